"""Proportional stratified interleaving into shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import cut, ranked, ranked_sql, seeded, seeded_sql, unit

SHARDS = 24
SEED = 20_240_601


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, block: int = 20_000) -> DataFrame:
    """Deals all rows into ``shards`` so that each matches the mixture of sources.

    Rows of a source are shuffled by a seeded hash of the text, then of the id,
    and ranked; a rank divided by the source's rows, less a share fixed by the
    source's name, is the row's place from 0 to 1.  Rows are put in order of
    place and cut at equal counts, so shards' counts are at most one apart (law
    ``rows``).  Equal texts hash alike, so copies mostly meet in one shard.

    Only ids, hashes and sizes are shuffled, never texts.  The order of each
    source's rows, and that of all places, is dealt in ranges of about ``block``
    rows, so neither a hot source nor a hot text nor a row that is repeated
    lands in one task.

    Null sources form a source of their own; null texts have size 8 and the
    crc32 of nothing; null and repeated ids are kept, each row apart; an empty
    table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(
        docs.select(
            "doc_id", "source",
            F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("v"), "source")).alias("stratum"),
            seeded(seed, text).alias("h"),
            seeded(seed + 1, F.col("doc_id"), F.octet_length(text)).alias("h2"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
    )
    total = rows.count()
    placed = ranked(rows, "stratum", ["h", "h2", "doc_id", "text_crc32"], "size", block)
    offset = unit(seeded(seed + 2, F.col("stratum")))
    placed = cut(placed.withColumn("place", (F.col("rank") - offset) / F.col("n")).drop("rank", "n", "before").withColumn("all", F.lit(0)))
    order = ranked(placed, "all", ["place", "stratum", "h", "h2", "doc_id", "text_crc32"], "size", block).withColumn("g", F.col("rank") - 1)
    order = order.withColumn("shard", F.expr(f"cast((g * {shards}) div {max(total, 1)} as int)"))
    return order.select(
        "doc_id", "source", "size", "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.expr(f"g - (shard * {total}L + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sql(shards: int = SHARDS, seed: int = SEED) -> str:
    """``shard`` of the table documents in DuckDB; crc32 is folded from half-bytes with a table made by rule."""
    return (
        "WITH tab AS (SELECT list_transform(range(16), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(4)), lambda a, x: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))) AS tab), "
        "d AS (SELECT doc_id, source, coalesce(text, '') AS x, list_transform(string_split(hex(encode(coalesce(text, ''))), ''), lambda c: CAST(strpos('0123456789ABCDEF', c) - 1 AS BIGINT)) AS halves FROM documents), "
        "rows_ AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 'v' || source END AS stratum, "
        f"{seeded_sql(seed, 'x')} AS h, {seeded_sql(seed + 1, 'doc_id', 'octet_length(encode(x))')} AS h2, CAST(octet_length(encode(x)) + 8 AS BIGINT) AS size, "
        "CASE WHEN x = '' THEN 0 ELSE xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(halves)), lambda i: halves[xor(i, 1) + 1])), lambda a, y: xor(a >> 4, tab[xor(a & 15, y) + 1])), 4294967295) END AS text_crc32 FROM d, tab), "
        f"{ranked_sql('rows_', 'stratum', 'h, h2, doc_id NULLS FIRST, text_crc32', 'size')}, "
        f"pl AS (SELECT *, (rank - ({seeded_sql(seed + 2, 'stratum')} >> 29) / 2147483648.0) / n AS place FROM rows__1), "
        "o AS (SELECT *, row_number() OVER (ORDER BY place, stratum, h, h2, doc_id NULLS FIRST, text_crc32) - 1 AS g, count(*) OVER () AS total FROM pl), "
        f"s AS (SELECT *, g * {shards} // total AS shard FROM o) "
        f"SELECT doc_id, source, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INT) AS shard, CAST(g - (shard * total + {shards - 1}) // {shards} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard FROM s"
    )
