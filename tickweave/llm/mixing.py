"""Temperature mixing of sources to target weights."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import WORD, apart, cut, join_hot, ranked, ranked_sql, seeded, seeded_sql

#: Share of the largest entropy (equal weights) that the mixture should reach.
ENTROPY = 0.97
#: Most times that a source's tokens are read.
REPEATS = 2.0
SEED = 77


def shares(tokens: DataFrame) -> DataFrame:
    """Token counts and shares by source from rows (stratum, tokens); sources without tokens have share 0."""
    per = cut(tokens.groupBy("stratum").agg(F.sum("tokens").alias("source_tokens"), F.count(F.lit(1)).alias("rows")))
    total = per.agg(F.sum("source_tokens")).first()[0] or 0
    return cut(per.withColumn("share", F.col("source_tokens") / F.lit(float(max(total, 1)))))


def exponent(share: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """The largest exponent from 0 to 1 that meets the target entropy, raised as far as the repetition limit asks.

    Weights are share ** exponent, normalised.  Their entropy falls as the
    exponent grows, so it is bisected 32 ways at a time: a pass over the
    sources returns one entropy for each trial exponent, never the sources.
    The most read source is read (largest share / smallest) ** (1 - exponent)
    times as often as the least read one; that is bisected from the two shares.
    """
    used = share.where("share > 0")
    n, low, high = used.agg(F.count(F.lit(1)), F.min("share"), F.max("share")).first()
    if n < 2 or low == high:
        return 1.0
    a, b = 0.0, 1.0
    for k in range(7):
        grid = [a + (b - a) * i / 32 for i in range(33)]
        trial = used.select("share", F.explode(F.array(*map(F.lit, grid))).alias("alpha"))
        power, log = F.pow("share", "alpha"), F.log("share")
        sums = trial.groupBy("alpha").agg(F.sum(power).alias("z"), F.sum(power * log).alias("d")).collect()
        met = [x.alpha for x in sums if math.log(x.z) - x.alpha * x.d / x.z >= entropy * math.log(n)]
        if k == 0 and 1.0 in met:
            a = 1.0
            break
        a = max(met, default=0.0)
        b = min([g for g in grid if g > a], default=1.0)
    c, d = 0.0, 1.0
    if (high / low) ** (1 - a) > repeats:
        for _ in range(60):
            m = (c + d) / 2
            c, d = (m, d) if (high / low) ** (1 - m) > repeats else (c, m)
        a = max(a, d)
    return a


_ROW, _READS, _PART = "__row__", "__reads__", "__part__"
#: Readings of one row that a task makes at once.
TOGETHER = 10_000


def mix(
    docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, seed: int = SEED, block: int = 20_000, row: str | None = None
) -> DataFrame:
    """Every document as often as the tempered mixture reads it.

    The budget is the least that reads each source whole at least once, so no
    document is lost; a source's budget is its tokens times its readings.  It
    is realised in blocks: each block is a seeded permutation of the source's
    documents, whole but for the last, which stops where the budget does.
    Returns one row for each reading: ``row``, ``block`` (from 1) and ``rank``
    within the block, with the source's tokens, share, weight and readings.

    ``row`` names a column that tells rows apart; without it a hash of id,
    source and text does.  Null sources form one of their own; null texts have no tokens;
    a source without tokens is read once; no rows give no rows.
    """
    rows = cut(
        docs.select(
            "doc_id", "source",
            (seeded(seed, F.col("doc_id"), F.col("source"), F.col("text")) if row is None else F.col(row)).alias("row"),
            F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("v"), "source")).alias("stratum"),
            F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("tokens"),
        )
    )
    per = shares(rows)
    alpha = exponent(per, entropy, repeats)
    power = F.when(F.col("share") > 0, F.pow("share", F.lit(alpha))).otherwise(0.0)
    # share ** (alpha - 1) is smallest for the largest share, which is read once
    often = F.when(F.col("share") > 0, F.pow("share", F.lit(alpha - 1.0)))
    z, least = per.agg(F.sum(power), F.min(often)).first()
    plan = cut(
        per.select(
            "stratum", "source_tokens", "share", "rows",
            (power / F.lit(z or 1.0)).alias("weight"),
            F.coalesce(often / F.lit(least or 1.0), F.lit(1.0)).alias("readings"),
        )
        .withColumn("whole", F.floor("readings"))
        .withColumn("rest", F.floor((F.col("readings") - F.col("whole")) * F.col("source_tokens")))
    )
    reads = join_hot(rows, plan, "stratum", "rows", rows.count()).withColumn("block", F.explode(F.expr("sequence(1L, whole + if(rest > 0, 1L, 0L))")))
    reads = reads.withColumn("part", F.concat_ws(":", F.col("block").cast("string"), "stratum"))
    reads = reads.withColumn("h", seeded(seed, F.col("block"), F.col("doc_id"), F.col("row")))
    order = ranked(cut(reads), "part", ["h", "doc_id", "row"], "tokens", block)
    kept = order.where((F.col("block") <= F.col("whole")) | (F.col("before") < F.col("rest")))
    return kept.select(
        "doc_id", "row", "source", "tokens", "block", "rank", "source_tokens", "share", F.round("weight", 9).alias("weight"),
        F.round("readings", 9).alias("readings"), F.round(F.lit(alpha), 9).alias("exponent"),
    )


def row_key(docs: DataFrame) -> Column:
    """96 bits of hashes of all columns, which tell rows apart at any size; maps, which have no hash, are taken as JSON."""
    columns = [F.to_json(F.struct(F.col(f"`{x.name}`"))) if "map<" in x.dataType.simpleString() else F.col(f"`{x.name}`") for x in docs.schema]
    return F.concat_ws("-", F.xxhash64(*columns).cast("string"), F.hash(*columns).cast("string"))


def mix_rows(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves as the mixture reads them, with their own columns.

    Rows are told apart by a hash of all columns; those equal in all of them
    are as many readings of one.  The plan moves ids and counts; the texts are
    shuffled once, on that hash, to be repeated; one that is read very often is
    dealt in parts to many tasks.  Columns may have any names.
    """
    return apart(docs, (_ROW, _READS, _PART), lambda rows: _mix_rows(rows, **options))


def _mix_rows(docs: DataFrame, **options) -> DataFrame:
    keyed = docs.withColumn(_ROW, row_key(docs))
    reads = cut(mix(keyed, row=_ROW, **options).groupBy(F.col("row").alias(_ROW)).agg(F.count(F.lit(1)).alias(_READS)))
    once = keyed.dropDuplicates([_ROW])
    repeated = once.join(reads, _ROW)
    if reads.where(F.col(_READS) > TOGETHER).isEmpty():
        return repeated.withColumn(_ROW, F.explode(F.sequence(F.lit(1).cast("long"), F.col(_READS)))).select(*(F.col(f"`{c}`") for c in docs.columns))
    few, many = repeated.where(F.col(_READS) <= TOGETHER), repeated.where(F.col(_READS) > TOGETHER)
    parts = many.withColumn(_PART, F.explode(F.sequence(F.lit(0), F.floor((F.col(_READS) - 1) / TOGETHER)))).repartition(_ROW, _PART)
    parts = parts.withColumn(_READS, F.least(F.lit(TOGETHER), F.col(_READS) - F.col(_PART) * TOGETHER).cast("long")).drop(_PART)
    read = few.unionByName(parts).withColumn(_ROW, F.explode(F.sequence(F.lit(1).cast("long"), F.col(_READS))))
    return read.select(*(F.col(f"`{c}`") for c in docs.columns))


def sql(entropy: float = ENTROPY, repeats: float = REPEATS, seed: int = SEED) -> str:
    """``mix`` of the table documents in DuckDB, without ``row``."""
    steps = ["l0 AS (SELECT CAST(0 AS DOUBLE) AS a, CAST(1 AS DOUBLE) AS b)"]
    for k in range(7):
        steps += [
            f"g{k} AS (SELECT a + (b - a) * i / 32 AS alpha FROM l{k}, range(33) r(i))",
            f"m{k} AS (SELECT alpha FROM (SELECT alpha, sum(pow(share, alpha)) AS z, sum(pow(share, alpha) * ln(share)) AS d FROM g{k}, used GROUP BY alpha) WHERE ln(z) - alpha * d / z >= {entropy} * ln((SELECT n FROM facts)))",
            f"l{k + 1} AS (SELECT a, coalesce((SELECT min(alpha) FROM g{k} WHERE alpha > a), 1.0) AS b FROM (SELECT coalesce((SELECT max(alpha) FROM m{k}), 0.0) AS a))",
        ]
    return (
        "WITH docs AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 'v' || source END AS stratum, "
        f"CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens, {seeded_sql(seed, 'doc_id', 'source', 'text')} AS row FROM documents), "
        "src AS (SELECT stratum, source_tokens, source_tokens / greatest(sum(source_tokens) OVER (), 1) AS share FROM (SELECT stratum, CAST(sum(tokens) AS BIGINT) AS source_tokens FROM docs GROUP BY 1)), "
        f"used AS (SELECT share FROM src WHERE share > 0), facts AS (SELECT count(*) AS n, min(share) AS low, max(share) AS high FROM used), {', '.join(steps)}, "
        f"al AS (SELECT CASE WHEN n < 2 OR low = high THEN 1.0 WHEN pow(high / low, 1 - a) > {repeats} THEN greatest(a, 1 - ln({repeats}) / ln(high / low)) ELSE a END AS alpha FROM l7, facts), "
        "pw AS (SELECT *, CASE WHEN share > 0 THEN pow(share, alpha) ELSE 0 END AS w, CASE WHEN share > 0 THEN pow(share, alpha - 1) END AS o FROM src, al), "
        "pl AS (SELECT *, w / coalesce(nullif(sum(w) OVER (), 0), 1) AS weight, coalesce(o / min(o) OVER (), 1.0) AS readings FROM pw), "
        "plan AS (SELECT *, CAST(floor(readings) AS BIGINT) AS whole, CAST(floor((readings - floor(readings)) * source_tokens) AS BIGINT) AS rest FROM pl), "
        "ex AS (SELECT d.doc_id, d.source, d.tokens, d.row, p.*, unnest(range(1, whole + CASE WHEN rest > 0 THEN 2 ELSE 1 END)) AS block FROM docs d JOIN plan p USING (stratum)), "
        f"rows_ AS (SELECT *, block || ':' || stratum AS part, {seeded_sql(seed, 'block', 'doc_id', 'row')} AS h FROM ex), "
        f"{ranked_sql('rows_', 'part', 'h, doc_id NULLS FIRST, row', 'tokens')} "
        "SELECT doc_id, source, tokens, block, rank, source_tokens, share, round(weight, 9) AS weight, round(readings, 9) AS readings, round(alpha, 9) AS exponent FROM rows__1 WHERE block <= whole OR before < rest"
    )
