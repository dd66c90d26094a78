"""What the operators share: tables, the shared folder, distributed ranking and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for an absent id where the smallest id is asked for.
NO_ID = 2**63 - 1
#: Ranges that rows are sorted into at most; Spark samples a hundred narrow rows of each.
RANGES = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; on one machine a new one where it is unset."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tickweave-')}"
    found = full_address(spark, found)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(found)
    return found


def full_address(spark: SparkSession, path: str) -> str:
    """A path with the file system that Spark takes it to be on, as tasks that read without Spark would look on their own disk."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(found).toString()


def own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that tasks share, and the path in it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut, kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder, under one folder for each application, which may go when that ends."""
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def apart(docs: DataFrame, private: tuple[str, ...], f: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """f of a table whose columns have other names where these are f's own; f keeps the columns and their order."""
    names = docs.columns
    if not any(c.lower() in private for c in names):
        return f(docs)
    free = (x for x in (f"own_{i}" for i in range(10**6)) if x not in {c.lower() for c in names})
    return f(docs.toDF(*[next(free) if c.lower() in private else c for c in names])).toDF(*names)


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; rows without an id never do."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def lowest(rows: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows with the smallest hashes of their key, which doesn't repeat; all rows if there are no more.

    Of many rows those with hashes beyond about twice the share that is wanted
    are left out first, so the last sort takes some 2 n rows whatever the input.
    """
    h, total = F.xxhash64(key), rows.count()
    share = (2 * n + 1000) / max(total, 1)
    if share < 1:
        rows = rows.where(h < int(share * 2**64) - 2**63)
    return rows.orderBy(h, key).limit(n)


def in_batches(
    f: Callable[[pa.RecordBatch], pa.RecordBatch | None], rows: int = 512, size: int = 32_000_000
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: f on slices of at most this many rows and about this many bytes of ``text``, so that long texts don't add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heavy = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy() if "text" in batch.schema.names else np.zeros(batch.num_rows)
            sums, at = np.cumsum(heavy), 0
            while at < batch.num_rows:
                stop = int(np.searchsorted(sums, (sums[at - 1] if at else 0) + size, side="right"))
                stop = min(max(stop, at + 1), at + rows, batch.num_rows)
                out = f(batch.slice(at, stop - at))
                at = stop
                if out is not None and out.num_rows:
                    yield out

    return run


def seeded(seed: int, *parts: Column) -> Column:
    """A hash of 60 bits that SQL engines share: the first 15 hex digits of the MD5 of seed and parts, joined by colons; null is ``null``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(x.cast("string"), F.lit("null")) for x in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def unit(h: Column) -> Column:
    """A hash of 60 bits as a number from 0 to under 1."""
    return F.shiftright(h, 29).cast("double") / float(2**31)


def seeded_sql(seed: int, *parts: str) -> str:
    """``seeded`` in DuckDB."""
    text = " || ':' || ".join([f"'{seed}'", *[f"coalesce(CAST({x} AS VARCHAR), 'null')" for x in parts]])
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def ranked_sql(rows: str, stratum: str, order: str, weight: str) -> str:
    """``ranked`` in DuckDB: the common table ``{rows}_1`` over ``rows``."""
    return (
        f"{rows}_1 AS (SELECT *, count(*) OVER (PARTITION BY {stratum}) AS n, row_number() OVER w AS rank, CAST(sum({weight}) OVER w - {weight} AS BIGINT) AS before FROM {rows} "
        f"WINDOW w AS (PARTITION BY {stratum} ORDER BY {order} ROWS UNBOUNDED PRECEDING))"
    )


def ranked(df: DataFrame, stratum: str, order: list[str], weight: str, block: int = 20_000) -> DataFrame:
    """Ranks each stratum's rows in order without giving a stratum, or what is equal in all of ``order``, to one task.

    ``df`` is narrow and cut.  Its rows are dealt to ranges of about ``block``
    rows (to ``RANGES`` at most, beyond which ranges grow) of stratum and
    order, and of their own number, which parts rows that are equal in all
    else.  Counts and weights of the ranges are summed, so a row's place is
    that of its range plus that within it.  Adds ``rank`` (from 1), ``n``
    (rows of the stratum) and ``before`` (weight of the rows ahead).
    """
    ranges = int(min(max(1, -(-df.count() // block)), RANGES))
    dealt = df.withColumn("_r", F.monotonically_increasing_id()).repartitionByRange(ranges, stratum, *order, "_r")
    dealt = cut(dealt.withColumn("_p", F.spark_partition_id()))
    whole = Window.partitionBy(stratum)
    ahead = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_p", stratum).agg(F.count(F.lit(1)).alias("_n"), F.sum(weight).alias("_w"))
    sizes = sizes.select(
        "_p", stratum, F.sum("_n").over(whole).alias("n"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_n"), F.coalesce(F.sum("_w").over(ahead), F.lit(0)).alias("_w"),
    )
    within = Window.partitionBy("_p", stratum).orderBy(*order, "_r")
    return (
        dealt.join(sizes, ["_p", stratum])
        .withColumn("rank", F.col("_n") + F.row_number().over(within))
        .withColumn("before", F.col("_w") + F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col(weight))
        .drop("_p", "_r", "_n", "_w")
    )


def join_hot(rows: DataFrame, dim: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """rows joined with dim on a key that every row finds once, however hot some keys are.

    ``dim`` has for each key its number of rows; of ``total`` rows, at most
    1024 keys can have more than a 1024th each.  Those are broadcast; the rest,
    none of them hot, are shuffled.
    """
    hot = dim.where(F.col(count) * 1024 > total)
    cold = dim.where(F.col(count) * 1024 <= total)
    marks = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(marks, key, "left_anti").join(cold, key))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b) of longs: rows (node, root), root the smallest node.

    Alternates large-star and small-star: each round hangs neighbours on the
    smallest one known, until every edge joins a node to its root.  Rounds grow
    with the logarithm of the longest path; each is cut, and only two numbers
    come to the driver.  A hub's edges meet its least neighbour by broadcast.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    size, mark = now.count(), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = join_hot(both, least, "a", "n", 2 * size).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        met = join_hot(large, low, "a", "n", size)
        small = met.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        now = cut(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct())
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        size = seen[0]
        if mark == tuple(seen):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(seen)


ID = T.StructField("doc_id", T.LongType())
