"""The stored tables: Parquet by month, appended and read through their newest rows."""

from __future__ import annotations

import urllib.parse
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave import schemas
from tickweave.functions import ids
from tickweave.operators import funding, validate
from tickweave.operators.versions import SEQ, current

#: Bytes of a file that compaction writes, about.
FILE_BYTES = 256_000_000


def init(spark: SparkSession, database: str) -> None:
    for statement in schemas.ddl(database):
        spark.sql(statement)


def _month(table: str) -> Column:
    return F.date_format(F.expr(schemas.MONTH_OF[table]), "yyyyMM")


def append(df: DataFrame, database: str, table: str, seq: Column) -> None:
    """Adds rows with their place in the order of insertion; rows of a key lie together within a file."""
    schema = schemas.TABLES[table]
    rows = df.select(*[F.col(x.name).cast(x.dataType).alias(x.name) for x in schema], seq.cast("long").alias(SEQ))
    if table in schemas.MONTH_OF:
        rows = rows.withColumn("month", _month(table))
    keys = schemas.KEYS[table]
    rows.sortWithinPartitions(*keys).write.mode("append").insertInto(f"{schemas.database_name(database)}.{table}")


def write_minutes(minutes: DataFrame, deltas: DataFrame, database: str, seq: Column) -> None:
    """Deltas first, minutes last: a minute is what makes its deltas visible.

    Rows that break a rule stop the write before anything is added, and
    writing the same rows again changes nothing that is read.
    """
    for df, rules in ((minutes, validate.minute()), (deltas, validate.delta())):
        bad = df.select(F.explode(rules).alias("rule")).groupBy("rule").count().collect()
        if bad:
            raise ValueError(f"not written: {sorted((x['rule'], x['count']) for x in bad)}")
    if not validate.orphan_deltas(minutes, deltas).isEmpty():
        raise ValueError("not written: deltas without a valid second")
    append(deltas, database, "order_book_second_delta", seq)
    append(minutes, database, "order_book_minute", seq)


def write_sound_minutes(minutes: DataFrame, deltas: DataFrame, database: str, seq: Column) -> int:
    """Writes the minutes that break no rule with their deltas, deltas first; the others go to ``minute_quarantine`` whole.

    Returns how many minutes were set aside.  Each row is checked once, and
    what is broken is collected as few rows of ids and rules.
    """
    held = minutes.select(F.col("id").alias("minute_id"), "valid_bitmap").groupBy("minute_id").agg(F.max("valid_bitmap").alias("_bits"))
    orphan = F.col("_bits").isNull() | ~ids.is_set(F.col("_bits"), F.col("second_offset"))
    of_deltas = F.array_union(validate.delta(), validate.codes(orphan=orphan))
    broken = minutes.select(F.col("id").alias("minute_id"), F.explode(validate.minute()).alias("rule"))
    broken = broken.unionByName(deltas.join(held, "minute_id", "left").select("minute_id", F.explode(of_deltas).alias("rule")))
    bad = broken.groupBy("minute_id").agg(F.sort_array(F.collect_set("rule")).alias("rules")).persist()
    try:
        n = bad.count()
        if n:
            held_out = lambda df, key: df.join(bad.withColumnRenamed("minute_id", key), key, "left_anti")
            rows = minutes.select(F.col("id").alias("minute_id"), F.to_json(F.struct("*")).alias("minute"))
            parts = deltas.groupBy("minute_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("second_offset", *[c for c in deltas.columns if c != "second_offset"])))).alias("deltas"))
            aside = bad.join(rows, "minute_id", "left").join(parts, "minute_id", "left")
            append(aside, database, "minute_quarantine", seq)
            minutes, deltas = held_out(minutes, "id").select(minutes.columns), held_out(deltas, "minute_id").select(deltas.columns)
        append(deltas, database, "order_book_second_delta", seq)
        append(minutes, database, "order_book_minute", seq)
    finally:
        bad.unpersist()
    return n


def read(spark: SparkSession, database: str, table: str, where: Column | str | None = None, months: list[str] | None = None) -> DataFrame:
    """The newest row of each key.  ``where`` bears on key columns and ``months`` on partitions; both reach the scan."""
    rows = spark.table(f"{schemas.database_name(database)}.{table}")
    if months is not None and table in schemas.MONTH_OF:
        rows = rows.where(F.col("month").isin(months))
    if where is not None:
        rows = rows.where(where)
    newest = current(rows, schemas.KEYS[table], version="is_actual" if table == "funding_rate_hourly" else None)
    return newest.select(*schemas.TABLES[table].names)


def upsert_rates(rates: DataFrame, database: str, seq: Column) -> None:
    """Appends the hourly rates that change what is stored: none over a stored actual by an estimate, none that says the same again.

    Only the months of these rates are read.
    """
    spark = rates.sparkSession
    months = [x.month for x in rates.select(_month("funding_rate_hourly").alias("month")).distinct().collect()]
    stored = spark.table(f"{schemas.database_name(database)}.funding_rate_hourly").where(F.col("month").isin(months))
    append(funding.upsert(stored, rates), database, "funding_rate_hourly", seq)


def confirm(tasks: DataFrame, answers: DataFrame, database: str, seq: Column) -> DataFrame:
    """Writes back the actual rates that answer tasks to the millisecond; returns the tasks that stay open."""
    upsert_rates(funding.confirm(tasks, answers), database, seq)
    keys = ["instrument_id", "funding_time"]
    return tasks.join(answers.where("rate is not null").select(keys), keys, "left_anti")


def instruments(spark: SparkSession, database: str) -> DataFrame:
    """All instruments in order of id; one that breaks a rule is an error when it is read."""
    rows = read(spark, database, "instrument")
    broken = validate.instrument()
    checked = F.when(F.size(broken) == 0, F.col("instrument_id")).otherwise(F.raise_error(F.concat_ws(",", broken)).cast("long"))
    return rows.withColumn("instrument_id", checked).orderBy("instrument_id")


def compact(spark: SparkSession, database: str, table: str, months: list[str] | None = None) -> list[str]:
    """Leaves the newest row of each key alone in months of a table, a file or so for each; returns the months that became smaller.

    The rows of a month are written beside the table and the month's place in
    the catalogue is then set to them, so a reader sees the files of before or
    those of after, and one that has begun keeps its own: they stay until
    ``vacuum``.  Rows keep their place in the order of insertion.  A month that
    was appended to meanwhile is left as it is and can be taken again; there is
    one writer for each table, and it doesn't write while this changes places.
    """
    name = f"{schemas.database_name(database)}.{table}"
    if table not in schemas.MONTH_OF:
        raise ValueError(f"{table} has no months")
    present = [r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    root = _location(spark, f"DESCRIBE FORMATTED {name}")
    done = []
    for month in sorted(set(present) & set(months) if months is not None else present):
        rows = spark.table(name).where(F.col("month") == month)
        files = sorted(rows.inputFiles())
        newest = current(rows, schemas.KEYS[table], version="is_actual" if table == "funding_rate_hourly" else None).drop("month")
        place = f"{root}/_compacted/month={month}/{uuid.uuid4().hex}"
        size = stored_bytes(spark, _location(spark, f"DESCRIBE FORMATTED {name} PARTITION (month = '{month}')"))
        newest.repartition(-(-size // FILE_BYTES) or 1, *schemas.KEYS[table]).sortWithinPartitions(*schemas.KEYS[table]).write.parquet(place)
        spark.catalog.refreshTable(name)
        if stored_bytes(spark, place) >= size or sorted(spark.table(name).where(F.col("month") == month).inputFiles()) != files:
            continue
        spark.sql(f"ALTER TABLE {name} PARTITION (month = '{month}') SET LOCATION '{place}'")
        done.append(month)
    spark.catalog.refreshTable(name)
    return done


def _location(spark: SparkSession, describe: str) -> str:
    """Where a table or the partition of one lies: a partition's own place comes first in its description."""
    return next(r.data_type for r in spark.sql(describe).collect() if r.col_name == "Location").rstrip("/")


def vacuum(spark: SparkSession, database: str, table: str, before: float) -> list[str]:
    """Deletes files of a table that no month's place has any more and that were last changed before a time (in seconds since the epoch).

    Give readers that began on them time to end.  Returns what was deleted.
    """
    name = f"{schemas.database_name(database)}.{table}"
    spark.catalog.refreshTable(name)
    used = {urllib.parse.unquote(urllib.parse.urlparse(x).path) for x in spark.table(name).inputFiles()}
    root = spark._jvm.org.apache.hadoop.fs.Path(_location(spark, f"DESCRIBE FORMATTED {name}"))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    listed, gone = files.listFiles(root, True), []
    while listed.hasNext():
        x = listed.next()
        path = x.getPath().toUri().getPath()
        if path.endswith(".parquet") and path not in used and x.getModificationTime() < before * 1000:
            files.delete(x.getPath(), False)
            gone.append(path)
    return gone


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a table's files, by Spark's own listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
