"""Compaction in place, and recorded feeds as a source with offsets."""

from __future__ import annotations

import time
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickweave.sources import recorded, store
from tickweave.streaming import books as streaming

T0 = datetime(2026, 1, 1)


def rates(spark, rows):
    schema = "instrument_id long, hour_time timestamp, funding_time timestamp, rate decimal(38,18), is_actual boolean"
    return spark.createDataFrame([(i, T0 + timedelta(hours=h), T0 + timedelta(hours=h), Decimal(r), a) for i, h, r, a in rows], schema)


def test_compaction_in_place(spark):
    name, db = "funding_rate_hourly", "compacted"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    store.init(spark, db)
    hours = [0, 5, 800]  # two months
    for n in range(6):
        store.append(rates(spark, [(i, h, f"0.0{n}", n == 2 and h == 5) for i in (1, 2) for h in hours]), db, name, F.lit(n))
    read = lambda months=None: sorted(map(tuple, store.read(spark, db, name, months=months).collect()))
    before = read()
    assert {(r[1].month, r[1].hour, str(r[3])[:4], r[4]) for r in before} == {(1, 0, "0.05", False), (1, 5, "0.02", True), (2, 8, "0.05", False)}
    begun = store.read(spark, db, name)
    begun._jdf.queryExecution().executedPlan()  # a reader that knows its files already
    size = store.stored_bytes(spark, store._location(spark, f"DESCRIBE FORMATTED {db}.{name} PARTITION (month = '202601')"))
    assert store.compact(spark, db, name, ["202601", "209901"]) == ["202601"]
    place = store._location(spark, f"DESCRIBE FORMATTED {db}.{name} PARTITION (month = '202601')")
    assert "_compacted" in place and store.stored_bytes(spark, place) < size
    assert read() == before and sorted(map(tuple, begun.collect())) == before and len(read(["202602"])) == 2
    assert spark.table(f"{db}.{name}").count() == 4 + 12  # the other month has all its rows

    store.append(rates(spark, [(1, 0, "0.09", True)]), db, name, F.lit(9))  # goes to the month's new place
    store.upsert_rates(rates(spark, [(2, 5, "0.5", False)]), db, F.lit(10))  # an estimate never replaces an actual
    after = read()
    assert [r for r in after if r not in before] == [(1, T0, T0, Decimal("0.09"), True)] and len(after) == len(before)

    assert store.vacuum(spark, db, name, 0) == []
    gone = store.vacuum(spark, db, name, time.time() + 60)
    assert len(gone) >= 6 and read() == after
    assert store.compact(spark, db, name) == ["202601", "202602"] and read() == after
    assert store.compact(spark, db, name) == []  # nothing to gain
    with pytest.raises(ValueError, match="no months"):
        store.compact(spark, db, "instrument")


def write_part(spark, path, conn, a, b):
    rows = spark.range(a, b).select(F.lit(conn).alias("conn_id"), F.col("id").alias("arrival_seq"), F.timestamp_seconds(F.col("id") + 1000).alias("arrival_time"), F.concat(F.lit("m"), F.col("id")).alias("payload"))
    rows.coalesce(1).write.mode("append").partitionBy("conn_id").parquet(path)


def test_recorded_feed_as_a_stream_restarts_where_it_was(spark, tmp_path):
    name, path, out, seen = recorded.register(spark), str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    spark.conf.set("parquet.block.size", "1024")

    def run():
        stream = spark.readStream.format(name).option("path", path).load()
        query = streaming.append_each_batch(stream, out, seen)
        query.awaitTermination(120)
        return query

    write_part(spark, path, "a", 0, 50)
    write_part(spark, path, "b", 10, 20)
    run()
    first = spark.read.parquet(out).count()
    write_part(spark, path, "a", 50, 75)
    write_part(spark, path, "c", 0, 5)
    query = run()
    run()  # nothing new
    got = sorted((r.conn_id, r.arrival_seq, r.payload) for r in spark.read.parquet(out).collect())
    assert first == 60 and got == sorted([("a", n, f"m{n}") for n in range(75)] + [("b", n, f"m{n}") for n in range(10, 20)] + [("c", n, f"m{n}") for n in range(5)])
    assert query.lastProgress.sources[0].endOffset.replace("'", '"') == '{"a": 74, "b": 19, "c": 4}'
    batch = spark.read.format(name).option("path", path).load()
    assert batch.count() == 90 and batch.where("conn_id = 'a' and arrival_seq = 3").first().arrival_time == datetime(1970, 1, 1, 0, 16, 43)


def test_offsets_cut_row_groups(spark, tmp_path):
    path = str(tmp_path / "log")
    write_part(spark, path, "a", 0, 40)
    reader = recorded.StreamReader({"path": path})
    assert reader.latestOffset() == {"a": 39}
    rows = lambda start, end: [s for p in reader.partitions(start, end) for b in reader.read(p) for s in b.column("arrival_seq").to_pylist()]
    assert rows({}, {"a": 9}) == list(range(10)) and rows({"a": 9}, {"a": 12}) == [10, 11, 12] and rows({"a": 39}, {"a": 39}) == []
    with pytest.raises(FileNotFoundError):
        recorded.StreamReader({"path": path + "x"}).latestOffset()
    with pytest.raises(ValueError, match="path"):
        recorded.Log({})
