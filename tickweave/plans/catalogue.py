"""Registry of the market-data queries and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.functions import decimals, ids
from tickweave.operators import book, collect, funding, registry, replay, sampler, validate, versions, yields
from tickweave.plans import projection as p
from tickweave.plans.projection import BLOCK, MIDDLE, PAUSE, PRICES, STRETCH, table
from tickweave.schemas import DEPTH
from tickweave.sources import recorded, store
from tickweave.sources.binance import field, whole

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# Shared parts of the SQL; the Spark side doesn't use them.
_EV = (
    "ev AS (SELECT e.*, t.instrument_id FROM events e JOIN (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) AS BIGINT) AS instrument_id "
    "FROM (SELECT DISTINCT event_type FROM events)) t USING (event_type))"
)
_WR = _EV + (
    ", wr AS MATERIALIZED (SELECT instrument_id, sec, sec // 60 AS minute, sec % 60 AS second, CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, "
    f"CAST(CASE WHEN event_id % 2 = 0 THEN {PRICES} - user_id % {PRICES} ELSE {PRICES + 1} + user_id % {PRICES} END AS BIGINT) AS price, CAST(event_id % 4 AS BIGINT) AS qty, event_id "
    "FROM (SELECT *, CAST((day(ts) - 1) * 24 + hour(ts) AS BIGINT) AS sec FROM ev))"
)
_SAMPLES = _WR + (
    ", lastw AS (SELECT instrument_id, side, price, sec, arg_max(qty, event_id) AS qty FROM wr GROUP BY ALL), "
    "secs AS (SELECT CAST(unnest(range(0, (SELECT max(sec) + 1 FROM wr))) AS BIGINT) AS sec), "
    "grid AS (SELECT instrument_id, side, price, sec FROM (SELECT DISTINCT instrument_id, side, price FROM wr), secs), "
    "state AS MATERIALIZED (SELECT instrument_id, side, price, sec, last_value(qty IGNORE NULLS) OVER (PARTITION BY instrument_id, side, price ORDER BY sec) AS qty "
    "FROM grid LEFT JOIN lastw USING (instrument_id, side, price, sec)), "
    "valid AS MATERIALIZED (SELECT instrument_id, sec, sec // 60 AS minute, sec % 60 AS second FROM (SELECT DISTINCT instrument_id FROM wr), secs WHERE (instrument_id + sec) % 7 <> 3), "
    "anch AS MATERIALIZED (SELECT instrument_id, minute, CAST(sum(CAST(1 AS BIGINT) << second) AS BIGINT) AS valid_bitmap FROM valid GROUP BY 1, 2 HAVING min(second) = 0), "
    "top AS MATERIALIZED (SELECT * FROM (SELECT s.instrument_id, v.minute, v.second, s.side, s.price, s.qty, row_number() OVER (PARTITION BY s.instrument_id, s.sec, s.side "
    "ORDER BY CASE WHEN s.side = 'bid' THEN -s.price ELSE s.price END) AS level FROM state s JOIN valid v USING (instrument_id, sec) WHERE s.qty > 0) "
    f"WHERE level <= {DEPTH})"
)


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _us(c: str) -> Column:
    return F.unix_micros(c)


@_query(
    "minute_bitmap",
    f"WITH {_WR} SELECT instrument_id, minute, CAST(sum(CAST(1 AS BIGINT) << second) AS BIGINT) AS valid_bitmap "
    "FROM (SELECT DISTINCT instrument_id, minute, second FROM wr) GROUP BY 1, 2 HAVING min(second) = 0",
)
def minute_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampler.anchored(p.writes(spark, sf_dir).select("instrument_id", "minute", "second").distinct())


@_query(
    "replay_second_31",
    f"WITH {_WR}, l AS (SELECT instrument_id, minute, side, price, arg_max(qty, event_id) AS qty FROM wr WHERE second <= 31 GROUP BY ALL) "
    "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY instrument_id, minute, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END) AS INT) AS level "
    "FROM l WHERE qty > 0) WHERE level <= 50",
)
def replay_second_31(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.last_writes(p.writes(spark, sf_dir).where("second <= 31"), ["instrument_id", "minute"], "event_id")


@_query(
    "tick_conversion",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(cents AS BIGINT) AS tick, CAST(CASE WHEN cents % 5 = 0 THEN cents // 5 END AS BIGINT) AS coarse_tick, "
    "CAST(l_quantity AS BIGINT) * 4 AS lot FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * 100 AS BIGINT) AS cents FROM lineitem)",
)
def tick_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, lot = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_quantity").cast("decimal(18,2)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", decimals.price_tick(price, F.lit("0.01"), "decimal(18,2)").alias("tick"),
        decimals.price_tick(price, F.lit("0.05"), "decimal(18,2)").alias("coarse_tick"), decimals.quantity_lot(lot, F.lit("0.25"), "decimal(18,2)").cast("long").alias("lot"),
    )


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.events(spark, sf_dir)
    span = rows.agg(F.date_trunc("hour", F.min("ts")).alias("a"), F.date_trunc("hour", F.max("ts")).alias("b"))
    each = rows.select("instrument_id").distinct().join(F.broadcast(span))
    return each.select("instrument_id", F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("hour"))


_HOURS = (
    "hrs AS (SELECT instrument_id, unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM ev), (SELECT date_trunc('hour', max(ts)) FROM ev), INTERVAL 1 HOUR)) AS hour "
    "FROM (SELECT DISTINCT instrument_id FROM ev))"
)


@_query(
    "hourly_asof",
    f"WITH {_EV}, {_HOURS} SELECT h.instrument_id, epoch_us(h.hour) AS hour_us, arg_max(e.event_id, e.event_id) AS event_id, epoch_us(max(e.ts)) AS source_us "
    "FROM hrs h JOIN ev e ON e.instrument_id = h.instrument_id AND e.ts <= h.hour AND e.ts >= h.hour - INTERVAL 10 MINUTE GROUP BY 1, 2",
)
def hourly_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.events(spark, sf_dir).select(
        "instrument_id", F.timestamp_seconds(F.lit(4102444800)).alias("funding_time"), F.col("event_id").alias("rate"),
        F.col("ts").alias("source_time"), F.col("event_id").alias("arrival"),
    )
    found = funding.at_hours(rows, _hours(spark, sf_dir), max_age="10 minutes")
    return found.select("instrument_id", _us("hour").alias("hour_us"), F.col("rate").alias("event_id"), _us("source_time").alias("source_us"))


@_query(
    "settlement_asof",
    f"WITH {_EV}, {_HOURS}, est AS (SELECT *, (epoch_us(ts) // 28800000000) * 28800000000 + 28800000000 + CASE WHEN event_id % 2 = 1 THEN 28800000000 ELSE 0 END AS target FROM ev), "
    "known AS (SELECT h.instrument_id, epoch_us(h.hour) AS hour_us, e.target, max(e.event_id) AS event_id, epoch_us(max(e.ts)) AS source_us FROM hrs h JOIN est e "
    "ON e.instrument_id = h.instrument_id AND e.ts <= h.hour AND e.ts >= h.hour - INTERVAL 48 HOUR GROUP BY 1, 2, 3), "
    "flag AS (SELECT *, bool_or(target = hour_us) OVER (PARTITION BY instrument_id, hour_us) AS settlement, source_us >= hour_us - 1800000000 AS fresh FROM known) "
    "SELECT instrument_id, hour_us, settlement, arg_max(event_id, event_id) AS event_id, arg_max(source_us, event_id) AS source_us, arg_max(target, event_id) AS funding_us "
    "FROM flag WHERE fresh AND (NOT settlement OR target = hour_us) GROUP BY 1, 2, 3",
)
def settlement_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.timestamp_seconds(p.settlement() + F.when(F.col("event_id") % 2 == 1, 28800).otherwise(0))
    rows = p.events(spark, sf_dir).select(
        "instrument_id", target.alias("funding_time"), F.col("event_id").alias("rate"), F.col("ts").alias("source_time"), F.col("event_id").alias("arrival")
    )
    found = funding.at_hours(rows, _hours(spark, sf_dir), max_age="30 minutes")
    return found.select(
        "instrument_id", _us("hour").alias("hour_us"), "settlement", F.col("rate").alias("event_id"), _us("source_time").alias("source_us"), _us("funding_time").alias("funding_us")
    )


@_query(
    "delta_encoding",
    f"WITH {_SAMPLES}, vs AS (SELECT v.*, lag(second) OVER (PARTITION BY v.instrument_id, v.minute ORDER BY second) AS before FROM valid v JOIN anch USING (instrument_id, minute)), "
    "cur AS (SELECT v.instrument_id, v.minute, v.second, t.side, t.price, t.qty FROM vs v JOIN top t USING (instrument_id, minute, second) WHERE v.second > 0), "
    "prv AS (SELECT v.instrument_id, v.minute, v.second, t.side, t.price, t.qty FROM vs v JOIN top t ON t.instrument_id = v.instrument_id AND t.minute = v.minute AND t.second = v.before), "
    "both_ AS (SELECT instrument_id, minute, second, side, price, qty AS now, NULL AS was FROM cur UNION ALL SELECT instrument_id, minute, second, side, price, NULL, qty FROM prv) "
    "SELECT instrument_id, minute, CAST(second AS INT) AS second, side, price, coalesce(max(now), 0) AS qty FROM both_ GROUP BY instrument_id, minute, second, side, price HAVING max(now) IS DISTINCT FROM max(was)",
)
def delta_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = sampler.rank_levels(p.samples(spark, sf_dir), DEPTH)
    return sampler.changes(top, p.held_seconds(spark, sf_dir)).withColumn("second", F.col("second").cast("int"))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes with their deltas."""
    return sampler.whole_minutes(p.samples(spark, sf_dir), p.held_seconds(spark, sf_dir), DEPTH)


@_query(
    "encode_replay_roundtrip",
    f"WITH {_SAMPLES} SELECT (t.minute << 32) | t.instrument_id AS minute_id, CAST(t.second AS INT) AS second, t.side, t.price, t.qty, CAST(t.level AS INT) AS level "
    "FROM top t JOIN anch USING (instrument_id, minute)",
)
def encode_replay_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = replay.every_second(_stored(spark, sf_dir), depth=DEPTH)
    return levels.select("minute_id", "second", "side", "price", F.col("qty").cast("long").alias("qty"), "level")


@_query(
    "stored_at_second_59",
    f"WITH {_SAMPLES} SELECT (t.minute << 32) | t.instrument_id AS minute_id, t.side, t.price, t.qty, CAST(t.level AS INT) AS level "
    "FROM top t JOIN anch USING (instrument_id, minute) WHERE t.second = 59",
)
def stored_at_second_59(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = replay.at_second(_stored(spark, sf_dir), None, 59, DEPTH)
    return levels.select("minute_id", "side", "price", F.col("qty").cast("long").alias("qty"), "level")


@_query(
    "replay_requests",
    f"WITH {_SAMPLES}, req AS (SELECT DISTINCT instrument_id + (CASE WHEN event_id % 13 = 0 THEN 1000 ELSE 0 END) AS instrument_id, sec FROM (SELECT instrument_id, event_id, "
    "CAST((day(ts) - 1) * 24 + hour(ts) AS BIGINT) AS sec FROM ev)), best AS (SELECT instrument_id, minute, second, max(CASE WHEN side = 'bid' AND level = 1 THEN price END) AS bid, "
    "max(CASE WHEN side = 'bid' AND level = 1 THEN qty END) AS bid_qty, max(CASE WHEN side = 'ask' AND level = 1 THEN price END) AS ask, CAST(sum(qty) AS BIGINT) AS total FROM top GROUP BY 1, 2, 3) "
    "SELECT r.instrument_id, r.sec AS time_s, CASE WHEN a.valid_bitmap IS NULL THEN 'not_found' WHEN v.sec IS NULL THEN 'invalid' ELSE 'valid' END AS status, b.bid, b.bid_qty, b.ask, b.total "
    "FROM req r LEFT JOIN anch a ON a.instrument_id = r.instrument_id AND a.minute = r.sec // 60 LEFT JOIN valid v ON v.instrument_id = r.instrument_id AND v.sec = r.sec "
    "LEFT JOIN best b ON a.valid_bitmap IS NOT NULL AND b.instrument_id = r.instrument_id AND b.minute = r.sec // 60 AND b.second = r.sec % 60",
)
def replay_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = F.when(F.col("event_id") % 13 == 0, 1000).otherwise(0)
    asked = p.writes(spark, sf_dir).select((F.col("instrument_id") + shift).alias("instrument_id"), F.timestamp_seconds("sec").alias("time")).distinct()
    found = replay.books_of_whole(asked, _stored(spark, sf_dir), DEPTH)
    sums = lambda c: F.aggregate(c, F.lit(0).cast("decimal(30,0)"), lambda a, x: (a + x).cast("decimal(30,0)"))
    return found.select(
        "instrument_id", F.unix_seconds("time").alias("time_s"), "status", F.get("bid_prices", F.lit(0)).alias("bid"),
        F.get("bid_qtys", F.lit(0)).cast("long").alias("bid_qty"), F.get("ask_prices", F.lit(0)).alias("ask"),
        (sums("bid_qtys") + sums("ask_qtys")).cast("long").alias("total"),
    )


_WIDE = ", ".join(
    f"coalesce(max(CASE WHEN t.side = '{s}' AND t.level = {n} THEN t.{c} END), 0) AS {s}_{k}_{n:02d}"
    for s in ("bid", "ask")
    for n in range(1, DEPTH + 1)
    for k, c in (("price", "price"), ("qty", "qty"))
)


@_query(
    "wide_minutes",
    f"WITH {_SAMPLES} SELECT (a.minute << 32) | a.instrument_id AS id, a.instrument_id, a.minute * 60 AS minute_s, a.valid_bitmap, {_WIDE} FROM anch a "
    "LEFT JOIN top t ON t.instrument_id = a.instrument_id AND t.minute = a.minute AND t.second = 0 GROUP BY a.minute, a.instrument_id, a.valid_bitmap",
)
def wide_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = sampler.widen(_stored(spark, sf_dir), DEPTH)
    levels = [F.col(c).cast("long").alias(c) for c in wide.columns[4:]]
    return wide.select("id", "instrument_id", F.unix_seconds("minute_time").alias("minute_s"), "valid_bitmap", *levels)


@_query(
    "final_by_insertion",
    "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id",
)
def final_by_insertion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return versions.current(rows, ["user_id"], seq="event_id")


@_query(
    "final_by_version",
    "SELECT user_id, event_type, event_id, is_actual FROM (SELECT user_id, event_type, event_id, value > 50 AS is_actual, row_number() OVER (PARTITION BY user_id, event_type "
    "ORDER BY value > 50 DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
)
def final_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", (F.col("value") > 50).alias("is_actual"))
    return versions.current(rows, ["user_id", "event_type"], seq="event_id", version="is_actual")


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.events(spark, sf_dir).select(
        "instrument_id", F.date_trunc("hour", "ts").alias("hour_time"), F.timestamp_seconds(p.settlement()).alias("funding_time"),
        F.col("value").cast("decimal(18,2)").cast(decimals.WIDE).alias("rate"), (F.col("event_id") % 37 == 0).alias("is_actual"), F.col("event_id").alias("_ingest_seq"),
    )


_RATES = _EV + (
    ", rates AS (SELECT instrument_id, epoch_us(date_trunc('hour', ts)) AS hour_us, (epoch_us(ts) // 28800000000) * 28800000000 + 28800000000 AS funding_us, "
    "CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS BIGINT) AS cents, event_id % 37 = 0 AS is_actual, event_id FROM ev)"
)


@_query(
    "pending_confirmations",
    f"WITH {_RATES}, fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, hour_us ORDER BY is_actual DESC, event_id DESC) AS rn FROM rates) WHERE rn = 1) "
    "SELECT instrument_id, funding_us FROM fin WHERE funding_us BETWEEN epoch_us(TIMESTAMP '2024-01-05') AND epoch_us(TIMESTAMP '2024-01-20') "
    "GROUP BY 1, 2 HAVING max(CAST(is_actual AS INT)) = 0",
)
def pending_confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    since, through = (F.timestamp_seconds(F.lit(s)) for s in (1704412800, 1705708800))
    return funding.pending(_rates(spark, sf_dir), since, through).select("instrument_id", _us("funding_time").alias("funding_us"))


@_query(
    "upsert_rates",
    f"WITH {_RATES}, st AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, hour_us ORDER BY is_actual DESC, event_id DESC) AS rn FROM rates WHERE event_id % 3 > 0) WHERE rn = 1), "
    "inc AS (SELECT instrument_id, hour_us, arg_max(funding_us, event_id) AS funding_us, arg_max(cents, event_id) AS cents, arg_max(is_actual, event_id) AS is_actual FROM rates WHERE event_id % 3 = 0 GROUP BY 1, 2) "
    "SELECT i.instrument_id, i.hour_us, i.funding_us, i.cents, i.is_actual FROM inc i LEFT JOIN st s ON s.instrument_id = i.instrument_id AND s.hour_us = i.hour_us "
    "WHERE s.rn IS NULL OR NOT ((s.is_actual AND NOT i.is_actual) OR (s.is_actual = i.is_actual AND s.cents = i.cents AND s.funding_us = i.funding_us))",
)
def upsert_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rates(spark, sf_dir)
    incoming = versions.current(rows.where("_ingest_seq % 3 = 0"), ["instrument_id", "hour_time"]).drop("_ingest_seq")
    kept = funding.upsert(rows.where("_ingest_seq % 3 > 0"), incoming)
    return kept.select("instrument_id", _us("hour_time").alias("hour_us"), _us("funding_time").alias("funding_us"), (F.col("rate") * 100).cast("long").alias("cents"), "is_actual")


@_query("confirmation_tasks", f"WITH {_RATES} SELECT DISTINCT instrument_id, funding_us FROM rates")
def confirmation_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funding.tasks(_rates(spark, sf_dir)).select("instrument_id", _us("funding_time").alias("funding_us"))


@_query(
    "first_attempts",
    "SELECT event_id, CAST(CASE WHEN late >= 3600000000 THEN 3 WHEN late >= 900000000 THEN 2 WHEN late >= 300000000 THEN 1 ELSE 0 END AS INT) AS attempt, "
    "CASE WHEN late >= 120000000 THEN now_us ELSE target + 120000000 END AS due_us FROM (SELECT event_id, epoch_us(ts) AS now_us, (epoch_us(ts) // 7200000000) * 7200000000 AS target, "
    "epoch_us(ts) % 7200000000 AS late FROM events)",
)
def first_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.col("ts").cast("timestamp")
    rows = table(spark, sf_dir, "events").select("event_id", now.alias("now"), F.timestamp_seconds(F.floor(F.unix_seconds(now) / 7200) * 7200).alias("target"))
    attempt, due = funding.first_attempt(F.col("target"), F.col("now"))
    return rows.select("event_id", attempt.alias("attempt"), F.unix_micros(due).alias("due_us"))


@_query(
    "request_slots",
    f"WITH {_RATES}, due AS (SELECT DISTINCT instrument_id, funding_us, CASE WHEN instrument_id % 2 = 0 THEN 'OKX' ELSE 'Binance' END AS exchange, funding_us + 120000000 AS due_us FROM rates), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY exchange ORDER BY due_us, instrument_id, funding_us) - 1 AS k FROM due) "
    "SELECT exchange, instrument_id, funding_us, CAST(max(due_us - k * 1000000) OVER (PARTITION BY exchange ORDER BY k) + k * 1000000 AS BIGINT) AS start_us FROM k",
)
def request_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = funding.tasks(_rates(spark, sf_dir)).withColumn("exchange", F.when(F.col("instrument_id") % 2 == 0, "OKX").otherwise("Binance"))
    due = due.withColumn("due", F.col("funding_time") + F.expr("interval 2 minutes"))
    return funding.request_slots(due).select("exchange", "instrument_id", _us("funding_time").alias("funding_us"), _us("start").alias("start_us"))


def _instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.events(spark, sf_dir).select("instrument_id", "event_type").distinct()
    kind = F.when(F.col("instrument_id") == 5, "spot").otherwise("perpetual")
    return rows.select(
        "instrument_id", F.when(F.col("instrument_id") % 2 == 0, "OKX").otherwise("Binance").alias("exchange"), kind.alias("market_type"), F.col("event_type").alias("exchange_symbol")
    )


@_query(
    "backfill_routing",
    f"WITH {_RATES}, fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, hour_us ORDER BY is_actual DESC, event_id DESC) AS rn FROM rates) WHERE rn = 1), "
    "pend AS (SELECT instrument_id, funding_us FROM fin WHERE funding_us BETWEEN epoch_us(TIMESTAMP '2024-01-05') AND epoch_us(TIMESTAMP '2024-01-20') GROUP BY 1, 2 HAVING max(CAST(is_actual AS INT)) = 0) "
    "SELECT p.instrument_id, p.funding_us, CASE WHEN p.instrument_id % 2 = 0 THEN 'OKX' ELSE 'Binance' END AS exchange, t.event_type AS exchange_symbol FROM pend p "
    "JOIN (SELECT DISTINCT instrument_id, event_type FROM ev) t USING (instrument_id) WHERE p.instrument_id <> 5",
)
def backfill_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    since, through = (F.timestamp_seconds(F.lit(s)) for s in (1704412800, 1705708800))
    open_ = funding.pending(_rates(spark, sf_dir), since, through)
    routed = registry.route_backfill(open_, _instruments(spark, sf_dir), ["Binance", "OKX"])
    return routed.select("instrument_id", _us("funding_time").alias("funding_us"), "exchange", "exchange_symbol")


@_query(
    "startup_backfill",
    f"WITH {_RATES}, fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, hour_us ORDER BY is_actual DESC, event_id DESC) AS rn FROM rates) WHERE rn = 1), "
    "now AS (SELECT epoch_us(TIMESTAMP '2024-01-15 08:07:00') AS t), pend AS (SELECT instrument_id, funding_us, t, t - funding_us AS late FROM fin, now WHERE funding_us BETWEEN t - 86400000000 AND t GROUP BY ALL HAVING max(CAST(is_actual AS INT)) = 0) "
    "SELECT p.instrument_id, p.funding_us, CASE WHEN p.instrument_id % 2 = 0 THEN 'OKX' ELSE 'Binance' END AS exchange, "
    "CAST(CASE WHEN late >= 3600000000 THEN 3 WHEN late >= 900000000 THEN 2 WHEN late >= 300000000 THEN 1 ELSE 0 END AS INT) AS attempt, CASE WHEN late >= 120000000 THEN t ELSE funding_us + 120000000 END AS due_us "
    "FROM pend p WHERE p.instrument_id <> 5",
)
def startup_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.timestamp_seconds(F.lit(1705306020))
    found = funding.backfill(_rates(spark, sf_dir), now, _instruments(spark, sf_dir), ["Binance", "OKX"])
    return found.select("instrument_id", _us("funding_time").alias("funding_us"), "exchange", "attempt", _us("due").alias("due_us"))


@_query(
    "confirm_rates",
    f"WITH {_RATES} SELECT t.instrument_id, (t.funding_us // 3600000000) * 3600000000 AS hour_us, t.funding_us, a.cents FROM (SELECT DISTINCT instrument_id, funding_us FROM rates) t "
    "JOIN (SELECT instrument_id, funding_us, arg_max(cents, event_id) AS cents, arg_max(event_id, event_id) AS event_id FROM rates GROUP BY 1, 2) a USING (instrument_id, funding_us) WHERE a.event_id % 4 > 0",
)
def confirm_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rates(spark, sf_dir)
    last = rows.groupBy("instrument_id", "funding_time").agg(F.max_by("rate", "_ingest_seq").alias("rate"), F.max("_ingest_seq").alias("e"))
    answers = last.withColumn("rate", F.when(F.col("e") % 4 > 0, F.col("rate")))
    found = funding.confirm(funding.tasks(rows), answers)
    return found.select("instrument_id", _us("hour_time").alias("hour_us"), _us("funding_time").alias("funding_us"), (F.col("rate") * 100).cast("long").alias("cents"))


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.floor(F.col("value") * 10).cast("long")
    return table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("arrival_seq"), (whole - F.col("event_id") % 3 - 1).alias("prev_id"), (whole - F.col("event_id") % 5).alias("first_id"), whole.alias("final_id"))


_UPDATES = (
    "up AS (SELECT user_id, event_id AS arrival_seq, w - event_id % 3 - 1 AS prev_id, w - event_id % 5 AS first_id, w AS final_id FROM (SELECT *, CAST(floor(value * 10) AS BIGINT) AS w FROM events)), "
    "seen AS (SELECT *, max(final_id) OVER (PARTITION BY user_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM up)"
)


@_query(
    "sequence_chain",
    f"WITH {_UPDATES}, fresh AS (SELECT * FROM seen WHERE before IS NULL OR final_id > before) SELECT user_id, arrival_seq, prev_id, first_id, final_id, "
    "coalesce(prev_id <> lag(final_id) OVER (PARTITION BY user_id ORDER BY arrival_seq), FALSE) AS gap FROM fresh",
)
def sequence_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.chain_breaks(_updates(spark, sf_dir), ["user_id"])


@_query(
    "sequence_ranges",
    f"WITH {_UPDATES} SELECT user_id, arrival_seq, prev_id, first_id, final_id, coalesce(first_id > before + 1, FALSE) AS gap FROM seen WHERE before IS NULL OR final_id > before",
)
def sequence_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.range_breaks(_updates(spark, sf_dir), ["user_id"])


@_query(
    "id_allocation",
    "WITH inc AS (SELECT s_suppkey AS pos, CAST((s_nationkey + 10) % 5 AS INT) AS region, 'NATION_' || (s_nationkey + 10) AS name FROM supplier), "
    "first AS (SELECT region, name, min(pos) AS f FROM inc GROUP BY 1, 2), known AS (SELECT f.*, n.id FROM first f LEFT JOIN (SELECT n_regionkey AS region, n_name AS name, CAST(min(n_nationkey) + 1 AS BIGINT) AS id "
    "FROM nation GROUP BY 1, 2) n USING (region, name)), fresh AS (SELECT region, name, (SELECT max(n_nationkey) + 1 FROM nation) + row_number() OVER (ORDER BY f) AS id FROM known WHERE id IS NULL) "
    "SELECT i.pos, CAST(coalesce(k.id, fresh.id) AS BIGINT) AS instrument_id, k.id IS NULL AS is_new, i.region, i.name FROM inc i JOIN known k USING (region, name) LEFT JOIN fresh USING (region, name)",
)
def id_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).cast("long").alias("instrument_id"), F.col("n_regionkey").alias("region"), F.col("n_name").alias("name"))
    key = F.col("s_nationkey") + 10
    incoming = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pos"), (key % 5).cast("int").alias("region"), F.concat(F.lit("NATION_"), key.cast("string")).alias("name"))
    return registry.register(nations, incoming, fields=["region", "name"])


@_query(
    "ordered_selection",
    "SELECT CAST(v.pos AS INT) AS pos, n.n_name, n.n_nationkey, n.n_regionkey FROM (VALUES (0, 'NATION_7'), (1, 'NATION_3'), (2, 'NATION_21'), (3, 'NATION_0')) v(pos, name) JOIN nation n ON n.n_name = v.name",
)
def ordered_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_name", "n_nationkey", "n_regionkey")
    return registry.select_in_order(nations, ["NATION_7", "NATION_3", "NATION_21", "NATION_0"], "n_name")


@_query(
    "feed_lookup",
    "SELECT e.event_id, n.n_nationkey FROM events e LEFT JOIN nation n ON n.n_name = 'NATION_' || (e.user_id % 40)",
)
def feed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("NATION_"), (F.col("user_id") % 40).cast("string")).alias("symbol"))
    dim = table(spark, sf_dir, "nation").select(F.col("n_name").alias("exchange_symbol"), F.col("n_nationkey").alias("instrument_id"))
    known, unknown = registry.lookup(feed, dim, "symbol")
    both = known.select("event_id", "instrument_id").unionByName(unknown.select("event_id", F.lit(None).cast("int").alias("instrument_id")))
    return both.withColumnRenamed("instrument_id", "n_nationkey")


@_query(
    "snapshot_rules",
    "WITH b AS (SELECT l_orderkey, coalesce(list(l_partkey % 15 + 1 ORDER BY l_partkey % 15 DESC) FILTER (l_linenumber % 2 = 1), []) AS bp, "
    "coalesce(list(l_suppkey % 20 + 12 ORDER BY l_suppkey % 20) FILTER (l_linenumber % 2 = 0), []) AS ap FROM lineitem GROUP BY 1) "
    "SELECT l_orderkey, concat_ws(',', CASE WHEN len(bp) NOT BETWEEN 1 AND 3 THEN 'bid_depth' END, CASE WHEN len(list_distinct(bp)) < len(bp) THEN 'bid_order' END, "
    "CASE WHEN len(ap) NOT BETWEEN 1 AND 3 THEN 'ask_depth' END, CASE WHEN len(list_distinct(ap)) < len(ap) THEN 'ask_order' END, "
    "CASE WHEN len(bp) > 0 AND len(ap) > 0 AND bp[1] >= ap[1] THEN 'crossed' END) AS broken FROM b",
)
def snapshot_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("l_linenumber") % 2 == 1
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.when(odd, F.col("l_partkey") % 15 + 1)), asc=False).alias("bid_prices"),
        F.sort_array(F.collect_list(F.when(~odd, F.col("l_suppkey") % 20 + 12))).alias("ask_prices"),
    )
    books = rows.withColumns({f"{s}_qtys": F.transform(f"{s}_prices", lambda x: F.lit(1).cast("decimal(20,0)")) for s in ("bid", "ask")})
    return books.select("l_orderkey", F.concat_ws(",", validate.snapshot(3)).alias("broken"))


@_query(
    "instrument_rules",
    "WITH i AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'spot' WHEN 1 THEN 'perpetual' WHEN 2 THEN 'delivery' ELSE 'option' END AS kind, "
    "CASE WHEN p_partkey % 3 > 0 THEN p_type END AS settle, p_size % 3 AS mult, p_partkey % 5 = 0 AS expires, CASE WHEN p_partkey % 7 = 0 THEN ' ' || p_brand ELSE p_brand END AS ex FROM part) "
    "SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey < 1 THEN 'instrument_id' END, CASE WHEN trim(ex) <> ex THEN 'exchange_text' END, CASE WHEN kind = 'option' THEN 'market_type' END, "
    "CASE WHEN mult <= 0 THEN 'contract_multiplier' END, CASE WHEN (kind = 'spot') = (settle IS NOT NULL) THEN 'settle_asset' END, CASE WHEN kind = 'spot' AND mult <> 1 THEN 'spot_multiplier' END, "
    "CASE WHEN (kind = 'delivery') <> expires THEN 'expiry_time' END) AS broken FROM i",
)
def instrument_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, key = F.col("p_size") % 4, F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        key, key.alias("instrument_id"), F.when(key % 7 == 0, F.concat(F.lit(" "), "p_brand")).otherwise(F.col("p_brand")).alias("exchange"),
        F.when(size == 0, "spot").when(size == 1, "perpetual").when(size == 2, "delivery").otherwise("option").alias("market_type"),
        F.col("p_name").alias("exchange_symbol"), F.lit("A").alias("base_asset"), F.lit("B").alias("quote_asset"),
        F.when(key % 3 > 0, F.col("p_type")).alias("settle_asset"), (F.col("p_size") % 3).cast(decimals.WIDE).alias("contract_multiplier"),
        F.lit(1).cast(decimals.WIDE).alias("price_tick_size"), F.lit(1).cast(decimals.WIDE).alias("quantity_step_size"),
        F.when(key % 5 == 0, F.timestamp_seconds(F.lit(0))).alias("expiry_time"),
    )
    return rows.select("p_partkey", F.concat_ws(",", validate.instrument()).alias("broken"))


@_query(
    "strict_decimals",
    "WITH r AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN '' || user_id WHEN 1 THEN '-' || user_id || '.' || event_id % 1000 WHEN 2 THEN '+' || user_id WHEN 3 THEN user_id || 'e3' "
    "WHEN 4 THEN user_id || '.' WHEN 5 THEN '.' || event_id % 1000 WHEN 6 THEN ' ' || user_id WHEN 7 THEN user_id || '.1.2' ELSE user_id || '.0000000000000000001' END AS raw FROM events), "
    "s AS (SELECT *, regexp_matches(raw, '^-?([0-9]+[.]?[0-9]*|[.][0-9]+)$') AS ok FROM r) "
    "SELECT event_id, raw, ok AS is_strict, CASE WHEN ok AND event_id % 9 < 8 THEN CAST(CAST(rtrim(raw, '.') AS DECIMAL(38, 18)) * 1000 AS BIGINT) END AS thousandths FROM s",
)
def strict_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, part, case = F.col("user_id").cast("string"), (F.col("event_id") % 1000).cast("string"), F.col("event_id") % 9
    forms = [user, F.concat(F.lit("-"), user, F.lit("."), part), F.concat(F.lit("+"), user), F.concat(user, F.lit("e3")), F.concat(user, F.lit(".")), F.concat(F.lit("."), part), F.concat(F.lit(" "), user), F.concat(user, F.lit(".1.2"))]
    raw = F.concat(user, F.lit(".0000000000000000001"))
    for k, form in enumerate(forms):
        raw = F.when(case == k, form).otherwise(raw)
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", "raw", decimals.is_strict(F.col("raw")).alias("is_strict"), (decimals.strict(F.col("raw")) * 1000).cast("long").alias("thousandths"))


@_query("json_fields", "SELECT event_id, CAST(regexp_extract(props, '\"k\": ?([0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", whole(field("$.k", "props")).alias("k"))


@_query(
    "minute_ids",
    f"WITH {_EV} SELECT event_id, ((epoch_us(ts) // 60000000) << 32) | instrument_id AS minute_id, (epoch_us(ts) // 60000000) * 60 AS minute_s, instrument_id FROM ev",
)
def minute_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.events(spark, sf_dir).select("event_id", ids.minute_id(F.col("instrument_id"), F.col("ts")).alias("minute_id"))
    return rows.select("event_id", "minute_id", F.unix_seconds(ids.minute_time(F.col("minute_id"))).alias("minute_s"), ids.instrument_of(F.col("minute_id")).alias("instrument_id"))


@_query(
    "prices_from_ticks",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * 100 AS BIGINT) AS price_cents, "
    "CAST(l_quantity AS BIGINT) * p_size * 100 AS base_hundredths FROM lineitem JOIN part ON p_partkey = l_partkey",
)
def prices_from_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = tick_conversion(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
    price = decimals.price(F.col("tick"), F.lit("0.01").cast("decimal(4,2)"))
    base = decimals.quantity(F.col("lot"), F.lit("0.25").cast("decimal(4,2)"), F.col("p_size").cast("decimal(10,0)"))
    return ticks.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (price * 100).cast("long").alias("price_cents"), (base * 100).cast("long").alias("base_hundredths"))


@_query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query(
    "yield_routes",
    "SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'candidate' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'rejected' ELSE 'unknown' END AS eligibility, "
    "CAST(CAST(c_acctbal AS DECIMAL(18, 2)) * 100 AS BIGINT) - 100 - 50 - c_nationkey * 100 AS net_cents FROM customer",
)
def yield_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "none").when(F.col("c_mktsegment") == "MACHINERY", "fixed").when(F.col("c_mktsegment") == "HOUSEHOLD", "variable")
    net = yields.net_yield(F.col("c_acctbal").cast("decimal(18,2)"), F.lit(1), F.lit("0.5"), F.col("c_nationkey"), F.lit(0))
    return table(spark, sf_dir, "customer").select("c_custkey", yields.eligibility(kind).alias("eligibility"), (net * 100).cast("long").alias("net_cents"))


@_query(
    "staking_rewards",
    "WITH t AS (SELECT c_custkey AS candidate_id, CAST(floor(c_acctbal) + 2000 AS BIGINT) AS votes FROM customer ORDER BY 2 DESC, 1 LIMIT 127) SELECT candidate_id, votes, "
    "CAST(row_number() OVER (ORDER BY votes DESC, candidate_id) AS INT) AS place, CAST(1000000 * votes // sum(votes) OVER () AS BIGINT) AS vote_reward, "
    "CAST(CASE WHEN row_number() OVER (ORDER BY votes DESC, candidate_id) <= 27 THEN 270000 // 27 ELSE 0 END AS BIGINT) AS block_reward FROM t",
)
def staking_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("candidate_id"), (F.floor("c_acctbal") + 2000).cast("long").alias("votes"))
    return yields.staking(rows, 1_000_000, 270_000)


_BOOKS = (
    f"WITH {_EV}, up AS (SELECT instrument_id, event_id + 1 AS seq, CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, "
    f"CAST(CASE WHEN event_id % 2 = 0 THEN {PRICES} - user_id % {PRICES} ELSE {PRICES + 1} + user_id % {PRICES} END AS BIGINT) AS price, CAST(event_id % 4 AS BIGINT) AS qty FROM ev "
    f"UNION ALL SELECT instrument_id, 0, s.side, s.price, 1 FROM (SELECT DISTINCT instrument_id FROM ev), (VALUES ('bid', {PRICES}), ('ask', {PRICES + 1})) s(side, price)), "
    "cells AS (SELECT t.instrument_id, t.seq, c.side, c.price FROM (SELECT DISTINCT instrument_id, seq FROM up) t JOIN (SELECT DISTINCT instrument_id, side, price FROM up) c USING (instrument_id)), "
    "held AS (SELECT instrument_id, seq, side, price, last_value(u.qty IGNORE NULLS) OVER (PARTITION BY instrument_id, side, price ORDER BY seq) AS qty FROM cells LEFT JOIN up u USING (instrument_id, seq, side, price)), "
    "best AS (SELECT *, row_number() OVER (PARTITION BY instrument_id, seq, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END) AS level FROM held WHERE qty > 0), "
    f"sides AS (SELECT instrument_id, seq, string_agg(price || ':' || qty, ' ' ORDER BY level) FILTER (side = 'bid') AS bids, string_agg(price || ':' || qty, ' ' ORDER BY level) FILTER (side = 'ask') AS asks FROM best WHERE level <= {DEPTH} GROUP BY 1, 2) "
    "SELECT t.instrument_id, CAST(t.seq AS BIGINT) AS arrival_seq, 'valid' AS state, CAST(t.seq AS BIGINT) AS sequence, CASE WHEN bids IS NOT NULL AND asks IS NOT NULL THEN bids ELSE '' END AS bids, "
    "CASE WHEN bids IS NOT NULL AND asks IS NOT NULL THEN asks ELSE '' END AS asks FROM (SELECT DISTINCT instrument_id, seq FROM up) t LEFT JOIN sides USING (instrument_id, seq)"
)


@_query("stateful_books", _BOOKS)
def stateful_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an update of its instrument's book, after one snapshot; the state machine's view after each."""
    rows = p.events(spark, sf_dir)
    bid = F.col("event_id") % 2 == 0
    level = F.array(F.struct(
        F.when(bid, PRICES - F.col("user_id") % PRICES).otherwise(PRICES + 1 + F.col("user_id") % PRICES).cast("long").alias("price"), (F.col("event_id") % 4).cast("decimal(20,0)").alias("qty")
    ))
    none = F.array().cast("array<struct<price:bigint,qty:decimal(20,0)>>")
    before = F.coalesce(F.lag("event_id").over(Window.partitionBy("instrument_id").orderBy("event_id")) + 1, F.lit(0))
    common = ["instrument_id", F.lit("OKX").alias("exchange"), F.lit("perpetual").alias("market_type"), F.lit(1).cast("long").alias("conn_id")]
    updates = rows.select(
        *common, (F.col("event_id") + 1).alias("arrival_seq"), F.col("ts").alias("arrival_time"), F.lit("update").alias("kind"), F.lit(None).cast("long").alias("first_id"),
        (F.col("event_id") + 1).alias("final_id"), before.alias("prev_id"), F.col("ts").alias("source_time"),
        F.when(bid, level).otherwise(none).alias("bids"), F.when(~bid, level).otherwise(none).alias("asks"),
    )
    start = F.timestamp_seconds(F.lit(0))
    one = lambda price: F.array(F.struct(F.lit(price).cast("long").alias("price"), F.lit(1).cast("decimal(20,0)").alias("qty")))
    snapshots = rows.select("instrument_id").distinct().select(
        *common, F.lit(0).cast("long").alias("arrival_seq"), start.alias("arrival_time"), F.lit("snapshot").alias("kind"), F.lit(None).cast("long").alias("first_id"),
        F.lit(0).cast("long").alias("final_id"), F.lit(-1).cast("long").alias("prev_id"), start.alias("source_time"), one(PRICES).alias("bids"), one(PRICES + 1).alias("asks"),
    )
    found = book.replay_log(snapshots.unionByName(updates))
    return found.select("instrument_id", "arrival_seq", "state", "sequence", _levels("bid").alias("bids"), _levels("ask").alias("asks"))


def _levels(side: str) -> Column:
    """A side's levels as text."""
    pairs = F.arrays_zip(F.col(f"{side}_prices").alias("p"), F.col(f"{side}_qtys").alias("q"))
    return F.array_join(F.transform(pairs, lambda x: F.concat_ws(":", x["p"].cast("string"), x["q"].cast("string"))), " ")


_OUTAGES = (
    f"WITH {_EV}, up AS (SELECT instrument_id, event_id * 2 + 1 AS seq, sec // {BLOCK} AS block, CAST((sec + {PAUSE} * (sec // {BLOCK})) * 1000000 + part * 277 AS BIGINT) AS at_us, event_id % 2 = 0 AS bid, "
    f"CASE WHEN event_id % 2 = 0 THEN {PRICES} - user_id % {PRICES} ELSE {PRICES + 1} + user_id % {PRICES} END AS price FROM "
    "(SELECT *, (day(ts) - 1) * 24 + hour(ts) AS sec, minute(ts) * 60 + second(ts) AS part FROM ev)), "
    "log AS (SELECT instrument_id, seq, at_us, FALSE AS snap FROM up UNION ALL SELECT instrument_id, min(seq) - 1, min(at_us), TRUE FROM up GROUP BY instrument_id, block HAVING (instrument_id + block) % 3 <> 0), "
    "fin AS (SELECT max(at_us) AS t FROM log), nxt AS (SELECT *, lead(at_us) OVER (PARTITION BY instrument_id ORDER BY seq) AS n FROM log), "
    "flt AS (SELECT *, coalesce(n - at_us > 45000000, t - at_us >= 45000000) AS fault FROM nxt, fin), "
    "cnt AS (SELECT *, coalesce(sum(CAST(fault AS INT)) OVER (PARTITION BY instrument_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS faults FROM flt), "
    "own AS (SELECT *, max(CASE WHEN snap THEN faults END) OVER w AS snap_faults, max(CASE WHEN snap THEN seq END) OVER w AS snap_seq FROM cnt WINDOW w AS (PARTITION BY instrument_id ORDER BY seq ROWS UNBOUNDED PRECEDING)), "
    "sec AS (SELECT instrument_id, seq, snap_seq, unnest(range((at_us + 999999) // 1000000, ((CASE WHEN fault THEN at_us + 45000000 ELSE coalesce(n, t + 1) END) + 999999) // 1000000)) AS s FROM own WHERE snap_faults = faults), "
    "mins AS (SELECT instrument_id, s // 60 AS minute, CAST(sum(CAST(1 AS BIGINT) << (s % 60)) AS BIGINT) AS valid_bitmap, max(CASE WHEN s % 60 = 0 THEN seq END) AS seq, max(CASE WHEN s % 60 = 0 THEN snap_seq END) AS snap_seq "
    "FROM sec, fin WHERE (s // 60 + 1) * 60000000 <= t GROUP BY 1, 2 HAVING min(s % 60) = 0) "
    f"SELECT m.instrument_id, CAST(m.minute AS BIGINT) AS minute, m.valid_bitmap, CAST(coalesce(max(CASE WHEN u.bid THEN u.price END), 1) AS BIGINT) AS best_bid, CAST(coalesce(min(CASE WHEN NOT u.bid THEN u.price END), {2 * PRICES}) AS BIGINT) AS best_ask "
    "FROM mins m LEFT JOIN up u ON u.instrument_id = m.instrument_id AND u.seq > m.snap_seq AND u.seq <= m.seq GROUP BY 1, 2, 3"
)


@_query("outage_minutes", _OUTAGES)
def outage_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collector over a log with silences: minutes that end in one, and books that stay invalid after it."""
    log = p.book_log(spark, sf_dir)
    until = log.agg(F.max("arrival_time")).first()[0]
    found = collect.minutes(log, F.lit(until))[0]
    return found.select(
        "instrument_id", F.floor(F.unix_seconds("minute_time") / 60).cast("long").alias("minute"), "valid_bitmap", F.get("bid_prices", F.lit(0)).alias("best_bid"), F.get("ask_prices", F.lit(0)).alias("best_ask")
    )


def _availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a feed of estimates that goes down now and then; one in four has a source time from before the last one's."""
    down = F.col("event_id") % 11 == 0
    source = F.timestamp_micros(F.unix_micros("ts") - F.when(F.col("event_id") % 4 == 0, F.col("user_id") % 120 * 60_000_000).otherwise(0))
    return p.events(spark, sf_dir).select(
        "instrument_id", F.when(down, "unavailable").otherwise("estimate").alias("kind"), F.col("event_id").alias("arrival_seq"), F.col("ts").alias("arrival_time"),
        F.when(~down, F.timestamp_seconds(p.settlement())).alias("funding_time"), F.when(~down, source).alias("source_time"), F.when(~down, F.col("event_id")).alias("rate"),
    )


_DOWN = _EV + (
    ", av AS (SELECT instrument_id, event_id AS seq, epoch_us(ts) AS us, event_id % 11 = 0 AS down, epoch_us(ts) - CASE WHEN event_id % 4 = 0 THEN user_id % 120 * 60000000 ELSE 0 END AS src, "
    "(epoch_us(ts) // 28800000000) * 28800000000 + 28800000000 AS target FROM ev), "
    "tk AS (SELECT *, max(src) OVER (PARTITION BY instrument_id, target ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM av WHERE NOT down), "
    "st AS (SELECT instrument_id, seq, us, TRUE AS up FROM tk WHERE newest IS NULL OR src >= newest UNION ALL SELECT instrument_id, seq, us, FALSE FROM av WHERE down), "
    "tn AS (SELECT *, lag(up) OVER (PARTITION BY instrument_id ORDER BY seq) AS was FROM st), "
    "tr AS (SELECT *, lead(us) OVER w AS nxt, lag(seq) OVER w IS NULL AS head FROM tn WHERE was IS NULL OR up <> was WINDOW w AS (PARTITION BY instrument_id ORDER BY seq)), "
    "dn AS (SELECT instrument_id, us AS from_us, nxt AS to_us FROM tr WHERE NOT up AND NOT head UNION ALL SELECT instrument_id, NULL, CASE WHEN up THEN us ELSE nxt END FROM tr WHERE head)"
)


@_query("estimate_outages", f"WITH {_DOWN} SELECT * FROM dn")
def estimate_outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funding.outages(_availability(spark, sf_dir)).select("instrument_id", _us("from_time").alias("from_us"), _us("to_time").alias("to_us"))


@_query(
    "available_asof",
    f"WITH {_DOWN}, {_HOURS}, hr AS (SELECT instrument_id, epoch_us(hour) AS hour_us FROM hrs), "
    "ok AS (SELECT * FROM hr h WHERE NOT EXISTS (SELECT 1 FROM dn d WHERE d.instrument_id = h.instrument_id AND coalesce(d.from_us <= h.hour_us, TRUE) AND coalesce(h.hour_us < d.to_us, TRUE))), "
    "known AS (SELECT h.instrument_id, h.hour_us, e.target, arg_max(e.seq, (e.src, e.seq)) AS event_id, max(e.src) AS source_us FROM ok h JOIN tk e "
    "ON e.instrument_id = h.instrument_id AND e.src <= h.hour_us AND e.src >= h.hour_us - 172800000000 GROUP BY 1, 2, 3), "
    "flag AS (SELECT *, bool_or(target = hour_us) OVER (PARTITION BY instrument_id, hour_us) AS settlement, source_us >= hour_us - 1800000000 AS fresh FROM known) "
    "SELECT instrument_id, hour_us, settlement, arg_max(event_id, (source_us, event_id)) AS event_id, max(source_us) AS source_us "
    "FROM flag WHERE fresh AND (NOT settlement OR target = hour_us) GROUP BY 1, 2, 3",
)
def available_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates at hours, none where the feed was down then."""
    log = _availability(spark, sf_dir)
    rows = log.where("kind = 'estimate'").select("instrument_id", "funding_time", "rate", "source_time", F.col("arrival_seq").alias("arrival"))
    found = funding.at_hours(rows, _hours(spark, sf_dir), max_age="30 minutes", unavailable=funding.outages(log))
    return found.select("instrument_id", _us("hour").alias("hour_us"), "settlement", F.col("rate").alias("event_id"), _us("source_time").alias("source_us"))


@_query("recorded_messages", "SELECT 'events' AS conn_id, event_id AS arrival_seq, epoch_us(ts) AS arrival_us, CAST(regexp_extract(props, '\"k\": ?([0-9]+)', 1) AS BIGINT) AS k FROM events")
def recorded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a recorded feed of one connection, read through the data source."""
    options = {"path": f"{sf_dir}/events.parquet", "arrival_seq": "event_id", "arrival_time": "ts", "payload": "props"}
    rows = spark.read.format(recorded.register(spark)).options(**options).load()
    return rows.select("conn_id", "arrival_seq", _us("arrival_time").alias("arrival_us"), whole(field("$.k", "payload")).alias("k"))


def _ladder(count: str, price: str, qty: int) -> str:
    return f"list_transform(range({count}), lambda i: {{'p': CAST({price} AS BIGINT), 'q': CAST({qty} AS BIGINT)}})"


# The rules of a book, one row of each instrument's log after the other.
_FAULTS = (
    f"WITH RECURSIVE {_EV}, num AS (SELECT *, CAST(row_number() OVER (PARTITION BY instrument_id ORDER BY event_id) - 1 AS BIGINT) AS n, instrument_id % 2 = 0 AS chained, "
    "CASE WHEN instrument_id % 2 = 0 THEN 400 ELSE 1000 END AS retained FROM ev), "
    f"pos AS (SELECT *, n % {STRETCH} AS k, (n // {STRETCH}) % 8 AS fault, n * 10 - 5 AS before FROM num), "
    "own AS (SELECT *, k = 0 OR (fault = 7 AND k = 40) AS snap, fault = 7 AND k = 40 AS bad, (fault = 3 AND k = 60) OR (fault = 5 AND k = 50) AS planted, CASE WHEN (fault = 1 AND k = 50) OR (fault = 6 AND k = 1) THEN 3 ELSE 0 END AS skip FROM pos), "
    "log AS MATERIALIZED (SELECT instrument_id, n, event_id, chained, retained, snap, bad, before + 1 + skip AS first_id, before + skip AS prev_id, CASE WHEN fault = 2 AND k = 50 THEN before - 1 ELSE before + 10 END AS final_id, "
    f"CASE WHEN snap AND fault IN (4, 5) AND NOT bad THEN {_ladder('retained', f'{MIDDLE} - 2 * i', 2)} WHEN snap THEN {_ladder('10', f'{MIDDLE} - i', 2)} "
    f"WHEN fault = 3 AND k = 60 THEN [{{'p': CAST({MIDDLE + 500} AS BIGINT), 'q': CAST(1 AS BIGINT)}}] WHEN fault = 5 AND k = 50 THEN {_ladder('retained - 20', f'{MIDDLE} - 2 * i', 0)} "
    f"WHEN event_id % 2 = 0 THEN [{{'p': CAST({MIDDLE} - user_id % 60 AS BIGINT), 'q': CAST(event_id % 4 AS BIGINT)}}] ELSE [] END AS cb, "
    f"CASE WHEN snap THEN {_ladder('10', f'{MIDDLE + 1} + i', 3)} WHEN event_id % 2 = 1 AND NOT planted THEN [{{'p': CAST({MIDDLE + 1} + user_id % 60 AS BIGINT), 'q': CAST(event_id % 4 AS BIGINT)}}] ELSE [] END AS ca FROM own), "
    "run AS (SELECT instrument_id, n, event_id, 'valid' AS state, final_id AS sequence, CAST(NULL AS VARCHAR) AS reason, TRUE AS seen, FALSE AS bridged, cb AS bids, ca AS asks, len(cb) < retained AS bw, len(ca) < retained AS aw FROM log WHERE n = 0 "
    "UNION ALL SELECT instrument_id, n, event_id, CASE WHEN act IN ('gap', 'reset', 'bridge', 'crossed', 'lost') THEN 'invalid' WHEN act = 'snapshot' THEN 'valid' ELSE state END, CASE WHEN act IN ('ok', 'snapshot') THEN final_id ELSE sequence END, "
    "CASE act WHEN 'gap' THEN 'gap' WHEN 'reset' THEN 'sequence reset' WHEN 'bridge' THEN 'the first update does not bridge the snapshot' WHEN 'crossed' THEN 'crossed' WHEN 'lost' THEN 'insufficient retained depth' WHEN 'refused' THEN 'crossed snapshot' WHEN 'none' THEN 'no snapshot yet' END, "
    "CASE WHEN act = 'snapshot' THEN TRUE WHEN act IN ('gap', 'reset', 'bridge', 'crossed', 'lost') THEN FALSE ELSE seen END, CASE WHEN act = 'snapshot' THEN FALSE WHEN act = 'ok' THEN TRUE ELSE bridged END, "
    "CASE WHEN act = 'snapshot' THEN cb WHEN act IN ('ok', 'lost') THEN tb ELSE bids END, CASE WHEN act = 'snapshot' THEN ca WHEN act IN ('ok', 'lost') THEN ta ELSE asks END, "
    "CASE WHEN act = 'snapshot' THEN len(cb) < retained WHEN act IN ('ok', 'lost') THEN tbw ELSE bw END, CASE WHEN act = 'snapshot' THEN len(ca) < retained WHEN act IN ('ok', 'lost') THEN taw ELSE aw END FROM ("
    "SELECT *, CASE WHEN bad THEN 'refused' WHEN snap THEN 'snapshot' WHEN NOT seen THEN 'none' WHEN chained AND final_id < prev_id THEN 'reset' WHEN final_id <= sequence THEN 'old' WHEN chained AND prev_id <> sequence THEN 'gap' "
    "WHEN NOT chained AND NOT bridged AND NOT (first_id <= sequence + 1 AND sequence + 1 <= final_id) THEN 'bridge' WHEN NOT chained AND bridged AND first_id > sequence + 1 THEN 'gap' "
    "WHEN len(nb) > 0 AND len(na) > 0 AND list_max(list_transform(nb, lambda x: x.p)) >= list_min(list_transform(na, lambda x: x.p)) THEN 'crossed' WHEN (len(tb) < 50 AND NOT tbw) OR (len(ta) < 50 AND NOT taw) THEN 'lost' ELSE 'ok' END AS act FROM ("
    "SELECT *, CASE WHEN len(nb) > retained THEN list_sort(nb, 'DESC')[1:retained] ELSE nb END AS tb, CASE WHEN len(na) > retained THEN list_sort(na)[1:retained] ELSE na END AS ta, bw AND len(nb) <= retained AS tbw, aw AND len(na) <= retained AS taw FROM ("
    "SELECT l.*, r.state, r.sequence, r.seen, r.bridged, r.bids, r.asks, r.bw, r.aw, "
    "list_filter(r.bids, lambda x: NOT list_contains(list_transform(l.cb, lambda y: y.p), x.p)) || list_filter(l.cb, lambda x: x.q > 0) AS nb, list_filter(r.asks, lambda x: NOT list_contains(list_transform(l.ca, lambda y: y.p), x.p)) || list_filter(l.ca, lambda x: x.q > 0) AS na "
    "FROM run r JOIN log l ON l.instrument_id = r.instrument_id AND l.n = r.n + 1)))) "
    "SELECT instrument_id, event_id AS arrival_seq, state, sequence, reason, CASE WHEN shown THEN array_to_string(list_transform(list_sort(bids, 'DESC')[1:50], lambda x: x.p || ':' || x.q), ' ') ELSE '' END AS bids, "
    "CASE WHEN shown THEN array_to_string(list_transform(list_sort(asks)[1:50], lambda x: x.p || ':' || x.q), ' ') ELSE '' END AS asks FROM (SELECT *, state = 'valid' AND len(bids) > 0 AND len(asks) > 0 AS shown FROM run)"
)


@_query("faulty_books", _FAULTS)
def faulty_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state machine's view after every row of a log with all of its faults."""
    found = book.replay_log(p.faulty_log(spark, sf_dir))
    return found.select("instrument_id", "arrival_seq", "state", "sequence", "reason", _levels("bid").alias("bids"), _levels("ask").alias("asks"))


@_query(
    "stored_replay",
    f"WITH {_SAMPLES}, sound AS (SELECT instrument_id, minute FROM top WHERE second = 0 GROUP BY 1, 2 HAVING count(DISTINCT side) = 2) "
    "SELECT (t.minute << 32) | t.instrument_id AS minute_id, t.side, t.price, t.qty, CAST(t.level AS INT) AS level "
    "FROM top t JOIN anch USING (instrument_id, minute) JOIN sound USING (instrument_id, minute) WHERE t.second = 59",
)
def stored_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path through the store: minutes are written, written again as after a restart, compacted in place, read and replayed.

    A minute whose first book lacks a side breaks a rule and is set aside.  The
    tables are in a database of its own for each run, in the session's warehouse.
    """
    database = f"stored_{uuid.uuid4().hex}"
    store.init(spark, database)
    whole = _stored(spark, sf_dir).persist()
    minutes, deltas = sampler.split(whole)
    for number in (1, 2):
        store.write_sound_minutes(minutes, deltas, database, F.lit(number))
    whole.unpersist()
    for name in ("order_book_second_delta", "order_book_minute"):
        store.compact(spark, database, name)
    levels = replay.at_second(store.read(spark, database, "order_book_minute"), store.read(spark, database, "order_book_second_delta"), 59, DEPTH)
    return levels.select("minute_id", "side", "price", F.col("qty").cast("long").alias("qty"), "level")


@_query(
    "tiered_income",
    "WITH tier AS (SELECT n_regionkey AS r, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS BIGINT) AS k, count(*) OVER (PARTITION BY n_regionkey) AS n, n_nationkey + 1 AS mills FROM nation), "
    "pos AS (SELECT c_custkey AS position_id, c_nationkey % 5 AS yield_route_id, CAST(CAST(c_acctbal AS DECIMAL(18, 2)) * 100 AS BIGINT) AS cents FROM customer), "
    "met AS (SELECT p.*, CASE WHEN r % 2 = 0 THEN greatest(CASE WHEN k < n THEN least(cents, k * 200000) ELSE cents END - (k - 1) * 200000, 0) * mills "
    "WHEN cents >= (k - 1) * 200000 AND (k = n OR cents < k * 200000) THEN cents * mills ELSE 0 END AS part FROM pos p JOIN tier t ON t.r = p.yield_route_id) "
    "SELECT yield_route_id, position_id, CAST(CASE WHEN cents <= 0 THEN 0 ELSE sum(part) END AS BIGINT) AS income_mills FROM met GROUP BY yield_route_id, position_id, cents",
)
def tiered_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' balances at the tiers of five routes, which pay by tier or on the whole balance."""
    whole = Window.partitionBy("n_regionkey")
    tiers = table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("yield_route_id"), F.row_number().over(whole.orderBy("n_nationkey")).alias("tier_no"), F.count(F.lit(1)).over(whole).alias("n"),
        F.when(F.col("n_regionkey") % 2 == 0, "marginal").otherwise("whole_balance").alias("tier_mode"), ((F.col("n_nationkey") + 1) * F.lit("0.001").cast("decimal(9,3)")).alias("rate"),
    )
    tiers = tiers.withColumn("tier_min_amount", (F.col("tier_no") - 1) * 2000).withColumn("tier_max_amount", F.when(F.col("tier_no") < F.col("n"), F.col("tier_no") * 2000))
    amounts = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 5).alias("yield_route_id"), F.col("c_custkey").alias("position_id"), F.col("c_acctbal").cast("decimal(18,2)").alias("amount"))
    found = yields.tiered_income(amounts, tiers)
    return found.select("yield_route_id", "position_id", (F.col("income") * 100_000).cast("long").alias("income_mills"))
