"""Queries of the wire parsers and rules: test tables written out as exchange payloads with planted faults, and parsed.

The SQL never parses: it states what each payload was made from, so it holds
the parsers to what went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions import decimals
from tickweave.operators import funding, validate
from tickweave.plans import projection as p
from tickweave.plans.catalogue import _EV, _HOURS, _hours, _query, _us
from tickweave.plans.projection import table
from tickweave.sources import binance, okx

_K = "k AS (SELECT *, event_id + 1 AS k, upper(event_type) AS sym, epoch_us(ts) // 1000 AS ms FROM ev)"
_TEXTS = "array<array<string>>"


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.events(spark, sf_dir).withColumn("k", F.col("event_id") + 1).withColumn("exchange_symbol", F.upper("event_type"))
    return rows.withColumn("ms", F.unix_millis("ts")).withColumn("market_type", F.when(F.col("instrument_id") % 2 == 1, "perpetual").otherwise("spot"))


def _each(n: int) -> Column:
    """Every n-th event, in which a fault is planted."""
    return F.col("k") % n == 0


def _broken() -> Column:
    return F.concat_ws(",", validate.VIOLATIONS).alias("broken")


def _level(*more: Column) -> Column:
    price = F.concat((F.col("user_id") % 60 + 1).cast("string"), F.lit("."), (F.col("k") % 10).cast("string"))
    qty = F.when(_each(17), F.lit("0.3")).otherwise(F.concat((F.col("k") % 4).cast("string"), F.lit(".250")))
    return F.array(price, qty, *more)


def _best(side: str) -> list[Column]:
    first = F.get(side, F.lit(0))
    return [first["price"].alias("tick"), first["qty"].cast("long").alias("lot")]


_BEST = "(user_id % 60 + 1) * 10 + k % 10 AS tick, CASE WHEN k % 17 > 0 THEN k % 4 * 4 + 1 END AS lot"


@_query(
    "wire_binance_updates",
    f"WITH {_EV}, {_K}, x AS (SELECT *, CASE WHEN k % 23 = 0 THEN k * 10 + 1 ELSE k * 10 - 9 END AS lo_id, k * 10 AS hi_id, CASE WHEN k % 31 = 0 THEN 0 ELSE k * 10 - 10 END AS pu, instrument_id % 2 = 1 AS futures FROM k) "
    f"SELECT event_id, lo_id AS first_id, hi_id AS final_id, pu AS prev_id, CASE WHEN futures THEN ms + 5 ELSE ms END AS source_ms, {_BEST}, "
    "concat_ws(',', CASE WHEN k % 29 = 0 THEN 'stream' END, CASE WHEN k % 11 = 0 THEN 'event' END, CASE WHEN k % 13 = 0 THEN 'symbol' END, CASE WHEN lo_id > hi_id THEN 'ids' END, "
    "CASE WHEN futures AND pu <= 0 THEN 'prev_id' END, CASE WHEN k % 17 = 0 OR k % 19 = 0 THEN 'bids' END) AS broken FROM x",
)
def wire_binance_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, symbol = F.col("k"), F.col("exchange_symbol")
    body = F.struct(
        F.when(_each(11), "trade").otherwise("depthUpdate").alias("e"), F.col("ms").alias("E"), (F.col("ms") + 5).alias("T"), F.when(_each(13), "OTHER").otherwise(symbol).alias("s"),
        F.when(_each(23), k * 10 + 1).otherwise(k * 10 - 9).alias("U"), (k * 10).alias("u"), F.when(_each(31), 0).otherwise(k * 10 - 10).alias("pu"),
        F.when(_each(19), F.array(_level(), _level())).otherwise(F.array(_level())).alias("b"), F.array().cast(_TEXTS).alias("a"),
    )
    stream = F.concat(F.when(_each(29), "other").otherwise(F.lower(symbol)), F.lit("@depth@100ms"))
    rows = _keyed(spark, sf_dir).select(
        "event_id", "exchange_symbol", "market_type", F.lit("0.1").cast(decimals.WIDE).alias("price_tick_size"), F.lit("0.25").cast(decimals.WIDE).alias("quantity_step_size"),
        F.to_json(F.struct(stream.alias("stream"), body.alias("data"))).alias("payload"),
    )
    return binance.depth_updates(rows).select("event_id", "first_id", "final_id", "prev_id", F.unix_millis("source_time").alias("source_ms"), *_best("bids"), _broken())


@_query(
    "wire_okx_depth",
    f"WITH {_EV}, {_K} SELECT event_id, CASE WHEN k % 11 = 0 THEN 'other' WHEN k % 7 = 0 THEN 'snapshot' ELSE 'update' END AS kind, k * 2 AS final_id, "
    f"CASE WHEN k % 29 = 0 THEN -5 WHEN k % 7 = 0 AND k % 11 > 0 THEN -1 ELSE k * 2 - 2 END AS prev_id, ms AS source_ms, {_BEST}, "
    "concat_ws(',', CASE WHEN k % 13 = 0 THEN 'channel' END, CASE WHEN k % 11 = 0 THEN 'action' END, CASE WHEN k % 23 = 0 THEN 'data' END, CASE WHEN k % 19 = 0 THEN 'source_time' END, "
    "CASE WHEN k % 29 = 0 THEN 'prev_id' END, CASE WHEN k % 17 = 0 OR k % 31 = 0 THEN 'bids' END, CASE WHEN k % 7 = 0 AND k % 11 > 0 THEN 'asks' END) AS broken FROM k WHERE k % 37 > 1",
)
def wire_okx_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, snapshot = F.col("k"), _each(7) & ~_each(11)
    level = F.array(_level(F.when(_each(31), "1").otherwise("0"), F.lit("2")))

    def payload(stamp: Column) -> Column:
        item = F.struct(
            F.array().cast(_TEXTS).alias("asks"), level.alias("bids"), stamp.alias("ts"),
            F.when(_each(29), -5).when(snapshot, -1).otherwise(k * 2 - 2).alias("prevSeqId"), (k * 2).alias("seqId"),
        )
        arg = F.struct(F.lit("books").alias("channel"), F.when(_each(13), "OTHER").otherwise(F.col("exchange_symbol")).alias("instId"))
        action = F.when(_each(11), "other").when(_each(7), "snapshot").otherwise("update")
        return F.to_json(F.struct(arg.alias("arg"), action.alias("action"), F.when(_each(23), F.array(item, item)).otherwise(F.array(item)).alias("data")))

    text = F.when(k % 37 == 0, "pong").when(k % 37 == 1, '{"event":"subscribe","arg":{"channel":"books"}}')
    text = text.when(_each(19), payload(F.col("ms"))).otherwise(payload(F.col("ms").cast("string")))  # a number where a text should be
    rows = _keyed(spark, sf_dir).select(
        "event_id", "exchange_symbol", F.lit("0.1").cast(decimals.WIDE).alias("price_tick_size"), F.lit("0.25").cast(decimals.WIDE).alias("quantity_step_size"), text.alias("payload")
    )
    return okx.depth(rows).select("event_id", "kind", "final_id", "prev_id", F.unix_millis("source_time").alias("source_ms"), *_best("bids"), _broken())


@_query(
    "wire_binance_snapshots",
    "WITH o AS (SELECT l_orderkey AS k, coalesce(list(l_partkey % 15 + 1) FILTER (l_linenumber % 2 = 1), []) AS bp, coalesce(list(l_suppkey % 20 + 12) FILTER (l_linenumber % 2 = 0), []) AS ap FROM lineitem GROUP BY 1), "
    "x AS (SELECT *, CASE WHEN k % 17 = 0 THEN 0 ELSE k END AS final_id, CASE WHEN k % 3 = 0 THEN 7000 WHEN k % 13 = 0 THEN 0 ELSE k * 1000 END AS source_ms FROM o) "
    "SELECT k, final_id, source_ms, CAST(len(bp) AS INT) AS bids, CAST(len(ap) AS INT) AS asks, list_max(bp) * 2 AS best_bid, list_min(ap) * 2 AS best_ask, "
    "concat_ws(',', CASE WHEN final_id = 0 THEN 'last_update_id' END, CASE WHEN source_ms = 0 THEN 'source_time' END, CASE WHEN len(bp) = 0 OR len(list_distinct(bp)) < len(bp) THEN 'bids' END, "
    "CASE WHEN len(ap) = 0 OR len(list_distinct(ap)) < len(ap) THEN 'asks' END, CASE WHEN coalesce(list_max(bp) >= list_min(ap), TRUE) THEN 'crossed' END) AS broken FROM x",
)
def wire_binance_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd, k = F.col("l_linenumber") % 2 == 1, F.col("l_orderkey")
    level = lambda price: F.array(F.concat(price.cast("string"), F.lit(".0")), F.lit("3"))
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(F.when(odd, level(F.col("l_partkey") % 15 + 1))).alias("bids"), F.collect_list(F.when(~odd, level(F.col("l_suppkey") % 20 + 12))).alias("asks")
    )
    stamp = F.when(~_mod(k, 3), F.when(_mod(k, 13), 0).otherwise(k * 1000))
    payload = F.to_json(F.struct(F.when(_mod(k, 17), 0).otherwise(k).alias("lastUpdateId"), stamp.alias("T"), "bids", "asks"))
    rows = orders.select(
        k.alias("k"), F.timestamp_millis(F.lit(7000)).alias("received_time"), F.lit("0.5").cast(decimals.WIDE).alias("price_tick_size"), F.lit("1").cast(decimals.WIDE).alias("quantity_step_size"),
        payload.alias("payload"),
    )
    prices = lambda side: F.transform(side, lambda x: x["price"])
    return binance.depth_snapshots(rows).select(
        "k", "final_id", F.unix_millis("source_time").alias("source_ms"), F.size("bids").alias("bids"), F.size("asks").alias("asks"),
        F.array_max(prices("bids")).alias("best_bid"), F.array_min(prices("asks")).alias("best_ask"), _broken(),
    )


def _mod(c: Column, n: int) -> Column:
    return c % n == 0


@_query(
    "wire_binance_instruments",
    "WITH x AS (SELECT p_partkey AS k, p_size, 'S' || (p_partkey - CASE WHEN p_partkey % 50 = 0 THEN 1 ELSE 0 END) AS symbol FROM part WHERE p_partkey % 9 > 0 AND p_partkey % 5 > 0 AND p_partkey % 7 > 0 "
    "UNION ALL SELECT p_partkey, p_size, 'S' || (p_partkey - 1) FROM part WHERE p_partkey % 50 = 0 AND p_partkey % 9 > 0 AND p_partkey % 7 > 0) "
    "SELECT p_size, symbol AS exchange_symbol, 'USDT' AS settle_asset, CASE WHEN k % 13 > 0 THEN p_size % 9 + 1 END AS tick_tenths, CAST(1 AS BIGINT) AS step_thousandths, "
    "concat_ws(',', CASE WHEN k % 11 = 0 THEN 'price_filter' END, CASE WHEN k % 13 = 0 THEN 'tick_size' END, CASE WHEN count(*) OVER (PARTITION BY symbol) > 1 THEN 'twice' END) AS broken FROM x",
)
def wire_binance_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    none = F.lit(None).cast("string")
    tick = F.when(_mod(k, 13), "0").otherwise(F.concat(F.lit("0."), (F.col("p_size") % 9 + 1).cast("string")))
    price = F.struct(F.lit("PRICE_FILTER").alias("filterType"), tick.alias("tickSize"), none.alias("stepSize"))
    lot = F.struct(F.lit("LOT_SIZE").alias("filterType"), none.alias("tickSize"), F.lit("0.001").alias("stepSize"))
    symbol = F.struct(
        F.concat(F.lit("S"), (k - F.when(_mod(k, 50), 1).otherwise(0)).cast("string")).alias("symbol"), F.when(_mod(k, 9), "BREAK").otherwise("TRADING").alias("status"),
        F.when(_mod(k, 5) & ~_mod(k, 50), "CURRENT_QUARTER").otherwise("PERPETUAL").alias("contractType"), F.lit("B").alias("baseAsset"), F.lit("USDT").alias("quoteAsset"),
        F.when(_mod(k, 7), "BUSD").otherwise("USDT").alias("marginAsset"), F.when(_mod(k, 11), F.array(price, price, lot)).otherwise(F.array(price, lot)).alias("filters"),
    )
    payloads = table(spark, sf_dir, "part").groupBy("p_size").agg(F.to_json(F.struct(F.collect_list(symbol).alias("symbols"))).alias("payload"))
    found = binance.instruments(payloads, "perpetual")
    return found.select(
        "p_size", "exchange_symbol", "settle_asset", (F.col("price_tick_size") * 10).cast("int").alias("tick_tenths"), (F.col("quantity_step_size") * 1000).cast("long").alias("step_thousandths"), _broken()
    )


@_query(
    "wire_okx_instruments",
    "WITH x AS (SELECT p_partkey AS k, p_size FROM part WHERE p_partkey % 9 > 0 AND p_partkey % 5 > 0) "
    "SELECT p_size, 'B' || k || CASE WHEN k % 17 = 0 THEN '-USDT-FUT' ELSE '-USDT-SWAP' END AS exchange_symbol, 'B' || k AS base_asset, 'USDT' AS quote_asset, "
    "CASE WHEN k % 19 > 0 THEN (p_size % 3 + 1) * 10 END AS multiplier_thousandths, concat_ws(',', CASE WHEN k % 17 = 0 THEN 'name' END, CASE WHEN k % 19 = 0 THEN 'contract' END, "
    "CASE WHEN k % 11 = 0 THEN 'contract_asset' END, CASE WHEN k % 13 = 0 THEN 'step_size' END) AS broken FROM x",
)
def wire_okx_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, empty = F.col("p_partkey"), F.lit("")
    base = F.concat(F.lit("B"), k.cast("string"))
    item = F.struct(
        F.lit("SWAP").alias("instType"), F.concat(base, F.when(_mod(k, 17), "-USDT-FUT").otherwise("-USDT-SWAP")).alias("instId"), F.when(_mod(k, 9), "suspend").otherwise("live").alias("state"),
        empty.alias("baseCcy"), empty.alias("quoteCcy"), F.lit("USDT").alias("settleCcy"), F.when(_mod(k, 5), "inverse").otherwise("linear").alias("ctType"), F.lit("0.01").alias("ctVal"),
        F.when(_mod(k, 19), "").otherwise((F.col("p_size") % 3 + 1).cast("string")).alias("ctMult"), F.when(_mod(k, 11), "X").otherwise(base).alias("ctValCcy"),
        F.lit("0.1").alias("tickSz"), F.when(_mod(k, 13), "-1").otherwise("1").alias("lotSz"),
    )
    payloads = table(spark, sf_dir, "part").groupBy("p_size").agg(F.to_json(F.struct(F.lit("0").alias("code"), empty.alias("msg"), F.collect_list(item).alias("data"))).alias("payload"))
    found = okx.instruments(payloads, "perpetual")
    return found.select("p_size", "exchange_symbol", "base_asset", "quote_asset", (F.col("contract_multiplier") * 1000).cast("int").alias("multiplier_thousandths"), _broken())


@_query(
    "wire_funding_history",
    f"WITH {_EV}, {_K} SELECT event_id, ms - ms % 3600000 AS hour_ms, CASE WHEN k % 5 > 0 AND k % 7 > 0 AND (instrument_id % 2 = 1 OR k % 11 > 0) AND k % 13 > 0 THEN k % 90 + 10 END AS rate_e4, "
    "CASE WHEN k % 13 = 0 AND k % 5 > 0 AND k % 7 > 0 AND (instrument_id % 2 = 1 OR k % 11 > 0) THEN 'rate' ELSE '' END AS broken FROM k",
)
def wire_funding_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories of both exchanges: the row asked for stands second, after one a millisecond later."""
    rows = _keyed(spark, sf_dir).withColumn("funding_time", F.timestamp_millis("ms"))
    good = F.concat(F.lit("0.00"), (F.col("k") % 90 + 10).cast("string"))
    symbol = F.when(_each(7), "OTHER").otherwise(F.col("exchange_symbol"))
    at = F.col("ms") + F.when(_each(5), 2).otherwise(0)

    def history(name: str, rate: str, number: str, empty: Column) -> Column:
        value = F.when(empty, "").when(_each(13), "a tenth").otherwise(good)
        return F.array(*(F.struct(symbol.alias(name), t.cast(number).alias("fundingTime"), v.alias(rate)) for t, v in ((F.col("ms") + 1, F.lit("0.0001")), (at, value))))

    keep = ["event_id", "instrument_id", "exchange_symbol", "funding_time"]
    ours = rows.where("instrument_id % 2 = 1").select(*keep, F.to_json(history("symbol", "fundingRate", "long", F.lit(False))).alias("payload"))
    theirs = rows.where("instrument_id % 2 = 0").select(
        *keep, F.to_json(F.struct(F.lit("0").alias("code"), history("instId", "realizedRate", "string", _each(11)).alias("data"))).alias("payload")
    )
    found = binance.funding_history(ours).unionByName(okx.funding_history(theirs))
    return found.select("event_id", F.unix_millis("hour_time").alias("hour_ms"), (F.col("rate") * 10000).cast("long").alias("rate_e4"), _broken())


def _perpetuals(rows: DataFrame) -> DataFrame:
    return rows.select("instrument_id", "exchange_symbol").distinct().withColumn("market_type", F.when(F.col("instrument_id") == 5, "spot").otherwise("perpetual"))


@_query(
    "wire_binance_estimates",
    f"WITH {_EV}, {_K} SELECT event_id, CASE WHEN k % 13 > 0 AND instrument_id <> 5 THEN instrument_id END AS id, CASE WHEN k % 23 = 0 THEN 0 ELSE ms + 60000 END AS funding_ms, "
    "CASE WHEN k % 19 > 0 THEN k % 90 + 10 END AS rate_e4, ms AS source_ms, concat_ws(',', CASE WHEN k % 11 = 0 THEN 'event' END, CASE WHEN k % 23 = 0 THEN 'funding_time' END, "
    "CASE WHEN k % 13 = 0 OR instrument_id = 5 THEN 'symbol' END, CASE WHEN k % 19 = 0 THEN 'rate' END) AS broken FROM k WHERE k % 17 > 0",
)
def wire_binance_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _keyed(spark, sf_dir)
    good = F.concat(F.lit("0.00"), (F.col("k") % 90 + 10).cast("string"))
    body = F.to_json(F.struct(
        F.when(_each(11), "trade").otherwise("markPriceUpdate").alias("e"), F.col("ms").alias("E"), F.when(_each(13), "OTHER").otherwise(F.col("exchange_symbol")).alias("s"),
        F.when(_each(19), "1e-4").otherwise(good).alias("r"), F.when(_each(23), 0).otherwise(F.col("ms") + 60000).alias("T"),
    ))
    payloads = rows.select("event_id", F.when(_each(17), '{"result":null,"id":1}').otherwise(body).alias("payload"))
    found = binance.mark_prices(payloads, _perpetuals(rows))
    return found.select("event_id", F.col("instrument_id").alias("id"), F.unix_millis("funding_time").alias("funding_ms"), (F.col("rate") * 10000).cast("long").alias("rate_e4"), F.unix_millis("source_time").alias("source_ms"), _broken())


@_query(
    "wire_okx_estimates",
    f"WITH {_EV}, {_K}, x AS (SELECT k.*, j FROM k, range(2) r(j) WHERE k % 17 > 0 AND k % 29 > 0) "
    "SELECT event_id, j, CASE WHEN NOT (j = 1 AND k % 13 = 0) AND instrument_id <> 5 THEN instrument_id END AS id, ms + 60000 * (j + 1) AS funding_ms, k % 90 + 10 AS rate_e4, ms AS source_ms, "
    "concat_ws(',', CASE WHEN (j = 1 AND k % 13 = 0) OR instrument_id = 5 THEN 'symbol' END, CASE WHEN j = 1 AND k % 11 = 0 THEN 'kind' END) AS broken FROM x",
)
def wire_okx_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows to a message: the first falls back to the subscription's instrument, the second names its own."""
    rows = _keyed(spark, sf_dir)
    rate = F.concat(F.lit("0.00"), (F.col("k") % 90 + 10).cast("string"))
    item = lambda name, kind, minutes: F.struct(
        name.alias("instId"), kind.alias("instType"), rate.alias("fundingRate"), (F.col("ms") + 60000 * minutes).cast("string").alias("fundingTime"), F.col("ms").cast("string").alias("ts")
    )
    data = F.array(item(F.lit(""), F.lit(""), 1), item(F.when(_each(13), "OTHER").otherwise(F.col("exchange_symbol")), F.when(_each(11), "FUTURES").otherwise("SWAP"), 2))
    body = F.to_json(F.struct(F.struct(F.lit("funding-rate").alias("channel"), F.col("exchange_symbol").alias("instId")).alias("arg"), data.alias("data")))
    payloads = rows.select("event_id", F.col("ms").alias("sent"), F.when(_each(17), "pong").when(_each(29), '{"event":"subscribe","code":"0"}').otherwise(body).alias("payload"))
    found = okx.funding_updates(payloads, _perpetuals(rows))
    funding_ms = F.unix_millis("funding_time")
    return found.select(
        "event_id", (F.floor((funding_ms - F.col("sent")) / 60000) - 1).cast("long").alias("j"), F.col("instrument_id").alias("id"), funding_ms.alias("funding_ms"),
        (F.col("rate") * 10000).cast("long").alias("rate_e4"), F.unix_millis("source_time").alias("source_ms"), _broken(),
    )


@_query(
    "delta_rules",
    "WITH d AS (SELECT l_orderkey, list(l_partkey % 15) AS prices, list(CAST(l_quantity AS BIGINT) - 2) AS qtys FROM lineitem GROUP BY 1) SELECT l_orderkey, concat_ws(',', "
    "CASE WHEN l_orderkey % 64 NOT BETWEEN 1 AND 59 THEN 'second_offset' END, CASE WHEN l_orderkey % 9 = 0 THEN 'bid_lengths' END, CASE WHEN list_min(prices) <= 0 OR len(list_distinct(prices)) < len(prices) THEN 'bid_prices' END, "
    "CASE WHEN list_min(qtys) < 0 THEN 'bid_qtys' END) AS broken, concat_ws(',', CASE WHEN list_min(prices) <= 0 THEN 'positive' END, CASE WHEN len(list_distinct(prices)) < len(prices) THEN 'once' END) AS changes FROM d",
)
def delta_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(F.col("l_partkey") % 15).alias("bid_change_prices"), F.collect_list((F.col("l_quantity").cast("long") - 2).cast("decimal(20,0)")).alias("_q")
    )
    more = F.when(F.col("l_orderkey") % 9 == 0, F.array(F.lit(1).cast("decimal(20,0)"))).otherwise(F.array().cast("array<decimal(20,0)>"))
    none = F.array().cast("array<bigint>")
    rows = rows.withColumns({
        "second_offset": (F.col("l_orderkey") % 64).cast("int"), "bid_change_qtys": F.concat("_q", more), "ask_change_prices": none, "ask_change_qtys": none.cast("array<decimal(20,0)>"),
    })
    return rows.select("l_orderkey", F.concat_ws(",", validate.delta()).alias("broken"), F.concat_ws(",", validate.changes(F.col("bid_change_prices"))).alias("changes"))


@_query(
    "orphan_deltas",
    "SELECT l_orderkey AS minute_id, l_linenumber AS second_offset FROM lineitem WHERE l_orderkey % 3 = 0 OR (CAST(1 AS BIGINT) << l_linenumber) & (l_orderkey % 256) = 0",
)
def orphan_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("minute_id"), F.col("l_linenumber").alias("second_offset"))
    minutes = rows.where("minute_id % 3 > 0").select("minute_id").distinct().select(F.col("minute_id").alias("id"), (F.col("minute_id") % 256).alias("valid_bitmap"))
    return validate.orphan_deltas(minutes, rows)


@_query(
    "funding_rules",
    f"WITH {_EV}, {_K} SELECT event_id, concat_ws(',', CASE WHEN k % 5 = 0 THEN 'instrument_id' END, CASE WHEN k % 7 = 0 THEN 'hour_time' END, CASE WHEN epoch_us(ts) % 1000 > 0 AND k % 3 = 0 THEN 'funding_time' END, "
    "CASE WHEN k % 11 = 0 THEN 'rate' END) AS rate_broken, concat_ws(',', CASE WHEN k % 5 = 0 THEN 'instrument_id' END, CASE WHEN epoch_us(ts) % 1000 > 0 AND k % 3 = 0 THEN 'funding_time' END, "
    "CASE WHEN k % 13 = 0 THEN 'source_time' END, CASE WHEN k % 11 = 0 THEN 'rate' END) AS estimate_broken FROM k",
)
def funding_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.date_trunc("hour", "ts")
    rows = _keyed(spark, sf_dir).select(
        "event_id", F.when(_each(5), 0).otherwise(F.col("instrument_id")).alias("instrument_id"), F.when(_each(7), hour + F.expr("interval 1 minute")).otherwise(hour).alias("hour_time"),
        F.when(_each(3), F.col("ts")).otherwise(F.timestamp_millis("ms")).alias("funding_time"), F.when(~_each(13), F.col("ts")).alias("source_time"),
        F.when(~_each(11), F.lit("0.0001").cast(decimals.WIDE)).alias("rate"), F.lit(True).alias("is_actual"),
    )
    return rows.select("event_id", F.concat_ws(",", validate.funding_rate()).alias("rate_broken"), F.concat_ws(",", validate.funding_estimate()).alias("estimate_broken"))


@_query(
    "definition_matches",
    "SELECT p_partkey, p_partkey % 5 > 0 AND p_partkey % 7 > 0 AND p_partkey % 11 > 0 AS same FROM part",
)
def definition_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each definition against a second reading of it: equal but for a changed step, settlement or expiry; absent ones are equal."""
    k = F.col("p_partkey")

    def read(changed: bool) -> DataFrame:
        fault = lambda n: (k % n == 0) & F.lit(changed)
        settle, expiry = F.when(k % 2 == 0, "B"), F.when(k % 3 == 0, F.timestamp_seconds(F.lit(0)))
        return table(spark, sf_dir, "part").select(
            k.alias("key"), (k + int(changed)).alias("instrument_id"), F.lit("Binance").alias("exchange"), F.lit("perpetual").alias("market_type"), F.col("p_name").alias("exchange_symbol"),
            F.lit("A").alias("base_asset"), F.lit("B").alias("quote_asset"), F.when(fault(7), F.when(settle.isNull(), "B")).otherwise(settle).alias("settle_asset"),
            F.lit(1).cast(decimals.WIDE).alias("contract_multiplier"), F.lit(1).cast(decimals.WIDE).alias("price_tick_size"),
            (F.col("p_size") + F.when(fault(5), 1).otherwise(0)).cast(decimals.WIDE).alias("quantity_step_size"),
            F.when(fault(11), F.when(expiry.isNull(), F.timestamp_seconds(F.lit(5)))).otherwise(expiry).alias("expiry_time"),
        )

    a, b = read(False), read(True)
    return a.join(b, a["key"] == b["key"]).select(a["key"].alias("p_partkey"), validate.same_definition(a, b).alias("same"))


@_query(
    "store_asof",
    f"WITH {_EV}, {_HOURS}, est AS (SELECT *, (epoch_us(ts) // 28800000000) * 28800000000 + 28800000000 + CASE WHEN event_id % 2 = 1 THEN 28800000000 ELSE 0 END AS target FROM ev), "
    "st AS (SELECT instrument_id, target, max(event_id) AS event_id, epoch_us(max(ts)) AS source_us FROM est GROUP BY 1, 2), "
    "m AS (SELECT h.instrument_id, epoch_us(h.hour) AS hour_us, s.target, s.event_id, s.source_us, bool_or(s.target = epoch_us(h.hour)) OVER (PARTITION BY h.instrument_id, h.hour) AS settlement "
    "FROM hrs h JOIN st s ON s.instrument_id = h.instrument_id) SELECT instrument_id, hour_us, settlement, arg_max(event_id, event_id) AS event_id, arg_max(source_us, event_id) AS source_us, arg_max(target, event_id) AS funding_us "
    "FROM m WHERE source_us <= hour_us AND source_us >= hour_us - 14400000000 AND (NOT settlement OR target = hour_us) GROUP BY 1, 2, 3",
)
def store_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.timestamp_seconds(p.settlement() + F.when(F.col("event_id") % 2 == 1, 28800).otherwise(0))
    rows = p.events(spark, sf_dir).select(
        "instrument_id", target.alias("funding_time"), F.col("event_id").alias("rate"), F.col("ts").alias("source_time"), F.col("event_id").alias("arrival")
    )
    found = funding.at_store(funding.latest(rows), _hours(spark, sf_dir), max_age="4 hours")
    return found.select(
        "instrument_id", _us("hour").alias("hour_us"), "settlement", F.col("rate").alias("event_id"), _us("source_time").alias("source_us"), _us("funding_time").alias("funding_us")
    )
