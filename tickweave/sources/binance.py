"""Binance payloads as rows: strict, each with the rules that it breaks.

All parsers take a DataFrame with a column ``payload`` of JSON text and keep
its other columns.  A payload that breaks a rule keeps its row, with the rules
named in ``violations``, so a caller can stop the feed or set it aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions import decimals
from tickweave.operators.validate import VIOLATIONS, codes

_INFO = (
    "struct<symbols:array<struct<symbol:string,status:string,contractType:string,baseAsset:string,quoteAsset:string,marginAsset:string,"
    "filters:array<struct<filterType:string,tickSize:string,stepSize:string>>>>>"
)


def field(path: str, payload: str = "payload") -> Column:
    """One field by its path; names that differ by case alone are told apart."""
    return F.get_json_object(payload, path)


def whole(text: Column) -> Column:
    """A long of an unsigned integer's text, else null."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("long"))


def instruments(df: DataFrame, market: str) -> DataFrame:
    """Instruments of exchangeInfo that trade: all of spot, or USDT-margined perpetuals.

    Exactly one PRICE_FILTER and one LOT_SIZE each; a symbol that trades twice is a violation.
    """
    parsed = df.withColumn("_j", F.from_json("payload", _INFO))
    rows = parsed.select(*df.drop("payload").columns, F.col("_j.symbols").isNull().alias("_none"), F.explode_outer("_j.symbols").alias("s"))
    active = F.col("s.status") == "TRADING"
    if market == "perpetual":
        active = active & (F.col("s.contractType") == "PERPETUAL") & (F.col("s.marginAsset") == "USDT")
    rows = rows.where(F.col("_none") | active)
    of = lambda kind: F.filter("s.filters", lambda x: x["filterType"] == kind)
    price, lot = of("PRICE_FILTER"), of("LOT_SIZE")
    tick, step = F.get(price, F.lit(0))["tickSize"], F.get(lot, F.lit(0))["stepSize"]
    counted = rows.groupBy(F.col("s.symbol").alias("_symbol")).agg(F.count(F.lit(1)).alias("_times"))
    rows = rows.join(counted, rows["s.symbol"].eqNullSafe(counted["_symbol"]))
    return rows.select(
        *df.drop("payload").columns,
        F.lit("Binance").alias("exchange"), F.lit(market).alias("market_type"), F.col("s.symbol").alias("exchange_symbol"),
        F.col("s.baseAsset").alias("base_asset"), F.col("s.quoteAsset").alias("quote_asset"),
        (F.col("s.marginAsset") if market == "perpetual" else F.lit(None).cast("string")).alias("settle_asset"),
        F.lit(1).cast(decimals.WIDE).alias("contract_multiplier"), decimals.positive(tick).alias("price_tick_size"),
        decimals.positive(step).alias("quantity_step_size"), F.lit(None).cast("timestamp").alias("expiry_time"),
        codes(
            symbols=F.col("_none"), price_filter=F.size(price) != 1, lot_size=F.size(lot) != 1,
            tick_size=decimals.positive(tick).isNull(), step_size=decimals.positive(step).isNull(), twice=F.col("_times") != 1,
        ).alias(VIOLATIONS),
    )


def texts(df: DataFrame, **paths: str) -> DataFrame:
    """Adds columns ``_{name}`` with the text at each path; each is a column of its own so that what is made of it parses the payload once."""
    return df.withColumns({f"_{name}": field(path) for name, path in paths.items()})


def levels(df: DataFrame, sides: dict[str, str], zero: bool, width: int = 2) -> DataFrame:
    """Adds each side of a book at its path: array of (price, qty) in ticks and lots, and ``_{side}_good``, whether the rows are good.

    Rows are ``width`` quoted texts, each price once; ``df`` has the steps.  Step by step, as a
    column that is used more than once is then worked out once: text, rows of texts
    (``_{side}_rows``), decimals, ticks and lots, and their rules.
    """
    least = 0 if zero else 1
    tick, step = F.col("price_tick_size"), F.col("quantity_step_size")
    text, rows, values = ({side: f"_{side}_{x}" for side in sides} for x in ("text", "rows", "values"))
    df = texts(df, **{f"{side}_text": path for side, path in sides.items()})
    df = df.withColumns({rows[side]: F.from_json(text[side], "array<array<string>>") for side in sides})
    df = df.withColumns({values[side]: F.transform(rows[side], lambda x: F.struct(decimals.strict(F.get(x, F.lit(0))).alias("p"), decimals.strict(F.get(x, F.lit(1))).alias("q"))) for side in sides})
    df = df.withColumns({side: F.transform(values[side], lambda x: F.struct(decimals.price_tick(x["p"], tick).alias("price"), decimals.quantity_lot(x["q"], step).alias("qty"))) for side in sides})
    good = {}
    for side in sides:
        prices = F.transform(side, lambda x: x["price"])
        good[f"_{side}_good"] = F.coalesce(
            F.col(rows[side]).isNotNull()
            & F.forall(rows[side], lambda x: F.size(x) == width)
            & F.forall(side, lambda x: F.coalesce((x["price"] > 0) & (x["qty"] >= least), F.lit(False)))
            & (F.size(F.array_distinct(prices)) == F.size(side))
            & ~F.col(text[side]).rlike(r"[\[,]\s*-?[0-9]"),  # a number where a text should be
            F.lit(False),
        )
    return df.withColumns(good)


def depth_snapshots(df: DataFrame, depth: int = 1000) -> DataFrame:
    """REST snapshots; ``df`` also has instrument_id, price_tick_size, quantity_step_size and received_time."""
    rows = levels(texts(df, id="$.lastUpdateId", stamp="$.T"), {"bids": "$.bids", "asks": "$.asks"}, zero=False)
    rows = rows.withColumns({"_final": whole(F.col("_id")), "_time": whole(F.col("_stamp"))})
    return rows.select(
        *df.drop("payload").columns, F.col("_final").alias("final_id"),
        F.when(F.col("_stamp").isNull(), F.col("received_time")).otherwise(F.timestamp_millis("_time")).alias("source_time"), "bids", "asks",
        codes(
            last_update_id=~(F.col("_final") > 0), source_time=F.col("_stamp").isNotNull() & ~F.coalesce(F.col("_time") > 0, F.lit(False)),
            bids=~F.col("_bids_good") | ~F.size("bids").between(1, depth), asks=~F.col("_asks_good") | ~F.size("asks").between(1, depth),
            crossed=F.array_max(F.transform("bids", lambda x: x["price"])) >= F.array_min(F.transform("asks", lambda x: x["price"])),
        ).alias(VIOLATIONS),
    )


def depth_updates(df: DataFrame) -> DataFrame:
    """Diffs of the depth stream, in a combined-stream envelope or bare; ``df`` also has exchange_symbol, market_type and the steps."""
    body = texts(df, stream="$.stream", data="$.data").withColumn("payload", F.coalesce("_data", "payload"))
    body = texts(body, first="$.U", final="$.u", before="$.pu", event="$.e", symbol="$.s", sent="$.E", traded="$.T")
    futures = F.col("market_type") != "spot"
    rows = levels(body, {"bids": "$.b", "asks": "$.a"}, zero=True).withColumn("_stamp", F.when(futures, F.col("_traded")).otherwise(F.col("_sent")))
    rows = rows.withColumns({x: whole(F.col(x)) for x in ("_first", "_final", "_before", "_stamp")})
    first, final, before, stamp = (F.col(x) for x in ("_first", "_final", "_before", "_stamp"))
    return rows.select(
        *df.drop("payload").columns, first.alias("first_id"), final.alias("final_id"), before.alias("prev_id"),
        F.timestamp_millis(stamp).alias("source_time"), "bids", "asks",
        codes(
            stream=F.col("_stream").isNotNull() & (F.lower(F.split(F.col("_stream"), "@")[0]) != F.lower("exchange_symbol")),
            event=~F.coalesce(F.col("_event") == "depthUpdate", F.lit(False)), symbol=~F.coalesce(F.col("_symbol") == F.col("exchange_symbol"), F.lit(False)),
            ids=~((first > 0) & (first <= final)), prev_id=futures & ~F.coalesce(before > 0, F.lit(False)), source_time=~(stamp > 0),
            bids=~F.col("_bids_good"), asks=~F.col("_asks_good"),
        ).alias(VIOLATIONS),
    )


def mark_prices(df: DataFrame, instruments: DataFrame) -> DataFrame:
    """Funding estimates of markPriceUpdate messages of known perpetuals; control frames (result null) are left out."""
    rows = df.where(~F.coalesce(F.col("payload").rlike(r'"result"\s*:\s*null'), F.lit(False)))
    body = rows.withColumn("payload", F.coalesce(field("$.data"), F.col("payload"))).withColumn("_symbol", field("$.s"))
    known = instruments.where("market_type = 'perpetual'").select(F.col("exchange_symbol").alias("_symbol"), "instrument_id")
    stamp, target = whole(field("$.E")), whole(field("$.T"))
    return body.join(known, "_symbol", "left").select(
        *df.drop("payload").columns, "instrument_id", F.timestamp_millis(target).alias("funding_time"), decimals.strict(field("$.r")).alias("rate"),
        F.timestamp_millis(stamp).alias("source_time"),
        codes(
            control=field("$.result").isNotNull() | field("$.code").isNotNull(), event=~F.coalesce(field("$.e") == "markPriceUpdate", F.lit(False)),
            source_time=~(stamp > 0), funding_time=~(target > 0), symbol=F.col("instrument_id").isNull(), rate=decimals.strict(field("$.r")).isNull(),
        ).alias(VIOLATIONS),
    )


def funding_history(df: DataFrame, rate: str = "fundingRate", path: str = "$", symbol: str = "symbol") -> DataFrame:
    """Actual rates; ``df`` also has instrument_id, exchange_symbol and the funding_time asked for.

    Only a row of the same symbol and millisecond answers; without one, or
    with an empty rate, the rate is null and the settlement stays open.
    """
    rows = F.from_json(F.get_json_object("payload", path) if path != "$" else F.col("payload"), f"array<struct<{symbol}:string,fundingTime:string,{rate}:string>>")
    same = F.filter(rows, lambda x: (x[symbol] == F.col("exchange_symbol")) & (whole(x["fundingTime"]) == F.unix_millis("funding_time")))
    text = F.get(same, F.lit(0))[rate]
    return df.select(
        *df.drop("payload").columns, F.date_trunc("hour", "funding_time").alias("hour_time"), decimals.strict(F.nullif(text, F.lit(""))).alias("rate"),
        F.lit(True).alias("is_actual"),
        codes(payload=rows.isNull(), rate=F.coalesce((text != "") & decimals.strict(text).isNull(), F.lit(False))).alias(VIOLATIONS),
    )
