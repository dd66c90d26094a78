"""OKX payloads as rows: strict, each with the rules that it breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions import decimals
from tickweave.operators.validate import VIOLATIONS, codes
from tickweave.sources.binance import field, funding_history as _history, levels, texts, whole

_INFO = (
    "struct<code:string,msg:string,data:array<struct<instType:string,instId:string,state:string,baseCcy:string,quoteCcy:string,settleCcy:string,"
    "ctType:string,ctVal:string,ctMult:string,ctValCcy:string,tickSz:string,lotSz:string>>>"
)


def instruments(df: DataFrame, market: str) -> DataFrame:
    """Live instruments: all of spot, or linear swaps that settle in USDT, whose multiplier is contract value times multiplier."""
    swap = market == "perpetual"
    parsed = df.withColumn("_j", F.from_json("payload", _INFO))
    bad = ~F.coalesce(F.col("_j.code") == "0", F.lit(False)) | F.col("_j.data").isNull()
    rows = parsed.select(*df.drop("payload").columns, bad.alias("_bad"), F.explode_outer("_j.data").alias("d"))
    live = F.col("d.state") == "live"
    if swap:
        live = live & (F.col("d.instType") == "SWAP") & (F.col("d.ctType") == "linear") & (F.col("d.settleCcy") == "USDT")
    rows = rows.where(F.col("_bad") | live)
    part = lambda k: F.get(F.split(F.col("d.instId"), "-"), F.lit(k))
    base = F.coalesce(F.nullif(F.col("d.baseCcy"), F.lit("")), part(0)) if swap else F.col("d.baseCcy")
    quote = F.coalesce(F.nullif(F.col("d.quoteCcy"), F.lit("")), part(1)) if swap else F.col("d.quoteCcy")
    named = F.concat_ws("-", part(0), part(1), F.lit("SWAP")) if swap else F.concat_ws("-", base, quote)
    value, times = decimals.positive(F.col("d.ctVal")), decimals.positive(F.col("d.ctMult"))
    scale = decimals.written_scale(F.col("d.ctVal")) + decimals.written_scale(F.col("d.ctMult"))
    product = F.when(scale <= decimals.SCALE, value.cast("decimal(19,9)") * times.cast("decimal(19,9)")).cast(decimals.WIDE)
    counted = rows.groupBy(F.col("d.instId").alias("_symbol")).agg(F.count(F.lit(1)).alias("_times"))
    rows = rows.join(counted, rows["d.instId"].eqNullSafe(counted["_symbol"]))
    multiplier = product if swap else F.lit(1).cast(decimals.WIDE)
    tick, step = decimals.positive(F.col("d.tickSz")), decimals.positive(F.col("d.lotSz"))
    return rows.select(
        *df.drop("payload").columns,
        F.lit("OKX").alias("exchange"), F.lit(market).alias("market_type"), F.col("d.instId").alias("exchange_symbol"), base.alias("base_asset"),
        quote.alias("quote_asset"), (F.col("d.settleCcy") if swap else F.lit(None).cast("string")).alias("settle_asset"), multiplier.alias("contract_multiplier"),
        tick.alias("price_tick_size"), step.alias("quantity_step_size"), F.lit(None).cast("timestamp").alias("expiry_time"),
        codes(
            code=F.col("_bad"), name=~F.coalesce(F.col("d.instId") == named, F.lit(False)), contract=multiplier.isNull(),
            contract_asset=F.lit(swap) & ~F.coalesce(F.col("d.ctValCcy") == base, F.lit(False)), tick_size=tick.isNull(), step_size=step.isNull(),
            twice=F.col("_times") != 1,
        ).alias(VIOLATIONS),
    )


def depth(df: DataFrame) -> DataFrame:
    """Messages of the books channel; ``df`` also has exchange_symbol and the steps.  Pongs and subscription notices are left out."""
    item = "$.data[0]"
    rows = texts(control(df)[0], action="$.action", channel="$.arg.channel", inst="$.arg.instId", item=item, second="$.data[1]", sequence=f"{item}.seqId", stamp=f"{item}.ts", before=f"{item}.prevSeqId")
    rows = levels(rows, {side: f"{item}.{side}" for side in ("bids", "asks")}, zero=True, width=4)
    rows = rows.withColumns({"_sequence": whole(F.col("_sequence")), "_stamp": whole(F.col("_stamp")), "_before": F.col("_before").try_cast("long"), "_snapshot": F.coalesce(F.col("_action") == "snapshot", F.lit(False))})
    first, snapshot, sequence, stamp, before = (F.col(x) for x in ("_action", "_snapshot", "_sequence", "_stamp", "_before"))

    def good(side: str) -> Column:
        tails = F.forall(f"_{side}_rows", lambda x: (F.get(x, F.lit(2)) == "0") & F.get(x, F.lit(3)).rlike("^[0-9]+$"))
        filled = ~snapshot | ((F.size(side) > 0) & F.forall(side, lambda x: x["qty"] > 0))
        return F.col(f"_{side}_good") & F.coalesce(tails & filled, F.lit(False))

    return rows.select(
        *df.drop("payload").columns, first.alias("kind"), F.lit(None).cast("long").alias("first_id"), sequence.alias("final_id"), before.alias("prev_id"),
        F.timestamp_millis(stamp).alias("source_time"), "bids", "asks",
        codes(
            channel=~F.coalesce((F.col("_channel") == "books") & (F.col("_inst") == F.col("exchange_symbol")), F.lit(False)),
            action=~F.coalesce(first.isin("snapshot", "update"), F.lit(False)),
            data=F.col("_item").isNull() | F.col("_second").isNotNull(), sequence=~(sequence >= 0),
            source_time=~F.coalesce((stamp > 0) & F.col("payload").rlike(r'"ts"\s*:\s*"[0-9]+"'), F.lit(False)),
            prev_id=~F.coalesce(F.when(snapshot, before == -1).otherwise(before >= 0), F.lit(False)), bids=~good("bids"), asks=~good("asks"),
        ).alias(VIOLATIONS),
    )


def control(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(data messages, notices that are errors): pongs and good subscription notices are in neither."""
    event = F.get_json_object("payload", "$.event")
    pong = F.coalesce(F.col("payload") == "pong", F.lit(False))
    subscribed = F.coalesce((event == "subscribe") & F.coalesce(field("$.code"), F.lit("")).isin("", "0"), F.lit(False))
    return df.where(~pong & event.isNull()), df.where(event.isNotNull() & ~subscribed)


def funding_updates(df: DataFrame, instruments: DataFrame) -> DataFrame:
    """Estimates of the funding-rate channel, many to a message; a row's instrument falls back to the subscription's."""
    rows = control(df)[0]
    kinds = "array<struct<instId:string,instType:string,fundingRate:string,fundingTime:string,ts:string>>"
    each = rows.select(*df.drop("payload").columns, field("$.arg.instId").alias("_arg"), F.explode_outer(F.from_json(field("$.data"), kinds)).alias("d"))
    each = each.withColumn("_symbol", F.coalesce(F.nullif(F.col("d.instId"), F.lit("")), F.col("_arg")))
    known = instruments.where("market_type = 'perpetual'").select(F.col("exchange_symbol").alias("_symbol"), "instrument_id")
    target, stamp = whole(F.col("d.fundingTime")), whole(F.col("d.ts"))
    return each.join(known, "_symbol", "left").select(
        *df.drop("payload").columns, "instrument_id", F.timestamp_millis(target).alias("funding_time"), decimals.strict(F.col("d.fundingRate")).alias("rate"),
        F.timestamp_millis(stamp).alias("source_time"),
        codes(
            symbol=F.col("instrument_id").isNull(), kind=~F.coalesce(F.col("d.instType"), F.lit("")).isin("", "SWAP"), funding_time=~(target > 0),
            source_time=~(stamp > 0), rate=decimals.strict(F.col("d.fundingRate")).isNull(),
        ).alias(VIOLATIONS),
    )


def funding_history(df: DataFrame) -> DataFrame:
    """Actual rates: the realised rate to the millisecond; an empty one is not found, and an estimate is never taken for it."""
    return _history(df, rate="realizedRate", path="$.data", symbol="instId")
