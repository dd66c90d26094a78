"""Schemas, limits and DDL of the stored tables."""

from __future__ import annotations

import re

from pyspark.sql import types as T

#: Levels sampled per side.
DEPTH = 50
RETAINED = {"Binance": 1000, "OKX": 400}
SIDES = ("bid", "ask")
WIDE = T.DecimalType(38, 18)
LOT = T.DecimalType(20, 0)
_f = T.StructField

INSTRUMENT = T.StructType(
    [
        _f("instrument_id", T.LongType()), _f("exchange", T.StringType()), _f("market_type", T.StringType()), _f("exchange_symbol", T.StringType()),
        _f("base_asset", T.StringType()), _f("quote_asset", T.StringType()), _f("settle_asset", T.StringType()),
        _f("contract_multiplier", WIDE), _f("price_tick_size", WIDE), _f("quantity_step_size", WIDE), _f("expiry_time", T.TimestampType()),
    ]
)
DEFINITION = [x.name for x in INSTRUMENT if x.name != "instrument_id"]

MINUTE = T.StructType(
    [_f("id", T.LongType()), _f("instrument_id", T.LongType()), _f("minute_time", T.TimestampType()), _f("valid_bitmap", T.LongType())]
    + [_f(f"{s}_{n}", T.ArrayType(k)) for s in SIDES for n, k in (("prices", T.LongType()), ("qtys", LOT))]
)
DELTA = T.StructType(
    [_f("minute_id", T.LongType()), _f("second_offset", T.IntegerType())]
    + [_f(f"{s}_change_{n}", T.ArrayType(k)) for s in SIDES for n, k in (("prices", T.LongType()), ("qtys", LOT))]
)
FUNDING = T.StructType(
    [_f("instrument_id", T.LongType()), _f("hour_time", T.TimestampType()), _f("funding_time", T.TimestampType()), _f("rate", WIDE), _f("is_actual", T.BooleanType())]
)
ESTIMATE = T.StructType([_f("instrument_id", T.LongType()), _f("funding_time", T.TimestampType()), _f("rate", WIDE), _f("source_time", T.TimestampType())])
LEVELS = T.ArrayType(T.StructType([_f("price", T.LongType()), _f("qty", LOT)]))
BOOK_EVENT = T.StructType(
    [
        _f("instrument_id", T.LongType()), _f("exchange", T.StringType()), _f("market_type", T.StringType()), _f("conn_id", T.LongType()), _f("arrival_seq", T.LongType()),
        _f("arrival_time", T.TimestampType()), _f("kind", T.StringType()), _f("first_id", T.LongType()), _f("final_id", T.LongType()),
        _f("prev_id", T.LongType()), _f("source_time", T.TimestampType()), _f("bids", LEVELS), _f("asks", LEVELS),
    ]
)

#: Minutes that broke a rule, whole, as text.
QUARANTINE = T.StructType([_f("minute_id", T.LongType()), _f("rules", T.ArrayType(T.StringType())), _f("minute", T.StringType()), _f("deltas", T.StringType())])

TABLES = {
    "instrument": INSTRUMENT, "order_book_minute": MINUTE, "order_book_second_delta": DELTA, "funding_rate_hourly": FUNDING, "minute_quarantine": QUARANTINE,
}
#: Sort key of each table: the newest row of a key is the one that counts.
KEYS = {
    "instrument": ["instrument_id"],
    "order_book_minute": ["instrument_id", "minute_time"],
    "order_book_second_delta": ["minute_id", "second_offset"],
    "funding_rate_hourly": ["instrument_id", "hour_time"],
    "minute_quarantine": ["minute_id"],
}
#: What each table's month partition is taken from; instruments have none.
MONTH_OF = {
    "order_book_minute": "minute_time",
    "order_book_second_delta": "timestamp_seconds(shiftright(minute_id, 32) * 60)",
    "funding_rate_hourly": "hour_time",
}


def minute_columns() -> list[str]:
    """The 204 columns of the wide minute: four of the header, then price and quantity of 50 levels, bids first."""
    levels = [f"{s}_{kind}_{n:02d}" for s in SIDES for n in range(1, DEPTH + 1) for kind in ("price", "qty")]
    return ["id", "instrument_id", "minute_time", "valid_bitmap", *levels]


def database_name(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"not an identifier: {name!r}")
    return name


def ddl(database: str) -> list[str]:
    """Statements that make the database and its tables; Parquet, by month, with the order of insertion in _ingest_seq."""
    name = database_name(database)
    out = [f"CREATE DATABASE IF NOT EXISTS {name}"]
    for table, schema in TABLES.items():
        columns = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in schema)
        month = " PARTITIONED BY (month)" if table in MONTH_OF else ""
        columns += ", _ingest_seq bigint" + (", month string" if month else "")
        out.append(f"CREATE TABLE IF NOT EXISTS {name}.{table} ({columns}) USING parquet{month}")
    return out
