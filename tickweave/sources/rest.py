"""Public REST payloads as a batch source: one row for each request, fetched where its partition runs."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Answers that are asked for again; any other is an error at once.
AGAIN = frozenset({429, 500, 502, 503, 504})
ATTEMPTS, FIRST_DELAY, LONGEST_DELAY, TIMEOUT, SHOWN = 4, 0.25, 2.0, 10.0, 512

BINANCE_SPOT, BINANCE_FUTURES, OKX = "https://api.binance.com", "https://fapi.binance.com", "https://www.okx.com"


class Refused(RuntimeError):
    """A request that was answered with an error."""


def get(url: str, attempts: int = ATTEMPTS, open_: Callable = urllib.request.urlopen, wait: Callable[[float], None] = time.sleep) -> str:
    """The body of a URL; waits 250 ms, doubled up to 2 s, between attempts.  A broken connection is an error at once."""
    for k in range(attempts):
        try:
            with open_(url, timeout=TIMEOUT) as answer:
                return answer.read().decode()
        except urllib.error.HTTPError as error:
            if error.code not in AGAIN or k == attempts - 1:
                raise Refused(f"{error.code}: {error.read()[:SHOWN].decode(errors='replace')}") from error
            wait(min(FIRST_DELAY * 2**k, LONGEST_DELAY))
    raise Refused("no attempt was allowed")


def fetch(requests: DataFrame, attempts: int = ATTEMPTS, get_: Callable[[str, int], str] = get) -> DataFrame:
    """Rows of requests (column url) with their payload."""
    fields = [x for x in requests.schema.fields if x.name != "payload"]
    schema = T.StructType([*fields, T.StructField("payload", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield frame.assign(payload=[get_(url, attempts) for url in frame["url"]])[schema.names]

    return requests.mapInPandas(run, schema)


def instruments_url(exchange: str, market: str) -> str:
    if exchange == "Binance":
        return f"{BINANCE_SPOT}/api/v3/exchangeInfo" if market == "spot" else f"{BINANCE_FUTURES}/fapi/v1/exchangeInfo"
    return f"{OKX}/api/v5/public/instruments?instType={'SPOT' if market == 'spot' else 'SWAP'}"


def snapshot_url(symbol: str, market: str) -> str:
    root = f"{BINANCE_SPOT}/api/v3" if market == "spot" else f"{BINANCE_FUTURES}/fapi/v1"
    return f"{root}/depth?symbol={symbol}&limit=1000"


def funding_history_url(exchange: str, symbol: str, millis: int) -> str:
    """One attempt is made for these; 100 settlements of OKX always cover a day of hourly ones."""
    if exchange == "Binance":
        return f"{BINANCE_FUTURES}/fapi/v1/fundingRate?symbol={symbol}&startTime={millis}&endTime={millis + 1}&limit=10"
    return f"{OKX}/api/v5/public/funding-rate-history?instId={symbol}&limit=100"


def stream_names(exchange: str, symbols: list[str], kind: str) -> list[str]:
    """Names of the public streams: depth or funding of each symbol."""
    if exchange == "Binance":
        return [f"{s.lower()}@{'depth@100ms' if kind == 'depth' else 'markPrice@1s'}" for s in symbols]
    return [f"{'books' if kind == 'depth' else 'funding-rate'}:{s}" for s in symbols]
