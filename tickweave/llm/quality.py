"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import ID, held_out, in_batches, lowest

#: Documents scored below this are rejected.
KEEP = 0.7
#: Labelled rows that the trees are fitted on at most: those whose ids have the smallest hashes.
FIT_ROWS = 12_000
TREES, DEPTH, BINS, RATE, L2, LEAST_HESSIAN = 80, 4, 64, 0.15, 1.0, 2.0

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_HIGH = _BYTES >= 128
_STOP = np.isin(_BYTES, list(b".,;:?'\"()-"))
_SYMBOL = (_BYTES > 32) & (_BYTES < 127) & ~(_UPPER | _LOWER | _DIGIT | _STOP)
_CLASSES = np.stack([_UPPER, _LOWER, _DIGIT, _SPACE, _HIGH, _STOP, _SYMBOL, _BYTES == ord("|"), _BYTES == ord("!"), _BYTES == 10]).astype(np.float64)
STATISTICS = 26


def statistics(data: bytes) -> list[float]:
    """Figures of one whole text: sizes, kinds of characters, repetition of words, lines and phrases, compression.

    An empty text has zeros.  Nothing but the text goes in.
    """
    n = len(data)
    words = data.split()
    m = len(words)
    if not m:
        return [float(n > 0), np.log1p(n)] + [0.0] * (STATISTICS - 2)
    kinds = _CLASSES @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = kinds[0] + kinds[1] + 1
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, m)
    lines = [x for x in data.split(b"\n") if x.strip()]
    ids = np.fromiter(map(hash, words), np.int64, m).view(np.uint64)
    mult = np.uint64(0x9E3779B97F4A7C15)
    triples = (ids[2:] * mult + ids[1:-1]) * mult + ids[:-2] if m > 2 else ids
    tails = np.fromiter((w[-1] for w in words), np.int64, m)
    heads = np.fromiter((w[0] for w in words), np.int64, m)
    return [
        1.0, np.log1p(n), np.log1p(m), lengths.mean(), lengths.std(), lengths.max(),
        *(kinds[:7] / n), kinds[0] / letters, kinds[7] / m, kinds[8] / m, kinds[9] / n,
        len(counts) / m, max(counts.values()) / m,
        (ids[1:] == ids[:-1]).mean() if m > 1 else 0.0,
        len(np.unique(triples)) / len(triples),
        len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        _SYMBOL[tails].mean(), _UPPER[heads].mean(),
        len(zlib.compress(data, 1)) / (n + 20),
    ]


def _matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([statistics(x or b"") for x in texts], np.float32).reshape(-1, STATISTICS)


@dataclass
class Trees:
    """Complete trees flattened level by level: node i has children 2i+1 and 2i+2."""

    feature: np.ndarray
    split: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1; all rows walk down one level of one tree at a time."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, split, leaf in zip(self.feature, self.split, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > split[at])
            total += leaf[at - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Newton boosting of the logistic loss on binned features.

    Without rows, or with one label alone, the trees are empty and the base
    score is the share of label 1 (a half without rows), smoothed by one row.
    """
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    nodes = 2**depth - 1
    model = Trees(np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf, np.float32), np.zeros((trees, nodes + 1)), base)
    if len(y) == 0 or y.min() == y.max():
        return model
    d = x.shape[1]
    edges = np.stack([np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32) for j in range(d)])
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)], axis=1)
    flat = binned + np.arange(d) * bins
    total = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            slot = ((at - first)[:, None] * (d * bins) + flat).ravel()
            size = width * d * bins
            gs = np.bincount(slot, np.repeat(g, d), size).reshape(width, d, bins).cumsum(2)
            hs = np.bincount(slot, np.repeat(h, d), size).reshape(width, d, bins).cumsum(2)
            ga, ha = gs[:, :1, -1:], hs[:, :1, -1:]
            gain = gs**2 / (hs + L2) + (ga - gs) ** 2 / (ha - hs + L2) - ga**2 / (ha + L2)
            gain[(hs < LEAST_HESSIAN) | (ha - hs < LEAST_HESSIAN)] = 0
            gain = gain[:, :, :-1].reshape(width, -1)
            best = gain.argmax(1)
            for k in range(width):
                if gain[k, best[k]] > 1e-6:
                    j, b = divmod(int(best[k]), bins - 1)
                    model.feature[t, first + k], model.split[t, first + k] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), model.feature[t, at]] > model.split[t, at])
        leaf = at - nodes
        gs, hs = np.bincount(leaf, g, nodes + 1), np.bincount(leaf, h, nodes + 1)
        model.leaf[t] = -RATE * gs / (hs + L2)
        total += model.leaf[t][leaf]
    return model


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, rows: int = FIT_ROWS) -> Trees:
    """Fits the trees on at most ``rows`` labelled documents that are not held out.

    Which rows: those with the smallest hashes of their ids.  A row with more
    than one label counts as 1 if any is; rows without an id or a label teach
    nothing.  Statistics are taken where the texts are; only they come to the
    driver, ``rows`` times 26 numbers at most.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"), modulus, remainder))
    sample = lowest(known.groupBy("doc_id").agg(F.max("quality").alias("label")), rows, "doc_id")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id")
    schema = T.StructType([ID, T.StructField("x", T.ArrayType(T.FloatType())), T.StructField("y", T.IntegerType())])

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column("text").to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, STATISTICS), pa.int32()), pa.array(x.ravel()))
        return pa.record_batch([batch.column("doc_id"), lists, batch.column("label").cast(pa.int32())], ["doc_id", "x", "y"])

    found = texts.mapInArrow(in_batches(measure), schema).groupBy("doc_id").agg(F.min("x").alias("x"), F.max("y").alias("y"))
    got = found.orderBy("doc_id").toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, STATISTICS)
    return fit(x, got.column("y").to_numpy().astype(np.float64))


def score(docs: DataFrame, model: Trees) -> DataFrame:
    """Rows (doc_id, score) for every document; null texts count as empty, repeated rows are scored each."""
    schema = T.StructType([ID, T.StructField("score", T.DoubleType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column("doc_id"), pa.array(model.score(_matrix(batch.column("text").to_pylist())))], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(in_batches(run), schema)


def keep(docs: DataFrame, model: Trees, threshold: float = KEEP) -> DataFrame:
    """The documents that score at least ``threshold``, with their own columns, whatever these are called."""
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).cast(pa.binary()).to_pylist()
        return batch.filter(pa.array(model.score(_matrix(texts)) >= threshold))

    return docs.mapInArrow(in_batches(run), docs.schema)
