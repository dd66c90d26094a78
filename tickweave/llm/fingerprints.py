"""Document fingerprints from closed syncmers: anchors with their places.

A fingerprint has 64 bins.  Each holds the anchor with the least hash of its
share of the hashes: 16 bits of it and where it first stands in the text (32
bits, in bytes).  Two fingerprints are alike by the anchors that they share in
the same order.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import ID, NO_ID, in_batches

#: Bytes of a k-mer and of the inner substrings whose least must lie at an edge.
K, S = 20, 6
#: Bins of a fingerprint.
BINS = 64
#: Bytes of texts in a range, and ranges at most.
RANGE_BYTES, RANGES = 16_000_000, 20_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _A
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(31))


def syncmers(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the closed syncmers of a text's bytes.

    A k-mer is one if the least of its inner s-mers' hashes is its first or its
    last, so whether it is depends on its own bytes alone: an edit elsewhere
    moves or drops no anchor.  A text of 1 to 19 bytes is its own anchor; an
    empty text has none.
    """
    if len(data) < K:
        own = np.frombuffer(hashlib.blake2b(data, digest_size=8).digest(), np.uint64)
        return np.zeros(min(1, len(data)), np.int64), own[: min(1, len(data))]
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = len(b) - S + 1
    v = np.zeros(n, np.uint64)
    for j in range(S):
        v = (v << np.uint64(8)) | b[j : j + n]
    v = _mix(v)
    window = K - S + 1  # inner substrings of a k-mer: 15
    two = np.minimum(v[:-1], v[1:])
    four = np.minimum(two[:-2], two[2:])
    eight = np.minimum(four[:-4], four[4:])
    least = np.minimum(eight[: -(window - 8)], eight[window - 8 :])
    m = len(least)
    at = np.flatnonzero((v[:m] == least) | (v[window - 1 : window - 1 + m] == least))
    h = v[at]
    for j in (6, 12, 14):  # with the first, these cover the k-mer
        h = _mix(h ^ v[at + j] * _B)
    return at, h


def sketch(at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Of each bin the least hash as a number from 1 to 65535 and its first position; 0 and 0 where a bin is empty."""
    out = np.zeros((2, BINS), np.int64)
    if len(hashes):
        order = np.argsort(hashes, kind="stable")
        h = hashes[order]
        bins = (h >> np.uint64(58)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(bins)) + 1])
        out[0, bins[first]] = (_mix(h[first]) % np.uint64(65535) + np.uint64(1)).astype(np.int64)
        out[1, bins[first]] = np.minimum(at[order[first]], 2**32 - 1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the bins filled in either sketch whose anchors are equal and in the same order; 1 for two empty ones.

    What is put in or left out between anchors moves them but keeps their
    order, so the longest run of shared anchors that ascends in both texts
    counts; equal hashes that stand elsewhere by chance don't.
    """
    filled = int(((a[0] > 0) | (b[0] > 0)).sum())
    if not filled:
        return 1.0
    shared = np.flatnonzero((a[0] == b[0]) & (a[0] > 0))
    tails: list[int] = []
    for x in b[1][shared[np.lexsort((-b[1][shared], a[1][shared]))]].tolist():
        k = bisect.bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return len(tails) / filled


def written_out(x: np.ndarray) -> str:
    """Four hex digits of hash and eight of position for each bin."""
    return np.concatenate([x[0].astype(">u2").view(np.uint8).reshape(-1, 2), x[1].astype(">u4").view(np.uint8).reshape(-1, 4)], axis=1).tobytes().hex()


def anchors(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, position, hash) of every document's closed syncmers, position in bytes; null texts have none."""
    schema = T.StructType([ID, T.StructField("position", T.LongType()), T.StructField("hash", T.LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id")
        found = [syncmers(x or b"") for x in batch.column("text").to_pylist()]
        sizes = np.array([len(p) for p, _ in found])
        take = pa.array(np.repeat(np.arange(len(found)), sizes))
        at = np.concatenate([p for p, _ in found])
        h = np.concatenate([x for _, x in found]).view(np.int64)
        return pa.record_batch([ids.take(take), pa.array(at), pa.array(h)], schema.names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(in_batches(run), schema)


def shared_anchors(left: DataFrame, right: DataFrame) -> DataFrame:
    """Anchors that two sets of documents share at the same distance from each other: rows (left_id, right_id, shift, anchors).

    For positional matching: hashes that occur once in a document are joined
    and counted by shift.  Meant for a stated set of documents on one side.
    """
    once = lambda df: df.groupBy("doc_id", "hash").agg(F.min("position").alias("position"), F.count(F.lit(1)).alias("n")).where("n = 1")
    a = once(anchors(left)).select(F.col("doc_id").alias("left_id"), "hash", F.col("position").alias("p"))
    b = once(anchors(right)).select(F.col("doc_id").alias("right_id"), "hash", F.col("position").alias("q"))
    return a.join(b, "hash").groupBy("left_id", "right_id", (F.col("q") - F.col("p")).alias("shift")).agg(F.count(F.lit(1)).alias("anchors"))


FIELDS = T.StructType(
    [
        ID,
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("n_anchors", T.LongType()),
    ]
)


def _compare(pairs: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    rows, known = [], {}
    for doc_id, text, after in pairs:
        half = len(text) // 2
        edited = (text[: len(text) - half] + after[:half]).encode()
        own = known.get("own") if known.get("text") is text else None
        if own is None:
            own = syncmers(text.encode())
        following = syncmers(after.encode())
        known = {"text": after, "own": following}
        a, b, c = sketch(*own), sketch(*syncmers(edited)), sketch(*following)
        rows.append((doc_id, len(text), hashlib.sha256(edited).hexdigest(), written_out(a), written_out(b), likeness(a, b), likeness(a, c), len(own[0])))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], FIELDS.names)


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row in order with the next one's text; rows that only lend their text are the last of their range."""
    held: tuple[int, int | None, str] | None = None
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            pairs = []
            for part, lent, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "lent", "doc_id", "text")), strict=True):
                if held is not None:
                    pairs.append((*held[1:], text))
                held = None if lent else (part, doc_id, text)
            if pairs:
                yield _compare(pairs)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness; see FIELDS.

    The edited text has its second half replaced by the start of the next
    document in ascending doc_id, the first following the last.  Ids are dealt
    into ranges of about ``RANGE_BYTES``; each range also gets a copy of the
    next one's first row, so the texts are shuffled once and sorted where they
    are, and no range waits for another.

    Null texts count as empty.  Rows without an id come last; rows that repeat
    an id follow each other by a hash of their text; a single row follows
    itself; no rows give no rows.  Empty texts have a fingerprint of zeros and
    are like each other.
    """
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(NO_ID))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    if total is None:
        return spark.createDataFrame([], FIELDS)
    parts = int(min(max(1, -(-total // RANGE_BYTES)), RANGES))
    cuts = docs.select(key.alias("k")).approxQuantile("k", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bounds = np.unique(np.array(cuts, np.float64))

    @F.pandas_udf("long")
    def part_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.to_numpy().astype(np.float64), side="right"))

    firsts = docs.select(key.alias("k")).withColumn("part", part_of("k")).groupBy("part").agg(F.min("k").alias("k"))
    heads = sorted((x.part, x.k) for x in firsts.collect())
    lends = spark.createDataFrame([(heads[i - 1][0], k) for i, (_, k) in enumerate(heads)], "_part long, k long")
    placed = rows.withColumn("part", part_of(key)).withColumn("k", key).withColumn("h", F.xxhash64("text"))
    first = F.min_by(F.struct("doc_id", "text"), "h").alias("row"), F.min("h").alias("h")
    lent = placed.join(F.broadcast(lends), "k").groupBy("_part", "k").agg(*first).select("_part", "k", "h", "row.*")
    both = placed.select("part", F.lit(False).alias("lent"), "k", "h", "doc_id", "text").unionByName(
        lent.select(F.col("_part").alias("part"), F.lit(True).alias("lent"), "k", "h", "doc_id", "text")
    )
    dealt = both.repartitionById(parts, F.col("part").cast("int"))  # hashed numbers of ranges would collide and leave tasks without any
    return dealt.sortWithinPartitions("part", "lent", "k", "h").mapInArrow(_follow, FIELDS)
