"""Hard-negative mining by a blocked matrix product: tiles of anchors by rows, added over chunks of dimensions.

Rows are numbered in the order of their labels and cut into blocks; so are the
anchors.  Each block is kept as one panel for each chunk of dimensions, the
rows' panels in the shared folder.  A task has a block of anchors and goes
through the rows' panels one after the other: partial tiles of a cell are added
over its chunks and reduced at once to what an anchor can need of them, so no
score is written or shuffled.  As blocks follow the labels, positives lie in few
panels; these come first, and with the windows that the positives set all that
hold other labels follow, so nearly every score is made once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import NO_ID, RANGES, cut, own_dir, ranked, store_of, written
from tickweave.llm.vectors import matrix, padded, usable, whole

POSITIVES, NEGATIVES = 5, 3
#: Rows and anchors of a block at most, anchors of a strip, and dimensions of a chunk at least; a vector has at most ``CHUNKS`` chunks.
ROWS, ANCHORS, STRIP, DIMS, CHUNKS = 4096, 2048, 256, 32, 16
#: Bytes of a panel of all dimensions at most, and of a row group of panels, about.
PANEL_BYTES, GROUP_BYTES = 1 << 26, 1 << 24
_LEAST = -(2**63)

_kind = {"long": T.LongType(), "int": T.IntegerType(), "binary": T.BinaryType()}


def _schema(fields: str) -> T.StructType:
    return T.StructType([T.StructField(n, _kind[t]) for n, t in (f.split() for f in fields.split(", "))])


PANEL = _schema("block long, chunk int, lo long, hi long, ids binary, labels binary, rows binary, x binary")
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _table(schema: T.StructType, columns: list) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.table([c if isinstance(c, pa.Array) else pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, schema.fields, strict=True)], schema.names)


def panels(rows: DataFrame, size: int, width: int, dims: int, blocks: int) -> DataFrame:
    """Rows (row, label, vec_id, x) as panels of ``size`` rows in the order of labels, one for each chunk of dimensions.

    In a panel rows lie in ascending ``vec_id`` (those without one last), so of equal scores the first comes first.
    Neighbouring blocks, of ``blocks``, lie side by side.
    """
    order = ranked(cut(rows.select("row", "label", F.lit(0).alias("all"), F.lit(0).cast("long").alias("weight"))), "all", ["label", "row"], "weight")
    placed = rows.join(order.select("row", F.floor((F.col("rank") - 1) / size).alias("block")), "row").select("block", "row", "label", "vec_id", "x")

    def pack(table: pa.Table) -> pa.Table:
        ids, row, label = (table.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        at = np.lexsort((row, ids))
        x = matrix(table.column("x").combine_chunks(), width)[at]
        out = []
        for k, start in enumerate(range(0, width, dims)):
            held = [ids[at].tobytes(), label[at].tobytes(), row[at].tobytes()] if k == 0 else [None] * 3
            out.append([table.column("block")[0].as_py(), k, int(label.min()), int(label.max()), *held, np.ascontiguousarray(x[:, start : start + dims]).tobytes()])
        return _table(PANEL, list(zip(*out, strict=True)))

    return placed.repartitionByRange(max(1, min(-(-blocks // 16), RANGES)), "block").groupBy("block").applyInArrow(pack, PANEL)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed in 64-bit integers: by way of doubles where these are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _ints(x: bytes | None) -> np.ndarray:
    return np.frombuffer(x or b"", np.int64)


def best(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores among some positions in ascending order, the first of equal ones first."""
    if len(among) > k:
        own = scores[among]
        among = among[own >= np.partition(own, len(own) - k)[len(own) - k]]
    return among[np.argsort(-scores[among], kind="stable")][:k]


@dataclass
class Panels:
    """The rows' panels in the shared folder, ``count`` of them; a task that can't read them all fails."""

    folder: str
    count: int

    def over(self, wanted: Callable[[int, int], bool]) -> Iterator[Panel]:
        """Each block between whose lowest and highest label something is wanted; blocks are read one row group at a time."""
        store, base = store_of(self.folder)
        seen = 0
        for info in sorted(store.get_file_info(pafs.FileSelector(base)), key=lambda x: x.path):
            if not info.path.endswith(".parquet"):
                continue
            with store.open_input_file(info.path) as opened:
                file = pq.ParquetFile(opened)
                seen += file.metadata.num_rows
                held: list[dict] = []  # chunks of one block may lie in two row groups
                for g in range(file.num_row_groups):
                    spans = file.read_row_group(g, columns=["lo", "hi"]).to_pylist()
                    if not any(wanted(x["lo"], x["hi"]) for x in spans):
                        continue
                    for k, x in enumerate(file.read_row_group(g).to_batches(max_chunksize=1)):
                        if wanted(spans[k]["lo"], spans[k]["hi"]):
                            row = x.to_pylist()[0]
                            if held and held[0]["block"] != row["block"]:
                                yield Panel.of(held)
                                held = []
                            held.append(row)
                if held:
                    yield Panel.of(held)
        if seen != self.count:
            raise FileNotFoundError(f"{self.folder} has {seen} of {self.count} panels here")


class Panel:
    """A block of rows: ids, labels, rows' own numbers, and a matrix for each chunk of dimensions."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, parts: list[np.ndarray]) -> None:
        self.ids, self.labels, self.rows, self.parts = ids, labels, rows, parts
        self.most = max((float(np.abs(x).max(initial=0)) for x in parts), default=0.0)
        self.narrow = [x.astype(np.float32) for x in parts] if self.most < 2**24 else []

    @classmethod
    def of(cls, chunks: list[dict]) -> Panel:
        chunks = sorted(chunks, key=lambda x: x["chunk"])
        ids, labels, rows = (_ints(chunks[0][c]) for c in ("ids", "labels", "rows"))
        return cls(ids, labels, rows, [_ints(x["x"]).reshape(len(ids), -1) for x in chunks])


def tile(a: Panel, strip: slice, b: Panel) -> np.ndarray:
    """Scores of a strip of a's rows by b's, added over the chunks: in floats where all sums are exact in them, else in 64-bit integers."""
    narrow = a.most * b.most * sum(x.shape[1] for x in a.parts) < 2**24
    out = None
    for x, y in zip(a.narrow if narrow else a.parts, b.narrow if narrow else b.parts, strict=True):
        part = x[strip] @ y.T if narrow else product(x[strip], y)
        out = part if out is None else np.add(out, part, out=out)
    return out


class Firsts:
    """For each of n places the ``count`` best (score, id, row) so far: higher scores first, then smaller ids and rows."""

    def __init__(self, n: int, count: int) -> None:
        self.count = count
        self.kept: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        #: What has to be beaten; nothing as long as there are fewer.
        self.score, self.id, self.row = np.full(n, _LEAST), np.full(n, NO_ID), np.full(n, NO_ID)

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scores at places; the places ascend, and ids at a place do."""
        beats = (ids < self.id[at]) | (ids == self.id[at]) & (rows < self.row[at])
        use = np.flatnonzero((score > self.score[at]) | (score == self.score[at]) & beats)
        if not len(use):
            return
        at = at[use]
        begins = np.flatnonzero(np.diff(at, prepend=-1))
        for a, b in zip(begins, np.append(begins[1:], len(at)), strict=True):
            t = int(at[a])
            mine = use[a:b]
            mine = mine[best(score[mine], np.arange(len(mine)), self.count)]
            more = [(-int(s), int(i), int(r)) for s, i, r in zip(score[mine], ids[mine], rows[mine], strict=True)]
            self.kept[t] = sorted(self.kept[t] + more)[: self.count]
            if len(self.kept[t]) == self.count:
                last = self.kept[t][-1]
                self.score[t], self.id[t], self.row[t] = -last[0], last[1], last[2]


def _between(scores: np.ndarray, least: np.ndarray, most: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all cells whose score is not below an anchor's ``least`` or above its ``most``, in order."""
    if scores.dtype == np.float32:  # such scores are less than 2**24, so limits beyond it may be that
        least, most = (None if x is None else np.clip(x, -(2**24), 2**24).astype(np.float32) for x in (least, most))
    hit = scores >= least[:, None]
    if most is not None:
        hit &= scores <= most[:, None]
    at = np.flatnonzero(hit.ravel())
    return at // scores.shape[1], at % scores.shape[1], scores.ravel()[at].astype(np.int64)


def mined(a: Panel, rows: Panels, positives: int, negatives: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """All rows of the result for a block of anchors: its positives, and with their windows its negatives."""
    n, lo, hi = len(a.ids), int(a.labels.min()), int(a.labels.max())
    strips = [slice(s, min(s + STRIP, n)) for s in range(0, n, STRIP)]
    good = Firsts(n, positives)
    for b in rows.over(lambda x, y: x <= hi and y >= lo):
        for strip in strips:
            t, q, score = _between(tile(a, strip, b), good.score[strip], None)
            t = t + strip.start
            own = np.flatnonzero((a.labels[t] == b.labels[q]) & (a.rows[t] != b.rows[q]))
            good.add(t[own], score[own], b.ids[q[own]], b.rows[q[own]])
    # 50 p <= 100 s <= 95 p; a slot without a positive has an empty window
    windows = np.array([[(-(s // 2), 95 * -s // 100) for s, _, _ in kept] + [(2**62, _LEAST)] * (positives - len(kept)) for kept in good.kept]).reshape(n, positives, 2)
    slots = [Firsts(n, negatives) for _ in range(positives)]
    for b in rows.over(lambda x, y: not lo == hi == x == y):
        for strip in strips:
            need = np.min([np.maximum(f.score[strip], windows[strip, k, 0]) for k, f in enumerate(slots)], axis=0)
            t, q, score = _between(tile(a, strip, b), need, windows[strip, :, 1].max(axis=1))
            t = t + strip.start
            other = np.flatnonzero(a.labels[t] != b.labels[q])
            t, q, score = t[other], q[other], score[other]
            for k, found in enumerate(slots):
                use = np.flatnonzero((score >= windows[t, k, 0]) & (score <= windows[t, k, 1]) & (score >= found.score[t]))
                found.add(t[use], score[use], b.ids[q[use]], b.rows[q[use]])
    known = lambda x: None if x == NO_ID else x
    for t in range(n):
        for (p, positive_id, _), found in zip(good.kept[t], slots, strict=False):
            for rank, (s, vec_id, _) in enumerate(found.kept[t], 1):
                yield int(a.ids[t]), known(positive_id), rank, known(vec_id), -p, -s


def _miner(rows: Panels, positives: int, negatives: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kinds = pa.schema([(n, pa.int32() if n == "rank" else pa.int64()) for n in (f.split()[0] for f in FOUND.split(", "))])

    def out(chunks: list[dict]) -> Iterator[pa.RecordBatch]:
        found = list(mined(Panel.of(chunks), rows, positives, negatives))
        if found:
            yield from pa.table([list(c) for c in zip(*found, strict=True)], schema=kinds).to_batches(max_chunksize=10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["block"] != row["block"]:
                    yield from out(held)
                    held = []
                held.append(row)
        if held:
            yield from out(held)

    return run


def mine(df: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, rows: int = ROWS, anchors: int = ANCHORS, dims: int = DIMS) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows (vec_id, embedding, label), the label a whole number,
    whose vec_id is divisible by ``every``; all rows are searched.  Rows with a null label, a null vector or
    a null or non-finite component take no part; a vector that is shorter than
    the longest counts as if it ended in zeros.  A row's score is its integer
    inner product with the anchor.  Rows that repeat a vec_id are rows of their
    own, other than the anchor too; rows without an id come last among equal
    scores and are no anchors.  Scores so large that 100 times one would not
    fit 64 bits are refused.  No anchors, or no rows of another label within
    the windows, give no rows.
    """
    spark = df.sparkSession
    parts = usable(df.where(F.col("label").isNotNull())).select(
        F.monotonically_increasing_id().alias("row"), F.col("label").cast("long").alias("label"), F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), whole().alias("x")
    )
    base = written(parts, "vectors")
    asked = (F.col("vec_id") % every == 0) & (F.col("vec_id") != NO_ID)
    largest = F.max(F.greatest(F.array_max("x"), -F.array_min("x")))
    total, seeking, width, most = base.agg(F.count(F.lit(1)), F.count_if(asked), F.max(F.size("x")), largest).first()
    if not seeking or not width:
        return spark.createDataFrame([], FOUND)
    if 100 * width * most * most >= 2**63:
        raise ValueError("components are too large for scores of 64 bits")
    base = base.withColumn("x", padded("x", width))
    dims, rows = max(dims, -(-width // CHUNKS)), min(rows, max(STRIP, PANEL_BYTES // (8 * width)))
    anchors = min(anchors, max(64, -(-seeking // (2 * spark.sparkContext.defaultParallelism))))
    chunks, n_rows, n_anchors = -(-width // dims), -(-total // rows), -(-seeking // anchors)
    right = f"{own_dir(spark)}/rows-{uuid.uuid4().hex}"
    panels(base, rows, width, dims, n_rows).write.options(**{"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1}).parquet(right)
    left = written(panels(base.where(asked), anchors, width, dims, n_anchors), "anchors").repartitionById(n_anchors, F.col("block").cast("int")).sortWithinPartitions("block", "chunk")
    return left.mapInArrow(_miner(Panels(right, n_rows * chunks), positives, negatives), FOUND)


def sql() -> str:
    """``mine`` of the table embeddings in DuckDB, with the query's labels."""
    return (
        "WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x FROM embeddings "
        "WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0), "
        "s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id), "
        "p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE own = label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5) "
        "SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id) "
        "WHERE label <> p.own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score "
        "WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3"
    )
