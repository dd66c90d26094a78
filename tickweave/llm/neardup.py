"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import ID, NO_ID, apart, components, cut, in_batches, join_hot

RADIUS = 3
SHINGLE = 3
HASH_SEED = 42
#: Rows before it that a row is compared with under a key; what a longer run leaves open goes to the whole balls.
NEAR = 64
#: Variants that a fingerprint emits, and variants in a task.
VARIANTS, TASK_ROWS = 130, 600_000

_hash = partial(xxhash.xxh64_intdigest, seed=HASH_SEED)
_PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
#: Three blocks of bits.  Of at most three differing bits at least one lies in some block, so outside it two are left at most.
_BLOCKS = (np.arange(0, 21), np.arange(21, 42), np.arange(42, 64))


def fingerprint(data: bytes, size: int = SHINGLE) -> int:
    """A bit is 1 if set in over half the shingles' hashes; no words give 0, fewer words than a shingle are one."""
    words = data.lower().split()
    if not words:
        return 0
    if len(words) < size:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(x) for x in zip(*(words[i:] for i in range(size)), strict=False)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(grams), 50_000):
        part = grams[at : at + 50_000]
        h = np.fromiter(map(_hash, part), np.uint64, len(part))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(_BITS[counts * 2 > len(grams)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, fp) for every document, fp as a signed long; null texts count as empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(x or b"", size) for x in batch.column("text").to_pylist()], np.uint64)
        return pa.record_batch([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    schema = T.StructType([ID, T.StructField("fp", T.LongType())])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(in_batches(run), schema)


def _keys(fps: np.ndarray) -> np.ndarray:
    """For each block: the bits outside it, as they are and with any one flipped; the block's number stands in its place."""
    out = []
    for number, block in enumerate(_BLOCKS):
        rest = np.delete(_BITS, block)
        mark = _BITS[block[0]] * np.uint64(number + 1)
        outside = (fps & ~_BITS[block].sum(dtype=np.uint64)) | mark
        out += [outside[:, None], outside[:, None] ^ rest[None, :]]
    return np.concatenate(out, axis=1)


def _ball_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    fps = batch.column(0).to_numpy().view(np.uint64)
    keys = _keys(fps)
    return pa.record_batch([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fps, keys.shape[1]).view(np.int64))], ["a", "b"])


def _whole_ball(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Variants with an even number of ones: within one bit of odd fingerprints, within two of even ones.

    Rows (key, role, fp): role 1 marks variants at two bits.
    """
    fps = batch.column(0).to_numpy().view(np.uint64)
    odd = (np.bitwise_count(fps) & 1).astype(bool)
    i, j = np.triu_indices(64, 1)
    parts = [
        (fps[~odd][:, None], 0, fps[~odd]),
        (fps[odd][:, None] ^ _BITS[None, :], 0, fps[odd]),
        (fps[~odd][:, None] ^ (_BITS[i] | _BITS[j])[None, :], 1, fps[~odd]),
    ]
    keys = np.concatenate([k.ravel() for k, _, _ in parts]).view(np.int64)
    roles = np.concatenate([np.full(k.size, r, np.int8) for k, r, _ in parts])
    own = np.concatenate([np.repeat(f, k.shape[1]) for k, _, f in parts]).view(np.int64)
    return pa.record_batch([pa.array(keys), pa.array(roles), pa.array(own)], ["key", "role", "fp"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few edges as join the same nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, new = np.minimum(root[u], root[v]), root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    tied = root != np.arange(len(nodes))
    return nodes[root[tied]], nodes[tied]


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])


def _collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, fp) in order: verified links, reduced to a forest for each batch, and rows (fp, fp) for what a long run leaves open."""
    keys, fps, run = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        old = len(keys)
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy()])
        if len(keys) == old:
            continue
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        if old:
            fresh[0] = False
        starts = np.where(fresh, np.arange(len(keys)), -1)
        if old:
            starts[0] = -run[0]
            starts[1:] = np.where(fresh[1:], starts[1:], -(10**18))
        starts = np.maximum.accumulate(starts)
        run = np.arange(len(keys)) - starts  # rows of the same key before each
        left, right, open_ = [], [], []
        for gap in range(1, min(NEAR, len(keys) - 1) + 1):
            at = np.arange(max(gap, old), len(keys))
            at = at[run[at] >= gap]
            if not len(at):
                break
            close = np.bitwise_count((fps[at] ^ fps[at - gap]).view(np.uint64)) <= RADIUS
            left.append(fps[at[close]])
            right.append(fps[at[close] - gap])
            if gap == NEAR:
                open_ = [np.concatenate([fps[at], fps[at - gap]])]
        if left and sum(map(len, left)):
            yield _pairs(*_forest(np.concatenate(left), np.concatenate(right)))
        if open_:
            dense = np.unique(open_[0])
            yield _pairs(dense, dense)
        keys, fps, run = keys[-NEAR:], fps[-NEAR:], run[-NEAR:]


def _star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, role, fp) in order: links to the key's first row at one bit or none; such links hold without a check."""
    key, centre = None, None
    for batch in batches:
        keys, roles, fps = (batch.column(i).to_numpy() for i in range(3))
        if not len(keys):
            continue
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        fresh[0] = key is None or keys[0] != key
        at = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), -1))
        hub, good = fps[np.maximum(at, 0)], roles[np.maximum(at, 0)] == 0
        if centre is not None:
            hub, good = np.where(at < 0, centre, hub), good | (at < 0)
        else:
            good &= at >= 0
        good_links = good & (hub != fps)
        if good_links.any():
            yield _pairs(*_forest(hub[good_links], fps[good_links]))
        key, centre = keys[-1], (hub[-1] if good[-1] else None)


def links(fps: DataFrame) -> DataFrame:
    """Enough links between distinct fingerprints (column fp) within three bits to join what they join.

    Each fingerprint emits, for each of three blocks of bits, the other bits
    and those with one flipped: 130 variants.  Two fingerprints within three
    bits differ in at most two bits outside some block, so a variant within one
    of each is the same.  Rows are shuffled on variants and sorted; a row is
    compared with the ``NEAR`` rows of its variant before it.  Fingerprints in
    longer runs that this leaves open emit their whole balls of half the
    radius, where meeting proves the link; that is linear in their number.
    """
    once = cut(fps.select("fp").distinct())
    # tasks by the number of variants: few bytes would else be put into few tasks, which emit 130 times what they read
    tasks = max(1, -(-once.count() * VARIANTS // TASK_ROWS))
    once = once.repartition(tasks, F.xxhash64("fp"))
    keyed = once.mapInArrow(in_batches(_ball_keys, 1000), _PAIR).repartition(tasks, "a").sortWithinPartitions("a", "b")
    found = cut(keyed.mapInArrow(_collide, _PAIR))
    near = found.where("a <> b")
    dense = found.where("a = b").select("a").distinct()
    if dense.isEmpty():
        return near
    ball = T.StructType([T.StructField("key", T.LongType()), T.StructField("role", T.ByteType()), T.StructField("fp", T.LongType())])
    whole = dense.mapInArrow(in_batches(_whole_ball, 100), ball).repartition("key").sortWithinPartitions("key", "role")
    return near.unionByName(whole.mapInArrow(_star, _PAIR))


def classes(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, fp, root, component) for every document: the smallest id that its fingerprint reaches.

    ``root`` is the smallest fingerprint reached.
    Null texts count as empty, and empty texts have fingerprint 0, linked like
    any other.  Rows without an id take part and have the component of the
    smallest id reached, null if none has one.  Repeated rows stay apart.
    Copies are one fingerprint, so a hot group costs one row in the search, and
    fingerprints with a thousandth of all rows get their component by broadcast.
    """
    rows = cut(fingerprints(docs, size))
    own = F.coalesce("doc_id", F.lit(NO_ID))
    per = cut(rows.groupBy("fp").agg(F.min(own).alias("least"), F.count(F.lit(1)).alias("n")))
    joined = components(links(per))
    rooted = per.join(joined, per["fp"] == joined["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted)
    groups = rooted.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("own"))
    named = cut(join_hot(rooted, groups, "root", "own", rooted.count()).select("fp", "n", "root", "component"))
    return join_hot(rows, named, "fp", "n", rows.count()).select(
        "doc_id", "fp", "root", F.when(F.col("component") != NO_ID, F.col("component")).alias("component")
    )


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def dedup(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of each component: that with the smallest id, with its own columns.

    Of rows of a component that repeat this id, and of a component without any
    id, the row with the smallest hashes stays.  A row is told by its id and its
    fingerprint, so an id that stands in several components keeps one row in
    each of which it is the smallest.  Columns may have any names.
    """
    return apart(docs, ("__keep__", "__fp__", "__root__", "__again__", "__row__"), lambda rows: _dedup(rows, size))


def _dedup(docs: DataFrame, size: int) -> DataFrame:
    found = classes(docs, size)
    best = found.where("doc_id = component").select(F.col("doc_id").alias("__keep__"), F.col("fp").alias("__fp__"), F.col("root").alias("__root__")).distinct()
    again = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null").select(F.col("doc_id").alias("__again__"))
    repeated = not again.isEmpty()
    once = best.join(again, F.col("__keep__") == F.col("__again__"), "left_anti") if repeated else best
    kept = docs.join(once.select("__keep__"), docs["doc_id"] == F.col("__keep__"), "left_semi")
    if repeated:
        rows = docs.join(again, docs["doc_id"] == F.col("__again__"), "left_semi")
        met = _with_fingerprint(rows, size).withColumn("__keep__", F.col("doc_id")).join(best, ["__keep__", "__fp__"])
        kept = kept.unionByName(_one_of_each(met, docs))
    lost = found.where("component is null").select(F.col("fp").alias("__fp__"), F.col("root").alias("__root__")).distinct()
    if lost.isEmpty():
        return kept
    nameless = _with_fingerprint(docs.where("doc_id is null"), size).join(lost, "__fp__")
    return kept.unionByName(_one_of_each(nameless, docs))


def _one_of_each(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Of each root the row with the smallest hash of its text, then of its other columns; with the columns of ``docs``."""
    order = [F.sha2(F.col("text").cast("binary"), 256)]
    order += [F.xxhash64(F.col(f"`{x.name}`")) for x in docs.schema if "map<" not in x.dataType.simpleString()]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return rows.groupBy("__root__").agg(F.min_by(whole, F.struct(*order)).alias("__row__")).select("__row__.*")


def _with_fingerprint(docs: DataFrame, size: int) -> DataFrame:
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).cast(pa.binary()).to_pylist()
        fps = np.array([fingerprint(x or b"", size) for x in texts], np.uint64).view(np.int64)
        return pa.record_batch([*batch.columns, pa.array(fps)], [*batch.schema.names, "__fp__"])

    return docs.mapInArrow(in_batches(run), T.StructType([*docs.schema.fields, T.StructField("__fp__", T.LongType())]))
