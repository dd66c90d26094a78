"""Whitening and hard negatives against plain versions in exact arithmetic."""

from __future__ import annotations

import math
import random
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickweave.llm import negatives, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def taking_part(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def whole(vector):
    return tuple(math.floor(256 * float(np.float32(c))) for c in vector)


def exact_covariance(points):
    n, d = len(points), len(points[0])
    sums = [sum(p[k] for p in points) for k in range(d)]
    y = [[Fraction(n * p[k] - sums[k], n) for k in range(d)] for p in points]
    return n, sums, [[sum(r[i] * r[j] for r in y) / n for j in range(d)] for i in range(d)]


def check_whitening(rows, got, components=4):
    kept = taking_part(rows)
    width = max(len(r[1]) for r in kept)
    x = [whole(r[1]) + (0,) * (width - len(r[1])) for r in kept]
    n, sums, v = exact_covariance(sorted(set(x)))
    e, u = np.linalg.eigh(np.array(v, np.float64))
    e, u = e[::-1], u[:, ::-1]
    k = min(components, width)
    assert len(got) == len(kept) * k
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    for r, p in zip(kept, x, strict=True):
        for c in range(k):
            row = by[r[0], c + 1][0]
            diff = [n * a - s for a, s in zip(p, sums, strict=True)]
            assert row.n == n and row.deviation == sum(d * d for d in diff)
            assert row.explained == pytest.approx(e[c] / e.sum(), rel=1e-9, abs=1e-12)
            if e[c] > 1e-9 * e[0]:
                want = np.dot(np.array(diff, np.float64) / n, u[:, c]) / math.sqrt(e[c])
                assert abs(row.whitened) == pytest.approx(abs(want), rel=1e-6, abs=1e-6)
            assert row.identity_error < 1e-9
    return by


def test_whitening_query_equals_exact_arithmetic(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()][:]
    got = queries.op13_whitening(spark, small).collect()
    check_whitening(rows, got)
    w = {}
    for r in got:
        w.setdefault(r.vec_id, {})[r.component] = r.whitened
    m = np.array([[w[i][c] for c in range(1, 5)] for i in sorted(w)])
    assert np.abs(m.T @ m / len(m) - np.eye(4)).max() < 1e-9  # no two vectors of this table are equal


def odd_rows():
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], i % 3) for i in range(40)]
    copies = [(100 + i, rows[0][1], 1) for i in range(60)]
    broken = [(200, None, 1), (201, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (202, [float("nan")] * 6, 1), (203, [float("inf")] * 6, 1), (204, [float("-inf")] + [0.0] * 5, 0)]
    return rows + copies + broken + [(None, [0.5] * 6, 2), (300, [0.25, -0.25], 0), (301, [], 0), (5, rows[5][1], 1), (302, [-0.0] * 6, None)]


def test_whitening_of_copies_short_vectors_and_broken_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("x", "n", "component", "piece", "part", "whitened"):
        df = df.withColumn(name, F.lit("clash"))
    by = check_whitening(rows, whitening.whiten(df.repartition(5)).collect())
    assert len(by[5, 1]) == 2 and by[5, 1][0] == by[5, 1][1]
    assert {i for i, _ in by} == {r[0] for r in taking_part(rows)}


def test_whitening_without_variance_or_rows(spark):
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)], SCHEMA)).collect()
    assert {(r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in same} == {(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)}
    line = whitening.whiten(spark.createDataFrame([(i, [i / 256, 2 * i / 256, 0.0], 0) for i in range(9)], SCHEMA)).collect()
    assert {r.component: r.whitened is None for r in line} == {1: False, 2: True, 3: True}
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], SCHEMA)).collect() == []


def test_components_too_large_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30], 0)], SCHEMA)).collect()


def test_deviations_beyond_64_bits_are_exact():
    big = whitening.Whitening(10**9, [3 * 10**12, -(10**11)], 2**40, np.array([1.0]), np.eye(2)[:, :1], 1.0)
    x = np.array([[2**40, -5], [7, 0]])
    want = [sum((10**9 * int(a) - s) ** 2 for a, s in zip(row, big.sums, strict=True)) for row in x]
    assert big.deviations(x) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.lists(st.lists(st.integers(-(2**40), 2**40), min_size=5, max_size=5), min_size=2, max_size=30))
def test_outer_products_keep_twice_the_digits(width, rows):
    x = np.array(rows)[:, :width]
    n = len(x)
    sums = [int(sum(int(a) for a in x[:, k])) for k in range(width)]
    mean = np.array([s / n for s in sums])
    rest = np.array([float(Fraction(s, n) - Fraction(m)) for s, m in zip(sums, mean.tolist(), strict=True)])
    high, low = whitening.outer(*whitening.centred(x, (mean, rest)))
    i, j = np.triu_indices(width)
    for k, (a, b) in enumerate(zip(i, j, strict=True)):
        want = sum(Fraction(n * int(r[a]) - sums[a], n) * Fraction(n * int(r[b]) - sums[b], n) for r in x)
        scale = sum(abs(Fraction(n * int(r[a]) - sums[a], n) * Fraction(n * int(r[b]) - sums[b], n)) for r in x)
        assert abs(Fraction(high[k]) + Fraction(low[k]) - want) <= scale * Fraction(1, 2**96)


def test_eigenvectors_are_refined_beyond_the_solver():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    v = (q * np.array([1e6, 1e6 * (1 - 1e-9), *np.geomspace(1e3, 1e-3, 28)])) @ q.T
    v = ((v + v.T) / 2).astype(np.longdouble)
    e, x = whitening.eigen(v)
    assert (np.diff(e) <= 0).all()
    assert np.abs(x.T @ x - np.eye(30)).max() < 1e-17
    assert np.abs(v @ x - x * e).max() < 1e-9


def mined(rows, every=50, positives=5, negatives_=3):
    """All pairs, sorted; equal scores by vec_id, those without one last."""
    kept = [(n, r[0], r[2], whole(r[1])) for n, r in enumerate(rows) if r in taking_part([r]) and r[2] is not None]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for n, i, label, x in kept:
        if i is None or i % every:
            continue
        scored = [(dot(x, y), j, other) for m, j, other, y in kept if m != n]
        for p, positive, _ in sorted((s for s in scored if s[2] == label), key=key)[:positives]:
            found = sorted((s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p), key=key)[:negatives_]
            out += [(i, positive, k, q, p, s) for k, (s, q, _) in enumerate(found, 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def clustered(n, labels, seed, width=6):
    rng = random.Random(seed)
    centres = [[rng.uniform(0, 1) for _ in range(width)] for _ in range(3)]
    return [(i, [c + rng.uniform(-0.2, 0.2) for c in centres[i % 3]], rng.choice(labels)) for i in range(n)]


@pytest.mark.parametrize("labels", [[0, 1], [0, 0, 0, 0, 1, 2, 3], list(range(60)), [4]])
def test_small_blocks_give_what_all_pairs_do(spark, labels):
    rows = clustered(230, labels, len(labels))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(negatives.mine(df, every=10, rows=32, anchors=4, dims=2)) == mined(rows, every=10)


def test_hard_negatives_of_odd_rows(spark):
    rows = odd_rows() + [(50, [0.5] * 6, 1), (50, [0.5] * 6, 1), (50, [0.5] * 6, 2), (60, [0.45] * 6, 0), (61, [0.45] * 6, 0), (None, [0.45] * 6, 0), (-50, [0.4] * 6, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "block", "chunk", "x", "i", "j", "lo", "all", "weight", "score"):
        df = df.withColumn(name, F.lit("clash"))
    assert rows_of(negatives.mine(df, rows=16, anchors=2, dims=4)) == mined(rows)


def test_no_anchors_no_rows(spark):
    for rows in ([], [(1, [1.0], 0), (2, [1.0], 1)], [(50, None, 0)], [(50, [1.0], None)], [(50, [], 1), (51, [], 2)]):
        assert negatives.mine(spark.createDataFrame(rows, SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="too large"):
        negatives.mine(spark.createDataFrame([(50, [1e8], 0)], SCHEMA))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=40), st.integers(1, 6))
def test_best_keeps_the_first_of_equal_scores(scores, k):
    found = negatives.best(np.array(scores), np.arange(len(scores)), k)
    assert found.tolist() == sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k]


def test_products_beyond_doubles_are_exact():
    a, b = np.array([[2**30, 1], [-(2**30), 3]]), np.array([[2**30, 2**27 + 1]])
    assert negatives.product(a, b).tolist() == [[2**60 + 2**27 + 1], [-(2**60) + 3 * (2**27 + 1)]]


def written_by_shuffles(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(f.stat().st_size for d in manager.localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data"))


def test_no_score_is_shuffled(spark):
    rows = clustered(3000, [0, 1, 2], 9)
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    before = written_by_shuffles(spark)
    assert negatives.mine(df, every=2, rows=128, anchors=64, dims=2).count() > 0
    assert written_by_shuffles(spark) - before < 1_000_000  # 4.5 million scores, of each of three chunks, are 108 MB


def test_best_of_a_stream_with_ties_and_panels_in_any_order():
    rng = random.Random(4)
    cells = [(rng.randint(0, 3), rng.choice([7, 8, 9, 10, negatives.NO_ID]), k) for k in range(200)]
    found = negatives.Firsts(2, 3)
    for part in (cells[100:], cells[:100]):
        part = np.array(sorted(part, key=lambda c: (c[1], c[2])))
        found.add(np.ones(len(part), int), part[:, 0], part[:, 1], part[:, 2])
    assert found.kept == [[], sorted((-s, i, k) for s, i, k in cells)[:3]]
