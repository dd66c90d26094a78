"""Mixing and sharding."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickweave.llm import common, mixing, sharding


def docs(make_docs, counts, size=5):
    rows, k = [], 0
    for source, n in counts.items():
        for i in range(n):
            rows.append((k, " ".join(["w"] * (size + i % 3)), source))
            k += 1
    return make_docs(rows)


def test_shards_match_the_mixture(make_docs):
    got = sharding.shard(docs(make_docs, {"big": 400, "mid": 150, "small": 50}), shards=8, block=60).collect()
    per = defaultdict(list)
    for x in got:
        per[x.shard].append(x)
    assert sorted(len(v) for v in per.values()) == [75] * 8
    for v in per.values():
        assert sorted(x.slot for x in v) == list(range(75))
        assert max(abs(Counter(x.source for x in v)[s] - n / 8) for s, n in {"big": 400, "mid": 150, "small": 50}.items()) <= 2


def test_blocks_do_not_change_shards(make_docs):
    df = docs(make_docs, {"a": 90, "b": 30})
    one, many = (sorted((x.doc_id, x.shard, x.slot) for x in sharding.shard(df, 7, block=b).collect()) for b in (10_000, 10_000))
    assert one == many and [x[0] for x in one] == list(range(120))
    assert sorted((x.shard, x.slot) for x in sharding.shard(df, 7, block=5).collect()) == sorted((x[1], x[2]) for x in one)


def test_sharding_odd_rows(odd_docs, no_docs):
    got = sharding.shard(odd_docs, 4).collect()
    assert len(got) == odd_docs.count()
    for x, text in ((x, {1: "one two three", 2: "", 3: ""}.get(x.doc_id)) for x in got):
        if text is not None:
            assert x.size == len(text) + 8 and x.text_crc32 == zlib.crc32(text.encode())
        assert x.law == "rows" and x.grown_shard is None
    assert sharding.shard(no_docs).count() == 0


def test_ranked_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aaab"), rng.choice([5, -7]) if rng.random() < 0.5 else rng.getrandbits(63) - 2**62, rng.getrandbits(63) - 2**62, i, rng.randint(0, 9)) for i in range(600)]
    df = spark.createDataFrame(rows, "s string, h long, h2 long, id long, w long")
    got = common.ranked(common.cut(df), "s", ["h", "h2", "id"], "w", block=20).collect()
    for s in "ab":
        want = sorted((x[1:] for x in rows if x[0] == s))
        mine = sorted((x for x in got if x.s == s), key=lambda x: x["rank"])
        assert [x["rank"] for x in mine] == list(range(1, len(mine) + 1)) and {x.n for x in mine} == {len(mine)}
        assert [(x.h, x.h2, x.id, x.w) for x in mine] == want
        assert [x.before for x in mine] == [sum(x[3] for x in want[:k]) for k in range(len(want))]


def test_equal_rows_are_dealt_apart(spark, monkeypatch):
    """A text that is in all rows, and rows that are equal in all: no task of the dealing has more than its share."""
    seen = []
    cut = common.cut

    def noted(df):
        out = cut(df)
        if "_p" in out.columns:
            seen.append([x["count"] for x in out.groupBy("_p").count().collect()])
        return out

    monkeypatch.setattr(common, "cut", noted)
    same = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one text").alias("text"), F.lit("a").alias("source"))
    got = sharding.shard(same, 8, block=200).collect()
    assert sorted((x.shard, x.slot) for x in got) == [(s, k) for s in range(8) for k in range(500)]
    assert len(seen) == 2 and all(max(sizes) <= 2 * 200 for sizes in seen)


def test_a_row_read_very_often_is_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TOGETHER", 7)
    same = spark.range(50).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one text").alias("text"), F.lit("a").alias("source"))
    rows = same.unionByName(spark.createDataFrame([(2, "another", "a")], "doc_id long, text string, source string"))
    assert Counter(x.doc_id for x in mixing.mix_rows(rows).collect()) == {1: 50, 2: 1}


def entropy(shares, alpha):
    w = [s**alpha for s in shares]
    z = sum(w)
    return -sum(x / z * math.log(x / z) for x in w)


@pytest.mark.parametrize(("target", "repeats"), [(0.97, 100.0), (0.97, 2.0), (0.5, 100.0), (1.0, 100.0)])
def test_exponent(spark, target, repeats):
    shares = [0.7, 0.2, 0.06, 0.04]
    df = spark.createDataFrame([(s,) for s in shares], "share double")
    alpha = mixing.exponent(df, target, repeats)
    need = target * math.log(4)
    limit = 1 - math.log(repeats) / math.log(0.7 / 0.04)
    if entropy(shares, 1.0) >= need:
        assert alpha == 1.0
    elif limit > 0 and entropy(shares, limit) < need:
        assert alpha == pytest.approx(limit, abs=1e-9)
    else:
        assert entropy(shares, alpha) == pytest.approx(need, abs=1e-6)


def test_budgets_and_blocks(make_docs):
    df = docs(make_docs, {"big": 300, "small": 40})
    got = mixing.mix(df, entropy=0.9, repeats=10, block=25).collect()
    by = defaultdict(list)
    for x in got:
        by[x.source].append(x)
    for rows in by.values():
        x = rows[0]
        whole, rest = int(x.readings), math.floor((x.readings - int(x.readings)) * x.source_tokens)
        for block in range(1, whole + 1):
            ids = sorted(y.doc_id for y in rows if y["block"] == block)
            assert len(ids) == len(set(ids)) == {"big": 300, "small": 40}[x.source]
        part = [y.tokens for y in sorted(rows, key=lambda y: y["rank"]) if y["block"] == whole + 1]
        assert (not rest and not part) or (sum(part) >= rest > sum(part) - part[-1])
    assert by["big"][0].readings == 1.0 and by["small"][0].readings > 2
    orders = [[y.doc_id for y in sorted(by["small"], key=lambda y: y["rank"]) if y["block"] == b] for b in (1, 2)]
    assert orders[0] != orders[1]


def test_mixing_odd_rows(odd_docs, no_docs, make_docs):
    rows = mixing.mix_rows(odd_docs)
    assert rows.columns == odd_docs.columns
    keys = ["doc_id", "text", "source"]
    assert odd_docs.select(keys).distinct().exceptAll(rows.select(keys).distinct()).count() == 0
    keyed = odd_docs.withColumn("__row__", mixing.row_key(odd_docs))  # as mix_rows tells rows apart; other keys give other last blocks
    assert rows.count() == mixing.mix(keyed, row="__row__").count() >= odd_docs.count()
    assert mixing.mix(no_docs).count() == 0 and mixing.mix_rows(no_docs).count() == 0
    assert mixing.mix(make_docs([(1, "", "a"), (2, None, "b")])).count() == 2


def test_columns_of_any_name_and_kind_come_through(make_docs):
    """The operators' own names, in any case, and maps; two rows that differ in the map alone are two."""
    from tickweave.llm import neardup

    docs = make_docs([(1, "one two three four", "a"), (2, "five six seven eight nine", "b"), (2, "five six seven eight nine", "b"), (None, "ten eleven twelve", "b")])
    docs = docs.withColumn("k", F.monotonically_increasing_id())
    for name in ("__row__", "__READS__", "__part__", "__fp__", "__keep__", "__root__", "__again__"):
        docs = docs.withColumn(name, F.concat(F.lit("mine "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    docs = docs.withColumn("m", F.create_map(F.lit("k"), F.col("k"))).drop("k")
    mixed = mixing.mix_rows(docs)
    assert mixed.columns == docs.columns and mixed.schema["m"].dataType == docs.schema["m"].dataType
    got = mixed.select("doc_id", "__row__", "__READS__", "__fp__", F.to_json("m").alias("m")).distinct().collect()
    assert {(r[0], *r[1:4]) for r in got} == {(i, *[f"mine {i or '-'}"] * 3) for i in (1, 2, None)} and len({r.m for r in got}) == 4
    kept = neardup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r["__row__"], r["__fp__"]) for r in kept.collect()) == [("1", "mine 1", "mine 1"), ("2", "mine 2", "mine 2"), ("None", "mine -", "mine -")]


def test_main_path_is_native(odd_docs):
    for df in (mixing.mix(odd_docs), sharding.shard(odd_docs)):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {x.node: x.root for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_join_hot(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(900)] + [(f"k{i}", i) for i in range(100)], "k string, i int")
    dim = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert common.join_hot(rows, dim, "k", "n", 1000).count() == 1000
