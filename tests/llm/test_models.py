"""Quality, toxicity and language model."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import common, corpus, lm, mixer, quality, toxicity
from tickweave.llm.queries import op1_quality, op4_toxicity


def label_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x[:1500], y[:1500], trees=40)
    assert ((model.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.97

    def walk(row):
        total = model.base
        for feature, split, leaf in zip(model.feature, model.split, model.leaf, strict=True):
            at = 0
            while at < len(feature):
                at = 2 * at + 1 + int(row[feature[at]] > split[at])
            total += leaf[at - len(feature)]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(model.score(x[:50]), [walk(r) for r in x[:50]])


@pytest.mark.parametrize("y", [np.zeros(0), np.ones(5), np.zeros(5)])
def test_one_label_or_none(y):
    model = quality.fit(np.zeros((len(y), quality.STATISTICS), np.float32), y)
    assert np.allclose(model.score(np.zeros((1, quality.STATISTICS), np.float32)), (y.sum() + 0.5) / (len(y) + 1))


def test_quality_on_held_out(spark, middle):
    got = {x.doc_id: x for x in op1_quality(spark, middle).collect()}
    labels = spark.read.parquet(f"{middle}/labels.parquet").collect()
    held = [x for x in labels if got[x.doc_id].held_out]
    assert all(got[x.doc_id].held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in labels)
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7) for x in got.values())
    assert len(got) == 1000 and np.mean([got[x.doc_id].predicted == x.quality for x in held]) >= 0.97


def test_quality_odd_rows(spark, odd_docs, no_docs):
    model = quality.learn(odd_docs, label_rows(spark, [(1, 1, 0), (1, 0, 0), (2, 0, 0), (None, 1, 1), (5, None, None), (99, 1, 1)]))
    assert quality.score(odd_docs, model).count() == odd_docs.count()
    kept = quality.keep(odd_docs, model, 0.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert quality.score(no_docs, quality.learn(no_docs, label_rows(spark, []))).count() == 0


def test_network_gradients():
    net = toxicity.Network.fresh(1)
    vocabulary = [b"alpha", b"be", "ü".encode(), b"delta"]
    words, bounds = toxicity.Words.in_order(vocabulary, block=3)
    net.keep_common(words, [np.arange(3)] * 3 + [np.array([3])], bounds)
    plain = toxicity.Words.of(vocabulary)
    assert sorted(zip(plain.owner, plain.gram, strict=True)) == sorted(zip(words.owner, words.gram, strict=True)) and (plain.word == words.word).all()
    assert (net.row["word"][words.word[:3]] > 0).all() and net.row["word"][words.word[3]] == 0
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    at = rng.integers(0, 5, (6, 7))
    y, weight = np.array([0, 1, 0, 1, 1, 0], np.float64), np.arange(1, 7) / 3

    def loss():
        x = net.inputs(words)
        out = net.logits((net.gates(x, "f"), net.gates(x, "b")), at).astype(np.float64)
        return float((weight * (np.logaddexp(0, out) - y * out)).sum() / weight.sum())

    grads = net.gradients(words, at, y, weight)
    for name, g in grads.items():
        flat, grad = net.p[name].reshape(-1), np.asarray(g, np.float64).reshape(-1)
        for i in np.argsort(-abs(grad))[:3]:
            keep = flat[i]
            flat[i] = keep + 1e-3
            up = loss()
            flat[i] = keep - 1e-3
            down = loss()
            flat[i] = keep
            assert (up - down) / 2e-3 == pytest.approx(grad[i], rel=0.05, abs=2e-4), name


def test_windows_cover_all_words():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        w = toxicity.windows(np.arange(n), 10**6)
        assert set(w.ravel()) - {10**6} == set(range(n))
        assert all(len(set(a) & set(b) - {10**6}) >= min(8, n - 24) for a, b in zip(w, w[1:], strict=False))


def test_toxicity_separates():
    rng = random.Random(4)
    common = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    bad = ["vile" + x for x in ("a", "o", "en", "ist", "ung", "er")]

    def text(n, toxic):
        words = [rng.choice(common) for _ in range(n)]
        for _ in range(max(1, n // 40) if toxic else 0):
            words[rng.randrange(n)] = rng.choice(bad)
        return " ".join(words)

    y = np.array([i % 5 == 0 for i in range(500)], int)
    texts = [text(rng.randint(10, 300), t) for t in y]
    net = toxicity.fit(texts[:400], y[:400])
    p = toxicity.scores(net, texts[400:])
    assert ((p >= 0.5) == y[400:]).mean() >= 0.95
    late = " ".join([rng.choice(common) for _ in range(3000)] + ["vileung"] + [rng.choice(common) for _ in range(3000)])
    assert toxicity.scores(net, [late])[0] > 0.5
    again = toxicity.scores(net, texts[400:][::-1])[::-1]
    assert np.allclose(p, again, atol=1e-5)


def test_toxicity_odd_rows(spark, odd_docs, no_docs, small):
    net = toxicity.learn(odd_docs, label_rows(spark, [(1, 1, 0), (2, 0, 1), (None, 1, 1), (5, None, None), (6, 1, 0), (7, 1, 1)]), toxic=3, clean=3)
    rows = toxicity.score(odd_docs, net).collect()
    assert len(rows) == odd_docs.count() and all(0 <= x.score <= 1 for x in rows)
    assert toxicity.score(no_docs, toxicity.learn(no_docs, label_rows(spark, []))).count() == 0
    got = op4_toxicity(spark, small).collect()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got) and len(got) == 200


def test_lm_base_by_brute_force(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    got = {x.doc_id: x for x in lm.score(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    held = {x.doc_id: zlib.crc32(str(x.doc_id).encode()) % 7 == 2 for x in rows}
    counts = Counter(t for x in rows if not held[x.doc_id] for t in lm.tokens(x.text.encode()))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for x in rows:
        tokens, y = lm.tokens(x.text.encode()), got[x.doc_id]
        assert (y.held_out, y.n_tokens, y.train_tokens, y.n_known) == (held[x.doc_id], len(tokens), n, sum(counts[t] > 0 for t in tokens))
        assert y.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), rel=1e-9)
        assert y.score < 0
    out = [y for y in got.values() if y.held_out]
    assert sum(y.score for y in out) > sum(y.base_score for y in out)


def test_spelling_is_a_probability():
    rng = random.Random(0)
    alphabet = b"ab"
    words = sorted({bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 4))) for _ in range(400)})
    speller = mixer.Speller(words)
    assert sum(2.0 ** -int(x) for x in speller.codes.length) == pytest.approx(1.0)
    first = [bytes([b]) for b in range(256)] + [b""]
    # of all words that begin with a byte, and the empty one, no more than 1
    assert np.exp(-speller.nats(first)).sum() < 1
    every = [b""] + [bytes(x) for n in range(1, 9) for x in itertools.product(alphabet, repeat=n)]
    total = np.exp(-speller.nats(every)).sum()
    assert 0.5 < total <= 1 + 1e-6
    assert speller.nats([b"ab"])[0] < speller.nats([b"zq"])[0]


def test_decisions_are_probabilities():
    rng = np.random.default_rng(1)
    weights = rng.integers(1, 50, 37).astype(float)
    tree = mixer.Tree(weights)
    assert np.exp(np.add.reduceat(np.log(1 / (1 + np.exp(-tree.static.astype(float)))), tree.start)) == pytest.approx(weights / weights.sum(), rel=1e-5)
    odds = np.stack([tree.odds(rng.integers(0, 20, 37)) for _ in range(2)])
    gates, symbols = np.repeat([0, 1], 37).astype(np.int8), np.tile(np.arange(37, dtype=np.int32), 2)
    cost = mixer.code(tree, odds, gates, symbols, rng.integers(0, 9, 74))
    assert np.exp(-cost[:37]).sum() == pytest.approx(1, rel=1e-4) and np.exp(-cost[37:]).sum() == pytest.approx(1, rel=1e-4)
    # a guess that may be right or wrong: both together are certain
    both = np.zeros(400, np.int32)
    both[1::2] = 1
    share = lambda said, where: (np.full(len(said), 0.1), np.full(len(said), 0.2))
    cost, met = mixer.guess(both, np.zeros((1, 400), np.int32), np.ones(400, np.int32), rng.random(400) < 0.5, share)
    assert met.tolist() == [x == 0 for x in both] and np.exp(-cost[0]) + np.exp(-cost[1]) == pytest.approx(1, rel=1e-5)


def test_contexts_by_brute_force():
    rng = np.random.default_rng(3)
    doc = np.sort(rng.integers(0, 12, 300)).astype(np.int32)
    context = mixer._mix2(rng.integers(0, 8, 300), rng.integers(0, 3, 300))
    symbol, learns = rng.integers(0, 4, 300).astype(np.int32), (doc % 3 > 0)
    found, grade = mixer.followers(context, symbol, doc, learns)
    here = mixer.before(context, symbol)
    for k in range(300):
        at = [j for j in range(300) if learns[j] and context[j] == context[k]]
        sides = [symbol[j] for j in (at[-1:] + at[:1]) if doc[j] != doc[k]]
        assert grade[k] == (0 if not sides else 1 if len(sides) == 1 else 2 if sides[0] == sides[1] else 3)
        assert found[k] == (sides[0] if sides else -1)
        early = [j for j in range(k) if context[j] == context[k]]
        assert here[k] == (symbol[early[-1]] if early else -1)


def scored(texts, held):
    """The model of a shard that is the whole corpus, counted plainly."""
    lists = [mixer.tokens(t.encode()) for t in texts]
    counts, sides = Counter(), defaultdict(Counter)
    for words, out in zip(lists, held, strict=True):
        if not out:
            own = Counter(words)
            counts.update(own)
            for w, n in own.items():
                sides[w][mixer.gate(own)] += n
    words = sorted({w for x in lists for w in x})
    place = {w: k for k, w in enumerate(words)}
    side = np.array([max(sides[w], key=lambda g: (sides[w][g], g)) if w in sides else mixer.GATES for w in words], np.int8)
    corpus = mixer.Corpus(sum(counts.values()), len(counts), sum(n == 1 for n in counts.values()))
    return mixer.score(words, np.array([counts[w] for w in words]), side, [(h, np.array([place[w] for w in x], np.int32)) for h, x in zip(held, lists, strict=True)], corpus)


def test_a_training_document_is_scored_by_the_others():
    rng = random.Random(6)
    names = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    text = lambda: " ".join(names[min(int(rng.expovariate(1 / 60)), 899)] for _ in range(120))
    texts = [text() for _ in range(150)]
    texts[80] = texts[20]
    held = [k % 7 == 2 for k in range(150)]
    plain = scored(texts, held)
    for k in (0, 6, 45):
        apart = scored(texts, [h or i == k for i, h in enumerate(held)])
        assert plain[k][2] == pytest.approx(apart[k][2], rel=0.06)
    assert min(plain[20][2], plain[80][2]) > max(x[2] for i, x in enumerate(plain) if i not in (20, 80))


def test_lm_odd_rows(odd_docs, no_docs, monkeypatch):
    rows = lm.score(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = [x for x in rows if x.doc_id in (2, 3, 7)]
    assert [x.n_tokens for x in empty] == [1, 1, 1] and all(x.score < 0 and math.isfinite(x.score) for x in rows)
    twice = [x for x in rows if x.doc_id == 8]
    assert len(twice) == 2 and twice[0].score == pytest.approx(twice[1].score)
    assert lm.score(no_docs).count() == 0
    assert all(math.isfinite(x.score) and x.train_tokens == 0 and x.n_known == 0 for x in lm.score(odd_docs.where("doc_id = 3"), 1, 0).collect())  # all held out
    monkeypatch.setattr(lm, "SHARD_BYTES", 3000)  # many shards, and a text whose copies overfill one
    many = lm.score(odd_docs).collect()
    for a, b in zip(sorted(map(tuple, rows), key=repr), sorted(map(tuple, many), key=repr), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def test_lm_learns_from_other_shards(spark, monkeypatch):
    """Documents that differ in a word each are in shards of their own and still know each other."""
    rng = random.Random(8)
    names = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(600)]
    texts = [[rng.choice(names) for _ in range(150)] for _ in range(60)]
    for k in range(10):
        texts[50 + k] = [f"other{k}", *texts[k][1:]]
    rows = [(k, " ".join(x)) for k, x in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = {x.doc_id: x for x in lm.score(docs, 7, 2).collect()}
    monkeypatch.setattr(lm, "SHARD_BYTES", 500)
    many = {x.doc_id: x for x in lm.score(docs, 7, 2).collect()}
    near = [k + d for k in range(10) for d in (0, 50) if not many[k + 50 - d].held_out]
    fresh = [k for k in range(10, 50)]
    for got in (one, many):
        assert max(got[k].score for k in fresh) < min(got[k].score for k in near)
        assert sum(got[k].score for k in near) / len(near) > 0.5 * sum(got[k].score for k in fresh) / len(fresh)


def test_answers_by_brute_force():
    rng = random.Random(9)
    parts, bits = 3, 40
    shards, texts = [], []
    for _ in range(4):
        some = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 9))).encode() for _ in range(25)]
        held = [rng.random() < 0.3 for _ in some]
        texts.append((some, held))
        shards.append(corpus.Shard.load(corpus.Shard.of(some, held).dump()))
    counts, follow = Counter(), defaultdict(Counter)
    pairs = lambda words: zip([None, None, *words], [None, *words], words)
    for some, held in texts:
        for text, out in zip(some, held, strict=True):
            words = mixer.tokens(text)
            if not out:
                counts.update(words)
                for a, b, c in pairs(words):
                    follow[a, b][c] += 1
    asked = sorted((part, kind, k, data) for k, shard in enumerate(shards) for part, kind, data in shard.asks(parts, bits))
    answers, distinct = defaultdict(dict), 0
    for part in range(parts):
        for kind in (corpus.WORDS, corpus.CONTEXTS):
            mine = [x for x in asked if x[:2] == (part, kind)]
            if kind == corpus.WORDS and mine:
                got, more = corpus.answer_words([x[3] for x in mine])
                distinct += more
            elif mine:
                got = corpus.answer_contexts([x[3] for x in mine])
            for x, y in zip(mine, got if mine else [], strict=True):
                answers[x[2], kind][part] = y
    assert distinct == len(counts)
    for k, (shard, (some, _)) in enumerate(zip(shards, texts, strict=True)):
        at = 0
        for part, data in sorted(answers[k, corpus.WORDS].items()):
            one, more, bitmap, code = corpus.unpack(data)
            for n in corpus.large(one, more):
                assert n == counts[shard.words[shard.order[at]]]
                at += 1
        lists = [[None, None, *mixer.tokens(x)] for x in some]
        flat = [(a, b, d) for d, x in enumerate(lists) for a, b in zip(x, x[1:-1], strict=False)]
        for part, data in sorted(answers[k, corpus.CONTEXTS].items()):
            keys = np.flatnonzero(shard.key_part == part)
            bitmap, a, b, c, d, *_ = corpus.unpack(data)
            known = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(keys)).astype(bool)
            n1, total = np.zeros(len(keys), int), np.zeros(len(keys), int)
            n1[known], total[known] = corpus.large(a, b), corpus.large(c, d)
            for key, n, all_ in zip(keys, n1, total, strict=True):
                places = np.flatnonzero(shard.of == key)
                a, b, doc = flat[places[0]]
                assert shard.shared[key] == any(flat[p][2] != doc for p in places)
                others = Counter(follow[a, b])
                if not shard.shared[key] and not shard.held[doc]:
                    others.subtract(Counter(z for x, y, z in pairs(lists[doc][2:]) if (x, y) == (a, b)))
                assert n == max(others.values(), default=0) and (not n or all_ == sum(others.values()))


def test_prices_of_contrary_cells():
    seen = np.random.default_rng(2).integers(0, 50, corpus.CELLS).astype(float)
    p = np.exp(-corpus.prices(seen, 20))
    two = p[: corpus.TREE].reshape(-1, 2).sum(axis=1)
    tree = p[corpus.TREE :].reshape(mixer.DEPTHS, corpus.STATIC, corpus.OWN)
    assert two == pytest.approx(1, rel=1e-4) and (tree + tree[:, ::-1, ::-1]).ravel() == pytest.approx(1, rel=1e-4)


def test_spelling_by_trigrams_is_a_probability():
    rng = random.Random(1)
    words = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 4))) for _ in range(60)})
    keys, n = np.unique(corpus.grams(words), return_counts=True)
    spelling = corpus.Spelling(keys, n)
    first = [[bytes([x])] for x in range(256)] + [[b""]]
    assert np.exp(-spelling.nats(first, np.ones(257, bool))).sum() < 1
    every = [[bytes(x)] for k in range(9) for x in itertools.product(b"ab", repeat=k)]
    assert 0.3 < np.exp(-spelling.nats(every, np.ones(len(every), bool))).sum() <= 1 + 1e-9
    less = np.unique(corpus.grams([w for w in words if w != words[3]]), return_counts=True)
    assert (spelling.nats([[words[3]]], np.zeros(1, bool)) >= spelling.nats([[words[3]]], np.ones(1, bool)) - 1e-9).all() and len(less[0]) <= len(keys)
    assert corpus.Spelling(np.zeros(0, np.int64), np.zeros(0, np.int64)).nats([[b"ab"], []], np.ones(2, bool))[0] == pytest.approx(3 * math.log(257))


def test_counts_in_bytes():
    n = np.concatenate([np.arange(70_000), 2 ** np.arange(17, 33)])
    back = corpus.restored(corpus.rounded(n))
    assert (back[:16] == n[:16]).all() and (np.abs(back - n) <= n / 8).all()


def test_lowest_is_the_smallest_hashes(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    got = [x.k for x in common.lowest(rows, 100, "k").collect()]
    assert got == [x.k for x in rows.orderBy(F.xxhash64("k")).limit(100).collect()]
    assert common.lowest(rows.where("k < 7"), 100, "k").count() == 7 and common.lowest(rows.where("k < 0"), 5, "k").count() == 0
