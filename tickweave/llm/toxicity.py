"""Toxicity: a bidirectional gated recurrent network with attention pooling over words and their characters."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import ID, held_out, in_batches, lowest

#: Words in a window and from one window to the next; neighbours share eight words.
WINDOW, STEP = 32, 24
#: Labelled rows of either kind that are fitted on at most (smallest hashes of ids), each with its whole text.
FIT_TOXIC, FIT_CLEAN = 1500, 3000
THRESHOLD = 0.5
HIDDEN, EMBED, ATTEND = 8, 8, 8
#: Hashes that words and character runs are told apart by, and the runs' bytes.
WORD_HASHES, GRAM_HASHES, GRAMS = 1 << 20, 1 << 21, (3, 5, 7)
BATCH, ROUNDS, WARM, STEPS, LEARN_RATE, SEED = 128, 8, 5, 900, 0.01, 11
#: A word or run has a vector of its own if this many sampled documents use it, or a 400th of them; others are zero, so no text is learned by heart.
LEAST_DOCS, LEAST_SHARE = 3, 1 / 400
#: Share of words that are hidden in training.
HIDE = 0.2
#: Weight decay for each unit of the learning rate.
DECAY = 2.0
#: Windows scored together, and words hashed together in fitting.
TOGETHER, BLOCK = 1024, 20_000
#: Bytes of texts scored together; a longer text is scored by itself.
SLICE_BYTES = 8_000_000

_MULT = np.uint64(0x9E3779B97F4A7C15)
_KEPT = np.float32(30)  # update gate of padding: the state stays as it is


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def _spread(x: np.ndarray, rows: int) -> np.ndarray:
    return ((x * _MULT) >> np.uint64(40)).astype(np.int32) & np.int32(rows - 1)


@dataclass
class Words:
    """Hashes of distinct words and of their character runs, these with the number of their word."""

    word: np.ndarray
    gram: np.ndarray
    owner: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, words: list[bytes]) -> Words:
        """Runs of bytes with a blank at either end of the word, all words at once."""
        data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
        blank = data == 32
        number = np.cumsum(blank) - 1
        hashes = np.zeros(len(words), np.uint64)
        grams, owners = [], []
        for n in GRAMS:
            m = len(data) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for j in range(n):
                h = h * np.uint64(257) + data[j : j + m]
            good = np.ones(m, bool)
            for j in range(1, n - 1):
                good &= ~blank[j : j + m]
            at = np.flatnonzero(good)
            grams.append(_spread(h[at], GRAM_HASHES))
            owners.append(number[at + 1].astype(np.int32))
        starts = np.flatnonzero(blank)[:-1]
        if len(words):
            power = np.cumprod(np.full(int(np.diff(np.append(starts, len(data))).max()) + 1, np.uint64(1000003), np.uint64))
            hashes = np.add.reduceat((data * power[np.arange(len(data)) - starts[np.minimum(number, len(starts) - 1)]])[:-1], starts)
        gram, owner = np.concatenate(grams or [[]]).astype(np.int32), np.concatenate(owners or [[]]).astype(np.int32)
        return cls(_spread(hashes, WORD_HASHES), gram, owner, np.sqrt(np.maximum(np.bincount(owner, minlength=len(words)), 1)).astype(np.float32))

    @classmethod
    def in_order(cls, words: list[bytes], block: int = BLOCK) -> tuple[Words, np.ndarray]:
        """Many words, hashed in blocks, with the runs in order of their words; and where each word's runs begin."""
        parts = []
        for a in range(0, max(len(words), 1), block):
            part = cls.of(words[a : a + block])
            order = np.argsort(part.owner, kind="stable")
            parts.append((part.word, part.gram[order], part.owner[order] + np.int32(a), part.count))
        joined = cls(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        return joined, np.searchsorted(joined.owner, np.arange(len(words) + 1))

    def take(self, rows: np.ndarray, bounds: np.ndarray) -> Words:
        """These of the words ``in_order``."""
        size = bounds[rows + 1] - bounds[rows]
        first = np.repeat(bounds[rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return Words(self.word[rows], self.gram[np.arange(int(size.sum())) + first], np.repeat(np.arange(len(rows)), size), self.count[rows])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Network:
    p: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0
    row: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        x, h = 2 * EMBED, HIDDEN
        p = {"word": np.zeros((1, EMBED), np.float32), "gram": np.zeros((1, EMBED), np.float32)}
        for d in ("f", "b"):
            p |= {f"w{d}": draw(x, 3 * h, s=x**-0.5), f"c{d}": np.zeros(3 * h, np.float32), f"u{d}": draw(h, 3 * h, s=h**-0.5)}
        p |= {"a": draw(2 * h, ATTEND, s=(2 * h) ** -0.5), "v": draw(ATTEND, s=0.5), "o": draw(2 * h, s=0.5), "k": np.zeros(1, np.float32)}
        return cls(p, row={"word": np.zeros(WORD_HASHES, np.int32), "gram": np.zeros(GRAM_HASHES, np.int32)})

    def inputs(self, words: Words) -> np.ndarray:
        """Vectors of words: their own, and the sum of their runs', over the root of the number of runs."""
        out = np.zeros((len(words.word), 2 * EMBED), self.p["gram"].dtype)
        out[:, :EMBED] = self.p["word"][self.row["word"][words.word]]
        rows = self.row["gram"][words.gram]
        known = np.flatnonzero(rows)
        own, owner = self.p["gram"][rows[known]], words.owner[known]
        first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1]) if len(owner) else np.zeros(0, np.int64)
        if len(first):  # stretches of runs with the same word
            np.add.at(out[:, EMBED:], owner[first], np.add.reduceat(own, first))
        out[:, EMBED:] /= words.count[:, None]
        return out

    def keep_common(self, words: Words, ids: list[np.ndarray], bounds: np.ndarray, seed: int = SEED) -> None:
        """Gives vectors to the words and runs that enough documents use."""
        least, rng = max(LEAST_DOCS, int(len(ids) * LEAST_SHARE)), np.random.default_rng(seed)
        used = {"word": np.zeros(WORD_HASHES, np.int32), "gram": np.zeros(GRAM_HASHES, np.int32)}
        for i in ids:
            mine = words.take(np.unique(i), bounds)
            used["word"][np.unique(mine.word)] += 1
            used["gram"][np.unique(mine.gram)] += 1
        for k, n in used.items():
            good = n >= least
            self.row[k] = np.where(good, np.cumsum(good), 0).astype(np.int32)
            self.p[k] = rng.normal(0, 0.1, (int(good.sum()) + 1, EMBED)).astype(np.float32)
            self.p[k][0] = 0

    def gates(self, x: np.ndarray, d: str) -> np.ndarray:
        """The words' share of the gates, with padding as the last row."""
        pad = np.zeros((1, 3 * HIDDEN), np.float32)
        pad[0, HIDDEN : 2 * HIDDEN] = _KEPT
        return np.concatenate([x @ self.p[f"w{d}"] + self.p[f"c{d}"], pad])

    def states(self, gates: np.ndarray, at: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        n, length = at.shape
        u, h = self.p[f"u{d}"], np.zeros((n, HIDDEN), np.float32)
        out = np.empty((length, n, HIDDEN), np.float32)
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            a, g = gates[at[:, t]], h @ u
            rz = _sigmoid(a[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            r, z, gn = rz[:, :HIDDEN], rz[:, HIDDEN:], g[:, 2 * HIDDEN :]
            new = np.tanh(a[:, 2 * HIDDEN :] + r * gn)
            if trace is not None:
                trace.append((t, h, r, z, new, gn))
            h = new + z * (h - new)
            out[t] = h
        return out

    def pooled(self, hidden: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        u = np.tanh(hidden @ self.p["a"])
        s = np.where(real.T, u @ self.p["v"], np.float32(-1e9))
        e = np.exp(s - s.max(0))
        alpha = e / e.sum(0)
        return u, alpha, np.einsum("tn,tnh->nh", alpha, hidden)

    def logits(self, gates: tuple[np.ndarray, np.ndarray], at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), np.float32)
        for i in range(0, len(at), TOGETHER):
            part = at[i : i + TOGETHER]
            hidden = np.concatenate([self.states(g, part, d) for g, d in zip(gates, "fb", strict=True)], 2)
            out[i : i + TOGETHER] = self.pooled(hidden, part < len(gates[0]) - 1)[2] @ self.p["o"] + self.p["k"]
        return out

    def gradients(self, words: Words, at: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean logistic loss over windows of rows into ``words``."""
        p, x = self.p, self.inputs(words)
        n, length = at.shape
        traces: dict[str, list] = {"f": [], "b": []}
        gates = {d: self.gates(x, d) for d in "fb"}
        hidden = np.concatenate([self.states(gates[d], at, d, traces[d]) for d in "fb"], 2)
        u, alpha, pool = self.pooled(hidden, at < len(x))
        out = pool @ p["o"] + p["k"]
        dout = ((_sigmoid(out) - y) * weight / weight.sum()).astype(np.float32)
        g = {"o": pool.T @ dout, "k": dout.sum(keepdims=True)}
        dpool = dout[:, None] * p["o"]
        dalpha = np.einsum("nh,tnh->tn", dpool, hidden)
        ds = alpha * (dalpha - (alpha * dalpha).sum(0))
        du = ds[..., None] * p["v"] * (1 - u * u)
        g["v"] = np.einsum("tn,tnk->k", ds, u)
        g["a"] = hidden.reshape(-1, 2 * HIDDEN).T @ du.reshape(-1, ATTEND)
        dhidden = alpha[..., None] * dpool + du @ p["a"].T
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            part = dhidden[..., k * HIDDEN : (k + 1) * HIDDEN]
            dh, uu = np.zeros((n, HIDDEN), np.float32), p[f"u{d}"]
            g[f"u{d}"] = np.zeros_like(uu)
            da = np.empty((length, n, 3 * HIDDEN), np.float32)
            for t, h, r, z, new, gn in reversed(traces[d]):
                dh = dh + part[t]
                dnew = dh * (1 - z) * (1 - new * new)
                dz = dh * (h - new) * z * (1 - z)
                dr = dnew * gn * r * (1 - r)
                da[t] = np.concatenate([dr, dz, dnew], 1)
                dg = np.concatenate([dr, dz, dnew * r], 1)
                g[f"u{d}"] += h.T @ dg
                dh = dh * z + dg @ uu.T
            table = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
            np.add.at(table, at.T.ravel(), da.reshape(-1, 3 * HIDDEN))
            table = table[:-1]
            g[f"w{d}"], g[f"c{d}"] = x.T @ table, table.sum(0)
            dx += table @ p[f"w{d}"].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], self.row["word"][words.word], dx[:, :EMBED])
        g["gram"] = np.zeros_like(p["gram"])
        rows = self.row["gram"][words.gram]
        known = np.flatnonzero(rows)
        np.add.at(g["gram"], rows[known], (dx[:, EMBED:] / words.count[:, None])[words.owner[known]])
        g["word"][0] = 0
        return g


def windows(ids: np.ndarray, pad: int) -> np.ndarray:
    """All overlapping windows of a text's words; a short or empty text has one, padded."""
    n = len(ids)
    count = max(1, -(-(n - WINDOW) // STEP) + 1)
    padded = np.concatenate([ids, np.full(WINDOW, pad, np.int32)])
    return padded[np.arange(count)[:, None] * STEP + np.arange(WINDOW)]


def _number(texts: Iterable[list[bytes]]) -> tuple[list[bytes], list[np.ndarray]]:
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    ids = [np.fromiter(map(known.__getitem__, words), np.int32, len(words)) for words in texts]
    return list(known), ids


def scores(net: Network, texts: list[str | None]) -> np.ndarray:
    """Probability for each whole text: the calibrated logit of its most toxic window."""
    vocabulary, ids = _number(words_of(x) for x in texts)
    x = net.inputs(Words.of(vocabulary))
    cut_up = [windows(i, len(vocabulary)) for i in ids]
    logits = net.logits((net.gates(x, "f"), net.gates(x, "b")), np.concatenate(cut_up))
    starts = np.concatenate([[0], np.cumsum([len(c) for c in cut_up])[:-1]])
    top = np.maximum.reduceat(logits, starts).astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(net.scale * top + net.shift, -500, 500)))


def fit(texts: list[str | None], labels: np.ndarray, prior: float | None = None, rounds: int = ROUNDS) -> Network:
    """Trains on whole-text labels: in each round a text stands by its window with the highest logit.

    The first round takes windows at random; later ones give a text's own top
    window and, for clean texts, another at random.  Then a logistic fit of the
    top logits calibrates the score; ``prior`` is the share of toxic texts
    among all labelled ones, if the sample has another.  Without both labels
    the network stays as drawn and the score is the prior.
    """
    net, rng = Network.fresh(), np.random.default_rng(SEED)
    labels = labels.astype(np.float32)
    share = float(labels.mean()) if len(labels) else 0.5
    prior = share if prior is None else prior
    if len(labels) == 0 or share in (0.0, 1.0):
        net.scale, net.shift = 0.0, float(np.log((prior + 1e-3) / (1 - prior + 1e-3)))
        return net
    vocabulary, ids = _number(words_of(x) for x in texts)
    pad = len(vocabulary)
    all_words, bounds = Words.in_order(vocabulary)
    net.keep_common(all_words, ids, bounds)
    each = [windows(i, pad) for i in ids]
    flat, starts = np.concatenate(each), np.concatenate([[0], np.cumsum([len(w) for w in each])])
    del each, ids, vocabulary
    weight_of = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0

    def tops() -> tuple[np.ndarray, np.ndarray]:
        x = np.concatenate([net.inputs(all_words.take(np.arange(a, min(a + BLOCK, pad)), bounds)) for a in range(0, max(pad, 1), BLOCK)])
        logits = net.logits((net.gates(x, "f"), net.gates(x, "b")), flat)
        best = np.array([a + int(logits[a:b].argmax()) for a, b in zip(starts[:-1], starts[1:], strict=True)])
        return best, logits[best]

    chance = lambda of: (starts[of] + rng.random(len(of)) * (starts[of + 1] - starts[of])).astype(np.int64)
    everyone, clean = np.arange(len(labels)), np.flatnonzero(labels == 0)
    passes = int(np.clip(STEPS * BATCH // (rounds * 2 * len(labels)), 1, 12))
    for turn in range(rounds):
        best = tops()[0] if turn >= WARM else None
        for _ in range(passes):
            one, other = (chance(everyone), everyone) if best is None else (best, clean)
            picks, owner = np.concatenate([one, chance(other)]), np.concatenate([everyone, other])
            mixed = rng.permutation(len(picks))
            for i in range(0, len(mixed), BATCH):
                chosen = mixed[i : i + BATCH]
                at, of = flat[picks[chosen]].copy(), owner[chosen]
                at[rng.random(at.shape) < HIDE] = pad
                used, inverse = np.unique(at, return_inverse=True)
                inverse = inverse.reshape(at.shape)
                if used[-1] == pad:
                    used = used[:-1]
                g = net.gradients(all_words.take(used, bounds), inverse, labels[of], weight_of[of])
                step += 1
                rate = LEARN_RATE * (1 - 0.8 * turn / rounds) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                for k, v in net.p.items():
                    m, s = moment[k]
                    m += np.float32(0.1) * (g[k] - m)
                    s += np.float32(0.001) * (g[k] * g[k] - s)
                    v -= np.float32(rate) * (m / (np.sqrt(s) + np.float32(1e-8)) + np.float32(DECAY) * v)
    top = tops()[1].astype(np.float64)
    weight = np.where(labels > 0, prior / share, (1 - prior) / (1 - share))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton's method, held back a little
        q = 1 / (1 + np.exp(-(a * top + b)))
        r, h = weight * (q - labels), weight * q * (1 - q)
        grad = np.array([(r * top).sum() + 0.01 * (a - 1), r.sum()])
        hess = np.array([[(h * top * top).sum() + 0.01, (h * top).sum()], [(h * top).sum(), h.sum() + 0.01]])
        move = np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
        a, b = a - move[0], b - move[1]
    net.scale, net.shift = max(float(a), 0.05), float(b)
    return net


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, toxic: int = FIT_TOXIC, clean: int = FIT_CLEAN) -> Network:
    """Fits the network on a bounded sample of labelled documents that are not held out.

    Of either label, those with the smallest hashes of their ids, ``toxic``
    and ``clean`` of them at most; a row with more than one label is toxic if
    any says so; rows without an id or a label teach nothing; of rows that
    repeat an id the least text does.  Whole texts of at most ``toxic`` and
    ``clean`` rows come to the driver.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), modulus, remainder))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    prior = known.agg(F.avg("label")).first()[0]
    first = lambda label, n: lowest(known.where(F.col("label") == label), n, "doc_id")
    sample = first(1, toxic).unionByName(first(0, clean))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    got = rows.orderBy("doc_id").toArrow()
    return fit(got.column("text").to_pylist(), got.column("label").to_numpy(), prior)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """Rows (doc_id, score) for every document; null texts count as empty, repeated rows are scored each."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([ID, T.StructField("score", T.DoubleType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = scores(sent.value, batch.column("text").to_pylist())
        return pa.record_batch([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(in_batches(run, 2500, SLICE_BYTES), schema)
