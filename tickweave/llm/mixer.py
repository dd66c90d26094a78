"""Context mixing of documents that one task holds: bit predictors, gated weights, adaptive refinement.

``lm`` takes tokens, gates, the tree and the mixer from here and the rest of the
whole corpus from ``corpus``; ``score`` is the model where one task has it all.

A token is coded as binary decisions: first, where a context of words names a
successor, whether it is that one; if not, the way down a binary tree over the
shard's words, balanced by their counts in the whole corpus.  Every decision is
a bit, predicted by

* the counts of the whole corpus,
* the shard's counts under the document's gate,
* what followed the same two words in other documents (a hashed context),
* what followed the same two words before in this document.

The predictions are mixed in the logistic domain with weights selected by which
contexts spoke and how deep the decision is; the weights are learned online.
A map from mixed to seen probabilities, kept for each set of weights, refines
the result.  Words that no other document has are coded as an escape and then
spelled, again bit by bit from hashed contexts.

All numbers here are log-odds for the decision that was taken, so a prediction
that says the contrary is negative.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import xxhash

GATES = 32
#: Weight of the whole corpus's share in a gate's prediction, in tokens.
BACKING = 12.0
#: Gates of weights: depths of a decision in the tree, and which contexts spoke.
DEPTHS, KINDS = 16, 6
#: Units (tokens, or equal ones) learned from at once, least steps, and the learning rate.
BATCH, STEPS, RATE = 1024, 150, 0.06
#: Bins of the refining map, for each half of log-odds.
BINS, HALF = 49, 24
#: Units priced at once.
TOGETHER = 1 << 13
_MULT, _MULT2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def tokens(data: bytes | None) -> list[bytes]:
    """Words in lower case, then the end, which is the one token without bytes."""
    found = (data or b"").lower().split()
    found.append(b"")
    return found


def gate(counts: Counter) -> int:
    """Of the most frequent word (of equals the first in byte order); a document without words has gate 0."""
    most = max(counts.values(), default=0)  # the end stands once, so where it has the most, words have as many or there are none
    best = min((word for word, n in counts.items() if n == most and word), default=b"")
    h = 0
    for x in best:
        h = (h * 1_000_003 + x + 1) & 0xFFFFFFFF
    return (h * 2654435761 >> 7) % GATES


# --- spelling ---------------------------------------------------------------

END = 256
CONTEXTS = 4
PLACES = 64


@dataclass
class Codes:
    """Huffman codes of the 256 bytes and the end of a word: bits and, for each bit, the code so far with a leading one."""

    length: np.ndarray
    bits: np.ndarray
    node: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Codes:
        heap = [(int(n) + 1, i, (i,)) for i, n in enumerate(counts)]
        heapq.heapify(heap)
        code: list[list[int]] = [[] for _ in counts]
        while len(heap) > 1:
            (n, i, low), (m, _, high) = heapq.heappop(heap), heapq.heappop(heap)
            for bit, side in ((0, low), (1, high)):
                for symbol in side:
                    code[symbol].append(bit)
            heapq.heappush(heap, (n + m, i, low + high))
        length = np.array([len(c) for c in code])
        bits = np.zeros((len(code), length.max()), np.int8)
        node = np.zeros((len(code), length.max()), np.int64)
        for symbol, c in enumerate(code):
            at = 1
            for k, bit in enumerate(reversed(c)):
                bits[symbol, k], node[symbol, k] = bit, at
                at = at * 2 + bit
                at = at if at < 1 << 40 else at ^ (at >> 20)
        return cls(length, bits, node)


@dataclass
class Bits:
    """The bits of words, all words at once: their value, the slots of their contexts, and the set of weights."""

    word: np.ndarray
    value: np.ndarray
    slots: np.ndarray
    select: np.ndarray


def spell(words: list[bytes], codes: Codes, slot_bits: int) -> Bits:
    """Contexts: the last one to three bytes of the word so far, and where in the word one is; the word's start is a byte of its own."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    text = np.full(int(size.sum()), END, np.int64)
    ends = np.cumsum(size)
    inner = np.ones(len(text), bool)
    inner[ends - 1] = False
    text[inner] = np.frombuffer(b"".join(words), np.uint8)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    place = np.arange(len(text)) - (ends - size)[owner]
    n = len(text)
    back = []
    for k in range(1, CONTEXTS):
        b = np.full(n, END, np.uint64)
        b[k:] = text[:-k] if k < n else b[k:]
        b[place < k] = END
        back.append(b + np.uint64(1))
    hashes = [np.minimum(place, 12).astype(np.uint64) * np.uint64(7919) + back[0] * np.uint64(1 << 9)]
    h = np.zeros(n, np.uint64)
    for k, b in enumerate(back):
        h = (h + b) * np.uint64(1_000_003)
        hashes.append(h + np.uint64(k + 1))
    length = codes.length[text]
    at = np.repeat(np.arange(n, dtype=np.int32), length)
    k = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    node = codes.node[text[at], k].astype(np.uint64) * _MULT2
    slots = np.empty((CONTEXTS, len(at)), np.int32)
    for i, own in enumerate(hashes):
        x = ((own + np.uint64(i * 0x51ED)) * _MULT)[at] ^ node
        slots[i] = ((x ^ (x >> np.uint64(31))) * _MULT >> np.uint64(64 - slot_bits)).astype(np.int32)
    select = (np.minimum(place[at], 3) * 16 + np.minimum(k, 15)).astype(np.int32)
    return Bits(owner[at], codes.bits[text[at], k], slots, select)


def _spelled(bits: Bits, table: np.ndarray, leave_out: bool) -> np.ndarray:
    """Log-odds of a one from each context's counts, and a constant; a bit's own count is left out for learning."""
    out = np.empty((CONTEXTS + 1, len(bits.value)), np.float32)
    out[-1] = 0.3
    one = bits.value.astype(np.float32)
    for i in range(CONTEXTS):
        n0, n1 = table[0][bits.slots[i]], table[1][bits.slots[i]]
        if leave_out:
            n0, n1 = np.maximum(n0 - (1 - one), 0), np.maximum(n1 - one, 0)
        out[i] = np.log((n1 + np.float32(0.4)) / (n0 + np.float32(0.4)))
    return out


class Speller:
    """Counts and weights from distinct words, each once; every word is learned with its own counts left out.

    ``own`` has what each of these words cost when it was learned last.
    """

    def __init__(self, words: list[bytes], group: int = 1024, step: float = 0.05) -> None:
        counts = np.bincount(np.frombuffer(b"".join(words), np.uint8), minlength=257)
        counts[END] = len(words)
        self.codes = Codes.of(counts)
        self.slot_bits = int(np.clip(math.ceil(math.log2(max(8 * len(words), 1))), 14, 24))
        self.table = np.zeros((2, 1 << self.slot_bits), np.float32)
        self.weights = np.full((PLACES, CONTEXTS + 1), 0.3)
        for i in range(0, len(words), group):
            bits = spell(words[i : i + group], self.codes, self.slot_bits)
            for value in (0, 1):
                np.add.at(self.table[value], bits.slots[:, bits.value == value].ravel(), np.float32(1))
        rounds = max(1, math.ceil(24 / max(1, math.ceil(len(words) / group)))) if words else 0
        ahead, self.own = np.random.default_rng(7).permutation(len(words)), np.zeros(len(words))
        for _ in range(rounds):
            for i in range(0, len(words), group):
                now = ahead[i : i + group]
                bits = spell([words[k] for k in now], self.codes, self.slot_bits)
                x = _spelled(bits, self.table, True)
                p = 1 / (1 + np.exp(-np.clip(self._dot(bits, x), -25, 25)))
                error = bits.value - p
                self.own[now] = -np.bincount(bits.word, np.log(1 - np.abs(error)), len(now))
                count = np.maximum(np.bincount(bits.select, minlength=PLACES), 1)
                for k in range(CONTEXTS + 1):
                    self.weights[:, k] += step * np.bincount(bits.select, error * x[k], PLACES) / count

    def _dot(self, bits: Bits, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bits.value), np.float32)
        for k, w in enumerate(self.weights.T.astype(np.float32)):
            out += w[bits.select] * x[k]
        return out

    def nats(self, words: list[bytes]) -> np.ndarray:
        """Cost of words that weren't learned from."""
        out = np.zeros(len(words))
        for i in range(0, len(words), 2048):
            part = words[i : i + 2048]
            bits = spell(part, self.codes, self.slot_bits)
            dot = np.clip(self._dot(bits, _spelled(bits, self.table, False)), -25, 25).astype(np.float64)
            out[i : i + 2048] = np.bincount(bits.word, np.log1p(np.exp(np.where(bits.value == 1, -dot, dot))), len(part))
        return out


# --- decisions --------------------------------------------------------------


class Tree:
    """A binary tree over symbols in order, balanced by weight.  A node is named by where it splits its range of symbols."""

    def __init__(self, weights: np.ndarray) -> None:
        n = len(weights)
        self.cum = np.concatenate([[0.0], np.cumsum(weights, dtype=np.float64)])
        self.low, self.high = np.zeros(n, np.int32), np.full(n, n, np.int32)
        symbol, a, b = np.arange(n, dtype=np.int32), np.zeros(n, np.int32), np.full(n, n, np.int32)
        levels = []
        self.length = np.zeros(n, np.int32)
        while len(symbol):
            begins = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))  # of each range once
            low, high = a[begins], b[begins]
            m = np.clip(np.searchsorted(self.cum, (self.cum[low] + self.cum[high]) / 2), low + 1, high - 1).astype(np.int32)
            self.low[m], self.high[m] = low, high
            m = np.repeat(m, np.diff(np.append(begins, len(a))))
            right = symbol >= m
            levels.append((symbol, m, right))
            self.length[symbol] += 1
            a, b = np.where(right, m, a), np.where(right, b, m)
            more = b - a > 1
            symbol, a, b = symbol[more], a[more], b[more]
        self.start = (np.cumsum(self.length) - self.length).astype(np.int32)
        self.node, self.right = np.empty(int(self.length.sum()), np.int32), np.empty(int(self.length.sum()), bool)
        for depth, (symbol, m, right) in enumerate(levels):
            self.node[self.start[symbol] + depth], self.right[self.start[symbol] + depth] = m, right
        del levels
        share = self._sides(self.cum)
        self.share = share[1] / (share[0] + share[1])
        self.share[0] = 0.5  # no node
        self.backing = np.clip(BACKING * self.share, 1e-6, BACKING - 1e-5).astype(np.float32)
        own = np.log(self.share / (1 - self.share)).astype(np.float32)[self.node]
        self.static = np.where(self.right, own, -own)

    def _sides(self, cum: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = np.arange(len(self.low))
        return np.maximum(cum[m] - cum[self.low], 0), np.maximum(cum[self.high] - cum[m], 0)

    def odds(self, counts: np.ndarray) -> np.ndarray:
        """Log-odds of going right at each node from counts of symbols, backed by the whole corpus's shares."""
        cum = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        at = cum[: len(self.low)]
        left, right = (at - cum[self.low]).astype(np.float32), (cum[self.high] - at).astype(np.float32)
        return np.log((right + self.backing) / (left + (np.float32(BACKING) - self.backing)))


def _mix2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a.astype(np.uint64) + np.uint64(1)) * _MULT ^ (b.astype(np.uint64) + np.uint64(1)) * _MULT2
    return (h ^ (h >> np.uint64(32))) * _MULT


def followers(context: np.ndarray, symbol: np.ndarray, doc: np.ndarray, learns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the symbol that followed its hashed context in another document that is learned from, and a grade.

    A slot keeps its first and its last writer.  Grades: 0 none, 1 one of them
    only, 2 both and they agree, 3 both and they don't (the last one counts).
    """
    bits = int(np.clip(math.ceil(math.log2(max(1.5 * len(context), 2))), 10, 26))
    slot = (context >> np.uint64(64 - bits)).astype(np.int32)
    tag = (context & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    at = np.flatnonzero(learns).astype(np.int32)
    other = []
    for order in (at, at[::-1]):
        writer = np.full(1 << bits, -1, np.int32)
        writer[slot[order]] = order
        w = writer[slot]
        ok = (w >= 0) & (tag[np.maximum(w, 0)] == tag) & (doc[np.maximum(w, 0)] != doc)
        other.append(np.where(ok, symbol[np.maximum(w, 0)], -1).astype(np.int32))
    last, first = other
    found = np.where(last >= 0, last, first)
    both = (last >= 0) & (first >= 0)
    grade = np.where(both, np.where(last == first, 2, 3), (found >= 0).astype(np.int8)).astype(np.int8)
    return found, grade


def before(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """For each place the symbol that followed the same hash last time before, else -1."""
    order = np.argsort(context, kind="stable")
    same = context[order][1:] == context[order][:-1]
    out = np.full(len(context), -1, np.int32)
    out[order[1:][same]] = symbol[order[:-1][same]]
    return out


class Mixer:
    """Weights of ``sets`` gates over ``inputs`` predictions, learned online, and the map that refines what they give."""

    def __init__(self, start: list[float], sets: int) -> None:
        self.sets = sets
        self.weights = np.tile(np.array(start, np.float32), (sets, 1))
        self.seen = np.ones((sets, BINS))

    def _dot(self, select: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(select), np.float32)
        for k in range(len(x)):
            out += self.weights[:, k][select] * x[k]
        return np.clip(out, -20, 20)

    def learn(self, select: np.ndarray, x: np.ndarray, many: np.ndarray, rate: float) -> None:
        """One step on decisions that count ``many`` times; where they fell is noted for the map."""
        z = self._dot(select, x)
        error = many / (1 + np.exp(z))  # 1 - p
        weight = np.bincount(select, many, self.sets) + 20
        for k in range(len(x)):
            self.weights[:, k] += (rate * np.bincount(select, error * x[k], self.sets) / weight).astype(np.float32)
        self.seen += np.bincount(select * BINS + _bin(z), many, self.sets * BINS).reshape(self.sets, BINS)

    def nats(self, select: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Cost of each decision: mixed log-odds and those of the refining map, half and half.

        A decision at odds z is the contrary one at -z, so the map's odds are
        those of what was seen at z against what was seen at -z.
        """
        refined = np.log(self.seen / self.seen[:, ::-1]).astype(np.float32)
        z = self._dot(select, x)
        return np.log1p(np.exp(-(z + refined[select, _bin(z)]) / 2))


def _bin(z: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(z * 2), -HALF, HALF).astype(np.int32) + HALF


def _schedule(n: int) -> list[tuple[int, float]]:
    """(start of a batch, rate) over n units, again and again until enough steps are made."""
    starts = list(range(0, n, BATCH))
    steps = max(STEPS, len(starts)) if starts else 0
    return [(starts[k % len(starts)], RATE / (1 + 3 * k / steps)) for k in range(steps)]


def code(tree: Tree, odds: np.ndarray, gates: np.ndarray, symbol: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Cost of each symbol under its gate, coded down the tree by the corpus's and the gate's counts (``odds`` has a row for each gate); ``many`` tokens learn of each."""
    mixer = Mixer([0.3, 0.7], DEPTHS)

    def inputs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        length = tree.length[symbol[at]]
        of = np.repeat(np.arange(len(at), dtype=np.int32), length)
        depth = np.arange(len(of), dtype=np.int32) - np.repeat((np.cumsum(length) - length).astype(np.int32), length)
        path = tree.start[symbol[at]][of] + depth
        own = odds[gates[at][of], tree.node[path]]
        return of, np.minimum(depth, DEPTHS - 1), np.stack([tree.static[path], np.where(tree.right[path], own, -own)])

    taught = np.flatnonzero(many > 0)
    taught = taught[np.random.default_rng(5).permutation(len(taught))]
    for start, rate in _schedule(len(taught)):
        at = taught[start : start + BATCH]
        of, select, x = inputs(at)
        mixer.learn(select, x, many[at][of], rate)
    out = np.zeros(len(symbol))
    for i in range(0, len(out), TOGETHER):
        at = np.arange(i, min(i + TOGETHER, len(out)))
        of, select, x = inputs(at)
        out[at] = np.bincount(of, mixer.nats(select, x), len(at))
    return out


def guess(symbol: np.ndarray, guesses: np.ndarray, kind: np.ndarray, learns: np.ndarray, share_of) -> tuple[np.ndarray, np.ndarray]:
    """(cost, whether it was met) of asking for each token whether it is what a context says, one guess after the other.

    ``guesses`` has a row for each context, -1 where it is silent; a guess that
    was denied isn't made again.  Inputs of a decision are the log-odds of the
    guessed symbol in the corpus and under the gate, and for each context
    whether it says this symbol (1), another (-1) or nothing.
    """
    cost, met = np.zeros(len(symbol)), np.zeros(len(symbol), bool)
    mixer = Mixer([0.3, 0.3, *[2.0] * len(guesses), 0.0], KINDS * len(guesses))
    asked = []
    for k, said in enumerate(guesses):
        open_ = (said >= 0) & ~met
        for earlier in guesses[:k]:
            open_ &= earlier != said
        at = np.flatnonzero(open_)
        hit = said[at] == symbol[at]
        asked.append((k, at, hit))
        met[at[hit]] = True
    where = np.concatenate([at for _, at, _ in asked])
    hits = np.concatenate([hit for _, _, hit in asked])
    turn = np.concatenate([np.full(len(at), k, np.int32) for k, at, _ in asked])
    said = guesses[turn, where]
    corpus, own = share_of(said, where)
    x = np.stack([_logit(corpus), _logit(own), *(np.where(g[where] < 0, 0, np.where(g[where] == said, 1, -1)) for g in guesses), np.ones(len(said))]).astype(np.float32)
    x *= np.where(hits, np.float32(1), np.float32(-1))
    select = turn * KINDS + kind[where]
    taught = np.flatnonzero(learns[where])
    taught = taught[np.random.default_rng(6).permutation(len(taught))]
    for start, rate in _schedule(len(taught)):
        at = taught[start : start + BATCH]
        mixer.learn(select[at], x[:, at], np.ones(len(at)), rate * 4)
    cost += np.bincount(where, mixer.nats(select, x), len(symbol))
    return cost, met


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p)) / 8


# --- a shard ----------------------------------------------------------------


@dataclass
class Corpus:
    """Figures of all training documents: tokens, distinct tokens, and tokens that occur once."""

    tokens: int
    distinct: int
    once: int


def _own(words: list[bytes], ids: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(gate of each document, how often each place's token occurs in its document); the words are in byte order."""
    key = doc.astype(np.int64) * len(words) + ids
    order = np.argsort(key)
    fresh = np.concatenate([[True], np.diff(key[order]) > 0])
    first = np.flatnonzero(fresh)
    many = np.diff(np.append(first, len(key)))
    own = np.empty(len(ids), np.int32)
    own[order] = np.repeat(many, many)
    of, token = doc[order[first]], ids[order[first]]
    del key, order
    empty = np.array([not w for w in words[:1]] + [False] * (len(words) - 1))
    begins = np.flatnonzero(np.concatenate([[True], np.diff(of) > 0]))
    weight = np.where(empty[token], 0, many)
    top = np.repeat(np.maximum.reduceat(weight, begins), np.diff(np.append(begins, len(of))))
    best = np.minimum.reduceat(np.where(weight == top, token, len(words)), begins)
    named: dict[int, int] = {}
    gates = np.zeros(docs, np.int8)
    for k, x in zip(of[begins], best, strict=True):
        if x not in named:
            named[x] = gate(Counter({words[x]: 1}))
        gates[k] = named[x]
    return gates, own


def score(words: list[bytes], count: np.ndarray, side: np.ndarray, texts: list[tuple[bool, np.ndarray]], corpus: Corpus) -> list[tuple[int, float, float]]:
    """(known tokens, base score, score), in log10, for every (held, places of its tokens in ``words``) of a shard.

    ``words`` are distinct and in byte order, so the end comes first.  ``count`` is each word's number in the whole training corpus, ``side`` the
    gate under which it occurs most.  A training document is scored as if it
    weren't one: its own tokens are taken from the corpus's counts, contexts
    speak from other documents alone, and a word that only it has is spelled.
    Copies have one score.
    """
    order = np.lexsort((np.arange(len(words)), -count, side))
    known = order[count[order] > 0]
    rest = max(1.0, corpus.tokens - float(count.sum()))
    tree = Tree(np.concatenate([count[known].astype(np.float64), [max(1.0, corpus.once), rest]]))
    escape, n = len(known), len(known) + 2
    symbol_of = np.full(len(words), escape, np.int32)
    symbol_of[known] = np.arange(len(known))

    sizes = np.array([len(x) for _, x in texts])
    ids = np.concatenate([x for _, x in texts])
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    gates, own = _own(words, ids, doc, len(texts))
    held = np.array([h for h, _ in texts])
    learns = ~held[doc]
    own[~learns] = 0
    own_gate = gates[doc]
    all_counts = count[ids]
    truly = symbol_of[ids]  # what is learned from: never an escape, as training has every word of its own
    symbol = np.where(all_counts > own, truly, escape).astype(np.int32)
    at_gate = [np.flatnonzero(own_gate == g).astype(np.int32) for g in range(GATES)]
    in_gate = [np.bincount(truly[at[learns[at]]], minlength=n).astype(np.int32) if len(at) else None for at in at_gate]

    first = np.zeros(len(ids), bool)
    first[np.cumsum(sizes) - sizes] = True
    one = np.concatenate([[-1], ids[:-1]]).astype(np.int64)
    one[first] = -1
    two = np.concatenate([[-1], one[:-1]])
    two[first] = -1
    context = _mix2(one, two)
    far, grade = followers(context, truly, doc, learns)
    here = before(context ^ doc.astype(np.uint64) * _MULT2, symbol)
    del context, one, two
    far[grade == 3] = -1
    grade[grade == 3] = 0
    kind = grade + 3 * (here >= 0)
    speak = np.flatnonzero(kind)

    def share_of(said: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        share = (tree.cum[said + 1] - tree.cum[said]) / tree.cum[-1]
        own_share = np.zeros(len(said))
        under = own_gate[speak[where]]
        for g in np.unique(under):
            at = under == g
            own_share[at] = (in_gate[g][said[at]] + BACKING * share[at]) / (in_gate[g].sum() + BACKING)
        return share, own_share

    asked, hit = guess(symbol[speak], np.stack([here[speak], far[speak]]), kind[speak].astype(np.int32), learns[speak], share_of)
    del far, here, kind
    cost = np.zeros(len(ids))
    cost[speak] = asked
    coded = np.ones(len(ids), bool)
    coded[speak[hit]] = False
    parts = []
    here = [g for g in range(GATES) if len(at_gate[g])]
    for k, g in enumerate(here):
        at = at_gate[g] = at_gate[g][coded[at_gate[g]]]
        used = np.flatnonzero(np.bincount(symbol[at], minlength=n)).astype(np.int32)
        parts.append((np.full(len(used), k, np.int8), used, np.bincount(symbol[at[learns[at]]], minlength=n)[used]))
    under, used, taught = (np.concatenate(x) for x in zip(*parts, strict=True))
    odds = np.empty((len(here), n), np.float32)
    for k, g in enumerate(here):
        odds[k] = tree.odds(in_gate[g])
    paid = code(tree, odds, under, used, taught)
    ends = np.cumsum([len(x) for x, _, _ in parts])
    price = np.zeros(n)
    for g, (_, mine, _), end in zip(here, parts, ends, strict=True):
        price[mine] = paid[end - len(mine) : end]
        cost[at_gate[g]] += price[symbol[at_gate[g]]]
    del parts, at_gate, in_gate, odds, under, used, taught, paid
    left = (own > 0) & (symbol != escape)
    cost[left] -= np.log((all_counts[left] - own[left]) / all_counts[left])  # its own tokens aren't in the corpus

    spelled = symbol == escape
    if spelled.any():
        once = [i for i in known if count[i] == 1]
        speller = Speller([words[i] for i in once])
        price = np.zeros(len(words))
        price[once] = speller.own
        needed = np.unique(ids[spelled])
        needed = needed[count[needed] != 1]
        price[needed] = speller.nats([words[i] for i in needed])
        cost[spelled] += price[ids[spelled]]
    base = np.log10((all_counts + 1) / (corpus.tokens + corpus.distinct + 1))
    seen = np.bincount(gates[~held], minlength=GATES)
    entry = np.log10((seen[gates] + 0.5) / (seen.sum() + 0.5 * GATES))
    total = -np.bincount(doc, cost, len(texts)) / math.log(10) + entry
    # copies see different ones of each other first and last: each gets their mean
    same: dict[tuple[bool, bytes], int] = {}
    group = np.array([same.setdefault((h, xxhash.xxh128_digest(x)), len(same)) for h, x in texts])
    total = (np.bincount(group, total) / np.bincount(group))[group]
    return list(zip(np.bincount(doc, all_counts > 0, len(texts)).astype(int).tolist(), np.bincount(doc, base, len(texts)).tolist(), total.tolist(), strict=True))
