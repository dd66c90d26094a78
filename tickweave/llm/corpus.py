"""What a shard asks of the whole corpus, the parts that answer, and the decisions that are priced with what all shards saw.

A shard is what one task takes in at a time.  It asks two things of the parts
that its words and contexts hash to: how often all training documents have each
word, under which gates, and what follows each pair of words in them.  With the
answers every token of the shard is a row of binary decisions, each in a cell:
a guess by what its context said, its support and the guesses before; an unknown
word by those before; a way down the tree of words by depth and the log-odds of
corpus and gate.  Cells of all training documents are summed, and weights and
maps of ``mixer`` are learned from these sums.
"""

from __future__ import annotations

import math
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from tickweave.llm import mixer
from tickweave.llm.mixer import GATES

WORDS, CONTEXTS, DISTINCT = 0, 1, 2
MASK = (1 << 24) - 1
#: Cells: guesses (turn, support, share, agreement, three outcomes before, outcome), unknown words (three before, outcome), ways in the tree.
GUESSES, UNKNOWN = 2 * 5 * 3 * 3 * 8 * 2, 8 * 2
STATIC, OWN = 25, 49
TREE = GUESSES + UNKNOWN
CELLS = TREE + mixer.DEPTHS * STATIC * OWN
#: Places whose ways in the tree are laid out at once.
AT_ONCE = 1 << 15


def pack(*columns: bytes) -> bytes:
    body = b"".join(columns)
    return struct.pack(f"<I{len(columns)}Q", len(columns), *map(len, columns)) + pa.compress(body, "zstd", asbytes=True)


def unpack(data: bytes) -> list[bytes]:
    n = struct.unpack_from("<I", data)[0]
    sizes = struct.unpack_from(f"<{n}Q", data, 4)
    body = pa.decompress(data[4 + 8 * n :], sum(sizes), "zstd", asbytes=True) if sum(sizes) else b""
    ends = np.cumsum(sizes).tolist()
    return [body[e - s : e] for s, e in zip(sizes, ends, strict=True)]


def small(x: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers that mostly fit in a byte."""
    return np.minimum(x, 255).astype(np.uint8).tobytes(), x[x >= 255].astype("<i8").tobytes()


def large(one: bytes, more: bytes) -> np.ndarray:
    out = np.frombuffer(one, np.uint8).astype(np.int64)
    out[out == 255] = np.frombuffer(more, "<i8")
    return out


def three(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def from_three(data: bytes) -> np.ndarray:
    x = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int64)
    return x[:, 0] | x[:, 1] << 8 | x[:, 2] << 16


def rounded(n: np.ndarray) -> np.ndarray:
    """Counts in a byte: exact below 16, else to an eighth."""
    n = np.minimum(n, (1 << 33) - 1)
    e = np.maximum(np.frexp(n.astype(np.float64))[1] - 1, 4)
    return np.where(n < 16, n, 16 + (e - 4) * 8 + ((n >> (e - 3)) & 7)).astype(np.uint8)


def restored(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.int64)
    e = (code - 16) // 8 + 4
    return np.where(code < 16, code, ((8 + (code - 16) % 8) << np.maximum(e - 3, 0)) + ((1 << np.maximum(e - 3, 0)) >> 1))


def hash_bits(total: int) -> int:
    """Bits of a context's hash: so many more than the corpus's bytes that about one context in 2^15 meets another."""
    return min(60, max(32, math.ceil(math.log2(total + 1)) + 13))


def part_of(key: np.ndarray, bits: int, parts: int) -> np.ndarray:
    return ((key >> np.uint64(bits - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def part_begins(part: int, bits: int, parts: int) -> int:
    return -(-(part << 32) // parts) << (bits - 32)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _order(key: np.ndarray, most: int) -> np.ndarray:
    """Stable order of numbers up to ``most``: sorted with their places where both fit in 64 bits, which is faster."""
    bits = int(len(key)).bit_length()
    if most.bit_length() + bits > 64:
        return np.argsort(key, kind="stable")
    packed = key.astype(np.uint64) << np.uint64(bits)
    packed |= np.arange(len(key), dtype=np.uint64)
    packed.sort()
    packed &= np.uint64((1 << bits) - 1)
    return packed.astype(np.int32)


@dataclass
class Shard:
    """Documents as numbers of distinct words; ``gates`` of documents, ``sizes`` in tokens."""

    words: list[bytes]
    ids: np.ndarray
    sizes: np.ndarray
    held: np.ndarray
    gates: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], held: list[bool]) -> Shard:
        place: dict[bytes, int] = {}
        ids = []
        for data in texts:
            found = mixer.tokens(data)
            for w in found:
                if w not in place:
                    place[w] = len(place)
            ids.append(np.fromiter(map(place.__getitem__, found), np.int32, len(found)))
        sizes, all_ids, words = np.array([len(x) for x in ids]), np.concatenate(ids), list(place)
        del place, ids
        order = np.argsort(-np.bincount(all_ids, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        words, all_ids = [words[i] for i in order], rank[all_ids]
        return cls(words, all_ids, sizes, np.array(held, bool), _gates(words, all_ids, sizes))

    def dump(self) -> bytes:
        planes = np.ascontiguousarray(self.ids.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()
        return pack(b"\n".join(self.words), planes, self.sizes.astype("<i8").tobytes(), self.held.tobytes(), self.gates.tobytes())

    @classmethod
    def load(cls, data: bytes) -> Shard:
        words, planes, sizes, held, gates = unpack(data)
        ids = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()
        return cls(words.split(b"\n"), ids, np.frombuffer(sizes, "<i8"), np.frombuffer(held, bool), np.frombuffer(gates, np.int8))

    def lay_out(self, parts: int, bits: int) -> None:
        """Hashes of words and contexts, and the order in which they are asked."""
        self.doc = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.hash = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words), np.uint64, len(self.words))
        part = ((self.hash >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        self.order = np.argsort(part, kind="stable")
        self.part = part[self.order]
        self.next = (self.hash >> np.uint64(40)).astype(np.int32)[self.ids]  # 24 bits of each token
        first = np.zeros(len(self.ids), bool)
        first[np.cumsum(self.sizes) - self.sizes] = True
        token = self.hash[self.ids]
        one = np.concatenate([[np.uint64(0)], token[:-1]])
        one[first] = 1
        two = np.concatenate([[np.uint64(0)], one[:-1]])
        two[first] = 2
        del token
        key = mixer._mix2(one, two) >> np.uint64(64 - bits)
        del one, two
        self.by = _order(key, (1 << bits) - 1)  # by context, then document
        key = key[self.by]
        at = _runs(key)
        self.keys = key[at]
        self.of = np.empty(len(key), np.int32)
        self.of[self.by] = np.repeat(np.arange(len(at), dtype=np.int32), np.diff(np.append(at, len(key))))
        doc = self.doc[self.by]
        self.shared = doc[at] != doc[np.append(at[1:], len(key)) - 1]
        self.key_part = part_of(self.keys, bits, parts)

    def asks(self, parts: int, bits: int) -> Iterator[tuple[int, int, bytes]]:
        """(part, kind, data); what training documents have is told in the same go."""
        self.lay_out(parts, bits)
        learns = ~self.held[self.doc]
        slot = np.empty(len(self.words), np.int64)
        slot[self.order] = np.arange(len(self.words))
        pair, n = _tally(slot[self.ids[learns]] * GATES + self.gates[self.doc[learns]])
        bitmap = np.zeros(len(self.words), np.uint32)
        np.bitwise_or.at(bitmap, pair // GATES, np.uint32(1) << (pair % GATES).astype(np.uint32))
        at = np.append(_runs(self.part), len(self.part))
        cut = np.searchsorted(pair // GATES, at)
        for a, b, c, d in zip(at[:-1], at[1:], cut[:-1], cut[1:], strict=True):
            yield int(self.part[a]), WORDS, pack(b"\n".join(self.words[i] for i in self.order[a:b]), bitmap[a:b].astype("<u4").tobytes(), *small(n[c:d]))
        taught = self.by[learns[self.by]]
        told, n = _tally(self.of[taught].astype(np.int64) << 24 | self.next[taught])
        silent = np.ones(len(self.keys), bool)
        silent[told >> 24] = False
        rows = np.concatenate([told, np.flatnonzero(silent) << 24])
        order = np.argsort(rows)
        rows, n = rows[order], np.concatenate([n, np.zeros(int(silent.sum()), np.int64)])[order]
        of = rows >> 24
        at = np.append(_runs(self.key_part), len(self.keys))
        cut = np.searchsorted(of, at)
        for a, b, c, d in zip(at[:-1], at[1:], cut[:-1], cut[1:], strict=True):
            part = int(self.key_part[a])
            key = (self.keys[a:b] - np.uint64(part_begins(part, bits, parts))).astype(np.int64)
            high = np.diff(key >> 16, prepend=0)
            each = np.diff(np.append(np.searchsorted(of[c:d], np.arange(a, b)), d - c))
            yield part, CONTEXTS, pack((key & 0xFFFF).astype("<u2").tobytes(), *small(high), *small(each * 2 + self.shared[a:b]), three(rows[c:d] & MASK), *small(n[c:d]))


def _gates(words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``mixer.gate`` of each document."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    pair = doc * len(words) + ids
    pair, many = _tally(pair[ids != words.index(b"")])
    doc, word = pair // len(words), pair % len(words)
    begins = _runs(doc)
    gates = np.full(len(sizes), mixer.gate(Counter()), np.int8)
    if not len(begins):
        return gates
    top = many == np.repeat(np.maximum.reduceat(many, begins), np.diff(np.append(begins, len(doc))))
    named: dict[bytes, int] = {}
    best: dict[int, bytes] = {}
    for d, w in zip(doc[top].tolist(), word[top].tolist(), strict=True):
        if d not in best or words[w] < best[d]:
            best[d] = words[w]
    for d, word_ in best.items():
        if word_ not in named:
            named[word_] = mixer.gate(Counter({word_: 1}))
        gates[d] = named[word_]
    return gates


def answer_words(asked: list[bytes]) -> tuple[list[bytes], int]:
    """Of each message's words the number in training and the gates that they have it from; and the number of distinct training words."""
    index: dict[bytes, int] = {}
    places, keys, counts = [], [], []
    for data in asked:
        words, bitmap, one, more = unpack(data)
        found = words.split(b"\n")
        place = np.fromiter((index.setdefault(w, len(index)) for w in found), np.int64, len(found))
        gate = np.unpackbits(np.frombuffer(bitmap, np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        word, g = np.nonzero(gate)
        places.append(place)
        keys.append(place[word] * GATES + g)
        counts.append(large(one, more))
    size = len(index)
    del index
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = _runs(key)
    key, n = key[at], np.add.reduceat(n, at) if len(at) else n
    total = np.bincount(key // GATES, n, size).astype(np.int64)
    begin = np.searchsorted(key // GATES, np.arange(size + 1))
    code = rounded(n)
    bitmap = np.zeros(size, np.uint32)
    np.bitwise_or.at(bitmap, key // GATES, np.uint32(1) << (key % GATES).astype(np.uint32))
    out = []
    for place in places:
        many = begin[place + 1] - begin[place]
        at = np.repeat(begin[place] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        out.append(pack(*small(total[place]), bitmap[place].astype("<u4").tobytes(), code[at].tobytes()))
    return out, int((total > 0).sum())


def answer_contexts(asked: list[bytes]) -> list[bytes]:
    """Of each message's contexts what follows most in training documents, how often, and how often anything does.

    Where one document alone of a shard has the context, what it told is left
    out; else the second best comes with it, for the shard to leave out.
    Equal successors are taken in order of their hashes.
    """
    told = []
    for data in asked:
        low, one, more, each, each_more, then, n, n_more = unpack(data)
        key = (np.cumsum(large(one, more)) << 16) + np.frombuffer(low, "<u2")
        each = large(each, each_more)
        told.append((key, each & 1 > 0, np.repeat(np.arange(len(key)), each >> 1), from_three(then), large(n, n_more)))
    pair = np.concatenate([key[of] << 24 | then for key, _, of, then, _ in told])
    n = np.concatenate([x[-1] for x in told])
    pair, n = pair[n > 0], n[n > 0]
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    at = _runs(pair)
    pair, n = pair[at], np.add.reduceat(n, at) if len(at) else n
    at = _runs(pair >> 24)
    keys, rank = pair[at] >> 24, n << 24 | MASK - (pair & MASK)
    if len(at):
        total, best = np.add.reduceat(n, at), np.maximum.reduceat(rank, at)
        rank[rank == np.repeat(best, np.diff(np.append(at, len(pair))))] = 0
        second = np.maximum.reduceat(rank, at)
    else:
        keys, total, best, second = (np.zeros(1, np.int64) for _ in range(4))
    del pair, n, rank, order
    out = []
    for key, shared, of, then, n in told:
        found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        there = keys[found] == key
        n1, n2 = np.where(there, best[found] >> 24, 0), np.where(there, second[found] >> 24, 0)
        s1, s2 = MASK - (best[found] & MASK), MASK - (second[found] & MASK)
        own = np.where(shared[of], 0, n)
        n1 -= np.bincount(of, own * (then == s1[of]), len(key)).astype(np.int64)
        n2 -= np.bincount(of, own * (then == s2[of]), len(key)).astype(np.int64)
        all_ = np.where(there, total[found], 0) - np.bincount(of, own, len(key)).astype(np.int64)
        swap = ~shared & (n2 > n1)
        n1, s1 = np.where(swap, n2, n1), np.where(swap, s2, s1)
        known = n1 > 0
        both = known & shared
        out.append(pack(np.packbits(known).tobytes(), *small(n1[known]), *small(all_[known]), three(s1[known]), *small(n2[both]), three(np.where(n2 > 0, s2, 0)[both])))
    return out


def _support(n: np.ndarray) -> np.ndarray:
    return np.select([n <= 0, n == 1, n == 2, n <= 5], [0, 1, 2, 3], 4)


def _lately(flag: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The last three flags before, of the same document, as bits."""
    out = np.zeros(len(flag), np.int64)
    for k in (1, 2, 3):
        out[k:] += (flag[:-k] & (doc[k:] == doc[:-k])).astype(np.int64) << (k - 1)
    return out


@dataclass
class Told:
    """Of each document: known tokens, sum of log10(count + 1), nats that nothing learned changes, tokens coded by the tree, cells with their numbers, words to spell."""

    known: np.ndarray
    logs: np.ndarray
    fixed: np.ndarray
    coded: np.ndarray
    cells: list[bytes]
    spelled: list[bytes]


def decide(shard: Shard, parts: int, bits: int, words: list[bytes], contexts: list[bytes]) -> Told:
    """The decisions of a shard, given the answers in order of parts."""
    shard.lay_out(parts, bits)
    ids, doc, docs, size = shard.ids, shard.doc, len(shard.sizes), len(shard.words)
    # words
    counts, maps, codes = [], [], []
    for data in words:
        one, more, bitmap, code = unpack(data)
        counts.append(large(one, more))
        maps.append(np.frombuffer(bitmap, np.uint8).reshape(-1, 4))
        codes.append(np.frombuffer(code, np.uint8))
    count = np.empty(size, np.int64)
    count[shard.order] = np.concatenate(counts)
    word, gate = np.nonzero(np.unpackbits(np.concatenate(maps), axis=1, bitorder="little"))
    word, gate, many = shard.order[word].astype(np.int32), gate.astype(np.int8), restored(np.concatenate(codes))
    del maps, codes
    most = np.zeros(size, np.int64)
    np.maximum.at(most, word, many * 64 + gate)
    side = np.where(count > 0, most % 64, GATES)
    # contexts
    known, n1, total, s1, n2, s2 = [], [], [], [], [], []
    for data, n in zip(contexts, np.diff(np.append(_runs(shard.key_part), len(shard.keys))), strict=True):
        bitmap, a, b, c, d, e, f, g, h = unpack(data)
        known.append(np.unpackbits(np.frombuffer(bitmap, np.uint8), count=n).astype(bool))
        n1.append(large(a, b)), total.append(large(c, d)), s1.append(from_three(e)), n2.append(large(f, g)), s2.append(from_three(h))
    known = np.concatenate(known)

    def spread(x: list[np.ndarray], where: np.ndarray) -> np.ndarray:
        out = np.zeros(len(known), np.int32)
        out[where] = np.minimum(np.concatenate(x), (1 << 31) - 1)
        return out[shard.of]

    both = known & shard.shared
    n1, total, s1, n2, s2 = spread(n1, known), spread(total, known), spread(s1, known), spread(n2, both), spread(s2, both)
    learns = ~shard.held[doc]
    own = shard.shared[shard.of] & learns & (n1 > 0)
    by = shard.by
    begins = np.flatnonzero(np.concatenate([[True], (shard.of[by][1:] != shard.of[by][:-1]) | (doc[by][1:] != doc[by][:-1])]))
    lengths = np.diff(np.append(begins, len(by)))
    for n, what in ((n1, shard.next == s1), (n2, shard.next == s2), (total, np.ones(len(ids), bool))):
        less = np.repeat(np.add.reduceat(what[by].astype(np.int32), begins), lengths)
        n[by] -= np.where(own[by], less, 0)
    second = n2 > n1
    n1, s1 = np.where(second, n2, n1), np.where(second, s2, s1)
    far = n1 > 0
    here = np.full(len(ids), -1, np.int32)  # what followed last in this document
    again = np.ones(len(by), bool)
    again[begins] = False
    again = np.flatnonzero(again)
    here[by[again]] = ids[by[again - 1]]
    asked = here >= 0
    says = np.where(asked, (shard.hash >> np.uint64(40)).astype(np.int32)[here], -1)
    met_here, met_far = asked & (here == ids), far & (s1 == shard.next)
    speak = np.flatnonzero(asked | far)
    lately = np.zeros(len(ids), np.int64)
    lately[speak] = _lately((met_here | met_far)[speak], doc[speak])
    support, share = _support(n1), np.select([n1 * 4 < total, n1 * 4 < total * 3], [0, 1], 2)
    turns = [(0, asked, met_here, np.select([~far, s1 == says], [0, 1], 2)), (1, far & ~met_here & ~(asked & (s1 == says)), met_far, asked.astype(np.int64))]
    where, cell = [], []
    for turn, at, met, agree in turns:
        k = np.flatnonzero(at)
        where.append(k)
        cell.append((((((turn * 5 + support[k]) * 3 + share[k]) * 3 + agree[k]) * 8 + lately[k]) * 2) + met[k])
    met = met_here | (turns[1][1] & met_far)
    # unknown words: those that no other document has
    key = doc.astype(np.int64) * size + ids
    order = _order(key, docs * size)
    at = _runs(key[order])
    lengths = np.diff(np.append(at, len(key))).astype(np.int32)
    mine = np.empty(len(ids), np.int32)
    mine[order] = np.repeat(lengths, lengths)
    mine[~learns] = 0
    del key, order, at, lengths
    unknown = count[ids] <= mine
    rest = np.flatnonzero(~met)
    where.append(rest)
    cell.append(GUESSES + _lately(unknown, doc)[rest] * 2 + unknown[rest])
    tallies = [_tally(doc[np.concatenate(where)].astype(np.int64) * CELLS + np.concatenate(cell))]
    del here, says, met_here, met_far, asked, far, speak, lately, support, share, turns, n1, n2, s1, s2, total, own, second, by, begins, again, where, cell, k, what, n, agree
    # the tree
    fixed = np.zeros(docs)
    coded = rest[~unknown[rest]]
    leaves = np.lexsort((-count, side))
    leaves = leaves[count[leaves] > 0]
    if len(coded):
        tree = mixer.Tree(np.concatenate([count[leaves].astype(np.float64), [1.0]]))
        leaf = np.full(size, -1, np.int64)
        leaf[leaves] = np.arange(len(leaves))
        under = shard.gates[doc[coded]]
        present = np.unique(under)
        odds = np.empty((len(present), len(leaves) + 1), np.int8)
        for k, g in enumerate(present):
            in_gate = np.zeros(len(leaves) + 1, np.int64)
            at = gate == g
            in_gate[leaf[word[at]]] = many[at]
            odds[k] = np.clip(np.rint(_odds(tree, in_gate) * 4), -24, 24)
        depth = np.arange(len(tree.node), dtype=np.int32) - np.repeat(tree.start, tree.length)
        static = np.clip(np.rint(tree.static * 2), -12, 12).astype(np.int32) + 12
        static = TREE + (np.minimum(depth, mixer.DEPTHS - 1) * STATIC + static) * OWN + 24
        sign = np.where(tree.right, 1, -1).astype(np.int8)
        del depth
        tree.static = tree.right = None
        row = np.zeros(GATES, np.int64)
        row[present] = np.arange(len(present)) * odds.shape[1]
        odds, row = odds.ravel(), row[shard.gates]
        pair, many = _tally(doc[coded].astype(np.int64) * size + ids[coded])
        over = np.maximum(-(-many // ((1 << 20) - 1)), 1)  # what doesn't fit in 20 bits is more than one pair
        pair, left = np.repeat(pair, over), np.repeat(many, over)
        turn = np.arange(len(pair)) - np.repeat(np.cumsum(over) - over, over)
        many = np.minimum(left - turn * ((1 << 20) - 1), (1 << 20) - 1)
        for i in range(0, len(pair), AT_ONCE):
            of, symbol = pair[i : i + AT_ONCE] // size, leaf[pair[i : i + AT_ONCE] % size]
            length = tree.length[symbol]
            path = np.repeat(tree.start[symbol] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
            z = odds[np.repeat(row[of], length) + tree.node[path]] * sign[path]
            packed = np.repeat((of * CELLS) << 20 | many[i : i + AT_ONCE], length)
            packed += (z + static[path]).astype(np.int64) << 20
            packed.sort()
            key = packed >> 20
            at = _runs(key)
            tallies.append((key[at], np.add.reduceat(packed & ((1 << 20) - 1), at)))
        all_, less = count[ids[coded]], mine[coded]
        fixed -= np.bincount(doc[coded], np.log((all_ - less) / all_) + math.log(float(count[leaves].sum()) + 1), docs)
    keys, numbers = np.concatenate([k for k, _ in tallies]), np.concatenate([n for _, n in tallies])
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    at = _runs(keys)
    keys, numbers = keys[at], np.add.reduceat(numbers, at)
    cut = np.searchsorted(keys, np.arange(docs + 1) * CELLS).tolist()
    cells = [pack((keys[a:b] % CELLS).astype("<u2").tobytes(), *small(numbers[a:b])) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    spell = rest[unknown[rest]]
    lists: list[list[bytes]] = [[] for _ in range(docs)]
    for d, i in zip(doc[spell].tolist(), ids[spell].tolist(), strict=True):
        lists[d].append(shard.words[i])
    return Told(
        np.bincount(doc, count[ids] > 0, docs).astype(np.int64), np.bincount(doc, np.log10(count[ids] + 1), docs), fixed,
        np.bincount(doc[coded], minlength=docs), cells, [b"".join(w + b"\n" for w in x) for x in lists],
    )


def _odds(tree: mixer.Tree, counts: np.ndarray) -> np.ndarray:
    """``Tree.odds`` for counts of any size."""
    cum = np.concatenate([[0], np.cumsum(counts)])
    at = cum[: len(tree.low)]
    left, right = at - cum[tree.low], cum[tree.high] - at
    return np.log((np.maximum(right, 0) + tree.backing) / (np.maximum(left, 0) + (mixer.BACKING - tree.backing)))


def _tally(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(x)
    at = _runs(x)
    return x[at], np.diff(np.append(at, len(x)))


def cells_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    cell, one, more = unpack(data)
    return np.frombuffer(cell, "<u2").astype(np.int64), large(one, more)


def prices(seen: np.ndarray, steps: int = 300) -> np.ndarray:
    """Nats of each cell, by weights and maps learned from how often all training documents had it.

    A cell and the one of the contrary decision are certain together.
    """
    out = np.zeros(CELLS)

    def odds(n: np.ndarray, axes: tuple[int, ...]) -> np.ndarray:
        """Log-odds of a one by the axes that are kept."""
        kept = n.sum(axis=tuple(k for k in range(n.ndim - 1) if k not in axes), keepdims=True) + 0.4
        return np.broadcast_to(np.log(kept[..., 1] / kept[..., 0]), n.shape[:-1])

    def learned(n: np.ndarray, x: np.ndarray, select: np.ndarray, rate: float) -> np.ndarray:
        model = mixer.Mixer([1 / len(x)] * len(x), int(select.max()) + 1)
        _learn(model, select, x, n, rate, steps)
        return model.nats(select, x)

    sign = np.array([-1.0, 1.0])
    n = seen[:GUESSES].reshape(2, 5, 3, 3, 8, 2)
    x = np.stack([(odds(n, axes)[..., None] * sign).ravel() for axes in ((0, 1, 2), (0, 4), (0, 1, 3), (0, 1, 2, 3, 4))]).astype(np.float32)
    turn, support, _, agree, _, _ = np.indices(n.shape)
    out[:GUESSES] = learned(n.ravel(), x, ((turn * 5 + support) * 3 + agree).ravel(), 0.24)
    n = seen[GUESSES:TREE].reshape(8, 2)
    x = np.stack([(odds(n, axes)[..., None] * sign).ravel() for axes in ((), (0,))]).astype(np.float32)
    out[GUESSES:TREE] = learned(n.ravel(), x, np.zeros(16, np.int64), 0.24)
    depth, static, own = (i.ravel() for i in np.indices((mixer.DEPTHS, STATIC, OWN)))
    model = mixer.Mixer([0.3, 0.7], mixer.DEPTHS)
    x = np.stack([(static - 12) / 2, (own - 24) / 4]).astype(np.float32)
    _learn(model, depth, x, seen[TREE:], 0.24, steps)
    out[TREE:] = model.nats(depth, x)
    return out


def _learn(model: mixer.Mixer, select: np.ndarray, x: np.ndarray, n: np.ndarray, rate: float, steps: int) -> None:
    n = n.astype(np.float64)
    for k in range(steps):
        model.learn(select, x, n, rate / (1 + 3 * k / steps))
    model.seen[:] = 1
    model.learn(select, x, n, 0.0)


# --- spelling ---------------------------------------------------------------

#: Bytes before that spelling looks at; a byte, the begin of a word or its end takes 9 bits of a key.
BACK, BEGIN, END = 3, 257, 256


def grams(words: list[bytes]) -> np.ndarray:
    """Keys of each byte and the end with the bytes before it."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    text = np.full(int(size.sum()), END, np.int64)
    ends = np.cumsum(size)
    inner = np.ones(len(text), bool)
    inner[ends - 1] = False
    text[inner] = np.frombuffer(b"".join(words), np.uint8)
    of = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(text)) - (ends - size)[of]
    key = text.copy()
    for k in range(1, BACK + 1):
        back = np.full(len(text), BEGIN, np.int64)
        back[k:] = text[:-k] if k < len(text) else back[k:]
        back[place < k] = BEGIN
        key |= back << (9 * k)
    return key


class Spelling:
    """Bytes by those before, backed by shorter contexts (Witten and Bell), from the unknown words of all training documents.

    Each of these is spelled by the others: every order leaves one of a byte's own out.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.orders = keys[order], []
        every, own = np.full(len(keys), 1 / 257), np.full(len(keys), 1 / 257)
        for k in range(BACK + 1):
            part = self.keys & ((1 << 9 * (k + 1)) - 1)
            by = np.argsort(part, kind="stable")
            at = _runs(part[by])
            gram, n = part[by][at], np.add.reduceat(counts[order][by], at) if len(at) else counts
            begins = _runs(gram >> 9)
            context, kinds = (gram >> 9)[begins], np.diff(np.append(begins, len(gram)))
            total = np.add.reduceat(n, begins) if len(begins) else n
            self.orders.append((gram, n, context, total, kinds))
            where, of = np.searchsorted(gram, part), np.searchsorted(context, part >> 9)
            hits, all_, many = n[where], total[of], kinds[of]
            every = (hits + many * every) / (all_ + many)
            own = np.where(all_ > 1, (hits - 1 + (many - (hits == 1)) * own) / np.maximum(all_ - 1 + many - (hits == 1), 1), own)
        self.every, self.own = -np.log(every), -np.log(own)

    def _rare(self, key: np.ndarray) -> np.ndarray:
        """Bytes that no training document has after the three before."""
        p = np.full(len(key), 1 / 257)
        for k, (gram, n, context, total, kinds) in enumerate(self.orders):
            part = key & ((1 << 9 * (k + 1)) - 1)
            hits, all_, many = _find(gram, n, part), _find(context, total, part >> 9), _find(context, kinds, part >> 9)
            p = np.where(all_ > 0, (hits + many * p) / np.maximum(all_ + many, 1), p)
        return -np.log(p)

    def nats(self, words: list[list[bytes]], held: np.ndarray) -> np.ndarray:
        """Cost of each document's unknown words."""
        flat = [w for x in words for w in x]
        out = np.zeros(len(words))
        if not flat:
            return out
        doc = np.repeat(np.arange(len(words)), [sum(map(len, x)) + len(x) for x in words])
        key = grams(flat)
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        known = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
        cost = np.empty(len(key))
        cost[known] = np.where(held[doc[known]], self.every[at[known]], self.own[at[known]])
        cost[~known] = self._rare(key[~known])
        return np.bincount(doc, cost, len(words))


def _find(keys: np.ndarray, values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, values[at], 0)
