"""SentencePiece encoding and decoding: exact merge-type tokens by backtracking over longest matches.

Merging by score builds a token from nothing but its own characters, so tokens
stand side by side in the result of a text exactly if merging the characters of
each two neighbours alone gives these two again.  A text is therefore encoded
from left to right: an Aho-Corasick automaton tells the longest piece at each
position; it is taken if it is compatible with the token before, else the next
shorter one; where none is left the position is marked as failed in a bitfield
and the token before gives way.  The prefix of a text has one encoding, so a
position that failed once fails for good.

No piece has a space after another character, so a word with the spaces before
it is encoded alone, and words are looked up before they are encoded again.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections import defaultdict
from functools import lru_cache
from itertools import chain
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import ID, in_batches

#: Stands for a space in pieces.
SPACE = "▁"
#: Words (in each of two generations, and parts of them) and pairs of neighbours that a Python worker keeps at most.
WORDS, PAIRS = 250_000, 200_000
#: Characters of a word that is kept, of the stretch that is matched at once, and of the stretch that is split into words at once.
KEPT, STRETCH, SLICE = 64, 1 << 16, 1 << 20
#: A model must leave this text as it is but for the spaces, and put one before it.
PROBE = "Å ﬁ  ①　x "

UNIT = re.compile(r" *[^ ]+| +")
BOUNDARY = re.compile(r"(?<! ) ")

codecs.register_error("one-by-one", lambda e: ("�", e.start + 1))


def read_utf8(data: bytes) -> str:
    """Text of bytes, each one that is no part of a character as U+FFFD."""
    return data.decode("utf-8", "one-by-one")


class Vocabulary:
    """The pieces of a merge-type model with byte fallback, and what is known of words and of neighbours so far."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        if library.normalize(PROBE) != SPACE + PROBE.replace(" ", SPACE):
            raise ValueError("the model changes characters; only identity with escaped spaces and a space before the text is served")
        ids = range(library.vocab_size())
        names = [library.id_to_piece(i) for i in ids]
        special = [library.is_byte(i) or library.is_control(i) or library.is_unknown(i) for i in ids]
        self.ids = {p: i for i, p in enumerate(names) if not special[i]}
        self.score = {p: library.get_score(i) for p, i in self.ids.items()}
        self.bytes = {b: library.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        if not all(library.is_byte(i) for i in self.bytes.values()) or any(SPACE in p.lstrip(SPACE) or "\0" in p for p in self.ids):
            raise ValueError("the model has no byte fallback, or pieces that reach over a space")
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if len(p) > 1:
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.longest = max(map(len, self.ids))
        self.near = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.shorter: dict[str, str | None] = {}
        self.follow: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self.pairs = 0
        self.inner: dict[str, bytes] = {}
        self.words = Words(self)
        # for decoding
        number = {i: b for b, i in self.bytes.items()}
        surface = ["" if library.is_control(i) else library.decode([i]) if library.is_unknown(i) else p.replace(SPACE, " ") for i, p in enumerate(names)]
        self.surface = [bytes([number[i]]) if i in number else surface[i].encode() for i in ids]
        self.lead = np.array([p.startswith(SPACE) and not special[i] for i, p in enumerate(names)])
        self.blank = np.array([library.is_control(i) for i in ids])

    def merged(self, text: str, border: int = 0) -> list[str] | None:
        """What merging makes of a short text: the best score first, then the leftmost.  None as soon as something is merged over the border."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = score.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if best is None:
                break
            if border and sum(map(len, parts[: at + 1])) == border:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: str, token: str) -> bool:
        """Whether the token can follow another, or stand first after "": kept, as few pairs make up most of a text."""
        if self.pairs >= PAIRS:
            self.follow.clear()
            self.pairs = 0
        self.pairs += 1
        found = self.merged(before + token, len(before)) == ([before, token] if before else [token])
        self.follow[before][token] = found
        return found

    def prefix(self, token: str) -> str | None:
        """The longest piece or single character that the token starts with and isn't."""
        if token not in self.shorter:
            short = (token[:k] for k in range(len(token) - 1, 0, -1))
            self.shorter[token] = next((p for p in short if len(p) == 1 or p in self.ids), None)
        return self.shorter[token]

    def tokens(self, text: str) -> list[str]:
        """The tokens of a text with escaped spaces; characters that no piece stands for are tokens of their own."""
        n, follow, shorter = len(text), self.follow, self.shorter
        failed: bytearray | None = None  # most words have no failed position
        found: list[str] = []
        pos, base, matches = 0, 0, self._matches(text, 0)
        before, token = "", matches[0]
        known = follow[before]
        while True:
            end = pos + len(token)
            fits = known.get(token)
            if fits is None:
                fits = self.fits(before, token)
            if fits and (failed is None or not failed[end >> 3] >> (end & 7) & 1):
                found.append(token)
                if end == n:
                    return found
                pos, before, known = end, token, follow[token]
                if not base <= pos < base + STRETCH:
                    base = pos - pos % STRETCH
                    matches = self._matches(text, base)
                token = matches[pos - base]
                continue
            token = shorter.get(token) or self.prefix(token)
            if token is None:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[pos >> 3] |= 1 << (pos & 7)
                token = found.pop()
                pos -= len(token)
                before = found[-1] if found else ""
                known = follow[before]

    def _matches(self, text: str, base: int) -> list[str]:
        """The longest piece at each position of a stretch, or its character."""
        part = text[base : base + STRETCH + self.longest]
        matches = list(part)
        for end, piece in self.automaton.iter(part):
            matches[end + 1 - len(piece)] = piece
        return matches

    def packed(self, text: str) -> bytes:
        """Ids of a text with escaped spaces, as 32-bit integers."""
        tokens = self.tokens(text)
        found = list(map(self.ids.get, tokens))
        if None in found:
            found = list(chain.from_iterable([i] if i is not None else map(self.bytes.__getitem__, t.encode()) for i, t in zip(found, tokens, strict=True)))
        return array("i", found).tobytes()

    def unit(self, text: str) -> bytes:
        """``packed``, split between characters that stand side by side in no piece, as nothing is merged over them."""
        out, near, start = bytearray(), self.near, 0
        for i, pair in enumerate(map(add, text, text[1:] + "\0"), 1):  # no piece has what ends the text here
            if pair not in near:
                part, start = text[start:i], i
                known = self.inner.get(part)
                if known is None:
                    known = self.packed(part)
                    if len(part) <= KEPT:
                        if len(self.inner) >= WORDS:
                            self.inner.clear()
                        self.inner[part] = known
                out += known
        return bytes(out)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as 32-bit integers."""
        if not text:
            return b""
        if SPACE in text:
            text = text.replace(SPACE, " ")
        word, found, start = self.words.__getitem__, [], 0
        while start < len(text):
            cut = BOUNDARY.search(text, start + SLICE)
            part = text[start : cut.start() if cut else len(text)]
            start += len(part) + (cut is not None)  # the space at the cut is that before the next word
            if cut and start == len(text):
                found += [*map(word, _units(part)), word("")]
            else:
                found += map(word, _units(part))
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the first space goes, runs of bytes are read as UTF-8."""
        if not len(ids):
            return ""
        pieces = list(map(self.surface.__getitem__, ids.tolist()))
        blank = self.blank[ids]
        seen = np.flatnonzero(~blank)
        if len(seen) and self.lead[ids[seen[0]]]:
            pieces[seen[0]] = pieces[seen[0]][1:]
        breaks = [0, *np.flatnonzero(blank).tolist(), len(pieces)]  # bytes on either side of a control id are no character together
        return "".join(read_utf8(b"".join(pieces[a:b])) for a, b in zip(breaks, breaks[1:], strict=False))


def _units(text: str) -> list[str]:
    """Words with the spaces before them, less the one that stands before the text or the word."""
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return [u[1:] for u in UNIT.findall(" " + text)]
    return text.split(" ")


class Words(dict):
    """Packed ids by word, in two generations, so that frequent words stay and memory is bounded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.old = vocabulary, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.vocabulary.unit(SPACE + word.replace(" ", SPACE))
            if len(word) > KEPT:
                return found
        if len(self) >= WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    """One for each model and Python worker."""
    return Vocabulary(model)


def _shared(df: DataFrame, path: str):  # noqa: ANN202
    """The model's bytes as a broadcast: half a megabyte, whatever the input."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, ids) for every document: its ids under the model at ``path``, without begin or end.

    Null texts count as empty and have no ids; repeated rows and rows without an
    id are encoded each; other columns are not looked at.  Bytes that are no
    UTF-8 count as U+FFFD each.  A text of any length is encoded whole, with
    memory in proportion to its length.
    """
    model = _shared(docs, path)
    schema = T.StructType([ID, T.StructField("ids", T.ArrayType(T.IntegerType(), containsNull=False), nullable=False)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = vocabulary(model.value)
        found = [known.encode(read_utf8(x or b"")) for x in batch.column("text").to_pylist()]
        ends = np.cumsum([0, *map(len, found)]) // 4
        values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        return pa.record_batch([batch.column("doc_id"), lists], ["doc_id", "ids"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(in_batches(run), schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, ids, text) of rows (doc_id, ids): with the text that the library's decode gives; null ids give an empty one."""
    model = _shared(encoded, path)
    schema = T.StructType([ID, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("text", T.StringType(), nullable=False)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, lists = vocabulary(model.value), batch.column("ids")
        texts = [known.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else "" for x in lists]
        return pa.record_batch([batch.column("doc_id"), lists, pa.array(texts, pa.string())], schema.names)

    return encoded.select("doc_id", "ids").mapInArrow(in_batches(run), schema)
