"""Benchmark decontamination by pigeonhole edit matching."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import own_dir, store_of

#: Errors (characters put in, left out or changed) allowed for each character of an item.
ERROR_RATE = 0.08
#: Bytes of item texts that a task holds in an automaton at once, and of documents that it holds against one after the other.
BLOCK_BYTES, HELD_BYTES = 4_000_000, 64_000_000

HITS = T.StructType(
    [T.StructField(x, T.LongType()) for x in ("doc_id", "item_id")] + [T.StructField(x, T.IntegerType()) for x in ("distance", "start", "end")]
)


def normal(text: str | None) -> str:
    """Lower case, each run of white space one blank."""
    return " ".join((text or "").lower().split())


@dataclass
class Item:
    item_id: int | None
    text: str
    budget: int
    peq: dict[str, int] = field(default_factory=dict)
    back: dict[str, int] = field(default_factory=dict)
    halves: list[str] | None = None

    def __post_init__(self) -> None:
        for masks, text in ((self.peq, self.text), (self.back, self.text[::-1])):
            for i, c in enumerate(text):
                masks[c] = masks.get(c, 0) | 1 << i

    def may_be_in(self, window: str) -> bool:
        """Whether a window can hold the item: of twice as many pieces each error spoils one at most, so more than half must be there."""
        if self.halves is None:
            n, m = 2 * (self.budget + 1), len(self.text)
            self.halves = [self.text[k * m // n : (k + 1) * m // n] for k in range(n)]
        missing = 0
        for half in self.halves:
            if half not in window:
                missing += 1
                if missing > self.budget:
                    return False
        return True


def myers(masks: dict[str, int], m: int, text: str, limit: int, anchored: bool = False) -> tuple[int, int] | None:
    """Least edit distance of a pattern to a substring, with the first end at which it occurs; None if over the limit.

    The pattern's ``m`` rows are bits of one integer, so a character of text
    costs a few operations whatever m is.  ``anchored`` makes the substring
    start where the text does.
    """
    mask, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = mask, 0, m, (limit + 1, -1)
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        plus = (down | ~(across | up)) & mask
        minus = up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = (plus << 1 | anchored) & mask
        minus = (minus << 1) & mask
        up = (minus | ~(vertical | plus)) & mask
        down = plus & vertical
        if score < best[0]:
            best = (score, at + 1)
    return best if best[1] >= 0 else None


class Matcher:
    """Items' pieces in one automaton, and the search of a text for the items."""

    def __init__(self, items: list[tuple[int | None, str | None]], rate: float = ERROR_RATE) -> None:
        self.items: list[Item] = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, raw in items:
            text = normal(raw)
            if not text:
                continue
            budget = int(rate * len(text))
            self.items.append(Item(item_id, text, budget))
            n, m = budget + 1, len(text)
            for k in range(n):
                a, b = k * m // n, (k + 1) * m // n
                pieces.setdefault(text[a:b], []).append((len(self.items) - 1, a))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, end) of each item's best passage in a text that is ``normal``.

        A passage within the budget keeps one of budget + 1 pieces whole, so
        some piece's exact hit gives where the item would start, up to the
        budget; neighbouring starts are verified together.  Of equal distances
        the first passage is taken.
        """
        if not self.items:
            return
        starts: dict[int, set[int]] = {}
        for end, (size, owners) in self.automaton.iter(text):
            for number, offset in owners:
                starts.setdefault(number, set()).add(end + 1 - size - offset)
        for number in sorted(starts):
            item = self.items[number]
            m, e = len(item.text), item.budget
            best: tuple[int, int, int] | None = None
            at = sorted(starts[number])
            first = 0
            for k in range(1, len(at) + 1):
                if k < len(at) and at[k] - at[k - 1] <= e:
                    continue
                low, high = max(0, at[first] - e), min(len(text), at[k - 1] + m + e)
                first = k
                hit = self._verify(item, text, low, high, (best[0] - 1) if best else e)
                best = hit or best
                if best and best[0] == 0:
                    break
            if best:
                yield item.item_id, *best

    def _verify(self, item: Item, text: str, low: int, high: int, limit: int) -> tuple[int, int, int] | None:
        m, whole = len(item.text), text[low:high]
        at = whole.find(item.text)
        while at >= 0:
            a, b = low + at, low + at + m
            if item.budget or ((a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum())):
                return 0, a, b
            at = whole.find(item.text, at + 1)
        if item.budget == 0 or limit < 1 or not item.may_be_in(whole):
            return None
        found = myers(item.peq, m, whole, limit)
        if not found:
            return None
        distance, end = found
        back = myers(item.back, m, whole[:end][::-1], distance, anchored=True)
        return distance, low + end - (back[1] if back else end), low + end


class Blocks:
    """A benchmark as files in the shared folder, in blocks of about ``size`` bytes, and the tasks' way to them.

    The driver holds none of it, whatever its size, but how many items each
    block has: a task that finds others, or no folder, fails.  A task reads a
    block and builds its automaton where it is needed; the last one built is
    kept, so a benchmark of one block is read once by each Python worker.
    """

    def __init__(self, benchmark: DataFrame, rate: float, size: int = BLOCK_BYTES) -> None:
        items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
        total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.count, self.rate, self.sizes = -(-total // size), rate, {}
        self.kept: tuple[int, Matcher] | None = None
        if self.count:
            self.folder = f"{own_dir(benchmark.sparkSession)}/benchmark-{uuid.uuid4().hex}"
            dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(self.count)))
            dealt.repartition(int(min(self.count, 1000)), "block").write.partitionBy("block").parquet(self.folder)
            written = benchmark.sparkSession.read.schema("item_id long, text string, block int").parquet(self.folder)
            self.sizes = {r.block: r["count"] for r in written.groupBy("block").count().collect()}

    def matchers(self) -> Iterator[Matcher]:
        for k in range(self.count):
            if self.kept is None or self.kept[0] != k:
                self.kept = None
                items: list[tuple[int | None, str | None]] = []
                if k in self.sizes:  # a block that the hash left empty has no folder
                    store, base = store_of(f"{self.folder}/block={k}")
                    for x in store.get_file_info(pafs.FileSelector(base)):
                        if x.path.endswith(".parquet"):
                            got = pq.read_table(store.open_input_file(x.path), columns=["item_id", "text"])
                            items += zip(got.column("item_id").to_pylist(), got.column("text").to_pylist(), strict=True)
                    if len(items) != self.sizes[k]:
                        raise FileNotFoundError(f"{self.folder}/block={k} has {len(items)} of {self.sizes[k]} items here")
                self.kept = (k, Matcher(sorted(items, key=lambda x: (x[0] is not None, x)), self.rate))
            yield self.kept[1]

    def over(self, f: Callable[[Blocks, list[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """For mapInArrow: f on batches, of which as many are held together as are worth building the automata for."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches:
                held.append(batch)
                size += batch.nbytes
                if size >= (HELD_BYTES if self.count > 1 else 1):
                    yield from f(self, held)
                    held, size = [], 0
            if held:
                yield from f(self, held)

        return run


def _parts(batches: list[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def find(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """Rows (doc_id, item_id, distance, start, end): each item's best passage in each document that has one.

    Texts are compared in lower case with white space as single blanks; start
    and end count characters of that form.  An item of n characters may have
    ``rate`` * n errors; one that is too short for any must stand as whole
    words.  Null and empty texts hold nothing; null and empty items are in
    nothing; items or documents that are repeated or have no id are reported
    each with the id they have.  No matches, no rows.  The documents are read
    once, however large the benchmark is.
    """
    blocks = Blocks(benchmark, rate)

    def run(blocks: Blocks, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matcher in blocks.matchers():
            for batch in _parts(held):
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    rows += [(doc_id, *hit) for hit in matcher.find(normal(text))]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                    yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], HITS.names)

    return docs.select("doc_id", "text").mapInArrow(blocks.over(run), HITS)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The documents that hold no passage of any item, with their own columns."""
    at, blocks = docs.columns.index("text"), Blocks(benchmark, rate)

    def run(blocks: Blocks, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matcher in blocks.matchers():
            held = [batch.filter(pa.array([next(matcher.find(normal(x)), None) is None for x in batch.column(at).to_pylist()], pa.bool_())) for batch in _parts(held)]
        yield from (x for x in held if x.num_rows)

    return docs.mapInArrow(blocks.over(run), docs.schema)
