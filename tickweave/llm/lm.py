"""Language-model scoring by logistic context mixing, learned from all training documents.

Documents stay in the tasks that read them and are taken in shards of some
megabytes (``corpus``).  Shards ask parts, to which words and contexts are dealt
by hash, what all training documents have; with the answers every token becomes
binary decisions, each in one of a fixed number of cells.  Cells and unknown
words of all training documents are summed; weights and maps (``mixer``) and
spelling are learned from the sums and price every document.  So nothing that a
score depends on is learned from a share of the corpus.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm import corpus, mixer
from tickweave.llm.common import held_out, own_dir, store_of, written

tokens = mixer.tokens
#: Bytes of texts that are taken in together, and for which there is a part.
SHARD_BYTES, PART_BYTES = 8_000_000, 16_000_000

_ASKED = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("shard", T.StringType()), T.StructField("data", T.BinaryType())])
_TOLD = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("held", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("logs", T.DoubleType()), T.StructField("gate", T.ByteType()), T.StructField("fixed", T.DoubleType()), T.StructField("coded", T.LongType()),
        T.StructField("cells", T.BinaryType()), T.StructField("spelled", T.BinaryType()), T.StructField("bytes", T.LongType()), T.StructField("distinct", T.LongType()),
    ]
)
_SUMS = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])
_NATS = T.StructType([*(f for f in _TOLD if f.name not in ("cells", "spelled", "distinct")), T.StructField("nats", T.DoubleType())])
_CELLS, _GRAMS = 0, 1


def _rows(schema: T.StructType, *columns: list) -> pa.RecordBatch:
    kinds = {T.IntegerType: pa.int32(), T.StringType: pa.string(), T.BinaryType: pa.binary(), T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(), T.ByteType: pa.int8()}
    return pa.record_batch([pa.array(x, kinds[type(f.dataType)]) for x, f in zip(columns, schema, strict=True)], schema.names)


def _asker(folder: str, parts: int, bits: int, most: int):
    """Documents to shards: each lies in the folder under a name of its own, what it asks goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        ids: list = []
        held: list[bool] = []
        texts: list[bytes] = []

        def out() -> Iterator[pa.RecordBatch]:
            name, shard = uuid.uuid4().hex, corpus.Shard.of(texts, held)
            known = np.array([x is not None for x in ids])
            numbers = np.array([x or 0 for x in ids], "<i8")
            with store.open_output_stream(f"{path}/{name}") as f:
                f.write(corpus.pack(shard.dump(), numbers.tobytes(), known.tobytes(), np.array([len(x) for x in texts], "<i8").tobytes()))
            for x in (ids, held, texts):
                x.clear()
            asked = list(shard.asks(parts, bits))
            for i in range(0, len(asked), 64):
                part, kind, data = zip(*asked[i : i + 64], strict=True)
                yield _rows(_ASKED, part, kind, [name] * len(part), data)

        size = 0
        for batch in batches:
            for doc_id, out_, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held", "text")), strict=True):
                if texts and size + len(text) > most:
                    yield from out()
                    size = 0
                ids.append(doc_id), held.append(out_), texts.append(text)
                size += len(text)
        if texts:
            yield from out()

    return run


def _grouped(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that follow each other with the same values of these columns."""
    now, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in batch.schema.names]
        at = [batch.schema.names.index(c) for c in names]
        for row in zip(*columns, strict=True):
            key = tuple(row[k] for k in at)
            if key != now:
                if rows:
                    yield now, rows
                now, rows = key, []
            rows.append(row)
    if rows:
        yield now, rows


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (part, kind), rows in _grouped(batches, "part", "kind"):
        shards, asked = [x[2] for x in rows], [x[3] for x in rows]
        rows.clear()
        if kind == corpus.WORDS:
            answers, distinct = corpus.answer_words(asked)
            yield _rows(_ASKED, [part], [corpus.DISTINCT], [f"{part}"], [str(distinct).encode()])
        else:
            answers = corpus.answer_contexts(asked)
        for i in range(0, len(answers), 64):
            some = answers[i : i + 64]
            yield _rows(_ASKED, [part] * len(some), [kind] * len(some), shards[i : i + 64], some)


def _decider(folder: str, parts: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        for (name,), rows in _grouped(batches, "shard"):
            if rows[0][1] == corpus.DISTINCT:
                yield _rows(_TOLD, *([None] for _ in range(len(_TOLD) - 1)), [int(rows[0][3])])
                continue
            with store.open_input_stream(f"{path}/{name}") as f:
                body, numbers, known, sizes = corpus.unpack(f.read())
            shard = corpus.Shard.load(body)
            words, contexts = ([x[3] for x in rows if x[1] == kind] for kind in (corpus.WORDS, corpus.CONTEXTS))
            rows.clear()
            told = corpus.decide(shard, parts, bits, words, contexts)
            ids = [x if y else None for x, y in zip(np.frombuffer(numbers, "<i8").tolist(), np.frombuffer(known, bool), strict=True)]
            n = len(ids)
            columns = [ids, shard.held, shard.sizes, told.known, told.logs, shard.gates, told.fixed, told.coded, told.cells, told.spelled, np.frombuffer(sizes, "<i8"), [None] * n]
            for i in range(0, n, 2000):
                yield _rows(_TOLD, *(x[i : i + 2000] for x in columns))

    return run


def _spelled(data: bytes) -> list[bytes]:
    return data.split(b"\n")[:-1]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often training documents have each cell, and the bytes of their unknown words, of each document once."""
    seen = np.zeros(corpus.CELLS, np.int64)
    for batch in batches:
        grams = []
        for cells, spelled in zip(batch.column("cells").to_pylist(), batch.column("spelled").to_pylist(), strict=True):
            cell, n = corpus.cells_of(cells)
            seen[cell] += n
            if spelled:
                grams.append(corpus.grams(sorted(set(_spelled(spelled)))))
        if grams:
            key, n = np.unique(np.concatenate(grams), return_counts=True)
            yield _rows(_SUMS, np.full(len(key), _GRAMS), key, n)
    cell = np.flatnonzero(seen)
    yield _rows(_SUMS, np.full(len(cell), _CELLS), cell, seen[cell])


def _pricer(price: np.ndarray, grams: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = None
        for batch in batches:
            if spelling is None:
                store, path = store_of(grams)
                table = pq.read_table(path, columns=["key", "n"], filesystem=store, schema=pa.schema([("key", pa.int64()), ("n", pa.int64())]))
                spelling = corpus.Spelling(table.column("key").to_numpy(), table.column("n").to_numpy())
            nats = np.zeros(batch.num_rows)
            for k, cells in enumerate(batch.column("cells").to_pylist()):
                cell, n = corpus.cells_of(cells)
                nats[k] = price[cell] @ n
            held = np.array(batch.column("held").to_pylist(), bool)
            for i in range(0, len(nats), 500):
                words = [_spelled(x) for x in batch.column("spelled")[i : i + 500].to_pylist()]
                nats[i : i + 500] += spelling.nats(words, held[i : i + 500])
            yield pa.record_batch([*(batch.column(c) for c in _NATS.names[:-1]), pa.array(nats)], _NATS.names)

    return run


def score(docs: DataFrame, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """Scores every whole text; see the module.  Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    A training document is scored by what the others teach.  Null texts count
    as empty and have the end alone.  Rows without an id are not held out;
    repeated rows are scored each.  Without training rows spelling alone is
    left; no rows give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts, shards, bits = max(1, -(-total // PART_BYTES)), max(1, -(-total // SHARD_BYTES)), corpus.hash_bits(total)
    folder = f"{own_dir(spark)}/lm-shards-{uuid.uuid4().hex}"
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    asked = rows.mapInArrow(_asker(folder, parts, bits, SHARD_BYTES), _ASKED)
    answers = asked.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind", "shard").mapInArrow(_answer, _ASKED)
    told = answers.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "part").mapInArrow(_decider(folder, parts, bits), _TOLD)
    told = written(told, "lm-decisions")
    ours = told.where("distinct is null")
    n, distinct = told.agg(F.sum(F.when(~F.col("held"), F.col("n_tokens"))), F.sum("distinct")).first()
    n, distinct = int(n or 0), int(distinct or 0)
    gates = np.zeros(mixer.GATES)
    for gate, many in ours.where("not held").groupBy("gate").count().collect():
        gates[gate] = many
    sums = ours.where("not held").select("cells", "spelled").mapInArrow(_sums, _SUMS).groupBy("kind", "key").agg(F.sum("n").alias("n"))
    grams = f"{own_dir(spark)}/lm-sums-{uuid.uuid4().hex}"
    sums.write.partitionBy("kind").parquet(grams)
    found = spark.read.schema(_SUMS).parquet(grams)
    seen = np.zeros(corpus.CELLS)
    for key, many in found.where(F.col("kind") == _CELLS).select("key", "n").collect():
        seen[key] = many
    store.create_dir(store_of(f"{grams}/kind={_GRAMS}")[1], recursive=True)  # there may be none
    priced = ours.select(*[c for c in _TOLD.names if c != "distinct"]).mapInArrow(_pricer(corpus.prices(seen), f"{grams}/kind={_GRAMS}"), _NATS)
    entry = F.element_at(F.array([F.lit(math.log((x + 0.5) / (gates.sum() + 0.5 * mixer.GATES))) for x in gates]), F.col("gate").cast("int") + 1)
    nats = F.col("nats") + F.col("coded") * math.log(n + 1) + F.col("fixed") - entry
    return priced.withColumn("score", -nats / math.log(10)).select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * math.log10(n + distinct + 1)).alias("base_score"), "score",
        F.when(F.col("bytes") > 0, -F.col("score") * F.lit(math.log2(10)) / F.col("bytes")).alias("bits_per_byte"),
    )
