from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).parent))
from tests_llm_words import words  # noqa: E402

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture(scope="session")
def middle(small) -> str:
    """Enough labelled rows and words for models to be held to figures."""
    return str(Path(small).parent / "sf0.01")


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs, spark):
    """Nulls everywhere, empty and very long texts, ties, a repeated row, and a column whose name an operator might use."""
    from pyspark.sql import functions as F

    rng = random.Random(3)
    long = words(rng, 30_000)
    rows = [(1, "one two three", "a"), (2, "", "a"), (3, None, None), (None, "no id here at all", "b"), (5, long, "b"), (6, long, "b"), (7, " \t\n", "c"), (8, "one two three", "c"), (8, "one two three", "c")]
    rows += [(10 + i, words(rng, 40), "hot") for i in range(12)]
    df = make_docs(rows)
    for name in ("score", "fp", "shard", "n", "rank", "key", "row", "block", "label", "part"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
