from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        *[T.StructField(c, T.StringType()) for c in ("key", "size", "class", "token", "version", "shard", "sha", "n")],
    ]
)


@pytest.fixture(scope="session")
def docs(spark):
    """``(doc_id, text)`` or ``(doc_id, text, source)`` tuples to documents with extra columns."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) + ("x",) * 8 for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


def prose(words: int, seed: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


#: Texts that every operator must bear.
ODD = [None, "", " \t\n", "a", "▁ x", "é" * 300, "x" * 5000, "naïve 😀 \u0000 text", "A b c", "1" * 400, "@@ a@b +1 0.0.0.0"]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
