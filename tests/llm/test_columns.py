"""Rows come back with all their columns, also with names that operators use themselves."""

import pytest
from pyspark.sql import functions as F

from rushcart.llm.exact import unique_rows
from rushcart.llm.mixing import mixed_rows
from rushcart.llm.ngram_join import first_of_groups

NAMES = ["_id", "_sha", "_class", "_size", "_null", "_row", "_turn", "_copies", "_keep", "_ties", "_best", "_taken", "extra 1", "root", "class"]


@pytest.mark.parametrize("run", [unique_rows, mixed_rows, first_of_groups])
@pytest.mark.parametrize("rows", [0, 40])
def test_extra_columns_keep_their_names_and_values(docs, run, rows):
    plain = docs([(i, f"one two three four five six w{i % 30} w{i % 30}", f"s{i % 3}") for i in range(rows)]).select("doc_id", "text", "lang", "source", "n_chars")
    wide = plain.select("*", *[F.concat(F.lit(name), F.col("doc_id").cast("string")).alias(name) for name in NAMES])
    out = run(wide)
    assert out.columns == wide.columns
    found = out.collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in run(plain).collect())
    assert all(r[name] == f"{name}{r['doc_id']}" for r in found for name in NAMES)
    assert bool(found) == bool(rows)
