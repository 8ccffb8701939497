import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rushcart.llm.merkle import fold, manifest, proofs, verified
from .conftest import ODD, rows_of

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fan=8):
    """Levels from the leaves up to the one that stays."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[a : a + fan]) for a in range(0, len(below), fan)])
    return levels


def path(levels, at, fan=8):
    out = []
    for nodes in levels[:-1]:
        first = at - at % fan
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fan])))
        at //= fan
    return out


def wanted(rows):
    """From (doc_id, text, lang) rows, one by one."""
    full = [{"doc_id": i, "text": t, "lang": lang, "source": "s", "n_chars": len(t or "")} for i, t, lang in rows]
    groups = {}
    for row in full:
        groups.setdefault("" if row["lang"] is None else "+" + row["lang"], []).append(row)
    names = sorted(groups, key=str.encode)
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = {name: tree([leaf_of(r) for r in groups[name]]) for name in names}
    top = tree([trees[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            siblings = path(trees[name], at) + path(top, place)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                changed = leaf_of(row | {"text": "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])})
            else:
                changed = leaf_of(row)
            for left, right in siblings:
                changed = digest(left, changed, right)
            root = top[-1][0]
            out.append((row["doc_id"], leaf_of(row), trees[name][-1][0], root, digest(*[x for s in siblings for x in s]), changed, changed == root))
    return sorted(out, key=repr)


def of(docs, rows):
    langs = docs([(i, t) for i, t, _ in rows]).sparkSession.createDataFrame([(n, x) for n, (_, _, x) in enumerate(rows)], "n long, l string")
    numbered = docs([(n, t) for n, (_, t, _) in enumerate(rows)]).drop("lang").join(langs.withColumnRenamed("n", "doc_id"), "doc_id").withColumnRenamed("l", "lang")
    ids = langs.sparkSession.createDataFrame([(n, i) for n, (i, _, _) in enumerate(rows)], "doc_id long, own long")
    return numbered.join(ids, "doc_id").withColumn("doc_id", F.col("own")).drop("own")


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "Lone", "en")],
        [(i, f"Text {i}", "en") for i in range(8)],
        [(i, f"Text {i}", "en") for i in range(9)],
        [(1, "A", "en"), (2, "B", None)],
        [(i, f"T{i}", f"l{i:02}") for i in range(20)],
        [(i, f"T{i}", f"l{i % 11}") for i in range(100)],
        [(i, t, ["en", "é", "z", None][i % 4]) for i, t in enumerate(ODD * 9)] + [(None, None, "en"), (None, "X", "en"), (5, "R", "en"), (5, "R", "en"), (5, "S", "en")],
        [(i, f"Text {i}", "en" if i % 50 else "de") for i in range(700)],
    ],
    ids=["one", "one run", "two runs", "two lone groups", "lone groups", "groups", "odd", "deep"],
)
def test_equals_brute_force(docs, rows):
    assert rows_of(verified(of(docs, rows)), *COLUMNS) == wanted(rows)


def test_no_rows(docs):
    assert verified(docs([])).collect() == [] and manifest(docs([])).collect() == []


def test_equal_rows_in_a_third_of_all(docs):
    rows = [(7, "Same", "en") if i % 3 == 0 else (100 + i, f"Text {i}", "en") for i in range(600)]
    assert rows_of(verified(of(docs, rows)), *COLUMNS) == wanted(rows)


def test_other_fans_and_clashing_names(spark):
    rows = [(i, f"{i % 3}", digest(str(i))) for i in range(40)]
    df = spark.createDataFrame(rows, "at long, `group` string, hex string").select("at", "group", F.unhex("hex").alias("digest"), F.lit(1).alias("tree"), F.lit(2).alias("row"), F.lit("x").alias("proof"))
    out = proofs(df, "group", ["at"], "digest", fan=2)
    assert out.columns == ["at", "group", "digest", "tree", "row", "subroot", "root", "proof"]
    found = out.select("at", fold(F.col("digest"), F.col("proof")).alias("to"), "root").collect()
    trees = [tree([h for _, g, h in rows if g == str(k)], 2) for k in range(3)]
    root = tree([t[-1][0] for t in trees], 2)[-1][0]
    assert len(found) == 40 and {(r["to"], r["root"]) for r in found} == {(root, root)}


def test_one_changed_row_is_found(docs):
    before = docs([(i, f"text {i}") for i in range(60)])
    kept = manifest(before)
    after = docs([(i, f"text {i}" if i != 33 else "other") for i in range(60)])
    from rushcart.llm.merkle import document_leaves

    now = after.select("doc_id", document_leaves(after).alias("now"))
    bad = kept.join(now, "doc_id").where(fold(F.col("now"), F.col("proof")) != F.col("root"))
    assert rows_of(bad, "doc_id") == [(33,)]
