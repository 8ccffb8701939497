import hashlib

from rushcart.llm.exact import CuckooFilter, LiveIndex, exact_dedup, unique_rows, update_index
from .conftest import ODD, rows_of


def wanted(rows):
    out = []
    done = set()
    for i, text in rows:
        same = [(j if j is not None else -(2**63)) for j, t in rows if (t or "") == (text or "")]
        keep = max(same)
        own = i if i is not None else -(2**63)
        kept = own == keep and (text or "") not in done
        if kept:
            done.add(text or "")
        out.append((i, None if keep == -(2**63) else keep, len(same), kept, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_equals_brute_force(docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, t) for i, t in enumerate(ODD[:6])] + [(7, "tied"), (7, "tied"), (6, "tied"), (None, "lone"), (None, None)]
    assert rows_of(exact_dedup(docs(rows)), *COLUMNS) == wanted(rows)


def test_no_rows(docs):
    assert exact_dedup(docs([])).count() == 0
    assert unique_rows(docs([])).count() == 0


def test_one_text_in_a_third_of_the_rows(docs):
    rows = [(i, "same" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    result = exact_dedup(docs(rows))
    assert result.where("kept").count() == 2001
    assert rows_of(result.where("group_size > 1 AND kept"), "doc_id", "group_size") == [(2997, 1000)]


def test_unique_rows_keep_their_columns(docs):
    df = docs([(1, "a"), (2, "a"), (2, "a"), (3, None), (4, "")])
    kept = unique_rows(df)
    assert kept.columns == df.columns
    assert rows_of(kept, "doc_id", "text") == [(2, "a"), (4, "")]


def test_filter_inserts_deletes_and_overflows():
    digests = [(i * 0x9E3779B97F4A7C15) % 2**63 for i in range(1, 400)]
    table = CuckooFilter(128)
    assert all(map(table.insert, digests)) and all(d in table for d in digests)
    assert all(map(table.delete, digests[::2])) and all(d in table for d in digests[1::2])
    assert sum(d in table for d in digests[::2]) < 20
    assert not all(map(CuckooFilter(16).insert, digests))


def test_index_grows_from_its_keys_and_tells_false_claims():
    index = LiveIndex()
    index.filter = CuckooFilter(2)
    for i in range(500):
        index.add(i % 250, f"sha {i}", i, 1, 1)  # two contents for each digest
    assert index.live == 500 and index.filter.mask > 1
    index.add(3, "sha 3", 900, 2, 1)
    index.remove(4, "sha 4", 1)
    index.remove(4, "not there", 1)
    found = {sha: (keep, rows) for _, sha, keep, rows, _ in index.rows()}
    assert found["sha 3"] == (900, 3) and "sha 4" not in found and found["sha 254"] == (254, 1)


def test_live_contents_follow_additions_and_removals(spark, docs):
    none = spark.createDataFrame([], "digest long, sha string, rows long")
    first = update_index(none, docs([(1, "a"), (2, "a"), (3, "b")]), docs([]))
    second = update_index(first, docs([(4, "c")]), docs([(1, "a"), (3, "b"), (9, "never")]))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert rows_of(second, "sha", "rows") == sorted([(sha("a"), 1), (sha("c"), 1)], key=repr)
