import random
import re
from collections import defaultdict

import pytest

from rushcart.llm import components as components_module, ngram_join
from rushcart.llm.components import components
from rushcart.llm.ngram_join import first_of_groups, near_duplicates
from .conftest import ODD, prose, rows_of


def shingles(text, words):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def wanted(rows, words=4, percent=85):
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[top(i)] = top(j)
    ids = defaultdict(list)
    for i in range(len(rows)):
        ids[top(i)].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted([(rows[i][0], len(sets[i]), least[top(i)]) for i in range(len(rows))], key=repr)


def edited(text, share, rng):
    words = text.split(" ")
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    texts = [prose(rng.randrange(1, 120), rng.randrange(10**6), 5000) for _ in range(60)]
    for original in list(texts[:25]):
        for _ in range(rng.randrange(1, 12)):
            texts.append(edited(original, rng.choice([0, 0.005, 0.01, 0.02, 0.05]), rng))
    texts += [prose(60, 1) + " " + prose(6, i) for i in range(20)]
    texts += [t.upper() for t in texts[:3]]
    rng.shuffle(texts)
    return list(enumerate(texts))


COLUMNS = ("doc_id", "n_shingles", "component_id")


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (2, 100), (3, 50)])
def test_equals_all_pairs(docs, words, percent):
    rows = corpus(words)
    assert rows_of(near_duplicates(docs(rows).repartition(4), words, percent), *COLUMNS) == wanted(rows, words, percent)


def test_small_buckets_blocks_and_flushes_change_nothing(docs, monkeypatch):
    for name, value in (("PER_BUCKET", 300), ("FLUSH_BYTES", 4000), ("BLOCK", 3), ("REMEMBERED", 5), ("PARTNERS", 2), ("FLUSH_CLASSES", 7), ("HEADS", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    monkeypatch.setattr(components_module, "PER_TASK", 5)
    rows = corpus(77)
    assert rows_of(near_duplicates(docs(rows).repartition(5)), *COLUMNS) == wanted(rows)


def test_frequent_shingles_skip_the_buckets(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 0.0)
    rng = random.Random(5)
    line = prose(80, 3)
    rows = [(i, edited(line, rng.choice([0, 0.01, 0.03]), rng)) for i in range(1100)]
    assert rows_of(near_duplicates(docs(rows).repartition(6)), *COLUMNS) == wanted(rows)


def test_equal_partitions_count_no_shingle_twice(spark, docs):
    """Tasks that send the same classes in the same order; two of the texts have a Jaccard similarity of about 0.5."""
    common = prose(40, 1, 5000)
    texts = [f"{common} {prose(17, 2, 5000)}", f"{common} {prose(17, 3, 5000)}", prose(50, 4, 5000)]
    parts = [[(10 * k + i, t) for i, t in enumerate(texts)] for k in range(3)]
    a, b = shingles(texts[0], 4), shingles(texts[1], 4)
    assert 0.45 < len(a & b) / len(a | b) < 0.55
    rows = [r for part in parts for r in part]
    df = docs(rows)
    df = spark.createDataFrame(spark.sparkContext.parallelize(df.collect(), 3), df.schema)
    assert [len(x) for x in df.rdd.glom().collect()] == [3, 3, 3]
    assert rows_of(near_duplicates(df), *COLUMNS) == wanted(rows)


def test_odd_rows(docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(20, "a b c d e"), (20, "a b c d e"), (21, "A  B c\nd e"), (None, "a b c d e"), (None, None), (22, "lone words")]
    assert rows_of(near_duplicates(docs(rows)), *COLUMNS) == wanted(rows)
    assert near_duplicates(docs([])).count() == 0
    assert rows_of(near_duplicates(docs([(1, None), (2, " ")])), *COLUMNS) == [(1, 0, 1), (2, 0, 2)]


def test_one_row_of_each_group_stays(docs):
    rows = corpus(9) + [(None, "null id")]
    df = docs(rows)
    kept = first_of_groups(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted({c for _, _, c in wanted(corpus(9), 5, 80)})
    assert kept.where("doc_id IS NULL").count() == 1


def test_one_row_stays_where_ids_repeat_or_are_null(docs):
    """Of each component; the id 7 stands in three of them, twice with one text, and null ids in two."""
    a, b, c, d = (prose(60, i, 5000) for i in (11, 12, 13, 14))
    rows = [(7, a), (7, a), (8, a + " more"), (7, b), (5, b + " more"), (7, c), (7, c + " more"), (None, d), (None, d + " more"), (None, c), (None, " "), (4, None)]
    kept = [tuple(r) for r in first_of_groups(docs(rows)).select("doc_id", "text").collect()]
    of = lambda text: [(i, t) for i, t in kept if (t or "").startswith(text)]
    assert of(a) == [(7, a)] and of(b) == [(5, b + " more")]
    assert [i for i, _ in of(c)] == [7] and [i for i, _ in of(d)] == [None]
    assert sorted(kept, key=repr) == sorted([*of(a), *of(b), *of(c), *of(d), (None, " "), (4, None)], key=repr)


@pytest.mark.parametrize("per_task", [3, 1000])
def test_components_of_long_paths_stars_and_loops(spark, monkeypatch, per_task):
    monkeypatch.setattr(components_module, "PER_TASK", per_task)
    rng = random.Random(1)
    path = list(range(100, 160))
    links = list(zip(path, path[1:])) + [(1, x) for x in range(2, 40)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links]
    rng.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long").repartition(8)).collect()))
    assert got == {x: 100 for x in path} | {x: 1 for x in range(1, 40)} | {200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
