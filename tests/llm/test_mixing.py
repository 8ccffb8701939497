import pytest

from rushcart.llm.mixing import mix, mixed_rows, targets
from .conftest import ODD, prose, rows_of


def filled(sizes, weights, total):
    """The rule as it is told: share by weight, stop at twice the size, share the rest anew."""
    goal, full = {}, set()
    while True:
        open_ = [s for s in sizes if s not in full]
        rest = total - sum(2 * sizes[s] for s in full)
        goal = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if goal[s] > 2 * sizes[s]}
        if not over:
            return goal | {s: 2 * sizes[s] for s in full}
        full |= over


def test_targets_are_shared_until_none_is_above(spark):
    sizes = {"sa": 1000, "sb": 10, "sc": 300, "sd": 1, "se": 0, "t": 700}
    weights = dict(zip(sorted(sizes), [3, 1, 2, 3, 1, 2]))
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "key string, size long")
    got = {r.key: r.target for r in targets(df).collect()}
    assert got == pytest.approx(filled(sizes, weights, 1.5 * sum(sizes.values())))


def test_takes_come_near_and_reruns_agree(docs):
    rows = [(i, prose(1 + i * 7 % 190, i), None if i % 7 == 0 else "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(900)]
    result = mix(docs(rows))
    per = result.groupBy("source_size", "target").agg({"taken": "sum", "copies": "max"}).collect()
    assert len(per) == 6
    for row in per:
        assert row["sum(taken)"] == pytest.approx(row.target, rel=0.01)
        assert row["max(copies)"] <= 2
    columns = ("doc_id", "size", "source_size", "target", "taken")
    again = mix(docs(list(reversed(rows))).repartition(5))
    plain = lambda df: [(a, b, c, round(d, 6), e) for a, b, c, d, e in rows_of(df, *columns)]
    assert plain(result) == plain(again)


def test_rates_rise_with_size_by_one_tilt(docs):
    """A source that must give more than it has takes its longer documents more often."""
    rows = [(i, prose(10 if i % 2 else 100, i), "a") for i in range(400)]
    taken = {r["size"]: r["avg(copies)"] for r in mix(docs(rows)).groupBy("size").agg({"copies": "avg"}).collect()}
    assert taken[100] > taken[10] > 1


def test_odd_rows(docs):
    rows = [(i, t, [None, "a", ""][i % 3]) for i, t in enumerate(ODD)] + [(3, "one two", "a"), (3, "one two", "a"), (None, "x y z", None)]
    result = mix(docs(rows))
    assert result.count() == len(rows)
    assert result.where("taken > 2 * size").count() == 0
    sizes = {r.doc_id: r["size"] for r in result.collect()}
    assert sizes[0] == sizes[1] == sizes[2] == 0 and sizes[8] == 2  # U+00A0 is no white space here
    assert mix(docs([])).count() == 0
    assert rows_of(mix(docs([(1, None), (2, "")])), "doc_id", "target", "taken") == [(1, 0.0, 0), (2, 0.0, 0)]


def test_mixed_rows_stand_as_often_as_taken(docs):
    df = docs([(i, prose(20 + i, i), f"s{i % 3}") for i in range(60)] + [(5, "a b c", "s0"), (5, "a b c", "s0")])
    mixed, copies = mixed_rows(df), mix(df).where("copies > 0")
    assert mixed.columns == df.columns
    assert mixed.count() == copies.agg({"copies": "sum"}).first()[0]


def test_groups_beyond_one_task_keep_their_share(docs, monkeypatch):
    monkeypatch.setattr("rushcart.llm.mixing.TOGETHER", 50)
    rows = [(i, "five words are in here", "a") for i in range(1000)]
    total = mix(docs(rows)).agg({"taken": "sum"}).first()[0]
    assert total == pytest.approx(1.5 * 5000, rel=0.02)
