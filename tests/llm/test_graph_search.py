import numpy as np
import pytest
from pyspark.sql import types as T

from rushcart.llm import graph_search
from rushcart.llm.graph_search import Graph, build_index, nearest, nearest_neighbours

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("shard", T.StringType()), T.StructField("ids", T.StringType())])


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, None if x is None else [None if v is None else float(v) for v in x], "x", "y") for i, x in rows], SCHEMA)


def brute(rows, query, k):
    found = []
    for i, x in rows:
        if i != query[0] and len(x) == len(query[1]):
            found.append((-float((np.float32(x).astype(float) * np.float32(query[1]).astype(float)).sum()), i))
    return [(i, -s) for s, i in sorted(found)[:k]]


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_over_shards_and_blocks(vectors):
    rng = np.random.default_rng(1)
    rows = [(i, x) for i, x in enumerate(rng.normal(size=(1500, 16)) * rng.uniform(0.5, 2, (1500, 1)))]
    df = vectors(rows)
    got = answers(nearest(build_index(df, 10, shard_rows=400), df.where("vec_id % 20 = 0"), 10, block=16))
    assert len(got) == 75
    hits = 0
    for q, found in got.items():
        want = brute(rows, rows[q], 10)
        hits += len({i for i, _ in found} & {i for i, _ in want})
        scores = [s for _, s in found]
        assert scores == sorted(scores, reverse=True) and len(found) == 10
        assert dict(found)[found[0][0]] == pytest.approx(dict(brute(rows, rows[q], 1500))[found[0][0]], abs=1e-12)
    assert hits / 750 >= 0.95


@pytest.mark.parametrize("longest", ["one long vector", "lengths over a million", "gaussian"])
def test_recall_does_not_depend_on_lengths(vectors, longest):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(1500, 16))
    if longest != "gaussian":
        points /= np.linalg.norm(points, axis=1)[:, None]
    if longest == "one long vector":
        points[7] *= 10_000
    elif longest == "lengths over a million":
        points *= 10 ** rng.uniform(-3, 3, (1500, 1))
    rows = list(enumerate(points))
    got = answers(nearest_neighbours(vectors(rows), every=30, k=20))
    hits = sum(len({i for i, _ in found} & {i for i, _ in brute(rows, rows[q], 20)}) for q, found in got.items())
    assert hits / (50 * 20) >= 0.95


def test_equal_vectors_tie_to_the_smaller_id(vectors):
    rng = np.random.default_rng(2)
    same = rng.normal(size=8)
    rows = [(i, same if i % 3 == 0 else rng.normal(size=8)) for i in range(600)]
    got = answers(nearest_neighbours(vectors(rows), every=60, k=20))
    for q in (0, 60, 120):
        assert [i for i, _ in got[q]][:5] == [i for i, _ in brute(rows, rows[q], 5)]


def test_odd_rows(vectors):
    rows = [(0, [1, 0]), (20, [0.5, 0.5]), (1, None), (2, []), (3, [0, 0]), (4, [None, 1]), (5, [float("nan"), 1]), (6, [float("inf"), 1]), (7, [1, 2, 3]), (40, [1, 1, 1]), (None, [1, 1]), (8, [2, 0]), (8, [2, 0])]
    got = answers(nearest_neighbours(vectors(rows)))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {0: [8, 20], 20: [8, 0], 40: [7]}
    assert nearest_neighbours(vectors([])).count() == 0
    assert nearest_neighbours(vectors([(0, [1.0])])).count() == 0


def test_reruns_agree(vectors):
    rng = np.random.default_rng(3)
    rows = [(i, x) for i, x in enumerate(rng.normal(size=(300, 6)))]
    assert answers(nearest_neighbours(vectors(rows))) == answers(nearest_neighbours(vectors(rows[::-1]).repartition(3)))


def test_pruning_keeps_diverse_neighbours():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2]], np.float32)
    graph = Graph(points)
    graph.points = np.concatenate([points, np.zeros((4, 1), np.float32)], axis=1)
    graph.lengths = (graph.points**2).sum(axis=1)
    kept = graph.prune(np.array([0]), np.array([[1, 2, 3, 1, 0, -1]]), graph_search.ALPHA)
    assert kept[0][kept[0] >= 0].tolist() == [1, 3]
