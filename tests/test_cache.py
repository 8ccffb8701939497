import random
from datetime import timedelta

import pytest
from conftest import at, tuples

from rushcart.operators import cache


def log(seed=1, n=500):
    rng = random.Random(seed)
    return [
        (i, float(rng.randint(0, 3_000)), 1 if rng.random() < 0.6 else rng.choice([2, 3, 4, None]), "view")
        for i in range(n)
    ]


@pytest.mark.parametrize("hot_rows", [1_000_000, 30, 2])
def test_gaps_follow_their_definition(events, hot_rows):
    rows, last, want = log(), {}, []
    for i, s, u, _ in sorted((r for r in rows if r[2] is not None), key=lambda r: r[1]):
        want.append((u, at(s), round((s - last[u]) * 1e6) if u in last else None))
        last[u] = s
    got = cache.reuse_gaps(events(rows), "user_id", hot_rows=hot_rows)
    assert tuples(got, "user_id", "ts", "gap_us") == sorted(want, key=repr)


def test_first_uses_are_misses(events):
    gaps = cache.reuse_gaps(events([(1, 0, 1, "v"), (2, 60, 1, "v"), (3, 121, 1, "v"), (4, 0, 2, "v")]), "user_id")
    got = cache.ttl_hit_share(gaps, [timedelta(seconds=60), timedelta(seconds=61)])
    assert tuples(got, "ttl_s", "accesses", "hits", "hit_share") == [(60.0, 4, 1, 0.25), (61.0, 4, 2, 0.5)]


def test_coverage_reaches_everything(events):
    data = events(log())
    got = cache.coverage_curve(data, "user_id").orderBy("uses").first()
    known = data.where("user_id IS NOT NULL")
    assert (got["keys"], got["accesses"], got["share"]) == (4, known.count(), 1.0)


def test_sketch_finds_the_hot_key_within_its_error(events):
    data = events(log(n=2_000))
    exact = cache.hot_keys(data, "user_id", 1).first()
    near = cache.hot_keys_approx(data, "user_id", 1, tracked=100).first()
    assert near["user_id"] == exact["user_id"] == 1
    assert abs(near["share"] - exact["share"]) < 0.05


def test_approximate_working_set_is_close(spark, events):
    data = events([(i, 0, i % 2_000, "view") for i in range(4_000)])
    day = timedelta(days=1)
    assert cache.working_set(data, "user_id", day).first()["keys"] == 2_000
    assert abs(cache.working_set(data, "user_id", day, approx=True).first()["keys"] - 2_000) < 300


@pytest.mark.parametrize("hashed", [False, True])
def test_spread_covers_every_server(events, hashed):
    got = cache.load_spread(events(log()), "user_id", 6, hashed=hashed)
    assert got.count() == 6
    assert got.agg({"requests": "sum"}).first()[0] == sum(r[2] is not None for r in log())


def test_one_key_on_two_servers_is_twice_the_mean(events):
    got = cache.load_spread(events([(1, 0, 4, "view"), (2, 1, 4, "view")]), "user_id", 2)
    assert tuples(got, "bucket", "requests", "imbalance") == [(0, 2, 2.0), (1, 0, 2.0)]


@pytest.mark.parametrize("slots", [1, 7, 64, 1 << 16])
@pytest.mark.parametrize("k", [1, 5, 40, 1_000])
def test_counted_keys_are_the_hot_keys(spark, slots, k):
    """Even ones, uneven ones and ties; few slots take the second pass or all of them."""
    rng = random.Random(k)
    keys = [int(rng.paretovariate(0.8)) % 300 for _ in range(3_000)] + list(range(300)) * 2 + [None] * 50
    df = spark.createDataFrame([(x,) for x in keys], "key long")
    columns = ("key", "uses", "share")
    assert tuples(cache.hot_keys_counted(df, "key", k, slots=slots), *columns) == tuples(cache.hot_keys(df, "key", k), *columns)


def test_counted_keys_of_nothing(spark):
    assert cache.hot_keys_counted(spark.createDataFrame([], "key long"), "key", 3).count() == 0


def test_sliding_working_sets_merge_panes(events):
    rng = random.Random(3)
    rows = [(i, float(rng.randrange(6_000)), rng.randrange(3_000), "view") for i in range(9_000)]
    width, slide = timedelta(seconds=1_500), timedelta(seconds=600)
    got = {r["window_start"]: r["keys"] for r in cache.working_set_sliding(events(rows), "user_id", width, slide).collect()}
    for start in range(-1_200, 6_000, 600):
        exact = len({u for _, s, u, _ in rows if start <= s < start + 1_500})
        assert abs(got[at(start)] - exact) <= 4 * 1.04 / 64 * exact + 1
    assert len(got) == 12 and cache.working_set_sliding(events([]), "user_id", width, slide).count() == 0


def test_shared_keys_are_in_their_band(spark):
    rows = [("V1", i) for i in range(30_000)] + [("V2", i) for i in range(20_000, 40_000)] + [("V3", 1), ("V1", None)]
    df = spark.createDataFrame(rows * 2, "version string, user long")
    got = cache.shared_keys(df, "user", "version", "V1", "V2").first()
    assert got["low_both"] <= 10_000 <= got["high_both"] and got["high_both"] - got["low_both"] < 2_500
    assert abs(got["either"] - 40_000) < 2_500 and abs(got["only_a"] - 20_000) < 2_000 and abs(got["only_b"] - 10_000) < 2_000
    few = cache.shared_keys(df, "user", "version", "V3", "V1").first()
    assert (few["both"], few["only_a"]) == (1, 0) or abs(few["both"] - 1) < 10
    none = cache.shared_keys(df, "user", "version", "V8", "V9").first()
    assert (none["either"], none["both"], none["low_both"], none["high_both"]) == (0, 0, 0.0, 0.0)
