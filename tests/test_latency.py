import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from conftest import at, plan, tuples

from rushcart.operators import latency


def load(seed, n=800):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        route = 1 if rng.random() < 0.6 else rng.choice([2, 3, None])
        value = rng.choice([None, rng.uniform(0, 3), rng.expovariate(0.02), 10.0, -1.5, 0.0])
        rows.append((rng.choice(["V1", "V2"]), route, float(rng.randint(0, 500)), value, rng.random() < 0.3))
    return rows


def disc(values, q):
    values = sorted(values)
    return values[max(1, math.ceil(round(q * len(values), 9))) - 1]


@pytest.mark.parametrize("ordered", [1, 20, 10**9])
def test_quantiles_follow_their_definition(samples, ordered):
    rows, probs = load(1), (0.001, 0.5, 0.95, 1.0)
    want = []
    for key in {(r[0], r[1]) for r in rows}:
        here = [r for r in rows if (r[0], r[1]) == key]
        known = [r[3] for r in here if r[3] is not None]
        want.append((*key, len(here), *[disc(known, q) for q in probs]))
    got = latency.latency_summary(samples(rows), ["version", "route"], probs, ordered=ordered)
    assert tuples(got, "version", "route", "requests", "p0_1", "p50", "p95", "p100") == sorted(want, key=repr)


def test_brackets_hold_few_values_of_any_distribution(spark, monkeypatch):
    from rushcart.functions import quantiles

    widths = []
    narrowed = quantiles._narrowed

    def watched(*args):
        out = narrowed(*args)
        widths.append(sorted(r["size"] for r in out.collect()))
        return out

    monkeypatch.setattr(quantiles, "_narrowed", watched)
    rows = spark.range(300_000).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 3 == 0, F.rand(1)).when(F.col("id") % 3 == 1, F.exp(F.randn(2) * 20)).otherwise((F.rand(3) * 5).cast("int")).alias("x"),
    )
    rows.write.parquet(path := spark.conf.get("spark.checkpoint.dir") + "/quantile-rows")
    rows = spark.read.parquet(path)
    probs = [0.0, 0.001, 0.5, 0.95, 0.9999, 1.0]
    got = {(r.g, r.q): r.x for r in quantiles.exact_quantiles(rows, ["g"], "x", probs, ordered=500).collect()}
    per = {}
    for r in rows.collect():
        per.setdefault(r.g, []).append(r.x)
    for g, values in per.items():
        assert {q: got[g, quantiles.column_name(q)] for q in probs} == {q: disc(values, q) for q in probs}
    assert len(widths) >= 2 and widths[0][0] < 10_000


def test_ranks_go_on_from_range_to_range(spark):
    from rushcart.functions.ranks import ranked

    rows = spark.range(1_000).select(F.col("id").alias("g"), F.when(F.col("id") % 50 != 0, (F.col("id") * 7 % 13).cast("decimal(20,0)")).alias("s"))
    order = [F.desc_nulls_last("s"), F.asc("g")]
    got = {r.g: (r["rank"], r.running) for r in ranked(rows, order, "s", rows=90).collect()}
    expected = sorted(rows.collect(), key=lambda r: (r.s is None, -(r.s or 0), r.g))
    total = 0
    for n, r in enumerate(expected, 1):
        total += r.s or 0
        assert got[r.g] == (n, total)


def test_summary_without_latencies_and_without_rows(samples):
    got = latency.latency_summary(samples([("V1", 1, 0, None, False)]), ["route"], [0.5])
    assert tuples(got, "requests", "mean_ms", "p50") == [(1, None, None)]
    assert latency.latency_summary(samples([]), ["route"]).count() == 0


def test_sketches_merge_and_stay_near_the_rank(samples):
    rng = random.Random(2)
    rows = [("V1", d % 4, d * 3600, rng.expovariate(0.02), False) for d in range(8_000)]
    sketches = latency.latency_sketch(samples(rows), ["route"])
    got = latency.sketch_quantiles(sketches, [], [0.5, 0.95]).first()
    ordered = sorted(r[3] for r in rows)
    assert got["requests"] == len(rows)
    for q, value in ((0.5, got["p50"]), (0.95, got["p95"])):
        rank = sum(v <= value for v in ordered) / len(ordered)
        assert abs(rank - q) < 0.03


def test_histogram_counts_every_latency_once(samples):
    rows = [("V1", 1, 0, v, False) for v in (-1.0, 5.0, 4.999, 10.0, 1e9, None)]
    got = latency.latency_histogram(samples(rows), [5.0, 10.0])
    assert tuples(got, "band", "from_ms", "to_ms", "requests") == [
        (0, None, 5.0, 2),
        (1, 5.0, 10.0, 1),
        (2, 10.0, None, 2),
    ]


@pytest.mark.parametrize("hot_rows", [1_000_000, 50, 3])
def test_error_runs_follow_their_definition(samples, hot_rows):
    rows = load(7)
    want = []
    for route in (1, 2, 3):
        path = sorted((r[2], r[4]) for r in rows if r[1] == route)
        run = []
        for s, failed in [*path, (None, False)]:
            if failed:
                run.append(s)
            elif run:
                want.append((route, at(run[0]), at(run[-1]), len(run)))
                run = []
    got = latency.error_runs(samples(rows), "route", hot_rows=hot_rows)
    assert tuples(got, "route", "run_start", "run_end", "length") == sorted(want, key=repr)


def test_one_long_run_crosses_many_slices(samples):
    rows = [("V1", 1, i, 1.0, True) for i in range(100)]
    got = latency.error_runs(samples(rows), "route", hot_rows=4)
    assert tuples(got, "run_start", "run_end", "length") == [(at(0), at(99), 100)]


def test_slow_samples_are_above_their_own_group(samples):
    rows = [("V1", r, i, float(i * r), False) for r in (1, 100) for i in range(1, 11)]
    got = latency.slow_samples(samples(rows), ["route"], 0.9)
    assert tuples(got, "route", "latency_ms") == [(1, 10.0), (100, 1000.0)]


def test_bottleneck_shares_add_up(samples):
    got = latency.bottlenecks(samples(load(3)), ["route"]).orderBy("rank").collect()
    assert abs(got[-1]["running_share"] - 1.0) < 1e-12
    assert [r["rank"] for r in got] == [1, 2, 3, 4]


def test_busier_windows_go_to_higher_bands(samples):
    rows = [("V1", 1, 0, 1.0, False)] + [("V1", 1, 60 + i / 100, 9.0, i == 0) for i in range(10)]
    got = latency.load_vs_latency(samples(rows), timedelta(minutes=1), 2)
    assert tuples(got, "band", "windows", "requests", "error_rate", "mean_p95") == [
        (0, 1, 1, 0.0, 1.0),
        (1, 1, 10, 0.1, 9.0),
    ]


def test_raw_samples_never_meet_in_one_partition(samples):
    data = samples(load(1))
    for df in (
        latency.latency_summary(data, ["version", "route"]),
        latency.slow_samples(data, ["route"], 0.9),
        latency.error_runs(data, "route"),
    ):
        assert "SinglePartition" not in plan(df)


def test_a_day_of_sketches_is_replaced_with_all_its_groups(spark, samples, tmp_path):
    path, day = str(tmp_path / "days"), 86_400
    first = [("V1", 1, 0, 1.0, False), ("V1", 1, day, 2.0, False), ("V2", 1, day, 9.0, False)]
    latency.write_day_sketches(samples(first), path, ["version"])
    latency.write_day_sketches(samples([("V1", 1, day, float(v), False) for v in range(5)] + [("V1", 1, 2 * day, 7.0, False)]), path, ["version"])
    stored = spark.read.parquet(path)
    got = latency.sketch_quantiles(stored, ["day", "version"], [0.5])
    assert [(str(r["day"]), r["version"], r["requests"], r["p50"]) for r in got.orderBy("day", "version").collect()] == [
        ("2024-01-01", "V1", 1, 1.0), ("2024-01-02", "V1", 5, 2.0), ("2024-01-03", "V1", 1, 7.0),
    ]
    assert latency.sketch_quantiles(stored, ["version"], [0.5]).first()["requests"] == 7
