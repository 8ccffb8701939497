import random
from datetime import timedelta

import pytest
from conftest import at, plan, tuples
from pyspark.sql import Window, functions as F

from rushcart.operators import traffic

MINUTE = timedelta(minutes=1)


def test_empty_windows_count_zero_for_every_group(events):
    log = events([(1, 0, 1, "view"), (2, 200, 1, "click"), (3, 201, 1, "click"), (4, None, 1, "view")])
    got = traffic.traffic(log, MINUTE, ["event_type"])
    assert tuples(got, "event_type", "window_start", "requests") == sorted(
        [("view", at(0), 1), ("view", at(60), 0), ("view", at(120), 0), ("view", at(180), 0)]
        + [("click", at(0), 0), ("click", at(60), 0), ("click", at(120), 0), ("click", at(180), 2)],
        key=repr,
    )
    assert traffic.traffic(log, MINUTE).count() == 4
    assert traffic.traffic(events([]), MINUTE).count() == 0


def test_window_counts_add_up(events):
    log = events([(i, i * 37.0, 1, "view") for i in range(500)])
    assert traffic.traffic(log, MINUTE).agg({"requests": "sum"}).first()[0] == 500


def test_sliding_windows_with_uneven_slide(events):
    """Width 90 s is no multiple of slide 60 s: panes of 30 s."""
    seconds = [0, 29, 30, 59, 61, 89, 90, 150, 151]
    log = events([(i, s, 1, "view") for i, s in enumerate(seconds)])
    got = traffic.traffic_sliding(log, timedelta(seconds=90), MINUTE)
    want = [(at(w), n) for w in range(-60, 240, 60) if (n := sum(w <= s < w + 90 for s in seconds))]
    assert tuples(got, "window_start", "requests") == sorted(want, key=repr)


def test_peaks_break_ties_by_time(events):
    log = events([(1, 0, 1, "view"), (2, 60, 1, "view"), (3, 120, 1, "view"), (4, 121, 1, "view")])
    got = traffic.peak_windows(log, MINUTE, 2).collect()
    assert [(r["window_start"], r["requests"]) for r in got] == [(at(120), 2), (at(0), 1)]


def test_a_spike_needs_two_windows_before_it(events):
    counts = [9, 1, 1, 1, 9]
    log = events([(w * 100 + i, w * 60, 1, "view") for w, n in enumerate(counts) for i in range(n)])
    got = traffic.spikes(traffic.traffic(log, MINUTE), 3, 2.0)
    assert [r["is_spike"] for r in got.orderBy("window_start").collect()] == [False] * 4 + [True]


def test_groups_get_all_windows_whatever_the_chunk(events, monkeypatch):
    rows = [(i, i * 37.0, 1, ["view", "click", None][i % 3]) for i in range(60)]
    want = tuples(traffic.traffic(events(rows), MINUTE, ["event_type"]), "window_start", "event_type", "requests")
    assert len(want) == 3 * 37 and sum(r[2] for r in want) == 60
    monkeypatch.setattr(traffic._grid, "__defaults__", (3,))
    assert tuples(traffic.traffic(events(rows), MINUTE, ["event_type"]), "window_start", "event_type", "requests") == want


def test_ten_million_windows_of_a_second(events):
    log = events([(1, 0, 1, "view"), (2, 10_000_000, 1, "view"), (3, 10_000_000.5, 1, "view")])
    got = traffic.traffic(log, timedelta(seconds=1))
    assert got.agg(F.count("*"), F.sum("requests"), F.max("requests"), F.max("window_start")).first()[:] == (10_000_001, 3, 2, at(10_000_000))
    assert "sequence" not in plan(got)


@pytest.mark.parametrize("group", [[], ["event_type"]])
@pytest.mark.parametrize("rows", [1_000_000, 15, 4])
def test_spikes_do_not_depend_on_the_pieces(events, group, rows):
    rng = random.Random(1)
    log = events([(i, rng.randrange(100) ** 2 * 1.0, 1, rng.choice(["view", "click"])) for i in range(900)])
    counted = traffic.traffic(log, 2 * MINUTE, group).persist()
    before = Window.partitionBy(*group).orderBy("window_start").rowsBetween(-4, -1)
    limit = F.avg("requests").over(before) + 2.0 * F.stddev_samp("requests").over(before)
    want = counted.withColumn("is_spike", F.coalesce((F.count("*").over(before) >= 2) & (F.col("requests") > limit), F.lit(False)))
    got = traffic.spikes(counted, 4, 2.0, group, rows=rows)
    columns = ("window_start", *group, "requests", "is_spike")
    assert tuples(got, *columns) == tuples(want, *columns) and got.where("is_spike").count() > 2
    assert "SinglePartition" not in plan(got)
