from datetime import timedelta

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from rushcart.operators import journeys, traffic
from rushcart.sources.tables import load_table, stream_events
from rushcart.streaming import events as streaming

SF = "/root/testdata/sf0.001"
MINUTE, HOUR = timedelta(minutes=1), timedelta(hours=1)


@pytest.fixture
def feed(spark, events, tmp_path):
    """Batches of events as files that a stream takes up one by one."""

    def make(*batches):
        path = tmp_path / "in"
        for n, rows in enumerate(batches):
            events(rows).coalesce(1).write.mode("append").parquet(str(path))
            for f in path.glob("part-*.parquet"):
                f.rename(path / f"{n:03d}.parquet")
        import os

        for n in range(len(batches)):
            os.utime(path / f"{n:03d}.parquet", (n + 1, n + 1))
        return stream_events(spark, str(path), max_files=1, files="*.parquet")

    return make


@pytest.fixture
def run(spark, tmp_path):
    def go(stream, name="out"):
        out = str(tmp_path / name)
        query = streaming.write_stream(stream, out, str(tmp_path / f"{name}-checkpoint"))
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out), query

    return go


def closed(spark, delay):
    last = load_table(spark, SF, "events").agg(F.max("ts")).first()[0]
    return last.replace(microsecond=last.microsecond // 1000 * 1000) - delay


def test_late_rows_are_dropped_and_counted(feed, run):
    on_time = [(1, 0, 1, "view"), (2, 300, 1, "view")]
    within = [(3, 250, 1, "view"), (4, 400, 1, "view")]
    beyond = [(5, 10, 1, "view"), (6, 900, 1, "view")]
    got, query = run(streaming.stream_traffic(feed(on_time, within, beyond), MINUTE, timedelta(seconds=60)))
    assert tuples(got, "window_start", "requests") == [
        (at(0), 1),
        (at(240), 1),
        (at(300), 1),
        (at(360), 1),
    ]
    assert streaming.late_rows(query) == 1


def test_repeats_are_dropped_until_forgotten(feed, run):
    batches = (
        [(1, 0, 1, "view"), (1, 0, 1, "view")],
        [(1, 5, 1, "view"), (2, 900, 1, "view")],
        [(3, 950, 1, "view")],
        [(1, 1_000, 1, "view")],
    )
    got, _ = run(streaming.stream_dedupe(feed(*batches), ["event_id"], MINUTE))
    assert tuples(got, "event_id", F.col("ts").cast("timestamp_ntz")) == [
        (1, at(0)),
        (1, at(1_000)),
        (2, at(900)),
        (3, at(950)),
    ]


def test_closed_sessions_equal_the_batch_form(spark, run):
    gap, delay = timedelta(minutes=30), timedelta(minutes=10)
    got, _ = run(streaming.stream_sessions(stream_events(spark, SF, files="events.parquet"), gap, delay))
    batch = journeys.sessionize(load_table(spark, SF, "events"), gap)
    done = batch.where(F.col("session_end") + F.lit(gap) <= F.lit(closed(spark, delay)).cast("timestamp_ntz"))
    columns = ("user_id", "session_start", "session_end", "events")
    assert tuples(got, *columns) == tuples(done, *columns)


def test_a_session_goes_on_at_exactly_the_gap(feed, run):
    gap = timedelta(minutes=30)
    batches = [(1, 0, 1, "view"), (2, 1800, 1, "view")], [(3, 3600.000001, 1, "view")], [(4, 90_000, 2, "view")]
    got, _ = run(streaming.stream_sessions(feed(*batches), gap, MINUTE))
    assert tuples(got, "user_id", "session_start", "events") == [(1, at(0), 2), (1, at(3600.000001), 1)]


def test_closed_windows_equal_the_batch_form(spark, run):
    delay = timedelta(minutes=10)
    end = closed(spark, delay)
    log = load_table(spark, SF, "events")
    source = stream_events(spark, SF, files="events.parquet")
    for stream, batch, name in (
        (streaming.stream_traffic(source, HOUR, delay), traffic.traffic(log, HOUR).where("requests > 0"), "a"),
        (streaming.stream_sliding(source, HOUR, 15 * MINUTE, delay), traffic.traffic_sliding(log, HOUR, 15 * MINUTE), "b"),
    ):
        got, _ = run(stream, name)
        done = batch.where(F.col("window_start") + F.lit(HOUR) <= F.lit(end).cast("timestamp_ntz"))
        assert tuples(got, "window_start", "requests") == tuples(done, "window_start", "requests")


def test_unknown_users_stay_in_the_enriched_stream(spark, feed, run):
    customer = spark.createDataFrame([(1, "AUTO", 3)], "c_custkey long, c_mktsegment string, c_nationkey int")
    got, _ = run(streaming.stream_enrich(feed([(1, 0, 1, "view"), (2, 0, 9, "view"), (3, 0, None, "view")]), customer))
    assert tuples(got, "event_id", "segment", "nation_key") == [(1, "AUTO", 3), (2, None, None), (3, None, None)]


def test_conversions_meet_across_batches_and_stay_in_time(feed, run):
    source = feed([(1, 0, 1, "view"), (2, 10, 1, "purchase")], [(3, 60, 1, "purchase"), (4, 61, 1, "purchase"), (5, 5, 2, "purchase")])
    views, buys = (source.where(F.col("event_type") == t) for t in ("view", "purchase"))
    got, _ = run(streaming.stream_conversions(views, buys, MINUTE))
    assert tuples(got, "view_id", "purchase_id") == [(1, 2), (1, 3)]


def test_a_restart_writes_nothing_twice(feed, run):
    stream = feed([(1, 0, 1, "view"), (2, 500, 1, "view")])
    first, _ = run(streaming.stream_traffic(stream, MINUTE, MINUTE))
    again, _ = run(streaming.stream_traffic(stream, MINUTE, MINUTE))
    assert tuples(first, "*") == tuples(again, "*") and again.count() == 1


def test_every_late_row_of_a_group_counts(spark, feed, events, tmp_path):
    """Three late rows of one window arrive in one task, after the aggregation's map side one row."""
    # a batch is judged by the watermark that the batch before it began with
    source = feed([(1, 0, 1, "view"), (2, 3_000, 1, "view")], [(6, 2_990, 1, "view")], [(3, 10, 1, "view"), (4, 11, 1, "view"), (5, 12, 1, "view")])
    folder, out = str(tmp_path / "end"), str(tmp_path / "out")
    stream = streaming.stream_traffic(streaming.watched(streaming.with_end(source, folder)), MINUTE, MINUTE)
    runs = streaming.run_to_end(lambda: streaming.write_stream(stream, out, f"{out}-checkpoint"), spark, folder)
    windows = spark.read.parquet(out)
    assert tuples(windows, "window_start", "requests") == [(at(0), 1), (at(2940), 1), (at(3000), 1)]
    assert sum(map(streaming.late_rows, runs)) == 1
    assert streaming.late_requests(windows, *runs) == 3


def test_closed_runs_keep_only_the_last_row(spark, tmp_path):
    source, delay = stream_events(spark, SF, files="events.parquet"), timedelta(minutes=10)
    for name, make in (
        ("traffic", lambda s: streaming.stream_traffic(s, HOUR, delay, ["event_type"])),
        ("sliding", lambda s: streaming.stream_sliding(s, HOUR, 15 * MINUTE, delay)),
        ("sessions", lambda s: streaming.stream_sessions(s, 30 * MINUTE, delay)),
        ("dedupe", lambda s: streaming.stream_dedupe(s, ["event_id"], delay)),
    ):
        folder, out = str(tmp_path / f"{name}-end"), str(tmp_path / name)
        stream = make(streaming.with_end(source, folder))
        streaming.run_to_end(lambda: streaming.write_stream(stream, out, f"{out}-checkpoint"), spark, folder)  # noqa: B023
        assert streaming.open_state(spark, f"{out}-checkpoint").count() == (4 if name == "sliding" else 1), name


def test_conversions_keep_what_can_still_convert(spark, feed, run, tmp_path):
    rows = [(i, i * 10.0, i % 7, "view" if i % 2 else "purchase") for i in range(600)]
    source = feed(rows, [(600, 6_000.0, 99, "view"), (601, 6_000.0, 98, "purchase")])
    views, buys = (source.where(F.col("event_type") == t) for t in ("view", "purchase"))
    run(streaming.stream_conversions(views, buys, MINUTE))
    left, right = (streaming.open_state(spark, str(tmp_path / "out-checkpoint"), joinSide=side) for side in ("left", "right"))
    # the four views of the last minute stand in two spans each; no view can come before a purchase of now
    assert (left.count(), right.count()) == (8, 0)


def test_conversions_of_one_user_use_all_state_partitions(spark, feed, run, tmp_path):
    rows = [(i, i * 30.0, 1 if i % 10 else i, "view" if i % 3 else "purchase") for i in range(2_000)]
    source = feed(rows)
    views, buys = (source.where(F.col("event_type") == t) for t in ("view", "purchase"))
    got, query = run(streaming.stream_conversions(views, buys, 10 * MINUTE))
    want = [
        (v, b) for v, s, u, t in rows if t == "view" for b, s2, u2, t2 in rows[v : v + 30] if t2 == "purchase" and u2 == u and s < s2 <= s + 600
    ]
    assert tuples(got, "view_id", "purchase_id") == sorted(want, key=repr)
    read = [p for p in query.recentProgress if p.numInputRows][0].stateOperators[0]
    assert read.numRowsUpdated > 0
    log = source.sparkSession.read.parquet(str(tmp_path / "in"))
    batch = journeys.conversions(log.where("event_type = 'view'"), log.where("event_type = 'purchase'"), 10 * MINUTE)
    assert tuples(batch, "view_id", "purchase_id") == sorted(want, key=repr)
    spans = log.where("user_id = 1").select(F.pmod(F.hash("user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 6e8).cast("long")), F.lit(4)))
    assert spans.distinct().count() == 4
