"""Streams over the event table, run until the input is used up and read back from files."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rushcart.sources.folders import work_folder
from rushcart.sources.tables import load_table, stream_events
from rushcart.streaming import events as streaming

HOUR = timedelta(hours=1)
DELAY = timedelta(minutes=10)


def _source(spark, sf_dir):
    return stream_events(spark, sf_dir, files="events.parquet")


def _finished(spark, stream, name):
    path = work_folder(spark, name)
    streaming.write_stream(stream, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.parquet(path)


def _closed(spark, sf_dir, make, name):
    """All windows or sessions of the table, the last ones too."""
    path, folder = work_folder(spark, name), work_folder(spark, f"{name}-end")
    stream = make(streaming.with_end(_source(spark, sf_dir), folder))
    streaming.run_to_end(lambda: streaming.write_stream(stream, path, f"{path}-checkpoint"), spark, folder)
    return spark.read.parquet(path)


def stream_traffic(spark, sf_dir):
    make = lambda events: streaming.stream_traffic(events, HOUR, DELAY, ["event_type"])
    return _closed(spark, sf_dir, make, "traffic")


def stream_sliding(spark, sf_dir):
    make = lambda events: streaming.stream_sliding(events, HOUR, timedelta(minutes=15), DELAY)
    return _closed(spark, sf_dir, make, "sliding")


def stream_sessions(spark, sf_dir):
    make = lambda events: streaming.stream_sessions(events, timedelta(minutes=30), DELAY)
    return _closed(spark, sf_dir, make, "sessions")


def stream_dedupe(spark, sf_dir):
    stream = streaming.stream_dedupe(_source(spark, sf_dir), ["event_id"], DELAY)
    return _finished(spark, stream.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "dedupe")


def stream_dedupe_of_repeats(spark, sf_dir):
    """Every event comes twice."""
    twice = _source(spark, sf_dir).unionByName(_source(spark, sf_dir))
    stream = streaming.stream_dedupe(twice, ["event_id"], DELAY)
    return _finished(spark, stream.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "dedupe")


def stream_late_rows(spark, sf_dir):
    """The events of the second half of the ids come first, so most of the first half is late."""
    events, folder, path = load_table(spark, sf_dir, "events"), work_folder(spark, "halves"), work_folder(spark, "late")
    middle = events.agg(F.expr("max(event_id) div 2")).first()[0]
    run = 0
    for half in (F.col("event_id") > middle, F.col("event_id") <= middle):
        events.where(half).write.mode("append").parquet(folder)
        stream = streaming.stream_dedupe(stream_events(spark, folder), ["event_id"], DELAY)
        query = streaming.write_stream(stream, path, f"{path}-checkpoint")
        query.awaitTermination()
        run += streaming.late_rows(query)
    return spark.read.parquet(path).agg(F.count("*").alias("kept")).withColumn("late", F.lit(run).cast("long"))


def stream_late_requests(spark, sf_dir):
    """The same halves into hourly windows, of which only those still open take late rows."""
    events, folder, path = load_table(spark, sf_dir, "events"), work_folder(spark, "halves"), work_folder(spark, "late-windows")
    middle = events.agg(F.expr("max(event_id) div 2")).first()[0]
    end, runs = work_folder(spark, "late-end"), []

    def start():
        stream = streaming.watched(streaming.with_end(stream_events(spark, folder), end))
        stream = streaming.stream_traffic(stream, HOUR, DELAY)
        return streaming.write_stream(stream, path, f"{path}-checkpoint")

    events.where(F.col("event_id") > middle).write.parquet(folder)
    runs.append(start())
    runs[0].awaitTermination()
    events.where(F.col("event_id") <= middle).write.mode("append").parquet(folder)
    runs += streaming.run_to_end(start, spark, end)
    windows = spark.read.parquet(path)
    late = streaming.late_requests(windows, *runs)
    return windows.agg(F.sum("requests").alias("kept")).withColumn("late", F.lit(late).cast("long"))


def stream_state(spark, sf_dir):
    """Rows that each kind of query keeps in its state after the whole table: what can still change."""
    makes = {
        "traffic": lambda events: streaming.stream_traffic(events, HOUR, DELAY, ["event_type"]),
        "sliding": lambda events: streaming.stream_sliding(events, HOUR, timedelta(minutes=15), DELAY),
        "sessions": lambda events: streaming.stream_sessions(events, timedelta(minutes=30), DELAY),
        "dedupe": lambda events: streaming.stream_dedupe(events, ["event_id"], DELAY),
    }
    counts = []
    for name, make in makes.items():
        path = work_folder(spark, f"state-{name}")
        streaming.write_stream(make(_source(spark, sf_dir)), path, f"{path}-checkpoint").awaitTermination()
        rows = streaming.open_state(spark, f"{path}-checkpoint").agg(F.count("*").alias("rows"))
        counts.append(rows.select(F.lit(name).alias("query"), "rows"))
    return reduce(DataFrame.unionByName, counts)


def stream_enrich(spark, sf_dir):
    stream = streaming.stream_enrich(
        _source(spark, sf_dir), load_table(spark, sf_dir, "customer")
    )
    return _finished(spark, stream.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "enrich")


def stream_conversions(spark, sf_dir):
    views = _source(spark, sf_dir).where("event_type = 'view'")
    buys = _source(spark, sf_dir).where("event_type = 'purchase'")
    stream = streaming.stream_conversions(views, buys, timedelta(hours=6), DELAY)
    return _finished(spark, stream, "conversions")


PLANS = {
    "stream_traffic": (
        stream_traffic,
        """
        SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS requests
        FROM events GROUP BY 1, 2""",
    ),
    "stream_sliding": (
        stream_sliding,
        """
        WITH starts AS (
          SELECT time_bucket(INTERVAL 15 MINUTE, ts) - back * INTERVAL 15 MINUTE AS window_start
          FROM events, range(4) AS r(back))
        SELECT window_start, count(*) AS requests FROM starts GROUP BY window_start""",
    ),
    "stream_sessions": (
        stream_sessions,
        """
        WITH flagged AS (
          SELECT user_id, ts,
                 CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        numbered AS (
          SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM flagged)
        SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events
        FROM numbered GROUP BY user_id, no""",
    ),
    "stream_dedupe": (stream_dedupe, "SELECT DISTINCT ON (event_id) * FROM events ORDER BY event_id, ts"),
    "stream_dedupe_of_repeats": (stream_dedupe_of_repeats, "SELECT * FROM events"),
    "stream_late_rows": (
        stream_late_rows,
        # The watermark is the latest time seen, in whole milliseconds, less the delay.
        """
        WITH halves AS (SELECT *, event_id > (SELECT max(event_id) // 2 FROM events) AS early FROM events),
        mark AS (
          SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS at FROM halves WHERE early)
        SELECT count(*) FILTER (WHERE early OR ts >= mark.at) AS kept, count(*) FILTER (WHERE NOT early AND ts < mark.at) AS late
        FROM halves, mark""",
    ),
    "stream_late_requests": (
        stream_late_requests,
        """
        WITH halves AS (SELECT *, event_id > (SELECT max(event_id) // 2 FROM events) AS early FROM events),
        mark AS (
          SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS at FROM halves WHERE early),
        judged AS (
          SELECT early OR date_trunc('hour', ts) + INTERVAL 1 HOUR > mark.at AS kept FROM halves, mark)
        SELECT count(*) FILTER (WHERE kept) AS kept, count(*) FILTER (WHERE NOT kept) AS late FROM judged""",
    ),
    "stream_state": (
        stream_state,
        # A window is open until its end, a session until its gap and a key until its delay have passed.
        """
        WITH mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS at FROM events),
        flagged AS (
          SELECT user_id, ts,
                 CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        numbered AS (
          SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM flagged),
        sessions AS (SELECT max(ts) AS ends FROM numbered GROUP BY user_id, no),
        slides AS (
          SELECT DISTINCT time_bucket(INTERVAL 15 MINUTE, ts) - back * INTERVAL 15 MINUTE AS starts
          FROM events, range(4) AS r(back)),
        hours AS (SELECT DISTINCT date_trunc('hour', ts) AS starts, event_type FROM events)
        SELECT 'traffic' AS query, count(*) AS rows FROM hours, mark WHERE starts + INTERVAL 1 HOUR > mark.at
        UNION ALL SELECT 'sliding', count(*) FROM slides, mark WHERE starts + INTERVAL 1 HOUR > mark.at
        UNION ALL SELECT 'sessions', count(*) FROM sessions, mark WHERE ends + INTERVAL 30 MINUTE > mark.at
        UNION ALL SELECT 'dedupe', count(*) FROM events, mark WHERE ts + INTERVAL 10 MINUTE > mark.at""",
    ),
    "stream_enrich": (
        stream_enrich,
        """
        SELECT events.*, c_mktsegment AS segment, c_nationkey AS nation_key
        FROM events LEFT JOIN customer ON c_custkey = user_id""",
    ),
    "stream_conversions": (
        stream_conversions,
        """
        SELECT v.user_id, v.event_id AS view_id, v.ts AS viewed_at,
               b.event_id AS purchase_id, b.ts AS bought_at
        FROM events v JOIN events b ON b.user_id = v.user_id
          AND b.ts > v.ts AND b.ts <= v.ts + INTERVAL 6 HOUR
        WHERE v.event_type = 'view' AND b.event_type = 'purchase'""",
    ),
}
