"""Streaming forms. Streams come from :func:`rushcart.sources.tables.stream_events`.

Results leave in append mode: a window or session appears once, when the watermark
has passed its end, and its state is dropped then. An input that ends is closed with
:func:`with_end` and :func:`run_to_end`, so that its last windows appear too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rushcart.functions.spans import text
from rushcart.operators.journeys import conversions
from rushcart.sources.tables import EVENTS, stream_events

#: Time and user of the row that ends an input. Its own window or session never closes.
END, NOBODY = datetime(2500, 1, 1), -1


def stream_traffic(
    stream: DataFrame, width: timedelta, delay: timedelta, group: Sequence[str] = ()
) -> DataFrame:
    """Requests per fixed window; windows without requests do not appear."""
    return _windowed(stream, delay, F.window("ts", text(width)), group)


def stream_sliding(
    stream: DataFrame, width: timedelta, slide: timedelta, delay: timedelta
) -> DataFrame:
    return _windowed(stream, delay, F.window("ts", text(width), text(slide)), ())


def _windowed(stream, delay, window, group):
    return (
        stream.withWatermark("ts", text(delay))
        .groupBy(window.alias("_w"), *group)
        .agg(F.count("*").alias("requests"))
        .select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), *group, "requests")
    )


def stream_sessions(stream: DataFrame, gap: timedelta, delay: timedelta) -> DataFrame:
    return (
        stream.withWatermark("ts", text(delay))
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id", F.session_window("ts", text(gap)).alias("_w"))
        .agg(
            F.min("ts").cast("timestamp_ntz").alias("session_start"),
            F.max("ts").cast("timestamp_ntz").alias("session_end"),
            F.count("*").alias("events"),
        )
        .drop("_w")
    )


def stream_dedupe(stream: DataFrame, key: Sequence[str], delay: timedelta) -> DataFrame:
    """Drop rows whose key was seen less than ``delay`` before.

    Keys are forgotten with the first batch whose watermark has passed that.
    """
    return stream.withWatermark("ts", text(delay)).dropDuplicatesWithinWatermark(list(key))


def stream_enrich(stream: DataFrame, customer: DataFrame) -> DataFrame:
    """Add the customer's segment and nation key; events of unknown users keep nulls."""
    home = customer.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
    )
    return stream.join(home, "user_id", "left")


def stream_conversions(
    views: DataFrame, buys: DataFrame, within: timedelta, delay: timedelta = timedelta(0)
) -> DataFrame:
    """Views followed by a purchase of the same user at most ``within`` later.

    Both sides meet by user and span of ``within``, so a user with very many events is spread over
    the state partitions. Watermarks and the time range bound what is kept of either side.
    """
    pairs = conversions(views.withWatermark("ts", text(delay)), buys.withWatermark("ts", text(delay)), within)
    return pairs.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("viewed_at", "bought_at")})


def late_rows(query: StreamingQuery) -> int:
    """Rows that a run dropped for being late, over all of its progress reports.

    Fails where the session may have kept only the last of them; a larger
    ``spark.sql.streaming.numRecentProgressUpdates`` keeps more. Aggregations drop rows after
    partial aggregation: late rows of one group that arrive in one task count as one there, which
    :func:`late_requests` counts in full.
    """
    return sum(operator.numRowsDroppedByWatermark for progress in _reports(query) for operator in progress.stateOperators)


def _reports(query: StreamingQuery) -> list:
    reports = query.recentProgress
    if len(reports) >= int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates")):
        raise RuntimeError("progress reports were dropped: raise spark.sql.streaming.numRecentProgressUpdates")
    return reports


def watched(stream: DataFrame) -> DataFrame:
    """The stream, with its rows counted before anything is aggregated, for :func:`late_requests`."""
    return stream.observe("arrived", F.count_if(F.col("ts") < F.lit(END)).alias("rows"))


def late_requests(windows: DataFrame, *runs: StreamingQuery) -> int:
    """Rows of a :func:`watched` stream that came too late for their window, over all its ``runs``.

    ``windows`` is all that the closed runs have written: each row that arrived in time is counted
    in one of its windows, however late rows are grouped and spread over tasks.
    """
    arrived = sum(p.observedMetrics["arrived"]["rows"] for run in runs for p in _reports(run) if "arrived" in p.observedMetrics)
    return arrived - (windows.agg(F.sum("requests")).first()[0] or 0)


def open_state(spark: SparkSession, checkpoint: str, **options: str) -> DataFrame:
    """What a stopped query keeps in its state: (key, value, partition_id), a row per window, session,
    key or joined row that the watermark has not passed yet."""
    return spark.read.format("statestore").options(**options).load(checkpoint)


def with_end(events: DataFrame, folder: str) -> DataFrame:
    """A stream of events and, behind it, what :func:`run_to_end` puts into ``folder``, which is made here."""
    spark = events.sparkSession
    spark.createDataFrame([], EVENTS).write.mode("append").parquet(folder)
    return events.unionByName(stream_events(spark, folder))


def run_to_end(start: Callable[[], StreamingQuery], spark: SparkSession, folder: str) -> list[StreamingQuery]:
    """Runs a query until its input is used up, then once more over a last row far ahead of
    all others, which closes every window and session. ``start`` begins a run that goes on
    from the query's checkpoint. Gives both runs."""
    first = start()
    first.awaitTermination()
    last = [(None, END, NOBODY, None, None, None)]
    spark.createDataFrame(last, EVENTS).coalesce(1).write.mode("append").parquet(folder)
    query = start()
    query.awaitTermination()
    return [first, query]


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to parquet files, each batch exactly once, until the input is used up.

    A restart with the same checkpoint goes on where the last run stopped; the
    sink's log hides files of a batch that did not finish.
    """
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
