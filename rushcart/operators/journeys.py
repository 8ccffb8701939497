"""How visitors move through the shop. Events are ordered by ``(ts, event_id)``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from rushcart.functions.skew import HOT_ROWS, cut_hot_keys, nearest
from rushcart.functions.spans import MICROSECOND, micros, text
from rushcart.sources.folders import stored

ORDER = ("ts", "event_id")


def funnel(
    events: DataFrame, steps: Sequence[str], within: timedelta, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """How far visitors get along ``steps``.

    From every first-step event the walk goes to the nearest later event of the
    next step, if that lies at most ``within`` ahead, and on from there. One row
    per step: ``users`` and ``starts`` (first-step events) that reach it. Events
    without a user are left out.
    """
    rows = events.where(F.col("event_type").isin(*steps) & F.col("user_id").isNotNull()).select(
        "user_id", *ORDER, "event_type"
    )
    rows, cut = cut_hot_keys(rows, "user_id", "ts", hot_rows)
    rows = rows.withColumn("reach", F.lit(1))
    for here, after in reversed(list(zip(steps, steps[1:]))):
        goal = F.when(F.col("event_type") == after, F.struct("ts", "reach"))
        rows = nearest(rows, "user_id", ORDER, goal, "_next", cut=cut, later=True)
        arrives = F.col("_next.ts") <= F.col("ts") + F.lit(within)
        rows = rows.withColumn(
            "reach",
            F.when(
                F.col("event_type") == here, F.when(arrives, F.col("_next.reach") + 1).otherwise(1)
            ).otherwise(F.col("reach")),
        ).drop("_next")
    depth = range(1, len(steps) + 1)
    per_user = (
        rows.where(F.col("event_type") == steps[0])
        .groupBy("user_id")
        .agg(
            F.max("reach").alias("far"),
            *[F.count_if(F.col("reach") >= i).alias(f"starts_{i}") for i in depth],
        )
    )
    totals = per_user.agg(
        *[F.count_if(F.col("far") >= i).alias(f"users_{i}") for i in depth],
        *[F.coalesce(F.sum(f"starts_{i}"), F.lit(0)).alias(f"starts_{i}") for i in depth],
    )
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("step_no"),
                        F.lit(step).alias("step"),
                        F.col(f"users_{i}").alias("users"),
                        F.col(f"starts_{i}").alias("starts"),
                    )
                    for i, step in zip(depth, steps)
                ]
            )
        )
    )


def last_touch(
    events: DataFrame, target: str, source: str, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The last ``source`` event of the same user before each ``target`` event.

    Targets without one, and targets without a user, keep null in ``touch_id`` and
    ``touch_ts``.
    """
    rows = events.where(F.col("event_type").isin(target, source)).select(
        "user_id", *ORDER, "event_type"
    )
    known, cut = cut_hot_keys(rows.where(F.col("user_id").isNotNull()), "user_id", "ts", hot_rows)
    touch = F.when(
        F.col("event_type") == source, F.struct(F.col("event_id").alias("id"), F.col("ts").alias("at"))
    )
    touched = nearest(known, "user_id", ORDER, touch, "_touch", cut=cut)
    nobody = rows.where(F.col("user_id").isNull())
    return (
        touched.unionByName(nobody, allowMissingColumns=True)
        .where(F.col("event_type") == target)
        .select(
            "event_id",
            "user_id",
            "ts",
            F.col("_touch.id").alias("touch_id"),
            F.col("_touch.at").alias("touch_ts"),
        )
    )


def conversions(views: DataFrame, buys: DataFrame, within: timedelta) -> DataFrame:
    """Views followed by a purchase of the same user more than 0 and at most ``within`` later.

    A purchase belongs to one span of that length, a view to its own and the next one, where
    each pair meets once. So rows meet by user and span, and a user with very many events is
    dealt out by time. Works on tables and, with watermarks on ``ts``, on streams.
    """
    length = within // MICROSECOND
    span = ((micros("ts") - F.pmod(micros("ts"), F.lit(length))) / F.lit(length)).cast("long")
    v = views.select(
        "user_id",
        F.col("event_id").alias("view_id"),
        F.col("ts").alias("viewed_at"),
        F.explode(F.array(span, span + 1)).alias("_span"),
    )
    b = buys.select(
        F.col("user_id").alias("_buyer"),
        F.col("event_id").alias("purchase_id"),
        F.col("ts").alias("bought_at"),
        span.alias("_bought"),
    )
    meets = (F.col("user_id") == F.col("_buyer")) & (F.col("_span") == F.col("_bought"))
    in_time = (F.col("bought_at") > F.col("viewed_at")) & (
        F.col("bought_at") <= F.col("viewed_at") + F.lit(within)
    )
    return v.join(b, meets & in_time).drop("_buyer", "_span", "_bought")


def sessionize(events: DataFrame, gap: timedelta) -> DataFrame:
    """Sessions per user; a session ends where more than ``gap`` passes without an event.

    Two events in one tile of width ``gap`` are never further apart than that, so
    events are first reduced to one row per user and tile, on the map side, and
    only tiles are ordered. Events without a user are left out.
    """
    tiles = (
        events.where(F.col("user_id").isNotNull())
        .groupBy("user_id", F.window("ts", text(gap)).alias("_tile"))
        .agg(
            F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n")
        )
    )
    timeline = Window.partitionBy("user_id").orderBy("first")
    idle = F.col("first") > F.lag("last").over(timeline) + F.lit(gap)
    return (
        tiles.withColumn("_new", F.when(idle, 1).otherwise(0))
        .withColumn(
            "_session",
            F.sum("_new").over(timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .groupBy("user_id", "_session")
        .agg(
            F.min("first").alias("session_start"),
            F.max("last").alias("session_end"),
            F.sum("n").alias("events"),
        )
        .drop("_session")
    )


def _known(right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The distinct keys, as a table: Spark broadcasts it if it is small, and otherwise
    can split a join partition that a frequent key of the left side makes too large.
    """
    return stored(right.select(*on).distinct(), "keys")


def never(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``."""
    return left.join(_known(right, on), list(on), "left_anti")


def only(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return left.join(_known(right, on), list(on), "left_semi")
