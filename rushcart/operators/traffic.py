"""How much traffic there is and when."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce
from math import gcd

from pyspark.sql import DataFrame, Window, functions as F

from rushcart.functions.ranks import RANGE_ROWS, numbered
from rushcart.functions.spans import MICROSECOND, micros, window_start
from rushcart.sources.folders import stored

#: Numbers of windows that a row holds at most.
CHUNK = 4_096


def _counts(df: DataFrame, width: timedelta, group: Sequence[str]) -> DataFrame:
    return df.groupBy(window_start("ts", width).alias("window_start"), *group).agg(
        F.count("*").alias("requests")
    )


def _grid(df: DataFrame, groups: DataFrame | None, n: int, chunk: int = CHUNK) -> DataFrame:
    """Numbers 0 to ``n`` - 1 as ``_no``, for every row of ``groups`` if there are any.

    Numbers come from a distributed range. Groups meet it chunk by chunk, through a list of
    chunks of chunks, so no row holds more than a few thousand numbers.
    """
    numbers = df.sparkSession.range(n).select(F.col("id").alias("_no"))
    if groups is None:
        return numbers
    chunks = -(-n // chunk)
    steps = -(-chunks // chunk)
    dealt = groups.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1)).cast("array<bigint>")))
    inside = F.sequence(F.col("_step") * chunk, F.least(F.col("_step") * chunk + (chunk - 1), F.lit(chunks - 1)))
    dealt = dealt.withColumn("_chunk", F.explode(inside)).drop("_step")
    return dealt.join(numbers.withColumn("_chunk", F.expr(f"_no div {chunk}")), "_chunk").drop("_chunk")


def traffic(df: DataFrame, width: timedelta, group: Sequence[str] = ()) -> DataFrame:
    """Requests per window and group, with 0 for empty windows.

    Every group gets every window from the first to the last one of the whole input.
    """
    counts = stored(_counts(df, width, group).where(F.col("window_start").isNotNull()), "window-counts")
    span = counts.select(micros(F.max("window_start")) - micros(F.min("window_start"))).first()[0]
    if span is None:
        return counts
    start = counts.select(F.min("window_start")).scalar()
    step = width // MICROSECOND
    number = ((micros("window_start") - micros(start)) / F.lit(step)).cast("long")
    n = span // step + 1
    grid = _grid(df, counts.select(*group).distinct() if group else None, n)
    on = ("_no", *group)
    found = counts.select(number.alias("__no"), *[F.col(c).alias(f"_{c}") for c in group], F.col("requests").alias("_n"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on])
    window = start + F.col("_no") * F.lit(width)
    return grid.join(found, same, "left").select(
        window.alias("window_start"), *group, F.coalesce("_n", F.lit(0)).cast("long").alias("requests")
    )


def traffic_sliding(df: DataFrame, width: timedelta, slide: timedelta) -> DataFrame:
    """Requests per sliding window.

    Rows are counted once per pane, the common divisor of width and slide, and
    only those counts are copied into the windows that overlap.
    """
    pane = gcd(width // MICROSECOND, slide // MICROSECOND) * MICROSECOND
    panes = _counts(df, pane, ()).withColumnRenamed("window_start", "ts")
    return panes.groupBy(window_start("ts", width, slide).alias("window_start")).agg(
        F.sum("requests").alias("requests")
    )


def peak_windows(df: DataFrame, width: timedelta, k: int) -> DataFrame:
    """The ``k`` busiest windows; ties go to the earlier one."""
    return _counts(df, width, ()).orderBy(F.desc("requests"), "window_start").limit(k)


def spikes(
    counted: DataFrame, n: int = 24, z: float = 2.0, group: Sequence[str] = (), *, rows: int = RANGE_ROWS
) -> DataFrame:
    """Flag windows above mean + ``z`` standard deviations of the ``n`` before them.

    Takes the output of :func:`traffic`. At least two earlier windows are needed for a flag.
    Windows are numbered and cut into pieces of ``rows``; the last ``n`` of a piece also go to the
    next one, where they only stand before its first windows.
    """
    rows = max(rows, n)
    placed = numbered(counted.select("window_start", *group, "requests"), group, [F.col("window_start")], rows=rows)
    piece = F.expr(f"at div {rows}")
    last = F.col("at") % rows >= rows - n
    pieces = F.array_compact(F.array(piece, F.when(last, piece + 1)))
    dealt = placed.withColumn("_own", piece).withColumn("_piece", F.explode(pieces))
    before = Window.partitionBy(*group, "_piece").orderBy("window_start").rowsBetween(-n, -1)
    limit = F.avg("requests").over(before) + z * F.stddev_samp("requests").over(before)
    enough = F.count("*").over(before) >= 2
    flag = F.coalesce(enough & (F.col("requests") > limit), F.lit(False))
    return dealt.withColumn("is_spike", flag).where("_piece = _own").select("window_start", *group, "requests", "is_spike")
