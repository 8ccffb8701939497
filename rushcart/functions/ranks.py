"""Ranks and running sums over a whole table without ordering it in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rushcart.sources.folders import stored

#: Rows of a range that one task ranks, about.
RANGE_ROWS = 100_000


def ranked(df: DataFrame, order: Sequence[Column], total: str, *, rows: int = RANGE_ROWS) -> DataFrame:
    """Adds ``rank`` from 1 and ``running``, the sum of ``total`` so far, in a total ``order``.

    Rows are dealt to ranges of the order; a table with one row per range carries the ranks
    and sums from each range to the next.
    """
    kept = stored(df, "unranked")
    ranges = max(1, -(-kept.count() // rows))
    dealt = stored(kept.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    per_range = dealt.groupBy("_range").agg(F.count("*").alias("_rows"), F.sum(total).alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select(
        "_range",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"),
        F.sum("_sum").over(before).alias("_before"),
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    running = F.sum(total).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    whole = dealt.join(starts, "_range").withColumn("rank", (F.col("_first") + F.row_number().over(inside)).cast("int"))
    sums = F.when(F.col("_before").isNull(), running).otherwise(F.coalesce(running, F.lit(0)) + F.col("_before"))
    return whole.withColumn("running", sums).drop("_range", "_first", "_before")


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[Column], *, rows: int = RANGE_ROWS) -> DataFrame:
    """Adds ``at``, the row's number from 0 within its group, and ``size``, the rows of the group.

    Rows are dealt to ranges of the groups and their order, so that many tasks number a group of any
    size; a table with a row per range and group carries the numbers on. Rows that are equal
    in that order are told apart by their place in the written table.
    """
    kept = stored(df.withColumn("_tie", F.monotonically_increasing_id()), "unnumbered")
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-kept.count() // rows))
    total = [*order, F.col("_tie")]
    dealt = stored(kept.repartitionByRange(ranges, *group, *total).withColumn("_range", F.spark_partition_id()), "ranges")
    here = dealt.groupBy("_range", *group).agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = here.select(
        *[F.col(c).alias(f"_{c}") for c in ("_range", *group)],
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"),
        F.sum("_rows").over(whole).alias("size"),
    )
    starts = stored(starts, "starts")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("_range", *group)]
    inside = Window.partitionBy("_range", *group).orderBy(*total)
    found = dealt.join(starts, reduce(lambda a, b: a & b, same)).withColumn("at", F.col("_first") + F.row_number().over(inside) - 1)
    return found.drop("_tie", "_range", "_first", *[f"_{c}" for c in ("_range", *group)])
