"""Ordered work on keys of which a few may hold a large part of all rows.

A window partitioned by such a key would put all of its rows into one task.
Here a key above ``rows`` rows is cut into slices of about that many, windows run
inside a slice, and what crosses a slice border is carried over on a small table
with one row per slice. Other keys stay whole, and where no key is that large the
plan is a plain window.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rushcart.functions.spans import micros
from rushcart.sources.folders import stored

#: Keys with more rows than this are cut into slices of about this many rows.
HOT_ROWS = 1_000_000

#: Slices that one look at the times of a key or slice gives at most.
FAN = 64
_STEP = 2 * FAN
#: Looks at the most, as many as a slice's number has room for. Each one leaves mostly a 64th of a slice.
ROUNDS = 8


def cut_hot_keys(
    df: DataFrame, key: str, ts: str, rows: int = HOT_ROWS
) -> tuple[DataFrame, bool]:
    """Add ``piece``, the slice number for rows of a hot key and null for all others.

    Also tells whether there is any hot key, which takes one pass that counts rows
    per key. Rows of one key with equal ``ts`` share a piece; pieces rise with ``ts``.
    Borders are quantiles of the key's times, so a burst is cut as finely as it is dense;
    slices that came out above twice ``rows`` are cut again, down to a single time.
    """
    hot = stored(
        df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > rows).select(key, F.lit(0).cast("long").alias("piece")),
        "hot-keys",
    )
    if hot.isEmpty():
        return df.withColumn("piece", F.lit(None).cast("long")), False
    at = micros(ts)
    cut = df.join(hot, key, "left")
    for _ in range(ROUNDS):
        over = stored(_borders(cut.where(F.col("piece").isNotNull()), key, at, rows), "borders")
        if over.isEmpty():
            break
        passed = F.size(F.filter("_borders", lambda b: b <= at))
        cut = cut.join(over, [key, "piece"], "left").withColumn(
            "piece", F.col("piece") * _STEP + F.coalesce(F.when(F.col("_borders").isNotNull(), passed), F.lit(0))
        ).drop("_borders")
    else:
        warnings.warn(f"slices of {key} are still above {2 * rows} rows after {ROUNDS} cuts: results hold, tasks are uneven", stacklevel=2)
    return cut, True


def _borders(cut: DataFrame, key: str, at: Column, rows: int) -> DataFrame:
    """Times at which slices that are still too large are cut, the slices around a frequent
    time ending right after it."""
    shares = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])
    slices = cut.groupBy(key, "piece").agg(
        F.count("*").alias("_n"),
        F.min(at).alias("_low"),
        F.max(at).alias("_high"),
        F.kll_sketch_agg_bigint(at, F.lit(800)).alias("_sketch"),
    )
    every = F.greatest(F.lit(1), F.floor(FAN * F.lit(rows) / F.col("_n")))
    at_shares = F.filter(F.kll_sketch_get_quantile_bigint("_sketch", shares), lambda _, i: (i + 1) % F.col("_every") == 0)
    middle = F.array(F.expr("_low + (_high - _low) div 2 + 1"))
    found = F.array_union(at_shares, F.array_union(F.transform(at_shares, lambda b: b + 1), middle))
    return (
        slices.where((F.col("_n") > 2 * rows) & (F.col("_low") < F.col("_high")))
        .withColumn("_every", every)
        .select(key, "piece", F.filter(found, lambda b: (b > F.col("_low")) & (b <= F.col("_high"))).alias("_borders"))
    )


def nearest(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    found: Column,
    name: str,
    *,
    cut: bool,
    later: bool = False,
) -> DataFrame:
    """Add ``name``: ``found`` of the closest earlier (or later) row where it is not null.

    ``df`` and ``cut`` come from :func:`cut_hot_keys`; ``order`` must be a total
    order within a key wherever it matters which of two tied rows is the closer one.
    """
    turn = F.desc if later else F.asc
    inside = (
        Window.partitionBy(key, "piece")
        .orderBy(*[turn(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = df.withColumn(name, F.last(found, ignorenulls=True).over(inside))
    if not cut:
        return local
    across = (
        Window.partitionBy("_key")
        .orderBy(turn("_piece"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # The last (first) hit of every slice, handed on to the slices after (before) it.
    edge = (F.min if later else F.max)(
        F.when(found.isNotNull(), F.struct(*order, found.alias("_found")))
    )
    carried = stored(
        df.where(F.col("piece").isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col("piece").alias("_piece"))
        .agg(edge.alias("_edge"))
        .select("_key", "_piece", F.last("_edge", ignorenulls=True).over(across)["_found"].alias("_carried")),
        "carried",
    )
    return (
        local.join(carried, (F.col(key) == F.col("_key")) & (F.col("piece") == F.col("_piece")), "left")
        .withColumn(name, F.coalesce(name, "_carried"))
        .drop("_key", "_piece", "_carried")
    )
