"""Exact quantiles without holding, writing or shuffling the values of a group.

A sketch of the values brackets every wanted rank; a count of what lies below and inside
tells whether it does, and by how much the rank goes down inside the bracket. That is
repeated until a bracket holds few enough values, and only those are ordered. A bracket
that missed its rank is drawn wider. Groups with few values need no sketch at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rushcart.sources.folders import stored

#: Values of a bracket that are ordered in one task.
ORDERED = 200_000
#: Quantiles that a sketch is asked for. A bracket is a few of these steps wide, and the
#: sketch's error less than one.
GRID = 256
SKETCH = 1_600


def column_name(prob: float) -> str:
    """0.95 -> p95, 0.999 -> p99_9."""
    return "p" + f"{prob * 100:.10g}".replace(".", "_")


def totals(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Per group what :func:`exact_quantiles` begins with: ``total``, ``low``, ``high``."""
    return df.groupBy(*group).agg(
        F.count(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")
    )


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probs: Sequence[float],
    sizes: DataFrame | None = None,
    *,
    ordered: int = ORDERED,
) -> DataFrame:
    """Long form (``group``, ``q``, ``x``): the smallest value whose share reaches ``q``.

    ``sizes`` are :func:`totals`, if they are known already, from a written table.
    """
    keys = [f"_{c}" for c in group] + ["_all"]
    named = [F.col(c).alias(f"_{c}") for c in group] + [F.lit(1).alias("_all")]
    known = df.where(F.col(value).isNotNull()).select(*named, F.col(value).cast("double").alias("x"))
    ranks = F.array(
        *[
            F.struct(
                F.lit(column_name(p)).alias("q"),
                F.greatest(F.lit(1), F.ceil(F.lit(Decimal(str(p))) * F.col("total"))).cast("long").alias("rank"),
            )
            for p in probs
        ]
    )
    if sizes is None:
        sizes = stored(totals(df, group, value), "totals")
    state = sizes.where(F.col("total") > 0).select(
        *named,
        F.inline(ranks),
        F.col("low").cast("double").alias("low"),
        F.col("high").cast("double").alias("high"),
        F.lit(0).cast("long").alias("below"),
        F.col("total").alias("size"),
        F.lit(2).alias("margin"),
    )
    # A margin beyond the grid says that few distinct values make up the bracket, which are counted anyway.
    too_large = (F.col("size") > ordered) & (F.col("low") < F.col("high")) & (F.col("margin") <= GRID)
    while not state.where(too_large).isEmpty():
        state = stored(_narrowed(known, keys, state, too_large), "brackets")
    brackets = state.select(*keys, "low", "high").distinct()
    counts = _inside(known, keys, brackets).groupBy(*keys, "low", "high", "x").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*keys, "low", "high").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("_upto", F.sum("n").over(upto))
    wanted = _right(state.select(*keys, "low", "high", "q", (F.col("rank") - F.col("below")).alias("_rank")), [*keys, "low", "high"])
    hit = (F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("n"))
    found = running.join(wanted, _same([*keys, "low", "high"]) & hit)
    return found.select(*[F.col(f"_{c}").alias(c) for c in group], "q", "x")


def _right(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_r" for c in keys})


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_r")) for c in keys])


def _inside(known: DataFrame, keys: Sequence[str], brackets: DataFrame) -> DataFrame:
    """Values with each bracket of their group that holds them."""
    between = (F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high"))
    return known.join(_right(brackets, keys), _same(keys) & between).drop(*[f"{c}_r" for c in keys])


def _narrowed(known: DataFrame, keys: Sequence[str], state: DataFrame, too_large: Column) -> DataFrame:
    large = state.where(too_large)
    steps = F.array(*[F.lit(i / GRID) for i in range(1, GRID)])
    grid = (
        _inside(known, keys, large.select(*keys, "low", "high").distinct())
        .groupBy(*keys, "low", "high")
        .agg(F.kll_sketch_agg_double("x", F.lit(SKETCH)).alias("_sketch"))
        .withColumn("_grid", F.kll_sketch_get_quantile_double("_sketch", steps))
        .drop("_sketch")
    )
    # Step i of the grid (from 0) is the quantile (i + 1) / GRID.
    at = F.floor((F.col("rank") - F.col("below")) / F.col("size") * GRID).cast("int")
    lower, upper = at - 1 - F.col("margin"), at + F.col("margin")
    tried = stored(
        large.join(_right(grid, [*keys, "low", "high"]), _same([*keys, "low", "high"]))
        .withColumn("_low", F.when(lower >= 0, F.get("_grid", lower)).otherwise(F.col("low")))
        .withColumn("_high", F.when(upper < GRID - 1, F.get("_grid", upper)).otherwise(F.col("high")))
        .drop("_grid", *[f"{c}_r" for c in (*keys, "low", "high")]),
        "tried",
    )
    counted = (
        _inside(known, keys, tried.select(*keys, "q", "low", "high", "_low", "_high"))
        .groupBy(*keys, "q")
        .agg(
            F.count_if(F.col("x") < F.col("_low")).alias("_under"),
            F.count_if(F.col("x").between(F.col("_low"), F.col("_high"))).alias("_in"),
        )
    )
    joined = tried.join(_right(counted, [*keys, "q"]), _same([*keys, "q"])).drop(*[f"{c}_r" for c in (*keys, "q")])
    place = F.col("rank") - F.col("below") - F.col("_under")
    holds = (place >= 1) & (place <= F.col("_in"))
    narrowed = joined.select(
        *keys, "q", "rank",
        F.when(holds, F.col("_low")).otherwise(F.col("low")).alias("low"),
        F.when(holds, F.col("_high")).otherwise(F.col("high")).alias("high"),
        (F.col("below") + F.when(holds, F.col("_under")).otherwise(0)).alias("below"),
        F.when(holds, F.col("_in")).otherwise(F.col("size")).alias("size"),
        F.when(holds & (F.col("_in") < F.col("size")), F.lit(2)).otherwise(F.col("margin") * 4).alias("margin"),
    )
    return narrowed.unionByName(state.where(~too_large))


def with_quantiles(
    stats: DataFrame, long: DataFrame, group: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """One row per group: the columns of ``stats`` and one column per quantile.

    Both sides go through one grouping, which also matches groups that hold nulls.
    """
    names = [column_name(p) for p in probs]
    values = [c for c in stats.columns if c not in group]
    wide = long.select(*group, *[F.when(F.col("q") == n, F.col("x")).alias(n) for n in names])
    return (
        stats.unionByName(wide, allowMissingColumns=True)
        .groupBy(*group)
        .agg(*[F.max(c).alias(c) for c in (*values, *names)])
    )
