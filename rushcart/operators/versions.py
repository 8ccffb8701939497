"""How one version of a system compares with another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rushcart.functions.money import fine, ratio
from rushcart.functions.spans import micros
from rushcart.operators.latency import request_summary


def combine_runs(*runs: DataFrame) -> DataFrame:
    """Stack runs by column name; a column that a run lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


def version_summary(samples: DataFrame) -> DataFrame:
    """Per version: requests, requests per second, p50, p95, p99, error rate.

    The rate is over the time from first to last request, null if that is 0.
    """
    seconds = (micros("last_ts") - micros("first_ts")) / F.lit(1e6)
    return request_summary(samples, ["version"], [0.5, 0.95, 0.99]).select(
        "version",
        "requests",
        ratio("requests", seconds).alias("requests_per_s"),
        "p50",
        "p95",
        "p99",
        ratio("errors", "requests").alias("error_rate"),
    )


def version_compare(samples: DataFrame, baseline: str) -> DataFrame:
    """Every version and route next to the baseline's figures for that route.

    A route the baseline lacks has nulls there, and so has the ratio to a 0.
    """
    cells = request_summary(samples, ["version", "route"], [0.5, 0.95]).withColumn(
        "error_rate", ratio("errors", "requests")
    )
    route = Window.partitionBy("route")

    def base(name):
        return F.max(F.when(F.col("version") == baseline, F.col(name))).over(route)

    return cells.select(
        "version",
        "route",
        "requests",
        "p50",
        "p95",
        "error_rate",
        base("requests").alias("base_requests"),
        base("p50").alias("base_p50"),
        base("p95").alias("base_p95"),
        base("error_rate").alias("base_error_rate"),
    ).select(
        "*",
        ratio("p50", "base_p50").alias("p50_ratio"),
        ratio("p95", "base_p95").alias("p95_ratio"),
        (F.col("p95") - F.col("base_p95")).alias("p95_diff"),
        (F.col("error_rate") - F.col("base_error_rate")).alias("error_rate_diff"),
    )


def version_steps(summary: DataFrame, order: Sequence[str]) -> DataFrame:
    """What each version gained over the one before it in ``order``.

    Versions that ``order`` does not name have no step and nothing before them.
    """
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("version"))
    steps = summary.withColumn("step", F.nullif(place, F.lit(0)).cast("int"))
    before = Window.partitionBy(F.col("step").isNull(), F.when(F.col("step").isNull(), F.col("version"))).orderBy("step")
    return steps.select(
        "step",
        F.lag("version").over(before).alias("from_version"),
        F.col("version").alias("to_version"),
        ratio("p95", F.lag("p95").over(before)).alias("p95_ratio"),
        ratio("requests_per_s", F.lag("requests_per_s").over(before)).alias("rate_ratio"),
        (F.col("error_rate") - F.lag("error_rate").over(before)).alias("error_rate_diff"),
    )


def version_pivot(
    cells: DataFrame, versions: Sequence[str], metrics: Sequence[str] = ("p95", "requests")
) -> DataFrame:
    """One row per route, one column per version and metric."""
    return (
        cells.groupBy("route")
        .pivot("version", list(versions))
        .agg(*[F.max(m).alias(m) for m in metrics])
    )


def regressions(compare: DataFrame, t: float, min_n: int) -> DataFrame:
    """Cells whose p95 is more than ``t`` (0.1 = 10 %) above the baseline's, one of 0 included.

    Cells with fewer than ``min_n`` requests on either side are left out.
    """
    return compare.where(
        (F.col("p95") > F.col("base_p95") * (1 + t))
        & (F.col("requests") >= min_n)
        & (F.col("base_requests") >= min_n)
    )


def _around(low: Column, n: Column, halves: Sequence[Column], squares: Sequence[Column]) -> tuple[Column, Column]:
    """Sums of the distances from ``low`` and of their squares, from whole-number sums of limbs.

    A measurement is h * 2^32 + l. With ``low`` split alike, the sum of squares is
    P * 2^64 + Q * 2^32 + R for whole P, Q and R, which are put together in 38 digits; where those
    do not suffice, P or Q is so large that doubles lose nothing that shows.
    """
    (sh, sl), (hh, hl, ll) = halves, squares
    lh, ll_ = (x.cast("decimal(20,0)") for x in _limbs(low))
    limb = F.lit(1 << 32).cast("decimal(10,0)")
    p = hh - 2 * lh * sh + n * lh * lh
    q = 2 * (hl - lh * sl - ll_ * sh + n * lh * ll_)
    r = ll - 2 * ll_ * sl + n * ll_ * ll_
    upper = F.try_add(F.try_multiply(p, limb), q)
    whole = F.try_add(F.try_multiply(upper, limb), r)
    two = float(1 << 32)
    rough = (p.cast("double") * two + q.cast("double")) * two + r.cast("double")
    squared = F.coalesce(whole.cast("double"), upper.cast("double") * two + r.cast("double"), rough)
    return ((sh - n * lh) * limb + (sl - n * ll_)).cast("double"), squared


def _limbs(x: Column) -> tuple[Column, Column]:
    """(h, l) with x = h * 2^32 + l and l from -2^31 up to 2^31, so that all their products fit a long."""
    high = F.shiftright(x + F.lit(1 << 31), 32)
    return high, x - F.shiftleft(high, 32)


def welch(samples: DataFrame, base: str, other: str, group: Sequence[str] = ()) -> DataFrame:
    """Welch's t and degrees of freedom for the difference of mean latencies.

    One pass: sums of two limbs and of their products are whole numbers, from which the sums
    around each side's smallest value follow. So neither the order of rows nor a large mean costs
    digits, and no count or size of latencies overflows. Null where a side has fewer than two
    samples or nothing varies.
    """
    high, low = _limbs(F.col("_x"))
    exact = "decimal(28,0)"
    own = samples.where(F.col("version").isin(base, other)).select(*group, "version", fine("latency_ms").cast("long").alias("_x"))
    sums = (
        own.select(*group, "version", "_x", high.alias("_h"), low.alias("_l"))
        .groupBy(*group, "version")
        .agg(
            F.count("_x").alias("n"),
            F.min("_x").alias("low"),
            *[F.sum(F.col(c).cast(exact)).alias(c) for c in ("_h", "_l")],
            *[F.sum((F.col(a) * F.col(b)).cast(exact)).alias(a + b) for a, b in (("_h", "_h"), ("_h", "_l"), ("_l", "_l"))],
        )
    )
    n = F.col("n").cast("decimal(20,0)")
    r, q = _around(F.col("low"), n, [F.col("_h"), F.col("_l")], [F.col("_h_h"), F.col("_h_l"), F.col("_l_l")])
    total = F.col("_h") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("_l")
    times = F.col("n").cast("double")
    sides = sums.select(
        *group, "version", "n", ratio(total.cast("double") / 1e9, times).alias("mean"), ratio(ratio((q - r * r / times) / 1e18, times - 1.0), times).alias("e")
    )
    picked = [
        F.max(F.when(F.col("version") == version, F.col(c))).alias(f"{c}_{tag}")
        for version, tag in ((base, "base"), (other, "other"))
        for c in ("n", "mean", "e")
    ]
    sums = sides.groupBy(*group).agg(*picked).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_base", "n_other")})
    e1, e2 = F.col("e_base"), F.col("e_other")
    n1, n2 = F.col("n_base"), F.col("n_other")
    t = ratio(F.col("mean_base") - F.col("mean_other"), F.sqrt(e1 + e2))
    dof = ratio((e1 + e2) * (e1 + e2), ratio(e1 * e1, n1 - 1) + ratio(e2 * e2, n2 - 1))
    return sums.select(
        *group, "n_base", "n_other", "mean_base", "mean_other", t.alias("t"), dof.alias("dof")
    )


def route_diff(samples: DataFrame, a: str, b: str) -> DataFrame:
    """Routes that occur in ``a`` only, in ``b`` only, or in both.

    One grouping gives both differences and the intersection.
    """
    present = (
        samples.where(F.col("version").isin(a, b))
        .groupBy("route")
        .agg(
            F.bool_or(F.col("version") == a).alias("_a"),
            F.bool_or(F.col("version") == b).alias("_b"),
        )
    )
    found = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), a).otherwise(b)
    return present.select("route", found.alias("found_in"))
