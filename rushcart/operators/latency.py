"""How long requests take, where the time goes, and which of them fail."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from rushcart.functions.money import coarse, fine, ratio
from rushcart.functions.quantiles import (
    ORDERED,
    column_name,
    exact_quantiles,
    with_quantiles,
)
from rushcart.functions.ranks import ranked
from rushcart.functions.skew import HOT_ROWS, cut_hot_keys
from rushcart.functions.spans import MICROSECOND, micros, window_start
from rushcart.sources.folders import stored

PROBS = (0.5, 0.9, 0.95, 0.99)


def error_rate(df: DataFrame, group: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*group)
        .agg(F.count("*").alias("requests"), F.count_if("is_error").alias("errors"))
        .withColumn("error_rate", ratio("errors", "requests"))
    )


def request_summary(
    df: DataFrame, group: Sequence[str], probs: Sequence[float] = PROBS, *, ordered: int = ORDERED
) -> DataFrame:
    """Counts, errors, time span, mean and quantiles: a pass for the sums and one for the quantiles.

    Quantiles are exact; groups with more than ``ordered`` samples take two passes more for
    every factor of about fifty. Requests without a latency count as requests only.
    """
    return _measured_summary(df, group, probs, ordered).drop("measured")


def _measured_summary(df: DataFrame, group: Sequence[str], probs: Sequence[float], ordered: int) -> DataFrame:
    """The same with ``measured``, the number of latencies."""
    x = F.col("latency_ms")
    stats = stored(
        df.groupBy(*group).agg(
            F.count("*").alias("requests"),
            F.count_if("is_error").alias("errors"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            ratio(coarse(F.sum(fine(x))), F.count(x)).alias("mean_ms"),
            F.min(x).alias("min_ms"),
            F.max(x).alias("max_ms"),
            F.count(x).alias("measured"),
        ),
        "stats",
    )
    sizes = stats.select(
        *group, F.col("measured").alias("total"), F.col("min_ms").alias("low"), F.col("max_ms").alias("high")
    )
    found = exact_quantiles(df, group, "latency_ms", probs, sizes, ordered=ordered)
    return with_quantiles(stats, found, group, probs)


def latency_summary(
    df: DataFrame, group: Sequence[str], probs: Sequence[float] = PROBS, *, ordered: int = ORDERED
) -> DataFrame:
    names = [column_name(p) for p in probs]
    return request_summary(df, group, probs, ordered=ordered).select(
        *group, "requests", "mean_ms", "min_ms", "max_ms", *names
    )


def latency_sketch(df: DataFrame, group: Sequence[str], k: int = 200) -> DataFrame:
    """A KLL sketch of latencies per group: small, mergeable, can be stored per day."""
    return df.groupBy(*group).agg(F.kll_sketch_agg_double("latency_ms", F.lit(k)).alias("sketch"))


def write_day_sketches(df: DataFrame, path: str, group: Sequence[str], k: int = 200) -> None:
    """Adds a latency sketch per day and group to the table at ``path``.

    A day that is written again is replaced, with all its groups; other days stay. So a day
    must be whole when it is written, and may be written again when rows came late.
    """
    (
        latency_sketch(df.withColumn("day", F.to_date("ts")).where(F.col("day").isNotNull()), ["day", *group], k)
        .repartition("day")  # one small file per day
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def sketch_quantiles(
    sketches: DataFrame, group: Sequence[str], probs: Sequence[float] = PROBS
) -> DataFrame:
    """Approximate quantiles per group from any number of stored sketches."""
    return (
        sketches.groupBy(*group)
        .agg(F.kll_merge_agg_double("sketch").alias("sketch"))
        .select(
            *group,
            F.kll_sketch_get_n_double("sketch").alias("requests"),
            *[
                F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(column_name(p))
                for p in probs
            ],
        )
    )


def latency_histogram(
    df: DataFrame, edges: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """Requests per band. Band i holds ``edges[i-1] <= latency < edges[i]``; ends are open."""
    band = reduce(
        lambda a, b: a + b,
        [F.when(F.col("latency_ms") >= e, 1).otherwise(0) for e in edges],
    )
    lo = F.array(F.lit(None).cast("double"), *[F.lit(float(e)) for e in edges])
    hi = F.array(*[F.lit(float(e)) for e in edges], F.lit(None).cast("double"))
    return (
        df.where(F.col("latency_ms").isNotNull())
        .groupBy(*group, band.alias("band"))
        .agg(F.count("*").alias("requests"))
        .select(
            *group,
            "band",
            F.get(lo, F.col("band")).alias("from_ms"),
            F.get(hi, F.col("band")).alias("to_ms"),
            "requests",
        )
    )


def bottlenecks(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Groups ranked by the time spent in them, with their share and the running share."""
    spent = df.groupBy(*group).agg(
        F.count("*").alias("requests"), F.sum(fine("latency_ms")).alias("_spent")
    )
    order = [F.desc_nulls_last("_spent"), *[F.asc(c) for c in group]]
    rows = ranked(spent, order, "_spent")
    total = rows.agg(F.sum("_spent")).scalar()
    return rows.select(
        *group,
        "requests",
        coarse(F.col("_spent")).alias("spent_ms"),
        "rank",
        ratio("_spent", total).alias("share"),
        ratio("running", total).alias("running_share"),
    )


def load_vs_latency(df: DataFrame, width: timedelta, bands: int) -> DataFrame:
    """Latency and errors by how busy the time window was.

    Windows are put into ``bands`` equal ranges of request counts, 0 to the highest
    count; those without requests, between the first and the last, count in band 0. Per
    band: windows, requests, error rate and p95 of its requests, and the mean and highest
    of its windows' p95.
    """
    timed = df.where(F.col("ts").isNotNull()).withColumn("window_start", window_start("ts", width))
    per_window = stored(_measured_summary(timed, ["window_start"], [0.95], ORDERED), "windows")
    highest = per_window.select(F.max("requests")).scalar()
    banded = per_window.withColumn("band", F.floor(F.col("requests") * bands / (highest + 1)))
    span = micros(F.max("window_start")) - micros(F.min("window_start"))
    empty = per_window.agg(
        (F.expr("1") + span / (width // MICROSECOND) - F.count("*")).cast("long").alias("windows")
    ).select(F.lit(0).cast("long").alias("band"), "windows").where("windows > 0")
    stats = (
        banded.groupBy("band")
        .agg(
            F.count("*").alias("windows"),
            F.sum("requests").alias("requests"),
            F.sum("errors").alias("errors"),
            ratio(coarse(F.sum(fine("p95"))), F.count("p95")).alias("mean_p95"),
            F.max("p95").alias("max_p95"),
        )
        .unionByName(empty, allowMissingColumns=True)
        .groupBy("band")
        .agg(
            F.sum("windows").alias("windows"),
            F.coalesce(F.sum("requests"), F.lit(0)).alias("requests"),
            ratio(F.sum("errors"), F.sum("requests")).alias("error_rate"),
            F.max("mean_p95").alias("mean_p95"),
            F.max("max_p95").alias("max_p95"),
        )
    )
    own = timed.join(banded.select("window_start", "band"), "window_start")
    own = own.select("band", "latency_ms")
    sizes = banded.groupBy("band").agg(
        F.sum("measured").alias("total"), F.min("min_ms").alias("low"), F.max("max_ms").alias("high")
    )
    found = exact_quantiles(own, ["band"], "latency_ms", [0.95], sizes)
    return with_quantiles(stats, found, ["band"], [0.95])


def slow_samples(
    df: DataFrame, group: Sequence[str], q: float, *, ordered: int = ORDERED
) -> DataFrame:
    """Samples above the ``q`` quantile of their group."""
    limits = stored(
        exact_quantiles(df, group, "latency_ms", [q], ordered=ordered).select(
            *[F.col(c).alias(f"_{c}") for c in group], F.col("x").alias("threshold_ms")
        ),
        "limits",
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
        + [F.col("latency_ms") > F.col("threshold_ms")],
    )
    return df.join(limits, same).drop(*[f"_{c}" for c in group])


def error_runs(df: DataFrame, key: str, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Unbroken runs of failed requests per key, by time.

    Requests at the same instant are taken with the successful ones first, which
    makes the runs definite. Runs are found inside the slices of a hot key; only
    the first and last run of a slice can go on across its border, so only those
    are looked at again.
    """
    rows, cut = cut_hot_keys(
        df.where(F.col(key).isNotNull()).select(
            key, "ts", F.coalesce("is_error", F.lit(False)).alias("failed")
        ),
        key,
        "ts",
        hot_rows,
    )
    timeline = Window.partitionBy(key, "piece").orderBy("ts", "failed")
    upto = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = F.coalesce(F.col("failed") != F.lag("failed").over(timeline), F.lit(True))
    runs = (
        rows.withColumn("_turned", turned.cast("int"))
        .withColumn("run", F.sum("_turned").over(upto))
        .groupBy(key, "piece", "run")
        .agg(
            F.min("ts").alias("run_start"),
            F.max("ts").alias("run_end"),
            F.count("*").alias("length"),
            F.bool_or("failed").alias("failed"),
        )
    )
    out = (key, "run_start", "run_end", "length")
    if not cut:
        return runs.where("failed").select(*out)
    runs = runs.withColumn("_last", F.max("run").over(Window.partitionBy(key, "piece")))
    at_border = F.col("piece").isNotNull() & F.col("run").isin(1, F.col("_last"))
    runs = stored(runs.withColumn("_border", at_border).where("_border OR failed"), "runs")
    across = Window.partitionBy(key).orderBy("piece", "run")
    apart = F.coalesce(
        (F.col("failed") != F.lag("failed").over(across))
        | (F.col("piece") == F.lag("piece").over(across)),
        F.lit(True),
    )
    merged = (
        runs.where("_border")
        .withColumn("_apart", apart.cast("int"))
        .withColumn(
            "_whole",
            F.sum("_apart").over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .where("failed")
        .groupBy(key, "_whole")
        .agg(
            F.min("run_start").alias("run_start"),
            F.max("run_end").alias("run_end"),
            F.sum("length").alias("length"),
        )
    )
    return runs.where("NOT _border").select(*out).unionByName(merged.select(*out))
