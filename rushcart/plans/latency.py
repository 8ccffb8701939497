from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rushcart.operators import latency
from rushcart.plans.common import SAMPLES, samples
from rushcart.sources.folders import work_folder
from rushcart.sources.samples import read_points, read_samples, samples_from_events, write_samples
from rushcart.sources.tables import load_table

CELL = ["version", "route"]


def samples_view(spark, sf_dir):
    return samples(spark, sf_dir)


def samples_written_by_version_and_day(spark, sf_dir):
    """In two parts of the same versions and days."""
    path, rows = work_folder(spark, "samples"), samples(spark, sf_dir)
    write_samples(rows.where("route < 12"), path)
    write_samples(rows.where("route >= 12 OR route IS NULL"), path)
    return spark.read.parquet(path).drop("run").withColumn("day", F.col("day").cast("timestamp_ntz"))


def samples_read_from(fmt):
    """The good rows of samples that were written as text."""

    def run(spark, sf_dir):
        path = work_folder(spark, f"samples-{fmt}")
        rows = samples_from_events(load_table(spark, sf_dir, "events"))
        writer = rows.select(*reversed(rows.columns), F.lit("x").alias("extra")).write
        writer = writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        writer.format(fmt).option("header", True).save(path)
        good, _ = read_samples(spark, path, fmt)
        return good

    return run


def samples_read_from_points(spark, sf_dir):
    """The good rows of samples that were written as a load tool writes them."""
    path = work_folder(spark, "points")
    rows = samples(spark, sf_dir)
    tags = F.struct("version", F.col("route").cast("string").alias("name"), F.when(F.col("is_error"), "500").otherwise("200").alias("status"))
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    data = F.struct(time.alias("time"), F.col("latency_ms").alias("value"), tags.alias("tags"))
    point = rows.select(F.lit("http_req_duration").alias("metric"), F.lit("Point").alias("type"), data.alias("data"))
    point.unionByName(point.withColumn("metric", F.lit("vus"))).write.json(path)
    good, _ = read_points(spark, path)
    return good.withColumn("route", F.col("route").cast("long"))


def error_rate(spark, sf_dir):
    return latency.error_rate(samples(spark, sf_dir), CELL)


def latency_summary(spark, sf_dir):
    return latency.latency_summary(samples(spark, sf_dir), CELL)


def latency_of_all(spark, sf_dir):
    return latency.latency_summary(samples(spark, sf_dir), [])


def latency_sketch_quantiles(spark, sf_dir):
    daily = latency.latency_sketch(
        samples(spark, sf_dir).withColumn("day", F.to_date("ts")), ["version", "day"]
    )
    return latency.sketch_quantiles(daily, ["version"])


def latency_sketch_holds_its_bound(spark, sf_dir):
    """Whether the true rank of every sketched quantile lies within 3 % of the wanted one."""
    probs = {f"p{p:g}": p / 100 for p in (50, 90, 95, 99)}
    near = latency_sketch_quantiles(spark, sf_dir).select(
        "version", *[F.col(name).alias(f"_{name}") for name in probs]
    )
    below = [F.count_if(F.col("latency_ms") < F.col(f"_{name}")) for name in probs]
    upto = [F.count_if(F.col("latency_ms") <= F.col(f"_{name}")) for name in probs]
    ranked = samples(spark, sf_dir).join(near, "version").groupBy("version")
    return ranked.agg(
        *[
            ((lo / F.count("latency_ms") <= p + 0.03) & (hi / F.count("latency_ms") >= p - 0.03)).alias(name)
            for (name, p), lo, hi in zip(probs.items(), below, upto)
        ]
    )


def latency_sketches_of_days(spark, sf_dir):
    """Days written in two runs, the one in the middle first in part and then whole.

    Requests per version, and whether the true rank of its p95 lies within 3 % of the wanted one."""
    path, rows = work_folder(spark, "day-sketches"), samples(spark, sf_dir).withColumn("day", F.to_date("ts"))
    middle = rows.select(F.min("day") + F.expr("CAST(datediff(max(day), min(day)) / 2 AS INT)")).scalar()
    rows = rows.withColumn("_middle", middle)
    latency.write_day_sketches(rows.where("day < _middle OR day = _middle AND hour(ts) < 12"), path, ["version"])
    latency.write_day_sketches(rows.where("day >= _middle"), path, ["version"])
    near = latency.sketch_quantiles(spark.read.parquet(path), ["version"], [0.95])
    x, p95 = F.col("latency_ms"), F.col("p95")
    ranked = rows.join(near, "version").groupBy("version", "requests")
    low, high = F.count_if(x < p95) / F.count(x), F.count_if(x <= p95) / F.count(x)
    return ranked.agg(((low <= 0.98) & (high >= 0.92)).alias("p95"))


def latency_histogram(spark, sf_dir):
    return latency.latency_histogram(
        samples(spark, sf_dir), [5.0, 10.0, 25.0, 50.0, 100.0, 250.0], ["version"]
    )


def bottlenecks(spark, sf_dir):
    return latency.bottlenecks(samples(spark, sf_dir), ["route"])


def load_vs_latency(spark, sf_dir):
    return latency.load_vs_latency(samples(spark, sf_dir), timedelta(hours=1), 5)


def slow_samples(spark, sf_dir):
    return latency.slow_samples(samples(spark, sf_dir), ["route"], 0.95)


def error_runs(spark, sf_dir):
    return latency.error_runs(samples(spark, sf_dir), "route")


SUMMARY = """
  count(*) AS requests,
  CAST(sum(CAST(floor(latency_ms * 1e9::DOUBLE + 0.5::DOUBLE) AS BIGINT)) AS DOUBLE) / 1e9::DOUBLE / count(latency_ms) AS mean_ms,
  min(latency_ms) AS min_ms, max(latency_ms) AS max_ms,
  quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.9) AS p90,
  quantile_disc(latency_ms, 0.95) AS p95, quantile_disc(latency_ms, 0.99) AS p99"""

SAMPLE_ROWS = f"WITH {SAMPLES} SELECT * FROM samples"

PLANS = {
    "samples_from_events": (samples_view, SAMPLE_ROWS),
    "samples_written_by_version_and_day": (
        samples_written_by_version_and_day,
        f"WITH {SAMPLES} SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM samples",
    ),
    "samples_read_from_json": (samples_read_from("json"), SAMPLE_ROWS),
    "samples_read_from_points": (samples_read_from_points, SAMPLE_ROWS),
    "samples_read_from_csv": (samples_read_from("csv"), SAMPLE_ROWS),
    "error_rate": (
        error_rate,
        f"""
        WITH {SAMPLES}
        SELECT version, route, count(*) AS requests, count(*) FILTER (is_error) AS errors,
               CAST(count(*) FILTER (is_error) AS DOUBLE) / count(*) AS error_rate
        FROM samples GROUP BY version, route""",
    ),
    "latency_summary": (
        latency_summary,
        f"WITH {SAMPLES} SELECT version, route, {SUMMARY} FROM samples GROUP BY version, route",
    ),
    "latency_of_all": (latency_of_all, f"WITH {SAMPLES} SELECT {SUMMARY} FROM samples"),
    "latency_sketch_quantiles": (latency_sketch_quantiles, None),
    "latency_sketch_holds_its_bound": (
        latency_sketch_holds_its_bound,
        f"""
        WITH {SAMPLES}
        SELECT DISTINCT version, true AS p50, true AS p90, true AS p95, true AS p99 FROM samples""",
    ),
    "latency_sketches_of_days": (
        latency_sketches_of_days,
        f"WITH {SAMPLES} SELECT version, count(latency_ms) AS requests, true AS p95 FROM samples GROUP BY version",
    ),
    "latency_histogram": (
        latency_histogram,
        f"""
        WITH {SAMPLES}, edges AS (
          SELECT * FROM (VALUES
            (0, CAST(NULL AS DOUBLE), 5.0), (1, 5.0, 10.0), (2, 10.0, 25.0), (3, 25.0, 50.0),
            (4, 50.0, 100.0), (5, 100.0, 250.0), (6, 250.0, NULL)) AS e(band, lo, hi))
        SELECT version, band, CAST(lo AS DOUBLE) AS from_ms, CAST(hi AS DOUBLE) AS to_ms,
               count(*) AS requests
        FROM samples JOIN edges
          ON latency_ms >= coalesce(lo, latency_ms) AND (hi IS NULL OR latency_ms < hi)
        GROUP BY ALL""",
    ),
    "bottlenecks": (
        bottlenecks,
        f"""
        WITH {SAMPLES}, spent AS (
          SELECT route, count(*) AS requests, sum(CAST(floor(latency_ms * 1e9::DOUBLE + 0.5::DOUBLE) AS BIGINT)) AS s
          FROM samples GROUP BY route)
        SELECT route, requests, CAST(s AS DOUBLE) / 1e9::DOUBLE AS spent_ms,
               CAST(row_number() OVER (ORDER BY s DESC, route) AS INTEGER) AS rank,
               CAST(s AS DOUBLE) / CAST(sum(s) OVER () AS DOUBLE) AS share,
               CAST(sum(s) OVER (ORDER BY s DESC, route) AS DOUBLE)
                 / CAST(sum(s) OVER () AS DOUBLE) AS running_share
        FROM spent""",
    ),
    "load_vs_latency": (
        load_vs_latency,
        f"""
        WITH {SAMPLES}, w AS (
          SELECT date_trunc('hour', ts) AS h, count(*) AS requests,
                 count(*) FILTER (is_error) AS errors, quantile_disc(latency_ms, 0.95) AS p95
          FROM samples GROUP BY 1),
        every AS (
          SELECT h, coalesce(requests, 0) AS requests, coalesce(errors, 0) AS errors, p95
          FROM (SELECT unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM w) LEFT JOIN w USING (h)),
        banded AS (
          SELECT *, (requests * 5) // ((SELECT max(requests) FROM w) + 1) AS band FROM every),
        own AS (
          SELECT band, quantile_disc(latency_ms, 0.95) AS p95
          FROM samples JOIN banded ON h = date_trunc('hour', ts) GROUP BY band)
        SELECT CAST(b.band AS BIGINT) AS band, count(*) AS windows,
               CAST(sum(requests) AS BIGINT) AS requests,
               CAST(sum(errors) AS DOUBLE) / CAST(sum(requests) AS DOUBLE) AS error_rate,
               CAST(sum(CAST(floor(b.p95 * 1e9::DOUBLE + 0.5::DOUBLE) AS BIGINT)) AS DOUBLE) / 1e9::DOUBLE
                 / count(b.p95) AS mean_p95,
               max(b.p95) AS max_p95, any_value(own.p95) AS p95
        FROM banded b LEFT JOIN own ON own.band = b.band GROUP BY b.band""",
    ),
    "slow_samples": (
        slow_samples,
        f"""
        WITH {SAMPLES}, limits AS (
          SELECT route, quantile_disc(latency_ms, 0.95) AS threshold_ms
          FROM samples GROUP BY route)
        SELECT s.*, threshold_ms FROM samples s JOIN limits USING (route)
        WHERE latency_ms > threshold_ms""",
    ),
    "error_runs": (
        error_runs,
        f"""
        WITH {SAMPLES}, numbered AS (
          SELECT route, ts, is_error,
                 row_number() OVER (PARTITION BY route ORDER BY ts, is_error)
                 - row_number() OVER (PARTITION BY route, is_error ORDER BY ts) AS run
          FROM samples)
        SELECT route, min(ts) AS run_start, max(ts) AS run_end, count(*) AS length
        FROM numbered WHERE is_error GROUP BY route, run""",
    ),
}
