from __future__ import annotations

from pyspark.sql import functions as F

from rushcart.operators import versions
from rushcart.operators.latency import request_summary
from rushcart.sources.samples import samples_from_events
from rushcart.sources.tables import load_table
from rushcart.plans.common import SAMPLES, samples

ORDER = ["V1", "V2", "V3", "V4"]


def combine_runs(spark, sf_dir):
    log = samples(spark, sf_dir)
    first = log.where("version = 'V1'").drop("is_error")
    return versions.combine_runs(first, log.where("version <> 'V1'"))


def version_summary(spark, sf_dir):
    return versions.version_summary(samples(spark, sf_dir))


def version_compare(spark, sf_dir):
    return versions.version_compare(samples(spark, sf_dir), "V1")


def version_steps(spark, sf_dir):
    return versions.version_steps(version_summary(spark, sf_dir), ORDER)


def version_pivot(spark, sf_dir):
    cells = request_summary(samples(spark, sf_dir), ["version", "route"], [0.95])
    return versions.version_pivot(cells, ORDER)


def regressions(spark, sf_dir):
    return versions.regressions(version_compare(spark, sf_dir), 0.1, 5)


def welch(spark, sf_dir):
    return versions.welch(samples(spark, sf_dir), "V1", "V4")


def welch_by_route(spark, sf_dir):
    return versions.welch(samples(spark, sf_dir), "V1", "V4", ["route"])


def route_diff(spark, sf_dir):
    return versions.route_diff(samples(spark, sf_dir), "V1", "V2")


def user_diff(spark, sf_dir):
    """Users and hours of the day stand in for finer routes, of which each version has some alone."""
    log = load_table(spark, sf_dir, "events")
    version = samples_from_events(log).select("version", "ts", "is_error")
    finer = log.select("ts", (F.col("user_id") * 24 + F.hour("ts")).alias("route"))
    return versions.route_diff(version.join(finer, "ts"), "V1", "V2")


PER_VERSION = """
per_version AS (
  SELECT version, count(*) AS requests,
         CAST(count(*) AS DOUBLE)
           / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0) AS requests_per_s,
         quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.95) AS p95,
         quantile_disc(latency_ms, 0.99) AS p99,
         CAST(count(*) FILTER (is_error) AS DOUBLE) / count(*) AS error_rate
  FROM samples GROUP BY version)"""

COMPARED = """
cells AS (
  SELECT version, route, count(*) AS requests, quantile_disc(latency_ms, 0.5) AS p50,
         quantile_disc(latency_ms, 0.95) AS p95,
         CAST(count(*) FILTER (is_error) AS DOUBLE) / count(*) AS error_rate
  FROM samples GROUP BY version, route),
compared AS (
  SELECT c.*, b.requests AS base_requests, b.p50 AS base_p50, b.p95 AS base_p95,
         b.error_rate AS base_error_rate,
         c.p50 / nullif(b.p50, 0) AS p50_ratio, c.p95 / nullif(b.p95, 0) AS p95_ratio,
         c.p95 - b.p95 AS p95_diff, c.error_rate - b.error_rate AS error_rate_diff
  FROM cells c LEFT JOIN cells b ON b.route = c.route AND b.version = 'V1')"""


def _welch_sql(group):
    by, comma, clause = (group, ",", f"GROUP BY {group}") if group else ("", "", "")
    return f"""
    WITH {SAMPLES}, x AS (
      SELECT *, CAST(floor(latency_ms * 1e9::DOUBLE + 0.5::DOUBLE) AS HUGEINT) AS x FROM samples
      WHERE version IN ('V1', 'V4')),
    d AS (SELECT *, x - min(x) OVER (PARTITION BY {by} {comma} version) AS d FROM x),
    s AS (
      SELECT {by} {comma}
             count(x) FILTER (version = 'V1') AS n1, count(x) FILTER (version = 'V4') AS n2,
             CAST(sum(x) FILTER (version = 'V1') AS DOUBLE) AS s1,
             CAST(sum(x) FILTER (version = 'V4') AS DOUBLE) AS s2,
             CAST(sum(CAST(d AS DECIMAL(38,0))) FILTER (version = 'V1') AS DOUBLE) AS r1,
             CAST(sum(CAST(d AS DECIMAL(38,0))) FILTER (version = 'V4') AS DOUBLE) AS r2,
             CAST(sum(CAST(d * d AS DECIMAL(38,0))) FILTER (version = 'V1') AS DOUBLE) AS q1,
             CAST(sum(CAST(d * d AS DECIMAL(38,0))) FILTER (version = 'V4') AS DOUBLE) AS q2
      FROM d {clause}),
    m AS (
      SELECT *, s1 / 1e9::DOUBLE / n1 AS m1, s2 / 1e9::DOUBLE / n2 AS m2,
             (q1 - r1 * r1 / n1) / 1e18::DOUBLE / nullif(n1 - 1.0::DOUBLE, 0) / n1 AS e1,
             (q2 - r2 * r2 / n2) / 1e18::DOUBLE / nullif(n2 - 1.0::DOUBLE, 0) / n2 AS e2
      FROM s)
    SELECT {by} {comma} n1 AS n_base, n2 AS n_other, m1 AS mean_base, m2 AS mean_other,
           (m1 - m2) / nullif(sqrt(e1 + e2), 0) AS t,
           (e1 + e2) * (e1 + e2)
             / nullif(e1 * e1 / nullif(n1 - 1, 0) + e2 * e2 / nullif(n2 - 1, 0), 0) AS dof
    FROM m"""


PLANS = {
    "combine_runs": (
        combine_runs,
        f"""
        WITH {SAMPLES}
        SELECT * REPLACE (CASE WHEN version <> 'V1' THEN is_error END AS is_error) FROM samples""",
    ),
    "version_summary": (
        version_summary,
        f"WITH {SAMPLES}, {PER_VERSION} SELECT * FROM per_version",
    ),
    "version_compare": (version_compare, f"WITH {SAMPLES}, {COMPARED} SELECT * FROM compared"),
    "version_steps": (
        version_steps,
        f"""
        WITH {SAMPLES}, {PER_VERSION}
        SELECT CAST(substr(n.version, 2) AS INTEGER) AS step, p.version AS from_version,
               n.version AS to_version, n.p95 / nullif(p.p95, 0) AS p95_ratio,
               n.requests_per_s / nullif(p.requests_per_s, 0) AS rate_ratio,
               n.error_rate - p.error_rate AS error_rate_diff
        FROM per_version n LEFT JOIN per_version p
          ON CAST(substr(p.version, 2) AS INTEGER) = CAST(substr(n.version, 2) AS INTEGER) - 1""",
    ),
    "version_pivot": (
        version_pivot,
        f"""
        WITH {SAMPLES}
        SELECT route, {", ".join(
            f"quantile_disc(latency_ms, 0.95) FILTER (version = '{v}') AS {v}_p95, "
            f"nullif(count(*) FILTER (version = '{v}'), 0) AS {v}_requests" for v in ORDER)}
        FROM samples GROUP BY route""",
    ),
    "regressions": (
        regressions,
        f"""
        WITH {SAMPLES}, {COMPARED}
        SELECT * FROM compared
        WHERE p95 > base_p95 * 1.1::DOUBLE AND requests >= 5 AND base_requests >= 5""",
    ),
    "welch": (welch, _welch_sql("")),
    "welch_by_route": (welch_by_route, _welch_sql("route")),
    "user_diff": (
        user_diff,
        f"""
        WITH {SAMPLES}, finer AS (
          SELECT version, user_id * 24 + hour(events.ts) AS route
          FROM samples JOIN events ON events.ts = samples.ts),
        a AS (SELECT DISTINCT route FROM finer WHERE version = 'V1'),
        b AS (SELECT DISTINCT route FROM finer WHERE version = 'V2')
        SELECT route, 'both' AS found_in FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
        UNION ALL SELECT route, 'V1' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
        UNION ALL SELECT route, 'V2' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    ),
    "route_diff": (
        route_diff,
        f"""
        WITH {SAMPLES}, a AS (SELECT DISTINCT route FROM samples WHERE version = 'V1'),
        b AS (SELECT DISTINCT route FROM samples WHERE version = 'V2')
        SELECT route, 'both' AS found_in FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
        UNION ALL SELECT route, 'V1' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
        UNION ALL SELECT route, 'V2' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    ),
}
