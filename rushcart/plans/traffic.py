from __future__ import annotations

from datetime import timedelta

from rushcart.operators import traffic
from rushcart.plans.common import SAMPLES, events, samples

HOUR = timedelta(hours=1)


def hourly_traffic(spark, sf_dir):
    return traffic.traffic(events(spark, sf_dir), HOUR)


def hourly_traffic_by_type(spark, sf_dir):
    return traffic.traffic(events(spark, sf_dir), HOUR, ["event_type"])


def sliding_traffic(spark, sf_dir):
    return traffic.traffic_sliding(events(spark, sf_dir), HOUR, timedelta(minutes=15))


def peak_windows(spark, sf_dir):
    return traffic.peak_windows(events(spark, sf_dir), HOUR, 10)


def spikes(spark, sf_dir):
    return traffic.spikes(traffic.traffic(events(spark, sf_dir), HOUR), 24, 2.0)


def spikes_by_version(spark, sf_dir):
    counted = traffic.traffic(samples(spark, sf_dir), HOUR, ["version"])
    return traffic.spikes(counted, 24, 2.0, ["version"])


GRID = """
hours AS (
  SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
                                INTERVAL 1 HOUR)) AS window_start
  FROM events)"""

PLANS = {
    "hourly_traffic": (
        hourly_traffic,
        f"""
        WITH {GRID}
        SELECT window_start, count(event_id) AS requests
        FROM hours LEFT JOIN events ON date_trunc('hour', ts) = window_start
        GROUP BY window_start""",
    ),
    "hourly_traffic_by_type": (
        hourly_traffic_by_type,
        f"""
        WITH {GRID}, types AS (SELECT DISTINCT event_type FROM events)
        SELECT h.window_start, t.event_type, count(e.event_id) AS requests
        FROM hours h CROSS JOIN types t
        LEFT JOIN events e ON date_trunc('hour', e.ts) = h.window_start
          AND e.event_type = t.event_type
        GROUP BY ALL""",
    ),
    "sliding_traffic": (
        sliding_traffic,
        """
        WITH starts AS (
          SELECT time_bucket(INTERVAL 15 MINUTE, ts) - back * INTERVAL 15 MINUTE AS window_start
          FROM events, range(4) AS r(back))
        SELECT window_start, count(*) AS requests FROM starts GROUP BY window_start""",
    ),
    "peak_windows": (
        peak_windows,
        """
        SELECT date_trunc('hour', ts) AS window_start, count(*) AS requests
        FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
    "spikes": (
        spikes,
        f"""
        WITH {GRID}, counted AS (
          SELECT window_start, count(event_id) AS requests
          FROM hours LEFT JOIN events ON date_trunc('hour', ts) = window_start
          GROUP BY window_start)
        SELECT window_start, requests,
               count(*) OVER w >= 2
                 AND requests > avg(requests) OVER w + 2 * stddev_samp(requests) OVER w AS is_spike
        FROM counted
        WINDOW w AS (ORDER BY window_start ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
    ),
    "spikes_by_version": (
        spikes_by_version,
        f"""
        WITH {SAMPLES}, {GRID}, versions AS (SELECT DISTINCT version FROM samples), counted AS (
          SELECT h.window_start, v.version, count(s.ts) AS requests
          FROM hours h CROSS JOIN versions v
          LEFT JOIN samples s ON date_trunc('hour', s.ts) = h.window_start AND s.version = v.version
          GROUP BY ALL)
        SELECT window_start, version, requests,
               count(*) OVER w >= 2
                 AND requests > avg(requests) OVER w + 2 * stddev_samp(requests) OVER w AS is_spike
        FROM counted
        WINDOW w AS (PARTITION BY version ORDER BY window_start
                     ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
    ),
}
