from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rushcart.operators import cache
from rushcart.plans.common import events
from rushcart.sources.tables import load_table

TTLS = [timedelta(minutes=1), timedelta(minutes=30), timedelta(hours=6), timedelta(days=1)]


def hot_users(spark, sf_dir):
    return cache.hot_keys(events(spark, sf_dir), "user_id", 20)


def hot_users_approx(spark, sf_dir):
    return cache.hot_keys_approx(events(spark, sf_dir), "user_id", 20)


def hot_users_counted(spark, sf_dir):
    return cache.hot_keys_counted(events(spark, sf_dir), "user_id", 20)


def hot_products_counted(spark, sf_dir):
    return cache.hot_keys_counted(load_table(spark, sf_dir, "lineitem"), "l_partkey", 100)


def load_spread_hashed_in_all(spark, sf_dir):
    """What all servers got, and whether the fullest one got its imbalance times the mean."""
    spread = load_spread_hashed(spark, sf_dir)
    fullest = F.max("requests") / F.avg("requests") - F.max("imbalance")
    return spread.agg(
        F.count("*").alias("servers"),
        F.sum("requests").alias("requests"),
        F.countDistinct("bucket").alias("buckets"),
        (F.abs(fullest) < 1e-9).alias("as_said"),
    )


def coverage_curve(spark, sf_dir):
    return cache.coverage_curve(events(spark, sf_dir), "user_id")


def reuse_gaps(spark, sf_dir):
    return cache.reuse_gaps(events(spark, sf_dir), "user_id")


def ttl_hit_share(spark, sf_dir):
    return cache.ttl_hit_share(reuse_gaps(spark, sf_dir), TTLS)


def working_set(spark, sf_dir):
    return cache.working_set(events(spark, sf_dir), "user_id", timedelta(days=1))


def working_set_approx(spark, sf_dir):
    return cache.working_set(events(spark, sf_dir), "user_id", timedelta(days=1), approx=True)


def working_set_approx_holds_its_bound(spark, sf_dir):
    """Exact counts per day, and whether the estimate is within three standard errors."""
    exact, near = working_set(spark, sf_dir), working_set_approx(spark, sf_dir)
    both = exact.join(near.withColumnRenamed("keys", "_near"), "window_start")
    close = F.abs(F.col("_near") - F.col("keys")) <= 0.15 * F.col("keys")
    return both.select("window_start", "keys", close.alias("close"))


QUARTER = timedelta(days=91)


def _shipped(spark, sf_dir):
    lines = load_table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_partkey", "l_returnflag", F.col("l_shipdate").alias("ts"))


def products_sliding_approx(spark, sf_dir):
    return cache.working_set_sliding(_shipped(spark, sf_dir), "l_partkey", 4 * QUARTER, QUARTER)


def products_sliding_in_band(spark, sf_dir):
    """Products shipped per sliding year, counted, and whether the merged sketches are within four standard errors."""
    rows = _shipped(spark, sf_dir)
    windows = rows.select(F.window("ts", "364 days", "91 days")["start"].alias("window_start"), "l_partkey")
    exact = windows.groupBy("window_start").agg(F.countDistinct("l_partkey").alias("products"))
    both = exact.join(products_sliding_approx(spark, sf_dir), "window_start")
    band = 4 * 1.04 / 2 ** (cache.LG / 2) * F.col("products") + 1
    return both.select("window_start", "products", (F.abs(F.col("keys") - F.col("products")) <= band).alias("in_band"))


def shared_orders_approx(spark, sf_dir):
    return cache.shared_keys(_shipped(spark, sf_dir), "l_orderkey", "l_returnflag", "A", "N")


def shared_orders_in_band(spark, sf_dir):
    """Orders with lines of both flags, and whether the estimate's band holds their number."""
    rows = _shipped(spark, sf_dir)
    flags = rows.where(F.col("l_returnflag").isin("A", "N")).groupBy("l_orderkey").agg(F.countDistinct("l_returnflag").alias("_n"))
    exact = flags.agg(F.count("*").alias("either"), F.count_if(F.col("_n") == 2).alias("both"))
    near = shared_orders_approx(spark, sf_dir).select(F.struct("low_both", "high_both", "either")).scalar()
    close = F.abs(F.col("near.either") - F.col("either")) <= 4 / 2 ** (cache.LG / 2) * F.col("either")
    held = F.col("both").between(F.floor("near.low_both"), F.ceil("near.high_both"))
    return exact.withColumn("near", near).select("either", "both", (held & close).alias("in_band"))


def load_spread(spark, sf_dir):
    return cache.load_spread(events(spark, sf_dir), "user_id", 8)


def load_spread_hashed(spark, sf_dir):
    return cache.load_spread(events(spark, sf_dir), "user_id", 8, hashed=True)


GAPS = """
gaps AS (
  SELECT user_id, ts,
         epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap_us
  FROM events)"""

PLANS = {
    "hot_users": (
        hot_users,
        """
        SELECT user_id, count(*) AS uses,
               CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events) AS share
        FROM events GROUP BY user_id ORDER BY uses DESC, user_id LIMIT 20""",
    ),
    "hot_users_approx": (hot_users_approx, None),
    "hot_users_counted": (
        hot_users_counted,
        """
        SELECT user_id, count(*) AS uses,
               CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events) AS share
        FROM events GROUP BY user_id ORDER BY uses DESC, user_id LIMIT 20""",
    ),
    "hot_products_counted": (
        hot_products_counted,
        """
        SELECT l_partkey, count(*) AS uses,
               CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem) AS share
        FROM lineitem GROUP BY l_partkey ORDER BY uses DESC, l_partkey LIMIT 100""",
    ),
    "coverage_curve": (
        coverage_curve,
        """
        WITH per_key AS (SELECT user_id, count(*) AS uses FROM events GROUP BY user_id),
        levels AS (SELECT DISTINCT uses FROM per_key)
        SELECT l.uses, count(*) AS keys, CAST(sum(k.uses) AS BIGINT) AS accesses,
               CAST(sum(k.uses) AS DOUBLE) / (SELECT count(*) FROM events) AS share
        FROM levels l JOIN per_key k ON k.uses >= l.uses GROUP BY l.uses""",
    ),
    "reuse_gaps": (reuse_gaps, f"WITH {GAPS} SELECT * FROM gaps"),
    "ttl_hit_share": (
        ttl_hit_share,
        f"""
        WITH {GAPS}, ttls AS (SELECT unnest([60.0, 1800.0, 21600.0, 86400.0]::DOUBLE[]) AS ttl_s)
        SELECT ttl_s, count(*) AS accesses, count(*) FILTER (gap_us <= ttl_s * 1e6) AS hits,
               CAST(count(*) FILTER (gap_us <= ttl_s * 1e6) AS DOUBLE) / count(*) AS hit_share
        FROM ttls, gaps GROUP BY ttl_s""",
    ),
    "working_set": (
        working_set,
        """
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
               count(DISTINCT user_id) AS keys
        FROM events GROUP BY 1""",
    ),
    "working_set_approx": (working_set_approx, None),
    "working_set_approx_holds_its_bound": (
        working_set_approx_holds_its_bound,
        """
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
               count(DISTINCT user_id) AS keys, true AS close
        FROM events GROUP BY 1""",
    ),
    "products_sliding_approx": (products_sliding_approx, None),
    "products_sliding_in_band": (
        products_sliding_in_band,
        """
        WITH starts AS (
          SELECT time_bucket(INTERVAL 91 DAY, l_shipdate, TIMESTAMP '1970-01-01') - back * INTERVAL 91 DAY AS window_start, l_partkey
          FROM lineitem, range(4) AS r(back))
        SELECT window_start, count(DISTINCT l_partkey) AS products, true AS in_band FROM starts GROUP BY window_start""",
    ),
    "shared_orders_approx": (shared_orders_approx, None),
    "shared_orders_in_band": (
        shared_orders_in_band,
        """
        WITH flags AS (
          SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem
          WHERE l_returnflag IN ('A', 'N') GROUP BY l_orderkey)
        SELECT count(*) AS either, count(*) FILTER (n = 2) AS both, true AS in_band FROM flags""",
    ),
    "load_spread": (
        load_spread,
        """
        WITH b AS (
          SELECT r.bucket, count(user_id) AS requests
          FROM range(8) AS r(bucket) LEFT JOIN events ON user_id % 8 = r.bucket
          GROUP BY r.bucket)
        SELECT bucket, requests, CAST(requests AS DOUBLE) / CAST(sum(requests) OVER () AS DOUBLE) AS share,
               CAST(max(requests) OVER () * 8 AS DOUBLE) / CAST(sum(requests) OVER () AS DOUBLE) AS imbalance
        FROM b""",
    ),
    "load_spread_hashed": (load_spread_hashed, None),
    "load_spread_hashed_in_all": (
        load_spread_hashed_in_all,
        """
        SELECT CAST(8 AS BIGINT) AS servers, count(user_id) AS requests, CAST(8 AS BIGINT) AS buckets,
               true AS as_said FROM events""",
    ),
}
