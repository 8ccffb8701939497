from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rushcart.operators import journeys, purchases
from rushcart.plans.common import LINES, bought_lines, bought_orders, events, lines
from rushcart.sources.tables import load_table

def load_orders(spark, sf_dir):
    return load_table(spark, sf_dir, "orders")


def purchase_lines(spark, sf_dir):
    names = ("lineitem", "orders", "customer", "part", "nation", "region")
    full = purchases.purchase_lines(*[load_table(spark, sf_dir, name) for name in names])
    return full.withColumn("revenue", F.col("revenue").cast("double"))


def revenue_by(unit):
    def run(spark, sf_dir):
        return purchases.revenue_by_period(bought_orders(spark, sf_dir), unit)

    sql = f"""
    WITH {LINES}
    SELECT CAST(date_trunc('{unit}', ordered_at) AS TIMESTAMP) AS period,
           count(DISTINCT order_id) AS orders,
           CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS units,
           CAST(sum(revenue) AS DOUBLE) AS revenue
    FROM lines GROUP BY 1"""
    return run, sql


def top_products(by):
    def run(spark, sf_dir):
        return purchases.top_products(lines(spark, sf_dir), 20, by)

    sql = f"""
    WITH {LINES}
    SELECT item, count(*) AS lines,
           CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS units,
           CAST(sum(revenue) AS DOUBLE) AS revenue
    FROM lines GROUP BY item ORDER BY {by} DESC, item LIMIT 20"""
    return run, sql


def top_products_per_segment(spark, sf_dir):
    return purchases.top_products_per(bought_lines(spark, sf_dir, "customer"), "segment", 10)


def customer_purchases(spark, sf_dir):
    return purchases.customer_purchases(bought_lines(spark, sf_dir))


def revenue_rollup(spark, sf_dir):
    return purchases.revenue_rollup(
        bought_orders(spark, sf_dir, "customer", "nation", "region"), ["segment", "region"]
    )


def running_revenue(spark, sf_dir):
    daily = purchases.daily_revenue(bought_orders(spark, sf_dir, "customer"), "segment")
    return purchases.running_revenue(daily, "segment").withColumn(
        "day", F.col("day").cast("timestamp_ntz")
    )


def deduped_lines(spark, sf_dir):
    raw = load_table(spark, sf_dir, "lineitem")
    rest = [c for c in raw.columns if c not in ("l_orderkey", "l_linenumber")]
    return purchases.dedupe_purchases(raw, ["l_orderkey", "l_linenumber"], sorted(rest))


def funnel(spark, sf_dir):
    return journeys.funnel(
        events(spark, sf_dir), ["view", "click", "purchase"], timedelta(hours=12)
    )


def last_touch(spark, sf_dir):
    return journeys.last_touch(events(spark, sf_dir), "purchase", "view")


def conversions(spark, sf_dir):
    log = events(spark, sf_dir)
    return journeys.conversions(log.where("event_type = 'view'"), log.where("event_type = 'purchase'"), timedelta(hours=6))


def sessions(spark, sf_dir):
    return journeys.sessionize(events(spark, sf_dir), timedelta(minutes=30))


def viewers_without_purchase(spark, sf_dir):
    log = events(spark, sf_dir)
    viewers = log.where("event_type = 'view'").select("user_id").distinct()
    return journeys.never(viewers, log.where("event_type = 'purchase'"), ["user_id"])


def customers_without_order(spark, sf_dir):
    buyers = load_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return journeys.never(load_table(spark, sf_dir, "customer"), buyers, ["c_custkey"])


def products_never_sold(spark, sf_dir):
    sold = load_table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return journeys.never(load_table(spark, sf_dir, "part"), sold, ["p_partkey"])


def orders_without_line(spark, sf_dir):
    has_line = load_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return journeys.never(load_table(spark, sf_dir, "orders"), has_line, ["o_orderkey"])


def events_of_big_buyers(spark, sf_dir):
    """Events on days on which the user bought something above 150."""
    log = events(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    big = log.where("event_type = 'purchase' AND value > 150")
    return journeys.only(log, big, ["user_id", "day"])


def buyer_events(spark, sf_dir):
    log = events(spark, sf_dir)
    return journeys.only(log, log.where("event_type = 'purchase'"), ["user_id"])


PLANS = {
    "load_orders": (load_orders, "SELECT * FROM orders"),
    "purchase_lines": (
        purchase_lines,
        f"WITH {LINES} SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM lines",
    ),
    "revenue_by_day": revenue_by("day"),
    "revenue_by_week": revenue_by("week"),
    "revenue_by_month": revenue_by("month"),
    "top_products_by_revenue": top_products("revenue"),
    "top_products_by_lines": top_products("lines"),
    "top_products_per_segment": (
        top_products_per_segment,
        f"""
        WITH {LINES}, sums AS (
          SELECT segment, item, count(*) AS lines,
                 CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS units,
                 CAST(sum(revenue) AS DOUBLE) AS revenue
          FROM lines GROUP BY segment, item)
        SELECT *, CAST(row_number() OVER (PARTITION BY segment ORDER BY revenue DESC, item)
                       AS INTEGER) AS rank
        FROM sums QUALIFY rank <= 10""",
    ),
    "customer_purchases": (
        customer_purchases,
        f"""
        WITH {LINES}
        SELECT "user", min(ordered_at) AS first_purchase, max(ordered_at) AS last_purchase,
               count(DISTINCT order_id) AS orders, count(DISTINCT item) AS products,
               CAST(sum(revenue) AS DOUBLE) AS spend
        FROM lines GROUP BY "user" """,
    ),
    "revenue_rollup": (
        revenue_rollup,
        f"""
        WITH {LINES}
        SELECT segment, region, CAST(grouping_id(segment, region) AS BIGINT) AS level,
               count(*) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue
        FROM lines GROUP BY ROLLUP (segment, region)""",
    ),
    "running_revenue": (
        running_revenue,
        f"""
        WITH {LINES}, daily AS (
          SELECT segment, date_trunc('day', ordered_at) AS day, sum(revenue) AS revenue
          FROM lines GROUP BY 1, 2)
        SELECT segment, CAST(day AS TIMESTAMP) AS day, CAST(revenue AS DOUBLE) AS revenue,
               CAST(sum(revenue) OVER (PARTITION BY segment ORDER BY day
                    RANGE UNBOUNDED PRECEDING) AS DOUBLE) AS running
        FROM daily""",
    ),
    "deduped_lines": (
        deduped_lines,
        """
        SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem
        ORDER BY l_orderkey, l_linenumber, l_discount NULLS FIRST, l_extendedprice NULLS FIRST,
                 l_linestatus NULLS FIRST, l_partkey NULLS FIRST, l_quantity NULLS FIRST,
                 l_returnflag NULLS FIRST, l_shipdate NULLS FIRST, l_suppkey NULLS FIRST,
                 l_tax NULLS FIRST""",
    ),
    "funnel": (
        funnel,
        """
        WITH v AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'view'),
        c AS (
          SELECT v.event_id, v.user_id, min(e.ts) AS ts
          FROM v LEFT JOIN events e ON e.user_id = v.user_id AND e.event_type = 'click'
            AND e.ts > v.ts AND e.ts <= v.ts + INTERVAL 12 HOUR
          GROUP BY ALL),
        p AS (
          SELECT c.event_id, c.user_id, c.ts AS clicked, min(e.ts) AS bought
          FROM c LEFT JOIN events e ON e.user_id = c.user_id AND e.event_type = 'purchase'
            AND e.ts > c.ts AND e.ts <= c.ts + INTERVAL 12 HOUR
          GROUP BY ALL)
        SELECT 1 AS step_no, 'view' AS step, count(DISTINCT user_id) AS users, count(*) AS starts FROM p
        UNION ALL
        SELECT 2, 'click', count(DISTINCT user_id), count(*) FROM p WHERE clicked IS NOT NULL
        UNION ALL
        SELECT 3, 'purchase', count(DISTINCT user_id), count(*) FROM p WHERE bought IS NOT NULL""",
    ),
    "last_touch": (
        last_touch,
        """
        SELECT p.event_id, p.user_id, p.ts, v.event_id AS touch_id, v.ts AS touch_ts
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
          ON v.user_id = p.user_id AND p.ts > v.ts""",
    ),
    "conversions": (
        conversions,
        """
        SELECT v.user_id, v.event_id AS view_id, v.ts AS viewed_at,
               b.event_id AS purchase_id, b.ts AS bought_at
        FROM events v JOIN events b ON b.user_id = v.user_id
          AND b.ts > v.ts AND b.ts <= v.ts + INTERVAL 6 HOUR
        WHERE v.event_type = 'view' AND b.event_type = 'purchase'""",
    ),
    "sessions": (
        sessions,
        """
        WITH flagged AS (
          SELECT user_id, ts, event_id,
                 CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        numbered AS (
          SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no
          FROM flagged)
        SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events
        FROM numbered GROUP BY user_id, no""",
    ),
    "viewers_without_purchase": (
        viewers_without_purchase,
        """
        SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND user_id NOT IN
          (SELECT user_id FROM events WHERE event_type = 'purchase')""",
    ),
    "customers_without_order": (
        customers_without_order,
        "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    ),
    "products_never_sold": (
        products_never_sold,
        "SELECT * FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)",
    ),
    "orders_without_line": (
        orders_without_line,
        "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    ),
    "events_of_big_buyers": (
        events_of_big_buyers,
        """
        WITH log AS (SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events)
        SELECT * FROM log WHERE (user_id, day) IN
          (SELECT (user_id, day) FROM log WHERE event_type = 'purchase' AND value > 150)""",
    ),
    "buyer_events": (
        buyer_events,
        """
        SELECT * FROM events WHERE user_id IN
          (SELECT user_id FROM events WHERE event_type = 'purchase')""",
    ),
}
