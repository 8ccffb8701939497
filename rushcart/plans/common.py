"""Tables and SQL fragments that several plans share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rushcart.operators.purchases import order_lines, summed, with_buyers
from rushcart.sources.samples import samples_from_events
from rushcart.sources.tables import load_table


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "events")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples_from_events(events(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(load_table(spark, sf_dir, "lineitem"))


def buyers_of(spark: SparkSession, sf_dir: str, rows: DataFrame, *dims: str) -> DataFrame:
    """``rows`` with their orders and the tables in ``dims``."""
    return with_buyers(rows, **{name: load_table(spark, sf_dir, name) for name in ("orders", *dims)})


def bought_lines(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    return buyers_of(spark, sf_dir, lines(spark, sf_dir), *dims)


def bought_orders(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    """One row per order, for questions that do not look at single products."""
    return buyers_of(spark, sf_dir, summed(lines(spark, sf_dir), "order_id"), *dims)


SAMPLES = """
samples AS (
  SELECT 'V' || CAST(k % 4 + 1 AS VARCHAR) AS version, k // 4 AS route, ts,
         value AS latency_ms, event_type = 'error' AS is_error
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""

LINES = """
lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS item,
         l_quantity AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS revenue,
         o_custkey AS "user", o_orderdate AS ordered_at,
         c_mktsegment AS segment, n_name AS nation, r_name AS region,
         p_brand AS brand, p_type AS type
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  JOIN part ON p_partkey = l_partkey
)"""
