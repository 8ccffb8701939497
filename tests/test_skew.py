"""Joins on a key that holds a third of the rows are split over several tasks."""

import pytest
from conftest import plan, tuples
from pyspark.sql import functions as F

from rushcart.functions.pairs import co_occurrence
from rushcart.functions.skew import cut_hot_keys
from rushcart.operators import journeys, purchases, recommend
from rushcart.sources.tables import load_table

SF = "/root/testdata/sf0.01"

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}


@pytest.fixture
def small(spark):
    """Make Spark take these small tables for large ones."""
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key in SMALL:
        spark.conf.unset(key)


def split_joins(df):
    df.collect()
    return plan(df).split("Initial Plan")[0].count("SortMergeJoin(skew=true)")


def hot_lines(spark):
    lineitem = load_table(spark, SF, "lineitem").repartition(8)
    hot = F.when(F.col("l_linenumber") <= 3, 5).otherwise(F.col("l_orderkey"))
    return purchases.order_lines(lineitem.withColumn("l_orderkey", hot))


def hot_events(spark):
    log = load_table(spark, SF, "events").repartition(8)
    return log.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 5).otherwise(F.col("user_id")))


def test_only_hot_keys_are_cut_into_even_slices(spark):
    log = hot_events(spark)
    rows, cut = cut_hot_keys(log, "user_id", "ts", rows=200)
    assert cut
    pieces = rows.where("piece IS NOT NULL").groupBy("user_id", "piece").agg(F.count("*").alias("n"))
    assert {r["user_id"] for r in pieces.select("user_id").distinct().collect()} == {5}
    sizes = [r["n"] for r in pieces.collect()]
    assert len(sizes) > 10 and max(sizes) <= 2 * 200
    assert rows.count() == log.count()
    whole, cut = cut_hot_keys(log, "user_id", "ts")
    assert not cut and whole.where("piece IS NOT NULL").count() == 0


def test_bursts_and_frequent_times_are_cut_by_rows(spark):
    burst = spark.range(10_000).select(F.lit(1).alias("user"), F.expr("timestamp_micros(1700000000000000 + id * 1000)").alias("ts"))
    early = burst.limit(1).withColumn("ts", F.expr("ts - INTERVAL 365 DAYS"))
    same = spark.range(900).select(F.lit(1).alias("user"), F.expr("timestamp_micros(1700000005000000)").alias("ts"))
    rows, cut = cut_hot_keys(burst.unionByName(early).unionByName(same), "user", "ts", rows=100)
    pieces = rows.groupBy("piece").agg(F.count("*").alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high")).orderBy("low").collect()
    assert cut and sum(p.n for p in pieces) == 10_901
    assert all(p.n <= 200 or p.low == p.high for p in pieces)
    assert [p.piece for p in pieces] == sorted(p.piece for p in pieces)
    assert all(a.high < b.low for a, b in zip(pieces, pieces[1:]))


def test_huge_groups_are_set_aside_and_the_next_ones_blocked(spark):
    members = spark.range(9_000).select(
        F.when(F.col("id") < 3_000, -1).otherwise(F.floor(F.col("id") / 5)).alias("grp"),
        (F.col("id") % 3_000).alias("item"),
        F.lit(1.0).alias("w"),
    )
    text = plan(co_occurrence(members, 2, wide=100))
    assert "_block" in text and "Cartesian" not in text and "NestedLoop" not in text
    columns = ("a", "b", "n", "dot")
    assert tuples(co_occurrence(members, 2, wide=100), *columns) == tuples(co_occurrence(members, 2), *columns)


def test_a_hot_order_is_split(small):
    bought = purchases.with_buyers(hot_lines(small), load_table(small, SF, "orders"))
    assert split_joins(purchases.customer_purchases(bought)) == 1
    assert split_joins(recommend.interactions(bought)) == 1


def test_a_hot_order_is_one_row_where_orders_are_summed(small):
    totals = purchases.summed(hot_lines(small), "order_id")
    bought = purchases.with_buyers(totals, load_table(small, SF, "orders"))
    assert split_joins(purchases.revenue_by_period(bought, "day")) == 0


def test_a_hot_user_is_split(small):
    log = hot_events(small)
    buyers = log.where("event_type = 'purchase'")
    assert split_joins(journeys.only(log, buyers, ["user_id"])) == 1
    assert split_joins(journeys.never(log, buyers, ["user_id"])) == 1


def test_a_hot_item_is_split(small):
    inter = small.range(60_000).select(
        F.col("id").alias("user"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("item")
    )
    sim = small.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(1.0).alias("s"))
    assert split_joins(recommend.recommend(inter, sim, 3, "s")) == 1
