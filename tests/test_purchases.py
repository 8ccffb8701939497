import pytest
from conftest import plan, tuples
from pyspark.sql import functions as F

from rushcart.operators import purchases
from rushcart.plans.common import bought_lines, bought_orders, lines
from rushcart.sources.tables import load_table

SF = "/root/testdata/sf0.001"


def test_first_copy_is_kept_and_copies_are_cut_before_the_shuffle(spark):
    rows = [(1, 1, "b"), (1, 1, "a"), (2, 1, None), (1, 2, "c")] + [(7, 7, f"x{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k long, n long, v string")
    got = purchases.dedupe_purchases(df, ["k", "n"], ["v"])
    assert tuples(got, "k", "n", "v") == [(1, 1, "a"), (1, 2, "c"), (2, 1, None), (7, 7, "x0")]
    assert plan(got).count("WindowGroupLimit") == 2


def test_top_per_group_ranks_before_the_shuffle(spark):
    got = purchases.top_products_per(bought_lines(spark, SF, "customer"), "segment", 3)
    assert plan(got).count("WindowGroupLimit") == 2
    assert {r["n"] for r in got.groupBy("segment").agg(F.count("*").alias("n")).collect()} == {3}


@pytest.mark.parametrize("unit", ["day", "week", "month", "year"])
def test_periods_add_up_to_the_whole(spark, unit):
    data = bought_lines(spark, SF)
    per_line = purchases.revenue_by_period(data, unit)
    got = per_line.agg(F.sum("units"), F.sum("orders")).first()
    assert got[0] == data.agg(F.sum("quantity")).first()[0]
    assert got[1] == data.select("order_id").distinct().count()
    per_order = purchases.revenue_by_period(bought_orders(spark, SF), unit)
    columns = ("period", "orders", "units", "revenue")
    assert tuples(per_line, *columns) == tuples(per_order, *columns)


def test_a_huge_order_is_summed_before_it_meets_its_order(spark):
    text = plan(purchases.revenue_by_period(bought_orders(spark, SF), "day"))
    below_the_join = text[text.index("Join") :]
    assert "partial_sum" in below_the_join
    assert below_the_join.count("Exchange hashpartitioning(order_id") == 2 or "Broadcast" in text


def test_rollup_total_is_the_plain_sum(spark):
    data = bought_lines(spark, SF, "customer", "nation", "region")
    got = purchases.revenue_rollup(data, ["segment", "region"])
    assert got.where("level = 3").first()["revenue"] == float(data.agg(F.sum("revenue")).first()[0])


def test_unused_tables_are_not_joined_and_unused_columns_not_read(spark):
    text = plan(purchases.top_products(lines(spark, SF), 5))
    assert text.count("FileScan") == 1 and "l_tax" not in text
    assert "TakeOrderedAndProject" in text
    text = plan(purchases.customer_purchases(bought_lines(spark, SF)))
    assert "Expand" not in text and "o_totalprice" not in text and "l_tax" not in text


def test_running_revenue_ends_at_the_group_total(spark):
    daily = purchases.daily_revenue(bought_lines(spark, SF, "customer"), "segment")
    got = purchases.running_revenue(daily, "segment").groupBy("segment").agg(F.max("running").alias("r"))
    want = daily.groupBy("segment").agg(F.sum("revenue").cast("double").alias("r"))
    assert tuples(got, "segment", "r") == tuples(want, "segment", "r")


def test_tables_load_whole(spark):
    assert load_table(spark, SF, "orders").count() == 1_500
