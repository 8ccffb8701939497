"""What was bought, when, by whom."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from rushcart.functions.money import line_revenue, whole


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Order lines as bought. ``lines`` is 1 here and a count after :func:`summed`.

    Revenue is a decimal; it and quantities, which are summed as decimals, add up exactly.
    """
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("item"),
        F.lit(1).alias("lines"),
        F.col("l_quantity").alias("quantity"),
        line_revenue("l_extendedprice", "l_discount").alias("revenue"),
    )


def summed(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines added up per ``keys``, for the functions below to go on from.

    Summing per order before joining the orders makes a huge order one row, and
    its rows reach that join already shuffled by order.
    """
    return lines.groupBy(*keys).agg(
        F.sum("lines").alias("lines"),
        F.sum(whole("quantity")).alias("quantity"),
        F.sum("revenue").alias("revenue"),
    )


def with_buyers(
    lines: DataFrame,
    orders: DataFrame,
    customer: DataFrame | None = None,
    nation: DataFrame | None = None,
    region: DataFrame | None = None,
) -> DataFrame:
    """Add who ordered, when and, as far as the tables are given, from where.

    Leave out the tables a question does not need: a join that is not there costs
    nothing. Small tables meet each other before the large ones.
    """
    buyers = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user"),
        F.col("o_orderdate").alias("ordered_at"),
    )
    if customer is not None:
        home = customer.select(
            F.col("c_custkey").alias("user"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("_nation"),
        )
        if nation is not None:
            places = nation.select(
                F.col("n_nationkey").alias("_nation"),
                F.col("n_name").alias("nation"),
                F.col("n_regionkey").alias("_region"),
            )
            if region is not None:
                regions = region.select(
                    F.col("r_regionkey").alias("_region"), F.col("r_name").alias("region")
                )
                places = places.join(regions, "_region")
            home = home.join(places.drop("_region"), "_nation")
        buyers = buyers.join(home.drop("_nation"), "user")
    return lines.join(buyers, "order_id")


def with_products(lines: DataFrame, part: DataFrame) -> DataFrame:
    products = part.select(
        F.col("p_partkey").alias("item"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
    )
    return lines.join(products, "item")


def purchase_lines(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    part: DataFrame,
    nation: DataFrame,
    region: DataFrame,
) -> DataFrame:
    """Order lines with their order, customer, nation, region and product."""
    lines = order_lines(lineitem).drop("lines")
    return with_products(with_buyers(lines, orders, customer, nation, region), part)


def _lines():
    return F.sum("lines").alias("lines")


def _units():
    return F.sum(whole("quantity")).cast("double").alias("units")


def _revenue():
    return F.sum("revenue").cast("double").alias("revenue")


def revenue_by_period(lines: DataFrame, unit: str) -> DataFrame:
    """Orders, units and revenue per ``day``, ``week``, ``month``, ..."""
    period = F.date_trunc(unit, "ordered_at").cast("timestamp_ntz").alias("period")
    return lines.groupBy(period).agg(
        F.countDistinct("order_id").alias("orders"), _units(), _revenue()
    )


def _products(lines: DataFrame, *group: str) -> DataFrame:
    return lines.groupBy(*group, "item").agg(_lines(), _units(), _revenue())


def top_products(lines: DataFrame, k: int, by: str = "revenue") -> DataFrame:
    """The ``k`` best by ``revenue``, ``units`` or ``lines``; ties go to the smaller item."""
    return _products(lines).orderBy(F.desc_nulls_last(by), "item").limit(k)


def top_products_per(lines: DataFrame, group: str, k: int, by: str = "revenue") -> DataFrame:
    """The ``k`` best of every group; partial rankings run before the shuffle."""
    best = Window.partitionBy(group).orderBy(F.desc_nulls_last(by), "item")
    return (
        _products(lines, group)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
    )


def customer_purchases(lines: DataFrame) -> DataFrame:
    """First and last purchase, orders, distinct products and spend per customer.

    Two distinct counts in one grouping would copy every line twice; here lines become one
    row per order on one side and one per product on the other, and the two meet per customer.
    """
    orders = lines.groupBy("user", "order_id").agg(
        F.min("ordered_at").alias("_first"),
        F.max("ordered_at").alias("_last"),
        F.sum("revenue").alias("_spend"),
    )
    bought = orders.groupBy("user").agg(
        F.min("_first").alias("first_purchase"),
        F.max("_last").alias("last_purchase"),
        F.count("order_id").alias("orders"),
        F.sum("_spend").cast("double").alias("spend"),
    )
    products = (
        lines.select(F.col("user").alias("_user"), "item").distinct().groupBy("_user").agg(F.count("item").alias("products"))
    )
    return bought.join(products, F.col("user").eqNullSafe(F.col("_user"))).select(
        "user", "first_purchase", "last_purchase", "orders", "products", "spend"
    )


def revenue_rollup(lines: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Subtotals over ``cols`` from left to right; ``level`` is Spark's grouping id.

    Lines are summed up per finest group first, so the rollup copies only those sums.
    """
    level = F.grouping_id().cast("long").alias("level")
    return summed(lines, *cols).rollup(*cols).agg(level, _lines(), _revenue())


def daily_revenue(lines: DataFrame, group: str) -> DataFrame:
    day = F.to_date("ordered_at").alias("day")
    return lines.groupBy(group, day).agg(F.sum("revenue").alias("revenue"))


def running_revenue(daily: DataFrame, group: str) -> DataFrame:
    """Revenue so far, day by day. Takes one row per group and day, never raw lines."""
    sofar = (
        Window.partitionBy(group)
        .orderBy("day")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.select(
        group,
        "day",
        F.col("revenue").cast("double").alias("revenue"),
        F.sum("revenue").over(sofar).cast("double").alias("running"),
    )


def dedupe_purchases(lines: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``, which must be a total order.

    Spark keeps one candidate per key and task before the shuffle, so copies of a
    much repeated key are not sent to one place.
    """
    first = Window.partitionBy(*key).orderBy(*order)
    return lines.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
