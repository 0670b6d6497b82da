"""Cohorts: customers grouped by the month of their first order.

Orders are folded to one row per customer and month before anything looks across a
customer's history. A customer then has at most one row per calendar month, so even
one with a third of all orders is a short window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.numbers import amount, exact, points, ratio
from tidemart.plans.gold import order_level


def _months(orders: DataFrame, *aggs) -> DataFrame:
    monthly = (orders.where("order_purchase_timestamp is not null and customer_id is not null")
               .groupBy("customer_id",
                        F.date_trunc("month", "order_purchase_timestamp").alias("month"))
               .agg(F.count(F.lit(1)).alias("orders"), *aggs))
    first = F.min("month").over(Window.partitionBy("customer_id"))
    offset = ((F.year("month") - F.year("cohort")) * 12 + F.month("month") - F.month("cohort"))
    return monthly.withColumn("cohort", first).withColumn("month_offset", offset)


def retention(orders: DataFrame) -> DataFrame:
    """Active customers per cohort and months since the first order, with the share of
    the cohort. One row per customer and month comes in, so a count is enough."""
    active = _months(orders).groupBy("cohort", "month_offset").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("orders").alias("orders"))
    size = F.max(F.when(F.col("month_offset") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort"))
    return active.withColumn("cohort_size", size).withColumn(
        "retention", F.col("active_customers") / F.col("cohort_size"))


def retention_matrix(orders: DataFrame) -> DataFrame:
    """Active customers for each cohort and every month offset that any cohort has; 0 where
    nobody came back. Rows, not columns: no offset is cut off, and no job finds the columns.
    Only counts per cohort and offset, months squared at most, meet in one window."""
    active = retention(orders).select("cohort", "month_offset", "active_customers")
    per_cohort = active.groupBy("cohort").agg(
        F.map_from_entries(F.collect_list(F.struct("month_offset", "active_customers"))).alias("m"),
        F.max("month_offset").alias("last"))
    last = F.max("last").over(Window.partitionBy())
    return per_cohort.withColumn("last", last).select("cohort", "m", F.explode(
        F.sequence(F.lit(0), "last")).alias("month_offset")).select(
        "cohort", "month_offset",
        F.coalesce(F.try_element_at("m", "month_offset"), F.lit(0)).alias("active_customers"))


def revenue(orders: DataFrame, items: DataFrame, payments: DataFrame,
            reviews: DataFrame) -> DataFrame:
    """Orders, item revenue, payments and mean review per cohort and month offset. Lines
    are summed per order before the join, so payments are counted once per order."""
    lines = items.groupBy("order_id").agg(
        F.sum(exact(F.col("price") + F.col("freight_value"))).alias("spent"))
    per_order = order_level(orders, payments, reviews).join(lines, "order_id", "left")
    monthly = _months(
        per_order, F.sum("spent").alias("spent"),
        F.sum(exact("payment_value")).alias("paid"),
        F.sum(points("review_score")).alias("score"), F.count("review_score").alias("reviewed"))
    return monthly.groupBy("cohort", "month_offset").agg(
        F.sum("orders").alias("orders"),
        amount(F.sum("spent")).alias("revenue"),
        amount(F.sum("paid")).alias("paid"),
        ratio(F.sum("score"), F.sum("reviewed"), 2).alias("avg_review"))
