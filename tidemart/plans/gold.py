"""Star schema: four dimensions, the order-line fact and four aggregate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.numbers import amount, exact, mean, mean_amount, points, ratio
from tidemart.operators.skew import HotSlots, skew_safe_join


def dim_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Sellers with the coordinates of their zip prefix (one geolocation row each)."""
    geo = geolocation.select(
        F.col("geolocation_zip_code_prefix").alias("_zip"),
        F.col("geolocation_lat").alias("seller_lat"),
        F.col("geolocation_lng").alias("seller_lng"))
    return sellers.join(geo, sellers["seller_zip_code_prefix"] == geo["_zip"], "left").select(
        "seller_id", "seller_city", "seller_state", "seller_zip_code_prefix",
        "seller_lat", "seller_lng")


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        amount(F.sum(exact("payment_value"))).alias("payment_value"),
        F.max("payment_type").alias("payment_type"),
        F.avg("payment_installments").alias("avg_installments"))


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("review_score"))


def order_level(orders: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order with its payments and reviews folded in. Both sides of both
    joins have unique keys, so no row is multiplied and no key is hot."""
    return (orders.join(payments_per_order(payments), "order_id", "left")
            .join(reviews_per_order(reviews), "order_id", "left"))


def delivery_columns(delivered: str, purchased: str, estimated: str) -> dict:
    """Calendar days to delivery and the two flags, NULL while undelivered."""
    done, due = F.col(delivered), F.col(estimated)
    return {
        "delivery_days": F.datediff(done, F.col(purchased)),
        "delay_flag": F.when(done.isNull(), F.lit(None).cast("int"))
        .when(done > due, 1).otherwise(0),
        "on_time_flag": F.when(done.isNull(), F.lit(None).cast("int"))
        .when(done <= due, 1).otherwise(0),
    }


def fact_order_items(orders: DataFrame, items: DataFrame, payments: DataFrame,
                     reviews: DataFrame, hot_orders: HotSlots | None = None) -> DataFrame:
    """One row per order line.

    Payments and reviews are attached at order grain first, so the line rows, the
    largest input, are shuffled once, for the single join with their order. Orders in
    ``hot_orders`` (see ``hot_slots``) are spread over several tasks in that join.
    """
    order_side = order_level(orders, payments, reviews).select(
        "order_id", "customer_id", "payment_value", "payment_type", "avg_installments",
        "order_status", F.col("order_purchase_timestamp").alias("purchase_timestamp"),
        F.col("order_delivered_customer_date").alias("delivered_date"),
        "order_estimated_delivery_date",
        F.coalesce("review_score", F.lit(0.0)).alias("review_score"))
    lines = items.select("order_id", "order_item_id", "product_id", "seller_id",
                         "price", "freight_value")
    joined = skew_safe_join(lines, order_side, ["order_id"], "inner", hot_orders)
    return joined.select(
        "order_id", "order_item_id", "customer_id", "product_id", "seller_id",
        "price", "freight_value", (F.col("price") + F.col("freight_value")).alias("total_amount"),
        "payment_value", "payment_type", "avg_installments", "order_status",
        "purchase_timestamp", "delivered_date", "order_estimated_delivery_date", "review_score",
        *(c.alias(n) for n, c in delivery_columns(
            "delivered_date", "purchase_timestamp", "order_estimated_delivery_date").items()))


def order_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_id").agg(
        F.count("order_item_id").alias("total_items"),
        amount(F.sum(exact("price"))).alias("total_price"),
        amount(F.sum(exact("freight_value"))).alias("total_freight"),
        amount(F.sum(exact("total_amount"))).alias("total_amount"),
        F.max("order_status").alias("order_status"),
        F.min("purchase_timestamp").alias("purchase_date"),
        F.max("delivered_date").alias("delivered_date"),
        mean("delivery_days", 0).cast("int").alias("delivery_days"))


def customer_state(fact: DataFrame) -> DataFrame:
    """Sums and counts of a customer's lines, from which the metrics follow. All but the last
    date can be added to and subtracted from: an order belongs to one customer."""
    spent = exact("total_amount")
    return fact.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("order_id").alias("orders"),
        F.sum(spent).alias("spent"), F.count(spent).alias("spent_n"),
        F.sum(points("review_score")).alias("score"), F.count("review_score").alias("score_n"),
        F.max("purchase_timestamp").alias("last_order_date"))


def customers_of(state: DataFrame) -> DataFrame:
    return state.select(
        "customer_id", F.col("orders").alias("total_orders"),
        amount(F.when(F.col("spent_n") > 0, F.col("spent"))).alias("total_spent"),
        mean_amount(F.col("spent"), F.col("spent_n")).alias("avg_order_value"),
        "last_order_date", ratio(F.col("score"), F.col("score_n"), 1).alias("avg_review_score"))


def customer_metrics(fact: DataFrame) -> DataFrame:
    """Lifetime value. ``avg_order_value`` is the mean per order line, as published; see
    ``order_value_per_customer`` for the mean per order."""
    return customers_of(customer_state(fact))


def order_value_per_customer(fact: DataFrame) -> DataFrame:
    """Spend divided by distinct orders: the average value of an order."""
    spent = exact("total_amount")
    return fact.groupBy("customer_id").agg(
        mean_amount(F.sum(spent), F.count_distinct("order_id")).alias("avg_per_order"))


def seller_state(fact: DataFrame) -> DataFrame:
    """Sums and counts of a seller's lines."""
    return fact.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("order_id").alias("orders"),
        F.sum(exact("price")).alias("revenue"), F.count("price").alias("revenue_n"),
        F.sum(points("review_score")).alias("score"), F.count("review_score").alias("score_n"),
        F.sum("on_time_flag").alias("on_time"), F.count("on_time_flag").alias("on_time_n"),
        F.sum("delivery_days").alias("days"), F.count("delivery_days").alias("days_n"))


def sellers_of(state: DataFrame) -> DataFrame:
    return state.select(
        "seller_id", F.col("orders").alias("total_orders"),
        amount(F.when(F.col("revenue_n") > 0, F.col("revenue"))).alias("total_revenue"),
        ratio(F.col("score"), F.col("score_n"), 2).alias("avg_review_score"),
        F.round(F.col("on_time") * F.lit(100.0) / F.nullif(F.col("on_time_n"), F.lit(0)), 1)
        .alias("on_time_delivery_rate"),
        ratio(F.col("days"), F.col("days_n"), 1).alias("avg_delivery_days"))


def seller_performance(fact: DataFrame) -> DataFrame:
    """Undelivered lines (NULL flags) count neither as on time nor as late."""
    return sellers_of(seller_state(fact))


def product_state(fact: DataFrame) -> DataFrame:
    """Sums and counts of a product's lines."""
    price = exact("price")
    return fact.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(price).alias("sales"),
        F.count(price).alias("sales_n"),
        F.sum(points("review_score")).alias("score"), F.count("review_score").alias("score_n"))


def products_of(state: DataFrame) -> DataFrame:
    return state.select(
        "product_id", F.col("lines").alias("total_quantity"),
        amount(F.when(F.col("sales_n") > 0, F.col("sales"))).alias("total_sales"),
        mean_amount(F.col("sales"), F.col("sales_n")).alias("avg_price"),
        ratio(F.col("score"), F.col("score_n"), 2).alias("avg_review_score"))


def product_performance(fact: DataFrame) -> DataFrame:
    return products_of(product_state(fact))


def unmatched_customers(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with sales but without a dimension row: inner joins drop these sales.
    The fact is reduced to one row per customer before the join."""
    spent = exact("total_amount")
    sales = fact.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lines"), amount(F.sum(spent)).alias("lost_revenue"))
    return sales.join(customers.select("customer_id"), "customer_id", "left_anti")
