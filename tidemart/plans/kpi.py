"""Dashboard queries over the star schema.

Questions that need a customer attribute first fold the fact to one row per customer.
An order belongs to one customer, so distinct orders add up across customers and the
result is exact. The join with the customer dimension then has unique keys on both
sides: the fact itself is never joined and a customer with a third of all sales is
one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.functions.numbers import amount, exact, mean, mean_amount, points, ratio
from tidemart.functions.text import mask_id
from tidemart.operators.histogram import equal_width

TOP_SPENDERS = 5000


def review_range(fact: DataFrame, low: int = 1, high: int = 5) -> DataFrame:
    """Lines whose review score is in range; unreviewed lines have score 0."""
    return fact.where(F.col("review_score").between(low, high))


def per_customer(fact: DataFrame) -> DataFrame:
    """Additive measures per customer; unused ones are pruned by the optimizer."""
    spent = exact("total_amount")
    return fact.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(spent).alias("spent"), F.count(spent).alias("spent_n"),
        F.sum("delivery_days").alias("days"), F.count("delivery_days").alias("days_n"),
        F.sum("on_time_flag").alias("on_time"), F.count("on_time_flag").alias("on_time_n"),
        F.sum(F.when(F.col("delay_flag") == 1, 1).otherwise(0)).alias("late"),
        F.sum(points("review_score")).alias("score"), F.count("review_score").alias("score_n"))


def with_state(measures: DataFrame, customers: DataFrame, state: str | None = None) -> DataFrame:
    """Attach the customer's state; optionally keep one state (None keeps all)."""
    dim = customers.select("customer_id", F.col("customer_state").alias("state"))
    if state is not None:
        dim = dim.where(F.col("state") == F.lit(state))
    return measures.join(dim, "customer_id")


def distinct_status(orders: DataFrame) -> DataFrame:
    return (orders.where("order_status is not null").select("order_status").distinct()
            .orderBy("order_status"))


def distinct_state(fact: DataFrame, customers: DataFrame) -> DataFrame:
    buyers = fact.select("customer_id").distinct()
    return (customers.where("customer_state is not null").join(buyers, "customer_id", "left_semi")
            .select("customer_state").distinct().orderBy("customer_state"))


def overview(fact: DataFrame, customers: DataFrame, state: str | None = None,
             low: int = 1, high: int = 5) -> DataFrame:
    """One row of headline figures. The on-time rate excludes undelivered lines; the
    delay rate divides by all lines."""
    c = with_state(per_customer(review_range(fact, low, high)), customers, state)
    return c.agg(
        amount(F.sum("spent"), 0).alias("total_revenue"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        ratio(F.sum("days"), F.sum("days_n"), 1).alias("avg_delivery_days"),
        ratio(F.sum("on_time") * 100, F.sum("on_time_n"), 1).alias("on_time_pct"),
        F.count(F.lit(1)).alias("unique_customers"),
        ratio(F.sum("score"), F.sum("score_n"), 2).alias("avg_review"),
        ratio(F.sum("late") * 100, F.sum("lines"), 1).alias("delay_pct"),
        mean_amount(F.sum("spent"), F.sum("spent_n")).alias("avg_order_value"))


def revenue_by_state(fact: DataFrame, customers: DataFrame, state: str | None = None,
                     low: int = 1, high: int = 5, limit: int = 15) -> DataFrame:
    c = with_state(per_customer(review_range(fact, low, high)), customers, state)
    return (c.groupBy("state").agg(amount(F.sum("spent"), 0).alias("revenue"),
                                   F.sum("orders").alias("orders"))
            .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("state")).limit(limit))


def revenue_by_status(orders: DataFrame, status: str | None = None) -> DataFrame:
    """Revenue per order status with the grand total on each row. The window sees one
    row per status."""
    if status is not None:
        orders = orders.where(F.col("order_status") == F.lit(status))
    grouped = orders.groupBy("order_status").agg(F.sum(exact("total_amount")).alias("spent"))
    everything = Window.partitionBy()
    return grouped.select(
        "order_status", amount(F.col("spent"), 0).alias("revenue"),
        amount(F.sum("spent").over(everything), 0).alias("grand_total"),
    ).orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("order_status"))


def monthly_revenue(fact: DataFrame, limit: int = 24) -> DataFrame:
    return (fact.where("purchase_timestamp is not null")
            .groupBy(F.date_trunc("month", "purchase_timestamp").alias("month"))
            .agg(F.count_distinct("order_id").alias("orders"),
                 amount(F.sum(exact("total_amount")), 0).alias("revenue"))
            .orderBy("month").limit(limit))


def delivery_histogram(fact: DataFrame, max_days: int = 60, low: int = 1,
                       high: int = 5) -> DataFrame:
    return (review_range(fact, low, high)
            .where(F.col("delivery_days").between(0, max_days) & F.col("delay_flag").isNotNull())
            .groupBy("delivery_days", "delay_flag").agg(F.count(F.lit(1)).alias("orders"))
            .select("delivery_days", "orders", "delay_flag")
            .orderBy("delivery_days", "delay_flag"))


def on_time_by_state(fact: DataFrame, customers: DataFrame, state: str | None = None,
                     low: int = 1, high: int = 5, more_than: int = 50,
                     limit: int = 20) -> DataFrame:
    """States with more than ``more_than`` delivered lines, best on-time rate first."""
    delivered = review_range(fact, low, high).where("on_time_flag is not null")
    c = with_state(per_customer(delivered), customers, state)
    return (c.groupBy("state").agg(
        ratio(F.sum("on_time") * 100, F.sum("on_time_n"), 1).alias("on_time_rate"),
        F.sum("orders").alias("orders"),
        ratio(F.sum("days"), F.sum("days_n"), 1).alias("avg_days"),
        F.sum("lines").alias("lines"))
        .where(F.col("lines") > more_than).drop("lines")
        .orderBy(F.desc_nulls_last("on_time_rate"), F.asc_nulls_last("state")).limit(limit))


def state_bubble(by_state: DataFrame) -> DataFrame:
    """Orders scaled to the largest state, as marker sizes (at most 20 rows come in)."""
    largest = F.max("orders").over(Window.partitionBy())
    return by_state.withColumn("size", F.col("orders") / largest * 30 + 8)


def delay_by_score(fact: DataFrame) -> DataFrame:
    return (fact.where("review_score > 0 and delay_flag is not null and delivery_days is not null")
            .groupBy(F.round("review_score", 0).cast("int").alias("score"), "delay_flag")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy("score", "delay_flag"))


def delay_score_pivot(fact: DataFrame) -> DataFrame:
    """Delay flag by score, 0 where a pair does not occur. Scores outside 1 to 5 count as
    ``score_other``."""
    scores = [1, 2, 3, 4, 5]
    one = lambda test: F.coalesce(F.sum(F.when(test, F.col("cnt"))), F.lit(0))
    return delay_by_score(fact).groupBy("delay_flag").agg(
        *(one(F.col("score") == s).alias(f"score_{s}") for s in scores),
        one(~F.col("score").isin(scores)).alias("score_other"))


def state_share(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per state and its share of the total; the window sees one row per state."""
    by_state = (with_state(per_customer(fact), customers).groupBy("state")
                .agg(F.sum("spent").alias("spent")))
    everything = Window.partitionBy()
    revenue = amount(F.col("spent"), 0)
    return (by_state.select("state", revenue.alias("revenue"))
            .withColumn("share", F.col("revenue") / F.nullif(
                F.sum("revenue").over(everything), F.lit(0.0)))
            .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("state")))


def top_spenders(metrics: DataFrame, limit: int = TOP_SPENDERS) -> DataFrame:
    return (metrics.where("total_spent > 0")
            .orderBy(F.desc("total_spent"), "customer_id").limit(limit))


def customer_value_histogram(metrics: DataFrame, bins: int = 60) -> DataFrame:
    return equal_width(top_spenders(metrics), "total_spent", bins)


def sample_customers(metrics: DataFrame, size: int = 1500, seed: str = "7") -> DataFrame:
    """Repeatable sample of the top spenders: the ids with the smallest seeded hash."""
    draw = F.md5(F.concat(F.col("customer_id").cast("string"), F.lit(":" + seed)))
    return (top_spenders(metrics).orderBy(draw, "customer_id").limit(size)
            .select("customer_id", "total_spent", "total_orders", "avg_review_score"))


def top_customers(metrics: DataFrame, limit: int = 10) -> DataFrame:
    return (metrics.orderBy(F.desc_nulls_last("total_spent"), "customer_id").limit(limit)
            .select(mask_id("customer_id").alias("customer"), "total_orders",
                    F.round("total_spent", 0).alias("total_spent"),
                    F.round("avg_order_value", 0).alias("avg_order"),
                    F.round("avg_review_score", 1).alias("review")))


def top_sellers(sellers: DataFrame, min_orders: int = 5, limit: int = 200) -> DataFrame:
    return (sellers.where(F.col("total_orders") >= min_orders)
            .withColumn("revenue", F.round("total_revenue", 0))
            .orderBy(F.desc_nulls_last("revenue"), "seller_id").limit(limit)
            .select("seller_id", mask_id("seller_id").alias("seller"), "total_orders", "revenue",
                    F.round("avg_review_score", 2).alias("review"),
                    F.round("on_time_delivery_rate", 1).alias("on_time"),
                    F.round("avg_delivery_days", 1).alias("avg_days")))


def top15_sellers(sellers: DataFrame) -> DataFrame:
    """Head of the seller list, smallest first."""
    head = top_sellers(sellers).orderBy(F.desc_nulls_last("revenue"), "seller_id").limit(15)
    return head.orderBy(F.asc_nulls_last("revenue"), F.desc("seller_id"))


def seller_on_time_histogram(sellers: DataFrame, bins: int = 40) -> DataFrame:
    """Histogram of the on-time rate of the top sellers, with their mean rate."""
    return equal_width(top_sellers(sellers), "on_time", bins)


def category_performance(products: DataFrame, dim_products: DataFrame,
                         limit: int = 20) -> DataFrame:
    """Sales per category. The averages are unweighted means of the product means."""
    joined = products.join(dim_products.select("product_id", "product_category_name_english"),
                           "product_id")
    sales, price = exact("total_sales"), exact("avg_price")
    return (joined.groupBy(F.coalesce("product_category_name_english", F.lit("Unknown"))
                           .alias("category"))
            .agg(amount(F.sum(sales), 0).alias("total_sales"),
                 F.sum("total_quantity").alias("total_qty"),
                 mean_amount(F.sum(price), F.count(price), 0).alias("avg_price"),
                 mean("avg_review_score", 2).alias("avg_review"))
            .orderBy(F.desc_nulls_last("total_sales"), "category").limit(limit))


def top12_categories(products: DataFrame, dim_products: DataFrame) -> DataFrame:
    return category_performance(products, dim_products).orderBy(
        F.desc_nulls_last("total_sales"), "category").limit(12)


def product_price_review(products: DataFrame, dim_products: DataFrame,
                         limit: int = 2000) -> DataFrame:
    """Products sold at least 3 times; the lowest product ids make the list repeatable."""
    joined = products.where("total_quantity >= 3 and avg_price > 0").join(
        dim_products.select("product_id", "product_category_name_english"), "product_id")
    return joined.orderBy("product_id").limit(limit).select(
        "product_id",
        F.coalesce("product_category_name_english", F.lit("Other")).alias("category"),
        "avg_price", "avg_review_score", "total_sales")


def delivery_delay(orders: DataFrame) -> DataFrame:
    """Average days between the promised and the actual delivery of delivered orders."""
    delay = F.datediff("order_delivered_customer_date", "order_estimated_delivery_date")
    return orders.agg(ratio(F.sum(delay), F.count(delay)).alias("avg_delay"),
                      F.count(delay).alias("delivered_orders"))


def lifetime_value(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(
        amount(F.sum(exact("total_amount"))).alias("clv"))


def revenue_by_state_simple(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return (with_state(per_customer(fact), customers).groupBy("state")
            .agg(amount(F.sum("spent")).alias("revenue")))


def revenue_by_region(fact: DataFrame, customers: DataFrame, regions: DataFrame) -> DataFrame:
    """States rolled up to regions; ``regions`` maps state to region."""
    by_state = (with_state(per_customer(fact), customers).groupBy("state")
                .agg(F.sum("spent").alias("spent"), F.sum("orders").alias("orders")))
    return (by_state.join(regions, "state").groupBy("region")
            .agg(amount(F.sum("spent")).alias("revenue"), F.sum("orders").alias("orders")))


def run_sql(spark: SparkSession, text: str, args: dict | None = None,
            **tables: DataFrame) -> DataFrame:
    """A SQL query over named tables (``{name}`` in the text). Values are bound as
    ``:name`` parameters, never pasted into the text."""
    return spark.sql(text, args=args or {}, **tables)


STATE_REVENUE_SQL = """
SELECT c.customer_state AS state,
       cast(round(sum(m.spent), 0) AS double) AS revenue,
       sum(m.orders) AS orders
FROM (SELECT customer_id, count(DISTINCT order_id) AS orders,
             sum(cast(nanvl(total_amount, NULL) AS decimal(38,9))) AS spent
      FROM {fact}
      WHERE review_score BETWEEN :low AND :high
      GROUP BY customer_id) m
JOIN {customers} c ON m.customer_id = c.customer_id
WHERE :state IS NULL OR c.customer_state = :state
GROUP BY c.customer_state
ORDER BY revenue DESC NULLS LAST, state
LIMIT 15
"""

STATUS_REVENUE_SQL = """
SELECT order_status,
       cast(round(sum(cast(nanvl(total_amount, NULL) AS decimal(38,9))), 0) AS double) AS revenue
FROM {order_summary}
WHERE :status IS NULL OR order_status = :status
GROUP BY order_status
ORDER BY revenue DESC NULLS LAST, order_status
"""
