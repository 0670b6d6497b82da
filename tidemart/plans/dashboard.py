"""The dashboard's questions as SQL table functions with parameters.

``install`` creates one function per question in the database that holds the nine published
tables. After ``USE`` of it callers select from them, ``SELECT * FROM revenue_by_state('SP', 1,
5)``: values are arguments, never text pasted into a query. NULL as a state or status asks for all.
Questions by state fold the fact to one row per customer before the join, as in ``kpi``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.plans.kpi import TOP_SPENDERS

_MONEY = "cast(nanvl({0}, NULL) AS decimal(38,9))"
_POINTS = "try_cast({0} AS decimal(28,12))"


def _sum(column: str) -> str:
    return f"sum({_MONEY.format(column)})"


def _rounded(total: str, digits: int = 0) -> str:
    return f"cast(round({total}, {digits}) AS double)"


def _ratio(num: str, den: str, digits: int) -> str:
    return (f"round(round(cast({num} AS double) / nullif(cast({den} AS double), 0), 9), "
            f"{digits})")


#: Lines of the asked review scores, folded to one row per customer.
_PER_CUSTOMER = f"""
    SELECT customer_id, count(DISTINCT order_id) AS orders, count(*) AS n,
           {_sum('total_amount')} AS spent, count(total_amount) AS spent_n,
           sum(delivery_days) AS days, count(delivery_days) AS days_n,
           sum(on_time_flag) AS on_time, count(on_time_flag) AS on_time_n,
           sum(CASE WHEN delay_flag = 1 THEN 1 ELSE 0 END) AS late,
           sum({_POINTS.format('review_score')}) AS score, count(review_score) AS score_n
    FROM {{db}}.fact_order_items
    WHERE review_score BETWEEN {{fn}}.low AND {{fn}}.high {{more}}
    GROUP BY customer_id"""
_BY_STATE = (f"({_PER_CUSTOMER}) m JOIN {{db}}.dim_customers c ON m.customer_id = c.customer_id "
             "WHERE {fn}.state IS NULL OR c.customer_state = {fn}.state")
_STATE = "state STRING DEFAULT NULL"
_SCORES = "low INT DEFAULT 1, high INT DEFAULT 5"

#: name: parameters, columns, query. ``{db}`` is the database, ``{fn}`` the function.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "order_statuses": ("", "order_status STRING", """
        SELECT DISTINCT order_status FROM {db}.order_summary
        WHERE order_status IS NOT NULL ORDER BY order_status"""),
    "customer_states": ("", "customer_state STRING", """
        SELECT DISTINCT customer_state FROM {db}.dim_customers
        WHERE customer_state IS NOT NULL
          AND customer_id IN (SELECT customer_id FROM {db}.fact_order_items)
        ORDER BY customer_state"""),
    "overview": (
        f"{_STATE}, {_SCORES}",
        "total_revenue DOUBLE, total_orders BIGINT, avg_delivery_days DOUBLE, on_time_pct DOUBLE, "
        "unique_customers BIGINT, avg_review DOUBLE, delay_pct DOUBLE, avg_order_value DOUBLE", f"""
        SELECT {_rounded('sum(spent)')}, coalesce(sum(orders), 0),
               {_ratio('sum(days)', 'sum(days_n)', 1)},
               {_ratio('sum(on_time) * 100', 'sum(on_time_n)', 1)}, count(*),
               {_ratio('sum(score)', 'sum(score_n)', 2)},
               {_ratio('sum(late) * 100', 'sum(n)', 1)},
               {_rounded('sum(spent) / nullif(sum(spent_n), 0)', 2)}
        FROM {_BY_STATE}"""),
    "revenue_by_state": (
        f"{_STATE}, {_SCORES}", "state STRING, revenue DOUBLE, orders BIGINT", f"""
        SELECT customer_state, {_rounded('sum(spent)')} AS revenue, sum(orders)
        FROM {_BY_STATE} GROUP BY customer_state
        ORDER BY revenue DESC NULLS LAST, customer_state LIMIT 15"""),
    "revenue_by_status": (
        "status STRING DEFAULT NULL", "order_status STRING, revenue DOUBLE", f"""
        SELECT order_status, {_rounded(_sum('total_amount'))} AS revenue
        FROM {{db}}.order_summary
        WHERE {{fn}}.status IS NULL OR order_status = {{fn}}.status
        GROUP BY order_status ORDER BY revenue DESC NULLS LAST, order_status"""),
    "monthly_revenue": (
        "", "month TIMESTAMP, orders BIGINT, revenue DOUBLE", f"""
        SELECT date_trunc('month', purchase_timestamp) AS month, count(DISTINCT order_id),
               {_rounded(_sum('total_amount'))}
        FROM {{db}}.fact_order_items WHERE purchase_timestamp IS NOT NULL
        GROUP BY date_trunc('month', purchase_timestamp) ORDER BY month LIMIT 24"""),
    "delivery_histogram": (
        f"max_days INT DEFAULT 60, {_SCORES}", "delivery_days INT, orders BIGINT, delay_flag INT", """
        SELECT delivery_days, count(*), delay_flag FROM {db}.fact_order_items
        WHERE delivery_days BETWEEN 0 AND {fn}.max_days AND delay_flag IS NOT NULL
          AND review_score BETWEEN {fn}.low AND {fn}.high
        GROUP BY delivery_days, delay_flag ORDER BY delivery_days, delay_flag"""),
    "on_time_by_state": (
        f"{_STATE}, {_SCORES}, more_than INT DEFAULT 50",
        "state STRING, on_time_rate DOUBLE, orders BIGINT, avg_days DOUBLE", f"""
        SELECT customer_state, {_ratio('sum(on_time) * 100', 'sum(on_time_n)', 1)} AS rate,
               sum(orders), {_ratio('sum(days)', 'sum(days_n)', 1)}
        FROM {_BY_STATE.replace('{more}', 'AND on_time_flag IS NOT NULL')}
        GROUP BY customer_state HAVING sum(n) > any_value({{fn}}.more_than)
        ORDER BY rate DESC NULLS LAST, customer_state LIMIT 20"""),
    "delay_by_score": (
        "", "score INT, delay_flag INT, cnt BIGINT", """
        SELECT cast(round(review_score, 0) AS INT) AS score, delay_flag, count(*)
        FROM {db}.fact_order_items
        WHERE review_score > 0 AND delay_flag IS NOT NULL AND delivery_days IS NOT NULL
        GROUP BY cast(round(review_score, 0) AS INT), delay_flag ORDER BY score, delay_flag"""),
    "customer_values": (
        "", "customer_id STRING, total_spent DOUBLE, total_orders INT, avg_review_score DOUBLE", f"""
        SELECT customer_id, total_spent, total_orders, avg_review_score
        FROM {{db}}.customer_metrics WHERE total_spent > 0
        ORDER BY total_spent DESC, customer_id LIMIT {TOP_SPENDERS}"""),
    "top_customers": (
        "", "customer STRING, total_orders INT, total_spent DOUBLE, avg_order DOUBLE, "
        "review DOUBLE", """
        SELECT left(customer_id, 8) || '...', total_orders, round(total_spent, 0),
               round(avg_order_value, 0), round(avg_review_score, 1)
        FROM {db}.customer_metrics
        ORDER BY total_spent DESC NULLS LAST, customer_id LIMIT 10"""),
    "state_revenue": ("", "state STRING, revenue DOUBLE", f"""
        SELECT c.customer_state, {_rounded('sum(m.spent)')} AS revenue
        FROM (SELECT customer_id, {_sum('total_amount')} AS spent
              FROM {{db}}.fact_order_items GROUP BY customer_id) m
        JOIN {{db}}.dim_customers c ON m.customer_id = c.customer_id
        GROUP BY c.customer_state ORDER BY revenue DESC NULLS LAST, c.customer_state"""),
    "top_sellers": (
        "min_orders INT DEFAULT 5", "seller STRING, total_orders INT, revenue DOUBLE, "
        "review DOUBLE, on_time DOUBLE, avg_days DOUBLE", """
        SELECT left(seller_id, 8) || '...', total_orders, round(total_revenue, 0) AS revenue,
               round(avg_review_score, 2), round(on_time_delivery_rate, 1),
               round(avg_delivery_days, 1)
        FROM {db}.seller_performance WHERE total_orders >= {fn}.min_orders
        ORDER BY revenue DESC NULLS LAST, seller_id LIMIT 200"""),
    "category_sales": (
        "", "category STRING, total_sales DOUBLE, total_qty BIGINT, avg_price DOUBLE, "
        "avg_review DOUBLE", f"""
        SELECT coalesce(p.product_category_name_english, 'Unknown') AS category,
               {_rounded(_sum('pp.total_sales'))} AS total_sales, sum(pp.total_quantity),
               {_rounded(f"{_sum('pp.avg_price')} / nullif(count(pp.avg_price), 0)")},
               {_ratio(f"sum({_POINTS.format('pp.avg_review_score')})",
                       'count(pp.avg_review_score)', 2)}
        FROM {{db}}.product_performance pp JOIN {{db}}.dim_products p
          ON pp.product_id = p.product_id
        GROUP BY coalesce(p.product_category_name_english, 'Unknown')
        ORDER BY total_sales DESC NULLS LAST, category LIMIT 20"""),
    "product_prices": (
        "", "category STRING, avg_price DOUBLE, avg_review_score DOUBLE, total_sales DOUBLE", """
        SELECT coalesce(p.product_category_name_english, 'Other'), pp.avg_price,
               pp.avg_review_score, pp.total_sales
        FROM {db}.product_performance pp JOIN {db}.dim_products p
          ON pp.product_id = p.product_id
        WHERE pp.total_quantity >= 3 AND pp.avg_price > 0 ORDER BY pp.product_id LIMIT 2000"""),
}


def install(spark: SparkSession, database: str) -> None:
    """Create or replace all functions over the published tables of a database."""
    for name, (parameters, columns, text) in FUNCTIONS.items():
        body = text.replace("{more}", "").replace("{db}", database).replace("{fn}", name)
        spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}({parameters}) "
                  f"RETURNS TABLE ({columns}) RETURN {body}")


def ask(spark: SparkSession, database: str, name: str, **values) -> DataFrame:
    """The answer of one function; values are bound as named arguments."""
    if name not in FUNCTIONS:
        raise ValueError(f"unknown question {name!r}")
    given = ", ".join(f"{v} => :{v}" for v in values)
    # Spark looks table functions up in the current database only
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        return spark.sql(f"SELECT * FROM {name}({given})", args=values)
    finally:
        spark.catalog.setCurrentDatabase(before)
