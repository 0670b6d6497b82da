"""SQL twins of the queries, for an independent engine.

Rounding is done in whole numbers so that both engines agree on ties: money in millionths,
review scores in halves (an order has at most two reviews in the test data).
"""

from __future__ import annotations

import re

from tidemart.testbed.bindings import RAW, TABLES


def cents(x: str) -> str:
    return f"cast(round(({x}) * 100) AS bigint)"


def millionths(x: str) -> str:
    return f"cast(round(({x}) * 1000000) AS hugeint)"


def half_up(num: str, den: str, digits: int) -> str:
    """round(num / den, digits) for non-negative whole numbers, as double."""
    scale = 10 ** digits
    return (f"cast((2 * {scale} * ({num}) + ({den})) // (2 * nullif({den}, 0)) AS double)"
            f" / {scale}.0")


def money(x: str, digits: int = 2) -> str:
    """Sum of amounts, half-up rounded."""
    return half_up(f"sum({millionths(x)})", "1000000", digits)


def money_mean(x: str, digits: int = 2) -> str:
    return half_up(f"sum({millionths(x)})", f"1000000 * count({x})", digits)


def score_mean(x: str, digits: int) -> str:
    return half_up(f"sum(cast(2 * {x} AS bigint))", f"2 * count({x})", digits)


def int_mean(x: str, digits: int) -> str:
    return half_up(f"sum({x})", f"count({x})", digits)


def percent(num: str, den: str, digits: int = 1) -> str:
    return half_up(f"100 * ({num})", den, digits)


CTES = {f"raw_{name}": text.format(**{t: t for t in TABLES}) for name, text in RAW.items()}
CTES |= {
    "s_customers": """
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
               upper(left(trim(customer_city), 1)) || lower(substr(trim(customer_city), 2))
                   AS customer_city,
               upper(trim(customer_state)) AS customer_state
        FROM raw_customers""",
    "s_sellers": """
        SELECT seller_id, seller_zip_code_prefix,
               upper(left(trim(seller_city), 1)) || lower(substr(trim(seller_city), 2))
                   AS seller_city,
               upper(trim(seller_state)) AS seller_state
        FROM raw_sellers""",
    "s_geolocation": """
        SELECT geolocation_zip_code_prefix,
               cast(sum(cast(geolocation_lat AS decimal(18,2))) AS double)
                   / count(geolocation_lat) AS geolocation_lat,
               sum(geolocation_lng) / count(geolocation_lng) AS geolocation_lng,
               arg_min(geolocation_city, seen_order) AS geolocation_city,
               arg_min(geolocation_state, seen_order) AS geolocation_state
        FROM raw_geolocation GROUP BY 1""",
    "s_products": """
        SELECT p.product_category_name, product_id,
               cast(product_name_lenght AS int) AS product_name_length,
               cast(product_description_lenght AS int) AS product_description_length,
               product_photos_qty, product_weight_g, product_length_cm, product_height_cm,
               product_width_cm,
               coalesce(t.product_category_name_english, 'unknown')
                   AS product_category_name_english
        FROM (SELECT * REPLACE (coalesce(product_category_name, 'unknown')
                                AS product_category_name) FROM raw_products) p
        LEFT JOIN raw_category_translation t
               ON p.product_category_name = t.product_category_name""",
    "s_orders": "SELECT * FROM raw_orders",
    "s_items": """
        SELECT order_id, order_item_id, product_id, seller_id, price, freight_value, shipped_at
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY order_id, order_item_id
                  ORDER BY shipped_at DESC NULLS LAST, product_id, seller_id, price,
                           freight_value) AS rn
              FROM raw_order_items) WHERE rn = 1""",
    "s_payments": """
        SELECT order_id, payment_sequential,
               CASE WHEN payment_type = 'not_defined' THEN 'unknown' ELSE payment_type END
                   AS payment_type,
               payment_installments, payment_value
        FROM raw_order_payments""",
    "s_reviews": """
        SELECT review_id, order_id, review_score,
               coalesce(review_comment_title, '') AS review_comment_title,
               coalesce(review_comment_message, '') AS review_comment_message,
               review_creation_date, review_answer_timestamp
        FROM raw_order_reviews""",
    "pay": f"""
        SELECT order_id, {money('payment_value')} AS payment_value,
               max(payment_type) AS payment_type,
               avg(payment_installments) AS avg_installments
        FROM s_payments GROUP BY 1""",
    "rev": "SELECT order_id, avg(review_score) AS review_score FROM s_reviews GROUP BY 1",
    "fact": """
        SELECT i.order_id, i.order_item_id, o.customer_id, i.product_id, i.seller_id,
               i.price, i.freight_value, i.price + i.freight_value AS total_amount,
               pay.payment_value, pay.payment_type, pay.avg_installments, o.order_status,
               o.order_purchase_timestamp AS purchase_timestamp,
               o.order_delivered_customer_date AS delivered_date,
               o.order_estimated_delivery_date,
               coalesce(rev.review_score, 0.0) AS review_score,
               cast(date_diff('day', o.order_purchase_timestamp,
                              o.order_delivered_customer_date) AS int) AS delivery_days,
               CASE WHEN o.order_delivered_customer_date IS NULL THEN NULL
                    WHEN o.order_delivered_customer_date > o.order_estimated_delivery_date
                    THEN 1 ELSE 0 END AS delay_flag,
               CASE WHEN o.order_delivered_customer_date IS NULL THEN NULL
                    WHEN o.order_delivered_customer_date <= o.order_estimated_delivery_date
                    THEN 1 ELSE 0 END AS on_time_flag
        FROM s_items i JOIN s_orders o ON i.order_id = o.order_id
        LEFT JOIN pay ON i.order_id = pay.order_id
        LEFT JOIN rev ON i.order_id = rev.order_id""",
    "dim_sellers": """
        SELECT seller_id, seller_city, seller_state, seller_zip_code_prefix,
               geolocation_lat AS seller_lat, geolocation_lng AS seller_lng
        FROM s_sellers LEFT JOIN s_geolocation
             ON seller_zip_code_prefix = geolocation_zip_code_prefix""",
    "summary": f"""
        SELECT order_id, count(order_item_id) AS total_items,
               {money('price')} AS total_price, {money('freight_value')} AS total_freight,
               {money('total_amount')} AS total_amount, max(order_status) AS order_status,
               min(purchase_timestamp) AS purchase_date, max(delivered_date) AS delivered_date,
               cast({int_mean('delivery_days', 0)} AS int) AS delivery_days
        FROM fact GROUP BY 1""",
    "cust": f"""
        SELECT customer_id, count(DISTINCT order_id) AS total_orders,
               {money('total_amount')} AS total_spent,
               {money_mean('total_amount')} AS avg_order_value,
               max(purchase_timestamp) AS last_order_date,
               {score_mean('review_score', 1)} AS avg_review_score
        FROM fact GROUP BY 1""",
    "sell": f"""
        SELECT seller_id, count(DISTINCT order_id) AS total_orders,
               {money('price')} AS total_revenue,
               {score_mean('review_score', 2)} AS avg_review_score,
               {percent('sum(on_time_flag)', 'count(on_time_flag)')} AS on_time_delivery_rate,
               {int_mean('delivery_days', 1)} AS avg_delivery_days
        FROM fact GROUP BY 1""",
    "prod": f"""
        SELECT product_id, count(*) AS total_quantity, {money('price')} AS total_sales,
               {money_mean('price')} AS avg_price,
               {score_mean('review_score', 2)} AS avg_review_score
        FROM fact GROUP BY 1""",
    "topspend": """
        SELECT * FROM cust WHERE total_spent > 0
        ORDER BY total_spent DESC, customer_id LIMIT 5000""",
    "topsell": f"""
        SELECT seller_id, left(cast(seller_id AS string), 8) || '...' AS seller, total_orders,
               {half_up(cents('total_revenue'), '100', 0)} AS revenue,
               avg_review_score AS review, on_time_delivery_rate AS on_time,
               avg_delivery_days AS avg_days
        FROM sell WHERE total_orders >= 5
        ORDER BY revenue DESC NULLS LAST, seller_id LIMIT 200""",
    "statebase": f"""
        SELECT c.customer_state AS state, {percent('sum(on_time_flag)', 'count(on_time_flag)')}
                   AS on_time_rate,
               count(DISTINCT order_id) AS orders, {int_mean('delivery_days', 1)} AS avg_days
        FROM fact f JOIN s_customers c ON f.customer_id = c.customer_id
        WHERE on_time_flag IS NOT NULL AND review_score BETWEEN 1 AND 5
        GROUP BY 1 HAVING count(*) > 50
        ORDER BY on_time_rate DESC NULLS LAST, state LIMIT 20""",
    "categories": f"""
        SELECT coalesce(d.product_category_name_english, 'Unknown') AS category,
               {money('total_sales', 0)} AS total_sales,
               cast(sum(total_quantity) AS bigint) AS total_qty,
               {money_mean('avg_price', 0)} AS avg_price,
               {half_up(f"sum({cents('avg_review_score')})", "100 * count(avg_review_score)", 2)}
                   AS avg_review
        FROM prod p JOIN s_products d ON p.product_id = d.product_id
        GROUP BY 1 ORDER BY total_sales DESC NULLS LAST, category LIMIT 20""",
    # the stored pipeline reads ids from CSV as text, so its last tie-breakers are texts
    "text_items": """
        SELECT order_id, order_item_id, product_id, seller_id, price, freight_value, shipped_at
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY order_id, order_item_id
                  ORDER BY shipped_at DESC NULLS LAST, cast(product_id AS string),
                           cast(seller_id AS string), price, freight_value) AS rn
              FROM raw_order_items) WHERE rn = 1""",
    "batches": """
        SELECT 'batch_' || cast(1 + order_id % 4 AS string) AS batch_id, * FROM raw_orders""",
    # one row per customer and month, for the cohorts
    "order_level": f"""
        SELECT o.order_id, o.customer_id,
               date_trunc('month', o.order_purchase_timestamp) AS month,
               l.spent, {cents('pay.payment_value')} AS paid, rev.review_score
        FROM s_orders o
        LEFT JOIN (SELECT order_id, sum({millionths('price + freight_value')}) AS spent
                   FROM s_items GROUP BY 1) l ON o.order_id = l.order_id
        LEFT JOIN pay ON o.order_id = pay.order_id
        LEFT JOIN rev ON o.order_id = rev.order_id""",
    "cohort_rows": """
        SELECT o.*, c.cohort, date_diff('month', c.cohort, o.month) AS month_offset
        FROM order_level o JOIN (SELECT customer_id, min(month) AS cohort
                                 FROM order_level GROUP BY 1) c
             ON o.customer_id = c.customer_id""",
}


CTES["text_fact"] = CTES["fact"].replace("s_items", "text_items")

# the tables after the live feed, and the fact made from them
CTES |= {
    "l_orders": """
        SELECT * FROM s_orders WHERE order_id NOT IN (SELECT order_id FROM raw_live_orders)
        UNION ALL BY NAME SELECT * FROM raw_live_orders""",
    "l_items": """
        SELECT * EXCLUDE (shipped_at) FROM text_items
        WHERE (order_id, order_item_id) NOT IN (
            SELECT (order_id, order_item_id) FROM raw_live_order_items)
        UNION ALL BY NAME SELECT * FROM raw_live_order_items""",
    "l_items_numbers": """
        SELECT * EXCLUDE (shipped_at) FROM s_items
        WHERE (order_id, order_item_id) NOT IN (
            SELECT (order_id, order_item_id) FROM raw_live_order_items)
        UNION ALL BY NAME SELECT * FROM raw_live_order_items""",
    "l_payments": """
        SELECT * FROM s_payments WHERE (order_id, payment_sequential) NOT IN (
            SELECT (order_id, payment_sequential) FROM raw_live_order_payments)
        UNION ALL BY NAME SELECT * FROM raw_live_order_payments""",
    "l_reviews": """
        SELECT * FROM s_reviews WHERE review_id NOT IN (
            SELECT review_id FROM raw_live_order_reviews)
        UNION ALL BY NAME SELECT * FROM raw_live_order_reviews""",
    "l_pay": CTES["pay"].replace("s_payments", "l_payments"),
    "l_rev": CTES["rev"].replace("s_reviews", "l_reviews"),
    "l_fact": CTES["fact"].replace("s_items", "l_items").replace("s_orders", "l_orders")
    .replace("JOIN pay", "JOIN l_pay pay").replace("JOIN rev", "JOIN l_rev rev"),
    # the published customers of the dashboard: a state with a quote in its name
    "w_customers": """
        SELECT * REPLACE (CASE WHEN customer_state = 'NATION_3' THEN 'D''OESTE'
                               ELSE customer_state END AS customer_state) FROM s_customers""",
}


def compose(body: str) -> str:
    """``body`` preceded by the CTEs it needs, directly or indirectly."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\w+", text)) & CTES.keys() - needed:
            needed.add(name)
            visit(CTES[name])

    visit(body)
    ctes = ", ".join(f"{n} AS ({CTES[n].strip()})" for n in CTES if n in needed)
    return f"WITH {ctes} {body.strip()}" if ctes else body.strip()
