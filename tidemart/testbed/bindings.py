"""The nine retail source tables expressed over the test tables.

Each binding is one SELECT that both Spark and DuckDB run unchanged; ``{name}`` is
the test table. The same text therefore feeds the queries and their SQL twins.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.clean import clean
from tidemart.operators.skew import hot_slots
from tidemart.plans import gold
from tidemart.plans.refresh import kept
from tidemart.session import scratch_dir
from tidemart.sources.tables import buckets_for
from tidemart.specs import ALL_SPECS, Collapse

RAW = {
    "category_translation": """
        SELECT DISTINCT p_type AS product_category_name,
               concat('EN_', p_type) AS product_category_name_english
        FROM {part} WHERE p_type <> 'SMALL'""",
    "geolocation": """
        SELECT cast(c_nationkey AS string) AS geolocation_zip_code_prefix,
               c_acctbal AS geolocation_lat,
               cast(c_custkey % 180 AS double) AS geolocation_lng,
               c_mktsegment AS geolocation_city,
               concat('S', cast(c_nationkey AS string)) AS geolocation_state,
               c_custkey AS seen_order
        FROM {customer}""",
    "sellers": """
        SELECT s_suppkey AS seller_id, cast(s_nationkey AS string) AS seller_zip_code_prefix,
               concat('  ', lower(s_name), ' ') AS seller_city,
               concat(' ', lower(n_name), ' ') AS seller_state
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "customers": """
        SELECT c_custkey AS customer_id, cast(c_custkey AS string) AS customer_unique_id,
               cast(c_nationkey AS string) AS customer_zip_code_prefix,
               concat('  ', lower(c_name), ' ') AS customer_city,
               concat(' ', lower(n_name), ' ') AS customer_state
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE p_type END AS product_category_name,
               length(p_name) AS product_name_lenght,
               length(p_brand) AS product_description_lenght,
               p_size % 5 AS product_photos_qty,
               cast(p_size AS double) AS product_weight_g,
               p_retailprice AS product_length_cm,
               cast(p_size + 1 AS double) AS product_height_cm,
               cast(p_size + 2 AS double) AS product_width_cm
        FROM {part}""",
    "orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL '1' DAY AS order_approved_at,
               o_orderdate + INTERVAL '2' DAY AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL
                    ELSE o_orderdate + (o_orderkey % 97) * INTERVAL '1' DAY
               END AS order_delivered_customer_date,
               o_orderdate + (30 + o_orderkey % 13) * INTERVAL '1' DAY
                   AS order_estimated_delivery_date
        FROM {orders}""",
    "order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
               l_partkey AS product_id, l_suppkey AS seller_id, l_extendedprice AS price,
               floor((floor(l_extendedprice * 100 + 0.5) * floor(l_tax * 100 + 0.5) + 50) / 100)
                   / 100 AS freight_value,
               l_shipdate AS shipped_at
        FROM {lineitem}""",
    "order_payments": """
        SELECT cast(floor(event_id / 2) AS bigint) AS order_id,
               cast(event_id % 2 + 1 AS int) AS payment_sequential,
               CASE WHEN event_type = 'error' THEN 'not_defined' ELSE event_type END
                   AS payment_type,
               cast(1 + event_id % 12 AS int) AS payment_installments,
               value AS payment_value
        FROM {events} WHERE event_type IN ('purchase', 'click', 'error')""",
    "order_reviews": """
        SELECT event_id AS review_id, cast(floor(event_id / 2) AS bigint) AS order_id,
               cast(1 + (event_id * 7) % 5 AS int) AS review_score,
               cast(NULL AS string) AS review_comment_title,
               props AS review_comment_message,
               ts AS review_creation_date,
               ts + INTERVAL '1' DAY AS review_answer_timestamp
        FROM {events} WHERE event_type IN ('view', 'signup')""",
    # open orders move on, and each urgent order is placed once more under a new key
    "live_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'L' AS order_status,
               o_orderdate + INTERVAL '400' DAY AS order_purchase_timestamp
        FROM {orders} WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT -1 - o_orderkey AS order_id, o_custkey AS customer_id, 'N' AS order_status,
               o_orderdate - INTERVAL '400' DAY AS order_purchase_timestamp
        FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    # lines are repriced and added, payments refunded, reviews changed to a later answer
    "live_order_items": """
        SELECT DISTINCT l_orderkey AS order_id, cast(2 AS int) AS order_item_id,
               cast(1 AS bigint) AS product_id, cast(1 AS bigint) AS seller_id,
               cast(9.5 AS double) AS price, cast(0.5 AS double) AS freight_value
        FROM {lineitem} WHERE l_linenumber = 2 AND l_orderkey % 7 = 0
        UNION ALL
        SELECT o_orderkey, cast(50 AS int), o_orderkey % 90, o_orderkey % 9,
               cast(20.25 AS double), cast(0.25 AS double)
        FROM {orders} WHERE o_orderkey % 50 = 0""",
    "live_order_payments": """
        SELECT cast(floor(event_id / 2) AS bigint) AS order_id,
               cast(event_id % 2 + 1 AS int) AS payment_sequential, 'refund' AS payment_type,
               cast(1 AS int) AS payment_installments, cast(5.25 AS double) AS payment_value
        FROM {events} WHERE event_type IN ('purchase', 'click', 'error') AND event_id % 9 = 0""",
    "live_order_reviews": """
        SELECT event_id AS review_id, cast(floor(event_id / 2) AS bigint) AS order_id,
               cast(1 AS int) AS review_score, 'later' AS review_comment_title,
               'it broke' AS review_comment_message,
               date_trunc('second', ts) AS review_creation_date,
               date_trunc('second', ts) + INTERVAL '400' DAY AS review_answer_timestamp
        FROM {events} WHERE event_type IN ('view', 'signup') AND event_id % 9 = 1""",
    "state_regions": """
        SELECT upper(n_name) AS state, r_name AS region
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
}

# Declared, so that opening a table runs no job to read a footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}
TABLES = tuple(SCHEMAS)

# The specs with the column that orders versions in the test data.
SPECS = ALL_SPECS | {
    "order_items": replace(ALL_SPECS["order_items"], version="shipped_at"),
    "geolocation": replace(ALL_SPECS["geolocation"], collapse=Collapse(
        ALL_SPECS["geolocation"].collapse.keys, ALL_SPECS["geolocation"].collapse.aggs,
        tie_breakers=("seen_order",))),
}


class Retail:
    """Raw, curated and star-schema tables over one test-data folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        text = RAW[name]
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def buckets(self, least: int = 4) -> int:
        """Buckets of a lake over these tables. Counts come from the footers of the files."""
        return buckets_for(max(self.table(t).count() for t in ("orders", "lineitem", "events")),
                           least)

    def silver(self, name: str) -> DataFrame:
        spec = SPECS[name]
        lookup = self.silver(spec.lookup.table) if spec.lookup else None
        return clean(self.raw(name), spec, lookup)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_order_items(
            self.silver("orders"), self.silver("order_items"), self.silver("order_payments"),
            self.silver("order_reviews"), hot_slots(self.raw("order_items"), ["order_id"]))

    def with_stored_fact(self) -> Retail:
        """The same tables with the fact written once and read back, for several results."""
        stored = Retail(self.spark, self.sf_dir)
        stored.fact = kept(self.fact, scratch_dir(self.spark, "fact"))
        return stored

    @property
    def customers(self) -> DataFrame:
        return self.silver("customers")

    @cached_property
    def order_summary(self) -> DataFrame:
        return gold.order_summary(self.fact)

    @cached_property
    def customer_metrics(self) -> DataFrame:
        return gold.customer_metrics(self.fact)

    @cached_property
    def seller_performance(self) -> DataFrame:
        return gold.seller_performance(self.fact)

    @cached_property
    def product_performance(self) -> DataFrame:
        return gold.product_performance(self.fact)
