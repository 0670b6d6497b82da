"""Every query by name: the Spark side over ``Retail`` and, where one exists, its SQL
twin. Both sides run over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.numbers import amount, exact
from tidemart.functions.rules import apply_rules
from tidemart.functions.text import mask_id
from tidemart.operators.clean import clean, clean_live
from tidemart.operators.counting import counted, rows_seen
from tidemart.operators.dedup import latest_per_key
from tidemart.plans import cohorts, dashboard, gold, kpi, months
from tidemart.plans.refresh import ROLLUPS, changed_orders, refresh_gold
from tidemart.plans.stages import (
    BATCHES, Lake, StageResult, build_gold, raise_first, run_bronze, run_silver, side_by_side,
)
from tidemart.session import scratch_dir
from tidemart.sources import csv
from tidemart.sources.bronze import LIVE_BATCH, read_batch, write_batch
from tidemart.sources.ledger import Ledger
from tidemart.sources.publish import (
    name_in_catalog, publish, published, quarantined, row_counts,
)
from tidemart.sources.tables import StoredTable, database_at, read_first
from tidemart.specs import (
    CONTRACT_DDL, REFERENCE_SPECS, TRANSACTIONAL_SPECS, Rule, contract,
)
from tidemart.streaming.live import live_counts, run_live
from tidemart.testbed.bindings import SPECS, Retail
from tidemart.testbed.oracle import CTES, compose, half_up, money, money_mean, percent, score_mean
from tidemart.testbed.oracle import cents as cents_sql
from tidemart.testbed.oracle import int_mean, millionths


@dataclass(frozen=True)
class Query:
    run: Callable[[Retail], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(run: Callable[[Retail], DataFrame]):
        QUERIES[name] = Query(run, compose(sql) if sql else None)
        return run
    return add


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, so a result does not depend on the client's zone."""
    return df.select(*(
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
        for f in df.schema.fields))


def stored_table(r: Retail, label: str, **layout) -> StoredTable:
    """A table of its own, in a new folder and database."""
    root = scratch_dir(r.spark, label)
    return StoredTable(r.spark, f"{database_at(r.spark, root)}.{label}", f"{root}/rows", **layout)


# ---------------------------------------------------------------- sources

ORDER_COLUMNS = ("order_id, customer_id, order_status, order_purchase_timestamp, "
                 "order_approved_at, order_delivered_carrier_date, "
                 "order_delivered_customer_date, order_estimated_delivery_date")
SHORT = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]
SHORT_SQL = "order_id, customer_id, order_status, order_purchase_timestamp"


def digest_of(text: str) -> str:
    """Sum over all rows of a number made from a text, in both dialects."""
    return (f"cast(sum(cast(ascii(substr(md5({text}), 1, 1)) AS bigint) * 1000003 + "
            f"ascii(substr(md5({text}), 9, 1)) * 10007 + ascii(substr(md5({text}), 17, 1))) "
            "AS bigint)")


def typed_ids(df: DataFrame) -> DataFrame:
    """Text keys of a CSV back to the numbers the test tables use."""
    ids = [c for c in ("order_id", "customer_id", "product_id", "seller_id", "review_id")
           if c in df.columns]
    return df.withColumns({c: F.col(c).cast("bigint") for c in ids})


def with_batch(df: DataFrame) -> DataFrame:
    return df.withColumn("batch_id", F.concat(F.lit("batch_"), (F.col("order_id") % 4 + 1)
                                              .cast("string")))


def to_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("compression", "gzip").csv(path)
    return path


def export_batches(r: Retail, raw: str, names=tuple(SPECS)) -> None:
    """The source files of all batches, as the pipeline expects them."""
    jobs = {}
    for name in names:
        spec = SPECS[name]
        if name in REFERENCE_SPECS:
            jobs[name] = partial(to_csv, r.raw(name), csv.batch_path(raw, 1, spec))
            continue
        rows = with_batch(r.raw(name))
        for n in BATCHES:
            part = rows.where(F.col("batch_id") == f"batch_{n}").drop("batch_id")
            jobs[f"{name}_{n}"] = partial(to_csv, part, csv.batch_path(raw, n, spec))
    exported = StageResult()
    side_by_side(jobs, exported, workers=8)
    raise_first(exported)


def live_frame(r: Retail, name: str = "live_orders") -> DataFrame:
    """Live rows with all columns of an orders file."""
    rows = r.raw(name)
    return rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
                         for c in SPECS["orders"].columns))


@query("scan_csv", f"SELECT {ORDER_COLUMNS} FROM raw_orders")
def _(r):
    path = to_csv(r.raw("orders"), f"{scratch_dir(r.spark, 'scan')}/orders.csv")
    return typed_ids(clean(csv.scan_csv(r.spark, path, SPECS["orders"]), SPECS["orders"]))


@query("scan_batch_csv", f"SELECT batch_id, {ORDER_COLUMNS} FROM batches")
def _(r):
    raw, spec = scratch_dir(r.spark, "batches"), SPECS["orders"]
    export_batches(r, raw, ("orders",))
    parts = [csv.scan_csv(r.spark, csv.batch_path(raw, n, spec), spec)
             .withColumn("batch_id", F.lit(f"batch_{n}")) for n in BATCHES]
    return typed_ids(apply_rules(reduce(DataFrame.unionByName, parts), spec.rules))


@query("scan_live_glob", f"SELECT {SHORT_SQL} FROM raw_live_orders")
def _(r):
    live, spec = scratch_dir(r.spark, "live"), SPECS["orders"]
    rows = live_frame(r)
    to_csv(rows.where("order_status = 'L'"), f"{live}/20260101_000000_{spec.source_file}")
    to_csv(rows.where("order_status = 'N'"), f"{live}/20260101_001000_{spec.source_file}")
    to_csv(r.raw("order_payments"), f"{live}/20260101_000000_order_payments_dataset.csv")
    scan = csv.scan_declared(r.spark, csv.live_glob(live, spec), spec)
    return typed_ids(apply_rules(scan, spec.rules)).select(*SHORT)


@query("scan_partition_pruned", f"SELECT batch_id, {SHORT_SQL} FROM batches")
def _(r):
    path = f"{scratch_dir(r.spark, 'bronze')}/orders"
    write_batch(with_batch(r.raw("orders")).withColumn("load_id", F.lit("0")), path)
    parts = [read_batch(r.spark, path, f"batch_{n}").select("batch_id", *SHORT) for n in BATCHES]
    return reduce(DataFrame.unionByName, parts)


@query("scan_with_fallback", "SELECT * FROM raw_category_translation")
def _(r):
    bronze = stored_table(r, "bronze")
    bronze.overwrite(csv.with_audit(r.raw("category_translation"), "batch_1", source_file="f"))
    missing = stored_table(r, "silver")
    return clean(read_first(missing, bronze), SPECS["category_translation"])


# ---------------------------------------------------------------- sinks

@query("sink_overwrite", f"SELECT {ORDER_COLUMNS} FROM raw_orders")
def _(r):
    table = stored_table(r, "overwrite")
    table.overwrite(r.raw("order_payments"))
    table.overwrite(r.raw("orders"))
    return table.read()


BRONZE_COUNTS_SQL = """
    SELECT batch_id, count(*) AS n, cast(sum(customer_id) AS bigint) AS customers
    FROM batches GROUP BY 1"""


def bronze_counts(r: Retail, path: str) -> DataFrame:
    return r.spark.read.parquet(path).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("customer_id").alias("customers"))


@query("sink_partitioned", BRONZE_COUNTS_SQL)
def _(r):
    path = f"{scratch_dir(r.spark, 'bronze')}/orders"
    write_batch(with_batch(r.raw("orders")).withColumn("load_id", F.lit("0")), path)
    return bronze_counts(r, path)


@query("sink_batch_idempotent", BRONZE_COUNTS_SQL)
def _(r):
    path = f"{scratch_dir(r.spark, 'bronze')}/orders"
    rows = with_batch(r.raw("orders")).withColumn("load_id", F.lit("0"))
    for n in (*BATCHES, "2", "4"):
        write_batch(rows.where(F.col("batch_id") == f"batch_{n}"), path)
    return bronze_counts(r, path)


LIVE_SQL = """
    SELECT order_id, customer_id, order_status, order_purchase_timestamp,
           cast(NULL AS timestamp) AS order_approved_at,
           cast(NULL AS timestamp) AS order_delivered_carrier_date,
           cast(NULL AS timestamp) AS order_delivered_customer_date,
           cast(NULL AS timestamp) AS order_estimated_delivery_date
    FROM raw_live_orders"""
UPSERT_SQL = f"""
    SELECT {ORDER_COLUMNS} FROM raw_orders
    WHERE order_id NOT IN (SELECT order_id FROM raw_live_orders)
    UNION ALL {LIVE_SQL}"""


def live_orders(r: Retail) -> DataFrame:
    """Live rows with the columns and types of the stored orders."""
    rows, whole = r.raw("live_orders"), r.raw("orders")
    return rows.select(*(F.col(f.name) if f.name in rows.columns
                         else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in whole.schema.fields))


def orders_table(r: Retail, label: str, filled: bool = True) -> StoredTable:
    """Orders partitioned by purchase month."""
    table = stored_table(r, label, keys=["order_id"], buckets=0,
                         month="order_purchase_timestamp")
    if filled:
        table.overwrite(r.raw("orders"))
    return table


@query("upsert_orders", UPSERT_SQL)
def _(r):
    table = orders_table(r, "upsert")
    table.upsert(live_orders(r))
    return table.read()


@query("upsert_create", LIVE_SQL)
def _(r):
    table = orders_table(r, "create", filled=False)
    table.upsert(live_orders(r))
    return table.read()


@query("upsert_compound_key", """
    SELECT order_id, order_item_id, product_id, seller_id, price,
           CASE WHEN freight_value = 0 THEN 1.0 ELSE freight_value END AS freight_value, shipped_at
    FROM s_items
    UNION ALL
    SELECT order_id, 100 + order_item_id, product_id, seller_id, price, freight_value, shipped_at
    FROM s_items WHERE order_item_id = 1""")
def _(r):
    table = stored_table(r, "compound", keys=["order_id", "order_item_id"],
                         buckets=r.buckets(8))
    table.overwrite(r.silver("order_items"))
    stored = table.read()
    repriced = stored.where("freight_value = 0").withColumn("freight_value", F.lit(1.0))
    added = stored.where("order_item_id = 1").withColumn(
        "order_item_id", F.col("order_item_id") + 100)
    table.upsert(repriced.unionByName(added))
    return table.read()


@query("upsert_versioned", f"""
    SELECT {ORDER_COLUMNS} FROM raw_orders WHERE order_status <> 'P'
    UNION ALL {LIVE_SQL} WHERE order_status = 'L'""")
def _(r):
    """Open orders get a newer row, which wins; filled orders an older one, which is
    ignored. Both arrive in the same feed."""
    table = orders_table(r, "versioned")
    day = F.expr("INTERVAL '400' DAY")
    older = r.raw("orders").where("order_status = 'F'").withColumns({
        "order_status": F.lit("X"),
        "order_purchase_timestamp": F.col("order_purchase_timestamp") - day})
    newer = live_orders(r).where("order_status = 'L'")
    table.upsert(newer.unionByName(older), version_col="order_purchase_timestamp")
    return table.read()


@query("upsert_new_column", f"""
    SELECT {ORDER_COLUMNS}, NULL AS channel FROM raw_orders
    WHERE order_id NOT IN (SELECT order_id FROM raw_live_orders)
    UNION ALL SELECT *, 'live' AS channel FROM ({LIVE_SQL})""")
def _(r):
    table = orders_table(r, "evolve")
    table.upsert(live_orders(r).withColumn("channel", F.lit("live")))
    return table.read()


@query("upsert_one_month", f"""
    SELECT {ORDER_COLUMNS.replace("order_status", "CASE WHEN date_trunc('month', "
    "order_purchase_timestamp) = (SELECT max(date_trunc('month', order_purchase_timestamp)) "
    "FROM raw_orders) THEN 'U' ELSE order_status END AS order_status")}
    FROM raw_orders""")
def _(r):
    """A feed of the last month's orders; a purchase date never changes, so only that folder
    is read and replaced."""
    table = stored_table(r, "month", keys=["order_id"], buckets=0,
                         month="order_purchase_timestamp", moves=False)
    table.overwrite(r.raw("orders"))
    orders = r.raw("orders")
    last = orders.agg(F.max(F.date_trunc("month", "order_purchase_timestamp")).alias("last"))
    month = F.date_trunc("month", "order_purchase_timestamp")
    table.upsert(orders.join(last, month == F.col("last")).drop("last").withColumn(
        "order_status", F.lit("U")))
    return table.read()


@query("publish_contract", """
    SELECT cast(order_id AS string) AS order_id, cast(total_items AS int) AS total_items,
           total_price, total_freight, total_amount, order_status, purchase_date,
           delivered_date, delivery_days FROM summary""")
def _(r):
    path = scratch_dir(r.spark, "publish")
    publish(r.order_summary, contract("order_summary"), path)
    return published(r.spark, path, contract("order_summary"))


@query("publish_quarantine", """
    SELECT cast(product_id AS string) AS product_id, 'product_photos_qty' AS failed_columns
    FROM s_products WHERE product_category_name = 'PROMO'""")
def _(r):
    bad = F.when(F.col("product_category_name") == "PROMO", F.col("product_category_name"))
    products = r.silver("products").withColumn(
        "product_photos_qty", F.coalesce(bad, F.col("product_photos_qty").cast("string")))
    path = scratch_dir(r.spark, "quarantine")
    publish(products, contract("dim_products"), path)
    return quarantined(r.spark, path, contract("dim_products")).select(
        F.get_json_object("raw_row", "$.product_id").alias("product_id"), "failed_columns")


def write_with_ledger(r: Retail, batches) -> tuple[Ledger, DataFrame]:
    root = scratch_dir(r.spark, "ledger")
    ledger = Ledger(r.spark, f"{root}/ledger")
    rows = with_batch(r.raw("orders")).withColumn("load_id", F.lit("0"))
    for n in batches:
        batch = f"batch_{n}"
        ledger.mark_done(batch, "bronze", write_batch(
            rows.where(F.col("batch_id") == batch), f"{root}/orders"))
    return ledger, rows


@query("ledger_pending", """
    SELECT batch_id AS batch, count(*) AS n FROM batches
    WHERE batch_id NOT IN ('batch_1', 'batch_3') GROUP BY 1""")
def _(r):
    ledger, rows = write_with_ledger(r, "123")
    ledger.reset("batch_2")
    requested = rows.groupBy(F.col("batch_id").alias("batch")).agg(F.count(F.lit(1)).alias("n"))
    return ledger.pending(requested, "bronze")


@query("ledger_status", """
    SELECT batch_id AS batch, 'bronze' AS stage,
           CASE WHEN batch_id = 'batch_2' THEN 'reset' ELSE 'completed' END AS status,
           CASE WHEN batch_id = 'batch_2' THEN 0 ELSE count(*) END AS n
    FROM batches GROUP BY 1""")
def _(r):
    ledger, _ = write_with_ledger(r, BATCHES)
    ledger.reset("batch_2")
    return ledger.status().select("batch", "stage", "status", F.col("rows").alias("n"))


CURATED_CTES = {"category_translation": "raw_category_translation",
                "geolocation": "s_geolocation", "sellers": "s_sellers",
                "customers": "s_customers", "products": "s_products", "orders": "s_orders",
                "order_items": "s_items", "order_payments": "s_payments",
                "order_reviews": "s_reviews"}


def count_sql(column: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS {column} FROM {cte}"
                              for name, cte in CURATED_CTES.items())


@query("row_counts", count_sql("n"))
def _(r):
    """Counts observed while the tables are written, without a job of their own."""
    root, counts = scratch_dir(r.spark, "counts"), []
    for name in CURATED_CTES:
        df, seen = counted(r.silver(name), name)
        df.write.parquet(f"{root}/{name}")
        counts.append((name, rows_seen(seen)))
    return r.spark.createDataFrame(counts, "table_name string, n bigint")


@query("unmatched_customers", f"""
    SELECT f.customer_id, count(*) AS lines, {money('total_amount')} AS lost_revenue
    FROM fact f JOIN s_customers c ON f.customer_id = c.customer_id
    WHERE c.customer_state = 'NATION_3' GROUP BY 1""")
def _(r):
    """Against a dimension that lacks one state."""
    return gold.unmatched_customers(r.fact, r.customers.where("customer_state <> 'NATION_3'"))


# ---------------------------------------------------------------- cleaning rules

@query("clean_initcap_trim", "SELECT customer_id, customer_city FROM s_customers")
def _(r):
    rule = Rule("customer_city", "initcap_trim")
    return apply_rules(r.raw("customers"), [rule]).select("customer_id", "customer_city")


@query("clean_upper_trim", "SELECT customer_id, customer_state FROM s_customers")
def _(r):
    rule = Rule("customer_state", "upper_trim")
    return apply_rules(r.raw("customers"), [rule]).select("customer_id", "customer_state")


@query("clean_cast_string", """
    SELECT cast(order_id AS string) AS order_id, cast(order_item_id AS string) AS order_item_id,
           product_id FROM raw_order_items""")
def _(r):
    rules = [Rule("order_id", "cast_string"), Rule("order_item_id", "cast_string")]
    return apply_rules(r.raw("order_items").select("order_id", "order_item_id", "product_id"),
                       rules)


def messy(value: str) -> str:
    """Text with junk, empty and padded values, in both dialects."""
    return (f"CASE WHEN p_size < 10 THEN concat('x', cast({value} AS string)) "
            f"WHEN p_size < 20 THEN '' "
            f"WHEN p_size < 30 THEN concat('  ', cast({value} AS string), ' ') "
            f"ELSE cast({value} AS string) END AS v")


@query("clean_cast_double", """
    SELECT p_partkey, CASE WHEN p_size >= 20 THEN p_retailprice END AS v FROM part""")
def _(r):
    text = r.table("part").selectExpr("p_partkey", messy("p_retailprice"))
    return apply_rules(text, [Rule("v", "cast_double")])


@query("clean_cast_int", """
    SELECT p_partkey, CASE WHEN p_size >= 20 THEN p_size END AS v FROM part""")
def _(r):
    text = r.table("part").selectExpr("p_partkey", messy("p_size"))
    return apply_rules(text, [Rule("v", "cast_int")])


@query("clean_to_timestamp", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS v FROM orders""")
def _(r):
    text = r.table("orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderstatus = 'F' THEN concat('on ', cast(o_orderdate AS "
        "string)) ELSE cast(o_orderdate AS string) END AS v")
    return apply_rules(text, [Rule("v", "to_timestamp")])


@query("clean_fill_null", """
    SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name
    FROM raw_products""")
def _(r):
    rule = Rule("product_category_name", "fill_null", default="unknown")
    return apply_rules(r.raw("products"), [rule]).select("product_id", "product_category_name")


@query("clean_replace_value", "SELECT order_id, payment_sequential, payment_type FROM s_payments")
def _(r):
    rule = Rule("payment_type", "replace_value", old="not_defined", new="unknown")
    return apply_rules(r.raw("order_payments"), [rule]).select(
        "order_id", "payment_sequential", "payment_type")


@query("clean_rename", """
    SELECT product_id, cast(product_name_lenght AS int) AS product_name_length
    FROM raw_products""")
def _(r):
    rule = Rule("product_name_lenght", "rename", new_name="product_name_length")
    return apply_rules(r.raw("products"), [rule]).select("product_id", "product_name_length")


@query("bronze_audit", """
    SELECT order_id, batch_id, 'orders_dataset.csv' AS source_file, '0' AS load_id,
           true AS stamped FROM batches""")
def _(r):
    raw, spec = scratch_dir(r.spark, "audit"), SPECS["orders"]
    export_batches(r, raw, ("orders",))
    parts = [csv.with_audit(csv.scan_csv(r.spark, csv.batch_path(raw, n, spec), spec),
                            f"batch_{n}", source_file=spec.source_file) for n in BATCHES]
    return typed_ids(reduce(DataFrame.unionByName, parts)).select(
        "order_id", "batch_id", "source_file", "load_id",
        F.col("ingestion_timestamp").isNotNull().alias("stamped"))


@query("bronze_casts", """
    SELECT order_id, order_item_id, product_id, seller_id, price, freight_value
    FROM raw_order_items""")
def _(r):
    spec = SPECS["order_items"]
    path = to_csv(r.raw("order_items"), f"{scratch_dir(r.spark, 'casts')}/items.csv")
    return typed_ids(csv.enforce_types(csv.scan_csv(r.spark, path, spec), spec)).select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")


# ---------------------------------------------------------------- curated tables

for _name, _cte in (("orders", "s_orders"), ("products", "s_products"),
                    ("geolocation", "s_geolocation"), ("customers", "s_customers"),
                    ("sellers", "s_sellers"), ("order_payments", "s_payments"),
                    ("order_reviews", "s_reviews")):
    query(f"silver_{_name}", f"SELECT * FROM {_cte}")(lambda r, n=_name: r.silver(n))

query("dedup_order_items", "SELECT * FROM s_items")(lambda r: r.silver("order_items"))


@query("dedup_latest_wins", """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
        FROM events) WHERE rn = 1""")
def _(r):
    return latest_per_key(r.table("events"), ["user_id"], "ts")


@query("dedup_live", """
    SELECT order_id, order_item_id, product_id, seller_id, price, freight_value FROM s_items""")
def _(r):
    raw = r.raw("order_items")
    text = raw.select(*(F.col(c) if c.endswith("_id") and c != "order_item_id"
                        else F.col(c).cast("string").alias(c) for c in raw.columns))
    return clean_live(text, SPECS["order_items"]).drop("shipped_at")


# ---------------------------------------------------------------- star schema

query("dim_customers", "SELECT * FROM s_customers")(lambda r: r.customers)
query("dim_products", "SELECT * FROM s_products")(lambda r: r.silver("products"))
query("dim_geolocation", "SELECT * FROM s_geolocation")(lambda r: r.silver("geolocation"))
query("dim_sellers", "SELECT * FROM dim_sellers")(
    lambda r: gold.dim_sellers(r.silver("sellers"), r.silver("geolocation")))
query("fact_order_items", "SELECT * FROM fact")(lambda r: r.fact)
query("fact_delivery_flags", """
    SELECT order_id, order_item_id, delivery_days, delay_flag, on_time_flag FROM fact""")(
    lambda r: r.fact.select("order_id", "order_item_id", "delivery_days", "delay_flag",
                            "on_time_flag"))
query("fact_payments_per_order", "SELECT * FROM pay")(
    lambda r: gold.payments_per_order(r.silver("order_payments")))
query("fact_reviews_per_order", "SELECT * FROM rev")(
    lambda r: gold.reviews_per_order(r.silver("order_reviews")))
query("order_summary", "SELECT * FROM summary")(lambda r: r.order_summary)
query("customer_metrics", "SELECT * FROM cust")(lambda r: r.customer_metrics)
query("seller_performance", "SELECT * FROM sell")(lambda r: r.seller_performance)
query("product_performance", "SELECT * FROM prod")(lambda r: r.product_performance)
query("order_value_per_customer", f"""
    SELECT customer_id, {half_up(f"sum({millionths('total_amount')})",
                                 "1000000 * count(DISTINCT order_id)", 2)} AS avg_per_order
    FROM fact GROUP BY 1""")(lambda r: gold.order_value_per_customer(r.fact))


# ---------------------------------------------------------------- KPI queries

query("distinct_status", "SELECT DISTINCT order_status FROM summary "
      "WHERE order_status IS NOT NULL ORDER BY 1")(lambda r: kpi.distinct_status(r.order_summary))
query("distinct_state", """
    SELECT DISTINCT c.customer_state FROM fact f JOIN s_customers c
    ON f.customer_id = c.customer_id WHERE c.customer_state IS NOT NULL ORDER BY 1""")(
    lambda r: kpi.distinct_state(r.fact, r.customers))
query("kpi_overview", f"""
    SELECT {money('f.total_amount', 0)} AS total_revenue,
           count(DISTINCT f.order_id) AS total_orders,
           {int_mean('f.delivery_days', 1)} AS avg_delivery_days,
           {percent('sum(f.on_time_flag)', 'count(f.on_time_flag)')} AS on_time_pct,
           count(DISTINCT f.customer_id) AS unique_customers,
           {score_mean('f.review_score', 2)} AS avg_review,
           {percent('sum(CASE WHEN f.delay_flag = 1 THEN 1 ELSE 0 END)', 'count(*)')}
               AS delay_pct,
           {money_mean('f.total_amount')} AS avg_order_value
    FROM fact f JOIN s_customers c ON f.customer_id = c.customer_id
    WHERE f.review_score BETWEEN 1 AND 5""")(lambda r: kpi.overview(r.fact, r.customers))

STATE_REVENUE = f"""
    SELECT c.customer_state AS state, {money('f.total_amount', 0)} AS revenue,
           count(DISTINCT f.order_id) AS orders
    FROM fact f JOIN s_customers c ON f.customer_id = c.customer_id
    WHERE f.review_score BETWEEN 1 AND 5 %s
    GROUP BY 1 ORDER BY revenue DESC NULLS LAST, state LIMIT 15"""
query("kpi_revenue_by_state", STATE_REVENUE % "")(
    lambda r: kpi.revenue_by_state(r.fact, r.customers))
query("kpi_filtered_state", STATE_REVENUE % "AND c.customer_state = 'NATION_7'")(
    lambda r: kpi.run_sql(r.spark, kpi.STATE_REVENUE_SQL,
                          {"low": 1, "high": 5, "state": "NATION_7"},
                          fact=r.fact, customers=r.customers))

STATUS_REVENUE = f"""
    SELECT order_status, {money('total_amount', 0)} AS revenue FROM summary %s
    GROUP BY 1 ORDER BY revenue DESC NULLS LAST, order_status"""
query("kpi_filtered_status", STATUS_REVENUE % "WHERE order_status = 'F'")(
    lambda r: kpi.run_sql(r.spark, kpi.STATUS_REVENUE_SQL, {"status": "F"},
                          order_summary=r.order_summary))
query("kpi_revenue_by_status", f"""
    SELECT order_status, {money('total_amount', 0)} AS revenue,
           (SELECT {money('total_amount', 0)} FROM summary) AS grand_total
    FROM summary GROUP BY 1""")(lambda r: kpi.revenue_by_status(r.order_summary))
query("kpi_monthly_revenue", f"""
    SELECT cast(date_trunc('month', purchase_timestamp) AS timestamp) AS month,
           count(DISTINCT order_id) AS orders, {money('total_amount', 0)} AS revenue
    FROM fact WHERE purchase_timestamp IS NOT NULL
    GROUP BY 1 ORDER BY 1 LIMIT 24""")(lambda r: kpi.monthly_revenue(r.fact))
query("kpi_delivery_histogram", """
    SELECT delivery_days, count(*) AS orders, delay_flag FROM fact
    WHERE delivery_days BETWEEN 0 AND 60 AND delay_flag IS NOT NULL
      AND review_score BETWEEN 1 AND 5 GROUP BY 1, 3""")(
    lambda r: kpi.delivery_histogram(r.fact))
query("kpi_on_time_by_state", "SELECT * FROM statebase")(
    lambda r: kpi.on_time_by_state(r.fact, r.customers))
query("kpi_state_bubble", """
    SELECT *, cast(orders AS double) / (SELECT max(orders) FROM statebase) * 30 + 8 AS size
    FROM statebase""")(lambda r: kpi.state_bubble(kpi.on_time_by_state(r.fact, r.customers)))

SCORES = """
    SELECT cast(floor(review_score + 0.5) AS int) AS score, delay_flag, count(*) AS cnt
    FROM fact WHERE review_score > 0 AND delay_flag IS NOT NULL AND delivery_days IS NOT NULL
    GROUP BY 1, 2"""
query("kpi_delay_by_score", SCORES)(lambda r: kpi.delay_by_score(r.fact))
query("kpi_delay_score_pivot", "SELECT delay_flag, " + ", ".join(
    f"cast(coalesce(sum(cnt) FILTER (score = {s}), 0) AS bigint) AS score_{s}"
    for s in range(1, 6)) + f""", cast(coalesce(sum(cnt) FILTER (score NOT BETWEEN 1 AND 5), 0)
    AS bigint) AS score_other FROM ({SCORES}) GROUP BY 1""")(
    lambda r: kpi.delay_score_pivot(r.fact))
query("kpi_state_share", f"""
    SELECT state, revenue, revenue / (sum(revenue) OVER ()) AS share FROM (
        SELECT c.customer_state AS state, {money('f.total_amount', 0)} AS revenue
        FROM fact f JOIN s_customers c ON f.customer_id = c.customer_id GROUP BY 1)""")(
    lambda r: kpi.state_share(r.fact, r.customers))


def histogram_sql(table: str, column: str, bins: int) -> str:
    return f"""
    SELECT bin, lo + (bin - 1) * (hi - lo) / cast({bins} AS double) AS bin_start, n, mean
    FROM (SELECT least(cast(floor(cast({bins} AS double) * (x - lo) / (hi - lo)) AS bigint) + 1,
                       {bins}) AS bin, lo, hi, mean, count(*) AS n
          FROM (SELECT {column} AS x, min({column}) OVER () AS lo, max({column}) OVER () AS hi,
                       round(avg({column}) OVER (), 1) AS mean
                FROM {table} WHERE {column} IS NOT NULL) GROUP BY ALL)"""


query("hist_customer_value", histogram_sql("topspend", "total_spent", 60))(
    lambda r: kpi.customer_value_histogram(r.customer_metrics))
query("hist_seller_on_time", histogram_sql("topsell", "on_time", 40))(
    lambda r: kpi.seller_on_time_histogram(r.seller_performance))
query("top_customers", f"""
    SELECT left(cast(customer_id AS string), 8) || '...' AS customer, total_orders,
           {half_up(cents_sql('total_spent'), '100', 0)} AS total_spent,
           {half_up(cents_sql('avg_order_value'), '100', 0)} AS avg_order,
           avg_review_score AS review
    FROM (SELECT * FROM cust ORDER BY total_spent DESC NULLS LAST, customer_id LIMIT 10)""")(
    lambda r: kpi.top_customers(r.customer_metrics))
query("sample_customers", """
    SELECT customer_id, total_spent, total_orders, avg_review_score FROM topspend
    ORDER BY md5(cast(customer_id AS string) || ':7'), customer_id LIMIT 1500""")(
    lambda r: kpi.sample_customers(r.customer_metrics))
query("top_sellers", "SELECT * FROM topsell")(lambda r: kpi.top_sellers(r.seller_performance))
query("top15_sellers", """
    SELECT * FROM (SELECT * FROM topsell ORDER BY revenue DESC NULLS LAST, seller_id LIMIT 15)
    ORDER BY revenue, seller_id DESC""")(lambda r: kpi.top15_sellers(r.seller_performance))
query("kpi_category_performance", "SELECT * FROM categories")(
    lambda r: kpi.category_performance(r.product_performance, r.silver("products")))
query("top12_categories", """
    SELECT * FROM categories ORDER BY total_sales DESC NULLS LAST, category LIMIT 12""")(
    lambda r: kpi.top12_categories(r.product_performance, r.silver("products")))
query("product_price_review", """
    SELECT p.product_id, coalesce(d.product_category_name_english, 'Other') AS category,
           avg_price, avg_review_score, total_sales
    FROM prod p JOIN s_products d ON p.product_id = d.product_id
    WHERE total_quantity >= 3 AND avg_price > 0 ORDER BY p.product_id LIMIT 2000""")(
    lambda r: kpi.product_price_review(r.product_performance, r.silver("products")))
query("mask_id", """
    SELECT customer_id, left(cast(c_name AS string), 8) || '...' AS masked
    FROM (SELECT c_custkey AS customer_id, c_name FROM customer)""")(
    lambda r: r.table("customer").select(F.col("c_custkey").alias("customer_id"),
                                         mask_id("c_name").alias("masked")))


query("kpi_overview_months", f"""
    SELECT cast(year(purchase_timestamp) AS int) AS period,
           {money('total_amount', 0)} AS total_revenue, count(DISTINCT order_id) AS total_orders,
           {int_mean('delivery_days', 1)} AS avg_delivery_days,
           {percent('sum(on_time_flag)', 'count(on_time_flag)')} AS on_time_pct,
           count(DISTINCT customer_id) AS unique_customers,
           {score_mean('review_score', 2)} AS avg_review,
           {percent('sum(CASE WHEN delay_flag = 1 THEN 1 ELSE 0 END)', 'count(*)')} AS delay_pct,
           {money_mean('total_amount')} AS avg_order_value
    FROM fact WHERE review_score BETWEEN 1 AND 5 AND purchase_timestamp IS NOT NULL
    GROUP BY 1""")(lambda r: yearly_overview(r))


def yearly_overview(r: Retail) -> DataFrame:
    """From states per month that are stored in two runs, some months in both."""
    path, year = scratch_dir(r.spark, "months"), F.year("purchase_timestamp")
    months.store_months(r.fact.where(year < 1996), path)
    months.store_months(r.fact.where(year >= 1995), path)
    return months.overview_months(r.spark, path, F.floor(F.col("month") / 100).cast("int"))


# ---------------------------------------------------------------- dashboard as SQL

_WAREHOUSES: dict[tuple[str, str], str] = {}


def published_frames(r: Retail) -> dict[str, DataFrame]:
    """The nine star-schema tables over the test data. Five of them need the fact, which is
    made once."""
    r = r.with_stored_fact()
    return {"dim_customers": r.customers,
            "dim_sellers": gold.dim_sellers(r.silver("sellers"), r.silver("geolocation")),
            "dim_products": r.silver("products"), "dim_geolocation": r.silver("geolocation"),
            "fact_order_items": r.fact, "order_summary": r.order_summary,
            "customer_metrics": r.customer_metrics,
            "seller_performance": r.seller_performance,
            "product_performance": r.product_performance}


def publish_frames(r: Retail, frames: dict[str, DataFrame], root: str, database: str) -> None:
    def load(name: str) -> int:
        rows = publish(frames[name], contract(name), f"{root}/{name}")
        name_in_catalog(r.spark, f"{root}/{name}", contract(name), f"{database}.{name}")
        return rows

    done = StageResult()
    side_by_side({name: partial(load, name) for name in frames}, done)
    raise_first(done)


def warehouse(r: Retail) -> str:
    """A database with the nine published tables and the dashboard functions, made once per
    session and data folder. One state has a quote in its name."""
    key = (r.spark.sparkContext.applicationId, r.sf_dir)
    if key not in _WAREHOUSES:
        root = scratch_dir(r.spark, "warehouse")
        database = database_at(r.spark, root)
        frames = published_frames(r)
        frames["dim_customers"] = r.customers.withColumn("customer_state", F.when(
            F.col("customer_state") == "NATION_3", "D'OESTE").otherwise(F.col("customer_state")))
        publish_frames(r, frames, root, database)
        dashboard.install(r.spark, database)
        _WAREHOUSES[key] = database
    return _WAREHOUSES[key]


def sql_query(question: str, sql: str, **values) -> None:
    query(f"sql_{question}", sql)(
        lambda r: dashboard.ask(r.spark, warehouse(r), question, **values))


BUYERS = "fact f JOIN w_customers c ON f.customer_id = c.customer_id"
sql_query("order_statuses", """
    SELECT DISTINCT order_status FROM summary WHERE order_status IS NOT NULL ORDER BY 1""")
sql_query("customer_states", f"""
    SELECT DISTINCT customer_state FROM {BUYERS} WHERE customer_state IS NOT NULL ORDER BY 1""")
sql_query("overview", f"""
    SELECT {money('f.total_amount', 0)} AS total_revenue,
           count(DISTINCT f.order_id) AS total_orders,
           {int_mean('f.delivery_days', 1)} AS avg_delivery_days,
           {percent('sum(f.on_time_flag)', 'count(f.on_time_flag)')} AS on_time_pct,
           count(DISTINCT f.customer_id) AS unique_customers,
           {score_mean('f.review_score', 2)} AS avg_review,
           {percent('sum(CASE WHEN f.delay_flag = 1 THEN 1 ELSE 0 END)', 'count(*)')}
               AS delay_pct,
           {money_mean('f.total_amount')} AS avg_order_value
    FROM {BUYERS} WHERE f.review_score BETWEEN 2 AND 5 AND c.customer_state = 'D''OESTE'""",
          state="D'OESTE", low=2)
sql_query("revenue_by_state", f"""
    SELECT c.customer_state AS state, {money('f.total_amount', 0)} AS revenue,
           count(DISTINCT f.order_id) AS orders
    FROM {BUYERS} WHERE f.review_score BETWEEN 2 AND 4
    GROUP BY 1 ORDER BY revenue DESC NULLS LAST, state LIMIT 15""", low=2, high=4)
sql_query("revenue_by_status", f"""
    SELECT order_status, {money('total_amount', 0)} AS revenue FROM summary
    WHERE order_status = 'O' GROUP BY 1""", status="O")
sql_query("monthly_revenue", f"""
    SELECT cast(date_trunc('month', purchase_timestamp) AS timestamp) AS month,
           count(DISTINCT order_id) AS orders, {money('total_amount', 0)} AS revenue
    FROM fact WHERE purchase_timestamp IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 24""")
sql_query("delivery_histogram", """
    SELECT delivery_days, count(*) AS orders, delay_flag FROM fact
    WHERE delivery_days BETWEEN 0 AND 45 AND delay_flag IS NOT NULL
      AND review_score BETWEEN 2 AND 4 GROUP BY 1, 3""", max_days=45, low=2, high=4)
sql_query("on_time_by_state", f"""
    SELECT c.customer_state AS state, {percent('sum(on_time_flag)', 'count(on_time_flag)')}
               AS on_time_rate,
           count(DISTINCT order_id) AS orders, {int_mean('delivery_days', 1)} AS avg_days
    FROM {BUYERS} WHERE on_time_flag IS NOT NULL AND review_score BETWEEN 1 AND 4
    GROUP BY 1 HAVING count(*) > 5 ORDER BY on_time_rate DESC NULLS LAST, state LIMIT 20""",
          high=4, more_than=5)
sql_query("delay_by_score", SCORES)
sql_query("customer_values", """
    SELECT cast(customer_id AS string) AS customer_id, total_spent,
           cast(total_orders AS int) AS total_orders, avg_review_score
    FROM cust WHERE total_spent > 0
    ORDER BY total_spent DESC, cast(customer_id AS string) LIMIT 5000""")
sql_query("top_customers", f"""
    SELECT left(cast(customer_id AS string), 8) || '...' AS customer,
           cast(total_orders AS int) AS total_orders,
           {half_up(cents_sql('total_spent'), '100', 0)} AS total_spent,
           {half_up(cents_sql('avg_order_value'), '100', 0)} AS avg_order,
           avg_review_score AS review
    FROM (SELECT * FROM cust
          ORDER BY total_spent DESC NULLS LAST, cast(customer_id AS string) LIMIT 10)""")
sql_query("state_revenue", f"""
    SELECT c.customer_state AS state, {money('f.total_amount', 0)} AS revenue
    FROM {BUYERS} GROUP BY 1""")
sql_query("top_sellers", f"""
    SELECT left(cast(seller_id AS string), 8) || '...' AS seller,
           cast(total_orders AS int) AS total_orders,
           {half_up(cents_sql('total_revenue'), '100', 0)} AS revenue,
           avg_review_score AS review, on_time_delivery_rate AS on_time,
           avg_delivery_days AS avg_days
    FROM sell WHERE total_orders >= 8
    ORDER BY revenue DESC NULLS LAST, cast(seller_id AS string) LIMIT 200""", min_orders=8)
sql_query("category_sales", "SELECT * FROM categories")
sql_query("product_prices", """
    SELECT coalesce(d.product_category_name_english, 'Other') AS category, avg_price,
           avg_review_score, total_sales
    FROM prod p JOIN s_products d ON p.product_id = d.product_id
    WHERE total_quantity >= 3 AND avg_price > 0
    ORDER BY cast(p.product_id AS string) LIMIT 2000""")

#: Table and a text of the main columns of each published table.
PUBLISHED = {
    "dim_customers": ("s_customers", "concat(cast(customer_id AS string), customer_state)"),
    "dim_sellers": ("dim_sellers", "concat(cast(seller_id AS string), seller_city)"),
    "dim_products": ("s_products", "concat(cast(product_id AS string), "
                     "product_category_name_english)"),
    "dim_geolocation": ("s_geolocation", "concat(geolocation_zip_code_prefix, geolocation_state)"),
    "fact_order_items": ("fact", "concat(cast(order_id AS string), '/', cast(order_item_id AS "
                         "string), '/', cast(product_id AS string), '/', cast(round(price * "
                         "100) AS bigint))"),
    "order_summary": ("summary", "concat(cast(order_id AS string), order_status, "
                      "cast(total_items AS string))"),
    "customer_metrics": ("cust", "concat(cast(customer_id AS string), '/', cast(total_orders AS "
                         "string), '/', cast(round(total_spent * 100) AS bigint))"),
    "seller_performance": ("sell", "concat(cast(seller_id AS string), '/', cast(total_orders AS "
                           "string))"),
    "product_performance": ("prod", "concat(cast(product_id AS string), '/', "
                            "cast(total_quantity AS string))"),
}


@query("publish_all", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count, {digest_of(text)} AS contents "
    f"FROM {cte}" for name, (cte, text) in PUBLISHED.items()))
def _(r):
    """All nine contracts, each loaded twice: the second load takes the place of the first."""
    root = scratch_dir(r.spark, "publish_all")
    database, frames = database_at(r.spark, root), published_frames(r)
    publish_frames(r, {n: f.limit(3) for n, f in frames.items()}, root, database)
    publish_frames(r, frames, root, database)
    return reduce(DataFrame.unionByName, (
        r.spark.table(f"{database}.{name}").selectExpr(
            f"'{name}' AS table_name", "count(*) AS row_count", f"{digest_of(text)} AS contents")
        for name, (_, text) in PUBLISHED.items()))


# ---------------------------------------------------------------- declared goals

query("cohort_retention", """
    SELECT cast(cohort AS timestamp) AS cohort, cast(month_offset AS int) AS month_offset,
           active_customers, orders, cohort_size,
           cast(active_customers AS double) / cohort_size AS retention
    FROM (SELECT cohort, month_offset, count(DISTINCT customer_id) AS active_customers,
                 count(*) AS orders FROM cohort_rows GROUP BY 1, 2)
    JOIN (SELECT cohort, count(DISTINCT customer_id) AS cohort_size
          FROM cohort_rows GROUP BY 1) USING (cohort)""")(
    lambda r: cohorts.retention(r.silver("orders")))
query("cohort_matrix", """
    SELECT cast(cohort AS timestamp) AS cohort, cast(o AS int) AS month_offset,
           count(DISTINCT customer_id) AS active_customers
    FROM (SELECT DISTINCT cohort FROM cohort_rows)
    CROSS JOIN (SELECT unnest(generate_series(0, max(month_offset))) AS o FROM cohort_rows)
    LEFT JOIN cohort_rows r USING (cohort)
    WHERE r.month_offset = o GROUP BY 1, 2
    UNION ALL
    SELECT cast(cohort AS timestamp), cast(o AS int), 0
    FROM (SELECT DISTINCT cohort FROM cohort_rows)
    CROSS JOIN (SELECT unnest(generate_series(0, max(month_offset))) AS o FROM cohort_rows)
    WHERE (cohort, o) NOT IN (SELECT (cohort, month_offset) FROM cohort_rows)""")(
    lambda r: cohorts.retention_matrix(r.silver("orders")))
query("money_subcent", """
    SELECT l_returnflag, cast(count(*) AS bigint) AS n,
           cast(sum(cast(l_extendedprice * l_discount / 1000 AS decimal(27,9))) AS decimal(18,2))
               ::double AS total
    FROM lineitem GROUP BY 1""")(
    lambda r: r.spark.read.parquet(f"{r.sf_dir}/lineitem.parquet").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), amount(F.sum(exact(
            F.col("l_extendedprice") * F.col("l_discount") / 1000))).alias("total")))
query("cohort_revenue", f"""
    SELECT cast(cohort AS timestamp) AS cohort, cast(month_offset AS int) AS month_offset,
           count(*) AS orders, {half_up('sum(spent)', '1000000', 2)} AS revenue,
           cast(sum(paid) AS double) / 100.0 AS paid,
           {score_mean('review_score', 2)} AS avg_review
    FROM cohort_rows GROUP BY 1, 2""")(
    lambda r: cohorts.revenue(r.silver("orders"), r.silver("order_items"),
                              r.silver("order_payments"), r.silver("order_reviews")))
query("kpi_delivery_delay", """
    SELECT cast(sum(d) AS double) / count(d) AS avg_delay, count(d) AS delivered_orders
    FROM (SELECT date_diff('day', order_estimated_delivery_date,
                           order_delivered_customer_date) AS d FROM s_orders)""")(
    lambda r: kpi.delivery_delay(r.silver("orders")))
query("clv_simple", f"""
    SELECT customer_id, {money('total_amount')} AS clv FROM fact GROUP BY 1""")(
    lambda r: kpi.lifetime_value(r.fact))
query("revenue_by_state_simple", f"""
    SELECT c.customer_state AS state, {money('total_amount')} AS revenue
    FROM fact f JOIN s_customers c ON f.customer_id = c.customer_id GROUP BY 1""")(
    lambda r: kpi.revenue_by_state_simple(r.fact, r.customers))
query("kpi_revenue_by_region", f"""
    SELECT g.region, {money('total_amount')} AS revenue, count(DISTINCT f.order_id) AS orders
    FROM fact f JOIN s_customers c ON f.customer_id = c.customer_id
    JOIN raw_state_regions g ON c.customer_state = g.state GROUP BY 1""")(
    lambda r: kpi.revenue_by_region(r.fact, r.customers, r.raw("state_regions")))


# ---------------------------------------------------------------- live path

ORDERS_ONLY = {"orders": replace(SPECS["orders"], version=None)}


def live_lake(r: Retail, label: str) -> tuple[Lake, str]:
    root = scratch_dir(r.spark, label)
    return Lake(r.spark, f"{root}/lake", {}, ORDERS_ONLY, buckets=r.buckets(8)), root


def drop_live(rows: DataFrame, root: str, stamp: str) -> None:
    to_csv(rows, f"{root}/live/{stamp}_{SPECS['orders'].source_file}")


@query("stream_ingest", f"SELECT '{LIVE_BATCH}' AS batch_id, {SHORT_SQL} FROM raw_live_orders")
def _(r):
    lake, root = live_lake(r, "ingest")
    drop_live(live_frame(r), root, "20260101_000000")
    run_live(lake, f"{root}/live", f"{root}/offsets", merge=False)
    stored = read_batch(r.spark, lake.bronze_path("orders"), LIVE_BATCH)
    return typed_ids(apply_rules(stored, SPECS["orders"].rules)).select("batch_id", *SHORT)


@query("stream_upsert", UPSERT_SQL)
def _(r):
    lake, root = live_lake(r, "merge")
    lake.silver("orders").overwrite(apply_rules(
        r.raw("orders").select(*(F.col(c).cast("string").alias(c)
                                 for c in SPECS["orders"].columns)), SPECS["orders"].rules))
    drop_live(live_frame(r), root, "20260101_000000")
    run_live(lake, f"{root}/live", f"{root}/offsets")
    return typed_ids(lake.silver("orders").read())


@query("stream_incremental", f"""
    SELECT order_status, count(*) AS n FROM raw_live_orders GROUP BY 1""")
def _(r):
    """Two arrivals, two runs from the same offsets: each row is stored once."""
    lake, root = live_lake(r, "increment")
    rows = live_frame(r)
    for stamp, status in (("20260101_000000", "L"), ("20260101_001000", "N")):
        drop_live(rows.where(F.col("order_status") == status), root, stamp)
        run_live(lake, f"{root}/live", f"{root}/offsets", merge=False)
    stored = read_batch(r.spark, lake.bronze_path("orders"), LIVE_BATCH)
    return stored.groupBy("order_status").agg(F.count(F.lit(1)).alias("n"))


@query("stream_empty_poll", """
    SELECT 1 AS poll, count(*) AS n FROM raw_live_orders UNION ALL SELECT 2, 0""")
def _(r):
    lake, root = live_lake(r, "poll")
    drop_live(live_frame(r), root, "20260101_000000")
    seen = [(i, run_live(lake, f"{root}/live", f"{root}/offsets", merge=False)["orders"])
            for i in (1, 2)]
    return r.spark.createDataFrame(seen, "poll int, n bigint")


#: The four live tables; their rows carry no column that the sources lack.
LIVE_SPECS = {n: replace(SPECS[n], version=None) for n in (
    "orders", "order_items", "order_payments")} | {"order_reviews": SPECS["order_reviews"]}


def drop_live_table(r: Retail, name: str, root: str, stamp: str) -> None:
    spec, rows = LIVE_SPECS[name], r.raw(f"live_{name}")
    whole = rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
                          for c in spec.columns))
    to_csv(whole, f"{root}/live/{stamp}_{spec.source_file}")


def merged_live(name: str, cte: str) -> None:
    columns = ", ".join(LIVE_SPECS[name].columns)

    def run(r: Retail) -> DataFrame:
        root = scratch_dir(r.spark, f"live_{name}")
        lake = Lake(r.spark, f"{root}/lake", {}, {name: LIVE_SPECS[name]},
                    buckets=r.buckets(8))
        base = r.silver(name)
        lake.silver(name).overwrite(base.select(*(
            F.col(c).cast("string").alias(c) if c.endswith("_id") and c != "order_item_id"
            else F.col(c) for c in LIVE_SPECS[name].columns)))
        drop_live_table(r, name, root, "20260101_000000")
        run_live(lake, f"{root}/live", f"{root}/offsets")
        return typed_ids(lake.silver(name).read())

    query(f"stream_upsert_{name.removeprefix('order_')}", f"SELECT {columns} FROM {cte}")(run)


merged_live("order_items", "l_items_numbers")
merged_live("order_payments", "l_payments")
merged_live("order_reviews", "l_reviews")


@query("stream_dedup", f"SELECT {SHORT_SQL} FROM raw_live_orders")
def _(r):
    """The second file repeats the first and adds to it; the third repeats all. Each row is
    stored once, over several files, batches and runs."""
    lake, root = live_lake(r, "dedup")
    rows = live_frame(r)
    for stamp, part in (("20260101_000000", rows.where("order_status = 'L'")),
                        ("20260101_001000", rows), ("20260101_002000", rows)):
        drop_live(part, root, stamp)
        run_live(lake, f"{root}/live", f"{root}/offsets", merge=False, once_within="30 days")
    stored = read_batch(r.spark, lake.bronze_path("orders"), LIVE_BATCH)
    return typed_ids(apply_rules(stored, SPECS["orders"].rules)).select(*SHORT)


@query("stream_new_column", f"""
    SELECT {SHORT_SQL}, CASE WHEN order_status = 'N' THEN 'app' END AS channel,
           CASE WHEN order_status = 'N' THEN order_id % 5 END AS shop
    FROM raw_live_orders""")
def _(r):
    """The second file has two new columns, in front of and between the others; the stream goes
    on, and the new values are read out of what was stored."""
    lake, root = live_lake(r, "evolve")
    rows = live_frame(r)
    drop_live(rows.where("order_status = 'L'"), root, "20260101_000000")
    run_live(lake, f"{root}/live", f"{root}/offsets", evolving=True)
    new = rows.where("order_status = 'N'")
    first, *rest = new.columns
    drop_live(new.select(F.lit("app").alias("channel"), first,
                         (F.col("order_id") % 5).alias("shop"), *rest), root, "20260101_001000")
    run_live(lake, f"{root}/live", f"{root}/offsets", evolving=True)
    stored = read_batch(r.spark, lake.bronze_path("orders"), LIVE_BATCH)
    merged = typed_ids(lake.silver("orders").read()).select(*SHORT)
    rescued = typed_ids(stored.select(
        "order_id", F.expr("variant_get(rescued, '$.channel', 'string')").alias("channel"),
        F.expr("variant_get(rescued, '$.shop', 'bigint')").alias("shop")))
    return merged.join(rescued, "order_id")


@query("stream_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n, cast(1 AS bigint) AS batches FROM raw_live_{n}"
    for n in ("orders", "order_items", "order_payments", "order_reviews")))
def _(r):
    """Rows and batches as reported by the streams of all four tables."""
    root = scratch_dir(r.spark, "counted")
    lake = Lake(r.spark, f"{root}/lake", {}, LIVE_SPECS, buckets=r.buckets(8))
    for name in LIVE_SPECS:
        drop_live_table(r, name, root, "20260101_000000")
    return live_counts(lake, f"{root}/live", f"{root}/offsets")


# ---------------------------------------------------------------- whole pipeline

def filled_lake(r: Retail, label: str, batches=BATCHES) -> Lake:
    """All batches through the raw and curated layers."""
    root = scratch_dir(r.spark, label)
    export_batches(r, f"{root}/raw")
    lake = Lake(r.spark, f"{root}/lake", {n: SPECS[n] for n in REFERENCE_SPECS},
                {n: SPECS[n] for n in TRANSACTIONAL_SPECS}, buckets=r.buckets())
    for n in batches:
        raise_first(run_bronze(lake, f"{root}/raw", n))
        run_silver(lake, n)
    return lake


_LAKES: dict[tuple[str, str, str], Lake] = {}


def shared(r: Retail, label: str, make: Callable[[Retail, str], Lake]) -> Lake:
    """A lake that several queries read, made once per session and data folder."""
    key = (r.spark.sparkContext.applicationId, r.sf_dir, label)
    if key not in _LAKES:
        _LAKES[key] = make(r, label)
    return _LAKES[key]


#: Distinguishes the contents of the curated tables of the pipeline; the CSV keys are texts.
DIGESTS = {
    "category_translation": ("raw_category_translation", "product_category_name_english"),
    "geolocation": ("s_geolocation", "geolocation_zip_code_prefix"),
    "sellers": ("s_sellers", "seller_city"), "customers": ("s_customers", "customer_city"),
    "products": ("s_products", "product_category_name_english"),
    "orders": ("s_orders", "concat(order_status, cast(customer_id AS string))"),
    "order_items": ("text_items", "concat(cast(order_id AS string), '/', cast(order_item_id AS "
                    "string), '/', cast(product_id AS string), '/', cast(seller_id AS string))"),
    "order_payments": ("s_payments", "concat(payment_type, cast(order_id AS string), "
                       "cast(payment_installments AS string))"),
    "order_reviews": ("s_reviews", "concat(review_comment_message, cast(order_id AS string), "
                      "cast(review_score AS string))"),
}


@query("stages_batches", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count, {digest_of(text)} AS contents "
    f"FROM {cte}" for name, (cte, text) in DIGESTS.items()))
def _(r):
    """Rows and contents of the curated tables after four batches."""
    lake = shared(r, "batches", filled_lake)
    return reduce(DataFrame.unionByName, (
        lake.silver(name).read().selectExpr(f"'{name}' AS table_name", "count(*) AS row_count",
                                            f"{digest_of(text)} AS contents")
        for name, (_, text) in DIGESTS.items()))


@query("stages_gold", "SELECT * FROM text_fact")
def _(r):
    """The stored fact after four batches equals the fact computed in one go."""
    lake = shared(r, "batches", filled_lake)
    build_gold(lake, ("fact_order_items",))
    return typed_ids(lake.gold("fact_order_items").read())


def grown_lake(r: Retail, label: str) -> Lake:
    """A star schema built from three batches and brought up to date with the fourth."""
    lake = filled_lake(r, label, BATCHES[:3])
    build_gold(lake, ("fact_order_items", "order_summary", *ROLLUPS))
    raise_first(run_bronze(lake, f"{lake.root[:-len('/lake')]}/raw", "4"))
    run_silver(lake, "4")
    refresh_gold(lake, changed_orders(lake, "batch_4"), "batch_4")
    return lake


@query("gold_incremental", "SELECT * FROM text_fact")
def _(r):
    """The fact after an incremental run equals the fact computed in one go."""
    return typed_ids(shared(r, "grown", grown_lake).gold("fact_order_items").read())


def on_text_fact(cte: str) -> str:
    return CTES[cte].replace("FROM fact", "FROM text_fact")


@query("gold_incremental_metrics", f"""
    SELECT 'customer' AS kind, customer_id AS id, cast(total_orders AS bigint) AS n,
           total_spent AS total, avg_review_score AS score, last_order_date AS last_date
    FROM ({on_text_fact("cust")})
    UNION ALL SELECT 'seller', seller_id, total_orders, total_revenue, avg_review_score, NULL
    FROM ({on_text_fact("sell")})
    UNION ALL SELECT 'product', product_id, total_quantity, total_sales, avg_review_score, NULL
    FROM ({on_text_fact("prod")})
    UNION ALL SELECT 'order', order_id, total_items, total_amount, NULL, purchase_date
    FROM ({on_text_fact("summary")})""")
def _(r):
    """Customers, sellers, products and orders after an incremental run."""
    lake = shared(r, "grown", grown_lake)
    none, when = "cast(NULL AS double)", "cast(NULL AS timestamp)"
    return reduce(DataFrame.unionByName, (lake.read_gold(name).selectExpr(
        f"'{kind}' AS kind", f"cast({key} AS bigint) AS id", f"{n} AS n", f"{total} AS total",
        f"{score} AS score", f"{last} AS last_date")
        for name, kind, key, n, total, score, last in (
            ("customer_metrics", "customer", "customer_id", "total_orders", "total_spent",
             "avg_review_score", "last_order_date"),
            ("seller_performance", "seller", "seller_id", "total_orders", "total_revenue",
             "avg_review_score", when),
            ("product_performance", "product", "product_id", "total_quantity", "total_sales",
             "avg_review_score", when),
            ("order_summary", "order", "order_id", "total_items", "total_amount", none,
             "purchase_date"))))


@query("stages_live", "SELECT * FROM l_fact")
def _(r):
    """Four batches, then a live feed of all four tables, up to the star schema, which is brought
    up to date with the feed alone."""
    lake = filled_lake(r, "to_gold")
    build_gold(lake, ("fact_order_items", "order_summary", *ROLLUPS))
    root = lake.root[:-len("/lake")]
    for name in LIVE_SPECS:
        drop_live_table(r, name, root, "20260101_000000")
    live = Lake(r.spark, lake.root, {}, LIVE_SPECS, buckets=lake.buckets)
    run_live(live, f"{root}/live", f"{root}/offsets")
    refresh_gold(live, changed_orders(live, LIVE_BATCH), "live")
    return typed_ids(lake.gold("fact_order_items").read())


@query("audit_row_counts", """
    SELECT 'dim_customers' AS table_name, count(*) AS row_count FROM s_customers
    UNION ALL SELECT 'dim_sellers', count(*) FROM s_sellers
    UNION ALL SELECT 'dim_products', count(*) FROM s_products
    UNION ALL SELECT 'dim_geolocation', count(*) FROM s_geolocation
    UNION ALL SELECT 'fact_order_items', count(*) FROM fact
    UNION ALL SELECT 'order_summary', count(*) FROM summary
    UNION ALL SELECT 'customer_metrics', count(*) FROM cust
    UNION ALL SELECT 'seller_performance', count(*) FROM sell
    UNION ALL SELECT 'product_performance', count(*) FROM prod""")
def _(r):
    lake = Lake(r.spark, scratch_dir(r.spark, "audit"), buckets=r.buckets(8))
    filled = StageResult()
    side_by_side({n: partial(lambda n: lake.silver(n).overwrite(r.silver(n)), n)
                  for n in SPECS}, filled)
    raise_first(filled)
    build_gold(lake)
    return row_counts({n: lake.read_gold(n) for n in CONTRACT_DDL})
