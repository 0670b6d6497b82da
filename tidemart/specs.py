"""Declarative table specs and published contracts: data, not code."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ACTIONS = frozenset({
    "initcap_trim", "upper_trim", "cast_string", "cast_double", "cast_int",
    "to_timestamp", "fill_null", "replace_value", "rename",
})
COLLAPSES = frozenset({"avg", "first"})
AUDIT_COLUMNS = ("ingestion_timestamp", "source_file", "batch_id", "load_id")


@dataclass(frozen=True)
class Rule:
    """One cleaning step on one column; an unknown action is rejected here."""

    column: str
    action: str
    default: str = ""
    old: str | None = None
    new: str | None = None
    new_name: str | None = None

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"{self.column}: unknown cleaning action {self.action!r}")
        if self.action == "replace_value" and (self.old is None or self.new is None):
            raise ValueError(f"{self.column}: replace_value needs old and new")
        if self.action == "rename" and not self.new_name:
            raise ValueError(f"{self.column}: rename needs new_name")


@dataclass(frozen=True)
class Lookup:
    """Join with another curated table, then fill columns left NULL."""

    table: str
    on: str
    how: str = "left"
    fill: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Collapse:
    """Fold many rows per key into one; ``first`` follows the tie-breakers."""

    keys: tuple[str, ...]
    aggs: dict[str, str]
    tie_breakers: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        unknown = set(self.aggs.values()) - COLLAPSES
        if unknown:
            raise ValueError(f"unknown aggregates {sorted(unknown)}")


@dataclass(frozen=True)
class TableSpec:
    """Everything the pipeline knows about one source table.

    ``version`` names the column that makes a row newer than another with the
    same key; without it the latest ingestion wins. Stored rows are clustered by
    ``cluster`` (by default the first merge key) and partitioned by the months of ``month``.
    """

    name: str
    source_file: str
    columns: tuple[str, ...]
    merge_keys: tuple[str, ...]
    dedup_keys: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    lookup: Lookup | None = None
    collapse: Collapse | None = None
    version: str | None = None
    cluster: tuple[str, ...] = ()
    month: str | None = None
    csv_options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.merge_keys:
            raise ValueError(f"{self.name}: merge_keys are required")

    @property
    def unique_keys(self) -> tuple[str, ...]:
        return self.dedup_keys or self.merge_keys

    @property
    def csv_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


def _rules(action: str, *columns: str, **kw: str) -> tuple[Rule, ...]:
    return tuple(Rule(c, action, **kw) for c in columns)


# Source file names, column names (spelling as delivered), keys,
# rules and defaults of the nine retail source tables.
REFERENCE_SPECS = {s.name: s for s in (
    TableSpec(
        "category_translation", "product_category_name_translation.csv",
        ("product_category_name", "product_category_name_english"),
        merge_keys=("product_category_name",), dedup_keys=("product_category_name",),
    ),
    TableSpec(
        "geolocation", "geolocation_dataset.csv",
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
         "geolocation_city", "geolocation_state"),
        merge_keys=("geolocation_zip_code_prefix",),
        rules=_rules("cast_string", "geolocation_zip_code_prefix")
        + _rules("cast_double", "geolocation_lat", "geolocation_lng"),
        collapse=Collapse(
            ("geolocation_zip_code_prefix",),
            {"geolocation_lat": "avg", "geolocation_lng": "avg",
             "geolocation_city": "first", "geolocation_state": "first"},
        ),
    ),
    TableSpec(
        "sellers", "sellers_dataset.csv",
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        merge_keys=("seller_id",), dedup_keys=("seller_id",),
        rules=_rules("initcap_trim", "seller_city") + _rules("upper_trim", "seller_state")
        + _rules("cast_string", "seller_zip_code_prefix"),
    ),
    TableSpec(
        "customers", "customers_dataset.csv",
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix",
         "customer_city", "customer_state"),
        merge_keys=("customer_id",), dedup_keys=("customer_id",),
        rules=_rules("initcap_trim", "customer_city") + _rules("upper_trim", "customer_state")
        + _rules("cast_string", "customer_zip_code_prefix"),
    ),
    TableSpec(
        "products", "products_dataset.csv",
        ("product_id", "product_category_name", "product_name_lenght",
         "product_description_lenght", "product_photos_qty", "product_weight_g",
         "product_length_cm", "product_height_cm", "product_width_cm"),
        merge_keys=("product_id",), dedup_keys=("product_id",),
        rules=(
            Rule("product_name_lenght", "rename", new_name="product_name_length"),
            Rule("product_description_lenght", "rename", new_name="product_description_length"),
            Rule("product_category_name", "fill_null", default="unknown"),
        )
        + _rules("cast_int", "product_name_length", "product_description_length",
                 "product_photos_qty")
        + _rules("cast_double", "product_weight_g", "product_length_cm",
                 "product_height_cm", "product_width_cm"),
        lookup=Lookup("category_translation", "product_category_name", "left",
                      {"product_category_name_english": "unknown"}),
    ),
)}

TRANSACTIONAL_SPECS = {s.name: s for s in (
    TableSpec(
        "orders", "orders_dataset.csv",
        ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
         "order_approved_at", "order_delivered_carrier_date",
         "order_delivered_customer_date", "order_estimated_delivery_date"),
        merge_keys=("order_id",), dedup_keys=("order_id",), month="order_purchase_timestamp",
        rules=_rules("to_timestamp", "order_purchase_timestamp", "order_approved_at",
                     "order_delivered_carrier_date", "order_delivered_customer_date",
                     "order_estimated_delivery_date"),
    ),
    TableSpec(
        "order_items", "order_items_dataset.csv",
        ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
        merge_keys=("order_id", "order_item_id"), dedup_keys=("order_id", "order_item_id"),
        rules=_rules("cast_int", "order_item_id")
        + _rules("cast_double", "price", "freight_value"),
    ),
    TableSpec(
        "order_payments", "order_payments_dataset.csv",
        ("order_id", "payment_sequential", "payment_type", "payment_installments",
         "payment_value"),
        merge_keys=("order_id", "payment_sequential"),
        rules=(Rule("payment_type", "replace_value", old="not_defined", new="unknown"),)
        + _rules("cast_double", "payment_value")
        + _rules("cast_int", "payment_installments", "payment_sequential"),
    ),
    TableSpec(
        "order_reviews", "order_reviews_dataset.csv",
        ("review_id", "order_id", "review_score", "review_comment_title",
         "review_comment_message", "review_creation_date", "review_answer_timestamp"),
        merge_keys=("review_id",), dedup_keys=("review_id",), cluster=("order_id",),
        rules=_rules("cast_int", "review_score")
        + _rules("fill_null", "review_comment_title", "review_comment_message")
        + _rules("to_timestamp", "review_creation_date", "review_answer_timestamp"),
        version="review_answer_timestamp",
    ),
)}

ALL_SPECS = REFERENCE_SPECS | TRANSACTIONAL_SPECS

# Column order and types of the nine published tables.
CONTRACT_DDL = {
    "dim_customers":
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string",
    "dim_sellers":
        "seller_id string, seller_zip_code_prefix string, seller_city string, "
        "seller_state string, seller_lat double, seller_lng double",
    "dim_products":
        "product_id string, product_category_name string, "
        "product_category_name_english string, product_name_length int, "
        "product_description_length int, product_photos_qty int, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double",
    "dim_geolocation":
        "geolocation_zip_code_prefix string, geolocation_lat double, "
        "geolocation_lng double, geolocation_city string, geolocation_state string",
    "fact_order_items":
        "order_id string, order_item_id int, customer_id string, product_id string, "
        "seller_id string, price double, freight_value double, total_amount double, "
        "payment_value double, payment_type string, avg_installments double, "
        "order_status string, purchase_timestamp timestamp, delivered_date timestamp, "
        "order_estimated_delivery_date timestamp, review_score double, delivery_days int, "
        "delay_flag int, on_time_flag int",
    "order_summary":
        "order_id string, total_items int, total_price double, total_freight double, "
        "total_amount double, order_status string, purchase_date timestamp, "
        "delivered_date timestamp, delivery_days int",
    "customer_metrics":
        "customer_id string, total_orders int, total_spent double, avg_order_value double, "
        "last_order_date timestamp, avg_review_score double",
    "seller_performance":
        "seller_id string, total_orders int, total_revenue double, avg_review_score double, "
        "on_time_delivery_rate double, avg_delivery_days double",
    "product_performance":
        "product_id string, total_quantity int, total_sales double, avg_price double, "
        "avg_review_score double",
}


def contract(name: str) -> T.StructType:
    """Published schema of one table (needs a running session to parse)."""
    return T.StructType.fromDDL(CONTRACT_DDL[name])
