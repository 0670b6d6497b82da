"""The star schema brought up to date with a batch, from the orders that the batch changed.

The fact rows of changed orders are made anew and replace the old ones. Customer, seller and
product tables are stored as sums and counts; the old contributions of the changed orders are
taken out and the new ones added. Only a last date that was taken out, and not followed by a
later one, is looked up again, for its customers alone.

A run keeps its old and new fact rows below the lake, and each stored sum names the last run
that changed it, so a run that was cut off goes on where it stopped and counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.plans import gold
from tidemart.session import frees_shuffles
from tidemart.sources.bronze import has_batch, read_batch
from tidemart.sources.paths import exists
from tidemart.sources.tables import StoredTable

#: The last run that changed a stored sum.
APPLIED = "applied"


@dataclass(frozen=True)
class Rollup:
    """A table of sums and counts per key; ``maxima`` maps other columns to the fact column
    whose largest value they hold."""

    key: str
    state: Callable[[DataFrame], DataFrame]
    metrics: Callable[[DataFrame], DataFrame]
    maxima: Mapping[str, str] = field(default_factory=dict)


ROLLUPS = {
    "customer_metrics": Rollup("customer_id", gold.customer_state, gold.customers_of,
                               {"last_order_date": "purchase_timestamp"}),
    "seller_performance": Rollup("seller_id", gold.seller_state, gold.sellers_of),
    "product_performance": Rollup("product_id", gold.product_state, gold.products_of),
}


def kept(frame: DataFrame, path: str) -> DataFrame:
    """Rows written to a folder and read back; an earlier, complete write is used as it is."""
    spark = frame.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def stored_state(rollup: Rollup, fact: DataFrame) -> DataFrame:
    """The state of all fact rows, as it is stored. Rows without a key are not rolled up."""
    rows = rollup.state(fact.where(F.col(rollup.key).isNotNull()))
    return rows.withColumn(APPLIED, F.lit(None).cast("string"))


def changed_orders(lake, batch_id: str, loads: Sequence[str] | None = None) -> DataFrame:
    """Distinct ``order_id`` of all rows of one batch, or of some of its loads."""
    found = []
    for name in lake.transactional:
        path = lake.bronze_path(name)
        if has_batch(lake.spark, path, batch_id):
            rows = read_batch(lake.spark, path, batch_id)
            if loads is not None:
                rows = rows.where(F.col("load_id").isin(list(loads)))
            found.append(rows.select("order_id"))
    if not found:
        return lake.spark.createDataFrame([], "order_id string")
    return reduce(DataFrame.unionByName, found).where("order_id is not null").distinct()


def merge_state(table: StoredTable, rollup: Rollup, old: DataFrame, new: DataFrame,
                fact: StoredTable, run: str, folder: str) -> int:
    """Replace the contributions of ``old`` fact rows by those of ``new`` ones in a stored
    state. Keys that are left without a line keep a row with zero lines. ``fact`` already
    holds the new rows."""
    key, maxima = rollup.key, list(rollup.maxima)
    gone, come = rollup.state(old), rollup.state(new)
    sums = [c for c in come.columns if c != key and c not in maxima]
    kinds = {f.name: f.dataType for f in table.read().schema.fields}

    def side(df: DataFrame, sign: int, name: str, other: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(
            key, *((F.col(c) * sign).cast(kinds[c]).alias(f"_d_{c}") for c in sums),
            *(F.col(c).alias(f"_{name}_{c}") for c in maxima),
            *(F.lit(None).cast(kinds[c]).alias(f"_{other}_{c}") for c in maxima))

    delta = side(come, 1, "new", "old").unionByName(side(gone, -1, "old", "new"))
    delta = kept(delta.groupBy(key).agg(
        *(F.sum(f"_d_{c}").cast(kinds[c]).alias(f"_d_{c}") for c in sums),
        *(F.max(f"_{w}_{c}").alias(f"_{w}_{c}") for w in ("new", "old") for c in maxima)),
        f"{folder}/delta")
    have = table.rows_of(delta)
    both = delta.join(have, key, "left").where(~F.col(APPLIED).eqNullSafe(F.lit(run)))
    look = {c: F.coalesce(F.col(f"_old_{c}") == F.col(c), F.lit(False)) & ~F.coalesce(
        F.col(f"_new_{c}") >= F.col(c), F.lit(False)) for c in maxima}
    made = both.select(
        key, *((F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_d_{c}"), F.lit(0)))
               .cast(kinds[c]).alias(c) for c in sums),
        *(F.when(~look[c], F.greatest(c, f"_new_{c}")).alias(c) for c in maxima),
        *(look[c].alias(f"_look_{c}") for c in maxima), F.lit(run).alias(APPLIED))
    for c in maxima:
        keys = made.where(f"_look_{c}").select(key)
        if not keys.isEmpty():
            again = fact.read().join(keys, key, "left_semi").groupBy(key).agg(
                F.max(rollup.maxima[c]).alias("_again"))
            made = made.join(again, key, "left").withColumn(
                c, F.coalesce(F.col(c), F.col("_again"))).drop("_again")
    return table.upsert(made.select(*kinds), unique=True)


@frees_shuffles
def refresh_gold(lake, changed: DataFrame, run: str | None = None) -> dict[str, int]:
    """Bring the fact, the order summary and the rollups up to date for the orders in
    ``changed`` (column ``order_id``). Returns the rows written per table.

    What is read and written are the partitions of these orders and of the customers, sellers
    and products in them. ``run`` names the run: calling it again with the same name, after a
    failure, finishes it and counts nothing twice. Lines are never deleted by the upserts of
    the layers below, so no fact row has to be.
    """
    run = run or uuid4().hex
    folder = f"{lake.root}/refresh/{run}"
    changed = kept(changed.select("order_id").distinct(), f"{folder}/changed")
    fact = lake.gold("fact_order_items")
    of = lambda name: lake.silver(name).rows_of(changed)
    old = kept(fact.rows_of(changed), f"{folder}/old")
    new = kept(gold.fact_order_items(of("orders"), of("order_items"), of("order_payments"),
                                     of("order_reviews")), f"{folder}/new")
    written = {"fact_order_items": fact.upsert(new, unique=True)}
    written["order_summary"] = lake.gold("order_summary").upsert(
        gold.order_summary(new), unique=True)
    for name, rollup in ROLLUPS.items():
        written[name] = merge_state(lake.gold(name), rollup, old, new, fact, run,
                                    f"{folder}/{name}")
    return written
