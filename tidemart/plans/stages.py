"""The stages that store each layer: raw batches, curated tables, star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.clean import clean
from tidemart.operators.skew import hot_slots
from tidemart.plans import gold
from tidemart.plans.refresh import ROLLUPS, stored_state
from tidemart.session import frees_shuffles
from tidemart.sources.bronze import has_batch, read_batch, write_batch
from tidemart.sources.csv import batch_path, scan_csv, with_audit
from tidemart.sources.ledger import Ledger
from tidemart.sources.publish import name_in_catalog, publish, published
from tidemart.sources.tables import StoredTable, database_at, read_first
from tidemart.specs import (
    CONTRACT_DDL, REFERENCE_SPECS, TRANSACTIONAL_SPECS, TableSpec, contract,
)

BATCHES = ("1", "2", "3", "4")
#: Keys of the star-schema tables that grow with the orders.
GOLD_KEYS = {"fact_order_items": ("order_id", "order_item_id"), "order_summary": ("order_id",),
             **{name: (r.key,) for name, r in ROLLUPS.items()}}


@dataclass
class Lake:
    """Where the layers live and which specs they follow.

    ``buckets`` divides each growing table; choose it so that a bucket is about a task's
    share, since joins of the layers run bucket by bucket: see ``buckets_for``. ``stamp_live`` adds ``cdc_merge_timestamp`` to rows
    that came by the live path.
    """

    spark: SparkSession
    root: str
    reference: Mapping[str, TableSpec] = field(default_factory=lambda: REFERENCE_SPECS)
    transactional: Mapping[str, TableSpec] = field(default_factory=lambda: TRANSACTIONAL_SPECS)
    buckets: int = 64
    stamp_live: bool = False

    def __post_init__(self) -> None:
        self.database = database_at(self.spark, self.root)

    def _table(self, layer: str, name: str, **layout) -> StoredTable:
        return StoredTable(self.spark, f"{self.database}.{layer}_{name}",
                           f"{self.root}/{layer}/{name}", buckets=self.buckets, **layout)

    def bronze_path(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def bronze_table(self, name: str) -> StoredTable:
        """Raw reference table: always replaced."""
        return self._table("bronze", name)

    def silver(self, name: str) -> StoredTable:
        spec = self.transactional.get(name)
        if not spec:
            return self._table("silver", name)
        return self._table("silver", name, keys=spec.merge_keys, cluster=spec.cluster,
                           month=spec.month)

    def gold(self, name: str) -> StoredTable:
        """A star-schema table as it is stored; rollups as sums and counts."""
        return self._table("gold", name, keys=GOLD_KEYS.get(name, ()))

    def read_gold(self, name: str) -> DataFrame:
        rows = self.gold(name).read()
        if name not in ROLLUPS:
            return rows
        return ROLLUPS[name].metrics(rows.where("lines > 0"))

    def export_path(self, name: str) -> str:
        return f"{self.root}/warehouse/{name}"

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger")


@dataclass
class StageResult:
    """Rows written per table and the tables that failed, with the error."""

    rows: dict[str, int] = field(default_factory=dict)
    errors: dict[str, Exception] = field(default_factory=dict)
    skipped: bool = False


def side_by_side(jobs: Mapping[str, Callable[[], int]], result: StageResult,
                 workers: int = 4) -> None:
    """Submit the writes of independent tables together, so that a small table does not
    leave the cluster idle. Each thread only submits; Spark shares out the tasks."""
    with ThreadPoolExecutor(workers) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    for name, job in running.items():
        if job.exception() is None:
            result.rows[name] = job.result()
        else:
            result.errors[name] = job.exception()


def raise_first(result: StageResult) -> StageResult:
    for error in result.errors.values():
        raise error
    return result


def _check(batch: str) -> str:
    if str(batch) not in BATCHES:
        raise ValueError(f"unknown batch {batch!r}: expected one of {', '.join(BATCHES)}")
    return str(batch)


@frees_shuffles
def run_bronze(lake: Lake, raw: str, batch: str) -> StageResult:
    """Load one batch folder. Batch 1 also loads the reference tables.

    A batch the ledger knows is skipped. A failing table does not stop the others, but
    the batch is entered in the ledger only when all tables succeeded; the retry then
    replaces the partitions already written instead of adding to them.
    """
    batch = _check(batch)
    result = StageResult()
    if lake.ledger.is_done(batch, "bronze"):
        result.skipped = True
        return result

    def load(name: str, spec: TableSpec) -> int:
        rows = with_audit(scan_csv(lake.spark, batch_path(raw, batch, spec), spec),
                          f"batch_{batch}", source_file=spec.source_file)
        if name in lake.reference:
            return lake.bronze_table(name).overwrite(rows)
        return write_batch(rows, lake.bronze_path(name))

    tables = {**(lake.reference if batch == "1" else {}), **lake.transactional}
    side_by_side({n: partial(load, n, s) for n, s in tables.items()}, result)
    if not result.errors:
        lake.ledger.mark_done(batch, "bronze", sum(result.rows.values()))
    return result


@frees_shuffles
def run_silver(lake: Lake, batch: str) -> StageResult:
    """Clean one batch. Batch 1 replaces every curated table; later batches are upserted
    into the transactional tables, reading only their own partition."""
    batch = _check(batch)
    result, batch_id = StageResult(), f"batch_{batch}"

    def reference(name: str, spec: TableSpec) -> int:
        lookup = None
        if spec.lookup:
            lookup = read_first(lake.silver(spec.lookup.table),
                                lake.bronze_table(spec.lookup.table))
        table = lake.silver(name)
        rows = table.overwrite(clean(lake.bronze_table(name).read(), spec, lookup))
        table.analyze(*spec.merge_keys)     # others look values up by these
        return rows

    def transactional(name: str, spec: TableSpec) -> int:
        raw = read_batch(lake.spark, lake.bronze_path(name), batch_id)
        rows = clean(raw, spec)
        unique = spec.unique_keys == spec.merge_keys
        if batch == "1":
            return lake.silver(name).overwrite(rows)
        return lake.silver(name).upsert(rows, spec.version, unique=unique)

    first = {n: partial(transactional, n, s) for n, s in lake.transactional.items()
             if has_batch(lake.spark, lake.bronze_path(n), batch_id)}
    then = {}
    if batch == "1":
        for name, spec in lake.reference.items():
            (then if spec.lookup else first)[name] = partial(reference, name, spec)
    side_by_side(first, result)
    side_by_side(then, result)
    return raise_first(result)


@frees_shuffles
def build_gold(lake: Lake, names: tuple[str, ...] = tuple(CONTRACT_DDL)) -> StageResult:
    """Rebuild the star schema. The aggregates read the stored fact, so it is computed
    once. Orders, lines, payments and reviews are stored in the same buckets of ``order_id``,
    so the fact is joined without a shuffle; only hot orders are spread by one."""
    result = StageResult()
    read = lambda n: lake.silver(n).read()

    def write_fact() -> int:
        items = read("order_items")
        hot = hot_slots(items, ["order_id"])
        rows = gold.fact_order_items(read("orders"), items, read("order_payments"),
                                     read("order_reviews"), hot)
        return lake.gold("fact_order_items").overwrite(rows, placed=not hot)

    stored_fact = lambda: lake.gold("fact_order_items").read()
    rolled = lambda name: lambda: stored_state(ROLLUPS[name], stored_fact())
    builders = {
        "dim_customers": lambda: read("customers"),
        "dim_sellers": lambda: gold.dim_sellers(read("sellers"), read("geolocation")),
        "dim_products": lambda: read("products"),
        "dim_geolocation": lambda: read("geolocation"),
        **{name: rolled(name) for name in ROLLUPS},
    }
    writers = {n: partial(lambda n: lake.gold(n).overwrite(builders[n]()), n) for n in builders}
    writers["fact_order_items"] = write_fact
    writers["order_summary"] = lambda: lake.gold("order_summary").overwrite(
        gold.order_summary(stored_fact()), placed=True)
    from_fact = ("order_summary", *ROLLUPS)
    for stage in ([n for n in names if n not in from_fact], [n for n in names if n in from_fact]):
        side_by_side({n: writers[n] for n in stage}, result)
        raise_first(result)
    return result


@frees_shuffles
def export_warehouse(lake: Lake) -> dict[str, DataFrame]:
    """Load every star-schema table into its typed contract, bad rows set aside, and name the
    loaded rows in the lake's database, as the dashboard functions ask for them. A table
    whose load fails keeps its old rows; the others are loaded."""
    loaded = StageResult()

    def load(name: str) -> int:
        rows = publish(lake.read_gold(name), contract(name), lake.export_path(name))
        name_in_catalog(lake.spark, lake.export_path(name), contract(name),
                        f"{lake.database}.{name}")
        return rows

    side_by_side({n: partial(load, n) for n in CONTRACT_DDL}, loaded)
    raise_first(loaded)
    return {name: published(lake.spark, lake.export_path(name), contract(name))
            for name in CONTRACT_DDL}
