"""Typed tables for the warehouse: columns by name, bad rows set aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sources.tables import StoredTable, database_at, quoted

LOADED, REJECTED = "loaded", "rejected"


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract columns in contract order and type, plus ``load_status`` and, for a
    rejected row, the names of the failing columns and the row as JSON.

    Names match ignoring case; a column the data lacks is NULL, others are ignored.
    """
    have = {c.lower(): c for c in df.columns}
    values, failures = [], []
    for f in contract.fields:
        if f.name.lower() not in have:
            values.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f"`{have[f.name.lower()]}`")
        typed = raw.try_cast(f.dataType)
        values.append(typed.alias(f.name))
        if df.schema[have[f.name.lower()]].dataType != f.dataType:
            failures.append(F.when(raw.isNotNull() & typed.isNull(), F.lit(f.name)))
    bad = F.array_compact(F.array(*failures)) if failures else F.array().cast("array<string>")
    rejected = F.size(bad) > 0
    return df.select(
        *values,
        F.when(rejected, F.concat_ws(",", bad)).alias("failed_columns"),
        F.when(rejected, F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
        .alias("raw_row"),
        F.when(rejected, F.lit(REJECTED)).otherwise(F.lit(LOADED)).alias("load_status"))


def _stored(spark: SparkSession, path: str) -> StoredTable:
    return StoredTable(spark, f"{database_at(spark, path)}.published", path)


def publish(df: DataFrame, contract: T.StructType, path: str) -> int:
    """Write one table in a single pass, good and bad rows told apart by ``load_status``. The
    rows go to a folder of their own, and the catalog is switched to it when all are
    written: a failed job leaves the old table. Returns the rows written."""
    return _stored(df.sparkSession, path).overwrite(conform(df, contract))


def _read(spark: SparkSession, path: str, status: str) -> DataFrame:
    return _stored(spark, path).read().where(F.col("load_status") == status)


def published(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    return _read(spark, path, LOADED).select(*contract.fieldNames())


def quarantined(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    return _read(spark, path, REJECTED).select("failed_columns", "raw_row")


def name_in_catalog(spark: SparkSession, path: str, contract: T.StructType, view: str) -> None:
    """A view of the loaded rows; it follows the table from one load to the next."""
    columns = ", ".join(f"`{c}`" for c in contract.fieldNames())
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM "
              f"{_stored(spark, path).name} WHERE load_status = {quoted(LOADED)}")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Load audit: one row per table. Each count reads footers only when the table is
    stored; nothing is sent to the driver."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")
