"""Raw layer: Parquet partitioned by batch and load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.counting import counted, rows_seen
from tidemart.sources.paths import exists

LIVE_BATCH = "live_stream"


def write_batch(df: DataFrame, path: str) -> int:
    """Replace exactly the partitions present in ``df``: running a batch again, after
    a failure or by mistake, leaves the same rows. Returns the rows written."""
    df, seen = counted(df, "bronze")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy("batch_id", "load_id").parquet(path))
    return rows_seen(seen)


def read_batch(spark: SparkSession, path: str, batch_id: str,
               load_id: str | None = None) -> DataFrame:
    """Rows of one batch. Only its partition folder is listed and read, and the columns
    are those of all its own loads, so a column new in one of them is seen without merging
    the footers of the whole table."""
    folder = f"{path}/batch_id={batch_id}" + (f"/load_id={load_id}" if load_id else "")
    return spark.read.option("basePath", path).option(
        "mergeSchema", load_id is None).parquet(folder)


def has_batch(spark: SparkSession, path: str, batch_id: str) -> bool:
    return exists(spark, f"{path}/batch_id={batch_id}")
