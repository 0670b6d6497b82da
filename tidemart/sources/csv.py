"""CSV readers. Every column is read as text and typed by the cleaning rules, so
no inference job runs, leading zeros survive and types cannot drift by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.specs import TableSpec


def scan_csv(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Read by header name; columns the spec does not know are kept as text.

    ``path`` may be a file, a folder or a glob. Files of one call share a header: one with
    other columns, or in another order, is an error and never read by position.
    """
    df = (spark.read.option("header", True).option("enforceSchema", False)
          .options(**spec.csv_options).csv(path))
    missing = {c.lower() for c in spec.columns} - {c.lower() for c in df.columns}
    if missing:
        raise ValueError(f"{path}: columns missing from the header: {sorted(missing)}")
    return df


def scan_declared(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Read with the declared columns only; a different header is an error."""
    return (spark.read.schema(spec.csv_schema).option("header", True)
            .option("enforceSchema", False).options(**spec.csv_options).csv(path))


def batch_path(raw: str, batch: int | str, spec: TableSpec) -> str:
    return f"{raw}/batch_{batch}/{spec.source_file}"


def live_glob(live: str, spec: TableSpec) -> str:
    """Live files carry a timestamp before the table's file name."""
    return f"{live}/*{spec.source_file}"


def with_audit(df: DataFrame, batch_id: str, load_id: str = "0",
               source_file: str | None = None) -> DataFrame:
    """Tag rows with when, from where and in which batch they came. A stream has
    already noted the source file; for a batch it is given or read from the scan."""
    tags = {
        "ingestion_timestamp": F.current_timestamp(),
        "batch_id": F.lit(batch_id),
        "load_id": F.lit(load_id),
    }
    if source_file:
        tags["source_file"] = F.lit(source_file)
    elif "source_file" not in df.columns:
        tags["source_file"] = F.col("_metadata.file_name")
    return df.withColumns(tags)


def enforce_types(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply only the cast rules, at ingest; columns absent from the file are skipped."""
    have = {c.lower(): c for c in df.columns}
    types = {"cast_string": "string", "cast_double": "double", "cast_int": "int"}
    casts = {have[r.column.lower()]: F.col(r.column).try_cast(types[r.action])
             for r in spec.rules if r.action in types and r.column.lower() in have}
    return df.withColumns(casts) if casts else df
