"""Live path: a file stream into the raw layer and an upsert into the curated one."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.clean import clean_live
from tidemart.operators.counting import StreamCounts
from tidemart.plans.stages import Lake
from tidemart.session import frees_shuffles
from tidemart.sources.bronze import LIVE_BATCH, read_batch, write_batch
from tidemart.sources.csv import live_glob, with_audit
from tidemart.specs import TableSpec

EVERY_15_MINUTES = {"processingTime": "15 minutes"}
ONCE = {"availableNow": True}
FILES_AT_ONCE = 1000


def read_live(spark: SparkSession, live: str, spec: TableSpec, archive: str | None = None,
              files_per_trigger: int | None = None, once_within: str | None = None) -> DataFrame:
    """New live files of one table, whatever timestamp precedes the file name. With
    ``archive`` a processed file is moved there when a later batch completes. With
    ``once_within``, such as ``2 hours``, a row that arrives again within that time, unchanged and
    in another file or batch, is dropped; Spark forgets older rows, so its state is bounded."""
    reader = (spark.readStream.schema(spec.csv_schema).option("header", True)
              .option("enforceSchema", False).options(**spec.csv_options))
    rows = _reader(reader, files_per_trigger, archive).csv(live_glob(live, spec)).withColumn(
        "source_file", F.col("_metadata.file_name"))
    return arrived_once(rows, spec.columns, once_within) if once_within else rows


def new_files(spark: SparkSession, live: str, spec: TableSpec, archive: str | None = None,
              files_per_trigger: int | None = None) -> DataFrame:
    """``path`` of each new live file; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    return _reader(reader, files_per_trigger or FILES_AT_ONCE, archive).load(
        live_glob(live, spec)).select("path")


def scan_evolving(paths: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of CSV files with columns that the spec does not know, or in another order. The
    unknown ones are kept in a VARIANT column, ``rescued`` (NULL where there are none), so a new
    column stops no stream and can be read out later. A declared column that a file lacks is
    NULL. Files are read together with those that have the same header; ``paths`` are
    those of one micro-batch, at most ``FILES_AT_ONCE`` unless asked otherwise."""
    spark, by_header = paths.sparkSession, defaultdict(list)
    reader = spark.read.option("header", True).option("enforceSchema", False).options(
        **spec.csv_options)
    for row in paths.collect():
        by_header[tuple(reader.csv(row["path"]).columns)].append(row["path"])
    frames = []
    for header, files in by_header.items():
        rows = reader.csv(files)
        known = {c.lower(): c for c in header}
        rest = [c for c in header if c.lower() not in {k.lower() for k in spec.columns}]
        rescued = F.lit(None).cast("string")
        if rest:
            rescued = F.nullif(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rest))), F.lit("{}"))
        frames.append(rows.select(
            *(F.col(f"`{known[c.lower()]}`").alias(c) if c.lower() in known
              else F.lit(None).cast("string").alias(c) for c in spec.columns),
            F.parse_json(rescued).alias("rescued"),
            F.col("_metadata.file_name").alias("source_file")))
    if not frames:
        schema = T.StructType([*spec.csv_schema, T.StructField("rescued", T.VariantType()),
                               T.StructField("source_file", T.StringType())])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, frames)


def _reader(reader, files_per_trigger: int | None, archive: str | None):
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader


def arrived_once(rows: DataFrame, columns: tuple[str, ...], within: str) -> DataFrame:
    """Rows that did not arrive before, by the time their file was written."""
    return (rows.withColumn("arrived_at", F.col("_metadata.file_modification_time"))
            .withWatermark("arrived_at", within)
            .dropDuplicatesWithinWatermark(list(columns)).drop("arrived_at"))


def load_name(checkpoint: str, batch: int) -> str:
    """Partition of one micro-batch. It carries the checkpoint's identity: a new
    checkpoint counts from 0 again and must not replace older loads."""
    return f"{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}_{batch:09d}"


def ingest_step(lake: Lake, spec: TableSpec, checkpoint: str, merge: bool = True,
                on_rows: Callable[[int], None] = lambda n: None, evolving: bool = False
                ) -> Callable[[DataFrame, int], None]:
    """Work on one micro-batch. Each step may run again after a failure: the raw
    partition is replaced and the upsert of the same rows changes nothing."""
    path = lake.bronze_path(spec.name)

    def step(rows: DataFrame, batch: int) -> None:
        load = load_name(checkpoint, batch)
        if evolving:
            rows = scan_evolving(rows, spec)
        written = write_batch(with_audit(rows, LIVE_BATCH, load), path)
        on_rows(written)
        if merge and written:
            stored = read_batch(rows.sparkSession, path, LIVE_BATCH, load)
            cleaned = clean_live(stored.drop("rescued"), spec)
            if lake.stamp_live:
                cleaned = cleaned.withColumn("cdc_merge_timestamp", F.current_timestamp())
            lake.silver(spec.name).upsert(cleaned, spec.version)

    return step


def start_live(lake: Lake, live: str, spec: TableSpec, checkpoint: str,
               trigger: dict | None = None, archive: str | None = None,
               files_per_trigger: int | None = None, merge: bool = True,
               on_rows: Callable[[int], None] = lambda n: None,
               once_within: str | None = None, evolving: bool = False) -> StreamingQuery:
    """Start the stream of one table; offsets in ``checkpoint`` keep it incremental.

    ``checkpoint`` and ``archive`` belong on shared storage. ``once_within`` and ``evolving``: see
    ``read_live`` and ``scan_evolving``.
    """
    if evolving and once_within:
        raise ValueError("rows are told apart by declared columns only, so not with evolving")
    rows = (new_files(lake.spark, live, spec, archive, files_per_trigger) if evolving
            else read_live(lake.spark, live, spec, archive, files_per_trigger, once_within))
    return (rows.writeStream.foreachBatch(
        ingest_step(lake, spec, checkpoint, merge, on_rows, evolving))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start())


@frees_shuffles
def run_live(lake: Lake, live: str, checkpoints: str, archive: str | None = None,
             merge: bool = True, files_per_trigger: int | None = None,
             once_within: str | None = None, evolving: bool = False) -> dict[str, int]:
    """Process everything that has arrived for all transactional tables, then return
    the number of new rows per table (0 when there was nothing to do). The streams
    run side by side, as they touch different tables. If one fails, the others are
    finished first; then its error is raised."""
    seen: dict[str, list[int]] = {name: [] for name in lake.transactional}
    started = [
        start_live(lake, live, spec, f"{checkpoints}/{name}", ONCE, archive,
                   files_per_trigger, merge, seen[name].append, once_within, evolving)
        for name, spec in lake.transactional.items()]
    failed: list[Exception] = []
    for stream in started:
        try:
            stream.awaitTermination()
        except Exception as error:      # raised below, when no stream is left running
            failed.append(error)
    if failed:
        raise failed[0]
    return {name: sum(counts) for name, counts in seen.items()}


def live_counts(lake: Lake, live: str, checkpoints: str,
                files_per_trigger: int | None = None) -> DataFrame:
    """``table_name, n, batches``: store what has arrived and report the rows and batches that
    the streams themselves say they have read. A failing read raises its error."""
    counts = StreamCounts()
    lake.spark.streams.addListener(counts)
    try:
        started = {name: start_live(lake, live, spec, f"{checkpoints}/{name}", ONCE, None,
                                    files_per_trigger, merge=False)
                   for name, spec in lake.transactional.items()}
        rows = [(name, *counts.of(stream)) for name, stream in started.items()]
    finally:
        lake.spark.streams.removeListener(counts)
    return lake.spark.createDataFrame(rows, "table_name string, n bigint, batches bigint")
