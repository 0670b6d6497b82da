"""Layer tables in Spark's catalog: Parquet written, partitioned and bucketed by Spark.

A table that is replaced goes to a new folder first and is then switched in the catalog, so a
failed job leaves the old rows. A keyed table is partitioned and also bucketed: by the hash
of its cluster columns, so that joins and sums by these columns need no shuffle. Its
partitions are the months of a timestamp, or the buckets themselves. An upsert reads and
replaces only the partitions it touches, by a join on the partition column (dynamic partition
pruning) and by dynamic partition overwrite. Running the same upsert again repairs one that
was cut off. One writer per table at a time. Tables live as long as the catalog: use a
metastore where they are to outlive the session.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.counting import counted, rows_seen
from tidemart.operators.dedup import latest_per_key
from tidemart.operators.upsert import (
    align_types, any_null, merge_by_key, merge_in_buckets,
)
from tidemart.session import scratch_dir
from tidemart.sources.paths import remove

#: Partition of a row; False in a row that only keeps an emptied partition from staying as it was.
PART, LIVE = "_part", "_live"
#: A bucket is read, joined and sorted by one task: so many rows stay in its memory.
ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int, least: int = 4) -> int:
    """Buckets for tables of which the largest has ``rows`` rows."""
    return max(least, math.ceil(rows / ROWS_PER_BUCKET))


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def database_at(spark: SparkSession, root: str) -> str:
    """The database of a root folder, created on first use."""
    name = f"lake_{hashlib.md5(root.encode(), usedforsecurity=False).hexdigest()[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {quoted(root)}")
    return name


class StoredTable:
    """One table, named ``database.table``, with its files below ``location``.

    ``keys`` make it a keyed table, which ``cluster`` (by default the first key) and ``buckets``
    divide. With ``month`` the partitions are the months of that column, else the buckets;
    a table by months may do without buckets (0).
    ``moves`` tells whether a newer row of a key may belong to another partition; where it
    may, an upsert looks up the partitions of its keys, reading no other column.
    """

    def __init__(self, spark: SparkSession, name: str, location: str, keys: Sequence[str] = (),
                 cluster: Sequence[str] = (), buckets: int = 8, month: str | None = None,
                 moves: bool | None = None):
        self.spark, self.name, self.location = spark, name, location.rstrip("/")
        self.keys, self.buckets, self.month = tuple(keys), buckets, month
        self.cluster = tuple(cluster) or self.keys[:1]
        if self.keys and not buckets and not month:
            raise ValueError(f"{name}: a keyed table needs buckets or months")
        known = not month and set(self.cluster) <= set(self.keys)
        self.moves = not known if moves is None else moves

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        """Current rows. A column added later reads NULL in older files."""
        if not self.exists():
            raise FileNotFoundError(f"no table {self.name}")
        rows = self.spark.table(self.name)
        if LIVE in rows.columns:
            rows = rows.where(LIVE).drop(LIVE)
        return rows.drop(PART)

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """Current rows whose cluster columns equal a row of ``keys``. Only partitions that hold
        such rows are read; a table by months finds them in its cluster columns."""
        by, table = list(self.cluster), self.spark.table(self.name)
        keys = align_types(keys.select(*by), table).where(~any_null(by)).distinct()
        if self.moves:
            parts = table.where(LIVE).join(keys, by, "left_semi").select(PART)
        else:
            parts = keys.select(self._part("").alias(PART))
        found = table.join(self._touched(parts), PART, "left_semi").join(keys, by, "left_semi")
        return (found.where(LIVE).drop(LIVE) if self.moves else found).drop(PART)

    # -- layout -----------------------------------------------------------------

    def _part(self, load: str) -> Column:
        """Partition of a row. Rows without a full key never match a later row; each load
        has a partition for them, which no upsert reads."""
        if self.month:
            part = F.coalesce(F.date_format(self.month, "yyyy-MM"), F.lit("none"))
        else:
            part = F.pmod(F.hash(*self.cluster), F.lit(self.buckets)).cast("string")
        return F.when(any_null(self.keys), F.lit(f"keyless-{load}")).otherwise(part) if load else part

    @staticmethod
    def _touched(parts: DataFrame) -> DataFrame:
        """Distinct partitions to prune by: at most as many rows as the table has folders. The
        condition, true for all, tells Spark that pruning pays."""
        return F.broadcast(parts.where(F.col(PART) > "").distinct())

    def _create(self, name: str, location: str, schema: T.StructType) -> None:
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
        layout = ""
        if self.keys:
            columns += [f"{LIVE} boolean"] * self.moves + [f"{PART} string"]
            by = ", ".join(f"`{c}`" for c in self.cluster)
            layout = f"PARTITIONED BY ({PART}) " + (
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS "
                if self.buckets else "")
        self.spark.sql(
            f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet OPTIONS "
            f"(partitionOverwriteMode 'dynamic') {layout}LOCATION {quoted(location)}")

    def _insert(self, name: str, rows: DataFrame, emptied: Sequence[str] = (),
                placed: bool = False) -> int:
        """Replace the partitions that ``rows`` belong to. Rows are grouped by bucket (or month), so
        a task writes few files; adaptive execution splits one that is far larger than others.
        ``placed`` rows come bucket by bucket and are written as they come."""
        if not self.keys:
            rows, seen = counted(rows, "write")
            rows.write.mode("overwrite").insertInto(name)
            return rows_seen(seen)
        order = self.spark.table(name).columns
        rows = rows.withColumn(PART, self._part(uuid4().hex[:12]))
        if self.moves:
            rows = rows.withColumn(LIVE, F.lit(True))
        if emptied:
            rows = rows.unionByName(self.spark.createDataFrame(
                [(p, False) for p in emptied], f"{PART} string, {LIVE} boolean").coalesce(1),
                allowMissingColumns=True)
        if not placed:
            rows = rows.hint("rebalance", self.buckets, *self.cluster) if self.buckets else (
                rows.hint("rebalance", PART))
        rows, seen = counted(rows, "write")
        rows.select(*order).write.mode("overwrite").insertInto(name)
        return rows_seen(seen) - len(emptied)

    def _add_columns(self, schema: T.StructType) -> None:
        have = {c.lower() for c in self.spark.table(self.name).columns}
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
               if f.name.lower() not in have]
        if new:
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({', '.join(new)})")

    # -- writes -----------------------------------------------------------------

    def overwrite(self, rows: DataFrame, placed: bool = False) -> int:
        """Replace all rows and the schema. Returns the rows written. ``placed`` tells that the
        rows come out of a join or sum in the buckets of this table: the shuffle that deals
        them falls away where Spark finds it so."""
        load = uuid4().hex
        fresh, aside = f"{self.name}_{load}", f"{self.location}/{load}"
        self._create(fresh, aside, rows.schema)
        try:
            written = self._insert(fresh, rows.repartition(self.buckets, *self.cluster)
                                   if placed else rows, placed=placed)
        except Exception:
            self.spark.sql(f"DROP TABLE {fresh}")
            raise
        if not self.keys and self.exists() and (
                self.spark.table(self.name).schema == self.spark.table(fresh).schema):
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION {quoted(aside)}")
            self.spark.sql(f"DROP TABLE {fresh}")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {self.name}")
        return written

    def analyze(self, *columns: str) -> None:
        """Let Spark count rows and collect statistics of columns, so that it can tell what is
        left of this table after a filter or join, and broadcast it or not."""
        names = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(f"ANALYZE TABLE {self.name} COMPUTE STATISTICS FOR "
                       + (f"COLUMNS {names}" if columns else "ALL COLUMNS"))

    def upsert(self, source: DataFrame, version_col: str | None = None,
               unique: bool = False) -> int:
        """Insert new keys and replace known ones; a missing table is created. Returns the rows
        written: the source and what else is in the partitions it touches.

        With ``version_col`` a row older than the stored one is ignored. ``unique`` promises one
        source row per key and saves the dedup. Running the same source twice gives the same
        keyed rows; rows without a key are inserted each time, as in a SQL MERGE.
        """
        latest = source if unique else latest_per_key(source, self.keys, version_col)
        if not self.exists():
            return self.overwrite(latest)
        # written once: its partitions, its keys and its rows are all needed
        path = scratch_dir(self.spark, "upsert")
        aligned, seen = counted(align_types(latest, self.read()), "feed")
        try:
            aligned.write.parquet(path)
            if not rows_seen(seen):
                return 0
            return self._upsert_feed(self.spark.read.schema(aligned.schema).parquet(path),
                                     version_col)
        finally:
            remove(self.spark, path)

    def _upsert_feed(self, feed: DataFrame, version_col: str | None) -> int:
        self._add_columns(feed.schema)
        table = self.spark.table(self.name)
        # rows without a key touch no partition that is there already
        touched = self._touched(feed.where(~any_null(self.keys)).select(
            self._part("").alias(PART)))
        if not self.moves:
            old = table.join(touched, PART, "left_semi").drop(PART)
            return self._replace(old, feed, version_col)
        found = table.where(LIVE).join(feed.select(*self.keys).distinct(), list(self.keys),
                                       "left_semi").select(PART).distinct()
        # the names of folders: needed to read them, and to mark those that may end up empty
        parts = [r[PART] for r in touched.unionByName(found).distinct().collect()]
        old = table.where(F.col(PART).isin(parts) & F.col(LIVE)).drop(LIVE, PART)
        return self._replace(old, feed, version_col, parts)

    def _replace(self, old: DataFrame, feed: DataFrame, version_col: str | None,
                 parts: Sequence[str] = ()) -> int:
        """Write old rows and a feed merged. The feed is dealt out once, by bucket, and the old
        rows stay in theirs, but not where a bucket is far too large for one task: adaptive
        execution splits such a one."""
        if self.buckets and set(self.cluster) <= set(self.keys):
            bucket = F.pmod(F.hash(*self.cluster), F.lit(self.buckets)).alias("bucket")
            largest = old.select(bucket).unionAll(feed.select(bucket)).groupBy("bucket").agg(
                F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
            if (largest or 0) <= 4 * ROWS_PER_BUCKET:
                return self._insert(self.name, merge_in_buckets(
                    old, feed, self.keys, self.cluster, self.buckets, version_col), parts, True)
        return self._insert(self.name, merge_by_key(old, feed, self.keys, version_col), parts)


def register(spark: SparkSession, name: str, table: StoredTable) -> None:
    """Make the current rows of a table available to SQL under ``name``; calling it
    again after a write moves the name to the new rows."""
    table.read().createOrReplaceTempView(name)


def register_location(spark: SparkSession, name: str, location: str) -> None:
    """Catalog entry for a Parquet folder; an entry for another folder is replaced."""
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING PARQUET LOCATION {quoted(location)}")


def missing_tables(spark: SparkSession, names: Sequence[str], database: str) -> DataFrame:
    """Names from a contract list that the catalog does not have."""
    have = [(t.name,) for t in spark.catalog.listTables(database)]
    want = spark.createDataFrame([(n,) for n in names], "table_name string")
    return want.join(spark.createDataFrame(have, "table_name string"), "table_name", "left_anti")


def read_first(*tables: StoredTable | DataFrame | None) -> DataFrame:
    """First table that exists, in order of preference (curated, then raw)."""
    for table in tables:
        if isinstance(table, DataFrame):
            return table
        if table is not None and table.exists():
            return table.read()
    raise FileNotFoundError("none of the tables exists")
