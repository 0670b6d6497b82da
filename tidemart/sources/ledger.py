"""Which batch finished which stage: a small JSON table, one file per entry."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.sources.paths import exists

FIELDS = "status string, rows bigint, completed_at string, batch string, stage string"
DONE, RESET = "completed", "reset"


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], FIELDS)
        return self.spark.read.schema(FIELDS).json(self.path)

    def status(self) -> DataFrame:
        """All entries in order, for a health check."""
        return self.entries().select("batch", "stage", "status", "rows", "completed_at").orderBy(
            "batch", "stage")

    def is_done(self, batch: str, stage: str) -> bool:
        hit = self.entries().where(
            (F.col("batch") == str(batch)) & (F.col("stage") == stage)
            & (F.col("status") == DONE))
        return not hit.isEmpty()

    def pending(self, requested: DataFrame, stage: str) -> DataFrame:
        """Rows of ``requested`` (column ``batch``) whose stage is not done."""
        done = self.entries().where((F.col("stage") == stage) & (F.col("status") == DONE))
        return requested.join(done.select("batch"), "batch", "left_anti")

    def _put(self, batch: str, stage: str, status: str, rows: int) -> None:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        entry = self.spark.createDataFrame([(status, rows, now, str(batch), stage)], FIELDS)
        (entry.coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch", "stage").json(self.path))

    def mark_done(self, batch: str, stage: str, rows: int = 0) -> None:
        self._put(batch, stage, DONE, rows)

    def reset(self, batch: str, stage: str = "bronze") -> None:
        """Let the stage run again."""
        self._put(batch, stage, RESET, 0)
