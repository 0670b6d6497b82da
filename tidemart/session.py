"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import wraps
from uuid import uuid4

from pyspark.sql import SparkSession

# Runtime re-planning does the sizing: partitions are coalesced to the advisory
# size, oversized join partitions are split, and a side is broadcast only when
# its measured size is below Spark's own threshold.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # sizes of filtered tables from their column statistics, where there are any
    "spark.sql.cbo.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidemart", **conf: str) -> SparkSession:
    """A session with the defaults above; keyword names use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Whether Spark deletes the shuffle files of a query when it ends, instead of when the driver
#: happens to collect its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def frees_shuffles(stage: Callable) -> Callable:
    """A stage whose first argument is a lake: the shuffle files of its many queries are freed
    one by one. Outside, the session stays as it was set."""
    @wraps(stage)
    def run(lake, *args, **options):
        before = lake.spark.conf.get(FREED, "false")
        lake.spark.conf.set(FREED, "true")
        try:
            return stage(lake, *args, **options)
        finally:
            lake.spark.conf.set(FREED, before)
    return run


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder that every executor can reach.

    The base is the cluster's ``spark.checkpoint.dir``. A machine-local folder is
    used only on a local master, where all executors share the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidemart-")
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"
