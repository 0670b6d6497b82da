"""Equal-width histogram over a bounded result (a top-k report)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def equal_width(top_k: DataFrame, value: str, bins: int) -> DataFrame:
    """Rows per bin between the smallest and largest value, and the mean over all bins;
    the largest value belongs to the last bin. The input is the output of a LIMIT, so
    the unpartitioned window sees at most k rows, which already sit in one partition."""
    everything = Window.partitionBy()
    last = F.lit(bins).cast("bigint")
    ranged = top_k.where(F.col(value).isNotNull()).select(
        F.col(value).alias("x"),
        F.min(value).over(everything).alias("lo"),
        F.max(value).over(everything).alias("hi"),
        F.round(F.avg(value).over(everything), 1).alias("mean"))
    binned = ranged.withColumn(
        "bin", F.when(F.col("lo") == F.col("hi"), F.lit(1).cast("bigint"))
        .otherwise(F.least(F.width_bucket("x", "lo", "hi", last), last)))
    return binned.groupBy("bin", "lo", "hi", "mean").agg(F.count(F.lit(1)).alias("n")).select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
        .alias("bin_start"),
        "n", "mean")
