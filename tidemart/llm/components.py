"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v) with u > v, each hung on the smallest neighbour of one of its ends."""
    if large:
        around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = links
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn(
        "m", F.least("u", "m"))
    both = around.join(least, "u")
    if large:
        moved = both.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = both.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether each node hangs on one other node at most, and those hang on none."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")
                        ).unionByName(links.select("v", F.lit(0), F.lit(1)).toDF(
                            "node", "hangs", "holds"))
    odd = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return odd.where("hangs + holds > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node with a link; the component is its smallest node.

    ``links`` has two columns of node ids, in any order and direction; links of a node with
    itself and repeated links do no harm. Rounds are written to the shared folder, so no
    lineage grows; a round ends with the question whether each node hangs on its component.
    The number of rounds grows with the logarithm of the longest chain, and the neighbours of
    a node are never gathered in one place.
    """
    a, b = links.columns
    now = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where("u > v").distinct(), "links")
    while not _settled(now):
        now = stored(_star(_star(now, large=True), large=False), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
