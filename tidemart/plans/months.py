"""Headline figures of any run of months from small states stored per month.

Sums and counts add up over months; distinct orders and customers do not, as a customer comes
back. Each month therefore keeps bitmaps of the ids it saw, in pieces of 32,768 ids, which are
combined with OR: the counts are exact and the fact is not read again. A month's states
depend on its own lines alone, so a month that changed is replaced by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.numbers import amount, exact, mean_amount, points, ratio
from tidemart.plans.kpi import review_range

SUMS, IDS = "sums", "ids"


def month_sums(fact: DataFrame) -> DataFrame:
    """``month`` and additive measures of its lines."""
    spent = exact("total_amount")
    return _by_month(fact).groupBy("month").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(spent).alias("spent"),
        F.count(spent).alias("spent_n"),
        F.sum("delivery_days").alias("days"), F.count("delivery_days").alias("days_n"),
        F.sum("on_time_flag").alias("on_time"), F.count("on_time_flag").alias("on_time_n"),
        F.sum(F.when(F.col("delay_flag") == 1, 1).otherwise(0)).alias("late"),
        F.sum(points("review_score")).alias("score"), F.count("review_score").alias("score_n"))


def month_ids(fact: DataFrame, columns: tuple[str, ...] = ("order_id", "customer_id")) -> DataFrame:
    """``month, kind, piece, ids``: a bitmap of the ids of each kind (column) in each month.
    A bitmap holds integers: text keys need a table of numbers first."""
    for c in columns:
        if not isinstance(fact.schema[c].dataType, T.IntegralType):
            raise TypeError(f"{c}: a bitmap needs integer ids, not {fact.schema[c].dataType}")
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).cast("long").alias("id"))
                               for c in columns)))
    seen = _by_month(fact).select("month", each.alias("x")).select("month", "x.*").where(
        "id IS NOT NULL")
    return seen.groupBy("month", "kind", F.bitmap_bucket_number("id").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("ids"))


def _by_month(fact: DataFrame) -> DataFrame:
    return fact.where("purchase_timestamp IS NOT NULL").withColumn(
        "month", F.year("purchase_timestamp") * 100 + F.month("purchase_timestamp"))


def store_months(fact: DataFrame, path: str, low: int = 1, high: int = 5) -> None:
    """Store the states of every month that ``fact`` has lines of; other months stay. Lines
    count whose review score is in range, as in ``kpi.overview``."""
    rows = review_range(fact, low, high)
    for name, state in ((SUMS, month_sums(rows)), (IDS, month_ids(rows))):
        (state.hint("rebalance", "month").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("month").parquet(f"{path}/{name}"))


def overview_months(spark: SparkSession, path: str, period: Column) -> DataFrame:
    """The figures of ``kpi.overview`` for each ``period``, an expression over ``month``
    (a number like 201801); months for which it is NULL are left out."""
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}").withColumn("period", period).where(
            "period IS NOT NULL")

    s = read(SUMS).groupBy("period").agg(*(F.sum(c).alias(c) for c in (
        "lines", "spent", "spent_n", "days", "days_n", "on_time", "on_time_n", "late", "score",
        "score_n")))
    distinct = read(IDS).groupBy("period", "kind", "piece").agg(
        F.bitmap_count(F.bitmap_or_agg("ids")).alias("n")).groupBy("period").agg(
        *(F.sum(F.when(F.col("kind") == c, F.col("n"))).alias(c)
          for c in ("order_id", "customer_id")))
    return s.join(distinct, "period", "left").select(
        "period", amount(F.col("spent"), 0).alias("total_revenue"),
        F.coalesce("order_id", F.lit(0)).alias("total_orders"),
        ratio(F.col("days"), F.col("days_n"), 1).alias("avg_delivery_days"),
        ratio(F.col("on_time") * 100, F.col("on_time_n"), 1).alias("on_time_pct"),
        F.coalesce("customer_id", F.lit(0)).alias("unique_customers"),
        ratio(F.col("score"), F.col("score_n"), 2).alias("avg_review"),
        ratio(F.col("late") * 100, F.col("lines"), 1).alias("delay_pct"),
        mean_amount(F.col("spent"), F.col("spent_n")).alias("avg_order_value"))
