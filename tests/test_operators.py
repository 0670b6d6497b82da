"""Dedup, upsert, skew-safe join, money and histogram."""

from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import pytest

from tidemart.functions.numbers import amount, exact, mean_amount, ratio
from tidemart.operators.clean import clean_live
from tidemart.operators.dedup import latest_per_key
from tidemart.operators.histogram import equal_width
from tidemart.operators.skew import SLOTS, hot_slots, skew_safe_join
from tidemart.operators.upsert import merge_by_key
from tidemart.specs import ALL_SPECS
from tests.conftest import rows

DDL = "k int, ts int, v string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_row_wins_in_any_input_order(spark):
    data = [(1, 5, "new"), (1, 3, "old"), (2, 4, "b"), (2, 4, "a"), (3, None, "n"), (3, 1, "t")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, DDL).repartition(3)
        assert rows(latest_per_key(df, ["k"], "ts")) == [(1, 5, "new"), (2, 4, "a"), (3, 1, "t")]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "id as ts")
    text = plan(latest_per_key(df, ["k"], "ts"))
    before_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_later_ingestion_wins_without_a_version(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "z")],
                               "k int, ingestion_timestamp int, v string")
    assert rows(latest_per_key(df, ["k"]), "v") == [("z",)]


def test_live_rows_are_deduplicated_and_cleaned(spark):
    spec = ALL_SPECS["order_payments"]
    df = spark.createDataFrame(
        [("o", "1", "not_defined", "2", "3.5"), ("o", "1", "not_defined", "2", "3.5")],
        ", ".join(f"{c} string" for c in spec.columns))
    assert rows(clean_live(df, spec)) == [("o", 1, "unknown", 2, 3.5)]


def test_upsert_compound_key_with_nulls(spark):
    ddl = "a int, b int, v string"
    target = spark.createDataFrame([(1, 1, "t"), (1, 2, "t"), (None, 1, "t")], ddl)
    source = spark.createDataFrame([(1, 2, "s"), (2, 1, "s"), (None, 1, "s")], ddl)
    assert rows(merge_by_key(target, source, ["a", "b"])) == [
        (1, 1, "t"), (1, 2, "s"), (2, 1, "s"), (None, 1, "s"), (None, 1, "t")]


def test_upsert_takes_target_types_and_new_columns(spark):
    target = spark.createDataFrame([(1, "t")], "k int, v string")
    source = spark.createDataFrame([(2, 5, "x")], "k bigint, v int, extra string")
    out = merge_by_key(target, source, ["k"])
    assert out.dtypes == [("k", "int"), ("v", "string"), ("extra", "string")]
    assert rows(out) == [(1, "t", None), (2, "5", "x")]


def test_upsert_ignores_older_versions(spark):
    target = spark.createDataFrame([(1, 10, "t"), (2, 10, "t"), (3, None, "t"), (4, 10, "t")], DDL)
    source = spark.createDataFrame([(1, 9, "s"), (2, 10, "s"), (3, 1, "s"), (4, None, "s")], DDL)
    assert rows(merge_by_key(target, source, ["k"], "ts"), "k", "v") == [
        (1, "t"), (2, "s"), (3, "s"), (4, "t")]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(0, 9), st.integers(0, 5)),
       st.dictionaries(st.integers(0, 9), st.integers(0, 5)))
def test_upsert_twice_is_upsert_once(spark, old, new):
    make = lambda d: spark.createDataFrame(list(d.items()), "k int, v int")
    once = merge_by_key(make(old), make(new), ["k"])
    assert rows(once) == sorted((old | new).items(), key=repr)
    assert rows(merge_by_key(once, make(new), ["k"])) == rows(once)


def skewed(spark, n=20_000):
    """A third of the rows under key 5, a third without a key."""
    return spark.range(n).selectExpr(
        "CASE id % 3 WHEN 0 THEN 5L WHEN 1 THEN NULL ELSE id END AS k", "id AS line")


def test_hot_slots_find_the_hot_keys_and_nothing_else(spark):
    df = skewed(spark)
    hot = dict(hot_slots(df, ["k"], share=0.01, min_piece=100))
    want = {r[0] for r in spark.createDataFrame([(5,), (None,)], "k bigint")
            .select(F.pmod(F.xxhash64("k"), F.lit(SLOTS)).cast("int")).collect()}
    assert set(hot) == want and all(30 <= pieces <= 40 for pieces in hot.values())
    assert hot_slots(df, ["k"]) == []  # too few rows to matter


def test_split_join_equals_plain_join_and_spreads_the_hot_key(spark):
    left = skewed(spark)
    right = spark.range(0, 20_000, 2).selectExpr("id AS k", "id * 2 AS w").union(
        spark.sql("SELECT 5L, 10L"))
    hot = hot_slots(left, ["k"], share=0.01, min_piece=100)
    for how in ("inner", "left"):
        split = skew_safe_join(left, right, ["k"], how, hot)
        assert rows(split) == rows(left.join(right, "k", how))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r[0] for r in skew_safe_join(left, right, ["k"], "left", hot)
                 .groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 2 * 20_000 / 8


def test_money_is_exact_and_half_up(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10 + [(float("nan"),)], "x double")
    total = F.sum(exact("x"))
    out = df.agg(amount(total), mean_amount(total, F.count(exact("x"))), amount(total, 0)).first()
    assert tuple(out) == (3.0, 0.15, 3.0)
    tie = spark.createDataFrame([(0.01,), (0.02,)], "x double")
    assert tie.agg(mean_amount(F.sum(exact("x")), F.count("x"))).first()[0] == 0.02
    empty = df.where("x > 5 and x < 6").agg(
        mean_amount(F.sum(exact("x")), F.count("x")), ratio(F.sum("x"), F.count("x"), 1)).first()
    assert tuple(empty) == (None, None)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.9,), (10.0,), (None,)], "x double").limit(10)
    got = rows(equal_width(df, "x", 10), "bin", "bin_start", "n")
    assert got == [(1, 0.0, 1), (10, 9.0, 2), (2, 1.0, 1)]
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double").limit(5)
    assert rows(equal_width(same, "x", 10), "bin", "n") == [(1, 2)]


def test_parts_of_a_cent_add_up(spark):
    df = spark.createDataFrame([(0.004,)] * 1000, "x double")
    assert df.agg(amount(F.sum(exact("x")))).first()[0] == 4.0


def test_csv_files_with_other_headers_are_an_error(spark, tmp_path):
    from tidemart.sources.csv import scan_csv
    from tidemart.specs import REFERENCE_SPECS

    spec = next(s for s in REFERENCE_SPECS.values() if len(s.columns) == 2)
    a, b = spec.columns
    (tmp_path / "1.csv").write_text(f"{a},{b}\nx,y\n")
    assert scan_csv(spark, str(tmp_path), spec).count() == 1
    (tmp_path / "2.csv").write_text(f"{b},{a}\ny,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path), spec).collect()
