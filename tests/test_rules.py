"""Cleaning rules on hand-made edge rows."""

from __future__ import annotations

from datetime import datetime

import pytest

from tidemart.functions.rules import apply_rules
from tidemart.functions.text import mask_id
from tidemart.operators.clean import clean, collapse, join_lookup
from tidemart.sources.csv import enforce_types
from tidemart.specs import ALL_SPECS, Collapse, Lookup, Rule, TableSpec
from tests.conftest import rows


def one(spark, values, rule, ddl="v string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in apply_rules(df, [rule]).collect()]


def test_initcap_and_upper_trim(spark):
    assert one(spark, ["  são PAULO ", "d'oeste-sul", None], Rule("v", "initcap_trim")) == [
        "São Paulo", "D'oeste-sul", None]
    assert one(spark, [" sp "], Rule("v", "upper_trim")) == ["SP"]


@pytest.mark.parametrize("action, good", [("cast_int", 12), ("cast_double", 12.0)])
def test_bad_numbers_become_null(spark, action, good):
    assert one(spark, ["x", "", " 12 ", None], Rule("v", action)) == [None, None, good, None]


def test_bad_timestamps_become_null(spark):
    got = one(spark, ["x", "", None, "2018-01-02 03:04:05"], Rule("v", "to_timestamp"))
    assert got == [None, None, None, datetime(2018, 1, 2, 3, 4, 5)]


def test_fill_and_replace(spark):
    assert one(spark, [None, "a"], Rule("v", "fill_null", default="unknown")) == ["unknown", "a"]
    assert one(spark, [None], Rule("v", "fill_null")) == [""]
    rule = Rule("v", "replace_value", old="not_defined", new="unknown")
    assert one(spark, ["not_defined", "boleto", None], rule) == ["unknown", "boleto", None]


def test_rename_then_cast_keeps_position_and_ignores_case(spark):
    df = spark.createDataFrame([("1", "7", "b")], "A string, Lenght string, c string")
    out = apply_rules(df, [Rule("lenght", "rename", new_name="length"),
                           Rule("LENGTH", "cast_int")])
    assert out.dtypes == [("A", "string"), ("length", "int"), ("c", "string")]
    assert rows(out) == [("1", 7, "b")]
    assert apply_rules(df, [Rule("absent", "rename", new_name="x")]).columns == df.columns


def test_rules_are_one_projection(spark):
    df = spark.range(3).selectExpr("cast(id as string) v")
    plan = apply_rules(df, [Rule("v", "cast_string"), Rule("v", "fill_null"),
                            Rule("v", "cast_int")])._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Project") == 1


def test_rule_on_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="missing column"):
        apply_rules(spark.range(1), [Rule("v", "cast_int")])


def test_unknown_actions_and_aggregates_are_rejected_when_built():
    with pytest.raises(ValueError, match="unknown cleaning action"):
        Rule("v", "shout")
    with pytest.raises(ValueError, match="unknown aggregates"):
        Collapse(("k",), {"v": "median"})
    with pytest.raises(ValueError):
        Rule("v", "replace_value", old="a")
    with pytest.raises(ValueError):
        TableSpec("t", "t.csv", ("a",), merge_keys=())


def test_ingest_casts_skip_absent_columns(spark):
    df = spark.createDataFrame([("1.5", "x")], "price string, other string")
    out = enforce_types(df, ALL_SPECS["order_items"])
    assert out.dtypes == [("price", "double"), ("other", "string")]


def test_lookup_fills_and_accepts_other_join_types(spark):
    left = spark.createDataFrame([("a",), ("unknown",)], "k string")
    other = spark.createDataFrame([("a", "A", "f")], "k string, e string, source_file string")
    filled = join_lookup(left, other, Lookup("t", "k", "left", {"e": "unknown"}))
    assert rows(filled) == [("a", "A"), ("unknown", "unknown")]
    assert rows(join_lookup(left, other, Lookup("t", "k", "inner"))) == [("a", "A")]


def test_null_category_becomes_unknown(spark):
    spec = ALL_SPECS["products"]
    df = spark.createDataFrame([("p1",) + (None,) * 8, ("p2", "x") + ("3",) * 7],
                               ", ".join(f"{c} string" for c in spec.columns))
    lookup = spark.createDataFrame([("x", "ex")],
                                   "product_category_name string, "
                                   "product_category_name_english string")
    out = clean(df, spec, lookup)
    assert rows(out, "product_id", "product_category_name", "product_category_name_english",
                "product_name_length") == [("p1", "unknown", "unknown", None), ("p2", "x", "ex", 3)]


def test_collapse_average_and_first(spark):
    df = spark.createDataFrame(
        [("z", 1.0, "b", 2), ("z", 2.0, "a", 1), ("y", None, None, 1)],
        "k string, lat double, city string, ord int")
    spec = Collapse(("k",), {"lat": "avg", "city": "first"}, ("ord",))
    assert rows(collapse(df, spec)) == [("y", None, None), ("z", 1.5, "a")]
    by_value = Collapse(("k",), {"city": "first"})
    assert rows(collapse(df, by_value)) == [("y", None), ("z", "a")]


def test_mask(spark):
    df = spark.createDataFrame([("0123456789",), ("ab",), (None,)], "id string")
    assert [r[0] for r in df.select(mask_id("id")).collect()] == ["01234567...", "ab...", None]
