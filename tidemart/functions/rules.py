"""Cleaning rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.specs import Rule


def rule_column(c: Column, rule: Rule) -> Column:
    """The cleaned value of ``c``. A failed cast gives NULL, never an error."""
    match rule.action:
        case "initcap_trim":
            return F.initcap(F.trim(c))
        case "upper_trim":
            return F.upper(F.trim(c))
        case "cast_string":
            return c.cast("string")
        case "cast_double":
            return c.try_cast("double")
        case "cast_int":
            return c.try_cast("int")
        case "to_timestamp":
            return c.try_cast("timestamp")
        case "fill_null":
            return F.coalesce(c, F.lit(rule.default))
        case "replace_value":
            return F.when(c == F.lit(rule.old), F.lit(rule.new)).otherwise(c)
    raise ValueError(f"{rule.action} is not a value rule")


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """All rules of a table in one projection, in order, names matched ignoring case.

    Renaming an absent column does nothing; any other rule on one is an error.
    """
    # output name, source column and, once a rule has touched it, the value
    columns = {c.lower(): (c, f"`{c}`", None) for c in df.columns}
    for rule in rules:
        key = rule.column.lower()
        if rule.action == "rename":
            columns = {
                (rule.new_name.lower() if k == key else k):
                ((rule.new_name, source, value) if k == key else (name, source, value))
                for k, (name, source, value) in columns.items()}
            continue
        if key not in columns:
            raise ValueError(f"rule {rule.action} names missing column {rule.column}")
        name, source, value = columns[key]
        current = F.col(source) if value is None else value
        columns[key] = (name, source, rule_column(current, rule))
    return df.select(*(
        source if value is None and source == f"`{name}`"
        else (F.col(source) if value is None else value).alias(name)
        for name, source, value in columns.values()))
