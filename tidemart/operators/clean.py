"""The cleaning pipeline of one table: rules, lookup, collapse, dedup, drop audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.rules import apply_rules
from tidemart.operators.dedup import latest_per_key
from tidemart.specs import AUDIT_COLUMNS, Collapse, Lookup, TableSpec


def join_lookup(df: DataFrame, other: DataFrame, lookup: Lookup) -> DataFrame:
    """Join on the shared column and fill what stayed NULL. No hint: Spark broadcasts
    the lookup when its size allows and AQE splits a hot category otherwise."""
    joined = df.join(other.drop(*AUDIT_COLUMNS), lookup.on, lookup.how)
    return joined.withColumns(
        {c: F.coalesce(c, F.lit(v)) for c, v in lookup.fill.items()})


def collapse(df: DataFrame, spec: Collapse) -> DataFrame:
    """One row per key. Averages add exact decimals; ``first`` takes the value of the
    smallest row by the tie-breakers, or the smallest value if there are none."""
    aggs = []
    for column, how in spec.aggs.items():
        if how == "avg":
            exact = F.col(column).try_cast("decimal(28,12)")
            aggs.append((F.sum(exact).cast("double") / F.nullif(F.count(exact), F.lit(0)))
                        .alias(column))
        elif spec.tie_breakers:
            aggs.append(F.min_by(column, F.struct(*spec.tie_breakers)).alias(column))
        else:
            aggs.append(F.min(column).alias(column))
    return df.groupBy(*spec.keys).agg(*aggs)


def clean(df: DataFrame, spec: TableSpec, lookup: DataFrame | None = None) -> DataFrame:
    """Raw rows of one table to curated rows, one per key."""
    df = apply_rules(df, spec.rules)
    if spec.lookup:
        if lookup is None:
            raise ValueError(f"{spec.name} needs {spec.lookup.table} to look up")
        df = join_lookup(df, lookup, spec.lookup)
    if spec.collapse:
        return collapse(df, spec.collapse)
    return latest_per_key(df, spec.unique_keys, spec.version).drop(*AUDIT_COLUMNS)


def clean_live(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Live rows: dedup first (on the raw rows), then the rules of the batch path."""
    newest = df if not spec.version else df.withColumn(
        "_version", F.col(spec.version).try_cast("timestamp"))
    newest = latest_per_key(newest, spec.unique_keys, "_version" if spec.version else None)
    return apply_rules(newest.drop("_version"), spec.rules).drop(*AUDIT_COLUMNS)
