"""Keyed upsert as joins: matched rows are replaced, new rows are added."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def align_types(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns the target knows take the target's type; new columns keep theirs."""
    known = {f.name.lower(): f.dataType for f in target.schema.fields}
    return source.select(*(
        F.col(f"`{f.name}`").cast(known[f.name.lower()]).alias(f.name)
        if known.get(f.name.lower(), f.dataType) != f.dataType else F.col(f"`{f.name}`")
        for f in source.schema.fields))


def drop_stale(target: DataFrame, source: DataFrame, keys: Sequence[str],
               version: str) -> DataFrame:
    """Source rows that are not older than the target row with the same key."""
    newer = target.select(*keys, F.col(version).alias("_have")).where("_have is not null")
    stale = (newer.join(source.select(*keys, F.col(version).alias("_new")), list(keys))
             .where("_new is null or _new < _have").select(*keys))
    return source.join(stale, list(keys), "left_anti")


def merge_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 version: str | None = None, match_keys: DataFrame | None = None) -> DataFrame:
    """Target after the upsert; ``source`` holds at most one row per key.

    Keys are ANDed and compared with ``=``, so a NULL key never matches: such target
    rows skip the join (they would all hash to one task) and such source rows are
    inserted. The source is the right side, so a small feed is broadcast by Spark's
    own size check and the target is then not shuffled at all. Columns new in the
    source are added; older rows read NULL there. ``match_keys`` may give the source
    keys from before its dedup, which saves repeating that for a narrow key scan.
    """
    source = align_types(source, target)
    if version:
        source = drop_stale(target, source, keys, version)
    if version or match_keys is None:
        match_keys = source.select(*keys)
    match_keys = align_types(match_keys.select(*keys).distinct(), target)
    no_key = any_null(keys)
    kept = (target.where(~no_key).join(match_keys, list(keys), "left_anti")
            .unionByName(target.where(no_key)))
    return kept.unionByName(source, allowMissingColumns=True)


def merge_in_buckets(target: DataFrame, source: DataFrame, keys: Sequence[str],
                     cluster: Sequence[str], buckets: int, version: str | None = None) -> DataFrame:
    """``merge_by_key`` for rows that are to lie in ``buckets`` of the ``cluster`` columns, which
    belong to the keys. The source is dealt out once, by these; so is a target that does not lie
    in such buckets yet, else Spark leaves its rows where they are. A window then tells per key
    which rows stay, where joins would shuffle the target by all keys before that."""
    by, no_key = Window.partitionBy(*keys), any_null(keys)
    source = align_types(source, target)

    def both(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.withColumn("_new", F.lit(False)).unionByName(
            new.withColumn("_new", F.lit(True)), allowMissingColumns=True)

    def dealt(side: DataFrame) -> DataFrame:
        # under new names: Spark compares the buckets of a union's sides by column and table
        return side.where(~no_key).repartition(buckets, *cluster).select(
            *(F.col(f"`{c}`").alias(f"_of_{c}") for c in side.columns))

    keyless = both(target.where(no_key), source.where(no_key)).drop("_new")
    rows = both(dealt(target), dealt(source))
    rows = rows.select(*(F.col(f"`{c}`").alias(c.removeprefix("_of_")) for c in rows.columns))
    if version:
        rows = rows.withColumn("_have", F.max(F.when(~F.col("_new"), F.col(version))).over(by))
        stale = F.col("_new") & F.col("_have").isNotNull() & (
            F.col(version).isNull() | (F.col(version) < F.col("_have")))
        rows = rows.withColumn("_stale", F.max(stale).over(by)).where(
            "NOT (_new AND _stale)").drop("_have", "_stale")
    rows = rows.withColumn("_fed", F.max("_new").over(by)).where("_new OR NOT _fed")
    return rows.drop("_new", "_fed").unionByName(keyless)
