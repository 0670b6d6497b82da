"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemart.operators.counting import rows_seen

# (slot, pieces): keys are hashed into SLOTS slots; a hot slot is cut into pieces.
HotSlots = list[tuple[int, int]]
SLOTS = 1 << 18

# A slot is hot above this share of the rows, or above two average shuffle partitions
# if that is less, so at most 1 / share slots are. With far more slots than partitions
# an ordinary slot stays well below.
HOT_SHARE = 0.002
# Fewer rows than this in one task are never worth splitting.
MIN_PIECE = 100_000


def slot_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int")


def hot_slots(df: DataFrame, keys: Sequence[str], share: float | None = None,
              min_piece: int = MIN_PIECE) -> HotSlots:
    """Slots that hold more rows than one task should get, with the pieces they need.

    One scan of the key columns and a count per slot: a fixed-size hash aggregate whose
    partial results, not the rows or keys, are shuffled. The driver receives at most
    ``1 / share`` rows. NULL keys count too, since a left join keeps them.
    """
    if share is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = min(HOT_SHARE, 2 / partitions)
    seen = Observation()
    counts = (df.groupBy(slot_of(keys).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
              .observe(seen, F.sum("n").alias("rows")))
    top = (counts.where(F.col("n") > min_piece).orderBy(F.desc("n"))
           .limit(math.ceil(1 / share)).collect())
    piece = max(share * rows_seen(seen), min_piece) if top else min_piece
    return [(r["slot"], math.ceil(r["n"] / piece)) for r in top if r["n"] > piece]


def skew_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                   hot: HotSlots | None = None) -> DataFrame:
    """Join ``left`` (many rows per key) to ``right`` (few rows per key).

    Left rows of a hot slot are spread over its pieces by a hash of the whole row, and
    the right rows of that slot are copied once per piece, so the result is the same as
    that of the plain join. The piece is a function of the row, not a random draw, so a
    retried task puts every row where the first attempt did. The slot table that is
    broadcast has at most ``1 / share`` rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"only inner and left joins can be split, not {how}")
    if not hot:
        return left.join(right, list(on), how)
    table = F.broadcast(left.sparkSession.createDataFrame(hot, "_slot int, _pieces int"))

    def tagged(df: DataFrame) -> DataFrame:
        return df.withColumn("_slot", slot_of(on)).join(table, "_slot", "left")

    piece = F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("_pieces")).cast("int"), F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    split_left = tagged(left).withColumn("_piece", piece).drop("_slot", "_pieces")
    split_right = tagged(right).withColumn("_piece", copies).drop("_slot", "_pieces")
    return split_left.join(split_right, [*on, "_piece"], how).drop("_piece")
