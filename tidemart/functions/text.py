"""Display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_id(c: Column | str, keep: int = 8) -> Column:
    """First characters of an identifier followed by dots."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.left(c.cast("string"), F.lit(keep)), F.lit("..."))
