"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import scratch_dir

#: White space between words: space, tab, LF, VT, FF, CR. Fixed values.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def text_digest(text: Column | str) -> Column:
    """128-bit digest of a text; empty for null."""
    return F.unhex(F.coalesce(F.md5(text), F.lit("")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often body uses it and wherever
    the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), body), 0)


def stored(frame: DataFrame, label: str = "llm") -> DataFrame:
    """The rows written below ``spark.checkpoint.dir`` and read back: computed once, without
    lineage, and whole when an executor is lost."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], text: int,
           limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the text column of each holds about ``limit`` bytes at most (a
    longer single text stays whole)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        start, held = 0, 0
        for at, size in enumerate(sizes.to_pylist()):
            if held and held + size > limit:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
