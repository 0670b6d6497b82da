"""Training corpus pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the ``docs`` of the next one. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.llm import leaks, near, packing, quality, repeats
from tidemart.llm.common import stored, table, text_digest
from tidemart.llm.queries import prepare, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; null and empty texts do not."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the text with the smallest id.

    Texts are linked by similarity alone: an id that comes with several texts keeps each that
    is like nothing kept. One row stays of rows that repeat an id and text; rows without an
    id stay.
    """
    rows = docs.select(F.struct(*_columns(docs)).alias("row"), "doc_id",
                       text_digest("text").alias("text_digest"))
    same = W.partitionBy("doc_id", "text_digest").orderBy(F.xxhash64("row"))
    one = rows.join(near.kept_texts(docs), ["doc_id", "text_digest"], "left_semi").select(
        "row", F.row_number().over(same).alias("n")).where("n = 1").select("row.*")
    return one.unionByName(docs.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document with a smaller id also has.

    Null texts stay null; ``n_chars`` is that of the new text. All documents stay.
    """
    left = repeats.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, told by their text alone: other texts with the
    same id, or without one, stay."""
    texts = docs.select(text_digest("text").alias("text_digest"), "text")
    found = leaks.leaks(texts, table(spark, sf_dir, "benchmark"), key="text_digest").select(
        "text_digest").distinct()
    rows = docs.select(F.struct(*_columns(docs)).alias("row"),
                       text_digest("text").alias("text_digest"))
    return rows.join(found, "text_digest", "left_anti").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("decontamination", decontamination),
          ("packing", pack)]

#: Near duplicates, repeated passages, tiling and packing have no SQL twin; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
