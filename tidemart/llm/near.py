"""Near duplicates by bottom-k sketches and exact Jaccard.

The sketch of a document is the k smallest hashes of its shingle set, all from one hash
function. Documents with equal sets form a class; the rest works on one row per class.

* Inverted lists hold the retained values. A linked pair shares at least ``need`` of them,
  so it also meets in the lists of the ``size - need + 1`` rarest values of either side: only
  those are listed, and a class whose other values are all its own is in no list at all.
* The classes of a list are compared with one pivot first. A pair is estimated on the sketch
  of the union, and confirmed on the whole sets.
* Classes that this leaves in different components of a list get lists on their whole sets,
  rarest values first; pairs across components that can still reach the similarity from
  where they stand in the list are confirmed. So a group of thousands of copies costs about
  one comparison per copy, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import slices, stored, text_digest
from tidemart.llm.components import components


@dataclass(frozen=True)
class Near:
    """Words of a shingle, least Jaccard similarity in percent, values in a sketch.

    ``need`` is the number of values that the sketch of the union must share when it is full.
    A pair of 80 % similarity shares fewer than 14 of 32 with a probability of about 1e-6, one
    of 85 % of 1e-8; raise ``k`` and ``need`` together to lower it.
    """

    words: int = 5
    percent: int = 80
    k: int = 32
    need: int = 14


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles: A-Z in lower case, words split at
    ASCII white space; fewer words than a shingle make one, none make an empty set."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, dtype=np.int64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = max(1, len(one) - words + 1)
    found = np.full(n, len(one) if len(one) < words else words, dtype=np.uint64)
    for j in range(min(words, len(one))):
        found = _mix(found * np.uint64(0x9E3779B97F4A7C15) + one[j:j + n])
    return np.unique(found.view(np.int64))


def _signatures(docs: DataFrame, near: Near) -> DataFrame:
    schema = T.StructType([*docs.select("id", "text_digest").schema, *T._parse_datatype_string(
        "n long, digest binary, sketch array<bigint>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            sets = [shingle_set(t, near.words) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([s[:near.k] for s in sets], pa.list_(pa.int64()))],
                names=schema.names)

    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, near: Near) -> DataFrame:
    """Whole shingle sets; rows that repeat an id within a task are left out."""
    schema = T.StructType([docs.schema["id"], *T._parse_datatype_string(
        "shingles array<bigint>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, 1):
            new = []
            for at, i in enumerate(batch.column(0).to_pylist()):
                if i not in seen:
                    seen.add(i)
                    new.append(at)
            batch = batch.take(pa.array(new, pa.int32()))
            sets = [shingle_set(t, near.words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=schema.names)

    return docs.mapInArrow(run, schema)


def _large(frame: DataFrame) -> DataFrame:
    """A side of a join that grows with the documents and is never broadcast: Spark sizes what
    comes out of an explode, or holds arrays, as if an array had one value, and a file by its
    compressed bytes, so it would send millions of rows through the driver."""
    return frame.hint("merge")


def _similar(shared: Column, a: Column, b: Column, near: Near) -> Column:
    return 100 * shared >= near.percent * (a + b - shared)


def _lists(classes: DataFrame, near: Near) -> DataFrame:
    """``value, id, n``: the inverted lists of the values that a linked pair must share."""
    values = classes.select("id", "n", F.size("sketch").alias("size"),
                            F.explode("sketch").alias("value"))
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = _large(values).join(counts, "value").groupBy("id", "n", "size").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("rare_first"))
    need = F.least(F.lit(near.need), F.ceil(F.col("n") * near.percent / 100).cast("int"))
    # values in no other sketch are the rarest of all, and need no list
    listed = F.size("rare_first") - need + 1
    return shared.where(listed > 0).select(
        "id", "n", F.explode(F.slice("rare_first", F.lit(1), listed)).alias("r")).select(
        F.col("r.value").alias("value"), "id", "n")


def _close_sizes(near: Near) -> Column:
    return 100 * F.least("n_a", "n_b") >= near.percent * F.greatest("n_a", "n_b")


def _estimated(pairs: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """Pairs ``a, b, n_a, n_b`` whose union sketch shares enough."""
    side = classes.select("id", "sketch")
    with_a = pairs.join(_large(side.select(F.col("id").alias("a"), F.col("sketch").alias("s"))), "a")
    both = with_a.join(_large(side.select(F.col("id").alias("b"), F.col("sketch").alias("t"))), "b")
    union = F.slice(F.sort_array(F.array_union("s", "t")), 1, near.k)
    sizes = both.withColumn("union", union).withColumn("shared", F.size(
        F.array_intersect("union", F.array_intersect("s", "t"))))
    enough = F.when(F.size("union") < near.k,
                    100 * F.col("shared") >= near.percent * F.size("union")).otherwise(
        F.col("shared") >= near.need)
    return sizes.where(enough).select("a", "b", "n_a", "n_b")


def _confirmed(pairs: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """``a, b`` of the pairs that are similar on their whole sets."""
    side = sets.select("id", "shingles")
    both = pairs.join(
        _large(side.select(F.col("id").alias("a"), F.col("shingles").alias("s"))), "a").join(
        _large(side.select(F.col("id").alias("b"), F.col("shingles").alias("t"))), "b")
    shared = F.size(F.array_intersect("s", "t"))
    return both.where(_similar(shared, F.col("n_a"), F.col("n_b"), near)).select("a", "b")


def _sets_of(asked: DataFrame, classes: DataFrame, rows: DataFrame, near: Near) -> DataFrame:
    """Whole shingle sets of the asked classes, each from a row that stands for it. Rows that
    repeat this id and text may give a set once more in another task."""
    first = classes.join(asked.distinct(), "id", "left_semi").select(
        F.col("id").alias("class"), F.col("first.id").alias("id"),
        F.col("first.text_digest").alias("text_digest"))
    return stored(_sets(rows.join(first, ["id", "text_digest"]).select(
        F.col("class").alias("id"), "text"), near), "sets")


def _whole_lists(sets: DataFrame, near: Near) -> DataFrame:
    """``value, id, n, at``: inverted lists of the rarest values of whole sets.

    A similar pair shares one of the ``n - ceil(similarity * n) + 1`` rarest values of either
    side; a value that stands at place ``at`` from the rarest leaves at most ``n - at`` to share.
    """
    values = sets.dropDuplicates(["id"]).select(
        "id", F.size("shingles").alias("n"), F.explode("shingles").alias("value"))
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = _large(values).join(counts, "value").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("rare_first"))
    own = F.col("n") - F.size("rare_first")
    listed = F.col("n") - F.ceil(F.col("n") * near.percent / 100).cast("int") + 1 - own
    return shared.where(listed > 0).select("id", "n", own.alias("own"), F.posexplode(
        F.slice("rare_first", F.lit(1), listed)).alias("i", "r")).select(
        F.col("r.value").alias("value"), "id", "n", (F.col("own") + F.col("i")).alias("at"))


def _named(lists: DataFrame, grouped: DataFrame) -> DataFrame:
    """Rows of the lists that hold several components, with the component of each row."""
    named = lists.join(grouped.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    mixed = named.groupBy("value").agg(F.min("component").alias("lo"),
                                       F.max("component").alias("hi")).where("lo < hi")
    return named.join(mixed.select("value"), "value", "left_semi")


def _across(left: DataFrame, right: DataFrame, near: Near) -> DataFrame:
    """Distinct pairs ``a, b, n_a, n_b`` of rows that meet in a list, belong to different
    components and can still be similar by their places in the list."""
    a = left.select("value", *(F.col(c).alias(f"{c}_a") for c in ("id", "n", "at", "component")))
    b = right.select("value", *(F.col(c).alias(f"{c}_b") for c in ("id", "n", "at", "component")))
    most = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    met = a.join(_large(b), "value").where("component_a <> component_b").where(
        _similar(most, F.col("n_a"), F.col("n_b"), near))
    first = F.col("id_a") < F.col("id_b")
    return met.select(*(F.when(first, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (
        ("id_a", "id_b", "a"), ("id_b", "id_a", "b"), ("n_a", "n_b", "n_a"),
        ("n_b", "n_a", "n_b")))).distinct()


def _same_key(members: DataFrame) -> DataFrame:
    """Links ``a, b`` between a key that has texts in several components and the least keys
    of those components."""
    several = members.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return members.join(several.select("id"), "id", "left_semi").select(
        F.col("id").alias("a"), F.col("least").alias("b"))


def _linked_texts(docs: DataFrame, near: Near, key: str, text: str
                  ) -> tuple[DataFrame, DataFrame]:
    """``id, text_digest, n, digest, sketch`` of each row, and ``id, text_digest, component`` of
    each distinct id and text that has an id and words. Texts are linked by similarity alone:
    rows are told apart by id and text digest, and classes of equal sets have numbers of
    their own, so an id that is repeated with other texts links nothing."""
    rows = docs.select(F.col(key).alias("id"), text_digest(text).alias("text_digest"),
                       F.col(text).alias("text"))
    signed = stored(_signatures(rows, near), "sketches")
    alive = signed.where("id is not null and n > 0")
    classes = stored(alive.groupBy("digest").agg(
        F.min(F.struct("id", "text_digest")).alias("first"), F.any_value("n").alias("n"),
        F.any_value("sketch").alias("sketch")).withColumn(
        "id", F.monotonically_increasing_id()), "classes")

    lists = stored(_lists(classes, near), "lists")
    pivots = lists.groupBy("value").agg(F.min(F.struct("id", "n")).alias("p"))
    stars = _large(lists).join(pivots, "value").select(
        F.col("p.id").alias("a"), F.col("id").alias("b"), F.col("p.n").alias("n_a"),
        F.col("n").alias("n_b")).where("a < b").where(_close_sizes(near)).distinct()
    pairs = stored(_estimated(stars, classes, near), "pairs")
    sets = _sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), classes,
                    rows, near)
    links = stored(_confirmed(pairs, sets, near), "links")

    # what the stars left apart: lists on whole sets, once more a star, then all that is left
    grouped = components(links)
    left = _named(lists, grouped).select("id")
    sets = _sets_of(left, classes, rows, near)
    lists = stored(_whole_lists(sets, near), "lists")
    named = stored(_named(lists, grouped), "lists")
    pivots = named.groupBy("value").agg(F.min_by(
        F.struct("id", "n", "at", "component"), F.struct("at", "id")).alias("p")).select(
        "value", "p.*")
    found = _confirmed(_across(pivots, named, near), sets, near)
    # components stand in for the links that made them
    grouped = components(grouped.toDF("a", "b").unionByName(found))
    named = stored(_named(lists, grouped), "lists")
    links = grouped.toDF("a", "b").unionByName(_confirmed(
        stored(_across(named, named.where("true"), near), "pairs"), sets, near))

    named = classes.select("digest", F.col("id").alias("node")).join(
        components(links), "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    return signed, stored(alive.select("id", "text_digest", "digest").distinct().join(
        named, "digest").select("id", "text_digest", "component"), "members")


def near_groups(docs: DataFrame, near: Near = Near(), key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id, kept`` for each row of ``docs``.

    ``component_id`` is the smallest key reachable by links, ``kept`` whether that is the
    row's own. Documents without words are linked with nothing. Rows that repeat a key count
    as one document when their texts are equal; with different texts they are linked through
    the key they share. A row with a null key is linked with nothing: its component is null
    and it is kept. Shingles are compared by 64-bit hashes.
    """
    signed, texts = _linked_texts(docs, near, key, text)
    least = texts.groupBy("component").agg(F.min("id").alias("least"))
    members = stored(texts.join(least, "component").select("id", "least").distinct(), "members")
    linked = components(_same_key(members))

    found = members.join(linked.withColumnRenamed("node", "least"), "least", "left").groupBy(
        "id").agg(F.min(F.coalesce("component", "least")).alias("component"))
    return signed.join(found, "id", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"))


def kept_texts(docs: DataFrame, near: Near = Near(), key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``key, text_digest`` of the texts to keep, each once: of each component of similar texts
    the one with the smallest key (then digest), and all texts without words.

    A key may come with any number of texts, they are not linked by it. Null keys are left out.
    """
    signed, texts = _linked_texts(docs, near, key, text)
    first = texts.groupBy("component").agg(F.min(F.struct("id", "text_digest")).alias("k"))
    alone = signed.where("id is not null and n = 0").select("id", "text_digest").distinct()
    return first.select("k.id", "k.text_digest").unionByName(alone).withColumnRenamed("id", key)
