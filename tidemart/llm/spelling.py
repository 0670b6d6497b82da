"""Groups of spelling variants, found by walking a trie of all words level by level.

The trie is a table: a node is a prefix of a word, with its next characters and, where it is
a word itself, that word's count. A state is (word, position, node, edits): the first
``position`` characters of the word lie ``edits`` changes from the node. Words that begin alike
share their states, so a state names its word by that beginning, which is a node as well, and
states without an edit are the nodes themselves. At each level

1. every node starts states with one edit: two of its next characters exchanged for one
   another, or one of them left out;
2. every state with one edit goes on with the characters that both of its nodes have next;
3. states whose two nodes are both words are neighbours.

Each pair of neighbours has one state only, from the word with the smaller character, or the
longer word (of equal characters in a row the first is left out). A node has at most as many
states as there are spellings one edit away, so no key is hot, and each level joins a
frontier with the nodes of that level. Words of ``LONGEST`` characters and more, which would
need a level each, are compared by hashes of the word without each of its characters instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ascii_lower, stored
from tidemart.session import scratch_dir

#: Words of this length and longer are compared by hashes; the trie holds words up to it.
LONGEST = 65
_RUN = "[a-z\\u00C0-\\u00FF]+"
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", one_in: int = 97,
                min_length: int = 5, min_count: int = 3) -> DataFrame:
    """``word, n``: runs of letters of all texts, A-Z in lower case.

    Of the runs whose crc32 with the document's key is divisible by ``one_in`` one character is
    left out. Counts are added up before the shuffle, so a frequent word is no hot key.
    """
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(_RUN), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = "cast(h % length(run) as int)"
    word = F.when(F.col("h") % one_in == 0, F.expr(
        f"concat(left(run, {at}), substr(run, {at} + 2))")).otherwise(F.col("run"))
    return (hashed.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _trie(words: DataFrame) -> DataFrame:
    """``node, n, next, depth``: every prefix, its count if it is a word, its next characters."""
    prefixes = words.select("word", "n", F.explode(
        F.sequence(F.lit(1), F.length("word"))).alias("i")).select(
        F.expr("left(word, i)").alias("node"),
        F.when(F.col("i") == F.length("word"), F.col("n")).alias("n")
    ).groupBy("node").agg(F.max("n").alias("n"))
    edges = prefixes.select(F.expr("left(node, length(node) - 1)").alias("node"),
                            F.lit(None).cast("long").alias("n"),
                            F.expr("right(node, 1)").alias("c"))
    both = prefixes.withColumn("c", F.lit(None).cast("string")).unionByName(edges)
    return both.groupBy("node").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list("c")).alias("next"),
        F.length("node").alias("depth"))


def _started(nodes: DataFrame) -> DataFrame:
    """``p, q``: the states with one edit that nodes start, one level below them."""
    first = nodes.select("node", "next", F.explode("next").alias("c"))
    swapped = first.select("node", "c", F.explode(
        F.filter("next", lambda d: d > F.col("c"))).alias("d"))
    dropped = first.where("c <> right(node, 1)")
    return swapped.select(F.concat("node", "c").alias("p"), F.concat("node", "d").alias("q")
                          ).unionByName(dropped.select(F.concat("node", "c"), F.col("node"))
                                        .toDF("p", "q"))


def _short_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: words one edit apart, each pair once."""
    spark, path = words.sparkSession, scratch_dir(words.sparkSession, "trie")
    _trie(words).hint("rebalance", "depth").write.partitionBy("depth").parquet(f"{path}/nodes")
    nodes = spark.read.schema("node string, n long, next array<string>, depth int").parquet(
        f"{path}/nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    schema = "p string, q string, p_n long, q_n long, next array<string>"
    before = spark.createDataFrame([], schema)
    found = before
    for depth in range(1, deepest + 1):
        frontier = before.select("p", "q", F.explode("next").alias("c")).select(
            F.concat("p", "c").alias("p"), F.concat("q", "c").alias("q")).unionByName(
            _started(nodes.where(F.col("depth") == depth - 1)))
        near = nodes.where(F.col("depth").isin(depth - 1, depth))
        step = frontier.join(nodes.where(F.col("depth") == depth).select(
            F.col("node").alias("p"), F.col("n").alias("p_n"), F.col("next").alias("_p")), "p"
        ).join(near.select(
            F.col("node").alias("q"), F.col("n").alias("q_n"), F.col("next").alias("_q")), "q"
        ).select("p", "q", "p_n", "q_n", F.array_intersect("_p", "_q").alias("next"))
        step.where("size(next) > 0 or (p_n is not null and q_n is not null)").write.parquet(
            f"{path}/states/level={depth}")
        before = spark.read.schema(schema).parquet(f"{path}/states/level={depth}")
    if deepest:
        found = spark.read.schema(schema).parquet(f"{path}/states")
    return found.where("p_n is not null and q_n is not null").select(
        F.col("p").alias("a"), F.col("p_n").alias("a_n"),
        F.col("q").alias("b"), F.col("q_n").alias("b_n"))


def without_each(word: str) -> tuple[np.ndarray, np.uint64, np.ndarray]:
    """Hashes of a word without each of its characters, hash of the whole word, and for each
    place whether its character differs from the one before."""
    codes = np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(
        len(codes) - 1, _BASE, dtype=np.uint64)])
    until = np.r_[np.uint64(0), np.cumsum(codes * power, dtype=np.uint64)]
    rest = (until[-1] - until[1:]) * _INVERSE
    return until[:-1] + rest, until[-1], np.r_[True, codes[1:] != codes[:-1]]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for word in batch.column(0).to_pylist():
            hashes, whole, first = without_each(word)
            name = hashlib.md5(word.encode(), usedforsecurity=False).digest()
            size = len(hashes)
            for at in range(0, size + 1, 100_000):
                h = np.r_[hashes, whole][at:at + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(h), pa.binary()), pa.array(h),
                    pa.array(np.r_[np.arange(size), -1][at:at + 100_000]),
                    pa.array(np.r_[first, False][at:at + 100_000])],
                    names=["id", "h", "at", "first"])


def _long_pairs(words: DataFrame) -> DataFrame:
    """The same for long words. Words without their character at one place are equal for at
    most as many words as there are letters; hashes only propose, the words decide."""
    hashed = stored(words.select("word").mapInArrow(
        _hashed, "id binary, h long, at long, first boolean"), "long-words")
    cut = hashed.where("at >= 0")
    swapped = cut.alias("x").join(cut.alias("y"), F.expr(
        "x.h = y.h and x.at = y.at and x.id < y.id")).select(
        F.col("x.id").alias("a_id"), F.col("y.id").alias("b_id"), F.col("x.at").alias("at"))
    dropped = cut.where("first").alias("x").join(hashed.where("at < 0").alias("y"), F.expr(
        "x.h = y.h")).select(F.col("x.id"), F.col("y.id"), F.col("x.at")).toDF(
        "a_id", "b_id", "at")
    named = words.select(F.unhex(F.md5("word")).alias("id"), "word", "n")
    both = swapped.unionByName(dropped).join(named.toDF("a_id", "a", "a_n"), "a_id").join(
        named.toDF("b_id", "b", "b_n"), "b_id")
    rest = "concat(left({0}, int(at)), substr({0}, int(at) + 2))"
    return both.where(F.expr(
        f"{rest.format('a')} = case when length(a) = length(b) then {rest.format('b')} else b end"
    )).select("a", "a_n", "b", "b_n")


def near_words(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: all pairs of words (of distinct ``word, n`` rows) that differ by one
    inserted, deleted or replaced character, each pair once."""
    length = F.length("word")
    long_words = words.where(length >= LONGEST)
    pairs = _short_pairs(words.where(length <= LONGEST))
    if long_words.isEmpty():
        return pairs
    # two words of just that length are found both ways
    return pairs.unionByName(_long_pairs(long_words).where(
        (F.length("a") > LONGEST) | (F.length("b") > LONGEST)))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of each chain of ``word, form`` rows. A form's count is at least
    double, so chains are short, and each round doubles the steps taken."""
    reached = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")),
                     "roots")
    while not reached.where("open").isEmpty():
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        reached = stored(reached.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"),
            F.col("_next").isNotNull().alias("open")), "roots")
    return reached.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", times: int = 2,
             min_length: int = 5, min_count: int = 3, one_in: int = 97) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the corpus.

    ``form`` is the word one edit away with the largest count (ties: the first in code-point
    order), if that count is at least ``times`` the word's own; ``root`` is the end of the chain
    of forms. Null and empty texts have no words; a null key is an empty one; repeated rows
    count as often as they come; extra columns are ignored; an empty table gives no rows. Texts
    of any length are read whole, and words of any length are compared. Counts, nodes, states
    and pairs stay on the cluster; the driver learns the depth of the trie, at most ``LONGEST``.
    """
    words = stored(word_counts(docs, key, text, one_in, min_length, min_count), "words")
    pairs = near_words(words)
    each = pairs.unionByName(pairs.select(
        F.col("b").alias("a"), F.col("b_n").alias("a_n"),
        F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = each.groupBy(F.col("a").alias("word"), F.col("a_n").alias("n")).agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("b_n")).alias("m"), F.col("b"))).alias("best"))
    form_n: Column = -F.col("best.m")
    taken = form_n >= times * F.col("n")
    near = stored(best.select("word", "n_near", F.when(taken, F.col("best.b")).alias("form"),
                              F.when(taken, form_n).alias("form_n")), "near-words")
    roots = _roots(near.where("form is not null").select("word", "form"))
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
