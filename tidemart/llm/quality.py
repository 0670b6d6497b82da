"""Quality rules as a short-circuit cascade of built-in expressions.

``plan_order`` orders rules by rejected rows per second of cost, both estimated on a bounded
sample; ``cascade`` tests them in one CASE, so a row that a rule rejects is not shown to the
later ones. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import SPACES, let, words

#: Characters that count as symbols. Fixed values.
SYMBOLS = "#*$%&|<>"
_WORD = "[^\\x20\\x09-\\x0D]"

Rule = Callable[[Column], Column]


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), SPACES, "")).cast("long")


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def _lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(_WORD)))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _covered(starts: Column) -> Column:
    """Words in windows of three words with the given sorted starts: a window adds three, or
    as many as its distance from the one before."""
    steps = F.transform(starts, lambda i, j: F.least(
        F.lit(3), F.coalesce(i - F.get(starts, j - 1), F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def _repeated_starts(pairs: Column) -> Column:
    """Starts of windows whose hash comes again, from (hash, start) pairs in order."""
    again = F.transform(pairs, lambda p, j: F.when(
        (p["h"] == F.get(pairs, j - 1)["h"]) | (p["h"] == F.get(pairs, j + 1)["h"]), p["i"]))
    return F.sort_array(F.filter(again, lambda i: i.isNotNull()))


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more in an array of words.

    Windows are compared by a 64-bit hash within one text. Only a text in which a window
    comes again has its windows sorted.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(
            pairs, lambda p: let(_repeated_starts(p), _covered))).otherwise(0)

    return F.when(F.size(words) >= 4, let(hashes, count)).otherwise(0).cast("long")


#: The rules of the method, each true where a text passes. A text that fits the base rules
#: and is ordinary prose passes them all.
def few_symbols(text: Column) -> Column:
    """At most one symbol in four words."""
    return 4 * n_symbols(text) <= n_words(text)


def word_length(text: Column) -> Column:
    """Words of 2 to 12 characters on average."""
    return word_chars(text).between(2 * n_words(text), 12 * n_words(text))


def few_shouts(text: Column) -> Column:
    """Exclamation and question marks: at most one for each two words."""
    text = F.coalesce(text, F.lit(""))
    return 2 * (F.length(text) - F.length(F.translate(text, "!?", ""))) <= n_words(text)


def few_capitals(text: Column) -> Column:
    """At most half of all letters A-Z are capitals."""
    text = F.coalesce(text, F.lit(""))
    upper = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return 2 * upper <= F.length(F.regexp_replace(text, "[^A-Za-z]", ""))


def few_equal_lines(text: Column) -> Column:
    """At most half of the lines with a word repeat an earlier line."""
    return let(_lines(text), lambda x: 2 * F.size(F.array_distinct(x)) >= F.size(x))


METHOD: dict[str, Rule] = {
    "few_symbols": few_symbols, "word_length": word_length, "few_shouts": few_shouts,
    "few_capitals": few_capitals, "few_equal_lines": few_equal_lines,
}


def enough_words(text: Column) -> Column:
    """Base rule: 50 words or more."""
    return n_words(text) >= 50


def few_repeats(text: Column) -> Column:
    """Base rule: at most half of the words are in repeated 3-word windows."""
    return let(words(text), lambda w: 100 * repeat_words(w) <= 50 * F.size(w))


BASE: dict[str, Rule] = {"enough_words": enough_words, "few_repeats": few_repeats}


def plan_order(docs: DataFrame, rules: Mapping[str, Rule], text: str = "text",
               sample_rows: int = 2000) -> list[str]:
    """Names of the rules, most rejections per second first.

    Cost and rejection are measured on the first ``sample_rows`` rows. The sample fixes the
    order of work alone; each rule still sees every row that reaches it.
    """
    sample = docs.select(F.col(text).alias("t")).limit(sample_rows).repartition(1).persist()
    rows = max(1, sample.count())

    def seconds(measure: Column) -> tuple[float, float]:
        start = time.perf_counter()
        rejected = sample.agg(measure).first()[0] or 0
        return time.perf_counter() - start, rejected

    seconds(F.sum(F.length("t")))
    base, _ = seconds(F.sum(F.length("t")))
    gain = {}
    for name, rule in rules.items():
        cost, rejected = seconds(F.sum((~rule(F.col("t"))).cast("long")))
        gain[name] = (rejected / rows) / max(cost - base, 1e-3)
    sample.unpersist()
    return sorted(gain, key=lambda name: (-gain[name], name))


def cascade(text: Column, rules: Mapping[str, Rule], order: list[str]) -> Column:
    """Boolean: every rule passes. Later rules are not evaluated for rejected rows."""
    verdict = F.when(F.lit(False), F.lit(False))
    for name in order:
        verdict = verdict.when(~rules[name](text), F.lit(False))
    return verdict.otherwise(F.lit(True))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text",
           sample_rows: int = 2000) -> DataFrame:
    """Counts and verdict of each row of ``docs``; repeated rows and null keys stay.

    Null and empty texts have no words: all counts are 0 and ``base_failed`` is true.
    ``base_failed``: fewer than 50 words, or over half of them in repeated 3-word windows.
    ``kept``: not ``base_failed``, and every rule of ``METHOD`` passes.
    """
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    order = plan_order(rows, METHOD, "text", sample_rows)
    counted = rows.withColumn("_n", let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("words"), repeat_words(w).alias("repeated"))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.select(
        key, F.col("_n.words").alias("n_words"), word_chars(F.col("text")).alias("word_chars"),
        n_symbols(F.col("text")).alias("n_symbols"), n_dup_lines(F.col("text")).alias(
            "n_dup_lines"), F.col("_n.repeated").alias("n_repeat_words"), "text",
    ).withColumn("base_failed", failed).withColumn("kept", F.when(
        F.col("base_failed"), F.lit(False)).otherwise(
        cascade(F.col("text"), METHOD, order))).drop("text")


def keep_good(docs: DataFrame, text: str = "text", sample_rows: int = 2000) -> DataFrame:
    """Rows of ``docs`` that pass all rules of ``BASE`` and ``METHOD``, columns unchanged.

    One cascade: a text that a cheap rule rejects never has its windows compared.
    """
    rules = BASE | METHOD
    order = plan_order(docs, rules, text, sample_rows)
    return docs.where(cascade(F.col(text), rules, order))
