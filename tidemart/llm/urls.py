"""URL rules: host-suffix and path-prefix expressions joined on short digests.

A rule is a host, a path that starts and ends with ``/``, and a verdict. It fits its host
and every subdomain, below its path. Each distinct (host, path) of the input is expanded
into the expressions that could be a rule (never deeper than the deepest rule), they meet
the rules in an equi-join on the first four bytes of a SHA-256 digest, and the full digest
confirms. The longest rule wins; of two verdicts for one expression, ``block`` wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ascii_lower

RULE_COLUMNS = "host string, path string, verdict string"


def _rest(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def expressions(host: Column, path: Column, labels: int, depth: int) -> Column:
    """Array of host suffix + path prefix, with at most ``labels`` labels and ``depth``
    slashes. A path prefix ends with a slash."""
    parts = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda n: F.array_join(F.slice(parts, -n, n), "."))
    heads = F.split(path, "/", depth + 1)
    # an empty path has one part and no slash
    depths = F.when(F.size(heads) > 1, F.sequence(F.lit(1), F.size(heads) - 1)).otherwise(
        F.array().cast("array<int>"))
    prefixes = F.transform(depths, lambda n: F.concat(
        F.array_join(F.slice(heads, 1, n), "/"), F.lit("/")))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id",
          url: str = "url") -> DataFrame:
    """``key, host, path, rule, verdict`` for each row of ``pages``, repeated rows included.

    ``rules`` has the columns host, path and verdict. ``rule`` is host + path of the rule
    that fits, else null, and then the verdict is ``default``. A null URL or one without
    ``://`` has an empty host and path and fits no rule; a URL without a path fits none
    either. Null and empty rules, and other columns, are ignored. Raises ``ValueError`` for
    a rule path that does not start and end with a slash.
    """
    rules = rules.select(
        ascii_lower(F.col("host")).alias("h"), F.col("path").alias("p"),
        F.col("verdict").alias("v")).dropna()
    shape = rules.agg(
        F.max(F.size(F.split("h", r"\."))).alias("labels"),
        F.max(F.size(F.split("p", "/")) - 1).alias("depth"),
        F.max(~(F.startswith(F.col("p"), F.lit("/"))
                & F.endswith(F.col("p"), F.lit("/")))).alias("bad")).first()
    if shape["bad"]:
        raise ValueError("the path of a rule must start and end with a slash")
    ready = rules.select(
        F.concat("h", "p").alias("rule"), "v",
        _digest(F.concat("h", "p")).alias("rule_digest")).withColumn(
            "short", F.substring("rule_digest", 1, 8))
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"),
                        path_of(F.col(url)).alias("path"))
    asked = rows.select("host", "path").distinct().select(
        "host", "path", F.explode(expressions(
            F.col("host"), F.col("path"), shape["labels"] or 1, shape["depth"] or 1)
        ).alias("expression")).withColumn("digest", _digest(F.col("expression"))).withColumn(
            "short", F.substring("digest", 1, 8))
    found = asked.join(ready, "short").where(
        (F.col("digest") == F.col("rule_digest")) & (F.col("expression") == F.col("rule")))
    best = found.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), "rule", "v")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        key, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.v", F.lit(default)).alias("verdict"))
