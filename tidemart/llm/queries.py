"""The registered queries of this subpackage and, where SQL can state them, their twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    chat, html, leaks, licenses, lm, near, packing, quality, repeats, spelling, tokens, urls,
    whitening,
)
from tidemart.llm.common import table

Run = Callable[[SparkSession, str], DataFrame]
ROOT = str(Path(__file__).resolve().parents[2])


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def prepare(spark: SparkSession) -> None:
    """Lets workers import this package from where the driver found it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def query(name: str, sql: str | None = None):
    def add(run: Run) -> Run:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return run(spark, sf_dir)
        QUERIES[name] = Query(prepared, sql)
        return prepared
    return add


def vocabulary(name: str) -> str:
    """File of a public tokenizer on this machine and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_suffix_dedup")
def _(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query("op2_decontamination")
def _(spark, sf_dir):
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_lm_scores")
def _(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"))


@query("op10_license_scan")
def _(spark, sf_dir):
    templates = spark.createDataFrame(licenses.TEMPLATES, licenses.TEMPLATE_COLUMNS)
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, templates).unionByName(licenses.spdx_tags(docs))


#: Rules (host, path, verdict) of the URL query. Fixed values.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_URL_SQL = """
with rest as (
  select page_id, case when strpos(url, '://') > 0
    then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), cut as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest
), rules(h, p, v) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), judged as (
  select page_id, host, path, (
    select max(struct_pack(n := length(h || p), rule := h || p, v := v)) from rules
    where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)) as best from cut
)
select page_id, host, path, best.rule as rule, coalesce(best.v, 'allow') as verdict from judged
"""


@query("op4_url_filter", _URL_SQL)
def _(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, urls.RULE_COLUMNS)
    return urls.judge(table(spark, sf_dir, "pages"), rules)


@query("op3_html_text")
def _(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@query("op5_minhash_dedup")
def _(spark, sf_dir):
    return near.near_groups(table(spark, sf_dir, "documents"), near.Near(words=3, percent=85))


@query("op6_token_counts")
def _(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"),
                               vocabulary("byte_bpe_50k.json"))


_QUALITY_SQL = r"""
with split as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents
), pos as (
  select r, unnest(generate_series(1, len(w) - 2)) as i, w from split
), win as (
  select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2]) as n from pos
), rep as (
  select r, count(distinct i + d) as n_repeat_words from win, (values (0), (1), (2)) s(d)
  where n > 1 group by r
), counted as (
  select split.*, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(l) - len(list_distinct(l)) as n_dup_lines, len(l) as n_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    length(regexp_replace(t, '[^!?]', '', 'g')) as shouts,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) as capitals,
    length(regexp_replace(t, '[^A-Za-z]', '', 'g')) as letters
  from split left join rep using (r)
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
  cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
  not base_failed and 4 * n_symbols <= n_words
    and word_chars between 2 * n_words and 12 * n_words and 2 * shouts <= n_words
    and 2 * capitals <= letters and 2 * (n_lines - n_dup_lines) >= n_lines as kept
from judged
"""


@query("op7_quality_rules", _QUALITY_SQL)
def _(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"))


@query("op8_packing")
def _(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op11_chat_format")
def _(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))],
        turns.schema)
    content = chat.text_part(F.col("text"))
    return chat.digests(chat.format_chats(
        turns.unionByName(probe).select("conv_id", "turn", "role", content.alias("content"))))


@query("op12_spelling_variants")
def _(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op13_embedding_whitening")
def _(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
