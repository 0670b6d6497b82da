from __future__ import annotations

import pytest
from conftest import rows
from llm_fixtures import frame  # noqa: F401

from tidemart.llm import quality, urls
from tidemart.llm.queries import URL_RULES

PROSE = " ".join(f"word{i} of the" for i in range(30))


def verdicts(spark, given, rules=URL_RULES):
    pages = spark.createDataFrame(
        [(i, u, None, "x") for i, u in enumerate(given)],
        "page_id long, url string, html string, host string")
    judged = urls.judge(pages, spark.createDataFrame(rules, urls.RULE_COLUMNS))
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged.collect()}


def test_url_rules(spark):
    got = verdicts(spark, [
        "http://a.NET/x?y", "https://w.example.net/en/1#t", "https://example.net/enx",
        "http://example.com/de/", "http://notexample.com/de/", "http://x.org/fr/a/b",
        None, "", "no scheme/net/", "http://net", "http://a.net?/x", "http://a.net:80/",
        "x://b.net//", "http://" + "a." * 3000 + "net/" + "b/" * 3000])
    assert [v[2:] for _, v in sorted(got.items())] == [
        ("net/", "block"), ("example.net/en/", "allow"), ("net/", "block"),
        ("example.com/de/", "block"), (None, "allow"), ("org/fr/", "allow"),
        (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
        (None, "allow"), ("net/", "block"), ("net/", "block")]
    assert got[0][:2] == ("a.net", "/x") and got[6][:2] == ("", "") and got[9][:2] == ("net", "")


def test_url_edges(spark):
    assert len(verdicts(spark, ["http://a.net/"] * 3)) == 3
    assert verdicts(spark, []) == {}
    both = [("a.b", "/", "allow"), ("a.b", "/", "block"), (None, "/", "block")]
    assert verdicts(spark, ["http://a.b/"], both)[0][2:] == ("a.b/", "block")
    assert verdicts(spark, ["http://a.b/"], [("", "/", None)])[0][2:] == (None, "allow")
    with pytest.raises(ValueError):
        verdicts(spark, ["http://a.b/"], [("a.b", "/x", "block")])


def repeated(text):
    w = text.split()
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    return len({i + d for i, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)})


def test_quality_counts(frame):
    texts = [None, "", " \t\n", "a b", "a b c", "a a a a", "a b c a b c x a b", PROSE,
             PROSE + " #$%" * 40, (PROSE + "\n") * 2, "x y z " * 2000, "#a\n\n#a\n b\n#a"]
    docs = frame(list(enumerate(texts)) + [(None, PROSE), (7, PROSE)])
    got = quality.report(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = (PROSE if r.doc_id is None else texts[r.doc_id]) or ""
        assert r.n_words == len(text.split())
        assert r.n_repeat_words == repeated(text), text[:80]
        assert r.word_chars == len("".join(text.split()))
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
    by_id = {r.doc_id: r for r in got}
    assert by_id[7].kept and by_id[None].kept and not by_id[8].kept and not by_id[0].kept
    assert by_id[11].n_dup_lines == 2 and by_id[11].n_symbols == 3
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == sorted(
        ((r.doc_id,) for r in got if r.kept), key=repr)


def test_quality_of_nothing(frame):
    assert quality.report(frame([])).count() == 0
    assert quality.keep_good(frame([])).count() == 0


def test_order_follows_rejections_per_cost(frame):
    docs = frame([(i, PROSE + " !?" * 60) for i in range(50)])
    order = quality.plan_order(docs, quality.METHOD)
    assert sorted(order) == sorted(quality.METHOD) and order[0] == "few_shouts"
