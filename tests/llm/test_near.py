from __future__ import annotations

import random

import pytest

from llm_fixtures import frame, small_docs  # noqa: F401
from tidemart.llm.components import components
from tidemart.llm.near import Near, near_groups


def brute(pairs, near):
    """Component of each row by exact sets and all pairs."""
    sets = {}
    for i, text in pairs:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets[i] = {tuple(w[j:j + near.words]) for j in range(max(1, len(w) - near.words + 1))
                   } if w else set()
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    items = sorted(sets.items())
    for x, (i, s) in enumerate(items):
        for j, t in items[:x]:
            if s and t and 100 * len(s & t) >= near.percent * len(s | t):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def variants(seed=3):
    """Groups of edited copies around the threshold, short texts, and chains."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for size in (1, 2, 3, 6, 12, 30, 33, 40, 90, 300):
        base = r.choices(vocabulary, k=size)
        for edits in (0, 0, 1, 1, 1, 2, 3, size // 20, size // 15):
            copy = list(base)
            for _ in range(edits):
                copy[r.randrange(size)] = r.choice(vocabulary)
            out.append(" ".join(copy))
    chain = r.choices(vocabulary, k=120)
    for step in range(25):
        chain = chain[3:] + r.choices(vocabulary, k=3)
        out.append(" ".join(chain))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("near", [Near(words=3, percent=85), Near()])
def test_equal_to_all_pairs(frame, small_docs, near):
    texts = variants() + [r.text for r in small_docs.collect()] + [None, "", " \n", "A b", "a B"]
    pairs = list(enumerate(texts))
    got = near_groups(frame(pairs + [(None, texts[0]), (5, texts[5])]), near).collect()
    assert len(got) == len(pairs) + 2
    want = brute(pairs, near)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], texts[r.doc_id][:80]
            assert r.kept == (r.doc_id == r.component_id)


def test_one_key_with_two_texts(frame):
    a, b = "one two three four five six", "seven eight nine ten eleven"
    got = near_groups(frame([(1, a), (2, a), (2, b), (3, b), (4, "else")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [
        (1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]


def test_nothing(frame):
    assert near_groups(frame([])).count() == 0
    assert near_groups(frame([(None, None), (1, None)])).count() == 2


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(7, 7)]
    found = {r.node: r.component for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]}


def test_an_id_with_many_texts_does_not_mix_them_up(frame):
    words = [f"w{i}" for i in range(60)]
    # an id's short text is in its long one, and like the short text of another id
    short, long = " ".join(words[:12]), " ".join(words)
    other = " ".join(words[:12] + ["x"] * 2 + words[30:50])
    got = near_groups(frame([(1, long), (2, short), (2, other), (3, short + " end")]),
                      Near(words=1, percent=85)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 2), (2, 2), (3, 2)]


def test_tables_that_grow_with_the_documents_are_not_broadcast(spark):
    """Spark takes an exploded or array column for a few bytes, whatever it holds."""
    from pyspark.sql import functions as F

    from tidemart.llm import near as n
    classes = spark.range(40).selectExpr(
        "id", "32L AS n", "transform(sequence(0, 31), x -> cast(x + id % 9 AS bigint)) AS sketch")
    sets = classes.select("id", F.col("sketch").alias("shingles"))
    pairs = spark.range(39).selectExpr("id AS a", "id + 1 AS b", "32L AS n_a", "32L AS n_b")
    lists = spark.range(40).selectExpr("id % 5 AS value", "id", "32L AS n", "1 AS at",
                                       "id AS component")
    for made in (n._lists(classes, Near()), n._whole_lists(sets, Near()),
                 n._estimated(pairs, classes, Near()), n._confirmed(pairs, sets, Near()),
                 n._across(lists, lists.where("true"), Near())):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
