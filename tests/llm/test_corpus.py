from __future__ import annotations

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm_fixtures import frame, small_docs  # noqa: F401
from tidemart.llm import exchange, html, leaks, licenses, lm
from tidemart.llm.common import words

PROSE = " ".join(f"word{i} of the" for i in range(30))


# ------------------------------------------------------------- language model

@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_scores_equal_plain_counts(frame, small_docs, monkeypatch, order):
    monkeypatch.setattr(exchange.blocks, "__defaults__", (100_000,))
    texts = [r.text for r in small_docs.collect()] + [None, "", " ", "One", "one  ONE\tone", "é É"]
    pairs = list(enumerate(texts)) + [(None, "one one"), (3, texts[3])]
    tokens = [(t or "").encode().lower().split() for _, t in pairs]
    counts = Counter(tuple(t[i:i + k]) for t in tokens for k in range(1, order + 1)
                     for i in range(len(t) - k + 1))
    total = sum(map(len, tokens))

    def plain(gram):
        """Log score of the last word after the others, and the steps back."""
        if len(gram) == 1:
            return math.log(counts[gram] / total), 0
        if counts[gram] >= 2:
            return math.log(counts[gram] / counts[gram[:-1]]), 0
        score, steps = plain(gram[1:])
        return math.log(0.4) + score, steps + 1

    got = lm.score(frame(pairs), min_count=2, backoff=0.4, order=order).collect()
    assert len(got) == len(pairs)
    for r in got:
        if r.doc_id is None:
            continue
        t = tokens[r.doc_id]
        found = [plain(tuple(t[max(0, i + 1 - order):i + 1])) for i in range(len(t))]
        assert (r.n_tokens, r.n_backoff) == (len(t), sum(n for _, n in found))
        assert r.log_score == pytest.approx(sum(s for s, _ in found), abs=1e-6)
        assert (r.mean_log_score is None) == (not t)
    assert lm.score(frame([]), order=order).count() == 0


def test_a_block_hashes_each_word_once_and_asks_in_one_order(monkeypatch):
    """Rows of a block come in another order each time it is read."""
    texts = ["One one\ttwo", "", " two\x0bTWO three ", "\x1cÉ é", "one two three", "x" * 70]
    hashed, plain = [], lm.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(lm.xxhash, "xxh3_64_intdigest", lambda w: hashed.append(w) or plain(w))

    def grams(rows):
        return lm.Grams(pa.table({"block": pa.array([7] * len(rows), pa.int64()),
                                  "text": pa.array(rows, pa.string())}), 3)
    one, other = grams(texts), grams(texts[::-1])
    tokens = [t.encode().lower().split() for t in texts]
    assert len(hashed) == 2 * len(set().union(*tokens))
    assert one.sizes.tolist() == other.sizes.tolist()[::-1] == [len(t) for t in tokens]
    assert one.keys.tolist() == other.keys.tolist()
    assert one.counts.tolist() == other.counts.tolist()
    for k, (at, keyed) in enumerate(zip(one.ends, one.keyed)):
        words = [w for t in tokens for w in t]
        want = Counter(tuple(words[i - k:i + 1]) for i in at)
        got = {tuple(words[i - k:i + 1]): int(one.counts[x]) for i, x in zip(at, keyed)}
        assert got == want
    assert len(grams([]).keys) == 0


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16, (1 << 16) + 1])
def test_keys_are_asked_by_bucket(buckets):
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    order = exchange.order_of(keys, buckets)
    assert order.tolist() == sorted(range(len(keys)), key=lambda i: int(keys[i]) % buckets)


# ------------------------------------------------------------- benchmark leaks

def plain_tiles(doc, item, least):
    """Greedy string tiling by trying all pairs of positions; of equally long runs that which
    comes first in the item, then in the doc."""
    size, out = max(1, min(least, len(item))), []
    doc, item = list(doc), list(item)
    while True:
        best = (0, 0, 0)
        run = [0] * (len(doc) + 1)
        for y in reversed(range(len(item))):
            run = [run[x + 1] + 1 if doc[x] is not None and doc[x] == item[y] else 0
                   for x in range(len(doc))] + [0]
            n = max(run)
            if n >= best[0]:
                best = (n, run.index(n), y)
        n, x, y = best
        if n < size:
            return out
        out.append((x, y, n))
        doc[x:x + n] = item[y:y + n] = [None] * n


def test_tiles_equal_the_plain_method():
    r = random.Random(2)
    for _ in range(400):
        k, least = r.choice([1, 2, 3, 4, 9]), r.choice([1, 2, 3, 5])
        doc = np.array(r.choices(range(k), k=r.randrange(0, 60)), dtype=np.uint64)
        item = np.array(r.choices(range(k), k=r.randrange(0, 30)), dtype=np.uint64)
        if r.random() < .5 and len(item):
            doc = np.concatenate([doc, item[len(item) // 3:], doc[:7], item[:len(item) // 2]])
        assert leaks.tiles(doc, item, least) == plain_tiles(doc.tolist(), item.tolist(), least)


def test_tiles_of_long_repeated_texts():
    """A million equal tokens against 400: memory by tokens, not by pairs of places."""
    doc = np.full(1_000_000, 7, np.uint64)
    doc[123_456] = 8
    tracemalloc.start()
    found = leaks.tiles(doc, np.r_[np.full(399, 7), 8].astype(np.uint64), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(123_057, 0, 400)] and peak < 200 << 20
    assert leaks.tiles(doc, doc[:400], 5) == [(0, 0, 400)]


def test_leaks_equal_all_pairs(spark, small_docs):
    """All documents and items against the plain method; a pair without a common run of five
    words cannot hold half of an item, shorter items aside."""
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    words_of = lambda t: re.findall(r"\w+", (t or "").lower())
    docs = {d.doc_id: words_of(d.text) for d in small_docs.collect()}
    runs = {i: {tuple(d[p:p + 5]) for p in range(len(d) - 4)} for i, d in docs.items()}
    want = set()
    for row in bench.collect():
        t = words_of(row.text)
        assert len(t) >= 5
        own = {tuple(t[p:p + 5]) for p in range(len(t) - 4)}
        for i, d in docs.items():
            if own & runs[i]:
                found = plain_tiles(d, t, 5)
                covered = sum(n for _, _, n in found)
                if 100 * covered >= 50 * len(t):
                    want.add((i, row.item_id, len(found), covered, len(t)))
    got = leaks.leaks(small_docs, bench).collect()
    assert want and {tuple(r)[:5] for r in got} == want and len(got) == len(want)


def test_leaks_of_repeated_and_null_items(spark, frame):
    r = random.Random(5)
    a, b = (" ".join(f"t{r.randrange(5000)}" for _ in range(30)) for _ in range(2))
    bench = spark.createDataFrame([(1, a), (1, b), (None, a), (1, a), (2, "t1 " * 400)],
                                  "item_id long, text string")
    docs = frame([(5, a), (6, b), (None, a), (7, "T1 " * 50_000), (8, "t1 " * 199)])
    got = leaks.leaks(docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id, r.covered_tokens) for r in got), key=repr) == sorted(
        [(5, 1, 30), (5, None, 30), (6, 1, 30), (None, 1, 30), (None, None, 30), (7, 2, 400)],
        key=repr)
    assert leaks.leaks(docs.where("doc_id = 8"), bench, percent=49).first().covered_tokens == 199


def test_leaks(spark, frame):
    r = random.Random(4)
    some = lambda n: [f"t{r.randrange(5000)}" for _ in range(n)]
    items = [some(n) for n in (40, 25, 15, 60, 3)]
    bench = spark.createDataFrame(
        [(i, " ".join(t), "x") for i, t in enumerate(items)] + [(9, None, "x"), (8, "", None),
                                                               (0, " ".join(items[0]), "x")],
        "item_id long, text string, doc_id string")
    a = items[0]
    docs = [" ".join(some(80)), " ".join(some(30) + a + some(5)),
            " ".join(some(9) + a[20:] + some(30) + a[:20]), " ".join(some(9) + a[:16] + some(9)),
            " ".join(a[:24]).upper(), None, "", " ".join(some(3) + items[4] + some(2)),
            " ".join(some(50) + items[1] + items[3])]
    pairs = list(enumerate(docs)) + [(None, docs[1]), (1, docs[1])]
    got = leaks.leaks(frame(pairs), bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=repr) == sorted(
        [(1, 0), (2, 0), (4, 0), (7, 4), (8, 1), (8, 3), (None, 0)], key=repr)
    assert {r.doc_id: r.n_tiles for r in got if r.item_id == 0} == {1: 1, 2: 2, 4: 1, None: 1}
    assert leaks.leaks(frame([]), bench).count() == 0
    assert leaks.leaks(frame(pairs), bench.where("item_id > 100")).count() == 0


# ------------------------------------------------------------- licences

def contained(text, template, size=3):
    grams = [tuple((t or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()) for t in (text, template)]
    w, t = grams
    t = {t[i:i + size] for i in range(len(t) - size + 1)}
    step = 2 ** max(3, math.ceil(math.log2(len(template.split()))))
    best = 0
    for start in range(0, len(w), step):
        part = w[start:start + 2 * step]
        best = max(best, len(t & {part[i:i + size] for i in range(len(part) - size + 1)}))
    return best if 100 * best >= 80 * len(t) else 0


def test_licences(spark, frame, small_docs):
    texts = [r.text for r in small_docs.collect()] + [None, "", "the the the"]
    for n, (_, t) in enumerate(licenses.TEMPLATES):
        texts += [t, PROSE + " " * n + t.upper() + "\n" + PROSE, "w " * (n * 7) + t,
                  t[: int(.7 * len(t))], PROSE + " " + t.replace("the", "a", 1) + " end"]
    pairs = list(enumerate(texts)) + [(None, texts[-1] + " " + licenses.TEMPLATES[0][1]), (3, texts[3])]
    templates = spark.createDataFrame(licenses.TEMPLATES + [("none", None), ("short", "a b")],
                                      licenses.TEMPLATE_COLUMNS)
    got = licenses.scan(frame(pairs), templates).collect()
    want = sorted((i, name, n) for i, text in enumerate(texts)
                  for name, t in licenses.TEMPLATES if (n := contained(text, t)))
    assert sorted((r.doc_id, r.license, r.n_shared) for r in got if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in got) >= 1
    assert licenses.scan(frame([]), templates).count() == 0
    assert licenses.scan(frame(pairs), templates.limit(0)).count() == 0


def test_licence_families(spark, frame):
    gpl = ("This {0} is free software; you can redistribute it and/or modify it under the terms of "
           "the GNU {1}General Public License as published by the Free Software Foundation; either "
           "version {2} of the License, or (at your option) any later version.")
    texts = {
        "(c) 2020 Acme. All rights reserved": {"All-Rights-Reserved"},
        "Licensed under CC BY-NC 4.0": {"CC-BY-NC-4.0"},
        " * 'Licensed under the Apache License, Version 2.0 (the \"License\");": {"Apache-2.0"},
        gpl.format("program", "", "2"): {"GPL-2.0"}, gpl.format("program", "", "3"): {"GPL-3.0"},
        gpl.format("library", "Lesser ", "2.1"): {"LGPL-2.1"},
        gpl.format("program", "Affero ", "3"): {"AGPL-3.0"},
        "This is free and unencumbered software, released into the public domain": {"Unlicense"}}
    templates = spark.createDataFrame(licenses.TEMPLATES, licenses.TEMPLATE_COLUMNS)
    pairs = list(enumerate(PROSE + "\n" + t + "\n" + PROSE for t in texts))
    got = {}
    for r in licenses.scan(frame(pairs), templates).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert got == dict(enumerate(texts.values()))

    tags = ["// SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC */", None, "SPDX MIT",
            "spdx-license-identifier: GPL-2.0-only WITH Classpath-exception-2.0.\nx"]
    found = licenses.spdx_tags(frame(list(enumerate(tags)) + [(0, tags[0])])).collect()
    assert sorted((r.doc_id, r.license) for r in found) == [
        (0, "Apache-2.0"), (0, "ISC"), (0, "MIT"),
        (3, "GPL-2.0-only WITH Classpath-exception-2.0")]


def test_licence_bands_keep_the_miss_rate():
    for n, class_ in ((1, 3), (3, 3), (31, 6), (38, 6)):
        bands = licenses.bands_of(n, class_, 3, 80, 32)
        shared = math.ceil(.8 * n)
        j = shared / (n - shared + 2 * 2 ** class_ - 2)
        assert bands >= 32 and (1 - j) ** bands <= 1e-5


# ------------------------------------------------------------- HTML

FUNCTION_WORDS = "the of and house " * 20


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain of text", ""), ("<p>", ""),
    ("<nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>One\n two<p>Three&#33;</article>"
     "<footer>&copy; x</footer>", "A & B\nOne two\nThree!"),
    ("<article><p>One <script>if (a < '</p>') b()</script>two<!-- <p>no --></p>"
     "<div class='ad box'>Buy the of and</div><aside>side</aside><form>f</form>"
     "<section id=comments><p>the of and</p></section><p>End <b>b</b>old</p></article>",
     "One two\nEnd bold"),
    (f"<div id=menu>m</div><p>{FUNCTION_WORDS}</p><p>short</p><p>{FUNCTION_WORDS}</p>"
     "<div><a href=q>" + "link the " * 30 + "</a></div><p>tail</p>",
     f"{FUNCTION_WORDS.strip()}\nshort\n{FUNCTION_WORDS.strip()}"),
    (f"<article><p title='a>b'>{FUNCTION_WORDS}<br>x</p></article", FUNCTION_WORDS + "x"),
])
def test_main_text(page, text):
    assert html.main_text(page or "") == text


@pytest.mark.parametrize("name", [
    "comment-body", "comment-text", "ad-content", "sidebar-content", "newsletter-body",
    "cookie-text", "footer-content", "related-article", "main-navigation", "content sidebar"])
def test_boilerplate_names(name):
    page = (f"<article><p>{FUNCTION_WORDS}</p><div class='{name}'><p>{FUNCTION_WORDS}x</p></div>"
            f"<p>the end</p></article>")
    assert html.main_text(page) == f"{FUNCTION_WORDS.strip()}\nthe end"
    if "article" not in name:
        assert html.main_text(page.replace("article", "div")) == FUNCTION_WORDS.strip()


@pytest.mark.parametrize("name", ["has-sidebar", "content-sidebar-wrap", "body-text", "entry",
                                  "no-comments", "story-layout", "article-content"])
def test_names_around_main_text(name):
    page = f"<div class='{name}'><p>{FUNCTION_WORDS}</p></div>"
    assert html.main_text(page) == FUNCTION_WORDS.strip()


def test_text_that_is_no_boilerplate():
    long = FUNCTION_WORDS.strip()
    assert html.main_text("<p>Short one.</p>") == "Short one."
    assert html.main_text("<ul><li>a<li>b</ul><nav><a href=x>menu</a></nav>") == "a\nb"
    assert html.main_text(f"<article><p>{long}</p><p>Photo \u00a9 Ann, of the year</p>"
                          "<p>\u00a9 2024 Press</p></article>") == (
        f"{long}\nPhoto \u00a9 Ann, of the year")
    # a teaser beside the post
    page = (f"<div><h1>Post</h1><p>{long}</p><p>{long}</p></div>"
            "<article><h2><a href=x>Other news of the day</a></h2></article>")
    assert html.main_text(page) == f"Post\n{long}\n{long}"
    # a link around blocks, and one that is never closed
    page = (f"<p>{long}</p><a href=x><div>{long}</div><div>{long}</div></a>"
            f"<p><a href=y>open</p><p>{long}</p>")
    assert html.main_text(page) == f"{long}\n{long}"


def test_pages(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<article><p>é of</article>"),
            (2, "v", "x" * 100_000 + "<div>" * 50_000 + "<" * 1000)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 4
    assert [(r.text, r.n_chars) for r in got if r.page_id is None] == [("é of", 4)]
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ------------------------------------------------------------- pipeline

def test_pipeline(spark, tmp_path):
    import corpus_pipeline as pipeline

    r = random.Random(8)
    some = lambda n: " ".join(f"t{r.randrange(5000)}" for _ in range(n))
    a, passage, leak = some(100), some(60), some(30)
    texts = [a, a + " more", some(10), some(80) + passage, passage + some(90), some(60) + leak,
             "#$% " * 90, None, "", a]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _w string"
    docs = spark.createDataFrame(
        [(i, t, None, "s", len(t or ""), None) for i, t in enumerate(texts)]
        + [(None, some(70), None, None, None, None), (3, texts[3], None, None, 1, None)], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    seen, now = [], docs
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == docs.columns and out.schema["n_chars"].dataType.simpleString() == "bigint"
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(sorted((x.doc_id for x in now.collect()), key=repr))
    assert seen == [sorted([0, 1, 3, 3, 4, 5, 9, None], key=repr), [0, 3, 4, 5, None],
                    [0, 3, 4, 5, None], [0, 3, 4, None]]
    kept = {x.doc_id: x for x in now.collect()}
    assert passage[5:-5] in kept[3].text and passage[5:-5] not in kept[4].text
    assert kept[4].n_chars == len(kept[4].text)
    packed = pipeline.run(spark, str(tmp_path))
    assert {x.doc_id for x in packed.collect()} == {0, 3, 4, None}
    assert pipeline.STAGES[-1][1](spark, now, "").count() == packed.count()


def test_one_id_over_many_texts(spark, tmp_path):
    import corpus_pipeline as pipeline

    r = random.Random(9)
    some = lambda n: " ".join(f"t{r.randrange(5000)}" for _ in range(n))
    hot = [some(80) for _ in range(40)]
    a, b, passage = some(100), some(100), some(60)
    pairs = [(7, t) for t in hot] + [(1, a), (2, a), (2, b), (3, b + " more"), (7, hot[3]),
                                     (8, hot[5] + " more"), (6, hot[6])]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in pairs],
                                 "doc_id long, text string, n_chars long")
    got = sorted((x.doc_id, x.text) for x in pipeline.near_duplicates(spark, docs, "").collect())
    assert got == sorted([(7, t) for t in hot if t != hot[6]] + [(1, a), (2, b), (6, hot[6])])

    # two texts of one id, equally long: each loses its own part
    tails = [some(100)[:400], some(100)[:400]]
    rows = [(1, passage + some(60)), (2, tails[0] + passage), (2, passage + tails[1]), (2, None)]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows],
                                 "doc_id long, text string, n_chars long")
    got = {x.text for x in pipeline.repeated_passages(spark, docs, "").collect()}
    assert len(rows[1][1]) == len(rows[2][1]) and len(got) == 4 and None in got
    assert all(any(t and tail[10:-10] in t for t in got) for tail in tails)


def test_one_leaked_text_takes_no_other_along(spark, tmp_path):
    import corpus_pipeline as pipeline

    r = random.Random(10)
    some = lambda n: " ".join(f"t{r.randrange(5000)}" for _ in range(n))
    leak = some(30)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    clean = [(None, some(40)), (None, some(50)), (None, None), (4, some(40)), (5, some(40))]
    docs = spark.createDataFrame(
        clean + [(None, some(20) + " " + leak), (4, leak), (6, leak)], "doc_id long, text string")
    got = pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(clean, key=repr)


def test_words_are_split_at_ascii_space(spark):
    df = spark.createDataFrame([(" a\tb c \x0b\x1cd ",), (None,)], "t string")
    assert [r[0] for r in df.select(words(df.t)).collect()] == [["a", "b c", "\x1cd"], []]
