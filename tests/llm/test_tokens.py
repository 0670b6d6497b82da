from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import frame, small_docs  # noqa: F401
from tidemart.llm import packing, tokens
from tidemart.llm.queries import vocabulary

EDGES = [None, "", " ", "\n\n  a", "aaaaaaaaaaaaa aaa", "x<|endoftext|>y <|endoftext|>",
         "it's we'll  'S\u00a0z\u2003\u0085q\x1cq", "١٢٣ 日本語テキスト 🙂🙂🙂", "a" * 30_000,
         "ab" * 9_000 + " " * 500 + "c", "\t\r\n x \n"]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    return {n: Tokenizer.from_file(vocabulary(n))
            for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def want(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts],
                                                  add_special_tokens=False)]


def test_counts_equal_the_library(frame, small_docs, reference):
    texts = EDGES + [r.text for r in small_docs.collect()]
    docs = frame(list(enumerate(texts)) + [(None, "null key"), (3, EDGES[3])])
    got = tokens.token_counts(docs, vocabulary("byte_bpe_50k.json")).collect()
    assert len(got) == len(texts) + 2
    ids = want(reference["byte_bpe_50k.json"], texts)
    for r in got:
        if r.doc_id is not None:
            assert r.n_tokens == len(ids[r.doc_id]), texts[r.doc_id]
            assert r.n_bytes == len((texts[r.doc_id] or "").encode())
            assert r.over_limit == (r.n_tokens > 512)


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab '\n\tls.")),
               max_size=60))
def test_counts_of_any_text(reference, text):
    path = vocabulary("byte_bpe_50k.json")
    assert tokens.merges(path).count_texts([text]) == [
        len(want(reference["byte_bpe_50k.json"], [text])[0])]


#: Letters that the normalizer takes apart or changes, with marks and stops around.
AWKWARD = ["İ", "ı", "ß", "ẞ", "ς", "Σ", "é", "e\u0301", "\u0301", "क़", "ড়", "ਲ਼", "ଡ଼", "क", "़",
           "ﬁ", "Å", "\u212b", "日", "ア", "か\u3099", "한", "\u1112\u1161", "א", "שׁ", "a", "Z",
           ".", ",", ".,", " ", "\n", "'s", "<|", "1", "٣", "\u200d", "-", "🙂"]


@settings(max_examples=800, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(AWKWARD), st.characters(codec="utf-8")), max_size=14
                ).map("".join))
def test_ids_of_any_text(reference, text):
    found = packing.ids(vocabulary("word_bpe_49k.json")).encode([text])[0]
    assert np.frombuffer(found, "<u4").tolist() == want(reference["word_bpe_49k.json"], [text])[0]


def test_stops_after_every_letter(reference):
    letters = [c for c in map(chr, range(0x30000)) if c.isalpha() and not "\ud800" <= c <= "\udfff"]
    texts = [f"x{c}{end} " for c in letters for end in (".", ",")]
    encoder = packing.Ids(vocabulary("word_bpe_49k.json"))
    joined = [" ".join(texts[i:i + 400]) for i in range(0, len(texts), 400)]
    ids = want(reference["word_bpe_49k.json"], joined)
    for text, right, found in zip(joined, ids, encoder.encode(joined)):
        assert np.frombuffer(found, "<u4").tolist() == right, text


def test_the_library_sees_each_word_once(reference, monkeypatch):
    """Case of plain letters and marks after a word make no new words for the library."""
    plain = [f"{a}{b}{c}" for a in ("été", "of", "über") for b in ("ba", "né", "çø") for c in "xyz"]
    marks = ["", ".", "%%%", "?!", "'", ".'", "<|", "|>,"]
    texts = [" ".join(form(w) + m for w in plain for m in marks)
             for form in (str.lower, str.upper, str.title)]
    encoder, asked = packing.Ids(vocabulary("word_bpe_49k.json")), []
    library = encoder._encode
    monkeypatch.setattr(encoder, "_encode",
                        lambda words: asked.extend(" ".join(words).split()) or library(words))
    found = encoder.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == want(
        reference["word_bpe_49k.json"], texts)
    assert len(asked) <= len(plain) + len(marks)


def test_ids_when_the_memory_of_words_is_full(reference, small_docs, monkeypatch):
    monkeypatch.setattr(packing, "_KEPT", 40)
    texts = [t or "" for t in EDGES] + [r.text for r in small_docs.limit(40).collect()]
    encoder = packing.Ids(vocabulary("word_bpe_49k.json"))
    for part in ([], texts, texts[:3], texts[::-1], ["", ""]):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(part)] == want(
            reference["word_bpe_49k.json"], part)
        assert len(encoder.known) <= 40


def test_empty_tables(frame):
    assert tokens.token_counts(frame([]), vocabulary("byte_bpe_50k.json")).count() == 0
    assert packing.pack(frame([]), vocabulary("word_bpe_49k.json")).count() == 0


def test_every_id_is_packed_once(frame, small_docs, reference):
    texts = EDGES + [r.text for r in small_docs.collect()]
    docs = frame(list(enumerate(texts)) + [(None, "null key"), (3, EDGES[3])])
    got = packing.pack(docs, vocabulary("word_bpe_49k.json")).collect()
    ids = [x + [1] for x in want(reference["word_bpe_49k.json"], texts)]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert len(by_doc.pop(None)) == 1
    assert len(by_doc[3]) == 2
    del by_doc[3][1]
    for i, rows in by_doc.items():
        rows.sort(key=lambda r: r.start)
        at = 0
        for r in rows:
            assert r.start == at and r.doc_tokens == len(ids[i])
            cut = np.array(ids[i][at:at + r.length], dtype="<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(cut)
            at += r.length
        assert at == len(ids[i])
    fills = []
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == list(np.cumsum([0] + [r.length for r in rows])[:-1])
        fills.append(sum(r.length for r in rows))
    assert max(fills) <= 2048
    assert sum(fills) >= 0.97 * 2048 * (len(fills) - 1)


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50)))
def test_histogram_is_packed_whole(counts):
    packed = defaultdict(int)
    for pattern, times in packing.pack_histogram(counts, 40):
        assert sum(pattern) <= 40 and times > 0
        for length in pattern:
            packed[length] += times
    assert packed == counts
