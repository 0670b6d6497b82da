from __future__ import annotations

import hashlib
import random
from collections import Counter

from llm_fixtures import frame, small_docs  # noqa: F401
from tidemart.llm import exchange, repeats
from tidemart.llm.repeats import Block, remove_repeats, without_repeats


def brute(pairs, length=50):
    """Removed bytes by a table of all windows with the smallest document of each."""
    data = {i: (t or "").encode() for i, t in pairs}
    least = {}
    for i in sorted(data):
        for p in range(len(data[i]) - length + 1):
            least.setdefault(data[i][p:p + length], i)
    out = {}
    for i, text in data.items():
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            if least[text[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(text, gone) if not g)
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest(),
                  kept.decode(errors="ignore"))
    return out


def planted(seed=5):
    """Passages around the threshold, shifted, nested, periodic, repeated within a text."""
    r = random.Random(seed)
    some = lambda n: "".join(r.choices("abé ", k=n))
    shared = [some(n) for n in (48, 49, 50, 51, 60, 100, 400)]
    texts = [None, "", "short", "a" * 300, "a" * 49, "a" * 50, "ab" * 200, "a" * 120 + some(9)]
    for _ in range(60):
        parts = [some(r.randrange(30))]
        for _ in range(r.randrange(4)):
            p = r.choice(shared)
            a = r.randrange(max(1, len(p) - 40)) if r.random() < .5 else 0
            parts += [p[a:], some(r.randrange(20))]
        texts.append("".join(parts))
    return texts + texts[:20]


def check(frame, texts, monkeypatch, size):
    monkeypatch.setattr(exchange, "BLOCK_BYTES", size)
    monkeypatch.setattr(exchange.blocks, "__defaults__", (size,))
    pairs = list(enumerate(texts))
    random.Random(1).shuffle(pairs)
    docs = frame(pairs + [(None, texts[-1]), (6, texts[6])])
    got = remove_repeats(docs).collect()
    assert len(got) == len(pairs) + 2
    want = brute(pairs)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id][:4]
    left = without_repeats(docs)
    assert left.schema == docs.schema
    have = Counter((r.doc_id, r.text, r.source) for r in left.collect())
    assert have == Counter((i, t if t is None or i is None else want[i][4], "s")
                           for i, t in [*pairs, (None, texts[-1]), (6, texts[6])])


def test_planted_passages(frame, monkeypatch):
    check(frame, planted(), monkeypatch, 2000)


def test_long_documents_in_parts(frame, monkeypatch):
    """Blocks are indexed in parts of 130 bytes; the result is the same."""
    index = Block._segments

    def parts(self):
        for a, b, lo, own in index(self):
            if b - a == 1:
                for at in range(0, own, 130):
                    yield a, b, lo + at, min(130, own - at)
            else:
                yield a, b, lo, own

    texts = planted(11) + ["x" * 700 + "abc" * 90]
    pairs = [(i, t) for i, t in enumerate(texts) if t]
    import pyarrow as pa
    table = pa.table({"block": [0] * len(pairs), "id": [i for i, _ in pairs],
                      "text": [t for _, t in pairs]})
    monkeypatch.setattr(repeats, "_STEP", 100)
    plain = Block(table, 50)
    monkeypatch.setattr(Block, "_segments", parts)
    cut = Block(table, 50)
    assert (plain.rank == cut.rank).all() and len(cut.run) > len(plain.run)

    def windows(block):
        return sorted((int(d), p) for d, lo, hi in zip(block.doc, block.low, block.high)
                      for p in range(lo, hi + 1))

    assert windows(plain) == windows(cut)


def test_documents(frame, small_docs, monkeypatch):
    check(frame, [r.text for r in small_docs.collect()], monkeypatch, 100_000)


def test_only_short_texts(frame, monkeypatch):
    check(frame, [f"text {i} of twenty bytes" for i in range(30)], monkeypatch, 2000)


def test_nothing(frame):
    assert remove_repeats(frame([])).count() == 0
    assert remove_repeats(frame([(None, None), (2, None)])).count() == 2
