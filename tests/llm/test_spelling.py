from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from llm_fixtures import frame, small_docs  # noqa: F401
from tidemart.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(pairs, one_in=97):
    """Words by a loop, neighbours by the words without each character."""
    counts = Counter()
    for key, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: set() for w in words}
    holes = {}
    for w in words:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1:]
            holes.setdefault((i, cut), set()).add(w)
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def compare(got, want):
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()}
    assert found == want
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_documents(frame, small_docs):  # noqa: F811
    pairs = [(r.doc_id, r.text) for r in small_docs.collect()]
    compare(spelling.variants(frame(pairs)), brute(pairs))


def test_edges_and_chains(frame):  # noqa: F811
    r = random.Random(3)
    texts = [None, "", "a b c", "haus" * 3, "Straße ÀÉÎõü×÷ " * 3]
    # chains of forms, ties, doubled letters, words that contain one another
    for word, n in (("letter", 40), ("leter", 20), ("lettre", 9), ("lettter", 4), ("letterr", 3),
                    ("aaaaa", 5), ("aaaaaa", 12), ("aaaaaaa", 30), ("baaaa", 3), ("abcde", 7),
                    ("abcdf", 7), ("abcdg", 3), ("ABCDZ", 2), ("abcd", 50), ("xabcde", 3)):
        texts += [" ".join([word] * k) for k in (n // 2, n - n // 2)]
    alphabet = "abç"
    for _ in range(150):
        texts.append(" ".join("".join(r.choices(alphabet, k=r.randrange(3, 8)))
                              for _ in range(40)))
    pairs = [(i, t) for i, t in enumerate(texts)] + [(None, "letter abcde"), (3, texts[3])]
    compare(spelling.variants(frame(pairs), one_in=97), brute(pairs))
    compare(spelling.variants(frame(pairs), one_in=3), brute(pairs, 3))


def test_long_words(frame):  # noqa: F811
    r = random.Random(8)
    words = ["".join(r.choices("ab", k=n)) for n in (63, 64, 65, 66, 67, 400, 5000)]
    words.append("a" * 20_000)
    for w in list(words):
        at = r.randrange(len(w))
        words += [w[:at] + "z" + w[at + 1:], w[:at] + w[at + 1:], w[:at] + "z" + w[at:],
                  w + "b", w[1:], w[:at] + "y" + w[at + 1:]]
    pairs = [(i, " ".join([w] * (3 + i % 9))) for i, w in enumerate(words)]
    compare(spelling.variants(frame(pairs)), brute(pairs))


def test_nothing(frame):  # noqa: F811
    assert spelling.variants(frame([])).count() == 0
    assert spelling.variants(frame([(None, None), (1, "")])).count() == 0
