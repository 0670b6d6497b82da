"""Token counts by byte-level BPE, merged in numpy for many pre-tokens at once.

The vocabulary is a ``tokenizers`` JSON file (ByteLevel pre-tokenizer, no normalizer). A
text is cut at special strings, then into pre-tokens. Distinct pre-tokens of a batch are
held as one ragged array of symbols; each round joins, in every sequence at the same time,
all occurrences of its lowest-rank pair, until no pair has a rank. A merge can only make
pairs of higher rank than its own, so joining all occurrences at once gives the same
symbols as one at a time from the left.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemart.llm.common import slices

#: White space of the pre-tokenizer, and its pattern. Fixed values.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PRE = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Coarser: no pre-token crosses the border of one of its matches.
_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: Chunks remembered between batches, and the longest of them.
_KEPT, _LONGEST = 200_000, 64
_NONE = np.iinfo(np.int64).max


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Merges:
    """Merge table of a vocabulary file and a memory of counted chunks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError(f"{path}: only plain byte-level vocabularies are supported")
        vocab = spec["model"]["vocab"]
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        left, right, made = np.array(pairs, dtype=np.int64).T
        keys = left << 20 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.byte_id = np.array([vocab[c] for c in _byte_symbols()], dtype=np.int64)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))
                                  ) if special else None
        self.known: dict[str, int] = {}

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of each pair in the merge table, or -1."""
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each byte string after all merges."""
        sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        result = sizes.copy()
        symbol = self.byte_id[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), sizes)
        pair = np.full(len(symbol), -1, dtype=np.int64)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        pair[inside] = self._look_up(symbol[inside], symbol[inside + 1])
        while len(symbol):
            rank = np.where(pair >= 0, self.rank[pair], _NONE)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(symbol)])
            least = np.minimum.reduceat(rank, starts)
            finished = least == _NONE
            result[owner[starts[finished]]] = lengths[finished]
            if finished.all():
                break
            chosen = (rank != _NONE) & (rank == np.repeat(least, lengths))
            # equal symbols in a row overlap: join the first, third, ... pair of such a run
            at = np.flatnonzero(chosen)
            first = np.r_[True, np.diff(at) > 1]
            offset = at - at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
            at = at[offset % 2 == 0]
            symbol[at] = self.made[pair[at]]
            stay = np.repeat(~finished, lengths)
            stay[at + 1] = False
            joined = np.zeros(len(symbol), dtype=bool)
            joined[at] = True
            symbol, owner, pair, joined = symbol[stay], owner[stay], pair[stay], joined[stay]
            stale = np.flatnonzero(joined | np.r_[joined[1:], False])
            after = np.minimum(stale + 1, len(symbol) - 1)
            same = (after > stale) & (owner[after] == owner[stale])
            pair[stale] = np.where(same, self._look_up(symbol[stale], symbol[after]), -1)
        return result

    def learn(self, chunks: Iterable[str]) -> None:
        """Counts of chunks that are not known yet."""
        chunks = list(chunks)
        split = [_PRE.findall(c) for c in chunks]
        parts = list({p for s in split for p in s})
        count = dict(zip(parts, self.count([p.encode() for p in parts]).tolist()))
        self.known.update((c, sum(map(count.__getitem__, s))) for c, s in zip(chunks, split))

    def count_texts(self, texts: list[str]) -> list[int]:
        total, pieces = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            total.append(len(parts) - 1)
            pieces.append([c for p in parts for c in _CHUNK.findall(p)])
        new = set().union(*pieces).difference(self.known)
        self.learn(new)
        total = [n + sum(map(self.known.__getitem__, chunks))
                 for n, chunks in zip(total, pieces)]
        if len(self.known) > _KEPT:
            self.known.clear()
        for chunk in new:
            if len(chunk) > _LONGEST:
                self.known.pop(chunk, None)
        return total


@cache
def merges(path: str) -> Merges:
    return Merges(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    ``path`` is a vocabulary file that every executor can open. Null and empty texts have no
    bytes and no tokens. Repeated rows and null keys stay; other columns are ignored. Rows
    are counted where they are read, without a shuffle; memory is bounded by a batch of a
    few MB (or one longer text) and by the chunks remembered.
    """
    schema = T.StructType([docs.schema[key], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(path)
        for batch in slices(batches, 1, 2 << 20):
            texts = pc.fill_null(batch.column(1), "")
            n = table.count_texts(texts.to_pylist())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pc.binary_length(texts).cast(pa.int64()),
                pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)
