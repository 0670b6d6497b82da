"""Benchmark passages in documents, by greedy string tiling.

Documents and benchmark items are token sequences. Windows of ``least`` tokens that both
share are seeds: an equi-join on their hash gives the pairs to look at, and the number of
seeds a bound that most pairs do not reach. For each other pair, the longest common run of
unmarked tokens is marked as a tile, again and again, until none of ``least`` tokens is left;
the part of the item that tiles cover tells whether the document holds it, in whatever order
its passages come. The seeds tell all tokens that can be in a tile, so no text of a document
travels: a pair takes the places of its shared seeds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import slices, stored

_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Slots of the filter that keeps documents without any seed out of the join: a bit each,
#: so its size does not depend on the benchmark.
_SLOTS = 1 << 21


def token_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words, in lower case."""
    found = _WORD.findall((text or "").lower())
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in found), np.uint64, len(found))


def windows(tokens: np.ndarray, size: int) -> np.ndarray:
    """Rolling Karp-Rabin hashes, modulo 2**64, of all windows of ``size`` tokens."""
    n = max(0, len(tokens) - size + 1)
    out = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        out = out * _BASE + tokens[j:j + n]
    return (out ^ out >> np.uint64(29)).view(np.int64)


class _Side:
    """Tokens of one side of a pair, the marked ones among them, and Karp-Rabin hashes of any length
    from sums of powers modulo 2**64: memory grows with the tokens alone."""

    def __init__(self, tokens: np.ndarray, marked: np.ndarray):
        self.tokens, self.marked = tokens, marked
        power = np.full(len(tokens) + 1, _BASE)
        power[0] = 1
        self.sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(tokens * np.cumprod(power)[:-1], out=self.sums[1:])
        self.back = np.full(len(tokens) + 1, _INVERSE)
        self.back[0] = 1
        self.back = np.cumprod(self.back)

    def longest(self) -> int:
        """Length of the longest run of unmarked tokens."""
        edge = np.flatnonzero(np.diff(np.r_[True, self.marked, True].astype(np.int8)))
        return int((edge[1::2] - edge[::2]).max(initial=0))

    def free(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of ``size`` unmarked tokens, and their hashes."""
        held = np.r_[0, np.cumsum(self.marked)]
        at = np.flatnonzero(held[size:] == held[:-size])
        return at, (self.sums[at + size] - self.sums[at]) * self.back[at]


def _shared(doc: _Side, item: _Side, size: int) -> tuple[np.ndarray, ...]:
    """Starts of free windows that both have: in the doc, in the item, and which of the distinct
    hashes each has."""
    (x, of_x), (y, of_y) = doc.free(size), item.free(size)
    known = np.unique(of_y)
    if not len(known):
        return x[:0], y, x[:0], y
    k = np.minimum(np.searchsorted(known, of_x), len(known) - 1)
    hit = known[k] == of_x
    x, k = x[hit], k[hit]
    m = np.searchsorted(known, of_y)
    both = np.isin(m, k)
    return x, y[both], k, m[both]


def _mark(doc: _Side, item: _Side, size: int) -> list[tuple[int, int, int]]:
    """Marks the tiles of exactly ``size`` tokens: item starts in order, each with the first start
    in the doc that is still free."""
    x, y, k, m = _shared(doc, item, size)
    order = np.argsort(k, kind="stable")
    x, k = x[order], k[order]
    first, last = (np.searchsorted(k, m, side=s) for s in ("left", "right"))
    # a start that is taken stays so: each hash goes on from where it was left
    left = dict(zip(m.tolist(), first.tolist()))
    out, end = [], 0
    for b, h, stop in zip(y.tolist(), m.tolist(), last.tolist()):
        if b < end:
            continue
        at = left[h]
        while at < stop and doc.marked[x[at]:x[at] + size].any():
            at += 1
        left[h] = at
        if at < stop and (doc.tokens[x[at]:x[at] + size] == item.tokens[b:b + size]).all():
            a, end = int(x[at]), b + size
            doc.marked[a:a + size] = item.marked[b:end] = True
            out.append((a, b, size))
    return out


def tile_seeds(at: np.ndarray, there: np.ndarray, item: np.ndarray,
               size: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of a doc known by its seeds: the ``size`` tokens from each of the places
    ``at`` on are those of the item from ``there`` on. Longest tiles first; of equally long
    ones that which starts first in the item, then in the doc."""
    if not len(at):
        return []
    order = np.argsort(at)
    at, there = at[order], there[order]
    # what lies between seeds shrinks to one marked token
    place = np.r_[0, np.cumsum(np.minimum(np.diff(at), size + 1))]
    tokens = np.zeros(place[-1] + size, np.uint64)
    marked = np.ones(len(tokens), bool)
    for o in range(size):
        tokens[place + o] = item[there + o]
        marked[place + o] = False
    doc, whole = _Side(tokens, marked), _Side(item, np.zeros(len(item), bool))
    out, top = [], len(item)
    while (top := min(top, doc.longest(), whole.longest())) >= size:
        # the longest length that both share: a shared window holds shared shorter ones
        low, high = size - 1, top
        probe = top
        while low < high:
            if len(_shared(doc, whole, probe)[0]):
                low = probe
            else:
                high = probe - 1
            probe = (low + high + 1) // 2
        if low < size:
            break
        out += _mark(doc, whole, low)
        top = low - 1
    back = [np.searchsorted(place, x, side="right") - 1 for x, _, _ in out]
    return [(int(at[k]) + x - int(place[k]), y, n) for k, (x, y, n) in zip(back, out)]


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in doc, start in item, length), longest first."""
    size = min(least, len(item))
    if not size:
        return []
    return tile_seeds(*_seeds_of(windows(doc, size), windows(item, size)), item, size)


def _seeds_of(doc: np.ndarray, item: np.ndarray,
              at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places ``at`` (all, if none are given) of doc windows that the item has, and a place
    of each in the item."""
    known, first = np.unique(item, return_index=True)
    k = np.minimum(np.searchsorted(known, doc), len(known) - 1)
    hit = known[k] == doc
    return (np.flatnonzero(hit) if at is None else at[hit]), first[k[hit]]


def _grouped(at: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct seeds, where the places of each begin, and the places in that order."""
    order = np.argsort(seeds, kind="stable")
    distinct, first = np.unique(seeds[order], return_index=True)
    return distinct, first, at[order].astype(np.int32)


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = 5, percent: int = 50,
          key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """``key, item, n_tiles, covered_tokens, item_tokens, coverage`` of each document and item
    of which tiles cover ``percent`` or more.

    Items with fewer than ``least`` tokens are matched whole; items and documents without
    tokens (null, empty) match nothing, empty tables give no rows. Equal texts are tiled once.
    Rows that repeat a key with the same text give one result, null keys stay on both sides.
    An item id with several texts gives a row for each text that is held. Texts of any length
    are matched whole; a pair takes memory by its seeds, not by pairs of places. Columns other
    than the named ones are ignored. Tokens are compared by 64-bit hashes.
    """
    items_schema = T.StructType([
        T.StructField("item", benchmark.schema[item].dataType), *T._parse_datatype_string(
            "item_digest binary, item_tokens array<bigint>, "
            "seeds array<struct<seed: bigint, n: int>>").fields])
    doc_schema = T.StructType([
        T.StructField("id", docs.schema[key].dataType), *T._parse_datatype_string(
            "digest binary, hits array<struct<seed: bigint, places: array<int>>>").fields])

    def read_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            tokens = [token_hashes(t) for t in batch.column(1).to_pylist()]
            seeds = [np.unique(windows(t, min(least, len(t))), return_counts=True) if len(t)
                     else (t.view(np.int64), t.view(np.int64)) for t in tokens]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([xxhash.xxh3_128_digest(t.tobytes()) for t in tokens], pa.binary()),
                pa.array([t.view(np.int64) for t in tokens], pa.list_(pa.int64())),
                pa.ListArray.from_arrays(
                    np.cumsum([0] + [len(s) for s, _ in seeds]).astype(np.int32),
                    pa.StructArray.from_arrays([
                        pa.array(np.concatenate([s for s, _ in seeds]), pa.int64()),
                        pa.array(np.concatenate([n for _, n in seeds]).astype(np.int32))],
                        names=["seed", "n"]))], names=items_schema.names)

    items = stored(benchmark.select(F.col(item).alias("item"), item_text).distinct().mapInArrow(
        read_items, items_schema), "items")
    wanted = items.groupBy("item_digest").agg(F.any_value("item_tokens").alias("item_tokens"),
                                              F.any_value("seeds").alias("seeds"))
    seeds = wanted.select("item_digest", F.size("item_tokens").alias("item_n"),
                          F.inline("seeds"))
    slots = np.zeros(_SLOTS, dtype=bool)
    taken = seeds.select(F.pmod("seed", F.lit(_SLOTS)).cast("int").alias("s")).distinct()
    slots[[r["s"] for r in taken.collect()]] = True
    sizes = sorted(r["n"] for r in items.select(F.least(
        F.size("item_tokens"), F.lit(least)).alias("n")).distinct().collect() if r["n"])

    def read_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row, digests, found = [], [], []
            for k, value in enumerate(batch.column(1).to_pylist()):
                tokens = token_hashes(value)
                hits = []
                for w in (windows(tokens, n) for n in sizes):
                    at = np.flatnonzero(slots[w % _SLOTS])
                    hits.append((at, w[at]))
                if any(len(at) for at, _ in hits):
                    row.append(k)
                    digests.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                    found.append(_grouped(*map(np.concatenate, zip(*hits))))
            if not row:
                continue
            seen, first, places = (list(c) for c in zip(*found))
            starts = np.cumsum([0] + [len(p) for p in places])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row, pa.int32())), pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(
                    np.cumsum([0] + [len(s) for s in seen]).astype(np.int32),
                    pa.StructArray.from_arrays([
                        pa.array(np.concatenate(seen)),
                        pa.ListArray.from_arrays(np.append(np.concatenate(
                            [f + s for f, s in zip(first, starts)]), starts[-1]).astype(np.int32),
                            pa.array(np.concatenate(places)))], names=["seed", "places"]))],
                names=doc_schema.names)

    suspects = stored(docs.select(F.col(key).alias("id"), text).mapInArrow(
        read_docs, doc_schema), "suspects")
    texts = suspects.groupBy("digest").agg(F.any_value("hits").alias("hits"))
    # tiles cover at most all tokens of the shared windows
    size = F.least(F.lit(least), F.col("item_n"))
    both = (texts.select("digest", F.inline("hits")).join(seeds, "seed")
            .groupBy("digest", "item_digest", "item_n")
            .agg(F.sum("n").alias("shared"), F.collect_list(F.struct("seed", "places")).alias("hits"))
            .where(100 * F.col("shared") * size >= percent * F.col("item_n"))
            .join(wanted.select("item_digest", "item_tokens"), "item_digest")
            .select("digest", "item_digest", "item_tokens", "hits"))
    tiled_schema = T._parse_datatype_string(
        "digest binary, item_digest binary, n_tiles long, covered long, item_n long")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, hits in zip(batch.column(2), batch.column(3)):
                t = t.values.to_numpy().view(np.uint64)
                size = min(least, len(t))
                seed, places = hits.values.flatten()
                doc = np.repeat(seed.to_numpy(), places.value_lengths().to_numpy())
                at = places.flatten().to_numpy().astype(np.int64)
                found = tile_seeds(*_seeds_of(doc, windows(t, size), at), t, size)
                out.append((len(found), sum(n for _, _, n in found), len(t)))
            columns = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns)],
                names=tiled_schema.names)

    held = both.mapInArrow(tile, tiled_schema).where(
        100 * F.col("covered") >= percent * F.col("item_n"))
    return (suspects.select("id", "digest").distinct().join(held, "digest")
            .join(items.select("item", "item_digest").distinct(), "item_digest").select(
        F.col("id").alias(key), F.col("item").alias(item), "n_tiles",
        F.col("covered").alias("covered_tokens"), F.col("item_n").alias("item_tokens"),
        (F.col("covered") / F.col("item_n")).alias("coverage")))
