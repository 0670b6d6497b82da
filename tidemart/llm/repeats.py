"""Repeated passages by rank doubling over the positions of all documents.

A position's rank at length n names the n bytes that start there. Ranks double from 1 to 2,
4, ... 32 bytes within a task, where the text is; two overlapping ranks of 32 give the rank
at the threshold of 50. Across documents only positions that can repeat are compared:

1. Each window of 50 bytes has an anchor, the 24 bytes in it with the least rank; equal windows
   have equal anchors. Runs of windows with the same anchor are compared as a whole: anchor
   and run (the ranks of its first and last window, which cover it) against all others. An
   anchor that comes once in the corpus is unique and drops out; a run that a smaller
   document holds is a repeat.
2. Where an anchor stands in different runs, at the ends of a shared passage, the windows
   of one holder of each run are compared at the full length.

Ranks are 64-bit hashes, so equal bytes get equal ranks in every task without a global sort.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm import exchange

_ANCHOR = 24
_STEP = 1 << 19
#: A longer document is indexed in parts.
_WHOLE = 1 << 22
_C1, _C2, _C3 = (np.uint64(c) for c in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))
_AT = np.uint64((1 << 27) - 1)
#: Anchors and runs are compared across documents by 48 bits of their ranks.
_WIDTH, _48 = 6, np.uint64((1 << 48) - 1)
_RUN = np.dtype([("low", "<u4"), ("high", "<u2"), ("doc", "<i8")])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rank of two ranks side by side."""
    x = a * _C1
    x += b * _C2
    x ^= x >> np.uint64(32)
    x *= _C3
    x ^= x >> np.uint64(29)
    return x


_FIRST = _pair(np.arange(256, dtype=np.uint64), np.arange(1, 257, dtype=np.uint64))


def _ranks(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks at the anchor's length and at ``length`` bytes, by doubling."""
    rank, n, anchor = _FIRST[data], 1, None
    while 2 * n <= length:
        if n <= _ANCHOR < 2 * n:
            anchor = _pair(rank[:n - _ANCHOR], rank[_ANCHOR - n:])
        rank = _pair(rank[:-n], rank[n:])
        n *= 2
    return anchor, _pair(rank[:n - length], rank[length - n:]) if n < length else rank


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by doubling."""
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    return np.minimum(values[:n - width], values[width - n:]) if n < width else values


class Block:
    """The documents of a block and the runs of their windows."""

    def __init__(self, table: pa.Table, length: int):
        self.length = length
        # in order of the keys, so that the first of equal runs has the smallest
        table = table.sort_by("id")
        self.table = table
        self.block = table["block"][0].as_py() if table.num_rows else 0
        self.ids = table["id"].to_numpy()
        texts = [t.encode() for t in table["text"].to_pylist()]
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.rank = np.empty(0, dtype=np.uint64)
        self._index()

    def _segments(self) -> Iterator[tuple[int, int, int, int]]:
        """First and last document, first byte and windows of a step: several documents, or a
        part of a long one. Parts overlap, so that every window is in one; runs that are cut
        there are compared window by window."""
        for a, b in exchange.chunks(self.sizes, _STEP):
            size = int(self.sizes[a:b].sum())
            step = size if size <= _WHOLE else _STEP
            for at in range(0, size, max(step, 1)):
                yield a, b, int(self.starts[a]) + at, min(step, size - at)

    def _index(self) -> None:
        doc, anchor, run, low, high, rank = [], [], [], [], [], []
        for a, b, lo, own in self._segments():
            end = self.starts[b - 1] + self.sizes[b - 1]
            data = self.data[lo:min(end, lo + own + self.length - 1)]
            if len(data) < self.length:
                rank.append(np.zeros(own, dtype=np.uint64))
                continue
            short, whole = _ranks(data, self.length)
            rank.append(np.r_[whole, np.zeros(len(data) - len(whole), np.uint64)][:own])
            owner = np.repeat(np.arange(a, b), self.sizes[a:b])[:len(data)]
            inside = owner[:len(whole)] == owner[self.length - 1:]
            if not inside.any():
                continue
            at = np.arange(len(short), dtype=np.uint64)
            least = _least((short & ~_AT) | (at & _AT), self.length - _ANCHOR + 1)
            place = (least & _AT).astype(np.int64)
            p = np.flatnonzero(inside)
            new = np.r_[True, (place[p[1:]] != place[p[:-1]]) | (np.diff(p) > 1)]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(p)) - 1
            doc.append(owner[p[first]])
            offset = (place[p[first]] - p[first]).astype(np.uint64)
            low.append(p[first] + lo)
            high.append(p[last] + lo)
            anchor.append(short[place[p[first]]] & _48)
            run.append(_pair(_pair(whole[p[first]], whole[p[last]]), offset * _C1
                             + (p[last] - p[first]).astype(np.uint64)) & _48)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        self.rank = join(rank, np.uint64)
        self.doc, self.low, self.high = (join(x, np.int64) for x in (doc, low, high))
        self.anchor, self.run = (join(x, np.uint64) for x in (anchor, run))
        self.holder = self.ids[self.doc] if len(self.doc) else np.empty(0, np.int64)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the distinct (anchor, run): index of the run with the smallest document, and
        for each run of the block its place among them and whether its document is larger."""
        both = _pair(self.anchor, self.run)
        order = np.argsort(both, kind="stable")
        both = both[order]
        new = np.r_[True, both[1:] != both[:-1]] if len(order) else order > 0
        first = order[new]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        return first, place, self.holder > self.holder[first][place]

    def ask_runs(self, buckets: int) -> pa.Table:
        first, _, _ = self.runs()
        values = np.empty(len(first), dtype=_RUN)
        values["low"] = self.run[first] & np.uint64(0xFFFFFFFF)
        values["high"] = self.run[first] >> np.uint64(32)
        values["doc"] = self.holder[first]
        return exchange.asked(self.block, self.anchor[first], values, buckets, _WIDTH)

    def known(self, replies: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Runs that a smaller document holds, and runs whose windows have to be asked."""
        first, place, larger = self.runs()
        got = exchange.answers(replies, self.anchor[first], buckets, np.uint8)
        repeated = larger | (got[place] & 1 > 0)
        unsure = np.zeros(len(self.run), dtype=bool)
        unsure[first] = got & 3 == 2
        # a document may hold its smallest run more than once
        return repeated, unsure[first][place] & ~larger if len(first) else unsure

    def windows(self, unsure: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the windows of runs, their documents, distinct ranks with the
        smallest document of each."""
        size = (self.high - self.low + 1)[unsure]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(self.low[unsure], size) + step
        holder = np.repeat(self.holder[unsure], size)
        rank = self.rank[at]
        order = np.argsort(rank, kind="stable")
        new = np.r_[True, np.diff(rank[order]) > 0] if len(order) else order > 0
        return at, holder, rank[order[new]], holder[order[new]]

    def ask_windows(self, replies: pa.Table, buckets: int) -> pa.Table:
        _, unsure = self.known(replies, buckets)
        _, _, keys, holders = self.windows(unsure)
        return exchange.asked(self.block, keys, holders, buckets)

    def covered(self, runs: pa.Table, windows: pa.Table, buckets: int) -> np.ndarray:
        """Bytes of the block that lie in a repeated window."""
        repeated, unsure = self.known(runs, buckets)
        edge = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(edge, self.low[repeated], 1)
        np.add.at(edge, self.high[repeated] + self.length, -1)
        at, holder, keys, holders = self.windows(unsure)
        if len(at):
            smaller = exchange.answers(windows, keys, buckets, np.bool_)
            place = np.searchsorted(keys, self.rank[at])
            found = at[smaller[place] | (holders[place] < holder)]
            np.add.at(edge, found, 1)
            np.add.at(edge, found + self.length, -1)
        return np.cumsum(edge)[:-1] > 0


def _judge_runs(anchors: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Per statement: bit 0 a smaller document holds the run, bit 1 the anchor has several."""
    run, doc = values["low"] | values["high"].astype(np.uint64) << np.uint64(32), values["doc"]
    order = np.argsort(doc, kind="stable")
    order = order[np.argsort(_pair(anchors, run)[order], kind="stable")]
    order = order[np.argsort(anchors[order], kind="stable")]
    a, r = anchors[order], run[order]
    new_anchor = np.r_[True, a[1:] != a[:-1]]
    new_run = new_anchor | np.r_[True, r[1:] != r[:-1]]
    least = doc[order][new_run][np.cumsum(new_run) - 1]
    group = np.cumsum(new_anchor) - 1
    several = np.bincount(group, weights=new_run)[group] > 1
    out = np.empty(len(order), dtype=np.uint8)
    out[order] = (least < doc[order]) | several.astype(np.uint8) << 1
    return out


def _smaller_elsewhere(keys: np.ndarray, holders: np.ndarray) -> np.ndarray:
    """Per statement: another one names a smaller document for its key."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    least = np.repeat(np.minimum.reduceat(holders[order], first),
                      np.diff(np.append(first, len(k))))
    out = np.empty(len(keys), dtype=np.bool_)
    out[order] = least < holders[order]
    return out


def _spans(covered: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    return zip(edge[::2].tolist(), edge[1::2].tolist())


def _blocks_done(docs: DataFrame, length: int, key: str, text: str, schema: T.StructType | str,
                 keep: tuple[Column, ...], emit: Callable[[Block, np.ndarray], pa.Table]
                 ) -> DataFrame:
    """Rows that ``emit`` makes of each block of documents and its covered bytes."""
    if not 32 <= length <= 64:
        raise ValueError("length must be 32 to 64 bytes")
    rows, buckets = exchange.blocks(docs, key, text, keep=keep)
    rows = rows.withColumn("id", F.col("id").cast("long"))

    def first(table: pa.Table) -> pa.Table:
        return Block(table, length).ask_runs(buckets)

    def second(table: pa.Table, replies: pa.Table) -> pa.Table:
        return Block(table, length).ask_windows(replies, buckets)

    def last(table: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(table, length)
        rounds = [replies.filter(pc.equal(replies["round"], i)) for i in (1, 2)]
        return emit(block, block.covered(*rounds, buckets))

    by_block = rows.groupBy("block")
    runs = exchange.answer(by_block.applyInArrow(first, exchange.ASKED), _judge_runs, _RUN, _WIDTH)
    windows = exchange.answer(by_block.cogroup(runs.groupBy("block")).applyInArrow(
        second, exchange.ASKED), _smaller_elsewhere, np.dtype(np.int64))
    both = runs.withColumn("round", F.lit(1)).unionByName(windows.withColumn("round", F.lit(2)))
    return by_block.cogroup(both.groupBy("block")).applyInArrow(last, schema)


def _documents(block: Block, covered: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes of each document of a block, and which of them are covered."""
    for start, size in zip(block.starts.tolist(), block.sizes.tolist()):
        yield block.data[start:start + size], covered[start:start + size]


def remove_repeats(docs: DataFrame, length: int = 50, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs``.

    Bytes covered by a string of ``length`` UTF-8 bytes that also starts in a document with a
    smaller key are removed. Null text is empty. Rows with a null key are compared with
    nothing. Rows that repeat a key don't remove from each other. Extra columns are ignored; an
    empty table gives no rows. Keys are integers; ``length`` is 32 to 64 bytes.
    """
    def emit(block: Block, covered: np.ndarray) -> pa.Table:
        out = [(len(data), int(gone.sum()), sum(1 for _ in _spans(gone)),
                hashlib.sha256(data[~gone].tobytes()).hexdigest())
               for data, gone in _documents(block, covered)]
        columns = list(zip(*out)) or [[]] * 4
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.table({"id": pa.array(block.ids)} | {
            c: pa.array(v, k) for c, v, k in zip(names, columns, kinds)})

    found = _blocks_done(
        docs.where(F.col(key).isNotNull()), length, key, text,
        "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", (), emit)
    whole = F.coalesce(F.col(text), F.lit(""))
    alone = docs.where(F.col(key).isNull()).select(
        F.lit(None).cast("long").alias("id"), F.octet_length(whole).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(whole, 256).alias("kept_sha256"))
    return found.unionByName(alone).withColumnRenamed("id", key)


def without_repeats(docs: DataFrame, length: int = 50, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the bytes that ``remove_repeats`` removes taken out
    of ``text``; parts of a cut character go too. Null texts stay null, rows without a key stay
    as they are. The other columns travel with the text, so it is shuffled once."""
    others = [c for c in docs.columns if c != text]
    keep = (F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"),
            F.col(text).isNull().alias("none"))
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField(
        "row", T.StructType([docs.schema[c] for c in others]))])

    def emit(block: Block, covered: np.ndarray) -> pa.Table:
        none = block.table["none"].to_pylist()
        kept = [None if null else data[~gone].tobytes().decode(errors="ignore")
                for null, (data, gone) in zip(none, _documents(block, covered))]
        return pa.table({"text": pa.array(kept, pa.string()), "row": block.table["row"]})

    found = _blocks_done(docs.where(F.col(key).isNotNull()), length, key, text, schema, keep, emit)
    return found.select(*(F.col("text") if c == text else F.col(f"row.`{c}`")
                          for c in docs.columns)).toDF(*docs.columns).unionByName(
        docs.where(F.col(key).isNull()))
