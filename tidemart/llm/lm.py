"""Stupid-backoff scores of documents under an n-gram model of the whole corpus.

N-gram counts are tables partitioned by a hash of the n-gram. A block of documents explodes
into its distinct n-grams of each order with their counts, these meet the partitions they
belong to, where counts add up over all blocks, and the totals come back to the block, which
sums the log scores of each document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import exchange
from tidemart.llm.common import words

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Grams:
    """N-grams of a block up to ``order`` words: distinct keys, and for each order which key
    the n-gram that ends at a position has."""

    def __init__(self, table: pa.Table, order: int):
        self.block = table["block"][0].as_py() if table.num_rows else 0
        words = pc.ascii_split_whitespace(pc.ascii_lower(table["text"])).combine_chunks()
        flat = words.flatten()
        real = pc.not_equal(flat, "")
        ends = np.cumsum(pc.list_value_length(words).to_numpy())
        before = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
        self.sizes = np.diff(before[np.r_[0, ends]]).astype(np.int64)
        # each distinct word is hashed once
        coded = flat.filter(real).dictionary_encode()
        distinct = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()),
                               np.uint64, len(coded.dictionary))
        word = coded.indices.to_numpy()
        one = distinct[word]
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.arange(len(one)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        #: positions that end an n-gram of each order
        self.ends = [np.flatnonzero(place >= k) for k in range(order)]
        # the lowest bits tell the orders apart
        tag = np.uint64(max(1, (order - 1).bit_length()))
        keys, found = np.unique(distinct << tag, return_inverse=True)
        self.keyed = [found[word]]
        parts, counts = [keys], [np.bincount(self.keyed[0], minlength=len(keys))]
        # ``shorter`` has a hash for each position, of the n-gram one word shorter
        shorter = one
        for k, at in enumerate(self.ends[1:], 1):
            longer = shorter[at - 1] * _C1 + one[at] * _C2
            longer ^= longer >> np.uint64(31)
            keys, found, n = np.unique(longer << tag | np.uint64(k), return_inverse=True,
                                       return_counts=True)
            self.keyed.append(found + sum(map(len, parts)))
            parts.append(keys)
            counts.append(n)
            shorter = np.zeros_like(one)
            shorter[at] = longer
        #: sorted within each order: rows of a block come in another order each time
        self.keys, self.counts = np.concatenate(parts), np.concatenate(counts)


def _sums(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    _, place = np.unique(keys, return_inverse=True)
    return np.bincount(place, weights=counts).astype(np.int64)[place]


def score(docs: DataFrame, min_count: int = 2, backoff: float = 0.4, key: str = "doc_id",
          text: str = "text", order: int = 2) -> DataFrame:
    """``key, n_tokens, n_backoff, log_score, mean_log_score`` for each row of ``docs``.

    Words are split at ASCII white space, A-Z in lower case. A word w after the words v scores
    c(v w) / c(v) if the n-gram v w comes ``min_count`` times or more in the corpus, else
    ``backoff`` times its score after v without the first word; after no word it scores
    c(w) / N. ``order`` is the length of the longest n-grams; ``n_backoff`` counts the steps
    back. Scores are natural logarithms. Documents without words (null, empty) have 0 tokens,
    log_score 0 and a null mean; an empty table gives no rows. Repeated rows count as often as
    they come; null keys stay. A very long text is a block of its own. Columns other than key
    and text are ignored. N-grams are compared by hashes of 63 bits (62 from order 3 on).
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    rows, n = exchange.blocks(docs, key, text)
    total = docs.agg(F.sum(F.size(words(F.col(text))))).first()[0] or 1
    id_type = docs.schema[key].dataType.simpleString()

    def ask(table: pa.Table) -> pa.Table:
        grams = Grams(table, order)
        return exchange.asked(grams.block, grams.keys, grams.counts.astype(np.uint32), n)

    def total_of(table: pa.Table, replies: pa.Table) -> pa.Table:
        grams = Grams(table, order)
        count = exchange.answers(replies, grams.keys, n, np.int64)
        docs_n = len(grams.sizes)
        shorter = count[grams.keyed[0]].astype(float)
        logs, unseen = np.log(shorter / total), np.zeros(docs_n, np.int64)
        for at, keyed in zip(grams.ends[1:], grams.keyed[1:]):
            found = count[keyed].astype(float)
            seen = found >= min_count
            logs[at] = np.where(seen, np.log(found / shorter[at - 1]),
                                np.log(backoff) + logs[at])
            unseen += np.bincount(grams.doc[at[~seen]], minlength=docs_n)
            shorter = np.zeros_like(logs)
            shorter[at] = found
        sums = np.bincount(grams.doc, weights=logs, minlength=docs_n)
        mean = np.divide(sums, grams.sizes, out=np.zeros(docs_n), where=grams.sizes > 0)
        return pa.table({
            "id": table["id"], "n_tokens": pa.array(grams.sizes),
            "n_backoff": pa.array(unseen), "log_score": pa.array(sums),
            "mean_log_score": pa.array(mean, mask=grams.sizes == 0)})

    by_block = rows.groupBy("block")
    replies = exchange.answer(by_block.applyInArrow(ask, exchange.ASKED), _sums,
                              np.dtype(np.uint32))
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(
        total_of, f"id {id_type}, n_tokens long, n_backoff long, log_score double, "
        "mean_log_score double").withColumnRenamed("id", key)
