"""Questions from blocks of documents to a table of keys that is spread over all tasks.

Documents are dealt to blocks of a few MB. A block states each of its distinct keys once (or once per value), as
packed arrays, one row per bucket; a bucket holds all statements about its keys, reduces
them, and answers each block with an array in the order it was asked. A key that a third of
all documents hold is thus stated once per block, whatever its frequency.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASKED = "bucket long, block long, keys binary, values binary"
ANSWERED = "block long, bucket long, answers binary"

#: Text bytes of a block, and of a bucket's share.
BLOCK_BYTES = 8 << 20


def blocks(docs: DataFrame, key: str, text: str, size: int = BLOCK_BYTES, *,
           keep: Sequence[Column] = ()) -> tuple[DataFrame, int]:
    """``block, id, text`` of all rows, and the number of blocks; null text becomes empty.
    Columns to ``keep`` travel along.

    Rows go to a block by a hash of key, text and input partition, so that neither a null nor
    a repeated key gathers in one block.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       *keep)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // size) + 1
    return rows.withColumn("block", F.pmod(F.xxhash64(
        "id", "text", F.spark_partition_id()), F.lit(n)).cast("long")), n


def order_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The order in which a block's distinct keys are asked: by bucket."""
    bucket = keys % np.uint64(buckets)
    # numpy sorts 16 bits by radix
    return np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")


def _packed(keys: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


def asked(block: int, keys: np.ndarray, values: np.ndarray, buckets: int,
          width: int = 8) -> pa.Table:
    """Rows of ``ASKED`` for keys (uint64, of ``width`` bytes) and a value (any dtype) each."""
    order = order_of(keys, buckets)
    keys, values = keys[order], values[order]
    bucket, first = np.unique(keys % np.uint64(buckets), return_index=True)
    ends = np.append(first[1:], len(keys))
    cut = [slice(a, b) for a, b in zip(first, ends)]
    return pa.table({
        "bucket": pa.array(bucket.astype(np.int64)),
        "block": pa.array(np.full(len(bucket), block, dtype=np.int64)),
        "keys": pa.array([_packed(keys[c], width) for c in cut], pa.binary()),
        "values": pa.array([values[c].tobytes() for c in cut], pa.binary())})


def answer(requests: DataFrame, reduce: Callable[[np.ndarray, np.ndarray], np.ndarray],
           dtype: np.dtype, width: int = 8) -> DataFrame:
    """``ANSWERED`` rows. ``reduce`` takes the keys and values of a whole bucket, a key once
    per block that holds it, and returns an answer for each statement."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_unpacked(k, width) for k in table["keys"].to_pylist()]
        values = np.concatenate([np.frombuffer(v, dtype=dtype)
                                 for v in table["values"].to_pylist()])
        out = reduce(np.concatenate(parts), values)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "answers": pa.array(
            [a.tobytes() for a in np.split(out, cuts)], pa.binary())})

    return requests.groupBy("bucket").applyInArrow(run, ANSWERED)


def answers(table: pa.Table, keys: np.ndarray, buckets: int, dtype: np.dtype) -> np.ndarray:
    """Answers to a block in the order of its distinct keys."""
    table = table.sort_by("bucket")
    got = [np.frombuffer(a, dtype=dtype) for a in table["answers"].to_pylist()]
    out = np.empty(len(keys), dtype=dtype)
    out[order_of(keys, buckets)] = np.concatenate(got) if got else np.empty(0, dtype=dtype)
    return out


def chunks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive documents of about ``limit`` bytes each."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
