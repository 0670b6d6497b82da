"""Packing of token sequences, shortest pack first over the length histogram.

A document is tokenized once and cut into pieces of ``size`` ids and a rest. The histogram
of piece lengths (at most ``size`` numbers) is packed on the driver: lengths from long to
short, each placed on the packs that are shortest so far, as long as they have room, with
counts per packing pattern instead of single pieces. Pieces then get their rank among the
pieces of their length, and the rank names the pattern, the sequence and the offset.
"""

from __future__ import annotations

import os
import string
import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import slices, stored

#: Parts of words remembered between batches, and the longest of them.
_KEPT, _LONGEST = 800_000, 64
#: Words in one call of the tokenizer.
_AT_ONCE = 500
#: Text bytes encoded at a time.
_BATCH = 8 << 20
#: Letters that are one code point in NFC and in lower case, and ASCII marks: no token crosses
#: the border between the two. Fixed values.
_LETTERS = "".join(c for c in map(chr, range(0x100)) if c.isalpha() and c not in "\xaa\xb5\xba")
_MARKS = string.punctuation
#: Pieces of one length are ranked in groups of about this many.
_GROUP = 250_000


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes, with a memory of words.

    Made for vocabularies whose pre-tokenizer drops white space: no token crosses a space or
    a line end, so a text is the sum of its words.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.is_end = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>")
                                for i in range(size)])
        self.known: dict[str, bytes] = {}
        for probe in ("a b", "A\nb,"):
            if self._encode([probe]) != self.encode([probe]):
                raise ValueError(f"{path}: not a vocabulary of lower-case words")

    def _encode(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """The same for words of letters alone, many in one call: each is one pre-token, and
        ends at its only token with the mark for word ends."""
        out: list[bytes] = []
        for at in range(0, len(words), _AT_ONCE):
            part = words[at:at + _AT_ONCE]
            ids = np.frombuffer(self._encode([" ".join(part)])[0], dtype="<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(part) and ends[-1:] == len(ids):
                data, ends = ids.tobytes(), (4 * ends).tolist()
                out += [data[a:b] for a, b in zip([0, *ends], ends)]
            else:
                out += self._encode(part)
        return out

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts of words; those seen before come from memory."""
        new = [p for p in parts if p not in self.known]
        letters = [p for p in new if p.isalpha()]
        rest = [p for p in new if not p.isalpha()]
        self.known.update(zip(letters, self._encode_letters(letters)))
        self.known.update(zip(rest, self._encode(rest)))
        found = [self.known[p] for p in parts]
        if len(self.known) > _KEPT:
            self.known = dict(zip(parts, found)) if len(parts) <= _KEPT else {}
        for part in new:
            if len(part) > _LONGEST:
                self.known.pop(part, None)
        return found

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words. A word of plain letters and marks after them is looked up as
        letters in lower case and as marks."""
        stem = pc.utf8_rtrim(words, characters=_MARKS)
        end = pc.utf8_ltrim(words, characters=_LETTERS)
        plain = pc.equal(pc.add(pc.binary_length(stem), pc.binary_length(end)),
                         pc.binary_length(words))
        parts = pa.concat_arrays([
            pc.if_else(plain, pc.utf8_lower(stem), words),
            pc.if_else(plain, end, pa.scalar("", words.type))]).dictionary_encode()
        ids = pa.array(self._known(parts.dictionary.to_pylist()), pa.large_binary())
        return pc.binary_join_element_wise(
            ids.take(parts.indices[:len(words)]), ids.take(parts.indices[len(words):]),
            pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text; an Arrow array must be without nulls."""
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
        words = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        flat = words.flatten().dictionary_encode()
        ids, index = self._words(flat.dictionary), flat.indices
        sizes = pc.binary_length(ids).to_numpy()[index.to_numpy()]
        ends = np.cumsum(pc.list_value_length(words).to_numpy())
        at = np.r_[0, np.cumsum(sizes)][np.r_[0, ends]].tolist()
        data = memoryview(ids.take(index).buffers()[2] or b"")
        return [data[a:b].tobytes() for a, b in zip(at, at[1:])]


@cache
def ids(path: str) -> Ids:
    return Ids(path)


def pieces(docs: DataFrame, path: str, size: int, end_id: int, key: str, text: str) -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens``: each document's ids and ``end_id``, cut.
    ``_deal`` spreads rows that are equal otherwise."""
    schema = T.StructType([docs.schema[key], *(T.StructField(n, T.LongType()) for n in (
        "start", "length", "ids_crc32", "doc_tokens", "_deal"))])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = ids(path), 0
        for batch in slices(batches, 1, _BATCH):
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            out = [(row, at // 4, len(cut) // 4, zlib.crc32(cut), len(data) // 4, seen + row)
                   for row, data in enumerate(x + end for x in encoder.encode(texts))
                   for at in range(0, len(data), 4 * size)
                   for cut in [data[at:at + 4 * size]]]
            seen += batch.num_rows
            row, *rest = (pa.array(c, pa.int64()) for c in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), *rest], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def pack_histogram(counts: Mapping[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths, longest first) and how often each is used.

    Packs are grouped by fill and pattern; a length is added to whole groups. A group is
    split at most once per length, so the patterns stay few.
    """
    open_packs: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fill = min((f for f in open_packs if f + length <= size), default=None)
            if fill is None:
                taken, pattern = left, ()
            else:
                pattern = next(iter(open_packs[fill]))
                taken = min(left, open_packs[fill][pattern])
                open_packs[fill][pattern] -= taken
                if not open_packs[fill][pattern]:
                    del open_packs[fill][pattern]
                if not open_packs[fill]:
                    del open_packs[fill]
            grown = (*pattern, length)
            group = open_packs[(fill or 0) + length]
            group[grown] = group.get(grown, 0) + taken
            left -= taken
    return [(p, n) for fill in sorted(open_packs) for p, n in sorted(open_packs[fill].items())]


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, pieces of that length in the pattern, first
    sequence, offset of the first piece) in rank order."""
    used: dict[int, int] = defaultdict(int)
    places: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    first = 0
    for pattern, count in patterns:
        offset = 0
        for length in dict.fromkeys(pattern):
            times = pattern.count(length)
            places[length].append((used[length], times, first, offset))
            used[length] += times * count
            offset += times * length
        first += count
    return {length: np.array(rows, dtype=np.int64).T for length, rows in places.items()}


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 1, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece.

    Every id of every row lies in one piece; a null or empty text is its ``end_id`` alone.
    Repeated rows are packed as often as they come; null keys stay; other columns are ignored;
    an empty table gives no rows; texts of any length are cut into pieces. Only the histogram, at
    most ``size`` rows, reaches the driver, and only its patterns go to the tasks.
    """
    cut = stored(pieces(docs, path, size, end_id, key, text), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    groups = min(4096, max(8, sum(counts.values()) // _GROUP))
    places = _places(pack_histogram(counts, size))

    dealt = cut.withColumn("_g", F.pmod(F.xxhash64(key, "start", "ids_crc32", "_deal"),
                                        F.lit(groups))).drop("_deal")
    columns = [c for c in cut.columns if c != "_deal"]
    before = dealt.groupBy("length", "_g").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.sum("_n").over(
            W.partitionBy("length").orderBy("_g").rowsBetween(W.unboundedPreceding, -1)))
    ranked = dealt.withColumn("_r", F.row_number().over(
        W.partitionBy("length", "_g").orderBy(key, "start", "ids_crc32"))).join(
        before.select("length", "_g", "_before"), ["length", "_g"]).select(
        *columns, (F.col("_r") - 1 + F.coalesce("_before", F.lit(0))).alias("_rank"))
    schema = T.StructType([*(cut.schema[c] for c in columns), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for one in np.unique(length):
                rows = np.flatnonzero(length == one)
                starts, times, first, at = places[int(one)]
                k = np.searchsorted(starts, rank[rows], side="right") - 1
                within = rank[rows] - starts[k]
                sequence[rows] = first[k] + within // times[k]
                offset[rows] = at[k] + within % times[k] * one
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=schema.names)

    return ranked.mapInArrow(place, schema)
