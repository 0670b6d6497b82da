"""Chat formatting: turns of typed content parts to one marked-up text per conversation.

A visitor walks the parts of a turn (text, image, audio, document) and flattens them to text
with a placeholder for each attachment, in order. It records what the placeholder stands for,
where it is, and how many tokens it expands to. Text is escaped so that no control string of
the template can come from it: a backslash goes in behind the first character of each, and a
further one where there are backslashes already, so that taking one out gives the text back.

Every turn is formatted by itself. Turns are sorted by conversation and turn over all tasks
(a range partitioning by both), and a task streams through its share, so a conversation that
holds a third of all rows is spread over many tasks. It comes out as several parts of bounded
size, in order of ``first``; the text of a conversation is its parts joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemart.llm.common import slices, stored

#: Text around the turns of the known roles: start and end. Fixed values.
MARKS = {"user": ("<s>[INST] ", " [/INST]"), "assistant": ("", "</s>"),
         "system": ("<<SYS>>\n", "\n<</SYS>>")}
#: Other roles: the role's name stands between the first two.
OTHER_START, OTHER_NAMED, OTHER_END = "<|role|>", "<|says|>", "<|end|>"
_TAIL = r"/?s>|</?SYS>>|/?INST\]|\|"
_CONTROL = re.compile(rf"([<\[])(\\*)(?={_TAIL})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_TAIL})")
_HOLDER = re.compile(r"<\|(image|audio|document)\|>")
_MARK = re.compile("|".join(re.escape(m) for pair in MARKS.values() for m in pair if m)
                   + "|" + "|".join(map(re.escape, (OTHER_START, OTHER_NAMED, OTHER_END))))
#: Characters of a part, at most, unless a single turn is longer.
PART = 1 << 18

CONTENT = T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("ref", T.StringType()), T.StructField("width", T.LongType()),
    T.StructField("height", T.LongType()), T.StructField("seconds", T.DoubleType()),
    T.StructField("pages", T.LongType())]))
_ATTACHMENT = ("array<struct<turn:long, place:int, type:string, ref:string, start:long, "
               "tokens:long>>")
FORMATTED = (
    "conv_id {key}, first struct<turn:long, tie:long, last_turn:long, last_tie:long>, "
    "n_turns long, formatted string, loss array<struct<start:long, end:long>>, "
    f"attachments {_ATTACHMENT}, expanded_tokens long")


def text_part(text: Column) -> Column:
    """Content of one text part."""
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in CONTENT.elementType.fields}
    made = nothing | {"type": F.lit("text"), "text": text}
    return F.array(F.struct(*(c.alias(n) for n, c in made.items())))


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


@dataclass(frozen=True)
class Sizes:
    """How many tokens a placeholder expands to: an image's patches in square tiles, audio by
    the second, a document by the page. Attachments of unknown size count as one unit."""

    tile: int = 28
    per_second: int = 25
    per_page: int = 512

    def image(self, width: int | None, height: int | None) -> int:
        return max(1, -(-(width or 0) // self.tile)) * max(1, -(-(height or 0) // self.tile))

    def audio(self, seconds: float | None) -> int:
        ok = seconds is not None and 0 < seconds < float("inf")
        return max(1, -(-int(seconds * 1000) * self.per_second // 1000)) if ok else self.per_second

    def document(self, pages: int | None) -> int:
        return max(1, pages or 0) * self.per_page


@dataclass
class Flattened:
    """Text of a turn's content, its attachments, and where its own text lies."""

    sizes: Sizes
    pieces: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[str, str | None, int, int]] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        """Unknown types are text parts if they have a text; null parts say nothing."""
        if part is None:
            return
        kind = part["type"]
        if kind == "image":
            self._hold(kind, part, self.sizes.image(part["width"], part["height"]))
        elif kind == "audio":
            self._hold(kind, part, self.sizes.audio(part["seconds"]))
        elif kind == "document":
            self._hold(kind, part, self.sizes.document(part["pages"]))
        elif part["text"]:
            self._text(part["text"])

    def close(self) -> None:
        """Neighbouring texts are escaped as one: a control string may span them."""
        out, at = [], 0
        for piece in self._joined():
            if isinstance(piece, str):
                text = escape(piece)
                self.spans.append((at, at + len(text)))
            else:
                kind, ref, tokens = piece
                text = f"<|{kind}|>"
                self.attachments.append((kind, ref, at, tokens))
            out.append(text)
            at += len(text)
        self.pieces, self.length = out, at

    def _joined(self) -> Iterator[str | tuple]:
        texts: list[str] = []
        for piece in self.pieces:
            if isinstance(piece, str):
                texts.append(piece)
                continue
            if texts:
                yield "".join(texts)
                texts = []
            yield piece
        if texts:
            yield "".join(texts)

    def _text(self, text: str) -> None:
        self.pieces.append(text)

    def _hold(self, kind: str, part: dict, tokens: int) -> None:
        self.pieces.append((kind, part["ref"], tokens))


def format_turn(role: str | None, content: Iterable[dict] | None, sizes: Sizes) -> tuple[
        str, list[tuple[int, int]], list[tuple[str, str | None, int, int]]]:
    """Text of one turn, spans under the loss mask, attachments with their places in it."""
    flat = Flattened(sizes)
    for part in content or ():
        flat.visit(part)
    flat.close()
    role = role or ""
    start, end = MARKS.get(role) or (f"{OTHER_START}{escape(role)}{OTHER_NAMED}", OTHER_END)
    at = len(start)
    loss = [(a + at, b + at) for a, b in flat.spans] if role == "assistant" else []
    held = [(kind, ref, p + at, tokens) for kind, ref, p, tokens in flat.attachments]
    return start + "".join(flat.pieces) + end, loss, held


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted text; placeholders stay in the text."""
    ends = {start.strip(): (role, end) for role, (start, end) in MARKS.items() if start}
    turns, at, size = [], 0, len(formatted)
    while at < size:
        mark = _MARK.match(formatted, at)
        found = mark and mark.group()
        if found == OTHER_START:
            named = formatted.index(OTHER_NAMED, at)
            role, start, end = (unescape(formatted[mark.end():named]), named + len(OTHER_NAMED),
                                OTHER_END)
        elif found in (MARKS["user"][0], MARKS["system"][0]):
            role, end = ends[found.strip()]
            start = mark.end()
        else:
            role, start, end = "assistant", at, MARKS["assistant"][1]
        close = formatted.index(end, start)
        turns.append((role, unescape(formatted[start:close])))
        at = close + len(end)
    return turns


def format_chats(rows: DataFrame, sizes: Sizes = Sizes(), key: str = "conv_id",
                 turn: str = "turn", role: str = "role", content: str = "content",
                 part: int = PART) -> DataFrame:
    """The columns of ``FORMATTED``: formatted parts of all conversations.

    ``content`` is an array like ``CONTENT``. ``loss`` are the spans of the assistants' text in
    ``formatted`` (code points, without placeholders and marks), ``attachments`` the placeholders
    with their references, places and expanded token counts, whose sum is ``expanded_tokens``.

    Turns come by number, null first; turns with the same number by a hash of role and content.
    Repeated rows are formatted as often as they come. Null or empty content is an empty turn, a
    null role an empty name; rows without a key form one conversation without a key. Extra columns
    are ignored; an empty table gives no rows; texts of any length are formatted whole.
    """
    tie = F.xxhash64(role, F.to_json(F.struct(content)))
    found = rows.select(F.col(key).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        tie.alias("tie"), F.col(role).alias("role"), F.col(content).cast(
                            CONTENT).alias("content"))
    order = ["conv_id", "turn", "tie"]
    dealt = found.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType.fromDDL(FORMATTED.format(key=rows.schema[key].dataType.simpleString()))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        open_part: _Part | None = None
        size = 0
        for batch in batches:
            for row in _rows(batch):
                if open_part and (open_part.key != row["conv_id"] or open_part.length >= part):
                    held.append(open_part.row())
                    size += open_part.length
                    open_part = None
                    if size >= part:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held, size = [], 0
                open_part = open_part or _Part(row)
                open_part.add(row, *format_turn(row["role"], row["content"], sizes))
        if open_part:
            held.append(open_part.row())
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return dealt.mapInArrow(run, schema)


def _rows(batch: pa.RecordBatch, at_once: int = 512) -> Iterator[dict]:
    for at in range(0, batch.num_rows, at_once):
        yield from batch.slice(at, at_once).to_pylist()


class _Part:
    """Consecutive turns of one conversation."""

    def __init__(self, row: dict):
        self.key, self.first = row["conv_id"], (row["turn"], row["tie"])
        self.texts: list[str] = []
        self.loss: list[dict] = []
        self.attachments: list[dict] = []
        self.length = 0

    def add(self, row: dict, text: str, loss: list, attachments: list) -> None:
        self.last = (row["turn"], row["tie"])
        self.loss += [{"start": a + self.length, "end": b + self.length} for a, b in loss]
        self.attachments += [
            {"turn": row["turn"], "place": i, "type": kind, "ref": ref,
             "start": at + self.length, "tokens": tokens}
            for i, (kind, ref, at, tokens) in enumerate(attachments)]
        self.texts.append(text)
        self.length += len(text)

    def row(self) -> dict:
        order = dict(zip(("turn", "tie", "last_turn", "last_tie"), (*self.first, *self.last)))
        return {"conv_id": self.key, "first": order, "n_turns": len(self.texts),
                "formatted": "".join(self.texts), "loss": self.loss,
                "attachments": self.attachments,
                "expanded_tokens": sum(a["tokens"] for a in self.attachments)}


class _Digest:
    """Digests of one conversation, part by part."""

    def __init__(self, key):
        self.key, self.turns, self.loss = key, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.tokens = 0

    def add(self, formatted: str, loss: list[dict], tokens: int) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in loss:
            text = unescape(formatted[span["start"]:span["end"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)
        self.tokens += tokens

    def values(self) -> tuple:
        return (self.key, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.chars, self.tokens)


def digests(parts: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    expanded_tokens`` per conversation, read back from formatted parts.

    A conversation of one part is digested where the part is read. Only those of several parts
    are brought together: sorted and streamed part by part, as a digest goes from first to last.
    """
    parts = stored(parts, "chats")
    schema = T.StructType([
        parts.schema["conv_id"], T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
        T.StructField("expanded_tokens", T.LongType())])
    arrow = to_arrow_schema(schema)
    columns = ["conv_id", "formatted", "loss", "expanded_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        done: list[tuple] = []
        for batch in slices(batches, 1, 1 << 20):
            for row in batch.to_pylist():
                if now is None or now.key != row["conv_id"]:
                    if now:
                        done.append(now.values())
                    now = _Digest(row["conv_id"])
                now.add(row["formatted"], row["loss"], row["expanded_tokens"])
            if done:
                yield _batch(done)
                done = []
        if now:
            yield _batch([now.values()])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    several = parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("conv_id").alias("_several"))
    same = F.col("conv_id").eqNullSafe(F.col("_several"))
    single = parts.join(several, same, "left_anti").select(*columns)
    split = parts.join(several, same, "left_semi").repartition("conv_id").sortWithinPartitions(
        "conv_id", "first").select(*columns)
    return single.mapInArrow(run, schema).unionByName(split.mapInArrow(run, schema))
