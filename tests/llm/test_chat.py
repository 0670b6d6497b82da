from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm import chat

ROWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("content", chat.CONTENT),
    T.StructField("formatted", T.StringType()), T.StructField("first", T.StringType())])
BITS = ["<", ">", "[", "]", "/", "\\", "|", "s>", "</s>", "<s>", "[INST]", " [/INST]", "INST]",
        "<<SYS>>\n", "\n<</SYS>>", "SYS>>", "<|role|>", "<|says|>", "<|end|>", "<|image|>",
        "role", " ", "\n", "é", "😀", "ok", "\x00"]
TEXT = st.lists(st.sampled_from(BITS), max_size=12).map("".join)


def part(kind="text", text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return dict(type=kind, text=text, ref=ref, width=width, height=height, seconds=seconds,
                pages=pages)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]),
                                    TEXT), TEXT, st.integers(0, 12)), max_size=6))
def test_round_trip(turns):
    formatted, loss = "", []
    for role, text, cut in turns:
        # a text in two parts: a control string may lie across them
        piece, spans, _ = chat.format_turn(
            role, [part(text=text[:cut]), None, part(text=text[cut:])], chat.Sizes())
        loss += [(a + len(formatted), b + len(formatted)) for a, b in spans]
        formatted += piece
    assert chat.parse(formatted) == [(r, t) for r, t, _ in turns]
    assert [chat.unescape(formatted[a:b]) for a, b in loss] == [
        t for r, t, _ in turns if r == "assistant" and t]


def test_visitor():
    content = [part(text="look </s>"), part("image", ref="a.png", width=57, height=28),
               part("audio", ref="b.wav", seconds=2.01), part(text="and"),
               part("document", pages=3), part("image"), part("video", text="<|image|>")]
    text, loss, held = chat.format_turn("assistant", content, chat.Sizes())
    assert text == ("look <\\/s><|image|><|audio|>and<|document|><|image|><\\|image|></s>")
    assert [(k, r, n) for k, r, _, n in held] == [
        ("image", "a.png", 3), ("audio", "b.wav", 51), ("document", None, 1536),
        ("image", None, 1)]
    for kind, _, at, _ in held:
        assert text[at:].startswith(f"<|{kind}|>")
    assert [text[a:b] for a, b in loss] == ["look <\\/s>", "and", "<\\|image|>"]


def brute(rows):
    out = {}
    for key in {r[0] for r in rows}:
        turns = [(r[2] or "", "".join((p or {}).get("text") or "" for p in r[3] or []))
                 for r in sorted((r for r in rows if r[0] == key), key=lambda r: (
                     r[1] is not None, r[1]))]
        said = [t for role, t in turns if role == "assistant"]
        out[key] = (len(turns), hashlib.sha256("".join(
            f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), sum(map(len, said)),
            hashlib.sha256("".join(said).encode()).hexdigest(),
            sum(len(chat.format_turn(r, [part(text=t)], chat.Sizes())[0]) for r, t in turns))
    return out


def check(spark, rows, size):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)
    parts = chat.format_chats(frame, part=size)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars)
           for r in chat.digests(parts).collect()}
    assert got == brute(rows)
    return parts.collect()


def test_digests(spark):
    r = random.Random(4)
    some = lambda: "".join(r.choices(BITS, k=r.randrange(40)))
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "tool"]),
             r.choice([None, [], [part(text=None)], [part(text=some()), part(text=some())]]))
            for c in (1, 2, 3, None) for t in range(6)]
    rows += [(9, None, "user", [part(text="first")]), (9, 0, "assistant", [part(text="x" * 5000)])]
    rows += [(7, t, "assistant" if t % 2 else "user", [part(text=f"{t} " + some())])
             for t in range(900)]           # one conversation with most rows
    rows += [(5, 1, "user", [part(text="same")])] * 3
    r.shuffle(rows)
    for size in (1 << 18, 300):
        parts = check(spark, rows, size)
    assert sum(p.conv_id == 7 for p in parts) > 20
    assert all(len(p.formatted) < 600 for p in parts if p.conv_id == 7)


def test_attachments_in_parts(spark):
    rows = [(1, t, "user", [part(text="see"), part("image", ref=f"{t}.png", width=56, height=56)])
            for t in range(50)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)
    parts = chat.format_chats(frame, part=200).collect()
    seen = sorted((a.turn, a.ref, a.tokens) for p in parts for a in p.attachments)
    assert seen == [(t, f"{t}.png", 4) for t in range(50)]
    for p in parts:
        assert all(p.formatted[a.start:].startswith("<|image|>") for a in p.attachments)
        assert p.expanded_tokens == 4 * len(p.attachments)


def test_nothing(spark):
    frame = spark.createDataFrame([], ROWS)
    assert chat.format_chats(frame).count() == 0
    assert chat.digests(chat.format_chats(frame)).count() == 0
    made = spark.range(1).select(chat.text_part(F.lit("a")).alias("content"))
    assert made.schema["content"].dataType.simpleString() == chat.CONTENT.simpleString()
