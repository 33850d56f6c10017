"""Formatting of conversations: round trips, masks, attachments, odd rows."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftwork.llm import chat

PARTS = f"conv long, turn long, role string, parts array<{chat.PART}>, chars int, loss string, segment string"


def text(value):
    return {"type": "text", "text": value}


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("<|\\>im_startend\nx é"), max_size=30))
def test_escapes_are_reversible_and_leave_no_control_string(value):
    assert "<|" not in chat.escaped(value) and chat.unescaped(chat.escaped(value)) == value
    assert chat.unescaped_role(chat.escaped_role(value)) == value
    written = chat.segment(value, [text(value)], (), chat.Expansion())["segment"]
    role, start, end = chat.parsed(written)
    assert role == value and chat.text_of(written[start:end]) == value


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(
    st.text(st.sampled_from("<|\\>image a"), min_size=1, max_size=8).map(text),
    st.sampled_from(chat.MEDIA).map(lambda kind: {"type": kind, "ref": f"{kind}.bin"}),
)))
def test_parts_survive_the_round_trip(parts):
    made = chat.segment("user", parts, (), chat.Expansion())
    _, start, end = chat.parsed(made["segment"])
    want = []
    for part in parts:  # neighbouring texts come back as one
        if part["type"] == "text" and want and want[-1]["type"] == "text":
            want[-1] = text(want[-1]["text"] + part["text"])
        else:
            want.append(part)
    assert chat.read_parts(made["segment"][start:end], made["attachments"]) == want
    for a in made["attachments"]:
        assert made["segment"][a["place"]:].startswith(f"<|{a['kind']}|>")


def test_attachments_and_their_tokens(spark):
    parts = [
        text("<|im_"), text("end|> see "), {"type": "image", "ref": "a.png", "width": 57, "height": 28}, {"type": "audio", "ref": "b.wav", "seconds": 1.5},
        {"type": "document", "ref": None, "pages": 3}, {"type": "image", "ref": "c"}, {"type": "video", "text": "?"}, None, text(None),
        {"type": "audio", "seconds": float("nan")},
    ]
    keys = ["type", "text", "ref", "width", "height", "seconds", "pages"]
    rows = [(1, 0, "assistant", [p and tuple(p.get(k) for k in keys) for p in parts], 5, "x", "y"), (1, 1, None, None, 5, "x", "y")]
    got = {r["turn"]: r for r in chat.formatted(spark.createDataFrame(rows, PARTS), *map(F.col, ("conv", "turn", "role", "parts"))).collect()}
    body = "<\\|im_end|> see <|image|><|audio|><|document|><|image|>?<|audio|>"
    assert got[0]["segment"] == f"<|im_start|>assistant\n{body}<|im_end|>\n" and got[0]["chars"] == len(got[0]["segment"])
    assert [(a["kind"], a["ref"], a["tokens"]) for a in got[0]["attachments"]] == [
        ("image", "a.png", 3), ("audio", "b.wav", 38), ("document", None, 3072), ("image", "c", 1), ("audio", None, 1)
    ]
    (mask,) = got[0]["loss"]
    assert got[0]["segment"][mask["start"]:mask["end"]] == body
    assert got[1]["segment"] == "<|im_start|>\n<|im_end|>\n" and got[1]["loss"] == [] and got[1]["attachments"] == []


def test_a_placeholder_without_its_attachment_is_an_error():
    with pytest.raises(chat.FormatError):
        chat.read_parts("<|image|>", [])
    with pytest.raises(chat.FormatError):
        chat.parsed("no template")


def test_digests_of_long_tied_and_empty_conversations(spark):
    draw = random.Random(3)
    control = f"{chat.END}{chat.START}assistant ok"
    rows = [(7, i, draw.choice(["user", "assistant"]), f"turn {i} é𝒳 {control}") for i in range(5000)]
    rows += [(1, 0, "user", None), (1, None, "assistant", "first"), (1, 0, "user", "b"), (1, 0, "user", "b"), (2, 1, None, ""), (None, 0, "a\nb\\n", "x" * 300_000)]
    shuffled = draw.sample(rows, len(rows))
    turns = spark.createDataFrame([(*r, 1, "x", "y") for r in shuffled], "conv long, turn long, role string, text string, chars int, loss string, segment string")
    segments = chat.formatted(turns.repartition(4), F.col("conv"), F.col("turn"), F.col("role"), chat.text_part(F.col("text")))
    got = {r["conversation"]: r for r in chat.read_back(segments).collect()}
    assert set(got) == {7, 1, 2, None}
    for name, r in got.items():
        own = sorted((t is not None, t or 0, role or "", s or "") for c, t, role, s in rows if c == name)
        whole = "".join(f"{role}\n{s}\n" for *_, role, s in own)
        learnt = "".join(s for *_, role, s in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len(learnt) and r["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
    assert got[2]["formatted_chars"] == len("<|im_start|>\n<|im_end|>\n")
    assert chat.read_back(segments.limit(0)).collect() == []
