r"""Conversations of typed content parts as training text with a loss mask, and back.

A turn is written as <|im_start|>role, a line feed, its content and <|im_end|> with a line feed.
Control strings inside texts are escaped reversibly: between '<' and '|' one backslash is added to
those that stand there, so no text holds '<|'.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.llm.tables import SLICE_ROWS, arrow_schema

START, END = "<|im_start|>", "<|im_end|>"
#: What an image, audio or document part has beside its reference; a text part has text only.
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: place: code points before the placeholder in the turn's segment; tokens: what it expands to.
ATTACHMENT = "struct<kind:string,ref:string,place:int,tokens:bigint>"
MEDIA = ("image", "audio", "document")
_PLACEHOLDER = re.compile(r"<\|(image|audio|document)\|>")
_SEGMENT = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + r"\n", re.DOTALL)


class FormatError(ValueError):
    """A segment that the template cannot have written."""


@dataclass(frozen=True)
class Expansion:
    """Model tokens that a placeholder stands for; a missing measure counts as one unit."""

    patch: int = 28
    audio_rate: float = 25.0
    page: int = 1024

    def tokens(self, kind: str, part: dict) -> int:
        if kind == "image":
            sides = [max(1, math.ceil((part.get(side) or 0) / self.patch)) for side in ("width", "height")]
            return sides[0] * sides[1]
        if kind == "audio":
            seconds = part.get("seconds") or 0.0
            return max(1, math.ceil(seconds * self.audio_rate)) if math.isfinite(seconds) else 1
        return max(1, part.get("pages") or 0) * self.page


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(role: str) -> str:
    r"""A role stays on its line: backslash and line feed are written \\ and \n."""
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


class Flattener:
    """Visits the parts of a turn in order; content() is their text with one placeholder per attachment.

    Neighbouring texts are joined before they are escaped, so that two parts cannot make up a control
    string together. A part of another type, or without one, counts as text.
    """

    def __init__(self, expansion: Expansion, offset: int):
        self.expansion, self.chars = expansion, offset
        self.pieces: list[str] = []
        self.held: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict | None) -> None:
        part = part or {}
        visit = self.visit_media if part.get("type") in MEDIA else self.visit_text
        visit(part)

    def visit_text(self, part: dict) -> None:
        self.held.append(part.get("text") or "")

    def visit_media(self, part: dict) -> None:
        self.write_held()
        kind = part["type"]
        self.attachments.append(
            {"kind": kind, "ref": part.get("ref"), "place": self.chars, "tokens": self.expansion.tokens(kind, part)}
        )
        self.write(f"<|{kind}|>")

    def write_held(self) -> None:
        self.write(escaped("".join(self.held)))
        self.held.clear()

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.chars += len(text)

    def content(self) -> str:
        self.write_held()
        return "".join(self.pieces)


def segment(role: str | None, parts: list[dict] | None, trained: tuple[str, ...], expansion: Expansion) -> dict:
    """One turn as the template writes it."""
    head = f"{START}{escaped_role(role or '')}\n"
    flat = Flattener(expansion, len(head))
    for part in parts or []:
        flat.visit(part)
    content = flat.content()
    text = f"{head}{content}{END}\n"
    mask = [{"start": len(head), "end": len(head) + len(content)}] if (role or "") in trained else []
    return {"segment": text, "chars": len(text), "loss": mask, "attachments": flat.attachments}


def parsed(text: str) -> tuple[str, int, int]:
    """Role of a segment, and where its content starts and ends."""
    found = _SEGMENT.fullmatch(text)
    if not found:
        raise FormatError(text[:80])
    return unescaped_role(found[1]), found.start(2), found.end(2)


def read_parts(content: str, attachments: list[dict]) -> list[dict]:
    """The parts of a turn's content: its texts, unescaped, and its attachments by reference."""
    parts, at, rest = [], 0, iter(attachments)
    for found in _PLACEHOLDER.finditer(content):
        if found.start() > at:
            parts.append({"type": "text", "text": unescaped(content[at:found.start()])})
        attachment = next(rest, None)
        if attachment is None or attachment["kind"] != found[1]:
            raise FormatError(f"placeholder {found[0]} without its attachment")
        parts.append({"type": found[1], "ref": attachment["ref"]})
        at = found.end()
    if at < len(content):
        parts.append({"type": "text", "text": unescaped(content[at:])})
    return parts


def text_of(content: str) -> str:
    """The texts of a turn's content, unescaped and joined."""
    return "".join(unescaped(piece) for piece in _PLACEHOLDER.split(content)[::2])


def text_part(text: Column) -> Column:
    """A turn's content from one text column; NULL is the empty text."""
    fields = {"type": F.lit("text"), "text": F.coalesce(text.cast("string"), F.lit(""))}
    names = [f.split(":") for f in PART[7:-1].split(",")]
    return F.array(F.struct(*[fields.get(n, F.lit(None)).cast(t).alias(n) for n, t in names]))


def formatted(
    turns: DataFrame, conversation: Column, turn: Column, role: Column, parts: Column,
    trained: tuple[str, ...] = ("assistant",), expansion: Expansion = Expansion(),
) -> DataFrame:
    """One segment per turn: conversation, turn, segment, chars, loss (spans of code points in the segment
    that are trained on), attachments. A conversation's text is its segments ordered by turn, then segment.

    parts is an array of PART. NULL parts, texts and roles are empty, empty content is kept as an empty
    turn; repeated rows are turns of their own; further columns are not read. Works row by row, so a
    conversation of any length is spread like any other rows.
    """
    schema = (
        f"conversation long, turn long, segment string, chars long, loss array<struct<start:int,end:int>>, attachments array<{ATTACHMENT}>"
    )
    target = arrow_schema(turns, schema)
    source = turns.select(
        conversation.cast("long").alias("conversation"), turn.cast("long").alias("turn"), role.cast("string").alias("role"), parts.alias("parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(start, SLICE_ROWS).to_pylist()
                yield pa.RecordBatch.from_pylist(
                    [{**r, **segment(r["role"], r["parts"], trained, expansion)} for r in rows], schema=target
                )

    return source.mapInArrow(run, schema)


class Reading:
    """What was read of one conversation so far; texts go into the digests and are not kept."""

    def __init__(self, conversation: int | None):
        self.row = {"conversation": conversation, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, mask: list[dict]) -> None:
        role, start, end = parsed(text)
        self.turns.update(f"{role}\n{text_of(text[start:end])}\n".encode("utf-8", "surrogatepass"))
        for span in mask:
            learnt = text_of(text[span["start"]:span["end"]])
            self.loss.update(learnt.encode("utf-8", "surrogatepass"))
            self.row["loss_chars"] += len(learnt)
        self.row["n_turns"] += 1
        self.row["formatted_chars"] += len(text)

    def done(self) -> dict:
        return {**self.row, "turns_sha256": self.turns.hexdigest(), "loss_sha256": self.loss.hexdigest()}


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, from its formatted segments alone: conversation, n_turns, turns_sha256 (role, line
    feed, text, line feed per turn), loss_chars, loss_sha256 (all text under the mask), formatted_chars.

    The segments of a conversation pass through one task in order, as a SHA-256 must, but are never held
    together: Spark sorts them on disk and the task keeps two digests. NULL is a conversation of its own.
    """
    schema = "conversation long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    target = arrow_schema(segments, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading = None
        for batch in batches:
            done = []
            for name, text, mask in zip(*(batch.column(c) for c in ("conversation", "segment", "loss"))):
                name = name.as_py()
                if reading is None or reading.row["conversation"] != name:
                    done += [reading.done()] if reading else []
                    reading = Reading(name)
                reading.add(text.as_py(), mask.as_py())
            yield pa.RecordBatch.from_pylist(done, schema=target)
        if reading:
            yield pa.RecordBatch.from_pylist([reading.done()], schema=target)

    ordered = segments.select("conversation", "turn", "segment", "loss").repartition("conversation").sortWithinPartitions(
        F.col("conversation").asc_nulls_first(), F.col("turn").asc_nulls_first(), "segment"
    )
    return ordered.mapInArrow(run, schema)
