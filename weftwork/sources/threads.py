"""Nested comment threads as a flat table."""

from __future__ import annotations

import json as json_reader
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Numbers of paths and characters of bodies that a task gathers before it passes rows on.
HELD = 1 << 20

_TOKEN = re.compile(r'[ \t\r\n]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?\d[\d.eE+-]*|true|false|null))')
_SPACE = re.compile(r"[ \t\r\n]*\Z")


class _Broken(ValueError):
    """Text that is no JSON."""


def read_json(text: str):
    """The value of a JSON text, nested to any depth; ValueError if it is none."""
    try:
        return json_reader.loads(text)
    except RecursionError:
        return _read_deep(text)


def _read_deep(text: str):
    """The same with a stack of its own in place of recursion."""
    holder: list = []  # the whole value is its one item
    stack: list[tuple[list | dict, str | None]] = []
    inside: list | dict = holder
    key: str | None = None
    at, wanted = 0, "value"  # value, key, colon, or after a value
    while True:
        found = _TOKEN.match(text, at)
        if not found:
            if wanted == "after" and not stack and inside is holder and _SPACE.match(text, at):
                return holder[0]
            raise _Broken(at)
        at = found.end()
        mark = found[1]
        if mark in ("}", "]"):
            empty = not inside and wanted == ("key" if mark == "}" else "value")
            if not stack or isinstance(inside, dict) != (mark == "}") or not (wanted == "after" or empty):
                raise _Broken(at)
            inside, key = stack.pop()
            wanted = "after"
        elif mark == ",":
            if wanted != "after" or inside is holder:
                raise _Broken(at)
            wanted = "key" if isinstance(inside, dict) else "value"
            if wanted == "value":
                inside.append(_NOTHING)  # taken away when the next value comes
        elif mark == ":":
            if wanted != "colon":
                raise _Broken(at)
            wanted = "value"
        elif wanted == "key":
            if found[2] is None:
                raise _Broken(at)
            key, wanted = json_reader.loads(found[2]), "colon"
        elif wanted == "value":
            value = {} if mark == "{" else [] if mark == "[" else json_reader.loads(found[2] or found[3])
            if isinstance(inside, dict):
                inside[key] = value
            else:
                if inside and inside[-1] is _NOTHING:
                    inside.pop()
                inside.append(value)
            wanted = "after"
            if mark:
                stack.append((inside, key))
                inside, wanted = value, "key" if mark == "{" else "value"
        else:
            raise _Broken(at)


_NOTHING = object()


def _text(value) -> str | None:
    """A field as text: numbers and truth values as JSON writes them."""
    if value is None or isinstance(value, str):
        return value
    return json_reader.dumps(value, separators=(",", ":"), ensure_ascii=False)


def _within(value, *names):
    """The value behind names of nested objects and places of lists, None where there is none."""
    for name in names:
        if isinstance(value, dict) and isinstance(name, str):
            value = value.get(name)
        elif isinstance(value, list) and isinstance(name, int) and name < len(value):
            value = value[name]
        else:
            return None
    return value


def comments_of(listing, response: bool = False) -> Iterator[tuple[str | None, str | None, str | None, str | None, list[int]]]:
    """(comment_id, parent_id, author, body, path) of all comments of a thread as one reads it, replies behind their comment."""
    top = _within(listing, 1, "data", "children") if response else listing
    stack: list[tuple[list, int, str | None]] = [(top, 0, None)] if isinstance(top, list) else []
    while stack:
        children, place, parent = stack.pop()
        if place == len(children):
            continue
        stack.append((children, place + 1, parent))
        data = _within(children[place], "data")
        if data is None:
            continue
        name, author, body = (_text(_within(data, field)) for field in ("id", "author", "body"))
        yield name, parent, author, body, [p - 1 for _, p, _ in stack]
        replies = _within(data, "replies", "data", "children")
        if isinstance(replies, list):
            stack.append((replies, 0, name))


def parse_comments(
    threads: DataFrame, post_id: str, json: str, drop_stubs: bool = False, response: bool = False,
) -> DataFrame:
    """(comment_id, parent_id, post_id, author, body, path) from a JSON array of children, in one scan.

    Threads are read one by one with a stack, so neither their depth nor their number adds a job. Empty
    replies come as "" and end there. Children without data give no row; "more comments" stubs have no
    author and no body and can be dropped. path orders the rows as one reads a thread. With response the
    column holds the whole answer [post listing, comment listing]. NULL and what is no JSON give no row.
    """
    kind = threads.select(post_id).schema[0].dataType.simpleString()
    schema = f"comment_id string, parent_id string, post_id {kind}, author string, body string, path array<int>"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for post, text in zip(batch.column(0), batch.column(1)):
                try:
                    listing = read_json(text.as_py() or "null")
                except ValueError:
                    continue
                post = post.as_py()
                for name, parent, author, body, path in comments_of(listing, response):
                    if drop_stubs and author is None and body is None:
                        continue
                    rows.append({"comment_id": name, "parent_id": parent, "post_id": post, "author": author, "body": body, "path": path})
                    held += len(path) + len(body or "")
                    if held > HELD:
                        yield pa.RecordBatch.from_pylist(rows, schema=target)
                        rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=target)

    return threads.select(post_id, F.col(json).cast("string")).mapInArrow(read, schema)
