"""Tables with NULLs, empty and very long texts, ties, repeated rows and further columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, source string, code string, features string, rate string, row string, copy string, shard string"


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(n))


def documents(spark):
    long = words(5, 60_000)
    rows = [
        (1, None, "a"), (2, "", "a"), (3, long, "b"), (4, words(1, 40), None), (5, words(1, 40), "b"),
        (6, words(1, 39) + " other", "b"), (7, "One", "c"), (7, "One", "c"), (7, "One", "c"), (None, words(2, 30), "c"),
        (None, None, None), (8, " \t\n ", "c"), (9, "Ünïcode 日本語 𝒳 ▁ tail", "c"), (10, "one", "a"),
    ]
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "v", "u") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
