"""Merkle manifest against a tree built in the test."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tests.llm import odd

from weftwork.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """Root, and for every node the list of its runs' other nodes with the node's place."""
    spots, proofs = [[i] for i in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        above, above_spots = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i:i + 3]
            for k in range(len(run)):
                for spot in spots[i + k]:
                    proofs[spot].append((k, run[:k] + run[k + 1:]))
            above.append(sha(*run))
            above_spots.append([s for part in spots[i:i + 3] for s in part])
        nodes, spots = above, above_spots
    return nodes[0], proofs


def by_brute_force(rows):
    """[(key, leaf, subroot, root, proof)] of rows (group, key, value)."""
    groups = {}
    for group, key, value in rows:
        groups.setdefault(group, []).append((key is not None, key or 0, sha(encoded(group), encoded(key), encoded(value))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([leaf for *_, leaf in sorted(groups[g])]) for g in names}
    root, above = climb([trees[g][0] for g in names]) if names else (None, [])
    return [
        (key if known else None, leaf, trees[g][0], root, proof + above[names.index(g)])
        for g in names for (known, key, leaf), proof in zip(sorted(groups[g]), trees[g][1])
    ]


def built(df, block_levels):
    rows = merkle.manifest(
        df, F.col("group"), [F.col("key")], [F.col("group"), F.col("key"), F.col("value")], {"key": F.col("key")}, block_levels
    ).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).withColumn("digest", merkle.path_digest(F.col("path"))).collect()
    for r in rows:
        assert r["folded"] == r["root"]
        assert r["digest"] == sha(*[s for step in r["path"] for s in step["siblings"]])
    return [(r["key"], r["leaf"], r["subroot"], r["root"], [(s["place"], list(s["siblings"])) for s in r["path"]]) for r in rows]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("block_levels", [0, 2])
def test_trees_are_those_of_the_definition(spark, block_levels):
    draw = random.Random(block_levels)
    sizes = {None: 4, "": 1, "a": 100, "b": 1, "é": 28, "Z": 9, "c": 10, "d": 3, "e": 2, "f": 1, "g": 55}
    rows = [(g, i * 7 - 20, draw.choice(["x\ny", "", None, "é"])) for g, n in sizes.items() for i in range(n)]
    draw.shuffle(rows)
    got = built(spark.createDataFrame(rows, "group string, key long, value string").repartition(5), block_levels)
    assert order(got) == order(by_brute_force(rows))


@pytest.mark.parametrize("rows", [
    [("a", 1, "x")],
    [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), ("a", None, None), (None, 2**60 + 1, "w")],
    [(f"g{i}", i, "v") for i in range(10)],
])
def test_lone_tied_and_repeated_rows(spark, rows):
    assert order(built(spark.createDataFrame(rows, "group string, key long, value string"), 1)) == order(by_brute_force(rows))


def test_a_changed_row_does_not_fold_to_the_root(spark):
    rows = spark.range(30).select(F.lit("s").alias("group"), F.col("id").alias("key"), F.lit("a\nb").alias("value"))
    values = [F.col("group"), F.col("key")]
    claimed = merkle.row_digest(*values, F.when(F.col("key") == 11, F.lit("ab")).otherwise(F.col("value")))
    found = merkle.manifest(rows, F.col("group"), [F.col("key")], [*values, F.col("value")], {"key": F.col("key"), "claimed": claimed}, 1)
    wrong = found.filter(merkle.fold(F.col("claimed"), F.col("path")) != F.col("root")).collect()
    assert [r["key"] for r in wrong] == [11]


def test_odd_rows(spark):
    docs = odd.documents(spark)
    columns = [F.col(c) for c in ("source", "doc_id", "text")]
    rows = [(r["source"], r["doc_id"], r["text"]) for r in docs.collect()]
    found = merkle.manifest(docs, columns[0], [columns[1]], columns, {"doc_id": columns[1]}, 1)
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["place"], list(s["siblings"])) for s in r["path"]]) for r in found.collect()]
    assert order(got) == order(by_brute_force(rows))
    empty = odd.empty(spark)
    assert merkle.manifest(empty, columns[0], [columns[1]], columns, {"doc_id": columns[1]}).collect() == []
