"""Merkle manifest of a table: one tree per group of rows, one tree over the groups' roots.

Leaves are dealt to aligned blocks of 3^BLOCK_LEVELS neighbours. What lies above the blocks is built by a
butterfly: in every round the blocks of a run swap the roots of their subtrees and each of them hashes the
parent itself, so that after the last round every block holds all it needs above it and nothing is sent
back down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.llm.tables import arrow_schema
from weftwork.operators.ranking import position, running_total
from weftwork.session import materialise

FANOUT = 3
#: Levels of the tree that one block covers by itself: 3^7 = 2187 leaves.
BLOCK_LEVELS = 7
#: A proof, from the leaf up: the node's place in its run, and the run's other nodes from left to right.
PATH = "array<struct<place:int,siblings:array<string>>>"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_digest(*values: Column) -> Column:
    """Hexadecimal SHA-256 of the values in turn: '-' if NULL, else UTF-8 bytes, ':', the value as text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]), 256)


def levels_of(nodes: Sequence[str], levels: int | None = None) -> list[list[str]]:
    """The nodes and the levels above them: so many, or as many as leave one node."""
    out = [list(nodes)]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([digest(*below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def path_of(levels: list[list[str]], at: int) -> list[dict]:
    """The proof of node number at of the lowest level, up to the last level."""
    path = []
    for nodes in levels[:-1]:
        first = at - at % FANOUT
        run = nodes[first:first + FANOUT]
        path.append({"place": at - first, "siblings": run[:at - first] + run[at - first + 1:]})
        at //= FANOUT
    return path


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    def up(node: Column, step: Column) -> Column:
        left = F.slice(step["siblings"], F.lit(1), step["place"])
        right = F.slice(step["siblings"], step["place"] + 1, F.size(step["siblings"]))
        return F.sha2(F.concat(F.array_join(left, ""), node, F.array_join(right, "")), 256)

    return F.aggregate(path, leaf, up)


def path_digest(path: Column) -> Column:
    """SHA-256 of all nodes of a proof, from the leaf up, each run from left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda step: step["siblings"])), ""), 256)


def leaves_in_order(df: DataFrame, group: Column, order: list[Column], leaf: Column, keep: dict[str, Column]) -> DataFrame:
    """_group, _at (place in its group, from 0), _n (leaves of the group), leaf, and the columns of keep.

    Groups sort NULL first, then by bytes. Leaves of one order sort by their digest, so repeated rows
    are leaves of their own in a defined order.
    """
    name = F.when(group.isNull(), "").otherwise(F.concat(F.lit("1"), group.cast("string")))
    rows = df.select(name.alias("_group"), leaf.alias("leaf"), *[c.alias(k) for k, c in keep.items()],
                     *[c.alias(f"_order{i}") for i, c in enumerate(order)])
    by = [F.col(f"_order{i}").asc_nulls_first() for i in range(len(order))] + [F.col("leaf").asc()]
    placed = running_total(materialise(rows, "leaves"), ["_group"], by, F.lit(1), "_at", total="_n")
    return placed.withColumn("_at", F.col("_at") - 1).drop(*[f"_order{i}" for i in range(len(order))])


def block_roots(leaves: DataFrame, block_levels: int) -> DataFrame:
    """_group, _block, _parts (blocks of the group), node (the block's root)."""
    width = FANOUT**block_levels

    def root(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_at")
        parts = -(-rows["_n"][0].as_py() // width)
        top = levels_of(rows["leaf"].to_pylist(), None if parts == 1 else block_levels)[-1][0]
        return rows.select(["_group", "_block"]).slice(0, 1).append_column("_parts", pa.array([parts])).append_column("node", pa.array([top]))

    return leaves.select("_group", "_block", "_at", "_n", "leaf").groupBy("_group", "_block").applyInArrow(
        root, "_group string, _block long, _parts long, node string"
    )


def swap(state: DataFrame, run: list[Column], digit: Column, number: Column, size: Column, width: Column) -> DataFrame:
    """One round: the members of a run swap the roots of their subtrees, and each hashes the parent.

    Member `number` of a subtree of `size` members meets its like of the other subtrees in a lane of
    its run; the run has `width` lanes. A subtree with fewer members serves the other lanes too, dealt
    evenly. A lane holds one row per subtree: FANOUT at most.
    """
    keys = [f"_run{i}" for i in range(len(run))]
    sent = state.select(
        *[c.alias(k) for c, k in zip(run, keys)], digit.cast("int").alias("_digit"), number.alias("_number"),
        F.explode(F.sequence(number, width - 1, size)).alias("_lane"), F.struct(*state.columns).alias("_member"),
    )
    met = sent.groupBy(*keys, "_lane").agg(F.sort_array(F.collect_list(F.struct(
        "_digit", F.col("_member.node").alias("node"), F.when(F.col("_lane") == F.col("_number"), F.col("_member")).alias("member"),
    ))).alias("_met"))
    nodes = F.transform("_met", lambda m: m["node"])
    mine = met.select(F.posexplode("_met").alias("_place", "_own"), nodes.alias("_nodes")).filter("_own.member IS NOT NULL")
    step = F.struct(
        F.col("_place").cast("int").alias("place"),
        F.concat(F.slice("_nodes", F.lit(1), F.col("_place")), F.slice("_nodes", F.col("_place") + 2, F.size("_nodes"))).alias("siblings"),
    )
    return mine.select(
        *[F.col(f"_own.member.{c}").alias(c) for c in state.columns if c not in ("node", "path")],
        F.sha2(F.array_join("_nodes", ""), 256).alias("node"),
        F.concat("_own.member.path", F.array(step)).alias("path"),
    ).select(*state.columns)


def butterfly(blocks: DataFrame) -> DataFrame:
    """_group, _block, subroot, root, path (the proof from the block up to the root)."""
    state = materialise(blocks.withColumn("path", F.array().cast(PATH)), "blocks")
    # Only counts come to the driver: the most blocks of a group, later the number of groups.
    most, step = state.agg(F.max("_parts")).first()[0] or 0, 1
    while step < most:
        at, span = F.col("_block"), step * FANOUT
        first = F.floor(at / span) * span
        own = F.floor(at / step) * step
        met = swap(
            state.filter(F.col("_parts") > step), [F.col("_group"), F.floor(at / span)], F.floor(at / step) % FANOUT, at % step,
            F.least(F.lit(step), F.col("_parts") - own), F.least(F.lit(step), F.col("_parts") - first),
        )
        state, step = materialise(met.unionByName(state.filter(F.col("_parts") <= step)), "swapped"), span
    # The same over the groups; a subtree's members are the blocks of all its groups in order.
    groups = state.select("_group", "_parts").distinct()
    groups = running_total(groups, [], [F.col("_group").asc()], F.col("_parts"), "_earlier").withColumn("_earlier", F.col("_earlier") - F.col("_parts"))
    groups = materialise(position(groups.drop("_parts"), [], [F.col("_group").asc()], "_place"), "groups")
    number = groups.count()
    state = state.join(groups, "_group").withColumn("subroot", F.col("node"))
    step = 1
    while step < number:
        tree, run = F.floor(F.col("_place") / step), F.floor(F.col("_place") / (step * FANOUT))
        sizes = state.groupBy(tree.alias("_tree")).agg(F.min("_earlier").alias("_first"), F.count(F.lit(1)).alias("_size"))
        sizes = sizes.withColumn("_width", F.max("_size").over(Window.partitionBy(F.floor(F.col("_tree") / FANOUT))))
        held = state.columns
        sized = state.withColumn("_tree", tree).join(materialise(sizes, "sizes"), "_tree")
        met = swap(
            sized, [run], F.col("_tree") % FANOUT, F.col("_earlier") + F.col("_block") - F.col("_first"), F.col("_size"), F.col("_width")
        )
        state, step = materialise(met.select(*held), "swapped"), step * FANOUT
    return state.select("_group", "_block", "subroot", F.col("node").alias("root"), "path")


def manifest(
    df: DataFrame, group: Column, order: list[Column], columns: list[Column], keep: dict[str, Column],
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """The columns of keep, leaf, subroot, root and path for every row of df.

    A leaf is the digest of columns; leaves are ordered inside their group, every 3 neighbours become
    one node until one is left, and the groups' roots become the root in the same way. NULL is a group
    and an order of its own (first); rows of one order sort by their leaf, repeated rows included. A
    group of one row is its own subroot, a single group's subroot is the root. Texts are hashed in the
    JVM and leave the scan as digests; further columns are not read. An empty table gives no rows.
    """
    width = FANOUT**block_levels
    leaves = leaves_in_order(df, group, order, row_digest(*columns), keep).withColumn("_block", F.floor(F.col("_at") / width))
    leaves = materialise(leaves, "ordered")
    above = butterfly(block_roots(leaves, block_levels))
    names = [*keep, "leaf", "subroot", "root"]

    path_type = arrow_schema(df, f"path {PATH}").field("path").type

    def prove(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        rows = rows.sort_by("_at")
        levels = levels_of(rows["leaf"].to_pylist(), None if rows["_n"][0].as_py() <= width else block_levels)
        block = blocks.to_pylist()[0]
        paths = [path_of(levels, i) + block["path"] for i in range(len(rows))]
        for name in ("subroot", "root"):
            rows = rows.append_column(name, pa.array([block[name]] * len(rows), pa.string()))
        return rows.append_column("path", pa.array(paths, path_type)).select([*names, "path"])

    kept = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    schema = ", ".join(f"`{n}` {kept.get(n, 'string')}" for n in names) + f", path {PATH}"
    return leaves.groupBy("_group", "_block").cogroup(above.groupBy("_group", "_block")).applyInArrow(prove, schema)
