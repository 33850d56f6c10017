"""Near duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.tables import as_bytes, map_text
from weftwork.operators.graph import connected_components
from weftwork.session import materialise

SEED = 42
BITS = 64
#: Fingerprints that are compared with each other inside one task at most.
BLOCK = 8192


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | bytes | None, shingle: int = 4) -> int:
    """The 64 bits that more than half of the shingles' XXH64 values have set.

    A-Z are lower-cased, words end at ASCII white space; with fewer words than a shingle the whole
    sequence is hashed, and without words (NULL, empty) the fingerprint is 0.
    """
    words = as_bytes(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    count = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65536):  # a very long text is unpacked piece by piece
        part = hashes[i:i + 65536]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * count > len(hashes), bitorder="little")
    return int(set_bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = 4) -> DataFrame:
    """(key, code): the fingerprint of every row as a signed 64-bit number."""
    kind = docs.select(key).schema[0].dataType.simpleString()

    def work(columns: list[list]) -> dict[str, list]:
        codes = [fingerprint(t, shingle) for t in columns[1]]
        return {key: columns[0], "code": [c - (1 << 64) if c >> 63 else c for c in codes]}

    return map_text(docs, [F.col(key), F.col(text)], work, f"`{key}` {kind}, code long")


# ---------------------------------------------------------------- multi-index search

def segments(distance: int, parts: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of every segment.

    Radii sum to distance - parts + 1: if every segment differed by more than its radius, the whole
    would differ by at least distance + 1 bits. So codes within the distance agree in one segment up
    to its radius.
    """
    if not 1 <= parts <= distance + 1:
        raise ValueError("parts must lie between 1 and distance + 1")
    spare, found, first = distance - parts + 1, [], 0
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        found.append((first, width, spare // parts + (i < spare % parts)))
        first += width
    return found


def _ball(width: int, radius: int) -> list[int]:
    """Masks of 1 to radius bits within a segment."""
    return [
        sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(range(width), r)
    ]


def index_rows(codes: DataFrame, distance: int, parts: int) -> DataFrame:
    """(segment, value, code, home): home rows hold a code's own segment value, the others the values
    in the Hamming ball around it."""
    plan = segments(distance, parts)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            code = batch["code"].to_numpy(np.int64)
            for number, (first, width, radius) in enumerate(plan):
                own = (code.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << width) - 1)
                for mask in [0, *_ball(width, radius)]:
                    yield pd.DataFrame({
                        "segment": np.full(len(code), number, np.int32),
                        "value": (own ^ np.uint64(mask)).view(np.int64), "code": code,
                        "home": np.full(len(code), mask == 0),
                    })

    return codes.select("code").mapInPandas(work, "segment int, value long, code long, home boolean")


def heavy_values(codes: DataFrame, distance: int, parts: int, block: int) -> DataFrame:
    """(segment, value, blocks) for index values that may hold over block rows.

    Counted from the codes' own values alone: the rows at a value are the codes whose own value lies
    in the ball around it. Values with few codes add at most block / 2 in sum, the others are counted.
    """
    plan = segments(distance, parts)
    widest = max(len(_ball(w, r)) for _, w, r in plan) + 1
    own = F.array(*[
        F.struct(
            F.lit(i).alias("segment"),
            F.shiftrightunsigned("code", first).bitwiseAND((1 << width) - 1).alias("value"),
        )
        for i, (first, width, _) in enumerate(plan)
    ])
    counts = codes.select(F.inline(own)).groupBy("segment", "value").agg(F.count("*").alias("n"))
    full = materialise(counts.filter(F.col("n") > block / (2 * widest)), "full")
    balls = F.array(*[
        F.array(*[F.lit(m).cast("long") for m in [0, *_ball(width, radius)]]) for _, width, radius in plan
    ])
    near = full.select(
        "segment", F.explode(F.element_at(balls, F.col("segment") + 1)).alias("mask"), "value", "n"
    ).select("segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value"), "n")
    load = near.groupBy("segment", "value").agg((F.sum("n") + block / 2).alias("load"))
    return load.filter(F.col("load") > block).select(
        "segment", "value", F.ceil(F.col("load") / block).cast("int").alias("blocks")
    )


def _forest(codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all codes that are connected by links within the distance.

    Every code is compared with those not yet reached, so a group of near copies costs one pass.
    """
    left, ends = codes, []
    while len(left) > 1:
        open_ends, left = [left[0]], left[1:]
        while open_ends and len(left):
            one = open_ends.pop()
            near = np.bitwise_count(left ^ one) <= distance
            if near.any():
                reached = left[near]
                ends.append((np.full(len(reached), one), reached))
                open_ends.extend(reached)
                left = left[~near]
    if not ends:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate([a for a, _ in ends]), np.concatenate([b for _, b in ends])


def _links_in_runs(run: np.ndarray, code: np.ndarray, home: np.ndarray, distance: int, small: int = 24):
    """Links inside runs of equal index value; rows of a run are adjacent."""
    bounds = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1], [True])))
    first, size = bounds[:-1], np.diff(bounds)
    homes = np.add.reduceat(home.astype(np.int64), first)
    kept = (size > 1) & (homes > 0)
    found = []
    # Small runs: every home row against every row of its run, all runs at once.
    few = kept & (size <= small)
    run_of = np.repeat(np.arange(len(size)), size)
    anchors = np.flatnonzero(home & few[run_of])
    if len(anchors):
        lengths = size[run_of[anchors]]
        left = np.repeat(anchors, lengths)
        offset = np.arange(len(left)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        right = first[run_of[left]] + offset
        a, b = code[left], code[right]
        near = (a != b) & (np.bitwise_count(a ^ b) <= distance)
        found.append((a[near], b[near]))
    for i in np.flatnonzero(kept & (size > small)):
        found.append(_forest(np.unique(code[first[i]:first[i] + size[i]]), distance))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def code_links(codes: DataFrame, distance: int = 4, parts: int = 3, block: int = BLOCK) -> DataFrame:
    """(src, dst): links between different codes that join all codes within the distance.

    codes(code) holds each code once. Codes meet at the index values of their segments; a value with
    over block rows is cut into blocks, and every pair of its blocks is compared in a task of its own.
    Each link is a pair within the distance; of a dense group only enough links to join it are
    written, not all pairs.
    """
    rows = index_rows(codes, distance, parts)
    heavy = materialise(heavy_values(codes, distance, parts, block), "heavy")
    rows = rows.join(heavy, ["segment", "value"], "left")
    n = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("code", F.lit(1)), n).cast("int")
    cells = F.when(n == 1, F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda j: F.struct(F.least(mine, j).alias("a"), F.greatest(mine, j).alias("b")),
        )
    )
    rows = rows.select("segment", "value", "code", "home", F.inline(cells)).select(
        F.xxhash64("segment", "value", "a", "b").alias("cell"), "code", "home"
    )
    shuffles = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(shuffles, "cell").sortWithinPartitions("cell")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the cell that the last batch ended in
        for batch in batches:
            cut = int(batch["cell"].searchsorted(batch["cell"].iloc[-1])) if len(batch) else 0
            if cut == 0 and held and len(batch) and held[-1]["cell"].iloc[-1] == batch["cell"].iloc[0]:
                held.append(batch)
                continue
            yield link(pd.concat([*held, batch.iloc[:cut]]))
            held = [batch.iloc[cut:]]
        if held:
            yield link(pd.concat(held))

    def link(part: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return pd.DataFrame({"src": np.empty(0, np.int64), "dst": np.empty(0, np.int64)})
        a, b = _links_in_runs(
            part["cell"].to_numpy(), part["code"].to_numpy(np.int64).view(np.uint64), part["home"].to_numpy(bool), distance
        )
        return pd.DataFrame({"src": a.view(np.int64), "dst": b.view(np.int64)})

    return dealt.mapInPandas(work, "src long, dst long")


# ---------------------------------------------------------------- groups

def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, parts: int = 3
) -> DataFrame:
    """(key, code, component): component is the smallest key that links reach, NULL only if all are NULL.

    Rows with the same fingerprint are one node; NULL and empty texts share fingerprint 0 and are
    linked like any other. Repeated rows stay; further columns are not looked at.
    """
    marked = materialise(fingerprints(docs, key, text, shingle), "fingerprints")
    nodes = materialise(marked.groupBy("code").agg(F.min(key).alias("_least")), "codes")
    links = materialise(code_links(nodes, distance, parts), "code_links")
    groups = materialise(
        connected_components(nodes.select(F.col("code").alias("id")), links).select(
            F.col("id").alias("code"), F.col("component").alias("_group")
        ),
        "code_groups",
    )
    least = materialise(
        groups.join(nodes, "code").groupBy("_group").agg(F.min("_least").alias("component")), "group_least"
    )
    of_code = materialise(groups.join(least, "_group").select("code", "component"), "code_components")
    return marked.join(of_code, "code").select(key, "code", "component")


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, parts: int = 3
) -> DataFrame:
    """Rows of docs, one of each group of near duplicates: the one with the smallest key.

    Of repeated rows with one key one stays. Rows without a key stay, as nothing can name them.
    """
    groups = near_duplicates(docs, key, text, shingle, distance, parts)
    dropped = materialise(
        groups.filter(F.col(key) != F.col("component")).select(F.col(key).alias("_dropped")).distinct(), "dropped"
    )
    kept = docs.join(dropped, F.col(key) == F.col("_dropped"), "left_anti")
    repeated = materialise(
        docs.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_again")).agg(F.count("*").alias("n")).filter("n > 1").select("_again"),
        "repeated",
    )
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, F.col(key) == F.col("_again"), "left_anti")
    return once.unionByName(kept.join(repeated, F.col(key) == F.col("_again"), "left_semi").dropDuplicates([key]))
