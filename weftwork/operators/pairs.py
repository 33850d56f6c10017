"""Pairs of owners that share items: exact, pruned by a similarity bound, split where a key is hot.

Rows are (owner, item, weight): users and their neighbours, documents and their terms.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.operators.ranking import position
from weftwork.session import discard, materialise

BLOCK_ROWS = 4096
#: Meetings that one task sums up; the number of tasks grows with the meetings.
MEETINGS_PER_TASK = 2_000_000
#: Meetings whose lists one task writes out, as a multiple of that.
_LISTED = 4
#: Rows in a block of owners whose leading rows meet those of another block in one task, and least blocks of many rows.
BLOCK_ELEMENTS = 4_000_000
_LEAST_BLOCKS = 3
_SMALL_ELEMENTS = 200_000
#: Pairs of blocks that meet at a time, so that no more copies of blocks lie on disk at once.
BLOCK_PAIRS = 32
#: Meetings that a task looks at together.
_MEETINGS_AT_ONCE = 2_000_000
_SLACK = 1e-9
_PAIRS_PER_ROW = 128
#: A bounded search is worth while if its leading rows meet so many times less often than all rows.
_BOUND_SAVES = 4


def pairs_within(
    rows: DataFrame, key: str, member: str, carry: Sequence[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(key, left, right, left_<carry>, right_<carry>), each unordered pair of one key's members once.

    A key with more than block_rows rows is cut into blocks by a hash of the member, and every
    pair of blocks is a join key of its own, so no task meets more than about block_rows^2 pairs
    of one key. Pass a written table: it is read three times.
    """
    hot = materialise(
        rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > block_rows)
        .select(key, F.ceil(F.col("_n") / block_rows).cast("int").alias("_blocks")),
        "hot-keys",
    )
    cut = rows.join(hot, key, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    cut = cut.withColumn("_block", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
    one = cut.select(
        key, F.col("_block").alias("_from"),
        F.explode(F.sequence(F.col("_block"), F.col("_blocks") - 1)).alias("_to"),
        F.col(member).alias("_l"), *[F.col(c).alias(f"_l_{c}") for c in carry],
    )
    two = cut.select(
        key, F.explode(F.sequence(F.lit(0), F.col("_block"))).alias("_from"),
        F.col("_block").alias("_to"),
        F.col(member).alias("_r"), *[F.col(c).alias(f"_r_{c}") for c in carry],
    )
    met = one.join(two, [key, "_from", "_to"]).filter(
        (F.col("_from") < F.col("_to")) | (F.col("_l") < F.col("_r"))
    )
    straight = F.col("_l") < F.col("_r")
    carried = []
    for c in carry:
        carried.append(F.when(straight, F.col(f"_l_{c}")).otherwise(F.col(f"_r_{c}")).alias(f"left_{c}"))
        carried.append(F.when(straight, F.col(f"_r_{c}")).otherwise(F.col(f"_l_{c}")).alias(f"right_{c}"))
    return met.select(
        key, F.least("_l", "_r").alias("left"), F.greatest("_l", "_r").alias("right"), *carried
    )


def meetings(rows: DataFrame, key: str) -> tuple[int, float]:
    """(rows, meetings) of a table whose rows meet in pairs at every value of key."""
    per_key = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").cast("double").alias("_n"))
    n, met = per_key.agg(F.sum("_n"), F.sum(F.col("_n") * (F.col("_n") - 1) / 2)).first()
    return int(n or 0), met or 0.0


def pair_totals(
    rows: DataFrame, key: str, member: str, totals: Sequence[Column], carry: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS, keep: Column | None = None,
) -> DataFrame:
    """(left, right, *totals): totals over the keys at which two members meet, left < right.

    totals and keep, which drops meetings before they are summed, read left_<carry> and right_<carry>.

    A member travels once per key, with the list of the later members there, to the task that holds all its
    meetings; they are taken apart and summed only there, so no single meeting is shuffled. The number of
    those tasks follows the number of meetings. Keys with more than block_rows rows are cut into
    blocks as in pairs_within, and a member with more than block_rows keys is dealt to several tasks
    by the hash of the other one. Pass a written table: it is read several times.
    """
    rows = rows.filter(F.col(key).isNotNull() & F.col(member).isNotNull())
    n_rows, met = meetings(rows, key)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # Lists grow with the meetings, so their tasks follow these, too; otherwise they would spill.
    spread = max(cores, math.ceil(n_rows / MEETINGS_PER_TASK), math.ceil(met / (_LISTED * MEETINGS_PER_TASK)))
    fields = [F.col(member).alias("_m"), *[F.col(c).alias(f"_c_{c}") for c in carry]]
    names = ["_m", *[f"_c_{c}" for c in carry]]
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > block_rows)
    hot = materialise(counts.select(key, F.ceil(F.col("_n") / block_rows).cast("int").alias("_blocks")), "hot-keys")
    any_hot = not hot.isEmpty()

    def later(lists: str, others: Callable[[Column], Column]) -> list[Column]:
        return [F.col("_one._m").alias("_l"), *[F.col(f"_one.{c}").alias(f"_l{c}") for c in names[1:]],
                *[others(F.col(f"{lists}.{c}")).alias(f"_r{c}") for c in names]]

    listed = F.sort_array(F.collect_list(F.struct(*fields))).alias("_list")
    cold = rows.join(hot, key, "left_anti") if any_hot else rows
    lists = cold.repartition(spread, key).groupBy(key).agg(listed).filter(F.size("_list") > 1)
    at = F.col("_at") + 2
    routed = lists.select("_list", F.posexplode("_list").alias("_at", "_one")).filter(at <= F.size("_list")).select(
        *later("_list", lambda c: F.slice(c, at, F.size("_list")))
    )
    if any_hot:
        cut = rows.join(hot, key).withColumn("_block", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
        blocks = materialise(cut.groupBy(key, "_block", "_blocks").agg(listed), "hot-blocks")
        every = F.sequence(F.lit(0), F.col("_blocks") - 1)
        one = cut.select(key, F.col("_block").alias("_from"), F.explode(every).alias("_to"), F.struct(*fields).alias("_one"))
        two = blocks.select(key, F.explode(every).alias("_from"), F.col("_block").alias("_to"), "_list")
        crossed = one.join(two, [key, "_from", "_to"]).withColumn("_list", F.filter("_list", lambda x: x["_m"] > F.col("_one._m")))
        routed = routed.unionByName(crossed.filter(F.size("_list") > 0).select(*later("_list", lambda c: c)))

    wide = rows.groupBy(F.col(member).alias("_l")).agg(F.count("*").alias("_n")).filter(F.col("_n") > block_rows)
    wide = materialise(wide.select("_l", F.ceil(F.col("_n") / block_rows).cast("int").alias("_parts")), "wide-members")
    lists, place = [f"_r{c}" for c in names], ["_l"]
    if not wide.isEmpty():
        place = ["_l", "_part"]
        parted = routed.join(wide, "_l").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))

        def here(x: Column) -> Column:
            return F.pmod(F.xxhash64(x["_r_m"]), F.col("_parts")).cast("int") == F.col("_part")

        parted = parted.withColumn("_others", F.filter(F.arrays_zip(*lists), here)).filter(F.size("_others") > 0)
        parted = parted.drop("_parts").withColumns({c: F.col(f"_others.{c}") for c in lists}).drop("_others")
        routed = routed.join(wide, "_l", "left_anti").withColumn("_part", F.lit(0)).unionByName(parted)
    tasks = max(cores, math.ceil(met / MEETINGS_PER_TASK))
    opened = routed.repartition(tasks, *place).select(
        *place, *[F.col(f"_l_c_{c}").alias(f"left_{c}") for c in carry],
        *([F.inline(F.arrays_zip(*lists))] if carry else [F.explode("_r_m").alias("_r_m")]),
    ).withColumnsRenamed({"_l": "left", "_r_m": "right", **{f"_r_c_{c}": f"right_{c}" for c in carry}})
    opened = opened.filter(F.col("left") < F.col("right"))
    if keep is not None:
        opened = opened.filter(keep)
    # Grouped by where the rows lie, too, so that they are not dealt anew.
    one = ["left", "right", *place[1:]]
    return opened.groupBy(*one).agg(*totals).drop("_part") if totals else opened.select(*one).distinct().drop("_part")


def shared_products(rows: DataFrame) -> DataFrame:
    """(left, right, dot, common) of all pairs with a common item."""
    product = F.sum(F.col("left_weight") * F.col("right_weight"))
    return pair_totals(rows, "item", "owner", [product.alias("dot"), F.count("*").alias("common")], ["weight"])


def shared_counts(rows: DataFrame) -> DataFrame:
    """(left, right, common) of all pairs with a common item; no weights travel for it."""
    return pair_totals(rows, "item", "owner", [F.count("*").alias("common")])


def _kept_parts(bound: float, longest: float):
    """Adds kept, how many items of a vector lead: those up to the last band that a partner can first be shared in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, w, band = (batch.column(c) for c in ("at", "w", "band"))
            offsets = at.offsets.to_numpy() - at.offsets[0].as_py()
            bands, weights = band.flatten().to_numpy(), w.flatten().to_numpy()
            kept = np.zeros(len(batch), dtype=np.int64)
            for n, (start, end) in enumerate(zip(offsets[:-1], offsets[1:])):
                # What is left from the start of every band on; it only falls.
                left = np.cumsum((weights[start:end] ** 2)[::-1])[::-1]
                first = np.flatnonzero(np.diff(bands[start:end], prepend=-1))
                enough = np.count_nonzero(np.sqrt(left[first]) * longest >= bound - _SLACK)
                kept[n] = end - start if enough == len(first) else first[enough]
            yield pa.RecordBatch.from_arrays([batch.column("owner"), at, w, pa.array(kept, pa.int32())], ["owner", "at", "w", "kept"])

    return run


def _leading_vectors(rows: DataFrame, bound: float) -> tuple[DataFrame, list[int]]:
    """((owner, at, w, kept), starts): vectors whose first kept items a pair with similarity >= bound must meet at, with the first number of every band.

    Items that several owners have are numbered, rare ones first, and put into bands by frequency. Of the first
    common item of a pair its band tells that neither vector may hold so little from there on that even the
    longest other one cannot make up for it. So an owner keeps its bands up to the last one from which enough is
    left.
    """
    rows = rows.filter(F.col("owner").isNotNull() & F.col("weight").isNotNull())
    used = materialise(rows.groupBy("item").agg(F.count("*").alias("_used")).filter("_used > 1"), "item-counts")
    numbers = position(used, [], [F.col("_used").asc(), F.col("item").asc()], "at")
    numbers = materialise(numbers.select("item", F.col("at").cast("int").alias("at"), F.floor(F.log("_used") * 8).cast("int").alias("band")), "item-numbers")
    starts = [r[0] for r in numbers.groupBy("band").agg(F.min("at").alias("at")).orderBy("at").select("at").collect()]
    listed = F.sort_array(F.collect_list(F.struct("at", F.col("weight").cast("double").alias("w"), "band"))).alias("_v")
    vectors = rows.join(numbers, "item").groupBy("owner").agg(listed)

    def summed(at: Column) -> Column:
        same = F.filter("_v", lambda x: x["at"] == at)
        return F.struct(at.alias("at"), F.aggregate(same, F.lit(0.0), lambda s, x: s + x["w"]).alias("w"), F.get(same, F.lit(0))["band"].alias("band"))

    # An owner that holds an item in several rows holds their sum.
    once = F.array_distinct(F.col("_v.at"))
    vectors = vectors.withColumn("_v", F.when(F.size(once) < F.size("_v"), F.transform(once, summed)).otherwise(F.col("_v")))
    square = F.aggregate("_v", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]).alias("_sq")
    vectors = materialise(vectors.select("owner", "_v", square), "listed")
    longest = math.sqrt(vectors.agg(F.max("_sq")).first()[0] or 0.0)
    able = vectors.filter(F.sqrt("_sq") * longest >= bound - _SLACK)
    kind = rows.schema["owner"].dataType.simpleString()
    parts = able.select(
        "owner", F.col("_v.at").alias("at"), F.col("_v.w").alias("w"), F.col("_v.band").alias("band")
    ).mapInArrow(_kept_parts(bound, longest), f"owner {kind}, at array<int>, w array<double>, kept int")
    leading = materialise(parts, "leading")
    discard(vectors, used, numbers)
    return leading, starts


def _meeting_blocks(bound: float, starts: list[int]):
    """(left, right, dot, common) of the owners of two blocks with dot >= bound; a task gets the blocks of one pair.

    With p the product over the items that both keep, every other common item is beyond the kept part of the
    owner that stops first, so the dot is at most p plus the product of what both hold beyond it. Owners are
    taken one at a time, looked up in an index of the other block, and multiplied out where that may suffice.
    """
    first = np.array(starts, dtype=np.int64)

    def block(parts: list[pa.RecordBatch]) -> tuple:
        def whole(name: str, of=lambda x: x):
            return np.concatenate([of(b.column(name)).to_numpy(zero_copy_only=False) for b in parts])

        names = pa.concat_arrays([b.column("owner") for b in parts])
        at, w = (whole(c, lambda x: x.flatten()) for c in ("at", "w"))
        sizes = np.concatenate([np.diff(b.column("at").offsets.to_numpy()) for b in parts])
        ptr, kept = np.concatenate([[0], np.cumsum(sizes)]), whole("kept")
        row = np.repeat(np.arange(len(sizes)), sizes)
        leads = np.arange(len(at)) - ptr[row] < kept[row]
        band = np.searchsorted(first, at, side="right") - 1
        # The first band not kept of every owner, and the length that it holds from every band on.
        end = np.zeros(len(sizes), dtype=np.int64)
        end[kept > 0] = band[(ptr[:-1] + kept)[kept > 0] - 1] + 1
        held = np.bincount(row * len(first) + band, w * w, minlength=len(sizes) * len(first)).reshape(len(sizes), -1)
        beyond = np.zeros((len(sizes), len(first) + 1))
        beyond[:, :-1] = np.cumsum(held[:, ::-1], axis=1)[:, ::-1]
        return names, at, w, ptr, kept, row[leads], at[leads], w[leads], end, np.sqrt(beyond)

    def pairs_of(one: tuple, two: tuple, same: bool) -> Iterator[tuple]:
        _, at1, w1, ptr1, kept1, *_, end1, beyond1 = one
        _, at2, w2, ptr2, _, rows, leading, weights, end2, beyond2 = two
        n, sizes2 = len(end2), np.diff(ptr2)
        order = np.argsort(leading, kind="stable")
        rows, weights = rows[order], weights[order]
        items, index = np.unique(leading[order], return_index=True)
        index = np.append(index, len(rows))
        # The owner in hand is laid out over the numbers of all items of both blocks.
        every, place = np.unique(np.concatenate([at1, at2]), return_inverse=True)
        place1, place2 = place[:len(at1)], place[len(at1):]
        looked = np.full(len(every), -1)
        looked[np.searchsorted(every, items)] = np.arange(len(items))
        wide, marked = np.zeros(len(every)), np.zeros(len(every), dtype=np.int64)
        for x in range(len(end1)):
            mine = np.arange(ptr1[x], ptr1[x] + kept1[x])
            key = looked[place1[mine]]
            mine, key = mine[key >= 0], key[key >= 0]
            lows = index[key]
            sizes = index[key + 1] - lows
            upto = np.cumsum(sizes)
            p, meets, at = np.zeros(n), np.zeros(n, dtype=bool), 0
            while at < len(mine):
                # As many items as meet at most _MEETINGS_AT_ONCE times, one at least.
                base = upto[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(upto, base + _MEETINGS_AT_ONCE, side="right")))
                size = sizes[at:to]
                where = np.repeat(lows[at:to] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                p += np.bincount(rows[where], weights[where] * np.repeat(w1[mine[at:to]], size), minlength=n)
                meets[rows[where]] = True
                at = to
            # Others lie below the bound: what the first to stop holds beyond its part is too little.
            met = np.flatnonzero(meets)
            if same:
                met = met[met > x]
            stop = np.minimum(end2[met], end1[x])
            found = met[p[met] + beyond1[x, stop] * beyond2[met, stop] >= bound - _SLACK]
            if not len(found):
                continue
            own = slice(ptr1[x], ptr1[x + 1])
            wide[place1[own]], marked[place1[own]] = w1[own], 1
            upto, at = np.cumsum(sizes2[found]), 0
            while at < len(found):
                base = upto[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(upto, base + _MEETINGS_AT_ONCE, side="right")))
                size = sizes2[found[at:to]]
                offsets = np.cumsum(size) - size
                where = np.repeat(ptr2[found[at:to]] - offsets, size) + np.arange(size.sum())
                dot = np.add.reduceat(wide[place2[where]] * w2[where], offsets)
                enough = dot >= bound - _SLACK
                if enough.any():
                    common = np.add.reduceat(marked[place2[where]], offsets)
                    yield np.full(np.count_nonzero(enough), x), found[at:to][enough], dot[enough], common[enough]
                at = to
            wide[place1[own]], marked[place1[own]] = 0.0, 0

    def table(one: tuple, two: tuple, parts: list) -> pa.RecordBatch:
        left, right, dot, common = (np.concatenate(c) for c in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [one[0].take(pa.array(left)), two[0].take(pa.array(right)), pa.array(dot), pa.array(common)], ["left", "right", "dot", "common"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            places = batch.column("place").to_numpy()
            for p in np.unique(places).tolist():
                held.setdefault(p, []).append(batch.filter(pa.array(places == p)))
        for pair in {p // 3 for p in held}:
            # Place 3 p + 2 has the one block of a pair of equal ones.
            same = 3 * pair + 2 in held
            if not same and (3 * pair not in held or 3 * pair + 1 not in held):
                continue
            one = block(held.pop(3 * pair + 2 if same else 3 * pair))
            two = one if same else block(held.pop(3 * pair + 1))
            parts, size = [], 0
            for part in pairs_of(one, two, same):
                parts.append(part)
                size += len(part[0])
                if size > 100_000:
                    yield table(one, two, parts)
                    parts, size = [], 0
            if parts:
                yield table(one, two, parts)

    return run


def few_pairs(rows: DataFrame) -> bool:
    """Whether meeting at every item directly makes at most _PAIRS_PER_ROW pairs per row."""
    n, pairs = meetings(rows, "item")
    return pairs <= _PAIRS_PER_ROW * n


def opened_candidates(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(short, long, n) of candidates(left, right), written: the owner with fewer rows, and their number."""
    sizes = materialise(rows.groupBy("owner").agg(F.count("*").alias("_n")), "owner-counts")
    for side in ("left", "right"):
        named = sizes.select(F.col("owner").alias(side), F.col("_n").alias(f"_n_{side}"))
        candidates = candidates.join(named, side)
    short = F.col("_n_left") <= F.col("_n_right")
    return materialise(candidates.select(
        F.when(short, F.col("left")).otherwise(F.col("right")).alias("short"),
        F.when(short, F.col("right")).otherwise(F.col("left")).alias("long"),
        F.least("_n_left", "_n_right").alias("n"),
    ), "candidates")


def opened_products(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(left, right, dot, common) over all items of opened_candidates."""
    # The shorter vector of a pair is opened and looked up in the longer one.
    opened = rows.select(F.col("owner").alias("short"), "item", F.col("weight").alias("_a"))
    looked = rows.select(F.col("owner").alias("long"), "item", F.col("weight").alias("_b"))
    return candidates.select("short", "long").join(opened, "short").join(looked, ["long", "item"]).groupBy("short", "long").agg(
        F.sum(F.col("_a") * F.col("_b")).alias("dot"), F.count("*").alias("common")
    ).select(F.least("short", "long").alias("left"), F.greatest("short", "long").alias("right"), "dot", "common")


def full_products(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(left, right, dot, common) over all items of the pairs in candidates(left, right)."""
    return opened_products(rows, opened_candidates(rows, candidates))


def bounded_candidates(
    rows: DataFrame, leading: DataFrame, key: str, carry: Sequence[str], keep: Column | None = None
) -> DataFrame | None:
    """opened_candidates of the owners that meet in leading, or None if meeting at every item costs less.

    That is so if the leading rows alone meet about as often, or if so many candidates are left that opening
    them would look up more items than there are meetings.
    """
    whole = meetings(rows, "item")[1]
    if meetings(leading, key)[1] * _BOUND_SAVES > whole:
        return None
    opened = opened_candidates(rows, pair_totals(leading, key, "owner", [], carry, keep=keep))
    looked = opened.agg(F.sum("n")).first()[0] or 0
    return None if looked > whole else opened


def products_at_least(rows: DataFrame, bound: float, counts: bool = False) -> DataFrame:
    """(left, right, dot, common) of vectors of any length with dot >= bound > 0, all of them.

    counts says that every weight is 1, so dot is the number of common items. Items that only one
    owner has are left aside, the others put into bands by frequency, rare ones first. From the first
    band that a pair shares on, neither owner may hold less than the bound (fewer items, or a length
    that even the longest vector cannot make up for): owners meet in those bands only, and what
    they meet at is computed in full. Pass a written table.
    """
    used = rows.groupBy("item").agg(F.count("*").alias("_used")).filter("_used > 1")
    used = materialise(used.select("item", F.floor(F.log("_used") * 8).cast("int").alias("_band")), "item-bands")
    banded = rows.join(used, "item")
    square = F.col("weight").cast("double") * F.col("weight").cast("double")
    mass = materialise(banded.groupBy("owner", "_band").agg(F.sum(square).alias("_sq")), "bands")
    onward = Window.partitionBy("owner").orderBy("_band").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    mass = mass.withColumn("_left", F.sum("_sq").over(onward))
    reach = F.col("_left")
    if not counts:
        longest = mass.agg(F.max("_left")).first()[0] or 0.0
        reach = F.sqrt(F.col("_left") * longest)
    kept = mass.filter(reach >= bound * (1 - _SLACK)).select("owner", "_band")
    leading = materialise(banded.join(kept, ["owner", "_band"]).select("owner", "item"), "leading")
    candidates = pair_totals(leading, "item", "owner", [])
    return full_products(rows, candidates).filter(F.col("dot") >= bound)


def similar_products(rows: DataFrame, bound: float) -> DataFrame | None:
    """(left, right, dot, common), written, of unit vectors with dot >= bound, or None if meeting at every item costs less.

    The vectors are cut into blocks of owners, and every two blocks meet in a task of their own. So neither a
    meeting nor a candidate is shuffled, only the vectors, as often as there are blocks. BLOCK_PAIRS pairs of blocks
    are dealt out at a time, and what was shuffled for them is deleted before the next.
    """
    leading, starts = _leading_vectors(rows, bound)
    met = meetings(leading.select(F.explode(F.slice("at", 1, F.col("kept"))).alias("item")), "item")[1]
    if met * _BOUND_SAVES > meetings(rows, "item")[1]:
        discard(leading)
        return None
    n_rows = leading.agg(F.sum(F.size("at"))).first()[0] or 0
    blocks = max(math.ceil(n_rows / BLOCK_ELEMENTS), _LEAST_BLOCKS if n_rows > _SMALL_ELEMENTS else 1)
    # Blocks a <= b meet as pair b * (b + 1) / 2 + a; a place is a pair and the side on which a vector stands in it.
    n_pairs = blocks * (blocks + 1) // 2
    own = F.pmod(F.xxhash64("owner"), F.lit(blocks))
    others = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))

    def pair(other: Column) -> Column:
        high, low = F.greatest(F.col("_own"), other), F.least(F.col("_own"), other)
        return F.floor(high * (high + 1) / 2 + low)

    kind = rows.schema["owner"].dataType.simpleString()
    side = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
    found = []
    for start in range(0, n_pairs, BLOCK_PAIRS):
        end = min(start + BLOCK_PAIRS, n_pairs)
        here = F.filter(others, lambda x: pair(x).between(start, end - 1))
        dealt = leading.withColumn("_own", own).withColumn("_other", F.explode(here))
        place = ((pair(F.col("_other")) - start) * 3 + side).alias("place")
        met = dealt.select("owner", "at", "w", "kept", place).repartitionById(end - start, F.floor(F.col("place") / 3).cast("int")).mapInArrow(
            _meeting_blocks(bound, starts), f"left {kind}, right {kind}, dot double, common bigint"
        )
        found.append(materialise(met.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"), "dot", "common"), "found"))
    discard(leading)
    return reduce(DataFrame.unionByName, found)


def similar_pairs(rows: DataFrame, bound: float | None) -> DataFrame:
    """(left, right, dot, common) of unit vectors with dot >= bound; all sharing pairs without one.

    Complete for every bound, which only saves work. Pass a written table.
    """
    if bound is None or bound <= 0:
        return shared_products(rows)
    found = similar_products(rows, bound)
    return shared_products(rows).filter(F.col("dot") >= bound - _SLACK) if found is None else found


def equal_owners(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Owners with the same items and weights (9 decimals) as classes.

    Returns classes(owner, size, second), named by the smallest member, and members(class, owner).
    A group of copies thus enters the pair search once. Equality is judged by the number of rows
    and two independent 64-bit hashes, which combine before the shuffle in any order.
    """
    weight = F.round("weight", 9)
    marks = ["_rows", "_h1", "_h2"]
    prints = rows.groupBy("owner").agg(
        F.count("*").alias("_rows"),
        F.bit_xor(F.xxhash64("item", weight)).alias("_h1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "item", weight)).alias("_h2"),
    )
    prints = materialise(prints, "prints")
    # Written, so that AQE can split the mark of a giant class of copies.
    classes = materialise(prints.groupBy(*marks).agg(F.min("owner").alias("class"), F.count("*").alias("size")), "marks")
    members = materialise(prints.join(classes, marks).select("class", "owner", "size"), "members")
    heads = members.groupBy("class").agg(
        F.max("size").alias("size"),
        F.min(F.when(F.col("owner") != F.col("class"), F.col("owner"))).alias("second"),
    )
    return heads.withColumnRenamed("class", "owner"), members.select("class", "owner")


def cosine_classes(rows: DataFrame, bound: float) -> tuple[DataFrame, DataFrame]:
    """All pairs of unit vectors with cosine >= bound, equal vectors taken together.

    Returns pairs(left, right, similarity, left_size, right_size) and members(class, owner). A row
    with left = right stands for the pairs inside one class. The two tables hold the whole
    result without writing out each pair of copies.
    """
    rows = materialise(rows.select("owner", "item", "weight"), "vectors")
    classes, members = equal_owners(rows)
    classes = materialise(classes, "classes")
    heads = materialise(rows.join(classes, "owner", "left_semi"), "heads")
    discard(rows)
    found = similar_pairs(heads, None if few_pairs(heads) else bound)
    across = found.filter(F.col("dot") >= bound - _SLACK).select("left", "right", F.col("dot").alias("similarity"))
    sized = across.join(
        classes.select(F.col("owner").alias("left"), F.col("size").alias("left_size")), "left"
    ).join(classes.select(F.col("owner").alias("right"), F.col("size").alias("right_size")), "right")
    inside = classes.filter(F.col("size") > 1).select(
        F.col("owner").alias("left"), F.col("owner").alias("right"), F.lit(1.0).alias("similarity"),
        F.col("size").alias("left_size"), F.col("size").alias("right_size"),
    )
    columns = ["left", "right", "similarity", "left_size", "right_size"]
    return sized.select(*columns).unionByName(inside), members
