"""Benchmark passages in documents: spaced-seed hashing and checks that tolerate substitutions."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.tables import as_bytes, map_text
from weftwork.session import materialise

#: Token positions that a seed looks at; the positions between them are ignored. Together the three
#: find every run of 13 tokens with up to 2 substitutions (and of 10 to 12 with 2, 8 or 9 with 1).
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
#: Tokens that an overlap is judged on, the least that tolerates substitutions, and the share that must agree.
#: Shorter items are found where all their tokens stand unchanged.
WINDOW, SHORTEST, AGREE = 13, 8, 0.8
#: The filter that keeps documents without any seed out of the join: bits a seed, probes, least and most bits.
#: Beyond the most it lets more documents through to the join, which is exact.
SEED_BITS, FILTER_PROBES, FILTER_LEAST, FILTER_MOST = 1024, 3, 1 << 16, 1 << 28

_WORD = re.compile(r"\w+")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def tokens(text: str | bytes | None) -> list[str]:
    return _WORD.findall(as_bytes(text).decode("utf-8", "replace").lower())


class _TokenHashes(dict):
    """XXH64 of a token; remembers a bounded number of tokens."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[token] = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        return value


def _hashes(token_lists: list[list[str]], known: _TokenHashes) -> np.ndarray:
    total = sum(map(len, token_lists))
    return np.fromiter((known[t] for ts in token_lists for t in ts), np.uint64, total)


def _seeds(hashes: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """The seed of every start position from which the mask fits."""
    n = len(hashes) - mask[-1]
    seed = np.full(max(0, n), number + 1, np.uint64)
    for i, place in enumerate(mask):
        seed = (seed ^ hashes[place:place + n]) * _ODD[i % len(_ODD)] if n > 0 else seed
        seed ^= seed >> np.uint64(29)
    return seed


def _whole(length: int) -> tuple[tuple[int, ...], int]:
    """Mask and number of the seeds that hold all tokens of a short item."""
    return tuple(range(length)), len(MASKS) + length


def _probes(seed: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((seed >> np.uint64(21 * i)) % np.uint64(bits)).astype(np.int64) for i in range(FILTER_PROBES)]


def benchmark_items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """(key, tokens, seeds): one row per distinct token sequence, with its smallest key."""
    kind = benchmark.select(key).schema[0].dataType.simpleString()

    def work(columns: list[list]) -> dict[str, list]:
        known, out = _TokenHashes(), {"item": [], "item_tokens": [], "seeds": []}
        for item, body in zip(*columns):
            hashes = _hashes([tokens(body)], known)
            if not len(hashes):
                continue
            seeds = []
            masks = zip(MASKS, range(len(MASKS))) if len(hashes) >= SHORTEST else [_whole(len(hashes))]
            for mask, number in masks:
                seeds += [
                    {"seed": s, "place": i} for i, s in enumerate(_seeds(hashes, mask, number).view(np.int64).tolist())
                ]
            out["item"].append(item)
            out["item_tokens"].append(hashes.view(np.int64).tolist())
            out["seeds"].append(seeds)
        return out

    rows = map_text(
        benchmark, [F.col(key), F.col(text)], work,
        f"item {kind}, item_tokens array<bigint>, seeds array<struct<seed:bigint,place:int>>",
    )
    return rows.groupBy("item_tokens").agg(F.min("item").alias("item"), F.first("seeds").alias("seeds"))


def _filter(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """(words, bits) of a Bloom filter over all seeds; what reaches the driver is bounded by FILTER_MOST bits."""
    wanted = SEED_BITS * seeds.select("seed").distinct().count()
    size = min(FILTER_MOST, max(FILTER_LEAST, 1 << wanted.bit_length()))
    value = F.col("seed")
    bits = F.array(*[F.pmod(F.shiftrightunsigned(value, 21 * i), F.lit(size)) for i in range(FILTER_PROBES)])
    words = seeds.select(F.explode(bits).alias("bit")).groupBy(F.shiftright("bit", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit % 32 AS INT))")).alias("bits")
    ).toPandas()
    packed = np.zeros(size // 32, np.uint32)
    packed[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return packed, size


def _candidates(
    docs: DataFrame, key: str, text: str, packed: np.ndarray, size: int, lengths: list[int]
) -> DataFrame:
    """(key, doc_tokens, hits(seed, at, whole)) of documents with a seed that the filter knows; lengths are those of
    short items. A seed that holds a whole short item is told once a document, at its first place."""
    masks = [(mask, number, False) for number, mask in enumerate(MASKS)] + [(*_whole(n), True) for n in lengths]
    kind = docs.select(key).schema[0].dataType.simpleString()

    def work(columns: list[list]) -> dict[str, list]:
        known = _state.setdefault("known", _TokenHashes())
        out: dict[str, list] = {key: [], "doc_tokens": [], "hits": []}
        keys, bodies = columns
        start = 0
        while start < len(bodies):
            lists, end, held = [], start, 0
            while end < len(bodies) and (held < 200_000 or end == start):
                lists.append(tokens(bodies[end]))
                held += len(lists[-1])
                end += 1
            hashes = _hashes(lists, known)
            first = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
            doc_of = np.repeat(np.arange(len(lists)), np.diff(first))
            at, seeds, wholes = [], [], []
            for mask, number, whole in masks:
                seed = _seeds(hashes, mask, number)
                if not len(seed):
                    continue
                hit = np.ones(len(seed), bool)
                for probe in _probes(seed, size):
                    hit &= (packed[probe >> 5] >> (probe & 31).astype(np.uint32)) & 1 == 1
                places = np.flatnonzero(hit)
                places = places[doc_of[places] == doc_of[places + mask[-1]]]
                if whole and len(places):
                    owners = np.rec.fromarrays([doc_of[places], seed[places]])
                    places = places[np.unique(owners, return_index=True)[1]]
                at.append(places)
                seeds.append(seed[places].view(np.int64))
                wholes.append(np.full(len(places), whole))
            at, seeds, wholes = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (at, seeds, wholes))
            order = np.argsort(at, kind="stable")
            at, seeds, wholes = at[order], seeds[order], wholes[order].astype(bool)
            for d in np.unique(doc_of[at]).tolist():
                a, b = np.searchsorted(at, [first[d], first[d + 1]])
                out[key].append(keys[start + d])
                out["doc_tokens"].append(hashes[first[d]:first[d + 1]].view(np.int64) if not wholes[a:b].all() else [])
                out["hits"].append([
                    {"seed": s, "at": p, "whole": w}
                    for s, p, w in zip(seeds[a:b].tolist(), (at[a:b] - first[d]).tolist(), wholes[a:b].tolist())
                ])
            start = end
        return out

    _state: dict = {}
    return map_text(
        docs, [F.col(key), F.col(text)], work,
        f"`{key}` {kind}, doc_tokens array<bigint>, hits array<struct<seed:bigint,at:int,whole:boolean>>",
    )


def overlap(same: np.ndarray) -> tuple[int, int, int] | None:
    """(start, length, agreeing) of the stretch covered by windows that agree well enough, if any.

    same tells for aligned tokens whether they are equal. A window has WINDOW tokens, or all of a
    shorter alignment that has SHORTEST at least.
    """
    width = min(WINDOW, len(same))
    if width < SHORTEST:
        return None
    sums = np.concatenate(([0], np.cumsum(same)))
    good = np.flatnonzero(sums[width:] - sums[:-width] >= AGREE * width - 1e-9)
    if not len(good):
        return None
    covered = np.zeros(len(same), bool)
    for start in good.tolist():
        covered[start:start + width] = True
    first = int(np.argmax(covered))
    last = len(covered) - int(np.argmax(covered[::-1]))
    return first, last - first, int(same[first:last].sum())


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, item_key, doc_start, item_start, n_tokens, n_same, share): documents with benchmark passages.

    Tokens are lower-cased runs of word characters. A document matches an item if, aligned at a common
    seed, some WINDOW tokens of the item (all of an item or alignment shorter than that) agree in AGREE
    of their places; starts and lengths tell the stretch with most equal tokens, share the part of the
    item that agrees. Items with the same tokens count as the one with the smallest key; items of fewer
    than SHORTEST tokens, NULL or empty ones are not searched for. NULL or empty documents match
    nothing; of repeated rows one result row per key and item stays; further columns are not looked at.
    """
    items = materialise(benchmark_items(benchmark, item_key, item_text), "items")
    seeds = materialise(items.select("item", F.inline("seeds")).distinct(), "seeds")
    sizes = items.select(F.size("item_tokens").alias("n")).filter(F.col("n") < SHORTEST).distinct().collect()
    found = _candidates(docs, key, text, *_filter(seeds), sorted(r["n"] for r in sizes))
    found = materialise(found.withColumn("row", F.monotonically_increasing_id()), "candidates")
    met = found.select("row", F.col(key).alias("_key"), F.inline("hits")).join(seeds, "seed")
    hits = met.filter(~F.col("whole")).select("row", "item", (F.col("at") - F.col("place")).alias("shift")).distinct()
    hits = materialise(hits, "hits")
    # The seed of a short item holds all its tokens: nothing is left to check.
    short = met.filter("whole").join(items.select("item", F.size("item_tokens").alias("n")), "item").select(
        "_key", "item", F.col("at").alias("doc_start"), F.lit(0).alias("item_start"), F.col("n").alias("n_tokens"),
        F.col("n").alias("n_same"), F.lit(1.0).alias("share"),
    )
    lined = hits.join(found.select("row", F.col(key).alias("_key"), "doc_tokens"), "row").join(
        items.select("item", "item_tokens"), "item"
    )
    skip = F.greatest(F.lit(0), -F.col("shift"))
    begin = F.greatest(F.lit(0), F.col("shift"))
    room = F.least(F.size("item_tokens") - skip, F.size("doc_tokens") - begin)
    aligned = lined.select(
        "_key", "item", begin.alias("begin"), skip.alias("skip"), F.size("item_tokens").alias("size"),
        F.arrays_zip(
            F.slice("doc_tokens", begin + 1, room).alias("d"), F.slice("item_tokens", skip + 1, room).alias("i")
        ).alias("pairs"),
    ).withColumn("same", F.transform("pairs", lambda p: p["d"] == p["i"])).drop("pairs")
    key_type = docs.select(key).schema[0].dataType.simpleString()
    item_type = benchmark.select(item_key).schema[0].dataType.simpleString()

    def check(parts):
        for part in parts:
            rows = []
            for k, item, begin_at, skip_at, size, same in zip(*[part[c] for c in part.columns]):
                kept = overlap(np.asarray(same, bool))
                if kept:
                    rows.append((k, item, begin_at + kept[0], skip_at + kept[0], kept[1], kept[2], kept[2] / size))
            yield pd.DataFrame(rows, columns=["_key", "item", "doc_start", "item_start", "n_tokens", "n_same", "share"])

    checked = aligned.mapInPandas(
        check, f"_key {key_type}, item {item_type}, doc_start int, item_start int, n_tokens int, n_same int, share double"
    )
    best = F.max(F.struct(
        "n_same", "share", (-F.col("doc_start")).alias("_d"), (-F.col("item_start")).alias("_i"), "n_tokens"
    )).alias("best")
    return checked.unionByName(short).groupBy("_key", "item").agg(best).select(
        F.col("_key").alias(key), F.col("item").alias(item_key), (-F.col("best._d")).alias("doc_start"),
        (-F.col("best._i")).alias("item_start"), "best.n_tokens", "best.n_same", "best.share",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **names: str) -> DataFrame:
    """Rows of docs whose key matches no benchmark item; rows without a key stay."""
    hit = materialise(contaminated(docs, benchmark, key, **names).select(F.col(key).alias("_hit")).distinct(), "hit_keys")
    return docs.join(hit, F.col(key) == F.col("_hit"), "left_anti")
