"""Word vectors by skip-gram with negative sampling, trained in blocks of the vocabulary.

Tokens and contexts are dealt to P blocks each. In a round token block i meets context block i + s: the P
pairs of blocks share no vector, so they are trained at the same time by separate tasks, and after P rounds
every token has met every context. No task and no driver holds the whole vocabulary: blocks of more than
PART_TOKENS tokens are cut into as many parts each, which meet in turn in the same way while their blocks do.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.operators.embeddings import counted_numbers, held_by_tasks, in_both_orders
from weftwork.operators.ranking import position
from weftwork.session import discard, materialise

#: Tokens of a block on average; a task holds two blocks of vectors.
BLOCK_TOKENS = 50_000
#: Tokens of a part on average, if a block is asked to hold more.
PART_TOKENS = 100_000
#: Exponent of a token's frequency among the sampled contexts.
NOISE = 0.75


@dataclass(frozen=True)
class Training:
    """size: numbers of a vector; epochs: times that all pairs of blocks meet; passes: passes over a pair of blocks
    while it is in memory; negatives: sampled contexts per observed one; batch: pairs per step."""

    size: int = 50
    epochs: int = 5
    passes: int = 4
    negatives: int = 5
    rate: float = 0.25
    batch: int = 2048
    seed: int = 42


def sampling_table(pairs: DataFrame) -> DataFrame:
    """(token, n, share): observed pairs of every token, and its share of the sampled contexts (n to the power NOISE)."""
    counted = materialise(pairs.groupBy("token").agg(F.sum("n").alias("n")), "pair-counts")
    noise = F.pow(F.col("n").cast("double"), F.lit(NOISE))
    total = counted.agg(F.sum(noise)).scalar()
    return counted.select("token", "n", (noise / total).alias("share"))


def _block(token: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), token), F.lit(blocks)).cast("int")


def _start(size: int, seed: int) -> Column:
    """Small numbers from the hash of the token and the place."""
    draw = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda k: F.pmod(F.xxhash64(F.lit(seed), "token", k), F.lit(1 << 24)))
    return F.transform(draw, lambda d: ((d / float(1 << 24) - 0.5) / size).cast("float"))


def step(vectors: np.ndarray, seen: np.ndarray, rows: np.ndarray, gradient: np.ndarray, rate: float) -> None:
    """Moves the rows against their summed gradients; a row's rate falls with what it has seen (in place)."""
    order = np.argsort(rows, kind="stable")
    lined = rows.take(order)
    starts = np.flatnonzero(np.diff(lined, prepend=-1))
    lengths = np.diff(starts, append=len(lined))
    summed, which = gradient.take(order.take(starts), axis=0), lined.take(starts)
    # Most rows stand alone in a batch; only the others are summed.
    many = np.flatnonzero(lengths > 1)
    if len(many):
        sizes = lengths[many]
        ends = np.cumsum(sizes)
        places = np.repeat(starts[many] - (ends - sizes), sizes) + np.arange(ends[-1])
        summed[many] = np.add.reduceat(gradient.take(order.take(places), axis=0), ends - sizes, axis=0)
    now = seen.take(which) + (summed**2).mean(axis=1)
    seen[which] = now
    summed *= rate
    summed /= np.sqrt(now + 1e-12)[:, None]
    vectors[which] = vectors.take(which, axis=0) - summed


def train_block(
    tokens: np.ndarray, contexts: np.ndarray, token_seen: np.ndarray, context_seen: np.ndarray, pairs: np.ndarray, pushes: np.ndarray,
    shares: np.ndarray, training: Training, seed: list[int],
) -> None:
    """One pass over a pair of blocks, in place: pairs(token, context, n) draw together, sampled contexts are pushed away.

    pushes is the expected number of sampled contexts of every token in this block, shares the contexts' odds.
    """
    draw = np.random.default_rng(seed)
    sampled = draw.choice(len(shares), (len(tokens), 2 * training.negatives), p=shares / shares.sum())
    own = np.repeat(np.arange(len(tokens)), sampled.shape[1])
    weight = np.repeat(pushes / sampled.shape[1], sampled.shape[1])
    rows = np.concatenate([pairs[:, 0], own])
    columns = np.concatenate([pairs[:, 1], sampled.ravel()])
    wanted = np.concatenate([np.ones(len(pairs)), np.zeros(len(own))])
    weights = np.concatenate([pairs[:, 2], weight])
    order = draw.permutation(len(rows))
    for start in range(0, len(order), training.batch):
        part = order[start:start + training.batch]
        r, c = rows.take(part), columns.take(part)
        x, y = tokens.take(r, axis=0), contexts.take(c, axis=0)
        error = 1 / (1 + np.exp(-np.clip((x * y).sum(axis=1), -30, 30))) - wanted.take(part)
        error = (error * weights.take(part))[:, None]
        step(tokens, token_seen, r, error * y, training.rate)
        step(contexts, context_seen, c, error * x, training.rate)


def _further(block: Column, shift: int, turn: int, blocks: int, parts: int) -> Column:
    """The number of the part `turn` further on in the block `shift` further on."""
    own, part = F.floor(block / parts), F.pmod(block, F.lit(parts))
    return (F.pmod(own + shift, F.lit(blocks)) * parts + F.pmod(part + turn, F.lit(parts))).cast("int")


def round_of_blocks(
    vectors: DataFrame, pairs: DataFrame, shift: int, blocks: int, number: int, training: Training, turn: int = 0, parts: int = 1
) -> DataFrame:
    """vectors after every token block has met the context block `shift` further on; pairs as in placed().

    Of blocks in parts, each part has met the one `turn` further on.
    """
    lane = F.when(F.col("side") == "token", F.col("block")).otherwise(_further(F.col("block"), -shift, -turn, blocks, parts)).cast("int")
    met = pairs.filter(F.col("meeting") == shift * parts + turn).select("token_block", "token_place", "context_place", "n")

    def train(held: pd.DataFrame, observed: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(["side", "place"], ignore_index=True)
        sides = {name: rows.reset_index(drop=True) for name, rows in held.groupby("side")}
        if len(sides) < 2:
            return held.drop(columns="lane")
        tokens, contexts = sides["token"], sides["context"]
        matrix = {name: np.stack(rows["vec"].to_numpy()).astype(np.float64) for name, rows in sides.items()}
        seen = {name: rows["seen"].to_numpy(np.float64).copy() for name, rows in sides.items()}
        places = np.column_stack([observed[c].to_numpy(np.int64) for c in ("token_place", "context_place", "n")])
        places = places[np.argsort(places[:, 0] * len(contexts) + places[:, 1])]
        shares = contexts["share"].to_numpy(np.float64)
        pushes = training.negatives * tokens["n"].to_numpy(np.float64) * shares.sum()
        for turn in range(training.passes):
            train_block(
                matrix["token"], matrix["context"], seen["token"], seen["context"], places, pushes, shares, training,
                [training.seed, number, int(held["lane"].iloc[0]), turn],
            )
        for name, rows in sides.items():
            rows["vec"], rows["seen"] = list(matrix[name].astype(np.float32)), seen[name]
        return pd.concat([tokens, contexts]).drop(columns="lane")

    keyed = vectors.withColumn("lane", lane)
    return keyed.groupBy("lane").cogroup(met.groupBy("token_block")).applyInPandas(train, vectors.schema)


def placed(table: DataFrame, pairs: DataFrame, blocks: int, parts: int = 1, key: str = "token") -> tuple[DataFrame, DataFrame]:
    """table with every token's block and its place in the block's order by name, and pairs by these numbers, written.

    Tasks of the training so see numbers only: names are compared and looked up here, once. pairs hold the key of both
    tokens. With parts, block is the number of a part, those of one block standing together; meeting is the round of
    an epoch in which two of them meet, and every file of the pairs is sorted by it.
    """
    part = F.pmod(F.xxhash64(F.lit("part"), "token"), F.lit(parts)).cast("int")
    dealt = table.withColumn("block", _block(F.col("token"), blocks) * parts + part)
    table = materialise(position(dealt, ["block"], [F.col("token").asc()], "place").withColumn("place", F.col("place").cast("int")), "places")
    for side in ("token", "context"):
        numbers = table.select(F.col(key).alias(side), F.col("block").alias(f"{side}_block"), F.col("place").alias(f"{side}_place"))
        pairs = pairs.join(held_by_tasks(numbers), side)
    one, other = F.col("token_block"), F.col("context_block")
    shift = F.pmod(F.floor(other / parts) - F.floor(one / parts), F.lit(blocks))
    meeting = shift * parts + F.pmod(F.pmod(other, F.lit(parts)) - F.pmod(one, F.lit(parts)), F.lit(parts))
    columns = ["token_block", "token_place", "context_block", "context_place", "n", meeting.cast("int").alias("meeting")]
    return table, materialise(pairs.select(*columns).sortWithinPartitions("meeting"), "block-pairs")


def train_skipgram(
    df: DataFrame, tokens: str, window: int = 5, min_count: int = 2, training: Training = Training(), blocks: int | None = None
) -> DataFrame:
    """(token, vec) of all tokens with at least min_count occurrences and one neighbour, from an array column.

    Observed pairs are counted once (as in cooccurrences) and trained on with their counts; a token's vector and
    the order of training depend on hashes alone, not on how df is partitioned. blocks is the number P of
    blocks, by default as many as keep BLOCK_TOKENS tokens in each; fewer are trained in parts where they hold
    more than PART_TOKENS. NULL and empty arrays have no pairs.
    """
    vocabulary, once = counted_numbers(df, tokens, window, min_count)
    pairs = in_both_orders(materialise(once, "pairs")).withColumnsRenamed({"a": "token", "b": "context"})
    counted = sampling_table(pairs).withColumnRenamed("token", "number")
    table = materialise(counted.join(vocabulary, "number"), "sampling-table")
    n_tokens = table.count()
    if blocks is None:
        blocks = max(1, math.ceil(n_tokens / BLOCK_TOKENS))
    parts = max(1, math.ceil(n_tokens / blocks / PART_TOKENS))
    table, pairs = placed(table, pairs, blocks, parts, "number")
    both = table.select("token", "n", "share", "block", "place", F.lit(0.0).alias("seen"))
    zero = F.transform(F.sequence(F.lit(1), F.lit(training.size)), lambda k: F.lit(0.0).cast("float"))
    vectors = both.withColumn("side", F.lit("token")).withColumn("vec", _start(training.size, training.seed)).unionByName(
        both.withColumn("side", F.lit("context")).withColumn("vec", zero)
    )
    vectors = materialise(vectors, "vectors")
    for epoch in range(training.epochs):
        for meeting in range(blocks * parts):
            shift, turn = divmod(meeting, parts)
            trained = round_of_blocks(vectors, pairs, shift, blocks, epoch * blocks * parts + meeting, training, turn, parts)
            before, vectors = vectors, materialise(trained, "vectors")
            discard(before)
    return vectors.filter("side = 'token'").select("token", "vec")
