"""Word vectors: a table (token, vec array<float>), computed in double precision."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, DoubleType, StringType

from weftwork.operators.ranking import position, top_rows
from weftwork.session import discard, materialise

#: Query vectors that one scan of a model serves.
QUERIES_AT_ONCE = 1000
#: Occurrences whose neighbours one task counts.
TOKENS_PER_TASK = 1_000_000
#: Bytes of a vocabulary that tasks hold as a whole.
VOCABULARY_BYTES = 128_000_000
#: Rows of a table by token that tasks may hold to join it.
BROADCAST_ROWS = 2_000_000
#: Pairs that a task counts before it passes them on, and rows that it hands on together.
_PAIRS_AT_ONCE = 8_000_000
_ROWS_AT_ONCE = 100_000
#: Cells of a table that one block of a factorisation holds, and its least blocks. A task that builds a block has its
#: cells about five times in memory (as received, gathered, sorted and written), 12 bytes each.
CELLS_PER_BLOCK = 4_000_000
_LEAST_BLOCKS = 10


class UnknownTokens(KeyError):
    """Tokens without a vector."""


def model_size(model: DataFrame) -> DataFrame:
    """One row (n_tokens, dimension)."""
    return model.agg(F.count("*").alias("n_tokens"), F.max(F.size("vec")).alias("dimension"))


def lookup(model: DataFrame, tokens: list) -> DataFrame:
    """(token, vec) of the requested tokens; an unknown one is an error."""
    kind = model.schema["token"].dataType
    wanted = model.sparkSession.createDataFrame([(t,) for t in set(tokens)], StructType([StructField("token", kind)]))
    found = model.join(wanted, "token", "left_semi")
    known = {row["token"] for row in found.select("token").collect()}
    if missing := sorted(set(tokens) - known):
        raise UnknownTokens(missing)
    return found


def dot(a: Column, b: Column) -> Column:
    """Scalar product of two arrays in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)


def cosine(a: Column, b: Column) -> Column:
    """Cosine, NULL for a zero vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def pair_similarities(model: DataFrame, pairs: DataFrame) -> DataFrame:
    """(token1, token2, similarity) for a table of token pairs of any length."""
    first = model.select(F.col("token").alias("token1"), F.col("vec").alias("_a"))
    second = model.select(F.col("token").alias("token2"), F.col("vec").alias("_b"))
    return pairs.join(first, "token1").join(second, "token2").select(
        "token1", "token2", cosine(F.col("_a"), F.col("_b")).alias("similarity")
    )


def compare_models(words: list, models: dict[str, DataFrame]) -> DataFrame:
    """(model, word1, word2, similarity): all ordered pairs of a few words in every model."""
    result = None
    for name, model in models.items():
        found = lookup(model, words).select("token", "vec")
        grid = found.select(
            F.col("token").alias("word1"), F.col("vec").alias("_a"),
            F.explode(F.array(*[F.lit(w) for w in words])).alias("word2"),
        )
        part = grid.join(found.select(F.col("token").alias("word2"), F.col("vec").alias("_b")), "word2")
        part = part.select(
            F.lit(name).alias("model"), "word1", "word2", cosine(F.col("_a"), F.col("_b")).alias("similarity")
        )
        result = part if result is None else result.unionByName(part)
    return result


def _best_in_batch(names: list[str], queries: np.ndarray, n: int, token: str):
    """The n best rows of each Arrow batch for every query, by one matrix product."""
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            vectors = np.stack(batch["vec"].to_numpy()).astype(np.float64)
            lengths = np.linalg.norm(vectors, axis=1)
            lengths[lengths == 0] = np.nan
            similar = (vectors @ unit.T) / lengths[:, None]
            for k, name in enumerate(names):
                column = similar[:, k]
                usable = np.flatnonzero(~np.isnan(column))
                if len(usable) > n:
                    # Keep all rows that tie with the n-th best, so that the token decides later.
                    cut = np.partition(column[usable], len(usable) - n)[len(usable) - n]
                    usable = usable[column[usable] >= cut - 1e-8]
                yield pd.DataFrame(
                    {"query": name, token: batch[token].to_numpy()[usable], "similarity": column[usable]}
                )

    return run


def nearest(
    model: DataFrame, queries: dict[str, list[float]], n: int = 10, exclude: dict[str, list] | None = None
) -> DataFrame:
    """(query, token, similarity, rank) of the n tokens nearest to each of a few query vectors.

    One scan of the model per QUERIES_AT_ONCE; every batch hands on its own best rows only. Raw query vectors do not
    leave out their inputs, exclude lists tokens to leave out per query.
    """
    names = list(queries)
    if len(names) > QUERIES_AT_ONCE:
        parts = [names[i:i + QUERIES_AT_ONCE] for i in range(0, len(names), QUERIES_AT_ONCE)]
        found = [
            nearest(model, {q: queries[q] for q in part}, n, {q: v for q, v in (exclude or {}).items() if q in set(part)})
            for part in parts
        ]
        return reduce(DataFrame.unionByName, found)
    kind = model.schema["token"].dataType
    schema = StructType(
        [StructField("query", StringType()), StructField("token", kind), StructField("similarity", DoubleType())]
    )
    widest = max((len(v) for v in (exclude or {}).values()), default=0)
    kernel = _best_in_batch(names, np.array([queries[q] for q in names], dtype=np.float64), n + widest, "token")
    found = model.select("token", "vec").filter(F.size("vec") > 0).mapInPandas(kernel, schema)
    for query, tokens in (exclude or {}).items():
        found = found.filter(~((F.col("query") == query) & F.col("token").isin(list(tokens))))
    return top_rows(found, n, ["query"], [F.round("similarity", 9).desc(), F.col("token").asc()], "rank")


def vectors_of(model: DataFrame, tokens: list) -> dict:
    """Vectors of a few tokens as Python lists."""
    return {row["token"]: [float(x) for x in row["vec"]] for row in lookup(model, tokens).collect()}


def similar_to(model: DataFrame, token, n: int = 10, exclude_input: bool = True) -> DataFrame:
    vec = vectors_of(model, [token])[token]
    return nearest(model, {str(token): vec}, n, {str(token): [token]} if exclude_input else None)


def vector_arithmetic(model: DataFrame, word1, word2, target, n: int = 50) -> DataFrame:
    """Neighbours of word1 - word2 ("difference") and of word1 - word2 + target ("analogy").

    The raw vectors are combined, not their unit vectors, and inputs stay in the result.
    """
    v = {t: np.array(x) for t, x in vectors_of(model, [word1, word2, target]).items()}
    difference = v[word1] - v[word2]
    queries = {"difference": difference.tolist(), "analogy": (difference + v[target]).tolist()}
    return nearest(model, queries, n)


def cooccurrences(df: DataFrame, tokens: str, window: int = 5, min_count: int = 2) -> DataFrame:
    """(token, context, n): how often two tokens stand at most window places apart, in both orders.

    Tokens that occur fewer than min_count times are left out of the result, not of the distances.
    Every task counts the pairs of its texts by number and passes them on in packed lists (see _pair_lists); no
    single pair is shuffled, and the number of tasks that sum them up follows the number of occurrences.
    """
    return _both_orders(_counted_once(df, tokens, window, min_count), "a", "b", "n").withColumnsRenamed({"a": "token", "b": "context"})


def _both_orders(pairs: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """(a, b, value) of unordered pairs in both orders; an item paired with itself has one row."""
    straight, turned = F.struct(a, b, value), F.struct(F.col(b).alias(a), F.col(a).alias(b), value)
    return pairs.select(F.inline(F.when(F.col(a) == F.col(b), F.array(straight)).otherwise(F.array(straight, turned))))


def in_both_orders(pairs: DataFrame) -> DataFrame:
    """(a, b, n) of the unordered pairs of counted_numbers() in both orders."""
    return _both_orders(pairs, "a", "b", "n")


def _counted_once(df: DataFrame, tokens: str, window: int, min_count: int) -> DataFrame:
    """(a, b, n), a <= b: cooccurrences() with one row per two tokens."""
    vocabulary, known, lists = _pair_lists(df, tokens, window, min_count)
    if known is not None:
        return _summed_pairs(lists, vocabulary, known)
    pairs = _summed_pairs(lists, vocabulary)
    for side in ("a", "b"):
        pairs = pairs.withColumnRenamed(side, "number").join(vocabulary.withColumnRenamed("token", side), "number").drop("number")
    return pairs.select("a", "b", "n")


def counted_numbers(df: DataFrame, tokens: str, window: int, min_count: int) -> tuple[DataFrame, DataFrame]:
    """(vocabulary(token, number), pairs(a, b, n)): cooccurrences() with one row per two tokens, in numbers by name, a <= b."""
    vocabulary, _, lists = _pair_lists(df, tokens, window, min_count)
    return vocabulary, _summed_pairs(lists, vocabulary)


def _pair_lists(df: DataFrame, tokens: str, window: int, min_count: int) -> tuple[DataFrame, Broadcast | None, DataFrame]:
    """(vocabulary(token, number), known, lists(bucket, _others, _n)): the pairs of each task in packed lists.

    A task looks up the numbers of its tokens and counts equal pairs before it passes them on; the lists hold sorted
    pairs of numbers, as differences, and their counts. Buckets are the cells of a grid over both tokens, so that the
    pairs of a common token are dealt to a whole row and column, while a token stands in few buckets. known is the
    vocabulary as tasks hold it, or None if it is too large for that: numbers are then joined with the occurrences.
    """
    spark = df.sparkSession
    counts = df.select(F.explode(tokens).alias("token")).filter(F.col("token").isNotNull()).groupBy("token").agg(F.count("*").alias("_n"))
    kept = materialise(counts.filter(F.col("_n") >= min_count), "tokens")
    total, held, size = kept.agg(F.sum("_n"), F.sum(F.octet_length(F.col("token").cast("string")) + 8), F.count("*")).first()
    vocabulary = position(kept.select("token"), [], [F.col("token").asc()], "number")
    vocabulary = materialise(vocabulary.select("token", F.col("number").cast("int").alias("number")), "vocabulary")
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil((total or 0) / TOKENS_PER_TASK))
    known = None
    if (held or 0) <= VOCABULARY_BYTES:
        table = vocabulary.orderBy("number").select("token").toArrow()
        known = spark.sparkContext.broadcast(table.column(0).combine_chunks())
        texts = df.select(F.col(tokens).alias("_tokens"))
    else:
        opened = df.select(F.monotonically_increasing_id().alias("_text"), F.col(tokens).alias("_tokens"))
        opened = opened.select("_text", F.posexplode("_tokens").alias("_at", "token"))
        listed = F.sort_array(F.collect_list(F.struct("_at", "number"))).alias("_v")
        texts = opened.join(vocabulary, "token").groupBy("_text").agg(listed)
        texts = texts.select(F.col("_v._at").alias("_at"), F.col("_v.number").alias("_number"))
    side = math.ceil(math.sqrt(tasks))
    kernel = _listing(window, size, side, known)
    lists = texts.mapInArrow(kernel, "bucket int, _others binary, _n binary")
    return vocabulary, known, lists.repartitionById(side * side, "bucket")


def _listing(window: int, size: int, side: int, known: Broadcast | None):
    """The pairs of numbers at most window places apart in a task's texts, counted, as packed lists for side^2 buckets."""
    def pack(values: np.ndarray) -> bytes:
        # Bytes of equal weight stand together; those of great weight are mostly zero.
        width = max(1, (int(values.max()).bit_length() + 7) // 8)
        planes = values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
        return bytes([width]) + len(values).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)

    def dealt(numbers: np.ndarray) -> np.ndarray:
        return (numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(side)

    def laid_out(batch: pa.RecordBatch) -> np.ndarray:
        """Numbers of all texts one after the other, -1 for no number, with a gap of window places behind each text."""
        first = batch.column(0)
        lengths = first.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        if known is not None:
            flat = first.flatten()
            at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            numbers = pc.index_in(flat, value_set=known.value.cast(flat.type)).fill_null(-1).to_numpy()
            places = lengths
        else:
            at, numbers = (batch.column(i).flatten().to_numpy().astype(np.int64) for i in (0, 1))
            places = np.zeros(len(lengths), dtype=np.int64)
            places[lengths > 0] = at[np.cumsum(lengths)[lengths > 0] - 1] + 1
        starts = np.cumsum(places + window) - (places + window)
        laid = np.full(int((places + window).sum()), -1, dtype=np.int64)
        laid[np.repeat(starts, lengths) + at] = numbers
        return laid

    def counted(laid: np.ndarray, start: int, end: int) -> pa.RecordBatch:
        found = []
        for apart in range(1, window + 1):
            x, y = laid[start:end], laid[start + apart:end + apart]
            x = x[:len(y)]
            both = (x >= 0) & (y >= 0)
            x, y = x[both], y[both]
            found.append(np.minimum(x, y) * size + np.maximum(x, y))
        pairs = np.concatenate(found)
        del found
        pairs.sort()
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        counts, pairs = np.diff(first, append=len(pairs)), pairs[first]
        bucket = (dealt(pairs // size) * np.uint64(side) + dealt(pairs % size)).astype(np.uint16 if side <= 256 else np.int64)
        order = np.argsort(bucket, kind="stable")
        pairs, counts, bucket = pairs[order], counts[order], bucket[order]
        cuts = np.append(np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1)), len(bucket)).tolist()
        rows = [
            (int(bucket[i]), pack(np.diff(pairs[i:j], prepend=0)), pack(counts[i:j])) for i, j in zip(cuts[:-1], cuts[1:])
        ]
        columns = list(zip(*rows)) or [[], [], []]
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "_others", "_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, _PAIRS_AT_ONCE // max(1, window))
        held, n = [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            laid = np.concatenate(held)
            for start in range(0, len(laid), step):
                yield counted(laid, start, min(start + step, len(laid)))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(laid_out(batch))
            n += len(held[-1])
            if n >= step:
                yield from flushed()
                held, n = [], 0
        if held and window > 0 and size:
            yield from flushed()

    return run


def _summed_pairs(lists: DataFrame, vocabulary: DataFrame, known: Broadcast | None = None) -> DataFrame:
    """(a, b, n) of the lists of all tasks, in numbers, or by name where the vocabulary is given as tasks hold it."""
    size = vocabulary.count()
    kind = "int" if known is None else vocabulary.schema["token"].dataType.simpleString()

    def unpack(packed: bytes) -> np.ndarray:
        width, n = packed[0], int.from_bytes(packed[1:5], "little")
        planes = np.frombuffer(pa.decompress(memoryview(packed)[5:], width * n, codec="zstd"), np.uint8).reshape(width, n)
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :width] = planes.T
        return wide.view("<i8")[:, 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = [], []
        for batch in batches:
            pairs += [np.cumsum(unpack(x)) for x in batch.column("_others").to_pylist()]
            counts += [unpack(x) for x in batch.column("_n").to_pylist()]
        if not pairs:
            return
        pairs, counts = np.concatenate(pairs), np.concatenate(counts)
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        pairs, counts = pairs[first], np.add.reduceat(counts, first)
        for start in range(0, len(pairs), _ROWS_AT_ONCE):
            part, n = pairs[start:start + _ROWS_AT_ONCE], counts[start:start + _ROWS_AT_ONCE]
            a, b = part // size, part % size
            # A token beside itself stands in both orders in the same row.
            ends = [pa.array(x.astype(np.int32)) for x in (a, b)]
            if known is not None:
                ends = [known.value.take(x) for x in ends]
            yield pa.RecordBatch.from_arrays([*ends, pa.array(np.where(a == b, 2 * n, n))], ["a", "b", "n"])

    return lists.mapInArrow(run, f"a {kind}, b {kind}, n bigint")


def association(pairs: DataFrame) -> DataFrame:
    """(token, context, weight): positive pointwise mutual information of cooccurrences()."""
    pairs = materialise(pairs, "cooccurrences")
    sums = materialise(pairs.groupBy("token").agg(F.sum("n").alias("_sum")), "token-sums")
    total = pairs.agg(F.sum("n")).scalar()
    context = sums.select(F.col("token").alias("context"), F.col("_sum").alias("_context"))
    weight = _information(total, "_sum", "_context")
    return pairs.join(sums, "token").join(context, "context").select("token", "context", weight.alias("weight")).filter(F.col("weight") > 0)


def held_by_tasks(table: DataFrame) -> DataFrame:
    """table, a written one, to be broadcast in a join unless it has too many rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _information(total: Column, one: str, other: str) -> Column:
    return F.log(F.col("n") * total / (F.col(one) * F.col(other)))


def _association_cells(once: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(numbers(token, number), cells(row, column, weight)): association() of the pairs of _counted_once(), written, in numbers.

    Every two tokens have one cell. Tokens are numbered by name, only those with a cell. once, a written table, is
    joined once per side, where it takes up the sum and the number of a token, and is deleted. Its tokens may be
    numbers themselves (see counted_numbers).
    """
    sums = _both_orders(once, "a", "b", "n").groupBy("a").agg(F.sum("n").alias("_sum")).withColumnRenamed("a", "token")
    sums = materialise(sums, "token-sums")
    numbers = materialise(position(sums, [], [F.col("token").asc()], "number").withColumn("number", F.col("number").cast("int")), "token-numbers")
    total = F.lit(sums.agg(F.sum("_sum")).first()[0])
    for side, number in (("a", "row"), ("b", "column")):
        named = numbers.select(F.col("token").alias(side), F.col("number").alias(number), F.col("_sum").alias(f"_sum_{number}"))
        joined = (once if side == "a" else joined).join(held_by_tasks(named), side).drop(side)
    weight = _information(total, "_sum_row", "_sum_column")
    cells = joined.select("row", "column", weight.alias("weight")).filter(F.col("weight") > 0)
    cells = materialise(cells.withColumn("weight", F.col("weight").cast("float")), "association")
    discard(once, sums)
    numbers = numbers.select("token", "number")
    held = materialise(cells.select(F.explode(F.array("row", "column")).alias("number")).distinct(), "held-numbers")
    if held.count() < numbers.count():
        # A token that stands beside others just as often as any token does has no cell; those after it move up.
        kept = position(numbers.join(held, "number", "left_semi"), [], [F.col("token").asc()], "_new")
        kept = materialise(kept.withColumn("_new", F.col("_new").cast("int")), "token-numbers")
        for side in ("row", "column"):
            cells = cells.join(held_by_tasks(kept.select(F.col("number").alias(side), F.col("_new").alias(f"_{side}"))), side)
        cells = materialise(cells.select(F.col("_row").alias("row"), F.col("_column").alias("column"), "weight"), "association")
        numbers = kept.select("token", F.col("_new").alias("number"))
    return numbers, cells


def train_vectors(
    df: DataFrame, tokens: str, size: int = 25, min_count: int = 2, seed: int = 42, window: int = 5, rounds: int = 10
) -> DataFrame:
    """(token, vec): factors of the association of tokens with their contexts, by alternating least squares.

    Counts, association and both factor tables stay distributed; the blocks of the factorisation grow in number, not
    in size. The result does not depend on the partitions of df. A token without positive association has no vector. Where spark.checkpoint.dir is set
    every round is written there, which lets go of what the rounds before have shuffled.
    """
    vocabulary, once = counted_numbers(df, tokens, window, min_count)
    numbers, cells = _association_cells(materialise(once, "cooccurrences"))
    named = vocabulary.select("token", F.col("number").alias("_known"))
    numbers = numbers.withColumnRenamed("token", "_known").join(named, "_known").select("token", "number")
    blocks = max(_LEAST_BLOCKS, math.ceil(2 * cells.count() / CELLS_PER_BLOCK))
    model = ALS(
        rank=size, maxIter=rounds, regParam=0.1, seed=seed, userCol="row", itemCol="column", ratingCol="weight",
        numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1,
    ).fit(_both_orders(cells, "row", "column", "weight"))
    return model.userFactors.withColumnRenamed("id", "number").join(numbers, "number").select(
        "token", F.col("features").alias("vec")
    )
