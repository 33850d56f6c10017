"""Nearest neighbours by inner product with randomly rotated one-bit codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftwork.session import materialise

ROTATION_SEED = 20
#: Candidates and queries that one task compares.
CANDIDATE_BLOCK, QUERY_BLOCK = 16_384, 4_096
#: Bits that a component of a rotated query is rounded to.
QUERY_BITS = 4
#: Standard deviations of the estimate's error that a bound allows for.
DEVIATIONS = 4.0


def rotation(dimension: int, seed: int = ROTATION_SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector in doubles, size): vectors that are not NULL, empty or zero and have only finite parts."""
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector")).filter(
        F.col("key").isNotNull() & F.col("vector").isNotNull() & whole & F.exists("vector", lambda x: x != 0)
    ).withColumn("size", F.size("vector"))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sign bits packed into 64-bit words, norm, alignment): alignment is the inner product of the rotated
    unit vector with its own code, the corner of the unit cube that its signs name."""
    norm = np.linalg.norm(vectors, axis=1)
    turned = (vectors / norm[:, None]) @ turn.T
    alignment = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return pack(turned >= 0), norm, alignment


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, filled up with zeros."""
    packed = np.packbits(bits, axis=1)
    filled = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), np.uint8)
    filled[:, :packed.shape[1]] = packed
    return filled.view(np.uint64)


def quantise(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, low, step) of rotated unit queries: component = low + step * level, and plane j holds bit j of all levels."""
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (2**QUERY_BITS - 1), 1e-12)
    levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    return np.stack([pack((levels >> j) & 1) for j in range(QUERY_BITS)], axis=1), low, step


def code_products(codes: np.ndarray, ones: np.ndarray, planes: np.ndarray, low: float, step: float, total: float, size: int) -> np.ndarray:
    """Inner products of one query with the corners that the codes name, by AND and popcount on packed words."""
    level_sum = np.zeros(len(codes), np.uint32)
    for j, plane in enumerate(planes):
        for word, column in zip(plane, codes.T):
            level_sum += np.bitwise_count(column & word).astype(np.uint32) << np.uint32(j)
    held = np.float32(low) * ones + np.float32(step) * level_sum.astype(np.float32)
    return (2 * held - np.float32(total)) * np.float32(1 / np.sqrt(size))


def build_index(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, spot, size, code, norm, alignment, vector): the one-bit code of every usable vector.

    spot is a hash of key and place that deals rows to blocks, copies of a vector or a key included.
    """

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for size, rows in part.groupby("size"):
                table = np.stack(rows["vector"].to_numpy()).astype(np.float64)
                scale = _scale(table)
                code, norm, alignment = encode(table / scale[:, None], rotation(int(size)))
                yield pd.DataFrame({
                    "key": rows["key"].to_numpy(), "spot": rows["spot"].to_numpy(), "size": rows["size"].to_numpy(),
                    "code": [c.tobytes() for c in code], "norm": norm * scale, "alignment": alignment,
                    "vector": rows["vector"].to_numpy(),
                })

    rows = usable(vectors, key, vector).withColumn("spot", F.xxhash64("key", F.monotonically_increasing_id()))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInPandas(
        work, f"key {kind}, spot long, size int, code binary, norm double, alignment double, vector array<double>"
    )


def _scale(vectors: np.ndarray) -> np.ndarray:
    """A power of two for every row, so that huge and tiny components neither overflow nor vanish."""
    return np.exp2(np.floor(np.log2(np.abs(vectors).max(axis=1))))


def _dot(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products row by row; equal vectors give equal results wherever they stand."""
    return (queries * rows).sum(axis=1)


def search_block(
    query_keys: np.ndarray, queries: np.ndarray, keys: np.ndarray, codes: np.ndarray, norm: np.ndarray,
    alignment: np.ndarray, vectors: np.ndarray, top: int, deviations: float,
) -> pd.DataFrame:
    """The top candidates of a block for every query, by exact inner product.

    Estimate: <code, rotated unit query> / alignment * norm, the query rounded to QUERY_BITS bits. First the
    candidates with the best estimates are computed exactly; then all whose estimate plus error bound
    (of the code and of the rounding) reaches the last of these.
    """
    size = vectors.shape[1]
    order = np.argsort(keys, kind="stable")
    keys, codes, norm, alignment, vectors = (x[order] for x in (keys, codes, norm, alignment, vectors))
    codes = np.asfortranarray(codes)
    ones = np.bitwise_count(codes).sum(axis=1).astype(np.float32)
    factor = norm / alignment
    code_error = np.sqrt(np.maximum(0, 1 - alignment**2) / max(1, size - 1))
    unit = queries / _scale(queries)[:, None]
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    turned = unit @ rotation(size).T
    planes, low, step = quantise(turned)
    own_first, own_last = np.searchsorted(keys, query_keys, "left"), np.searchsorted(keys, query_keys, "right")
    # Scores up to rounding come from products with the surviving rows; rows so close to the last
    # place that rounding could decide are computed once more, row by row.
    slack = 1e-9 * norm
    found = []
    for i in range(len(queries)):
        n = min(top, len(keys) - int(own_last[i] - own_first[i]))
        if n == 0:
            continue
        estimate = factor * code_products(codes, ones, planes[i], low[i], step[i], turned[i].sum(), size)
        estimate[own_first[i]:own_last[i]] = -np.inf  # rows with the query's own key
        first = np.argpartition(estimate, len(keys) - n)[-n:]
        least = (vectors[first] @ unit[i] - slack[first]).min()
        error = deviations * np.sqrt(code_error**2 + step[i]**2 / 12) + 1e-6
        chosen = np.flatnonzero(estimate + factor * error >= least)
        near = vectors[chosen] @ unit[i]
        if len(chosen) < n:
            chosen, near = first, vectors[first] @ unit[i]
        last = np.partition(near - slack[chosen], len(near) - n)[-n]
        chosen = chosen[near + slack[chosen] >= last]
        exact = _dot(queries[i], vectors[chosen])
        best = np.lexsort((chosen, -exact))[:top]  # candidates stand in key order
        found.append((np.full(len(best), i), keys[chosen[best]], exact[best]))
    if not found:
        return pd.DataFrame({"query_id": query_keys[:0], "vec_id": keys[:0], "score": np.empty(0)})
    which = np.concatenate([f[0] for f in found])
    return pd.DataFrame({
        "query_id": query_keys[which], "vec_id": np.concatenate([f[1] for f in found]),
        "score": np.concatenate([f[2] for f in found]),
    })


def nearest(
    vectors: DataFrame, is_query, top: int = 20, key: str = "vec_id", vector: str = "embedding",
    deviations: float = DEVIATIONS, candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the top candidates of every row for which is_query holds.

    All other rows are candidates; a query never finds rows with its own key. Every vector is indexed.
    Queries meet all candidates block by block, and each pair of blocks keeps its top rows before they
    are ranked. Vectors that are NULL, empty, zero or not finite, and rows without a key, take no part;
    vectors of different lengths do not meet. Ties go to the smaller key, repeated rows are candidates
    of their own, further columns are not looked at.
    """
    index = materialise(build_index(vectors, key, vector), "codes")
    # Of rows that share a key one is the query.
    wanted = index.filter(is_query(F.col("key"))).groupBy("key").agg(F.min(F.struct("size", "vector")).alias("v")).select("key", "v.*")
    counts = index.agg(F.count("*"), F.count_if(is_query(F.col("key")))).first()
    n_cand, n_query = max(1, -(-counts[0] // candidate_block)), max(1, -(-counts[1] // query_block))
    candidates = index.withColumn("b", F.pmod("spot", F.lit(n_cand)).cast("int")).withColumn(
        "a", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1)))
    )
    # The block of a query depends on its key alone, so a repeated task deals it to the same blocks.
    queries = wanted.select("key", "size", "vector", F.pmod(F.xxhash64("key"), F.lit(n_query)).cast("int").alias("a")).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(n_cand - 1)))
    )
    kind = index.schema["key"].dataType.simpleString()

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        size = int(left["size"].iloc[0])
        codes = np.frombuffer(b"".join(right["code"]), np.uint64).reshape(len(right), -1)
        return search_block(
            left["key"].to_numpy(), np.stack(left["vector"].to_numpy()).astype(np.float64), right["key"].to_numpy(), codes,
            right["norm"].to_numpy(), right["alignment"].to_numpy(),
            np.stack(right["vector"].to_numpy()).astype(np.float64).reshape(-1, size), top, deviations,
        )

    cell = ["size", "a", "b"]
    found = queries.groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInPandas(
        work, f"query_id {kind}, vec_id {kind}, score double"
    )
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score"
    )
