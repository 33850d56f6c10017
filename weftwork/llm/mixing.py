"""Mixing sources to target weights by Poisson replication, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.llm.tables import uniform
from weftwork.session import materialise


def _poisson_steps(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... up to where the rest is below double precision."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(
        F.lit(0.0).alias("log_factorial"), F.exp(-rate).alias("reached"), F.array(F.exp(-rate)).alias("steps")
    )

    def add(state: Column, k: Column) -> Column:
        factorial = state["log_factorial"] + F.log(k.cast("double"))
        reached = state["reached"] + F.exp(k * F.log(rate) - rate - factorial)
        return F.struct(
            factorial.alias("log_factorial"), reached.alias("reached"),
            F.concat(state["steps"], F.array(reached)).alias("steps"),
        )

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, add)["steps"]).otherwise(F.array(F.lit(1.0)))


def replication_rates(docs: DataFrame, weights: DataFrame | None, source: str = "source") -> DataFrame:
    """(source, n_rows, rate): rows of the source, and how often one of them is wanted on average.

    weights(source, weight) need not sum to one; without it all sources weigh the same. The mix has as
    many rows as the input on average: rate = weight share * all rows / rows of the source. Sources
    without a weight (or a NULL or negative one) get rate 0. A NULL source is a source of its own.
    """
    held = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n_rows"))
    if weights is None:
        weighted = held.withColumn("weight", F.lit(1.0))
    else:
        wanted = weights.groupBy("source").agg(F.sum(F.greatest("weight", F.lit(0.0))).alias("weight"))
        wanted = wanted.select(F.col("source").alias("_w"), "weight")
        weighted = held.join(wanted, F.col("source").eqNullSafe(F.col("_w")), "left").select(
            "source", "n_rows", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    weighted = materialise(weighted, "weights")
    totals = weighted.agg(F.sum("n_rows"), F.sum("weight")).first()
    rows, weight = totals[0] or 0, totals[1] or 0.0
    rate = F.col("weight") / (weight or 1.0) * float(rows) / F.col("n_rows")
    return weighted.select("source", "n_rows", rate.alias("rate"))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, key: str = "doc_id", source: str = "source", seed: int = 0,
    number: str = "copy",
) -> DataFrame:
    """Columns of docs plus the number of the copy (from 1), in a global random order fixed by seed.

    Each row is repeated as often as the inverse Poisson distribution with its source's rate says at a
    number hashed from seed and key, so the counts do not depend on partitioning. Repeated rows (same
    key) get the same count; a NULL key counts as empty text; an empty table stays empty. Further
    columns are carried; a column with the name of number is replaced.
    """
    kept = [c for c in docs.columns if c != number]
    steps = replication_rates(docs, weights, source).select(
        F.col("source").alias("_mix_source"), _poisson_steps(F.col("rate")).alias("_mix_steps")
    )
    steps = materialise(steps, "poisson_steps")
    draw = uniform(F.col(key), seed=seed)
    counted = docs.select(*kept, draw.alias("_mix_draw")).join(
        steps, F.col(source).eqNullSafe(F.col("_mix_source")), "inner"
    )
    count = F.size(F.filter("_mix_steps", lambda step: step <= F.col("_mix_draw")))
    copies = counted.withColumn("_mix_count", count).filter(F.col("_mix_count") > 0).select(
        *kept, F.explode(F.sequence(F.lit(1), F.col("_mix_count"))).alias(number)
    )
    order = F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")), number)
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copies.withColumn("_mix_order", order).repartition(shuffles, "_mix_order").sortWithinPartitions(
        "_mix_order"
    ).select(*kept, number)


def temperature_weights(docs: DataFrame, source: str = "source", exponent: float = 0.5) -> DataFrame:
    """(source, weight): rows of the source to the power of exponent; 1 keeps the mix, 0 makes it even."""
    if not math.isfinite(exponent):
        raise ValueError("exponent must be finite")
    return docs.groupBy(F.col(source).alias("source")).agg(F.pow(F.count("*"), F.lit(exponent)).alias("weight"))
