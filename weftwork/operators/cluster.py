"""k-means on an array column, with its centres, costs and labels as tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from weftwork.operators.embeddings import dot
from weftwork.operators.ranking import top_rows


#: Rows per cluster from which the starts are chosen.
SAMPLE = 20


@dataclass
class Clustering:
    assignments: DataFrame  # the input rows with cluster
    centres: DataFrame      # cluster, centre array<double>
    cost: float


def _assign(centres: np.ndarray, vector: str, schema: StructType):
    """Adds cluster, the nearest centre (the smaller number in a tie), and its squared distance."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch[vector].to_numpy()).astype(np.float64)
            apart = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * (x @ centres.T)
            apart = np.round(np.maximum(apart, 0.0), 9)
            nearest = apart.argmin(axis=1)
            batch["cluster"] = nearest.astype(np.int32)
            batch["_apart"] = apart[np.arange(len(x)), nearest]
            yield batch[schema.names]

    return run


def _starts(sample: np.ndarray, k: int) -> np.ndarray:
    """k rows of the sample: its first, then each time the one farthest from those chosen, the earlier in a tie."""
    chosen = sample[:1]
    while len(chosen) < min(k, len(sample)):
        apart = ((sample[:, None, :] - chosen[None, :, :]) ** 2).sum(axis=2).min(axis=1)
        chosen = np.vstack([chosen, sample[np.round(apart, 9).argmax()]])
    return chosen


def fit_kmeans(df: DataFrame, vector: str, k: int, key: str, max_iter: int = 20) -> Clustering:
    """k-means from fixed starts: rows far from each other among the SAMPLE * k whose key has the smallest MD5.

    Assignment and means alternate until the centres stand still, max_iter times at most. Only the
    centres reach the driver. A centre that loses all rows stays where it was. The result does not
    depend on the partitions of df.
    """
    spark = df.sparkSession
    start = df.orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).select(vector).limit(SAMPLE * k).collect()
    centres = _starts(np.array([r[0] for r in start], np.float64), k)
    schema = StructType([*df.schema.fields, StructField("cluster", IntegerType()), StructField("_apart", DoubleType())])
    for _ in range(max_iter):
        means = centres_from(df.mapInPandas(_assign(centres, vector, schema), schema), vector).toPandas()
        moved = centres.copy()
        moved[means["cluster"], means["i"]] = means["value"]
        settled = np.allclose(moved, centres, rtol=0, atol=1e-12)
        centres = moved
        if settled:
            break
    assigned = df.mapInPandas(_assign(centres, vector, schema), schema)
    cost = float(assigned.agg(F.coalesce(F.sum("_apart"), F.lit(0.0))).first()[0])
    table = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cluster int, centre array<double>")
    return Clustering(assigned.drop("_apart"), table, cost)


def squared_distance(a, b):
    return dot(a, a) + dot(b, b) - 2 * dot(a, b)


def centres_from(assignments: DataFrame, vector: str) -> DataFrame:
    """(cluster, i, value, n): centre coordinates as means of the assigned rows."""
    cells = assignments.select("cluster", F.posexplode(vector).alias("i", "x"))
    return cells.groupBy("cluster", "i").agg(
        F.avg(F.col("x").cast("double")).alias("value"), F.count("*").alias("n")
    )


def inertia_from(assignments: DataFrame, vector: str) -> DataFrame:
    """(cluster, n, inertia): squared distances of the assigned rows to their mean.

    Per coordinate sum(x^2) - sum(x)^2 / n, so one partially summed pass gives mean and spread.
    """
    cells = assignments.select("cluster", F.posexplode(vector).alias("i", "x"))
    x = F.col("x").cast("double")
    per = cells.groupBy("cluster", "i").agg(
        (F.sum(x * x) - F.sum(x) * F.sum(x) / F.count("*")).alias("_ss"), F.count("*").alias("n")
    )
    return per.groupBy("cluster").agg(F.max("n").alias("n"), F.sum("_ss").alias("inertia"))


def inertia_sweep(data: dict[str, DataFrame], vector: str, ks: list[int], key: str) -> DataFrame:
    """(data, k, inertia) for several tables and numbers of clusters."""
    spark = next(iter(data.values())).sparkSession
    rows = [
        (name, k, fit_kmeans(df, vector, k, key).cost)
        for name, df in data.items() for k in ks
    ]
    return spark.createDataFrame(rows, "data string, k int, inertia double")


def majority_labels(assignments: DataFrame, cluster: str, label: str) -> DataFrame:
    """(cluster, predicted): the label most rows of a cluster have, the smaller one in a tie."""
    counted = assignments.groupBy(cluster, label).agg(F.count("*").alias("_n"))
    return counted.groupBy(cluster).agg(
        F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias("predicted")
    )


def label_clusters(assignments: DataFrame, cluster: str, label: str) -> DataFrame:
    """Adds predicted, the majority label of the row's cluster."""
    return assignments.join(majority_labels(assignments, cluster, label), cluster)


def nearest_to_centres(assignments: DataFrame, centres: DataFrame, key: str, vector: str, n: int = 5) -> DataFrame:
    """(cluster, key, distance, rank) of the n members nearest to their centre."""
    near = assignments.join(centres, "cluster").select(
        "cluster", key,
        F.sqrt(F.greatest(squared_distance(F.col(vector), F.col("centre")), F.lit(0.0))).alias("distance"),
    )
    return top_rows(near, n, ["cluster"], [F.round("distance", 9).asc(), F.col(key).asc()], "rank")
