"""An index of vectors in cells around centres, searched exactly: bounds tell which cells need not be read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from weftwork.operators.embeddings import nearest

#: Centres at most: their vectors are held by every task that deals vectors to cells.
MOST_CELLS = 4096
_SLACK = 1e-7


@dataclass
class CellIndex:
    """folder holds the vectors by cell; centres are unit vectors, radius the widest angle inside a cell."""

    spark: SparkSession
    folder: str
    schema: StructType
    cells: list[int]
    centres: np.ndarray
    radius: np.ndarray
    sizes: np.ndarray

    def read(self, cells: list[int]) -> DataFrame:
        """The vectors of some cells; only their files are opened."""
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/vectors").filter(F.col("cell").isin(cells)).drop("cell")

    def reach(self, query: list[float]) -> np.ndarray:
        """The greatest cosine that a vector of each cell can have with the query: the angle to it is no smaller
        than the angle to the centre less the radius."""
        unit = np.asarray(query, np.float64)
        unit = unit / np.linalg.norm(unit)
        angle = np.arccos(np.clip(self.centres @ unit, -1, 1))
        return np.cos(np.maximum(0, angle - self.radius))

    def first_cells(self, reach: np.ndarray, n: int) -> list[int]:
        """Places of the cells that reach farthest and hold n vectors together."""
        order = np.argsort(-reach, kind="stable")
        enough = int(np.searchsorted(np.cumsum(self.sizes[order]), n)) + 1
        return order[:enough].tolist()

    def search(self, queries: dict[str, list[float]], n: int = 10, exclude: dict[str, list] | None = None) -> DataFrame:
        """(query, token, similarity, rank) as embeddings.nearest finds it over all vectors.

        The cells that reach farthest are read first. Then only those are read that can hold a vector as
        near as the n-th found, so the result is exact for any number of cells. Queries must not be zero.
        """
        if not self.cells:
            return nearest(self.read([]), queries, n, exclude)
        widest = max((len(v) for v in (exclude or {}).values()), default=0)
        reach = {name: self.reach(vector) for name, vector in queries.items()}
        first = sorted({place for r in reach.values() for place in self.first_cells(r, n + widest)})
        found = nearest(self.read([self.cells[p] for p in first]), queries, n, exclude)
        last = {r["query"]: (r["n"], r["least"]) for r in found.groupBy("query").agg(F.count("*").alias("n"), F.min("similarity").alias("least")).collect()}
        needed = set(first)
        for name, r in reach.items():
            held, least = last.get(name, (0, -1.0))
            needed |= set(np.flatnonzero(r >= (least if held >= n else -1.0) - _SLACK).tolist())
        if needed == set(first):
            return found
        return nearest(self.read([self.cells[p] for p in sorted(needed)]), queries, n, exclude)


def build_cells(model: DataFrame, folder: str, cells: int = 64) -> CellIndex:
    """Write model(token, vec) below folder, dealt to the nearest of so many centres.

    Centres are the vectors with the smallest hash of the token. NULL, empty and zero vectors have no
    direction and are left out; all others must have one length. Repeated rows stay.
    """
    if not 1 <= cells <= MOST_CELLS:
        raise ValueError(f"between 1 and {MOST_CELLS} cells")
    spark = model.sparkSession
    usable = model.select("token", "vec").filter(F.exists("vec", lambda x: x != 0))
    chosen = usable.dropDuplicates(["vec"]).orderBy(F.xxhash64("token"), "token").limit(cells).collect()  # MOST_CELLS rows
    centres = np.array([r["vec"] for r in chosen] or np.empty((0, 1)), np.float64)
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    schema = StructType([*usable.schema.fields, StructField("cell", IntegerType()), StructField("angle", DoubleType())])

    def deal(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                unit = np.stack(part["vec"].to_numpy()).astype(np.float64)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                near = unit @ centres.T
                part["cell"] = near.argmax(axis=1).astype(np.int32)
                part["angle"] = np.arccos(np.clip(near.max(axis=1), -1, 1))
                yield part

    usable.mapInPandas(deal, schema).write.partitionBy("cell").parquet(f"{folder}/vectors")
    held = spark.read.schema(schema).parquet(f"{folder}/vectors")
    stats = held.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).orderBy("cell").collect()
    places = [r["cell"] for r in stats]
    return CellIndex(
        spark, folder, schema, places, centres[places], np.array([r["radius"] for r in stats]), np.array([r["n"] for r in stats], np.int64)
    )
