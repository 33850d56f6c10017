"""Two-mode tables (row_item, col_item) and their one-mode projections."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.operators.pairs import few_pairs, pair_totals, products_at_least
from weftwork.session import materialise

#: Rows of a two-mode table whose cells one task holds.
ROWS_PER_TASK = 2_000_000


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "choice", value: str = "value") -> DataFrame:
    """Wide to long: one row per id and value column."""
    return df.unpivot(ids, values, name, value)


def _dealt(rows: DataFrame) -> DataFrame:
    """(row_item, col_item, ...) with equal cells in one task; the number of tasks follows that of the rows.

    Cells seldom repeat, so a task that gathers them ahead of the shuffle would only hold its whole part of the table.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / ROWS_PER_TASK))
    return rows.repartition(tasks, "row_item", "col_item")


def incidence(df: DataFrame, row: str, col: str) -> DataFrame:
    """Distinct (row_item, col_item); absent pairs are the zeros. df is read twice."""
    return _dealt(df.select(F.col(row).alias("row_item"), F.col(col).alias("col_item")).filter(
        F.col(row).isNotNull() & F.col(col).isNotNull()
    )).distinct()


def summed_cells(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """(row_item, col_item, w): the sum of value over the rows of each cell. df is read twice."""
    rows = _dealt(df.select(F.col(row).alias("row_item"), F.col(col).alias("col_item"), F.col(value).alias("w")))
    return rows.groupBy("row_item", "col_item").agg(F.sum("w").cast("double").alias("w"))


def incidence_matrix(cells: DataFrame, columns: list) -> DataFrame:
    """row_item with a 0/1 column per listed column item."""
    wide = cells.groupBy("row_item").pivot("col_item", columns).agg(F.count(F.lit(1)))
    return wide.select("row_item", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(str(c)) for c in columns])


def project(
    cells: DataFrame, onto: str = "row_item", weight: Column | None = None, diagonal: bool = False,
    min_weight: float | None = None, top_n: int | None = None,
) -> DataFrame:
    """(left, right, weight): for two items of one side the number of items they share.

    With a weight column the products are summed instead, as in a document-term matrix.
    With diagonal every item is also paired with itself (its degree, or its squared length).
    Pairs that share nothing are left out. Items that hold very many others are cut into blocks.

    min_weight keeps pairs of at least that weight, top_n the heaviest pairs, ties by name; the
    diagonal stays whole. Both bound the search: pairs meet only at the rarer items that two items
    of such a weight must share. Without either, all sharing pairs are the result.
    """
    via = "col_item" if onto == "row_item" else "row_item"
    value = F.lit(1).cast("long") if weight is None else weight
    rows = materialise(cells.select(F.col(onto).alias("owner"), F.col(via).alias("item"), value.alias("weight")), "cells")
    if top_n is not None:
        result = _heaviest(rows, top_n, min_weight, weight is None)
    else:
        result = _shared(rows, min_weight, weight is None)
    if diagonal:
        own = rows.groupBy(F.col("owner").alias("left"), F.col("owner").alias("right")).agg(
            F.sum(F.col("weight") * F.col("weight")).alias("weight")
        )
        result = result.unionByName(own)
    return result


def _shared(rows: DataFrame, least: float | None, counts: bool) -> DataFrame:
    """(left, right, weight) of pairs with a weight of at least least, of all sharing pairs without one."""
    if least is not None and least > 0 and not few_pairs(rows):
        return products_at_least(rows, least, counts).select("left", "right", F.col("dot").alias("weight"))
    total = F.count("*") if counts else F.sum(F.col("left_weight") * F.col("right_weight"))
    result = pair_totals(rows, "item", "owner", [total.alias("weight")], [] if counts else ["weight"])
    return result if least is None else result.filter(F.col("weight") >= least)


def _heaviest(rows: DataFrame, n: int, least: float | None, counts: bool) -> DataFrame:
    """The n heaviest pairs: the bound starts where the two longest items allow and falls until n are found."""
    order = [F.col("weight").desc(), F.col("left"), F.col("right")]
    square = F.col("weight").cast("double") * F.col("weight").cast("double")
    lengths = rows.groupBy("owner").agg(F.sqrt(F.sum(square)).alias("_length"))
    first = [r[0] for r in lengths.select("_length").orderBy(F.col("_length").desc()).limit(2).collect()]
    floor = rows.agg(F.min(F.when(square > 0, square))).first()[0] or 0.0
    bound = first[0] * first[1] if len(first) == 2 else 0.0
    if few_pairs(rows):
        bound = 0.0
    while bound > max(floor, least or 0.0):
        found = materialise(_shared(rows, bound, counts), "heavy-pairs")
        if found.count() >= n:
            return found.orderBy(*order).limit(n)
        bound /= 4
    return _shared(rows, least, counts).orderBy(*order).limit(n)


def relabel(projection: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """Replace both ids by names from a (key, name) table; (left_name, right_name, weight)."""
    left = names.select(F.col(key).alias("left"), F.col(name).alias("left_name"))
    right = names.select(F.col(key).alias("right"), F.col(name).alias("right_name"))
    return projection.join(left, "left").join(right, "right").select("left_name", "right_name", "weight")


def scaled_weights(projection: DataFrame, to: float = 3.0) -> DataFrame:
    """Adds width = weight / largest weight * to.

    A projection need not be written for it: the search of the largest weight reads what the projection shuffles.
    """
    largest = projection.agg(F.max("weight")).scalar()
    return projection.withColumn("width", F.col("weight") / largest * to)
