"""Running totals and positions in which no group is confined to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.session import materialise


def running_total(
    df: DataFrame, group: list[str], order: list[Column], value: Column, out: str,
    total: str | None = None,
) -> DataFrame:
    """Exact running sum of value inside each group, in a total order.

    The table is range-partitioned on (group, order) and the slice number is written with it; a
    slice's offset is the sum of the slices before it. A window over (group, slice) then never
    holds more than one slice, however large a group is.
    """
    if not order:
        raise ValueError("a running total needs an order")
    keys = [F.col(g).asc() for g in group]
    sliced = materialise(
        df.withColumn("_value", value)
        .repartitionByRange(*keys, *order)
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    parts = sliced.groupBy(*group, "_slice").agg(F.sum("_value").alias("_part"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *group, "_slice",
        F.coalesce(F.sum("_part").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_part").over(whole).alias("_total"),
    )
    inside = (
        Window.partitionBy(*group, "_slice").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    result = sliced.join(offsets, [*group, "_slice"]).withColumn(
        out, F.col("_before") + F.sum("_value").over(inside)
    )
    if total:
        result = result.withColumn(total, F.col("_total"))
    return result.drop("_value", "_slice", "_before", "_total")


def position(df: DataFrame, group: list[str], order: list[Column], out: str, start: int = 0) -> DataFrame:
    """Dense position of every row inside its group, from start."""
    return running_total(df, group, order, F.lit(1), out).withColumn(out, F.col(out) + (start - 1))


def top_rows(df: DataFrame, n: int, group: list[str], order: list[Column], rank: str = "_rank") -> DataFrame:
    """The first n rows of each group. Spark cuts every map task to n rows before the shuffle."""
    if not group:
        return df.orderBy(*order).limit(n)
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    return ranked.drop(rank) if rank == "_rank" else ranked
