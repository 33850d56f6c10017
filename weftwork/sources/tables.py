"""Reading tables, and storing result tables per corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Session setting for tables that are stored in fewer splits than the session has cores.
INPUT_PARTITIONS = "spark.weftwork.inputPartitions"


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to as many partitions as the session setting says; without it df stays as read.

    Meant for small files on one machine; a cluster leaves the setting out and reads splits as they are.
    """
    wanted = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted else df


def save_results(results: dict[str, DataFrame], folder: str, corpus: str = "corpus") -> None:
    """One Parquet table per result, laid out by corpus so that a reader can prune to one."""
    for name, table in results.items():
        table.write.mode("overwrite").partitionBy(corpus).parquet(f"{folder}/{name}")


def load_results(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
