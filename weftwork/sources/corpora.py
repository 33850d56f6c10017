"""Labelled corpora: JSON files {documents: [[text, label], ...], metadata: {...}}."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORPUS_SCHEMA = "documents array<array<string>>, metadata struct<description: string, version: string>"


def _documents(df: DataFrame, keys: list[str], documents: str) -> DataFrame:
    return df.select(*keys, F.posexplode(documents).alias("doc_id", "_d")).select(
        *keys, "doc_id", F.get("_d", F.lit(0)).alias("text"), F.get("_d", F.lit(1)).alias("label")
    )


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text, label) of corpus files, doc_id counting from 0 within a file."""
    return _documents(spark.read.schema(CORPUS_SCHEMA).json(path, multiLine=True), [], "documents")


def parse_corpus(df: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """(keys, doc_id, text, label) of corpora held in a text column."""
    parsed = df.select(*keys, F.from_json(json, CORPUS_SCHEMA).alias("_c"))
    return _documents(parsed.select(*keys, F.col("_c.documents").alias("documents")), keys, "documents")
