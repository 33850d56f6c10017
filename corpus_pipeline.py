"""Documents to training shards: quality, near duplicates, benchmark passages, mix, shards.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of documents; further columns stay and none of theirs is read. An empty table passes
every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftwork.llm import decontamination, mixing, plans, quality, sharding, simhash
from weftwork.session import materialise
from weftwork.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking accepts.

    NULL and empty texts are judged by their (zero) features, very long ones as a whole; repeated rows and
    ties are judged alike. Without labels of both classes all documents stay.
    """
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest key.

    NULL and empty texts are one group; of rows that repeat a key one stays; rows without a key stay.
    """
    return simhash.one_of_each(docs, shingle=plans.DUPLICATE_SHINGLE, distance=plans.DUPLICATE_DISTANCE)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    NULL and empty texts hold none and stay, as do rows without a key; rows that repeat a key stay or go together.
    """
    return decontamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the target weights of their sources, in random order.

    A NULL source is a source of its own. Rows that repeat a key, and rows without one, draw the same number.
    """
    weights = mixing.temperature_weights(docs, exponent=plans.MIX_EXPONENT)
    return mixing.mix(docs, weights, seed=plans.MIX_SEED, number="_copy").select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard that each belongs to (columns shard, shard_depth, shard_bytes, replaced if there).

    NULL texts count no bytes; NULL keys are one key, whose rows are told apart only where they exceed a shard.
    """
    return sharding.shard(docs, limit=plans.SHARD_BYTES)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing", source_mixing),
    ("sharding", shards),
]

#: SQL can express neither the ranking nor the fingerprints; tests/llm replays the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.split(" ", maxsplit=1)[0])
    return STAGES[-1][1](spark, docs, sf_dir)
