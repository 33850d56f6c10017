"""Comparing corpora: shared and unique terms, set overlap, distances and angles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.operators.pairs import equal_owners, pairs_within, shared_products
from weftwork.operators.ranking import running_total, top_rows
from weftwork.session import materialise


def membership_patterns(df: DataFrame, owner: str, item: str) -> DataFrame:
    """(_pattern, name, n_items): items that belong to the same sets are one pattern, named by the smallest item.

    df holds each pair once. A row tells that set `name` holds the pattern's n_items items, so later steps work on
    patterns instead of items; an item in very many sets is a row per set and never one array.
    """
    rows = df.select(F.col(item).alias("owner"), F.col(owner).alias("item"), F.lit(1.0).alias("weight"))
    classes, _ = equal_owners(rows)
    return rows.join(materialise(classes, "patterns"), "owner").select(
        F.col("owner").alias("_pattern"), F.col("item").alias("name"), F.col("size").alias("n_items")
    )


def all_pairs(sizes: DataFrame, name: str, carry: list[str]) -> DataFrame:
    """(left, right, left_<carry>, right_<carry>) of all names, which is the result a report asks for."""
    rows = materialise(sizes.withColumn("_all", F.lit(0)), "names")
    return pairs_within(rows, "_all", name, carry).drop("_all")


def jaccard_report(df: DataFrame, owner: str, item: str) -> DataFrame:
    """(left, right, shared, jaccard) for all pairs of sets, disjoint ones too."""
    distinct = materialise(df.select(owner, item).distinct(), "sets")
    members = materialise(membership_patterns(distinct, owner, item), "pattern-members")
    sizes = members.groupBy("name").agg(F.sum("n_items").alias("size"))
    shared = pairs_within(members, "_pattern", "name", ["n_items"]).groupBy("left", "right").agg(
        F.sum("left_n_items").alias("shared")
    )
    full = all_pairs(sizes, "name", ["size"]).join(shared, ["left", "right"], "left")
    common = F.coalesce("shared", F.lit(0))
    union = F.col("left_size") + F.col("right_size") - common
    return full.select("left", "right", common.alias("shared"), (common / union).alias("jaccard"))


def common_terms(df: DataFrame, corpus: str, term: str = "term") -> DataFrame:
    """Terms that occur in every corpus."""
    return _in_all(materialise(df.select(corpus, term).distinct(), "terms"), corpus, term)


def _in_all(pairs: DataFrame, corpus: str, term: str) -> DataFrame:
    k = pairs.agg(F.count_distinct(corpus)).scalar()
    return pairs.groupBy(term).agg(F.count_if(F.col(corpus).isNotNull()).alias("_k")).filter(F.col("_k") == k).select(term)


def unique_terms(df: DataFrame, corpus: str, term: str = "term") -> DataFrame:
    """(corpus, term): the vocabulary of each corpus without the terms common to all."""
    pairs = materialise(df.select(corpus, term).distinct(), "terms")
    return pairs.join(_in_all(pairs, corpus, term), term, "left_anti")


def score_table(scores: DataFrame, corpus: str, names: list[str]) -> DataFrame:
    """(term, one score per corpus, mean) of the terms that every listed corpus has."""
    wide = (
        scores.filter(F.col(corpus).isin(names))
        .groupBy("term").pivot(corpus, names).agg(F.max("score"))
        .dropna(subset=names)
    )
    mean = sum((F.col(f"`{n}`") for n in names[1:]), F.col(f"`{names[0]}`")) / len(names)
    return wide.withColumn("mean", mean)


def common_score_table(scores: DataFrame, corpus: str, names: list[str], n: int = 5) -> DataFrame:
    """The n shared terms with the best mean score."""
    return top_rows(score_table(scores, corpus, names), n, [], [F.col("mean").desc(), F.col("term").asc()])


def rank_comparison(scores: DataFrame, corpus: str, names: list[str]) -> DataFrame:
    """(term, one rank per corpus) of the shared terms, ranked among themselves.

    A rank is one plus the number of shared terms with a better score. Scores are counted first,
    so the running sum goes over distinct scores.
    """
    scores = materialise(scores, "scores")
    shared = common_terms(scores.filter(F.col(corpus).isin(names)), corpus)
    kept = scores.join(shared, "term", "left_semi").select(corpus, "term", F.round("score", 9).alias("score"))
    levels = kept.groupBy(corpus, "score").agg(F.count("*").alias("_n"))
    better = running_total(levels, [corpus], [F.col("score").desc()], F.col("_n"), "_upto").select(
        corpus, "score", (F.col("_upto") - F.col("_n") + 1).alias("rank")
    )
    ranked = kept.join(better, [corpus, "score"])
    return ranked.groupBy("term").pivot(corpus, names).agg(F.max("rank"))


def term_space(scores: DataFrame, corpus: str, first: str, second: str) -> DataFrame:
    """(corpus, x, y): every corpus as a point of its scores for two terms, 0 if a term is absent."""
    def score_of(term: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("term") == term, F.col("score"))), F.lit(0.0))

    return scores.groupBy(corpus).agg(score_of(first).alias("x"), score_of(second).alias("y"))


def report_distances(scores: DataFrame, corpus: str) -> DataFrame:
    """(left, right, distance, angle) of every pair of corpora, each a sparse vector over its terms.

    Corpora meet at the terms that they share; |a-b|^2 = |a|^2 + |b|^2 - 2 a.b.
    """
    rows = materialise(
        scores.filter(F.col(corpus).isNotNull()).select(
            F.col(corpus).alias("owner"), F.col("term").alias("item"), F.col("score").alias("weight")
        ),
        "scores",
    )
    norms = rows.groupBy("owner").agg(F.sum(F.col("weight") * F.col("weight")).alias("sq"))
    dots = shared_products(rows).select("left", "right", F.col("dot").alias("_dot"))
    full = all_pairs(norms, "owner", ["sq"]).withColumnsRenamed({"left_sq": "_a", "right_sq": "_b"})
    full = full.join(dots, ["left", "right"], "left").withColumn("_dot", F.coalesce("_dot", F.lit(0.0)))
    cosine = F.try_divide(F.col("_dot"), F.sqrt(F.col("_a") * F.col("_b")))
    return full.select(
        "left", "right",
        F.sqrt(F.greatest(F.col("_a") + F.col("_b") - 2 * F.col("_dot"), F.lit(0.0))).alias("distance"),
        F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))).alias("angle"),
    )
