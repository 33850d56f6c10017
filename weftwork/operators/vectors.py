"""Similarity of terms and documents in long form, and their coordinates in the plane."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.operators.pairs import cosine_classes
from weftwork.operators.ranking import position, top_rows
from weftwork.operators.similarity import open_classes
from weftwork.session import materialise

#: Matrix cells that a task holds over all corpora before it passes sums on.
CELLS = 4_000_000


def _partial_products(n: int):
    """Sum of x'x over the feature rows of every corpus in a task, passed on as (corpus, i, j, dot)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict = {}

        def sums() -> Iterator[pd.DataFrame]:
            for corpus, total in totals.items():
                i, j = np.nonzero(np.triu(total))
                yield pd.DataFrame({"_group": corpus, "i": i, "j": j, "dot": total[i, j]})
            totals.clear()

        for batch in batches:
            for corpus, rows in batch.groupby("_group"):
                sizes = rows["at"].map(len).to_numpy()
                row = np.repeat(np.arange(len(rows)), sizes)
                block = np.zeros((len(rows), n))
                np.add.at(block, (row, np.concatenate(rows["at"].to_numpy())), np.concatenate(rows["w"].to_numpy()))
                if corpus not in totals and (len(totals) + 1) * n * n > CELLS:
                    yield from sums()
                totals[corpus] = totals.get(corpus, 0) + block.T @ block
        yield from sums()

    return run


def term_similarities(
    weights: DataFrame, scores: DataFrame, corpus: list[str], doc: str, n_terms: int = 10
) -> DataFrame:
    """(corpus, left, right, cosine, distance) for the n_terms best-scored terms of each corpus.

    Terms are numbered inside their corpus, and products are summed inside the tasks as one matrix
    of n_terms^2 cells per corpus; only those are shuffled. Term pairs are not written out per
    document.
    """
    order = [F.col("score").desc(), F.col("term").asc()]
    chosen = top_rows(scores, n_terms, corpus, order, "_place") if corpus else top_rows(scores, n_terms, [], order).withColumn(
        "_place", F.row_number().over(Window.orderBy(*order))
    )
    name = F.struct(*corpus) if corpus else F.struct(F.lit(0).alias("all"))
    numbered = materialise(
        chosen.select(*corpus, "term", (F.col("_place") - 1).alias("at"), F.to_json(name).alias("_group")), "numbered"
    )
    lists = weights.join(numbered, [*corpus, "term"]).groupBy("_group", doc).agg(
        F.collect_list(F.struct("at", "weight")).alias("_v")
    )
    parts = lists.select("_group", F.col("_v.at").alias("at"), F.col("_v.weight").alias("w")).mapInPandas(
        _partial_products(n_terms), "_group string, i int, j int, dot double"
    )
    dots = materialise(parts.groupBy("_group", "i", "j").agg(F.sum("dot").alias("dot")), "dots")
    square = dots.filter(F.col("i") == F.col("j"))
    left = numbered.select("_group", *corpus, F.col("term").alias("left"), F.col("at").alias("_l"))
    right = numbered.select("_group", F.col("term").alias("right"), F.col("at").alias("_r"))
    pairs = left.join(right, "_group").filter(F.col("left") < F.col("right")).withColumns(
        {"i": F.least("_l", "_r"), "j": F.greatest("_l", "_r")}
    )
    pairs = (
        pairs.join(dots, ["_group", "i", "j"], "left")
        .join(square.select("_group", "i", F.col("dot").alias("_a")), ["_group", "i"], "left")
        .join(square.select("_group", "j", F.col("dot").alias("_b")), ["_group", "j"], "left")
    )
    cosine = F.coalesce(F.try_divide(F.col("dot"), F.sqrt(F.col("_a") * F.col("_b"))), F.lit(0.0))
    return pairs.select(*corpus, "left", "right", cosine.alias("cosine")).withColumn(
        "distance", 1 - F.col("cosine")
    )


def similarity_edges(similarities: DataFrame, threshold: float = 0.3) -> DataFrame:
    return similarities.filter(F.col("cosine") > threshold)


def document_similarities(weights: DataFrame, doc: str, bound: float) -> tuple[DataFrame, DataFrame]:
    """All document pairs with cosine >= bound, equal documents taken together.

    See pairs.cosine_classes for the two tables. weights must have length 1 per document.
    """
    rows = weights.select(F.col(doc).alias("owner"), F.col("term").alias("item"), "weight")
    return cosine_classes(rows, bound)


def expand_classes(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(left, right, similarity) for every single pair behind document_similarities."""
    found = pairs.select("left", "right", F.col("similarity").alias("score"))
    return open_classes(found, members, None).withColumnRenamed("score", "similarity")


def plane_coordinates(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, x, y): the two leading principal components of an array column.

    Signs are fixed so that the largest loading of each component is positive.
    """
    rows = df.select(label, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    model = PCA(k=2, inputCol="_v", outputCol="_pc").fit(rows)
    loading = model.pc.toArray()
    signs = [float(np.sign(loading[np.abs(loading[:, k]).argmax(), k]) or 1.0) for k in range(2)]
    points = model.transform(rows).select(label, vector_to_array("_pc").alias("_xy"))
    return points.select(label, *[(F.get("_xy", F.lit(k)) * signs[k]).alias("xy"[k]) for k in range(2)])


def dense_rows(docs: DataFrame, weights: DataFrame, doc: str, terms: list[str]) -> DataFrame:
    """(doc, vector) of every row of docs: the cells of the listed terms as an array, in their order.

    A document without any of them has a vector of zeros.
    """
    listed = F.array(*[F.lit(t) for t in terms])
    found = weights.filter(F.col("term").isin(terms)).groupBy(doc).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("_m")
    )
    zero = F.lit(0.0)
    vector = F.transform(listed, lambda t: F.coalesce(F.try_element_at("_m", t), zero))
    return docs.select(doc).join(found, doc, "left").select(doc, vector.alias("vector"))


def _scaled(corpus: list[str]):
    """Classical scaling of one corpus: the leading two axes of the centred squared distances."""
    def run(pairs: pd.DataFrame) -> pd.DataFrame:
        terms = sorted(set(pairs["left"]) | set(pairs["right"]))
        at = {t: i for i, t in enumerate(terms)}
        d = np.zeros((len(terms), len(terms)))
        i, j = pairs["left"].map(at).to_numpy(), pairs["right"].map(at).to_numpy()
        d[i, j] = d[j, i] = pairs["distance"].to_numpy()
        centre = np.eye(len(terms)) - 1.0 / len(terms)
        values, axes = np.linalg.eigh(-0.5 * centre @ (d * d) @ centre)
        axes = axes[:, ::-1][:, :2] * np.sqrt(np.maximum(values[::-1][:2], 0.0))
        for k in range(axes.shape[1]):
            if axes[np.abs(axes[:, k]).argmax(), k] < 0:
                axes[:, k] *= -1
        out = pd.DataFrame({"term": terms, "x": axes[:, 0], "y": axes[:, 1]})
        for c in corpus:
            out[c] = pairs[c].iloc[0]
        return out[[*corpus, "term", "x", "y"]]

    return run


def term_coordinates(similarities: DataFrame, corpus: list[str]) -> DataFrame:
    """(corpus, term, x, y) from term_similarities, whose chosen terms per corpus are n_terms.

    Classical scaling of the distances 1 - cosine, one task per corpus on its n_terms^2 / 2 pairs.
    """
    kept = similarities.select(*corpus, "left", "right", "distance")
    kinds = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in corpus)
    return kept.groupBy(*corpus).applyInPandas(
        _scaled(corpus), f"{kinds + ', ' if kinds else ''}term string, x double, y double"
    )


def highlight_top(scores: DataFrame, group: list[str], n: int = 5) -> DataFrame:
    """Adds highlighted, true for the n items with the best score of their group."""
    best = top_rows(scores, n, group, [F.col("score").desc(), F.col("term").asc()])
    marked = best.select(*group, "term", F.lit(True).alias("_top"))
    return scores.join(marked, [*group, "term"], "left").withColumn(
        "highlighted", F.coalesce("_top", F.lit(False))
    ).drop("_top")


def colour_groups(df: DataFrame, label: str | Column, out: str = "colour") -> DataFrame:
    """Adds a dense group number per label, in label order, from 0."""
    label = F.col(label) if isinstance(label, str) else label
    labelled = df.withColumn("_label", label)
    numbers = position(labelled.select("_label").distinct(), [], [F.col("_label").asc()], out)
    return labelled.join(numbers, "_label").drop("_label")
