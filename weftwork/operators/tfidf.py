"""TF-IDF in long form: one row per (document, term) with a weight."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.operators import vocabulary as V
from weftwork.operators.ranking import top_rows
from weftwork.session import materialise


def relative_frequencies(counts: DataFrame) -> DataFrame:
    """Adds tf_ratio, the share of the document's tokens; the length came along with the row."""
    return counts.withColumn("tf_ratio", F.col("tf") / F.col("n_tokens"))


def plain_idf(counts: DataFrame, n_docs: DataFrame, corpus: list[str]) -> DataFrame:
    """(corpus, term, df, idf) with idf = ln(N / (1 + df)) + 1."""
    return V.document_frequencies(counts, corpus).join(n_docs, corpus).select(
        *corpus, "term", "df", (F.log(F.col("n_docs") / (1 + F.col("df"))) + 1).alias("idf")
    )


def tfidf_plain(df: DataFrame, corpus: list[str], doc: str, tokens: Column) -> DataFrame:
    """Relative frequency times plain_idf, not normalised."""
    counts = materialise(V.term_counts(df, [*corpus, doc], tokens), "counts")
    idf = materialise(plain_idf(counts, V.document_counts(df, corpus), corpus), "idf")
    return relative_frequencies(counts).join(idf, [*corpus, "term"]).select(
        *corpus, doc, "term", (F.col("tf_ratio") * F.col("idf")).alias("weight")
    )


@dataclass
class Weighted:
    """A document-term matrix: its non-zero cells, its columns and its row counts."""

    weights: DataFrame      # corpus, doc, term, weight
    vocabulary: DataFrame   # corpus, term, df, total_tf, n_docs
    n_docs: DataFrame       # corpus, n_docs


def _fit(
    df: DataFrame, corpus: list[str], doc: str, tokens: Column, max_terms: int | None,
    min_doc_freq: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    counts = materialise(V.term_counts(df, [*corpus, doc], tokens), "counts")
    terms = V.pruned_vocabulary(counts, corpus, min_doc_freq, max_terms)
    n_docs = materialise(V.document_counts(df, corpus), "documents")
    # Written with all that idf needs: the weights then join one table of known size.
    return counts, materialise(terms.join(n_docs, corpus), "vocabulary"), n_docs


def count_vectors(
    df: DataFrame, corpus: list[str], doc: str, tokens: Column, max_terms: int | None = None,
    min_doc_freq: int = 1,
) -> Weighted:
    """Raw counts over the pruned vocabulary."""
    counts, terms, n_docs = _fit(df, corpus, doc, tokens, max_terms, min_doc_freq)
    kept = counts.join(terms.select(*corpus, "term"), [*corpus, "term"])
    return Weighted(
        kept.select(*corpus, doc, "term", F.col("tf").cast("double").alias("weight")), terms, n_docs
    )


def tfidf_matrix(
    df: DataFrame, corpus: list[str], doc: str, tokens: Column, max_terms: int | None = 1000,
    min_doc_freq: int = 2,
) -> Weighted:
    """Count times (ln((1 + N) / (1 + df)) + 1), scaled to length 1 per document.

    N counts all documents of the corpus; the length runs over the surviving terms only.
    """
    counts, terms, n_docs = _fit(df, corpus, doc, tokens, max_terms, min_doc_freq)
    return Weighted(_weigh(counts, terms, corpus, doc), terms, n_docs)


def tfidf_transform(fitted: Weighted, df: DataFrame, corpus: list[str], doc: str, tokens: Column) -> DataFrame:
    """(corpus, doc, term, weight) of other documents, by the vocabulary and idf of a fitted matrix."""
    counts = materialise(V.term_counts(df, [*corpus, doc], tokens), "counts")
    return _weigh(counts, fitted.vocabulary, corpus, doc)


def _weigh(counts: DataFrame, terms: DataFrame, corpus: list[str], doc: str) -> DataFrame:
    idf = terms.select(
        *corpus, "term", (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf")
    )
    raw = counts.join(idf, [*corpus, "term"]).select(
        *corpus, doc, "term", (F.col("tf") * F.col("idf")).alias("raw")
    )
    return scaled(raw, [*corpus, doc], "raw")


def scaled(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Divide every value by the Euclidean length of its row vector, into weight."""
    length = F.sqrt(F.sum(F.col(value) * F.col(value)).over(Window.partitionBy(*keys)))
    return rows.withColumn("weight", F.col(value) / length).drop(value)


def mean_scores(matrix: Weighted, corpus: list[str]) -> DataFrame:
    """(corpus, term, score): mean over all documents, absent cells counting as 0."""
    sums = matrix.weights.groupBy(*corpus, "term").agg(F.sum("weight").alias("_sum"))
    return sums.join(matrix.n_docs, corpus).select(
        *corpus, "term", (F.col("_sum") / F.col("n_docs")).alias("score")
    )


def top_terms(scores: DataFrame, corpus: list[str], n: int = 5) -> DataFrame:
    """(corpus, term, score, rank) of the n best terms."""
    return top_rows(scores, n, corpus, [F.col("score").desc(), F.col("term").asc()], "rank")


def term_importance(weights: DataFrame, n_docs: DataFrame, corpus: list[str], doc: str) -> DataFrame:
    """(corpus, term, doc, avg_tfidf, max_tfidf), one row per document that attains the maximum.

    weights must be a written table: a term that most documents hold is split by AQE.
    """
    stats = weights.groupBy(*corpus, "term").agg(
        F.sum("weight").alias("_sum"), F.max("weight").alias("max_tfidf")
    )
    stats = stats.join(n_docs, corpus).select(
        *corpus, "term", (F.col("_sum") / F.col("n_docs")).alias("avg_tfidf"), "max_tfidf"
    )
    stats = materialise(stats, "term-stats")
    best = weights.withColumnRenamed("weight", "max_tfidf")
    return stats.join(best, [*corpus, "term", "max_tfidf"]).select(
        *corpus, "term", doc, "avg_tfidf", "max_tfidf"
    )


def matrix_shape(matrix: Weighted, corpus: list[str]) -> DataFrame:
    """(corpus, n_rows, n_cols, nnz, sparsity); sparsity in percent, NULL without columns.

    Every document frequency counts non-zero cells, so the cells themselves are not read.
    """
    cells = matrix.vocabulary.groupBy(*corpus).agg(
        F.count("*").alias("n_cols"), F.sum("df").alias("nnz")
    )
    full = F.col("n_rows") * F.col("n_cols")
    shape = matrix.n_docs.join(cells, corpus, "left").select(
        *corpus, F.col("n_docs").alias("n_rows"),
        F.coalesce("n_cols", F.lit(0)).alias("n_cols"), F.coalesce("nnz", F.lit(0)).alias("nnz"),
    )
    return shape.withColumn("sparsity", 100 * (1 - F.try_divide(F.col("nnz"), full)))


@dataclass
class Report:
    vocab_stats: DataFrame
    freq_distribution: DataFrame
    tf_idf_scores: DataFrame
    matrix_shape: DataFrame


def create_report(
    df: DataFrame, corpus: list[str], doc: str, text_tokens: Column, max_terms: int = 1000,
    min_doc_freq: int = 2,
) -> Report:
    """Frequencies, statistics, mean TF-IDF and matrix shape of every corpus at once."""
    freq = materialise(V.frequencies(df, corpus, text_tokens), "frequencies")
    matrix = tfidf_matrix(df, corpus, doc, text_tokens, max_terms, min_doc_freq)
    return Report(
        V.vocabulary_stats(freq, corpus, min_doc_freq),
        V.frequency_table(freq, corpus),
        mean_scores(matrix, corpus),
        matrix_shape(matrix, corpus),
    )
