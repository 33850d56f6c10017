"""Word counts per document and per corpus, vocabularies, and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.operators.ranking import position, running_total, top_rows


def term_rows(df: DataFrame, keys: list[str], tokens: Column, term: str = "term") -> DataFrame:
    """One row per occurrence of a word."""
    return df.select(*keys, F.explode(tokens).alias(term))


def term_counts(df: DataFrame, keys: list[str], tokens: Column) -> DataFrame:
    """(keys, n_tokens, term, tf), one row per distinct word of each input row.

    The words of a row are sorted in place and counted by the length of their runs, so nothing is
    shuffled. The one-element explode keeps the planner from repeating the tokeniser in the
    lambdas.
    """
    words = df.select(*keys, F.explode(F.array(F.sort_array(tokens))).alias("_w"))
    words = words.filter(F.size("_w") > 0)
    n = F.size("_w")
    first = F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (i == 1) | (F.get("_w", i - 1) != F.get("_w", i - 2)),
    )
    runs = words.select(*keys, "_w", F.explode(F.array(first)).alias("_first"))
    counted = F.transform(
        "_first",
        lambda at, i: F.struct(
            F.get("_w", at - 1).alias("term"),
            (F.coalesce(F.get("_first", i + 1), n + 1) - at).cast("long").alias("tf"),
        ),
    )
    return runs.select(*keys, n.cast("long").alias("n_tokens"), F.inline(counted))


def frequencies(df: DataFrame, corpus: list[str], tokens: Column, mode: str = "count") -> DataFrame:
    """(corpus, word, frequency). Mode "presence" counts every word once."""
    rows = term_rows(df, corpus, tokens, "word")
    if mode == "presence":
        return rows.distinct().withColumn("frequency", F.lit(1).cast("long"))
    if mode != "count":
        raise ValueError("mode must be count or presence")
    return rows.groupBy(*corpus, "word").agg(F.count("*").alias("frequency"))


def frequency_table(freq: DataFrame, corpus: list[str]) -> DataFrame:
    """Adds the share of all words in percent and its running sum, most frequent word first."""
    ranked = running_total(
        freq, corpus, [F.col("frequency").desc(), F.col("word").asc()], F.col("frequency"),
        "_running", total="_all",
    )
    return ranked.select(
        *corpus, "word", "frequency",
        (F.col("frequency") / F.col("_all") * 100).alias("percentage"),
        (F.col("_running") / F.col("_all") * 100).alias("cumulative_percentage"),
    )


def vocabulary_stats(freq: DataFrame, corpus: list[str], min_freq: int = 2, top: int = 1000) -> DataFrame:
    """Totals per corpus and the share of all words that the top words cover."""
    totals = freq.groupBy(*corpus).agg(
        F.sum("frequency").alias("total_words"),
        F.count("*").alias("unique_words"),
        F.count_if(F.col("frequency") >= min_freq).alias("words_min_freq"),
    )
    head = top_rows(freq, top, corpus, [F.col("frequency").desc(), F.col("word").asc()])
    covered = head.groupBy(*corpus).agg(F.sum("frequency").alias("_covered"))
    share = F.when(F.col("unique_words") < top, F.lit(100.0)).otherwise(
        F.col("_covered") / F.col("total_words") * 100
    )
    return totals.join(covered, corpus).select(
        *corpus, "total_words", "unique_words", "words_min_freq", share.alias("coverage_top_1000")
    )


def vocabulary_index(df: DataFrame, corpus: list[str], tokens: Column) -> DataFrame:
    """(corpus, term, idx): distinct terms in order, counted from 0."""
    terms = term_rows(df, corpus, tokens).distinct()
    return position(terms, corpus, [F.col("term").asc()], "idx")


def document_counts(df: DataFrame, corpus: list[str]) -> DataFrame:
    """Documents per corpus, those without any word included."""
    return df.groupBy(*corpus).agg(F.count("*").alias("n_docs"))


def document_frequencies(counts: DataFrame, corpus: list[str]) -> DataFrame:
    """(corpus, term, df, total_tf) from term_counts, partially summed before the shuffle."""
    return counts.groupBy(*corpus, "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("total_tf")
    )


def pruned_vocabulary(
    counts: DataFrame, corpus: list[str], min_doc_freq: int = 1, max_terms: int | None = None
) -> DataFrame:
    """Terms in at least min_doc_freq documents, then the max_terms most used ones per corpus."""
    terms = document_frequencies(counts, corpus).filter(F.col("df") >= min_doc_freq)
    if max_terms is None:
        return terms
    return top_rows(terms, max_terms, corpus, [F.col("total_tf").desc(), F.col("term").asc()])
