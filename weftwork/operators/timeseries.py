"""Term counts per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class UnknownTerms(ValueError):
    """Terms that occur nowhere in the text."""


def missing_terms(df: DataFrame, tokens: Column, terms: list[str]) -> list[str]:
    """Requested terms that occur nowhere; at most one row per requested term reaches the driver."""
    wanted = sorted(set(terms))
    word = F.explode(tokens).alias("term")
    found = df.select(word).filter(F.col("term").isin(wanted)).distinct()
    return sorted(set(wanted) - {row["term"] for row in found.collect()})


def daily_term_counts(
    df: DataFrame, time: str, tokens: Column, terms: list[str], validate: bool = True
) -> DataFrame:
    """(date, term, n) for every date present and every term, 0 where a term does not occur.

    The terms are a short list from the caller: each row is reduced to one count per term in
    place, so days and terms meet without a join and one partially summed shuffle by date
    remains.
    """
    if validate and (missing := missing_terms(df, tokens, terms)):
        raise UnknownTerms(f"terms not in vocabulary: {missing}")
    rows = df.select(F.to_date(time).alias("date"), F.filter(tokens, lambda w: w.isin(terms)).alias("_w"))
    per_day = rows.groupBy("date").agg(
        *[
            F.sum(F.size("_w") - F.size(F.array_remove("_w", term))).cast("long").alias(f"_t{i}")
            for i, term in enumerate(terms)
        ]
    )
    pairs = F.array(
        *[F.struct(F.lit(t).alias("term"), F.col(f"_t{i}").alias("n")) for i, t in enumerate(terms)]
    )
    return per_day.filter(F.col("date").isNotNull()).select("date", F.inline(pairs))
