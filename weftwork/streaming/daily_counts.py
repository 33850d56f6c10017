"""Term counts per day over a stream of posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def streaming_term_counts(
    posts: DataFrame, time: str, tokens: Column, terms: list[str], lateness: str = "2 days"
) -> DataFrame:
    """(date, term, n) of a streaming table; a day is final once the watermark has passed it.

    Rows are reduced to their requested terms in place. State holds one number per open day and
    term. Days without a hit have no row, since a stream cannot know its dates in advance.
    """
    hits = posts.withWatermark(time, lateness).select(
        time, F.explode(F.filter(tokens, lambda w: w.isin(terms))).alias("term")
    )
    counted = hits.groupBy(F.window(time, "1 day").alias("_day"), "term").agg(F.count("*").alias("n"))
    return counted.select(F.to_date("_day.start").alias("date"), "term", "n")
