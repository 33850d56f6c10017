"""The full cleaning chain as a table job, with an optional lemma lexicon."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.functions import text as T
from weftwork.operators.lexicon import lemmatise


def preprocess(
    df: DataFrame, text: str, out: str = "clean",
    stop_words: Iterable[str] = T.ENGLISH_STOP_WORDS, lexicon: DataFrame | None = None,
    doc: str | None = None, tags: DataFrame | None = None,
) -> DataFrame:
    """Clean text into out: full tokens without stop words, lemmas, then words over two characters.

    Without a lexicon the whole chain stays inside the row. With one, the words of each document
    (doc) are joined to it and put back in their order; tags(term, tag) marks verbs, all other
    words are looked up as nouns.
    """
    words = T.without_stop_words(T.full_tokens(text), stop_words)
    if lexicon is None:
        return df.withColumn(out, F.array_join(T.longer_than(words, 2), " "))
    if doc is None:
        raise ValueError("a lexicon needs the document key")
    rows = df.select(doc, F.posexplode(words).alias("_at", "term"))
    tag = None
    if tags is not None:
        rows = rows.join(tags, "term", "left")
        tag = F.when(F.col("tag").startswith("V"), "V").otherwise("N")
    kept = lemmatise(rows, lexicon, tag=tag).filter(F.char_length("lemma") > 2)
    # One group is one document, which already fitted into a row.
    texts = kept.groupBy(doc).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_at", "lemma"))), lambda x: x["lemma"]),
            " ",
        ).alias(out)
    )
    return df.join(texts, doc, "left").withColumn(out, F.coalesce(out, F.lit("")))
