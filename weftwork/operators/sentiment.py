"""Lexicon scores of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.functions.text import SPACE, plain, split_words, squeeze

# The demonstration word lists of the simple score.
POSITIVE = (
    "good", "great", "excellent", "happy", "wonderful", "fantastic",
    "amazing", "love", "best", "beautiful", "nice", "perfect",
)
NEGATIVE = (
    "bad", "terrible", "awful", "horrible", "sad", "wrong",
    "hate", "worst", "poor", "disappointing", "negative", "ugly",
)

# Published constants of the rule-based score (Hutto and Gilbert 2014).
BOOST = 0.293
CAPS = 0.733
NEGATION = -0.74
EXCLAMATION = 0.292
ALPHA = 15.0
DISTANCE = (1.0, 0.95, 0.9)
NEGATORS = (
    "not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere", "without",
    "cannot", "can't", "don't", "doesn't", "didn't", "isn't", "wasn't", "won't", "wouldn't",
)
BOOSTERS = ("very", "really", "extremely", "absolutely", "so", "totally", "especially")
DAMPENERS = ("slightly", "somewhat", "barely", "hardly", "almost", "partly", "kinda")


def blank_split(text: Column | str) -> Column:
    """Pieces between white space, punctuation left on."""
    return split_words(squeeze(plain(text)))


def simple_score(text: Column | str) -> Column:
    """Positive minus negative words; a word with punctuation attached does not count."""
    words = blank_split(F.lower(plain(text)))
    hits = F.filter(words, lambda w: w.isin(*POSITIVE, *NEGATIVE))
    return F.aggregate(
        hits, F.lit(0).cast("long"),
        lambda s, w: s + F.when(w.isin(*POSITIVE), F.lit(1)).otherwise(F.lit(-1)).cast("long"),
    )


def all_caps(text: Column) -> Column:
    return (F.upper(text) == text) & (F.lower(text) != text)


def lexicon_scores(df: DataFrame, doc: str, text: str, lexicons: dict[str, DataFrame]) -> DataFrame:
    """(doc, one sum of valences per lexicon), 0 for a text without a hit.

    All lexicons are stacked into one table (word, lexicon, valence), so the words are exploded
    and joined once; words without a valence drop out in the join, before anything is shuffled
    by document.
    """
    stacked = None
    for name, words in lexicons.items():
        part = words.select("word", F.lit(name).alias("_lexicon"), F.col("valence").cast("double"))
        stacked = part if stacked is None else stacked.unionByName(part)
    rows = df.select(doc, F.explode(blank_split(F.lower(plain(text)))).alias("word"))
    sums = rows.join(stacked, "word").groupBy(doc).agg(
        *[
            F.sum(F.when(F.col("_lexicon") == name, F.col("valence"))).alias(name)
            for name in lexicons
        ]
    )
    return df.select(doc).join(sums, doc, "left").select(
        doc, *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in lexicons]
    )


def _kind(word: Column) -> Column:
    return F.when(word.isin(*BOOSTERS), "+").when(word.isin(*DAMPENERS), "-").when(word.isin(*NEGATORS), "!").otherwise("")


def rule_scores(df: DataFrame, doc: str, text: str, lexicon: DataFrame) -> DataFrame:
    """(doc, polarity, compound, positive, negative, neutral) with context rules.

    The three words before each word are read inside the row, so a word row already carries
    its negation, booster and capital-letter factors when it meets the lexicon.
    """
    body = plain(text)
    raw = blank_split(body)
    edge = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
    words = F.transform(raw, lambda w: F.regexp_replace(w, edge, ""))
    bare = df.select(
        doc, F.explode(F.array(words)).alias("_w"),
        F.least(F.regexp_count(body, F.lit("!")), F.lit(4)).alias("_bangs"),
        (~all_caps(body)).alias("_mixed"),
    )
    # Lower case, and whether a word strengthens, weakens or negates, once per word and not per word behind it.
    lowered = bare.withColumn("_low", F.explode(F.array(F.transform("_w", F.lower))))
    base = lowered.withColumn("_kind", F.explode(F.array(F.transform("_low", _kind))))

    def before(i: Column, k: int) -> Column:
        return F.coalesce(F.when(i >= k, F.get("_kind", i - k)), F.lit(""))

    def context(w: Column, i: Column) -> Column:
        near = [before(i, k) for k in (1, 2, 3)]
        boost = F.lit(0.0)
        for kind, weight in zip(near, DISTANCE):
            boost = boost + F.when(kind == "+", weight * BOOST).when(kind == "-", -weight * BOOST).otherwise(0.0)
        negated = (near[0] == "!") | (near[1] == "!") | (near[2] == "!")
        return F.struct(
            F.get("_low", i).alias("word"), boost.alias("boost"), negated.alias("negated"),
            (all_caps(w) & F.col("_mixed")).alias("caps"),
        )

    rows = base.select(doc, "_bangs", F.size("_w").alias("_n"), F.inline(F.transform("_w", context)))
    sign = F.signum("valence")
    force = F.col("valence") + sign * (F.when(F.col("caps"), CAPS).otherwise(0.0) + F.col("boost"))
    hits = rows.join(lexicon.select("word", F.col("valence").cast("double")), "word").withColumn(
        "force", force * F.when(F.col("negated"), NEGATION).otherwise(1.0)
    )
    sums = hits.groupBy(doc).agg(
        F.sum("force").alias("_sum"), F.avg("valence").alias("_polarity"),
        F.sum(F.when(F.col("force") > 0, F.col("force") + 1).otherwise(0.0)).alias("_up"),
        F.sum(F.when(F.col("force") < 0, 1 - F.col("force")).otherwise(0.0)).alias("_down"),
        (F.max("_n") - F.count_if(F.col("force") != 0)).alias("_flat"), F.max("_bangs").alias("_bangs"),
    )
    loud = F.col("_sum") + F.signum("_sum") * F.col("_bangs") * EXCLAMATION
    extra = F.col("_bangs") * EXCLAMATION
    up = F.col("_up") + F.when(F.col("_up") > F.col("_down"), extra).otherwise(0.0)
    down = F.col("_down") + F.when(F.col("_up") < F.col("_down"), extra).otherwise(0.0)
    whole = up + down + F.col("_flat")
    scored = sums.select(
        doc, F.col("_polarity").alias("polarity"),
        (loud / F.sqrt(loud * loud + ALPHA)).alias("compound"),
        F.try_divide(up, whole).alias("positive"), F.try_divide(down, whole).alias("negative"),
        F.try_divide(F.col("_flat").cast("double"), whole).alias("neutral"),
    )
    empty = F.size(raw) == 0
    return df.select(doc, empty.alias("_empty")).join(scored, doc, "left").select(
        doc,
        *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 3).alias(c)
          for c in ("polarity", "compound", "positive", "negative")],
        F.round(F.coalesce("neutral", F.when(F.col("_empty"), 0.0).otherwise(1.0)), 3).alias("neutral"),
    )


def compare_scores(df: DataFrame, doc: str, text: str, lexicon: DataFrame) -> DataFrame:
    """(doc, simple_score, polarity, compound, positive, negative, neutral), rounded to 3."""
    simple = df.select(doc, simple_score(text).alias("simple_score"))
    return simple.join(rule_scores(df, doc, text, lexicon), doc)


def disagreement_notes(text: Column, simple: Column, first: Column, second: Column) -> list[Column]:
    """Flags: scores far apart, emphasis as the likely cause, negation missed by the simple score."""
    apart = F.abs(first - second) > 0.3
    loud = text.contains("!!!") | all_caps(text)
    missed = F.lower(text).contains("not") & (F.abs(simple) > 0)
    return [
        apart.alias("substantial_difference"),
        (apart & loud).alias("emphasis_likely"),
        missed.alias("negation_missed"),
    ]
