"""Splitting, naive Bayes as tables, and evaluation reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.operators.ranking import position, top_rows
from weftwork.session import materialise


def split_order(doc: str, seed: int) -> Column:
    """A shuffled order that depends on the key and the seed only."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(doc).cast("string")))


def train_test_split(
    df: DataFrame, doc: str, test_size: float = 0.3, seed: int = 42, exact: bool = True
) -> DataFrame:
    """Adds is_test. Exact: precisely ceil(test_size * n) rows; otherwise each row by its hash alone.

    Neither depends on the partitioning; the second needs no shuffle.
    """
    if not exact:
        share = F.pmod(F.xxhash64(F.lit(seed), F.col(doc)), F.lit(1_000_000)) / 1_000_000.0
        return df.withColumn("is_test", share < test_size)
    order = [split_order(doc, seed).asc(), F.col(doc).asc()]
    ranked = position(df.select(doc), [], order, "_at")
    n = df.agg(F.count("*")).scalar()
    marked = ranked.select(doc, (F.col("_at") < F.ceil(n * F.lit(test_size))).alias("is_test"))
    return df.join(marked, doc)


@dataclass
class NaiveBayes:
    """Multinomial model as tables. A term unseen in a class has that class's default."""

    classes: DataFrame  # label, log_prior, log_default
    terms: DataFrame    # label, term, log_prob (seen pairs only)


def fit_naive_bayes(weights: DataFrame, labels: DataFrame, doc: str, alpha: float = 1.0) -> NaiveBayes:
    """Fit on (doc, term, weight) and (doc, label). Weights may be fractional.

    The prior is the empirical class share. The vocabulary is that of the given weights, so fit
    the weights on all documents to count terms that only occur outside the training part.
    """
    counted = labels.groupBy("label").agg(F.count("*").alias("_n"))
    sums = materialise(
        weights.join(labels.select(doc, "label"), doc).groupBy("label", "term").agg(
            F.sum("weight").alias("_w")
        ),
        "class-terms",
    )
    size = weights.agg(F.count_distinct("term")).scalar()
    n = labels.agg(F.count("*")).scalar()
    totals = counted.join(sums.groupBy("label").agg(F.sum("_w").alias("_sum")), "label", "left").select(
        "label", F.log(F.col("_n") / n).alias("log_prior"),
        (F.coalesce("_sum", F.lit(0.0)) + alpha * size).alias("_base"),
    )
    totals = materialise(totals, "classes")
    terms = sums.join(totals, "label").select(
        "label", "term", F.log((F.col("_w") + alpha) / F.col("_base")).alias("log_prob")
    )
    classes = totals.select("label", "log_prior", F.log(alpha / F.col("_base")).alias("log_default"))
    return NaiveBayes(classes, materialise(terms, "model"))


def class_scores(model: NaiveBayes, docs: DataFrame, weights: DataFrame, doc: str) -> DataFrame:
    """(doc, label, score): log prior plus the weighted log probabilities of the document's terms.

    weights holds terms of the fitted vocabulary only; one that no training document has weighs in
    with the defaults. Each (term, class) seen in training is one row with its gain over the default,
    so a document's words meet only the classes that know them; all classes get the defaults.
    """
    gains = materialise(
        model.terms.join(model.classes, "label").select(
            "term", "label", (F.col("log_prob") - F.col("log_default")).alias("_gain")
        ),
        "gains",
    )
    weights = materialise(weights.select(doc, "term", "weight"), "weights")
    mass = weights.groupBy(doc).agg(F.sum("weight").alias("_mass"))
    sums = weights.join(gains, "term").groupBy(doc, "label").agg(F.sum(F.col("weight") * F.col("_gain")).alias("_gain"))
    every = model.classes.agg(F.collect_list(F.struct("label", "log_prior", "log_default"))).scalar()
    grid = docs.select(doc).join(mass, doc, "left").select(doc, "_mass", F.inline(every))
    zero = F.lit(0.0)
    return grid.join(sums, [doc, "label"], "left").select(
        doc, "label",
        (F.col("log_prior") + F.coalesce("_mass", zero) * F.col("log_default") + F.coalesce("_gain", zero)).alias("score"),
    )


def predict(scores: DataFrame, doc: str) -> DataFrame:
    """(doc, predicted): best class, the smaller label when scores tie at 9 decimals."""
    return scores.groupBy(doc).agg(
        F.min_by("label", F.struct(-F.round("score", 9), F.col("label"))).alias("predicted")
    )


def confusion_matrix(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n) of the pairs that occur."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def classification_report(confusion: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support), then accuracy, macro avg and weighted avg.

    Works on the counts of truth and prediction, a table of at most classes^2 rows. Undefined
    ratios are 0; accuracy stands in the f1 column.
    """
    cells = confusion.select(
        F.inline(
            F.array(
                F.struct(F.col("truth").cast("string").alias("label"), F.col("n").alias("support"),
                         F.lit(0).cast("long").alias("claimed"), F.lit(0).cast("long").alias("hit")),
                F.struct(F.col("predicted").cast("string").alias("label"), F.lit(0).cast("long").alias("support"),
                         F.col("n").alias("claimed"),
                         F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
            )
        )
    )
    per_label = cells.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("_claimed"), F.sum("hit").alias("_hit")
    )
    zero = F.lit(0.0)
    rates = per_label.select(
        "label", "_hit",
        F.coalesce(F.try_divide("_hit", "_claimed"), zero).alias("precision"),
        F.coalesce(F.try_divide("_hit", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("_hit"), F.col("_claimed") + F.col("support")), zero).alias("f1"),
        "support",
    )
    rates = materialise(rates, "rates")
    names = ("precision", "recall", "f1")
    whole = rates.agg(
        F.sum("support").alias("n"), F.sum("_hit").alias("hit"),
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"w_{c}") for c in names],
    )
    accuracy = F.col("hit") / F.col("n")
    summary = whole.select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("label"), accuracy.alias("precision"),
                         accuracy.alias("recall"), accuracy.alias("f1"), F.col("n").alias("support")),
                F.struct(F.lit("macro avg").alias("label"), *[F.col(f"m_{c}").alias(c) for c in names],
                         F.col("n").alias("support")),
                F.struct(F.lit("weighted avg").alias("label"), *[F.col(f"w_{c}").alias(c) for c in names],
                         F.col("n").alias("support")),
            )
        )
    )
    return rates.drop("_hit").unionByName(summary)


def most_informative_features(model: NaiveBayes, n: int = 10) -> DataFrame:
    """(label, term, log_prob, prob, rank) of the n most probable seen terms per class."""
    best = top_rows(model.terms, n, ["label"], [F.round("log_prob", 9).desc(), F.col("term").asc()], "rank")
    return best.withColumn("prob", F.exp("log_prob"))
