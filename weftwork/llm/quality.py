"""Document quality by Bradley-Terry ranking: scores are learned from preference pairs."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.llm.tables import as_bytes, fold, map_text
from weftwork.session import materialise

#: Labelled rows of each class that the model is fitted on at most, and pairs per row of the rarer one.
SAMPLE, PAIRS_PER_ROW = 10_000, 16
#: The score at the threshold: rows at or above it are accepted.
ACCEPT = 0.3

FEATURES = (
    "lower", "upper", "digit", "space", "line_end", "mark", "shout", "symbol", "bar", "wide", "control",
    "log_words", "word_length", "distinct_words", "distinct_lines", "decorated_words", "longest_word",
)
_KINDS = FEATURES[:11]
_MARKS, _SYMBOLS = b".,;:'\"?()-", b"#$%&*@^~<>{}[]\\/_=+`"


def _kind_table() -> np.ndarray:
    table = np.full(256, _KINDS.index("control"), np.uint8)
    table[128:] = _KINDS.index("wide")
    groups = {
        "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": b"0123456789", "space": b" \t",
        "line_end": b"\r\n", "mark": _MARKS, "shout": b"!", "symbol": _SYMBOLS, "bar": b"|",
    }
    for name, members in groups.items():
        table[list(members)] = _KINDS.index(name)
    return table


_KIND_OF_BYTE = _kind_table()


def describe(text: str | bytes | None) -> list[float]:
    """The features of a text, all within about 0 to 1; NULL and empty texts have all zeros."""
    data = as_bytes(text)
    if not data:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KIND_OF_BYTE[np.frombuffer(data, np.uint8)], minlength=len(_KINDS)) / len(data)
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n = max(1, len(words))
    decorated = sum(w[-1] in _SYMBOLS or w[-1] in b"!|" for w in words)
    return [
        *kinds.tolist(),
        math.log1p(len(words)) / 10,
        min(1.0, sum(map(len, words)) / n / 20),
        len(set(words)) / n,
        len(set(lines)) / max(1, len(lines)),
        decorated / n,
        min(1.0, max(map(len, words), default=0) / 100),
    ]


def features(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, features) of every row; nothing but the text goes in."""
    kind = docs.select(key).schema[0].dataType.simpleString()

    def work(columns: list[list]) -> dict[str, list]:
        return {key: columns[0], "features": [describe(t) for t in columns[1]]}

    return map_text(docs, [F.col(key), F.col(text)], work, f"`{key}` {kind}, features array<double>")


# ---------------------------------------------------------------- the model

@dataclass(frozen=True)
class Ranking:
    """Strength of a text: weights on its standardised features."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def strength(self, column: str = "features") -> Column:
        parts = [
            F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col(column)[i] - float(m)) / float(s))) * float(w)
            for i, (m, s, w) in enumerate(zip(self.mean, self.spread, self.weights))
        ]
        return sum(parts[1:], parts[0])


def preference_pairs(better: np.ndarray, worse: np.ndarray, per_row: int = PAIRS_PER_ROW) -> np.ndarray:
    """Feature differences better - worse: every row of the rarer class meets per_row of the other."""
    if not len(better) or not len(worse):
        return np.empty((0, len(FEATURES)))
    rare, other = (better, worse) if len(better) < len(worse) else (worse, better)
    left = np.repeat(np.arange(len(rare)), per_row)
    right = np.arange(len(left)) % len(other)
    difference = other[right] - rare[left]
    return -difference if len(better) < len(worse) else difference


def fit(better: np.ndarray, worse: np.ndarray, ridge: float = 1e-3, steps: int = 30) -> Ranking:
    """Minimises the mean of log(1 + exp(-w . difference)) plus a ridge term by Newton steps."""
    rows = np.concatenate([better, worse])
    mean = rows.mean(axis=0) if len(rows) else np.zeros(len(FEATURES))
    spread = rows.std(axis=0) if len(rows) else np.ones(len(FEATURES))
    spread = np.where(spread > 1e-9, spread, 1.0)
    scale = lambda x: np.clip((x - mean) / spread, -8, 8)
    pairs = preference_pairs(scale(better), scale(worse))
    weights = np.zeros(len(FEATURES))
    for _ in range(steps if len(pairs) else 0):
        lose = 1 / (1 + np.exp(np.clip(pairs @ weights, -500, 500)))
        gradient = ridge * weights - pairs.T @ lose / len(pairs)
        curve = (pairs * (lose * (1 - lose))[:, None]).T @ pairs / len(pairs) + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return Ranking(mean, spread, weights)


def _sample(labelled: DataFrame, quality: int, key: str, limit: int) -> np.ndarray:
    """Features of at most limit rows of a class, those with the smallest hash of their key."""
    rows = labelled.filter(F.col("quality") == quality).select(
        F.xxhash64(F.col(key)).alias("_order"), "features"
    ).orderBy("_order", "features").limit(limit).toPandas()
    return np.array(rows["features"].tolist(), np.float64).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Judge:
    """A fitted ranking with its threshold: the strength that scores ACCEPT."""

    ranking: Ranking
    threshold: float

    def score(self, column: str = "features") -> Column:
        shift = math.log(ACCEPT / (1 - ACCEPT))
        return 1 / (1 + F.exp(-(self.ranking.strength(column) - self.threshold + shift)))


def learn(rows: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = SAMPLE) -> Judge:
    """A judge from feature rows (key, features) and labels(key, quality).

    Pairs (quality 1 over quality 0) come from labelled rows outside the held-out fold, at most sample
    rows of each class. The threshold is the quantile of all labelled training rows' strengths at their
    share of quality 0. Labels of one key that disagree, and NULL ones, are not learned from; if a class
    has no labelled row, every text gets the same strength.
    """
    agreed = labels.filter(F.col("quality").isNotNull()).groupBy(key).agg(
        F.min("quality").alias("quality"), F.max("quality").alias("_other")
    ).filter(F.col("quality") == F.col("_other")).select(key, "quality")
    labelled = materialise(rows.filter(fold(key) != 0).join(agreed, key), "labelled")
    ranking = fit(_sample(labelled, 1, key, sample), _sample(labelled, 0, key, sample))
    poor = labelled.agg(F.avg(F.when(F.col("quality") == 0, 1.0).otherwise(0.0))).first()[0] or 0.0
    place = F.percentile_approx(ranking.strength(), F.lit(float(poor)), F.lit(10_000))
    return Judge(ranking, float(labelled.agg(place).first()[0] or 0.0))


def quality_scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """(key, held_out, score, predicted) for every row of docs.

    score is the logistic of strength minus threshold, shifted so that the threshold itself scores
    ACCEPT; predicted = 1 at or above ACCEPT. Without labels of both classes every text scores ACCEPT.
    NULL and empty texts are scored by their (zero) features; repeated rows are scored alike; further
    columns are not looked at.
    """
    rows = materialise(features(docs, key, text), "features")
    judge = learn(rows, labels, key, sample)
    return rows.select(key, (fold(key) == 0).alias("held_out"), judge.score().alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0)
    )


def accepted(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """Rows of docs that score at least ACCEPT.

    Texts are described once to learn and once to filter them where they are: cheaper than a join that
    would move every text.
    """
    judge = learn(materialise(features(docs, key, text), "features"), labels, key, sample)

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return texts.map(describe)

    marked = docs.withColumn("_quality", described(F.col(text).cast("string").cast("binary")))
    return marked.filter(judge.score("_quality") >= ACCEPT).select(*docs.columns)
