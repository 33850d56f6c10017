"""Secret scan: candidate strings, and a random forest that tells findings from false alarms."""

from __future__ import annotations

import re

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.tables import as_bytes, map_text
from weftwork.session import materialise

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Labelled findings that the forest is grown on at most, its trees and their depth.
SAMPLE, TREES, DEPTH, SEED = 20_000, 40, 6, 7
#: A candidate is a run of at least so many token characters, or a value of at least so many characters
#: that is assigned to a secret's name.
SHORTEST, ASSIGNED = 16, 4
#: Words beside a candidate that are looked at, on each side, and characters in which they are sought.
BESIDE, REACH = 3, 120

# Words that name a secret, words that mark an example, words that name other numbers, path parts.
NAMES = frozenset(
    "token key apikey api_key secret password passwd pwd pass auth authorization bearer credential credentials "
    "private access client_secret access_key secret_key".split()
)
EXAMPLES = frozenset("example sample test dummy fake placeholder changeme your xxx mock demo todo".split())
OTHERS = frozenset("commit sha sha1 sha256 md5 hash checksum digest uuid guid id revision phone tel card isbn doi version".split())
PATHS = ("test", "example", "sample", "fixture", "mock", "doc", "readme", "config", "env", "lock")

FEATURES = (
    "length", "lower", "upper", "digit", "other", "distinct", "changes", "longest_letters", "hex", "unlike_words",
    "covered", "assigned", "quoted", "names_before", "examples_before", "others_before", "names_after",
    "examples_after", "others_after", "words_before", "path_depth", *(f"path_{p}" for p in PATHS),
)

_ASSIGNMENT = rf"(?<![A-Za-z0-9])(?i:{'|'.join(sorted(NAMES, key=len, reverse=True))})[\"']?\s{{0,9}}[=:]\s{{0,9}}[\"']?"
_CANDIDATE = re.compile(
    rf"{_ASSIGNMENT}(?P<value>[^\s\"'`<>,;]{{{ASSIGNED},}})"
    rf"|(?<![A-Za-z0-9+/=_-])(?P<run>[A-Za-z0-9+/_-][A-Za-z0-9+/=_-]{{{SHORTEST - 1},}})"
)
_WORD = re.compile(r"[A-Za-z][A-Za-z0-9_]*")
_LETTERS = re.compile(r"[a-z]+")
_HEX = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")


class Dictionary:
    """Lower-case words of a tokenizer's vocabulary: cover of letters, and how likely letters follow each other."""

    def __init__(self, words: list[str]):
        self.words = frozenset(w for w in words if len(w) >= 4)
        self.longest = max(map(len, self.words), default=0)
        pairs = np.ones((37, 37))
        for word in words:
            places = [self.place(c) for c in word]
            for a, b in zip(places, places[1:]):
                pairs[a, b] += 1
        self.surprise = -np.log(pairs / pairs.sum(axis=1, keepdims=True))

    @staticmethod
    def place(c: str) -> int:
        return ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) - 48 if "0" <= c <= "9" else 36

    def covered(self, text: str) -> float:
        """Share of characters inside dictionary words, longest first from the left."""
        total = 0
        for run in _LETTERS.finditer(text):
            letters, i = run[0], 0
            while i < len(letters):
                for n in range(min(self.longest, len(letters) - i), 3, -1):
                    if letters[i:i + n] in self.words:
                        total += n
                        i += n
                        break
                else:
                    i += 1
        return total / len(text)

    def unlike_words(self, text: str) -> float:
        places = [self.place(c) for c in text]
        return float(self.surprise[places[:-1], places[1:]].mean())


def load_dictionary(path: str = VOCABULARY) -> Dictionary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size())}
    return Dictionary(sorted(p for p in pieces if _LETTERS.fullmatch(p)))


def _groups(words: list[str]) -> list[float]:
    parts = {p for w in words for p in (w, *w.split("_"))}
    return [float(bool(parts & group)) for group in (NAMES, EXAMPLES, OTHERS)]


def describe(candidate: str, before: str, after: str, path: str, words: Dictionary) -> list[float]:
    """The features of a candidate; before and after are the texts beside it."""
    n = len(candidate)
    kinds = ["lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9" else "other" for c in candidate]
    low = candidate.lower()
    left, right = _WORD.findall(before.lower())[-BESIDE:], _WORD.findall(after.lower())[:BESIDE]
    low_path = path.lower()
    return [
        float(min(n, 1000)), *[kinds.count(k) / n for k in ("lower", "upper", "digit", "other")], len(set(candidate)) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        float(max(map(len, _LETTERS.findall(low)), default=0)) / n, float(bool(_HEX.match(candidate))),
        words.unlike_words(low), words.covered(low),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))), float(before[-1:] in "\"'" and before != ""),
        *_groups(left), *_groups(right), float(len(left)),
        float(low_path.count("/")), *[float(p in low_path) for p in PATHS],
    ]


def find_candidates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, vocabulary: str = VOCABULARY
) -> DataFrame:
    """(key, start, candidate, before, after, features): all candidates of all texts with what stands beside them.

    start counts characters from 0. NULL and empty texts have none; a NULL path is empty; very long texts are
    searched whole. Repeated rows give their findings each; further columns are not read; an empty table gives
    no rows.
    """
    kind = docs.select(key).schema[0].dataType.simpleString()
    words = load_dictionary(vocabulary)
    where = F.lit("") if path is None else F.coalesce(F.col(path).cast("string"), F.lit(""))

    def work(columns: list[list]) -> dict[str, list]:
        out: dict[str, list] = {key: [], "start": [], "candidate": [], "before": [], "after": [], "features": []}
        for row, place, body in zip(*columns):
            body = as_bytes(body).decode("utf-8", "replace")
            for found in _CANDIDATE.finditer(body):
                group = found.lastgroup
                candidate, start, end = found[group], found.start(group), found.end(group)
                before, after = body[max(0, start - REACH):start], body[end:end + REACH]
                for name, value in zip(out, (row, start, candidate, before, after, describe(candidate, before, after, place, words))):
                    out[name].append(value)
        return out

    return map_text(
        docs, [F.col(key), where, F.col(text)], work,
        f"`{key}` {kind}, start int, candidate string, before string, after string, features array<double>",
    )


def judged(findings: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = SAMPLE, accept: float = 0.5) -> DataFrame:
    """findings plus probability and is_secret (1 at or above accept), by a forest grown on labelled ones.

    labels(key, start, secret 0/1) name findings; contradicting and NULL labels are not learned from. At
    most sample labelled findings are used, those with the smallest hash. If all labels agree every
    finding gets that label, without labels all are kept as secrets with probability NULL. Findings that
    repeat a place are judged each; NULL keys are not learned from but judged. Columns of findings named
    probability or is_secret are replaced, all others kept; an empty table gives no rows.
    """
    findings = findings.drop("probability", "is_secret")
    agreed = labels.filter(F.col("secret").isNotNull()).groupBy(key, "start").agg(
        F.min("secret").alias("secret"), F.max("secret").alias("_other")
    ).filter(F.col("secret") == F.col("_other")).drop("_other")
    known = findings.select(key, "start", "features").join(agreed, [key, "start"])
    chosen = materialise(
        known.orderBy(F.xxhash64(key, "start"), key, "start").limit(sample).select(
            array_to_vector("features").alias("features"), F.col("secret").cast("double").alias("label")
        ),
        "labelled_findings",
    )
    kinds = chosen.agg(F.min("label"), F.max("label")).first()
    if kinds[0] is None or kinds[0] == kinds[1]:
        probability = F.lit(kinds[0]).cast("double")
        found = findings.withColumn("probability", probability)
    else:
        forest = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label", probabilityCol="votes",
            rawPredictionCol="raw", predictionCol="class",
        ).fit(chosen)
        # All columns of findings travel as one, so that none clashes with those of the forest.
        scored = forest.transform(findings.select(F.struct("*").alias("finding"), array_to_vector("features").alias("features")))
        found = scored.select("finding.*", vector_to_array("votes")[1].alias("probability"))
    return found.withColumn("is_secret", F.when(F.coalesce("probability", F.lit(1.0)) >= accept, 1).otherwise(0))
