"""Document probability by a subword lattice: all segmentations of a text, weighted by unigram scores."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.tables import as_bytes, fold, map_text
from weftwork.session import materialise

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Marks the start of a word in the vocabulary.
START = "▁"
#: Words whose scores are sent to every task, and the longest of them in bytes. All others are joined.
COMMON, COMMON_BYTES = 100_000, 64
#: Words that a task counts before it passes its counts on, and characters of words in a lattice at once.
COUNTED, CELLS = 300_000, 400_000
#: Times that the scores are re-estimated.
ROUNDS = 3
#: Weight of the vocabulary's own order against the training text, in pieces.
PRIOR = 1000.0
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = 0xCBF29CE484222325


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return as_bytes(text).lower().split()


# ---------------------------------------------------------------- vocabulary and lattice

@dataclass(frozen=True)
class Vocabulary:
    """Pieces with log scores, the log scores of single bytes, and a hash table over all prefixes of pieces."""

    pieces: list[str]
    log_piece: np.ndarray
    log_byte: np.ndarray
    log_end: float
    keys: np.ndarray
    piece_at: np.ndarray  # -2 empty, -1 only a prefix
    probes: int
    slot_bits: int

    def with_scores(self, counts: np.ndarray, ends: float, prior: float = PRIOR) -> Vocabulary:
        """Scores from expected counts of pieces and bytes and the number of texts, mixed with the present ones."""
        now = np.exp(np.concatenate([self.log_piece, self.log_byte]))
        mixed = counts + prior * now / now.sum()
        ends = ends + prior * math.exp(self.log_end)
        logs = np.log(mixed) - math.log(mixed.sum() + ends)
        n = len(self.pieces)
        return Vocabulary(self.pieces, logs[:n], logs[n:], math.log(ends / (mixed.sum() + ends)), self.keys, self.piece_at, self.probes, self.slot_bits)


def _longer(key: int, c: str) -> int:
    """The key of a prefix that goes on with c."""
    return ((key ^ ord(c)) * int(_PRIME)) & (2**64 - 1)


def load_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """The pieces of a sentencepiece model. Its scores give the order; a piece of rank r starts with a
    weight of 1 / r, and the 256 bytes, which can spell any text, share a hundredth."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    held = [
        (-model.get_score(i), model.id_to_piece(i)) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return vocabulary([piece for _, piece in sorted(held)])


def vocabulary(pieces: list[str]) -> Vocabulary:
    weight = 1.0 / np.arange(1, len(pieces) + 1)
    log_piece = np.log(0.98 * weight / weight.sum())
    number_of: dict[int, int] = {}  # prefix to its piece, -1 if it is none
    for number, piece in enumerate(pieces):
        key = _EMPTY
        for c in piece:
            key = _longer(key, c)
            number_of.setdefault(key, -1)
        if piece:
            number_of[key] = number
    # At least two slots a prefix; a prefix whose slot is taken goes on to the next free one, which
    # may lie behind the last slot.
    slot_bits = max(8, (2 * len(number_of)).bit_length())
    taken: dict[int, int] = {}
    probes = 1
    for key in number_of:
        home = slot = key >> (64 - slot_bits)
        while slot in taken:
            slot += 1
        taken[slot] = key
        probes = max(probes, slot - home + 1)
    keys, piece_at = np.zeros((1 << slot_bits) + probes, np.uint64), np.full((1 << slot_bits) + probes, -2, np.int32)
    for slot, key in taken.items():
        keys[slot], piece_at[slot] = key, number_of[key]
    return Vocabulary(pieces, log_piece, np.full(256, math.log(0.01 / 256)), math.log(0.01), keys, piece_at, probes, slot_bits)


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(characters with the start mark in front, lengths); words must come longest first."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    flat = np.frombuffer((START + START.join(words)).encode("utf-32-le", "surrogatepass"), np.uint32)
    table = np.zeros((len(words), int(lengths[0])), np.uint32)
    table[np.arange(table.shape[1]) < lengths[:, None]] = flat
    return table, lengths


def _edges(v: Vocabulary, table: np.ndarray, lengths: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(end, rows, pieces) of all pieces that begin at a position."""
    rows = np.arange(int(np.searchsorted(-lengths, -start, side="left")))
    key = np.full(len(rows), _EMPTY, np.uint64)
    for end in range(start + 1, table.shape[1] + 1):
        inside = lengths[rows] >= end
        rows = rows[inside]
        if not len(rows):
            return
        key = (key[inside] ^ table[rows, end - 1]) * _PRIME
        slot = (key >> np.uint64(64 - v.slot_bits)).astype(np.int64)
        piece = np.full(len(rows), -2, np.int32)
        for step in range(v.probes):
            same = v.keys[slot + step] == key
            piece[same] = v.piece_at[slot[same] + step]
        known = piece > -2
        rows, key, piece = rows[known], key[known], piece[known]
        whole = piece >= 0
        yield end, rows[whole], piece[whole]


def _spelled(v: Vocabulary, table: np.ndarray) -> np.ndarray:
    """Log score of every character spelled in bytes."""
    chars, where = np.unique(table, return_inverse=True)
    scores = np.array([v.log_byte[list(chr(c).encode("utf-8", "surrogatepass"))].sum() for c in chars.tolist()])
    return scores[where].reshape(table.shape)


def _forward(v: Vocabulary, table: np.ndarray, lengths: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(log sum over all segmentations of every prefix, byte scores); keep collects the edges."""
    alpha = np.full((len(table), table.shape[1] + 1), -np.inf)
    alpha[:, 0] = 0.0
    spelled = _spelled(v, table)
    for start in range(table.shape[1]):
        n = int(np.searchsorted(-lengths, -start, side="left"))
        alpha[:n, start + 1] = np.logaddexp(alpha[:n, start + 1], alpha[:n, start] + spelled[:n, start])
        for end, rows, piece in _edges(v, table, lengths, start):
            alpha[rows, end] = np.logaddexp(alpha[rows, end], alpha[rows, start] + v.log_piece[piece])
            if keep is not None:
                keep.append((start, end, rows, piece))
    return alpha, spelled


def _parts(words: list[str]) -> Iterator[np.ndarray]:
    """Indexes of words of similar length, longest first, as many as CELLS allows."""
    order = np.argsort([-len(w) for w in words], kind="stable")
    start = 0
    while start < len(order):
        n = max(1, CELLS // (len(words[order[start]]) + 1))
        yield order[start:start + n]
        start += n


def word_scores(v: Vocabulary, words: list[str]) -> np.ndarray:
    """Natural log of the probability of every word: the sum over all its segmentations."""
    out = np.zeros(len(words))
    for part in _parts(words):
        table, lengths = _matrix([words[i] for i in part])
        out[part] = _forward(v, table, lengths)[0][np.arange(len(part)), lengths]
    return out


def expected_counts(v: Vocabulary, words: list[str], times: np.ndarray) -> np.ndarray:
    """How often each piece, then each byte, is expected in words that occur so many times."""
    n = len(v.pieces)
    total = np.zeros(n + 256)
    for part in _parts(words):
        table, lengths = _matrix([words[i] for i in part])
        edges: list = []
        alpha, spelled = _forward(v, table, lengths, edges)
        rows = np.arange(len(part))
        whole, weight = alpha[rows, lengths], times[part].astype(np.float64)
        beta = np.full(alpha.shape, -np.inf)
        beta[rows, lengths] = 0.0
        for start in range(table.shape[1] - 1, -1, -1):
            m = int(np.searchsorted(-lengths, -start, side="left"))
            back = spelled[:m, start] + beta[:m, start + 1]
            share = np.exp(alpha[:m, start] + back - whole[:m]) * weight[:m]
            beta[:m, start] = np.logaddexp(beta[:m, start], back)
            chars, where = np.unique(table[:m, start], return_inverse=True)
            for c, times_c in zip(chars.tolist(), np.bincount(where, share).tolist()):
                for b in chr(c).encode("utf-8", "surrogatepass"):
                    total[n + b] += times_c
            while edges and edges[-1][0] == start:
                _, end, at, piece = edges.pop()
                back = v.log_piece[piece] + beta[at, end]
                beta[at, start] = np.logaddexp(beta[at, start], back)
                total[:n] += np.bincount(piece, np.exp(alpha[at, start] + back - whole[at]) * weight[at], n)
    return total


# ---------------------------------------------------------------- corpus

def word_counts(docs: DataFrame, key: str, text: str, held_out: int) -> DataFrame:
    """(word, times, trained): how often each word occurs in all texts, and in those of the training folds."""
    source = docs.select(F.col(text).cast("string").cast("binary").alias("t"), (fold(key) != held_out).alias("train"))
    schema = pa.schema([("word", pa.string()), ("times", pa.int64()), ("trained", pa.int64())])

    def table(counts: Counter, trained: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "word": [w.decode("utf-8", "replace") for w in counts], "times": list(counts.values()),
            "trained": [n if trained else 0 for n in counts.values()],
        }, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {True: Counter(), False: Counter()}
        for batch in batches:
            for i in range(batch.num_rows):
                trained = batch.column(1)[i].as_py()
                counts[trained].update(words_of(batch.column(0)[i].as_py()))
                if len(counts[trained]) > COUNTED:
                    yield table(counts[trained], trained)
                    counts[trained] = Counter()
        for trained, held in counts.items():
            if held:
                yield table(held, trained)

    return source.mapInArrow(run, "word string, times long, trained long").groupBy("word").agg(
        F.sum("times").alias("times"), F.sum("trained").alias("trained")
    )


def train(words: DataFrame, texts: int, start: Vocabulary) -> Vocabulary:
    """Scores re-estimated from the expected counts of pieces over all training words.

    What reaches the driver in a round is one number for every piece of the vocabulary.
    """
    for _ in range(ROUNDS):
        start = _round(words, texts, start)
    return start


def _round(words: DataFrame, texts: int, start: Vocabulary) -> Vocabulary:
    n = len(start.pieces) + 256

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n)
        for part in parts:
            total += expected_counts(start, part["word"].tolist(), part["trained"].to_numpy())
        used = np.flatnonzero(total)
        yield pd.DataFrame({"piece": used, "expected": total[used]})

    sums = words.filter(F.col("trained") > 0).select("word", "trained").mapInPandas(run, "piece long, expected double")
    found = sums.groupBy("piece").agg(F.sum("expected").alias("expected")).toPandas()
    counts = np.zeros(n)
    counts[found["piece"].to_numpy()] = found["expected"].to_numpy()
    return start.with_scores(counts, float(texts))


def text_scores(
    docs: DataFrame, key: str = "doc_id", text: str = "text", held_out: int = 1, path: str = VOCABULARY,
    common: int = COMMON,
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs.

    Tokens are the words and one end; texts outside the held-out fold are learned from. base_score adds
    log10((c + 0.5) / (N + 0.5 (V + 1))) over tokens; score is log10 of the sum, over all ways to cut
    the words into pieces of the vocabulary (or bytes), of the product of piece probabilities, times
    that of the end. Pieces do not cross words, so a text's sum is the product of its words' sums.
    NULL and empty texts consist of the end; without a training text every count is 0. Words are
    counted over all texts; the common ones are looked up in the task, all others are joined.
    Repeated rows are scored alike; further columns are not looked at.
    """
    counted = materialise(word_counts(docs, key, text, held_out), "words")
    totals = counted.agg(
        F.coalesce(F.sum("trained"), F.lit(0)), F.count_if(F.col("trained") > 0)
    ).first()
    texts = docs.filter(fold(key) != held_out).count()
    tokens, kinds = totals[0] + texts, totals[1] + (texts > 0)
    model = train(counted, texts, load_vocabulary(path))
    base = math.log10(tokens + 0.5 * (kinds + 1))

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            logs = word_scores(model, part["word"].tolist()) / math.log(10)
            yield part.assign(base=np.log10(part["trained"] + 0.5) - base, log_word=logs)

    words = materialise(
        counted.mapInPandas(score, "word string, times long, trained long, base double, log_word double"), "word_scores"
    )
    frequent = words.filter(F.octet_length("word") <= COMMON_BYTES).orderBy(F.col("times").desc(), "word").limit(common)
    known = {
        w.encode(): (c > 0, b, s) for w, c, b, s in frequent.select("word", "trained", "base", "log_word").toPandas().itertuples(index=False)
    }
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kind = docs.select(key).schema[0].dataType.simpleString()
    end = (texts > 0, math.log10(texts + 0.5) - base, model.log_end / math.log(10))

    def look_up(columns: list[list]) -> dict[str, list]:
        scores, out = shared.value, []
        for row, own, body in zip(*columns):
            words = words_of(body)
            n_known, sum_base, sum_log, rest = int(end[0]), end[1], end[2], []
            for word, times in Counter(words).items():
                found = scores.get(word)
                if found is None:
                    rest.append((word.decode("utf-8", "replace"), times))
                else:
                    n_known += times * found[0]
                    sum_base += times * found[1]
                    sum_log += times * found[2]
            out.append((row, own, len(words) + 1, n_known, sum_base, sum_log, rest))
        return dict(zip(("row", key, "n_tokens", "known", "base", "log_text", "rest"), map(list, zip(*out))))

    rows = materialise(
        map_text(
            docs, [F.monotonically_increasing_id().alias("row"), F.col(key), F.col(text)], look_up,
            f"row long, `{key}` {kind}, n_tokens long, known long, base double, log_text double, rest array<struct<word:string,n:int>>",
        ),
        "texts",
    )
    joined = rows.select("row", F.inline("rest")).join(words, "word").groupBy("row").agg(
        F.sum(F.when(F.col("trained") > 0, F.col("n")).otherwise(0)).alias("_known"),
        F.sum(F.col("n") * F.col("base")).alias("_base"), F.sum(F.col("n") * F.col("log_word")).alias("_log"),
    )
    zero = F.lit(0.0)
    return rows.drop("rest").join(joined, "row", "left").select(
        key, (fold(key) == held_out).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", zero)).alias("base_score"), (F.col("log_text") + F.coalesce("_log", zero)).alias("score"),
    )
