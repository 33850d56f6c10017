import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm import odd

from weftwork.llm import language_model as L


def segmentations(word, pieces, log_byte):
    """Sum over all ways to spell a word, by recursion over every cut."""
    if not word:
        return 1.0
    total = math.exp(sum(log_byte[b] for b in word[0].encode())) * segmentations(word[1:], pieces, log_byte)
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            total += math.exp(pieces[word[:n]]) * segmentations(word[n:], pieces, log_byte)
    return total


def small():
    return L.vocabulary(["▁a", "b", "ab", "▁", "ba", "▁ab", "é", "bab"])


def test_scores_sum_all_segmentations():
    v = small()
    pieces = dict(zip(v.pieces, v.log_piece))
    words = ["ab", "babab", "a", "é", "日b", "", "abababab", "xyz"]
    want = [math.log(segmentations("▁" + w, pieces, v.log_byte)) for w in words]
    assert np.allclose(L.word_scores(v, words), want)


def test_scores_and_end_are_a_distribution():
    v = small()
    total = np.exp(v.log_piece).sum() + np.exp(v.log_byte).sum() + math.exp(v.log_end)
    assert total == pytest.approx(1.0)
    after = v.with_scores(L.expected_counts(v, ["ab", "ba"], np.array([3, 1])), 2.0)
    assert np.exp(after.log_piece).sum() + np.exp(after.log_byte).sum() + math.exp(after.log_end) == pytest.approx(1.0)


def test_expected_counts_are_derivatives_of_the_likelihood():
    v, words, times = small(), ["babab", "ab", "xb"], np.array([2, 5, 1])
    got = L.expected_counts(v, words, times)
    for i in range(len(v.pieces)):
        likelihood = []
        for step in (-1e-5, 1e-5):
            logs = v.log_piece.copy()
            logs[i] += step
            moved = L.Vocabulary(v.pieces, logs, v.log_byte, v.log_end, v.keys, v.piece_at, v.probes, v.slot_bits)
            likelihood.append((L.word_scores(moved, words) * times).sum())
        assert got[i] == pytest.approx((likelihood[1] - likelihood[0]) / 2e-5, abs=1e-4)


def test_training_raises_the_likelihood():
    v = small()
    words, times = ["ab", "abab", "bab"], np.array([50, 20, 10])
    after = v.with_scores(L.expected_counts(v, words, times), 10.0, prior=1.0)
    assert (L.word_scores(after, words) * times).sum() > (L.word_scores(v, words) * times).sum()


def check(rows, docs):
    train = [(d, t) for d, t in docs if zlib.crc32(str("" if d is None else d).encode()) % 5 != 1]
    counts = Counter(w for _, t in train for w in L.words_of(t))
    n, kinds = sum(counts.values()) + len(train), len(counts) + bool(train)
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (kinds + 1)))
    texts = Counter()
    for d, t in docs:
        words = L.words_of(t)
        score = sum(base(counts[w]) for w in words) + base(len(train))
        known = sum(counts[w] > 0 for w in words) + bool(train)
        texts[d, len(words) + 1, known, n, round(score, 6)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == texts


@pytest.mark.parametrize("common", [100_000, 3])
def test_odd_rows_against_brute_force(spark, common):
    docs = odd.documents(spark)
    rows = L.text_scores(docs, common=common).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    alone = [r["score"] for r in rows if r["n_tokens"] == 1]
    assert len(alone) == 4 and max(alone) - min(alone) < 1e-12
    assert L.text_scores(odd.empty(spark)).collect() == []


def test_joined_words_score_like_looked_up_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = sorted((r["doc_id"], round(r["score"], 5), r["n_known"]) for r in L.text_scores(docs).collect())
    two = sorted((r["doc_id"], round(r["score"], 5), r["n_known"]) for r in L.text_scores(docs, common=50).collect())
    assert one == two
    check(L.text_scores(docs, common=50).collect(), docs.select("doc_id", "text").collect())


def test_large_vocabularies():
    alphabet = "abcdefghijklmnop"
    pieces = ["▁" + "".join(alphabet[(i >> 4 * k) & 15] for k in range(5)) + "q" * (i % 2) for i in range(400_000)]
    v = L.vocabulary(pieces)
    assert (v.piece_at >= -1).sum() > 600_000
    log = dict(zip(v.pieces, v.log_piece))
    for i in (0, 1, 77_777, 399_999):
        word = pieces[i][1:]
        assert L.word_scores(v, [word])[0] == pytest.approx(math.log(segmentations("▁" + word, log, v.log_byte)))
