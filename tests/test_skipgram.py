"""Skip-gram vectors: a planted corpus, the sampling table, blocks that share nothing."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftwork.operators import embeddings as E
from weftwork.operators import skipgram as S
from weftwork.session import materialise

ROLES = 8


def planted(n=1500, seed=4):
    """Every text names a role of a sex, beside words about the role and words about the sex."""
    draw, out = random.Random(seed), []
    for _ in range(n):
        role, sex = draw.randrange(ROLES), draw.randrange(2)
        words = [f"role{role}{'mf'[sex]}"] + [f"about{role}x{draw.randrange(4)}" for _ in range(3)] + [f"sex{sex}x{draw.randrange(4)}" for _ in range(3)]
        draw.shuffle(words)
        out.append((words,))
    return out


def test_analogies_on_a_planted_corpus_in_any_partitioning(spark):
    df = spark.createDataFrame([*planted(), (None,), ([],), (["once"],)], "w array<string>")
    training = S.Training(size=25, epochs=5, passes=5, batch=256)
    model = {r["token"]: r["vec"] for r in S.train_skipgram(df.coalesce(1), "w", 6, training=training, blocks=3).collect()}
    assert set(model) == {w for words, in planted() for w in words}
    few = S.Training(size=8, epochs=1, passes=1)
    same = [{r["token"]: r["vec"] for r in S.train_skipgram(df.repartition(n), "w", 6, training=few, blocks=2).collect()} for n in (1, 5)]
    assert same[0] == same[1]
    names = sorted(model)
    table = np.array([model[n] for n in names])
    unit = table / np.linalg.norm(table, axis=1)[:, None]
    hits = 0
    for a in range(ROLES):
        for b in range(ROLES):
            if a != b:
                given = [f"role{a}m", f"role{a}f", f"role{b}f"]
                query = table[names.index(given[0])] - table[names.index(given[1])] + table[names.index(given[2])]
                order = [names[i] for i in np.argsort(-(unit @ query)) if names[i] not in given]
                hits += order[0] == f"role{b}m"
    assert hits >= 0.6 * ROLES * (ROLES - 1)
    # The library's own analogies work on the vectors.
    found = E.vector_arithmetic(spark.createDataFrame(list(model.items()), "token string, vec array<float>"), "role0m", "role0f", "role1f", 5)
    assert found.count() == 10


def test_sampling_table(spark):
    df = spark.createDataFrame(planted(400), "w array<string>")
    counts = Counter()
    for words, in planted(400):
        for i, a in enumerate(words):
            counts[a] += sum(1 for j in range(len(words)) if j != i and abs(i - j) <= 5)
    kept = {w for w, n in Counter(w for words, in planted(400) for w in words).items() if n >= 2}
    assert kept == set(counts)  # no word is rare here, so all pairs count
    total = sum(n**0.75 for n in counts.values())
    rows = {r["token"]: (r["n"], r["share"]) for r in S.sampling_table(E.cooccurrences(df, "w")).collect()}
    assert {t: n for t, (n, _) in rows.items()} == counts
    assert all(share == pytest.approx(counts[t]**0.75 / total) for t, (_, share) in rows.items())


def test_blocks_of_a_round_share_no_vector_and_all_meet(spark):
    blocks = 5
    names = spark.range(200).select(F.col("id").cast("string").alias("token")).select("token", S._block(F.col("token"), blocks).alias("b"))
    of = {r["token"]: r["b"] for r in names.collect()}
    assert set(of.values()) == set(range(blocks))
    met = [{(i, (i + shift) % blocks) for i in range(blocks)} for shift in range(blocks)]
    assert all(len({c for _, c in pairs}) == blocks for pairs in met)
    assert set.union(*met) == {(i, j) for i in range(blocks) for j in range(blocks)}


def test_a_step_is_the_gradient_of_the_loss():
    draw = np.random.default_rng(0)
    x, y = draw.normal(size=(4, 3)), draw.normal(size=(5, 3))
    before = x.copy()
    rows, gradient = np.array([2, 0, 2]), draw.normal(size=(3, 3))
    seen = np.zeros(4)
    S.step(x, seen, rows, gradient, 0.1)
    summed = gradient[0] + gradient[2]
    assert np.allclose(x[2], before[2] - 0.1 * summed / np.sqrt((summed**2).mean())) and np.allclose(x[[1, 3]], before[[1, 3]])
    assert seen[0] == pytest.approx((gradient[1]**2).mean()) and y.shape == (5, 3)


def test_an_empty_corpus_has_no_vectors(spark):
    df = spark.createDataFrame([(None,), (["a"],)], "w array<string>")
    assert S.train_skipgram(df, "w", training=S.Training(epochs=1)).collect() == []


def test_cooccurrences_in_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(E, "TOKENS_PER_TASK", 60)
    draw = random.Random(8)
    texts = [[f"w{min(int(draw.expovariate(0.2)), 30)}" for _ in range(draw.randrange(40))] for _ in range(60)]
    texts += [["lone", "w1", "w1"], [], ["w2"]]
    often = Counter(w for t in texts for w in t)
    want = Counter(
        (x, t[j]) for t in texts for i, x in enumerate(t) for j in range(max(0, i - 5), min(len(t), i + 6))
        if j != i and often[x] > 1 and often[t[j]] > 1
    )
    df = spark.createDataFrame([*((t,) for t in texts), (None,)], "w array<string>")
    found = E.cooccurrences(df, "w")
    assert {(r["token"], r["context"]): r["n"] for r in found.collect()} == want and found.count() == len(want)
    assert max(often.values()) > 60
    # The rows that are exchanged hold lists of neighbours, not single pairs.
    assert "_others" in found._jdf.queryExecution().executedPlan().toString()


def test_training_sees_numbers_only(spark):
    pairs = materialise(E.cooccurrences(spark.createDataFrame(planted(200), "w array<string>"), "w"))
    table, numbered = S.placed(S.sampling_table(pairs), pairs, 3)
    assert not [f.name for f in numbered.schema if f.dataType.simpleString() not in ("int", "bigint")]
    names = {(r["block"], r["place"]): r["token"] for r in table.collect()}
    for block in range(3):
        here = [names[key] for key in sorted(names) if key[0] == block]
        assert here == sorted(here) and max(p for b, p in names if b == block) == len(here) - 1
    found = {(names[r["token_block"], r["token_place"]], names[r["context_block"], r["context_place"]]): r["n"] for r in numbered.collect()}
    assert found == {(r["token"], r["context"]): r["n"] for r in pairs.collect()}


def test_pairs_travel_counted_and_packed(spark, monkeypatch):
    draw = random.Random(3)
    texts = [[f"w{min(int(draw.expovariate(0.1)), 60)}" for _ in range(40)] + [None, f"rare{i}"] for i in range(150)]
    df = spark.createDataFrame([*((t,) for t in texts), (None,), ([],)], "w array<string>").repartition(2)
    want = {(r["token"], r["context"]): r["n"] for r in E.cooccurrences(df, "w").collect()}
    occurrences, often = Counter(), Counter(w for t in texts for w in t if w)
    for t in texts:
        for i, a in enumerate(t):
            occurrences.update((a, b) for j, b in enumerate(t) if i != j and abs(i - j) <= 5 and min(often[a], often[b]) > 1)
    assert want == occurrences
    # Each of the two tasks sends a list to a bucket, not a row for an occurrence, and equal pairs are one entry of it.
    _, _, lists = E._pair_lists(df, "w", 5, 2)
    rows = lists.collect()
    assert len(rows) <= 2 * len({r["bucket"] for r in rows})
    # Behind its width, a list has the number of its entries.
    assert sum(int.from_bytes(r["_others"][1:5], "little") for r in rows) <= 2 * len(want) < sum(occurrences.values()) / 2
    # In small pieces, and with a vocabulary that no task holds, the counts are the same.
    monkeypatch.setattr(E, "_PAIRS_AT_ONCE", 5000)
    monkeypatch.setattr(E, "_ROWS_AT_ONCE", 7)
    assert {(r["token"], r["context"]): r["n"] for r in E.cooccurrences(df, "w").collect()} == want
    monkeypatch.setattr(E, "VOCABULARY_BYTES", 0)
    assert {(r["token"], r["context"]): r["n"] for r in E.cooccurrences(df, "w").collect()} == want


def test_shares_from_packed_pairs(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c", "c"],), (["c", None, "a"],)], "w array<string>")
    lists = E._pair_lists(df, "w", 2, 2)[2]
    assert "MapInArrow" in lists._jdf.queryExecution().executedPlan().toString()
    rows = {r["token"]: r["n"] for r in S.sampling_table(E.cooccurrences(df, "w", window=2)).collect()}
    assert rows == {"a": 5, "c": 5}


def test_parts_of_large_blocks_all_meet_and_share_no_vector(spark, monkeypatch):
    blocks, parts = 2, 3
    lanes = spark.range(blocks * parts).select(F.col("id").cast("int").alias("b"))
    met = []
    for shift in range(blocks):
        for turn in range(parts):
            met.append({(r["b"], r["c"]) for r in lanes.select("b", S._further(F.col("b"), shift, turn, blocks, parts).alias("c")).collect()})
    assert all(len({c for _, c in pairs}) == blocks * parts for pairs in met)
    assert sum(len(pairs) for pairs in met) == len(set.union(*met)) == (blocks * parts)**2
    # Blocks that are asked to hold too much are trained by more tasks.
    df = spark.createDataFrame(planted(300), "w array<string>")
    training = S.Training(size=8, epochs=1, passes=1)
    whole = {r["token"] for r in S.train_skipgram(df, "w", training=training, blocks=1).collect()}
    rounds, trained = [], S.round_of_blocks
    monkeypatch.setattr(S, "round_of_blocks", lambda vectors, *a: rounds.append(vectors.select("block").distinct().count()) or trained(vectors, *a))
    monkeypatch.setattr(S, "PART_TOKENS", 30)
    monkeypatch.setattr(E, "BROADCAST_ROWS", 0)
    found = {r["token"]: r["vec"] for r in S.train_skipgram(df, "w", training=training, blocks=1).collect()}
    assert set(found) == whole and all(np.isfinite(v).all() and np.any(v) for v in found.values())
    assert rounds == [2, 2]
