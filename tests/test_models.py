import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftwork.operators import classify as N
from weftwork.operators import cluster as C
from weftwork.operators import compare as K
from weftwork.operators import embeddings as E
from weftwork.operators import vectors as X


@pytest.mark.parametrize("n, test", [(16, 5), (10, 3), (1, 1), (24, 8)])
def test_split_size(spark, n, test):
    df = spark.range(n).withColumnRenamed("id", "doc")
    first = N.train_test_split(df, "doc").filter("is_test")
    again = N.train_test_split(df.repartition(7), "doc").filter("is_test")
    assert first.count() == test
    assert sorted(r["doc"] for r in first.collect()) == sorted(r["doc"] for r in again.collect())


def test_naive_bayes(spark):
    weights = spark.createDataFrame(
        [(1, "cat", 2.0), (1, "dog", 1.0), (2, "ball", 1.5), (3, "cat", 1.0), (3, "net", 1.0), (4, "bat", 2.0)],
        "doc int, term string, weight double",
    )
    labels = spark.createDataFrame([(1, "pets"), (2, "sports")], "doc int, label string")
    model = N.fit_naive_bayes(weights, labels, "doc")
    v, total = 5, {"pets": 3.0, "sports": 1.5}
    seen = {"pets": {"cat": 2.0, "dog": 1.0}, "sports": {"ball": 1.5}}
    docs = spark.createDataFrame([(3,), (4,), (5,)], "doc int")
    texts = {3: {"cat": 1.0, "net": 1.0}, 4: {"bat": 2.0}, 5: {}}
    rows = N.class_scores(model, docs, weights.filter("doc > 2"), "doc").collect()
    assert len(rows) == 6
    for r in rows:
        want = math.log(0.5) + sum(
            w * math.log((seen[r["label"]].get(t, 0.0) + 1) / (total[r["label"]] + v)) for t, w in texts[r["doc"]].items()
        )
        assert r["score"] == pytest.approx(want)
    best = {r["doc"]: r["predicted"] for r in N.predict(N.class_scores(model, docs, weights.filter("doc > 2"), "doc"), "doc").collect()}
    assert best == {3: "pets", 4: "sports", 5: "pets"}


def test_report_with_undefined_ratios(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "t string, p string")
    rows = {r["label"]: r for r in N.classification_report(N.confusion_matrix(df, "t", "p")).collect()}
    assert rows["c"]["precision"] == 0 and rows["c"]["recall"] == 0 and rows["c"]["support"] == 1
    assert rows["b"]["precision"] == 0.5 and rows["b"]["recall"] == 1
    assert rows["accuracy"]["f1"] == 0.5
    assert rows["macro avg"]["recall"] == pytest.approx(0.5)


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(2)
    rows = [(f"w{i}", [draw.gauss(0, 1) for _ in range(8)]) for i in range(80)] + [("zero", [0.0] * 8)]
    return spark.createDataFrame(rows, "token string, vec array<float>")


def test_embeddings(spark, model):
    vec = {r["token"]: np.array(r["vec"], dtype=float) for r in model.collect()}

    def cos(a, b):
        return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))

    got = [r["token"] for r in E.vector_arithmetic(model, "w1", "w2", "w3", 5).filter("query = 'analogy'").orderBy("rank").collect()]
    q = vec["w1"] - vec["w2"] + vec["w3"]
    want = sorted((t for t in vec if t != "zero"), key=lambda t: -cos(vec[t], q))[:5]
    assert got == want
    near = E.similar_to(model, "w1", 3).collect()
    assert "w1" not in {r["token"] for r in near} and len(near) == 3
    pairs = spark.createDataFrame([("w1", "w2"), ("w1", "zero")], "token1 string, token2 string")
    sims = {r["token2"]: r["similarity"] for r in E.pair_similarities(model, pairs).collect()}
    assert sims["w2"] == pytest.approx(cos(vec["w1"], vec["w2"])) and sims["zero"] is None
    with pytest.raises(E.UnknownTokens):
        E.lookup(model, ["w1", "nowhere"])


def test_kmeans_costs(spark):
    draw = random.Random(3)
    rows = [(i, [10.0 * (i % 3) + draw.random(), draw.random()]) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    found = C.fit_kmeans(df, "v", 3, "id")
    total = C.inertia_from(found.assignments, "v").agg(F.sum("inertia")).first()[0]
    assert total == pytest.approx(found.cost, rel=1e-6)
    sweep = {r["k"]: r["inertia"] for r in C.inertia_sweep({"d": df}, "v", [1, 3], "id").collect()}
    assert sweep[3] < sweep[1]
    truth = found.assignments.withColumn("truth", F.col("id") % 3)
    assert C.label_clusters(truth, "cluster", "truth").filter("predicted <> truth").count() == 0
    near = C.nearest_to_centres(found.assignments, found.centres, "id", "v", 2)
    assert near.count() == 6


def test_term_similarities_and_coordinates(spark):
    cells = [("c", d, t, w) for d, row in enumerate([{"a": 1.0, "b": 2.0}, {"a": 3.0}, {"b": 1.0, "z": 1.0}]) for t, w in row.items()]
    weights = spark.createDataFrame(cells, "corpus string, doc int, term string, weight double")
    scores = weights.groupBy("corpus", "term").agg(F.sum("weight").alias("score"))
    rows = {(r["left"], r["right"]): r["cosine"] for r in X.term_similarities(weights, scores, ["corpus"], "doc", 3).collect()}
    assert rows[("a", "b")] == pytest.approx(2 / math.sqrt(10 * 5)) and rows[("a", "z")] == 0
    points = X.term_coordinates(X.term_similarities(weights, scores, ["corpus"], "doc", 3), ["corpus"]).collect()
    assert len(points) == 3
    coloured = X.colour_groups(X.highlight_top(scores, ["corpus"], 1), "term").collect()
    assert {r["term"]: (r["highlighted"], r["colour"]) for r in coloured} == {"a": (True, 0), "b": (False, 1), "z": (False, 2)}


def test_principal_components_are_uncorrelated(spark, model):
    rows = X.plane_coordinates(model, "token", "vec").collect()
    xy = np.array([(r["x"], r["y"]) for r in rows])
    assert abs(np.corrcoef(xy.T)[0, 1]) < 1e-6 and xy[:, 0].var() >= xy[:, 1].var()


def test_kmeans_does_not_depend_on_partitions(spark):
    draw = random.Random(9)
    df = spark.createDataFrame([(i, [draw.gauss(i % 5, 1.0), draw.random()]) for i in range(300)], "id int, v array<double>")
    one = {r["id"]: r["cluster"] for r in C.fit_kmeans(df.coalesce(1), "v", 5, "id").assignments.collect()}
    many = {r["id"]: r["cluster"] for r in C.fit_kmeans(df.repartition(7), "v", 5, "id").assignments.collect()}
    assert one == many


def test_more_sets_classes_and_queries_than_a_short_list(spark):
    sets = spark.range(1200).select(F.concat(F.lit("s"), "id").alias("owner"), (F.col("id") % 3).alias("item"))
    report = K.jaccard_report(sets, "owner", "item")
    assert report.count() == 1200 * 1199 // 2 and report.filter("jaccard = 1").count() == 3 * 400 * 399 // 2
    docs = spark.range(500).select(F.col("id").alias("doc"), F.concat(F.lit("l"), F.col("id") % 250).alias("label"))
    weights = docs.select("doc", F.concat(F.lit("t"), F.col("doc") % 250).alias("term"), F.lit(1.0).alias("weight"))
    model = N.fit_naive_bayes(weights, docs, "doc")
    scores = N.class_scores(model, docs, weights, "doc")
    assert scores.count() == 500 * 250
    assert N.predict(scores, "doc").join(docs, "doc").filter("label <> predicted").count() == 0
    words = spark.range(1100).select(F.concat(F.lit("w"), "id").alias("token"), F.array(F.col("id") + 1.0, F.lit(1.0)).alias("vec"))
    found = E.nearest(words, {f"q{i}": [i + 1.0, 1.0] for i in range(1100)}, 1)
    assert found.count() == 1100


def test_documents_without_kept_terms_have_coordinates(spark):
    docs = spark.range(5).withColumnRenamed("id", "doc")
    weights = spark.createDataFrame([(0, "a", 1.0), (1, "b", 0.5), (2, "a", 0.2)], "doc long, term string, weight double")
    rows = {r["doc"]: r["vector"] for r in X.dense_rows(docs, weights, "doc", ["a", "b"]).collect()}
    assert len(rows) == 5 and rows[4] == [0.0, 0.0] and rows[1] == [0.0, 0.5]
    assert X.plane_coordinates(X.dense_rows(docs, weights, "doc", ["a", "b"]), "doc", "vector").count() == 5


def test_vectors_do_not_depend_on_partitions(spark):
    rows = [(i, [f"w{(i * j) % 12}" for j in range(8)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    one = {r["token"]: r["vec"] for r in E.train_vectors(df.coalesce(1), "w", size=4).collect()}
    many = {r["token"]: r["vec"] for r in E.train_vectors(df.repartition(5), "w", size=4).collect()}
    assert set(one) == set(many) and all(one[t] == pytest.approx(many[t], abs=1e-3) for t in one)
    n = {(r["token"], r["context"]): r["n"] for r in E.cooccurrences(df, "w", window=2).collect()}
    want = {}
    for _, words in rows:
        for i, a in enumerate(words):
            for b in words[i + 1:i + 3]:
                for pair in ((a, b), (b, a)):
                    want[pair] = want.get(pair, 0) + 1
    assert n == want


def test_cells_of_an_association_are_numbered_and_held_once(spark):
    # "a" stands beside "a", "b" and "c" exactly as often as any token does, so it has no positive association.
    texts = [["b", "b"], ["c", "c"], ["a", "a"], ["a", "a"], ["a", "b"], ["a", "b"], ["c", "a"], ["c", "a"]]
    rng = random.Random(5)
    for texts, names in [(texts, ["b", "c"]), ([[f"w{min(rng.randrange(9), rng.randrange(9))}" for _ in range(7)] for _ in range(30)], None)]:
        df = spark.createDataFrame([(t,) for t in texts], "w array<string>")
        want = {(r["token"], r["context"]): r["weight"] for r in E.association(E.cooccurrences(df, "w")).collect()}
        numbers, cells = E._association_cells(E.materialise(E._counted_once(df, "w", 5, 2)))
        name = {r["number"]: r["token"] for r in numbers.collect()}
        assert [name[i] for i in range(len(name))] == sorted({t for t, _ in want}) and names in (None, list(name[i] for i in range(len(name))))
        rows = [(name[r["row"]], name[r["column"]], r["weight"]) for r in cells.collect()]
        assert len({frozenset(r[:2]) for r in rows}) == len(rows)
        held = {k: w for a, b, w in rows for k in ((a, b), (b, a))}
        assert set(held) == set(want) and all(held[k] == pytest.approx(want[k], abs=1e-6) for k in held)


def test_blocks_of_a_factorisation_fit_a_small_heap(spark, monkeypatch):
    # Two tasks that build a block each (12 bytes a cell, five times) take at most half of a heap of 1.8 GB.
    assert 2 * 5 * 12 * E.CELLS_PER_BLOCK < 0.5 * 1.8e9
    df = spark.createDataFrame([([f"w{(i * j) % 12}" for j in range(8)],) for i in range(60)], "w array<string>")
    asked, als = [], E.ALS
    monkeypatch.setattr(E, "ALS", lambda **options: asked.append(options) or als(**options))
    monkeypatch.setattr(E, "CELLS_PER_BLOCK", 4)
    monkeypatch.setattr(E, "BROADCAST_ROWS", 0)
    model = {r["token"]: r["vec"] for r in E.train_vectors(df, "w", size=4, rounds=2).collect()}
    cells = E.association(E.cooccurrences(df, "w")).collect()
    n = len({frozenset((r["token"], r["context"])) for r in cells})
    assert asked[0]["numUserBlocks"] == asked[0]["numItemBlocks"] == max(10, -(-2 * n // 4)) > 10
    assert set(model) == {r["token"] for r in cells}


def test_a_written_table_leaves_nothing_shuffled_behind(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        every = files.getAllFiles()
        return {name for i in range(every.length()) if (name := every.apply(i).getName()).startswith("shuffle_")}

    before = shuffled()
    table = E.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "k"))
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    assert not left and table.count() == 7
