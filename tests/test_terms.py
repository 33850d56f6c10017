import math

import pytest
from pyspark.sql import functions as F

from weftwork.operators import compare as C
from weftwork.operators import tfidf as W
from weftwork.operators import timeseries as D
from weftwork.operators import vocabulary as V
from weftwork.operators.ranking import position, running_total

# Golden input whose weights are known.
SENTENCES = [
    "the cat sat on the mat",
    "the dog chased the cat",
    "the mat was on the floor",
    "a dog and a cat played together",
]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [("x", i, s) for i, s in enumerate(SENTENCES)]
    return spark.createDataFrame(rows, "corpus string, doc_id int, text string")


def test_plain_tfidf(corpus):
    words = F.split("text", " ")
    weights = W.tfidf_plain(corpus, ["corpus"], "doc_id", words)
    n = V.document_counts(corpus, ["corpus"])
    rows = W.term_importance(weights, n, ["corpus"], "doc_id").collect()
    mean = {r["term"]: r["avg_tfidf"] for r in rows}
    assert mean["the"] == pytest.approx(8 / 24 * 0 + (2 / 6 + 2 / 5 + 2 / 6) / 4, abs=1e-9)
    assert mean["the"] == pytest.approx(0.266667, abs=1e-6)
    assert mean["cat"] == pytest.approx(0.127381, abs=1e-6)
    assert mean["a"] == pytest.approx(0.120939, abs=1e-6)
    assert {r["doc_id"] for r in rows if r["term"] == "the"} == {1}


def test_counts_match_plain_grouping(corpus):
    words = F.split("text", " ")
    a = {tuple(r) for r in V.term_counts(corpus, ["doc_id"], words).select("doc_id", "term", "tf").collect()}
    b = {tuple(r) for r in corpus.select("doc_id", F.explode(words).alias("term")).groupBy("doc_id", "term").count().collect()}
    assert a == b


def test_empty_documents_count(spark):
    df = spark.createDataFrame([("x", 1, "red red"), ("x", 2, ""), ("x", 3, "red blue")], "corpus string, doc_id int, text string")
    words = F.filter(F.split("text", " "), lambda w: w != "")
    m = W.tfidf_matrix(df, ["corpus"], "doc_id", words, max_terms=1, min_doc_freq=1)
    assert {r["term"] for r in m.vocabulary.collect()} == {"red"}
    assert [r["weight"] for r in m.weights.collect()] == [1.0, 1.0]
    assert W.mean_scores(m, ["corpus"]).first()["score"] == pytest.approx(2 / 3)
    shape = W.matrix_shape(m, ["corpus"]).first()
    assert (shape["n_rows"], shape["n_cols"], shape["nnz"]) == (3, 1, 2)
    assert shape["sparsity"] == pytest.approx(100 / 3)
    again = W.tfidf_transform(m, df.filter("doc_id = 1"), ["corpus"], "doc_id", words).collect()
    assert [(r["term"], r["weight"]) for r in again] == [("red", 1.0)]


def test_frequency_table(corpus):
    freq = V.frequencies(corpus, ["corpus"], F.split("text", " "))
    rows = V.frequency_table(freq, ["corpus"]).orderBy(F.desc("frequency"), "word").collect()
    assert (rows[0]["word"], rows[0]["frequency"]) == ("the", 6)
    assert rows[-1]["cumulative_percentage"] == pytest.approx(100)
    stats = V.vocabulary_stats(freq, ["corpus"]).first()
    assert (stats["total_words"], stats["coverage_top_1000"]) == (24, 100.0)
    few = V.vocabulary_stats(freq, ["corpus"], top=1).first()
    assert few["coverage_top_1000"] == pytest.approx(25.0)
    present = V.frequencies(corpus, ["corpus"], F.split("text", " "), mode="presence")
    assert present.agg(F.max("frequency")).first()[0] == 1
    with pytest.raises(ValueError):
        V.frequencies(corpus, ["corpus"], F.split("text", " "), mode="other")


def test_running_total_over_many_slices(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).alias("g"), F.col("id"), (F.col("id") % 7).alias("v"))
    rows = running_total(df.repartition(16), ["g"], [F.col("id").asc()], F.col("v"), "run").collect()
    for group in (True, False):
        total = 0
        for r in sorted((r for r in rows if r["g"] == group), key=lambda r: r["id"]):
            total += r["v"]
            assert r["run"] == total
    at = position(df, [], [F.col("id").desc()], "at").collect()
    assert all(r["at"] == 4999 - r["id"] for r in at)


def test_daily_counts(spark):
    df = spark.createDataFrame([("2024-01-01", "cat dog cat"), ("2024-01-02", "dog"), ("2024-01-02", "")], "t string, text string")
    rows = D.daily_term_counts(df, "t", F.split("text", " "), ["cat", "dog"]).collect()
    assert {(str(r["date"]), r["term"]): r["n"] for r in rows} == {
        ("2024-01-01", "cat"): 2, ("2024-01-01", "dog"): 1, ("2024-01-02", "cat"): 0, ("2024-01-02", "dog"): 1,
    }
    with pytest.raises(D.UnknownTerms):
        D.daily_term_counts(df, "t", F.split("text", " "), ["bird"])


def test_jaccard(spark):
    sets = {"fruits": "apple orange banana grape cherry", "vegetables": "carrot potato tomato pea grape", "spheres": "apple orange cherry ball pea globe"}
    rows = [(name, item) for name, items in sets.items() for item in items.split()] + [("none", "void"), ("fruits", "apple")]
    got = {(r["left"], r["right"]): r["jaccard"] for r in C.jaccard_report(spark.createDataFrame(rows, "o string, i string"), "o", "i").collect()}
    for a in sets:
        for b in sets:
            if a < b:
                x, y = set(sets[a].split()), set(sets[b].split())
                assert got[(a, b)] == pytest.approx(len(x & y) / len(x | y))
    assert got[("fruits", "none")] == 0 and len(got) == 6


@pytest.mark.parametrize("a, b, distance, angle", [((3.0, 4.0), (4.0, 3.0), math.sqrt(2), 16.260205), ((1.0, 0.0), (0.0, 2.0), math.sqrt(5), 90.0)])
def test_distances(spark, a, b, distance, angle):
    rows = [(n, t, v) for n, vec in (("a", a), ("b", b)) for t, v in zip("xy", vec)]
    r = C.report_distances(spark.createDataFrame(rows, "corpus string, term string, score double"), "corpus").first()
    assert r["distance"] == pytest.approx(distance) and r["angle"] == pytest.approx(angle, abs=1e-5)


def test_corpus_terms(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "z"), ("b", "x")], "corpus string, term string")
    assert [r["term"] for r in C.common_terms(df, "corpus").collect()] == ["x"]
    assert sorted(tuple(r) for r in C.unique_terms(df, "corpus").select("corpus", "term").collect()) == [("a", "y"), ("b", "z")]
