import zlib

import numpy as np
from tests.llm import odd

from weftwork.llm import quality


def test_fit_orders_pairs_and_ignores_constant_features():
    draw = np.random.default_rng(3)
    better, worse = draw.normal(1, 1, (300, len(quality.FEATURES))), draw.normal(0, 1, (200, len(quality.FEATURES)))
    better[:, 3] = worse[:, 3] = 2.0
    model = quality.fit(better, worse)
    assert abs(model.weights[3]) < 1e-9
    strength = lambda x: (x - model.mean) / model.spread @ model.weights
    pairs = strength(better)[:, None] > strength(worse)[None, :]
    assert pairs.mean() > 0.98
    # At the optimum the gradient of the mean logistic loss plus ridge is zero.
    scaled = quality.preference_pairs(
        np.clip((better - model.mean) / model.spread, -8, 8), np.clip((worse - model.mean) / model.spread, -8, 8)
    )
    lose = 1 / (1 + np.exp(scaled @ model.weights))
    assert np.abs(1e-3 * model.weights - scaled.T @ lose / len(scaled)).max() < 1e-6


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in scored)
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.95


def test_rows_of_the_held_out_fold_teach_nothing(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    turned = labels.rdd.map(lambda r: (r[0], 1 - r[1] if zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[1])).toDF("doc_id long, quality int")
    assert sorted(quality.quality_scores(docs, labels).collect()) == sorted(quality.quality_scores(docs, turned).collect())


def test_odd_rows(spark):
    docs = odd.documents(spark)
    labels = spark.createDataFrame(
        [(1, 0), (2, 0), (3, 1), (4, 1), (5, None), (6, 1), (6, 0), (None, 1), (99, 0)], "doc_id long, quality int"
    )
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 7}) == 1
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)
    none = labels.filter("false")
    assert {round(r["score"], 9) for r in quality.quality_scores(docs, none).collect()} == {0.3}
    assert quality.quality_scores(odd.empty(spark), labels).collect() == []
    assert quality.accepted(odd.empty(spark), none).collect() == []
