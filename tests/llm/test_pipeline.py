"""The pipeline's stages against replays by brute force, on odd rows, and by name."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm import odd
from tests.llm.test_decontamination import by_brute_force
from tests.llm.test_simhash import groups_by_brute_force
from tests.llm.test_tables import count_by_inversion, split_by_recursion

import corpus_pipeline
from weftwork.llm import plans, quality, simhash
from weftwork.session import materialise

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], FOLDER)))
    return [[r.asDict() for r in table.collect()] for table in out]


def test_columns_and_run(spark, stages):
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    for rows in stages[:-1]:
        assert list(rows[0]) == columns
    ran = corpus_pipeline.run(spark, FOLDER)
    assert Counter(map(str, (r.asDict() for r in ran.collect()))) == Counter(map(str, stages[-1]))


def test_quality_stage(spark, stages):
    labels = dict((r[0], r[1]) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality").collect())
    described = {r["doc_id"]: np.array(quality.describe(r["text"])) for r in stages[0]}
    train = [k for k in described if k in labels and zlib.crc32(str(k).encode()) % 5]
    order = {r[0]: r[1] for r in spark.createDataFrame([(k,) for k in train], "k long").selectExpr("k", "xxhash64(k)").collect()}
    train.sort(key=order.get)
    model = quality.fit(*(np.array([described[k] for k in train if labels[k] == q]) for q in (1, 0)))
    strength = {k: float((np.clip((v - model.mean) / model.spread, -8, 8) * model.weights).sum()) for k, v in described.items()}
    ranked = sorted(strength[k] for k in train)
    poor = sum(labels[k] == 0 for k in train) / len(train)
    threshold = ranked[max(0, int(np.ceil(poor * len(ranked))) - 1)]
    assert {r["doc_id"] for r in stages[1]} == {k for k, s in strength.items() if s >= threshold - 1e-9}
    kept = {r["doc_id"] for r in stages[1]}
    assert np.mean([(k in kept) == bool(q) for k, q in labels.items()]) > 0.9


def test_near_duplicate_stage(stages):
    rows = sorted(stages[1], key=lambda r: r["doc_id"])
    roots = groups_by_brute_force([simhash.fingerprint(r["text"]) for r in rows])
    assert sorted(r["doc_id"] for r in stages[2]) == [rows[i]["doc_id"] for i in sorted(set(roots))]


def test_decontamination_stage(spark, stages):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()
    hit = {d for d, _ in by_brute_force([(r["doc_id"], r["text"]) for r in stages[2]], items)}
    assert sorted(r["doc_id"] for r in stages[3]) == sorted({r["doc_id"] for r in stages[2]} - hit)


def test_mixing_stage(stages):
    held = Counter(r["source"] for r in stages[3])
    weight = {s: n**plans.MIX_EXPONENT for s, n in held.items()}
    want = Counter()
    for r in stages[3]:
        rate = weight[r["source"]] / sum(weight.values()) * len(stages[3]) / held[r["source"]]
        want[r["doc_id"]] = count_by_inversion(rate, plans.MIX_SEED, r["doc_id"])
    assert Counter(r["doc_id"] for r in stages[4]) == +want


def test_sharding_stage(stages):
    rows = [
        (i, f"{int(hashlib.md5(str(r['doc_id']).encode()).hexdigest()[:10], 16):040b}", len(r["text"].encode()))
        for i, r in enumerate(stages[4])
    ]
    parts = split_by_recursion(rows, plans.SHARD_BYTES)
    want = Counter((stages[4][i]["doc_id"], bits, sum(x[2] for x in inside)) for bits, inside in parts.items() for i, *_ in inside)
    assert Counter((r["doc_id"], r["shard"], r["shard_bytes"]) for r in stages[5]) == want


def test_odd_rows_pass_all_stages(spark, tmp_path):
    docs = odd.documents(spark)
    folder = str(tmp_path)
    spark.createDataFrame([(4, 1), (2, 0)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    for start in (docs, odd.empty(spark)):
        table = start
        for _, stage in corpus_pipeline.STAGES:
            table = materialise(stage(spark, table, folder))
        assert set(docs.columns) <= set(table.columns)
        assert start is docs or table.count() == 0
