"""Mixing, sharding, neighbours and secrets."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import odd

from weftwork.llm import mixing, neighbours, secrets, sharding


# ---------------------------------------------------------------- mixing

def count_by_inversion(rate, seed, key):
    draw = int(hashlib.md5(f"{seed}|{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52
    k, total = 0, math.exp(-rate)
    term = total
    while total <= draw:
        k += 1
        term *= rate / k
        total += term
    return k


def test_copies_follow_the_inverse_distribution(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source")
    )
    weights = spark.createDataFrame([("big", 1.0), ("s1", 5.0), ("s2", 40.0), ("s3", 0.0), ("s9", 1.0)], "source string, weight double")
    held = Counter(r["source"] for r in docs.collect())
    share = {"big": 1.0, "s1": 5.0, "s2": 40.0}
    total = sum(share.values())
    want = {}
    for r in docs.collect():
        rate = share.get(r["source"], 0.0) / total * 3000 / held[r["source"]]
        want[r["doc_id"]] = count_by_inversion(rate, 4, r["doc_id"])
    rows = mixing.mix(docs, weights, seed=4).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter({k: n for k, n in want.items() if n})
    assert all(sorted(r["copy"] for r in rows if r["doc_id"] == k) == list(range(1, want[k] + 1)) for k in (1, 2, 3, 9, 16))
    assert abs(sum(1 for r in rows if r["source"] == "s2") / 3000 - 40 / total) < 0.05
    ids = [r["doc_id"] for r in rows]
    assert abs(np.corrcoef(ids[:-1], ids[1:])[0, 1]) < 0.1  # neighbours are unrelated


def test_large_rates_do_not_underflow(spark):
    steps = spark.range(1).select(mixing._poisson_steps(F.lit(1500.0)).alias("s"), mixing._poisson_steps(F.lit(0.0)).alias("z")).first()
    assert steps["s"][-1] == pytest.approx(1.0, abs=1e-9) and steps["s"][1400] < 0.01 < steps["s"][1450] and steps["z"] == [1.0]


def test_mixing_odd_rows(spark):
    docs = odd.documents(spark)
    got = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    held = Counter(r["source"] for r in docs.collect())
    want = Counter()
    for r in docs.collect():
        want[r["doc_id"]] += count_by_inversion(docs.count() / len(held) / held[r["source"]], 0, r["doc_id"])
    assert got == +want
    assert set(mixing.mix(docs).columns) == set(docs.columns)
    assert mixing.mix(odd.empty(spark)).collect() == []
    assert mixing.mix(docs, spark.createDataFrame([("a", None)], "source string, weight double")).collect() == []


# ---------------------------------------------------------------- sharding

def split_by_recursion(rows, limit, bits=""):
    """{prefix: [key]} by splitting every bucket over the limit."""
    inside = [r for r in rows if r[1].startswith(bits)]
    if sum(r[2] for r in inside) <= limit or len({r[1] for r in inside}) < 2:
        return {bits: inside} if inside else {}
    return split_by_recursion(inside, limit, bits + "0") | split_by_recursion(inside, limit, bits + "1")


@pytest.mark.parametrize("limit", [500, 5_000, 60_000, 10**9])
def test_shards_are_those_of_recursive_splitting(spark, limit):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), (F.col("id") * 7 % 90).cast("int")).alias("text"))
    rows = []
    for r in docs.collect():
        number = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:10], 16)
        rows.append((r["doc_id"], f"{number:040b}", len(r["text"].encode())))
    want = {k: (bits, sum(x[2] for x in inside)) for bits, inside in split_by_recursion(rows, limit).items() for k, *_ in inside}
    got = {r["doc_id"]: (r["shard"], r["shard_bytes"]) for r in sharding.shard(docs, limit=limit).collect()}
    assert got == want


def test_copies_of_one_key_are_split(spark):
    docs = spark.range(4000).select(
        F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("doc_id"), F.repeat(F.lit("x"), 100).alias("text"), F.lit(1).alias("depth")
    )
    rows = sharding.shard(docs, limit=20_000).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += 100
    assert len(rows) == 4000 and max(sizes.values()) <= 20_000 and len(sizes) > 20
    assert all(sizes[r["shard"]] == r["shard_bytes"] and len(r["shard"]) == r["shard_depth"] for r in rows)
    names = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))  # no shard lies in another


def test_sharding_odd_rows(spark, tmp_path):
    docs = odd.documents(spark)
    sharded = sharding.shard(docs, limit=1000)
    rows = sharded.collect()
    assert len(rows) == docs.count() and [c for c in docs.columns if c != "shard"] == [c for c in sharded.columns if not c.startswith("shard")]
    over = {r["shard"] for r in rows if r["shard_bytes"] > 1000}
    assert all(Counter(r["shard"] for r in rows)[s] == 1 for s in over) and len(over) == 1
    assert sharding.shard(odd.empty(spark)).collect() == []
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(str(tmp_path / "out"))
    assert back.count() == len(rows)


# ---------------------------------------------------------------- neighbours

def nearest_by_brute_force(rows, top, every):
    good = [(k, np.array(v)) for k, v in rows if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in sorted({k for k, _ in good if k % every == 0}):
        v = next(v for k, v in good if k == q)
        scored = sorted((-float((v * c).sum()), k) for k, c in good if k != q and len(c) == len(v))
        out[q] = [(k, -s) for s, k in scored[:top]]
    return out


@pytest.mark.parametrize("blocks", [(16_384, 4_096), (60, 7)])
def test_neighbours_against_brute_force(spark, blocks):
    draw = np.random.default_rng(8)
    rows = [(i, draw.normal(size=24).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]  # copies: ties
    rows += [(2000, None), (2020, []), (2040, [0.0] * 24), (2060, [math.nan] * 24), (2080, [math.inf] * 24), (2100, [None, *[1.0] * 23])]
    rows += [(2120, [1.0, 2.0]), (2140, [2.0, 1.0]), (2160, [1e200] * 24), (2180, [-1e-200] * 24), (None, [1.0] * 24)]
    table = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], "vec_id long, embedding array<double>, code string, size int")
    got = {}
    found = neighbours.nearest(table, lambda key: key % 20 == 0, 10, candidate_block=blocks[0], query_block=blocks[1])
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = nearest_by_brute_force(rows, 10, 20)
    assert set(got) == set(want)
    hits = sum(len({k for k, _ in got[q]} & {k for k, _ in want[q]}) for q in want)
    assert hits / sum(len(v) for v in want.values()) >= 0.999
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], rel=1e-9)
    assert neighbours.nearest(table.filter("false"), lambda key: key % 20 == 0).collect() == []


def test_bounds_hold():
    draw = np.random.default_rng(2)
    vectors, query = draw.normal(size=(5000, 64)), draw.normal(size=64)
    code, norm, alignment = neighbours.encode(vectors, neighbours.rotation(64))
    signs = (2.0 * np.unpackbits(code.view(np.uint8), axis=1, count=64) - 1) / 8
    estimate = signs @ (neighbours.rotation(64) @ query) / alignment * norm
    spread = np.sqrt(1 - alignment**2) / alignment / np.sqrt(63) * norm * np.linalg.norm(query)
    error = np.abs(vectors @ query - estimate) / spread
    assert error.max() < neighbours.DEVIATIONS + 0.5 and 0.8 < np.sqrt((error**2).mean()) < 1.2


@pytest.mark.parametrize("size", [5, 64, 100])
def test_packed_products_are_those_of_the_rounded_query(size):
    draw = np.random.default_rng(size)
    signs, query = draw.normal(size=(300, size)) >= 0, draw.normal(size=(1, size))
    planes, low, step = neighbours.quantise(query)
    rounded = low + step * np.rint((query - low) / step)
    assert np.abs(rounded - query).max() <= step[0] / 2 + 1e-12
    codes = neighbours.pack(signs)
    ones = signs.sum(axis=1).astype(np.float32)
    got = neighbours.code_products(codes, ones, planes[0], low[0], step[0], rounded.sum(), size)
    assert np.allclose(got, (2.0 * signs - 1) @ rounded[0] / np.sqrt(size), atol=1e-5)


# ---------------------------------------------------------------- secrets

def findings_of(spark, n=240):
    rows = []
    for i in range(n):
        value = hashlib.sha1(str(i).encode()).hexdigest()
        secret = i % 3 == 0
        text = f'set token = "{value}" here' if secret else f"see commit {value} and call 97{i:014d}"
        rows.append((i, text, "src/config" if secret else "docs/readme", int(secret)))
    return spark.createDataFrame(rows, "doc_id long, text string, path string, secret int")


def test_forest_tells_findings_from_false_alarms(spark):
    docs = findings_of(spark)
    found = secrets.find_candidates(docs, path="path")
    assert found.count() == 80 + 320
    labels = found.filter("doc_id % 4 <> 0").join(docs.select("doc_id", "secret"), "doc_id").select("doc_id", "start", "secret")
    judged = secrets.judged(found, labels).filter("doc_id % 4 = 0").join(docs.select("doc_id", "secret"), "doc_id").collect()
    assert judged and np.mean([r["is_secret"] == r["secret"] for r in judged]) > 0.97


def test_secret_features():
    words = secrets.Dictionary(["password", "horse", "staple", "the"])
    row = dict(zip(secrets.FEATURES, secrets.describe("passwordhorse1", 'api_key: "', '" sample', "a/test/b", words)))
    assert row["length"] == 14 and row["covered"] == pytest.approx(13 / 14) and row["assigned"] == row["quoted"] == 1
    assert row["names_before"] == 1 and row["examples_after"] == 1 and row["path_depth"] == 2 and row["path_test"] == 1
    assert row["changes"] == pytest.approx(1 / 14)


def test_secret_odd_rows(spark):
    docs = odd.documents(spark).unionByName(
        spark.createDataFrame([(50, 'token = "0123456789abcdef0123"', "s", "c", "f", "r", "w", "y", "s")] * 2, odd.SCHEMA)
    )
    found = secrets.find_candidates(docs)
    assert [(r["doc_id"], r["start"]) for r in found.collect()] == [(50, 9)] * 2
    none = spark.createDataFrame([], "doc_id long, start int, secret int")
    rows = secrets.judged(found, none).collect()
    assert [(r["probability"], r["is_secret"]) for r in rows] == [(None, 1)] * 2
    one = spark.createDataFrame([(50, 9, 0), (50, 9, None)], "doc_id long, start int, secret int")
    assert {(r["probability"], r["is_secret"]) for r in secrets.judged(found, one).collect()} == {(0.0, 0)}
    assert secrets.judged(secrets.find_candidates(odd.empty(spark)), one).collect() == []


def test_short_and_letter_only_secrets_are_candidates(spark):
    rows = [
        (1, "password: hunter2 and more"), (2, "API_KEY='abcd'"), (3, "see correcthorsebatterystaple there"), (4, 'Token = "x1"'),
        (5, "passwordless: nothing"), (6, "pwd=p@ss!word;next"), (7, None), (8, "secret=" + "z" * 100_000), (9, "deadbeefdeadbee"),
    ]
    found = secrets.find_candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["start"], r["candidate"][:40]) for r in sorted(found, key=lambda r: r["doc_id"])] == [
        (1, 10, "hunter2"), (2, 9, "abcd"), (3, 4, "correcthorsebatterystaple"), (6, 4, "p@ss!word"), (8, 7, "z" * 40),
    ]


def test_findings_with_clashing_columns(spark):
    docs = findings_of(spark, 60)
    found = secrets.find_candidates(docs, path="path")
    labels = found.join(docs.select("doc_id", "secret"), "doc_id").select("doc_id", "start", "secret")
    clash = found.select("*", F.lit(9).alias("probability"), F.lit("v").alias("_votes"), F.lit("c").alias("class"), F.lit(3).alias("label"))
    rows = secrets.judged(clash, labels)
    assert [c for c in rows.columns if c in ("_votes", "class", "label")] == ["_votes", "class", "label"]
    assert {r["_votes"] for r in rows.collect()} == {"v"} and all(0 <= r["probability"] <= 1 for r in rows.collect())
    assert secrets.judged(clash.limit(0), labels).collect() == []
