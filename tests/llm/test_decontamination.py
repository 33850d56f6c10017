from itertools import combinations

import numpy as np
from pyspark.sql import functions as F
from tests.llm import odd

from weftwork.llm import decontamination as D


def by_brute_force(docs, items):
    """All (document, item) with an alignment that passes, every alignment tried."""
    found = set()
    for doc, text in docs:
        a = D.tokens(text)
        places = {}
        for i, t in enumerate(a):
            places.setdefault(t, []).append(i)
        for item, other in items:
            b = D.tokens(other)
            if len(b) < D.SHORTEST:
                if b and any(a[i:i + len(b)] == b for i in range(len(a) - len(b) + 1)):
                    found.add((doc, item))
                continue
            equal = {}
            for j, t in enumerate(b):
                for i in places.get(t, ()):
                    equal.setdefault(i - j, []).append(j)
            for shift, at in equal.items():
                if len(at) < D.AGREE * D.SHORTEST:
                    continue
                low, high = max(0, -shift), min(len(b), len(a) - shift)
                same = np.zeros(high - low, bool)
                same[np.array(at) - low] = True
                if D.overlap(same):
                    found.add((doc, item))
    return found


def test_masks_find_every_window_with_allowed_substitutions():
    for size in range(D.SHORTEST, D.WINDOW + 1):
        wrong = size - int(np.ceil(D.AGREE * size - 1e-9))
        for bad in combinations(range(size), wrong):
            assert any(
                all(start + p not in bad for p in mask) for mask in D.MASKS for start in range(size - mask[-1])
            ), (size, bad)


def test_overlap():
    same = np.array([0, 0] + [1] * 20 + [0] * 6, bool)
    assert D.overlap(same) == (0, 24, 20)
    assert D.overlap(np.ones(7, bool)) is None and D.overlap(np.array([1, 0] * 12, bool)) is None
    assert D.overlap(np.array([1, 1, 1, 0, 1, 1, 1, 1], bool)) == (0, 8, 7)


def test_documents_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect()}
    want = by_brute_force(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert got == want and want
    kept = {r["doc_id"] for r in D.clean_documents(docs, items).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


def test_substitutions_and_odd_rows(spark):
    passage = odd.words(11, 30).split()
    changed = [w if i % 6 else "zz" for i, w in enumerate(passage)]
    broken = [w if i % 3 else "zz" for i, w in enumerate(passage)]
    part = passage[8:21]
    texts = {
        20: passage, 21: changed, 22: broken, 23: part, 24: part[:6], 25: [w.upper() + "!!" for w in passage], 26: passage + passage,
    }
    rows = [(k, odd.words(k, 50) + " " + " ".join(v) + " " + odd.words(k + 100, 50)) for k, v in texts.items()]
    docs = spark.createDataFrame([(k, t, None, "c", "f", "r", "w", "y", "s") for k, t in rows], odd.SCHEMA).unionByName(odd.documents(spark))
    items = spark.createDataFrame(
        [(5, " ".join(passage), 1), (6, " ".join(passage).upper(), 1), (7, None, 1), (8, "", 1), (9, "one two", 1), (None, None, 1)],
        "item_id long, text string, doc_id int",
    )
    got = {(r["doc_id"], r["item_id"]): r for r in D.contaminated(docs, items).collect()}
    assert set(got) == {(k, 5) for k in (20, 21, 23, 25, 26)}
    assert got[20, 5]["doc_start"] == 50 and got[20, 5]["n_same"] == 30 and got[20, 5]["share"] == 1.0
    assert got[23, 5]["item_start"] <= 8 and got[23, 5]["n_same"] == 13
    kept = D.clean_documents(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 5
    assert D.contaminated(odd.empty(spark), items).collect() == []
    assert D.contaminated(docs, items.filter("false")).collect() == []
    assert D.clean_documents(docs, items.filter("false")).count() == docs.count()


def test_items_below_the_window_are_found_whole(spark):
    docs = [(1, "a b c d e f g"), (2, "a b c d x e"), (3, "A, b! c d e - a b c d e"), (4, None), (5, "e"), (6, "b c d e f g h i j a"), (7, "g f")]
    items = [(1, "a b c d e"), (2, "E"), (3, "c d"), (4, "f g h i j a b"), (5, "b c d e f g h"), (6, ""), (7, "Q"), (8, "C D")]
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    # Items 3 and 8 have the same tokens and count as item 3.
    assert {(r["doc_id"], r["item_id"]) for r in got} == {p for p in by_brute_force(docs, items) if p[1] != 8}
    third = next(r for r in got if (r["doc_id"], r["item_id"]) == (3, 1))
    assert (third["doc_start"], third["item_start"], third["n_tokens"], third["n_same"], third["share"]) == (0, 0, 5, 5, 1.0)


def test_the_filter_grows_with_the_seeds(spark):
    few, many = (spark.range(n).select(F.xxhash64("id").alias("seed")) for n in (10, 200_000))
    for seeds, least in ((few, D.FILTER_LEAST), (many, 1024 * 200_000)):
        packed, size = D._filter(seeds)
        assert size >= least and len(packed) * 32 == size
        held = np.array([r["seed"] for r in seeds.limit(1000).collect()]).view(np.uint64)
        other = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
        known = [np.all([(packed[p >> 5] >> (p & 31).astype(np.uint32)) & 1 for p in D._probes(x, size)], axis=0) for x in (held, other)]
        assert known[0].all() and known[1].mean() < 1e-3
