import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from weftwork.llm import simhash


def groups_by_brute_force(codes, distance=4):
    """Smallest place of every connected group."""
    parent = list(range(len(codes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(codes))]


def test_shingle_hashes_are_those_of_spark(spark):
    text = "Ab cD  ef\tgh IJ é"
    shingles = ["ab cd ef gh", "cd ef gh ij", "ef gh ij é"]
    hashes = [r[0] & (2**64 - 1) for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 3)
    assert simhash.fingerprint(text) == bits
    one = spark.createDataFrame([("ab c",)], "s string").select(F.xxhash64("s")).first()[0] & (2**64 - 1)
    assert simhash.fingerprint(" AB c ") == one
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_radii_leave_no_pair_out():
    for distance in range(1, 7):
        for parts in range(1, distance + 2):
            plan = simhash.segments(distance, parts)
            assert sum(w for _, w, _ in plan) == 64
            assert sum(r + 1 for _, _, r in plan) == distance + 1


@pytest.mark.parametrize("parts,block", [(3, simhash.BLOCK), (2, simhash.BLOCK), (4, 40), (3, 16)])
def test_links_join_what_brute_force_joins(spark, parts, block):
    draw = random.Random(parts * block)
    codes = {draw.getrandbits(64) for _ in range(60)}
    centre = draw.getrandbits(64)
    for _ in range(250):  # a dense group and its fringe
        code = centre
        for _ in range(draw.randint(0, 7)):
            code ^= 1 << draw.randrange(64)
        codes.add(code)
    codes = sorted(codes)
    table = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "code long")
    links = simhash.code_links(table, 4, parts, block).collect()
    place = {int(np.uint64(c).view(np.int64)): i for i, c in enumerate(codes)}
    parent = list(range(len(codes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        assert (codes[place[a]] ^ codes[place[b]]).bit_count() <= 4
        a, b = root(place[a]), root(place[b])
        parent[max(a, b)] = min(a, b)
    assert [root(i) for i in range(len(codes))] == groups_by_brute_force(codes)


def test_odd_rows(spark):
    docs = odd.documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"], set()).add(r["component"])
    assert of[1] == of[2] == of[8] == {1} and of[5] == {4} and of[7] == {7} and of[10] == {7}
    assert 1 in of[None]  # the row without key and text joins the empty ones
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] or 0 for r in kept.collect())
    assert ids.count(7) == 1 and 5 not in ids and 10 not in ids and ids.count(0) == 2
    assert simhash.near_duplicates(odd.empty(spark)).collect() == []
    assert simhash.one_of_each(odd.empty(spark)).collect() == []


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(simhash.near_duplicates(docs).collect())
    texts = dict(docs.select("doc_id", "text").collect())
    codes = [simhash.fingerprint(texts[r["doc_id"]]) for r in rows]
    assert [r["code"] & (2**64 - 1) for r in rows] == codes
    assert [r["component"] for r in rows] == [rows[i]["doc_id"] for i in groups_by_brute_force(codes)]
