"""Maps of items: stress majorisation and neighbour embedding against plain computations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftwork.operators import maps as M
from weftwork.operators.vectors import plane_coordinates


def planted(n_groups=5, size=12, seed=3):
    """Items of a few groups: items of one group share most of their features."""
    draw = random.Random(seed)
    rows = []
    for g in range(n_groups):
        for i in range(size):
            for k in range(30):
                if draw.random() < 0.6:
                    rows.append((f"g{g}i{i:02}", f"f{g}-{k}", 1.0 + draw.random()))
            for _ in range(3):
                rows.append((f"g{g}i{i:02}", f"common{draw.randrange(20)}", 0.3))
    return {(a, b): w for a, b, w in rows}


def cosines(weights):
    items = sorted({a for a, _ in weights})
    features = {f: i for i, f in enumerate(sorted({f for _, f in weights}))}
    table = np.zeros((len(items), len(features)))
    for (a, f), w in weights.items():
        table[items.index(a), features[f]] = w
    table /= np.linalg.norm(table, axis=1)[:, None]
    return items, table, table @ table.T


def frame(spark, weights):
    return spark.createDataFrame([(a, f, w) for (a, f), w in weights.items()], "item string, feature string, weight double")


def test_landmark_steps_never_raise_the_stress():
    draw = np.random.default_rng(5)
    points = draw.normal(size=(40, 7))
    target = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    spots = draw.normal(size=(40, 2))
    spots -= spots.mean(axis=0)
    before = M.stress(spots, target)
    for _ in range(50):
        spots = M.guttman(spots, target)
        now = M.stress(spots, target)
        assert now <= before + 1e-9
        before = now
    assert M.stress(M.place_landmarks(target), target) <= before + 1e-6
    flat = draw.normal(size=(20, 2))  # distances in the plane are met exactly
    target = np.sqrt(((flat[:, None] - flat[None]) ** 2).sum(axis=2))
    assert M.stress(M.place_landmarks(target), target) < 1e-9
    assert M.place_landmarks(np.zeros((1, 1))).tolist() == [[0.0, 0.0]]


def test_points_are_placed_by_steps_that_never_raise_their_stress(spark):
    weights = planted()
    items, _, cosine = cosines(weights)
    marks = items[::4]
    distances = M.landmark_distances(frame(spark, weights), marks, "item", "feature", "weight")
    got = {r["item"]: r["cosines"] for r in distances.collect()}
    for i, a in enumerate(items):
        for b in marks:
            assert got[a].get(b, 0.0) == pytest.approx(cosine[i, items.index(b)], abs=1e-9)
    spots = M.landmark_spots(distances, marks, "item")
    before = None
    for rounds in (0, 1, 10):
        rows = {r["item"]: r for r in M.place_points(distances, spots, "item", rounds).collect()}
        for a, r in rows.items():
            want = sum((math.dist((r["x"], r["y"]), spots[b]) - 1 + cosine[items.index(a), items.index(b)]) ** 2 for b in marks)
            assert r["stress"] == pytest.approx(want, abs=1e-9)
            assert before is None or r["stress"] <= before[a]["stress"] + 1e-12
        before = rows
    # Items stand nearer to those of their own group.
    where = np.array([[before[a]["x"], before[a]["y"]] for a in items])
    apart = np.sqrt(((where[:, None] - where[None]) ** 2).sum(axis=2))
    same = np.array([[a[:2] == b[:2] for b in items] for a in items])
    assert apart[same].mean() < 0.6 * apart[~same].mean()


def test_items_that_share_nothing_and_wrong_landmarks(spark):
    rows = spark.createDataFrame([("a", "f", 1.0), ("b", "f", 2.0), ("c", "g", 1.0), ("d", "h", 0.0)], "item string, feature string, weight double")
    got = {r["item"]: r["cosines"] for r in M.landmark_distances(rows, ["a", "c"], "item", "feature", "weight").collect()}
    assert got == {"a": {"a": 1.0}, "b": {"a": 1.0}, "c": {"c": 1.0}, "d": {}}
    assert M.stress_map(rows, ["a", "c"], "item", "feature", "weight").count() == 4
    assert M.stress_map(rows.limit(0), ["a"], "item", "feature", "weight").collect() == []
    for wrong in ([], ["a", "a"], [str(i) for i in range(M.MOST_LANDMARKS + 1)]):
        with pytest.raises(ValueError):
            M.landmark_distances(rows, wrong, "item", "feature", "weight")


def test_calibration_reaches_the_perplexity(spark):
    draw = random.Random(2)
    rows = [(f"i{a}", f"i{b}", draw.random()) for a in range(30) for b in range(a + 1, 30)]
    near = M.nearest_table(spark.createDataFrame(rows, "left string, right string, distance double"), 15)
    found = {}
    for r in M.calibrated(near, 6.0).collect():
        found.setdefault(r["item"], []).append(r["p"])
    assert len(found) == 30 and all(len(p) == 15 for p in found.values())
    for p in found.values():
        assert sum(p) == pytest.approx(1) and math.exp(-sum(x * math.log(x) for x in p)) == pytest.approx(6.0, abs=1e-6)
    few = M.calibrated(near.filter("other IN ('i1', 'i2')"), 6.0).filter("item = 'i9'").collect()
    assert [(r["p"], r["beta"]) for r in few] == [(1 / len(few), 0.0)] * len(few)
    edges = M.affinities(M.calibrated(near, 6.0)).collect()
    table = {(r["item"], r["other"]): r["p"] for r in edges}
    assert sum(table.values()) == pytest.approx(1) and all(table[b, a] == pytest.approx(p) for (a, b), p in table.items())


def kept_neighbours(items, where, cosine, k=8):
    """Share of the k nearest by cosine that are among the k nearest on the map."""
    spots = np.array([where[a] for a in items])
    apart = ((spots[:, None] - spots[None]) ** 2).sum(axis=2)
    np.fill_diagonal(apart, np.inf)
    like = cosine - 2 * np.eye(len(items))
    return np.mean([len(set(np.argsort(apart[i])[:k]) & set(np.argsort(-like[i])[:k])) / k for i in range(len(items))])


def test_map_keeps_neighbours_better_than_components_in_any_partitioning(spark):
    weights = planted(20, 10)
    items, table, cosine = cosines(weights)
    pairs = [(a, items[j], round(float(1 - cosine[i, j]), 9)) for i, a in enumerate(items) for j in range(i + 1, len(items)) if cosine[i, j] > 0]
    near = M.nearest_table(spark.createDataFrame(pairs, "left string, right string, distance double"), 12)
    edges = M.affinities(M.calibrated(near, 5.0)).withColumn("p", F.round("p", 12))
    vectors = spark.createDataFrame([(a, row.tolist()) for a, row in zip(items, table)], "item string, vector array<double>")
    flat = plane_coordinates(vectors, "item", "vector")
    start = M.shrunk(flat.select("item", F.round("x", 9).alias("x"), F.round("y", 9).alias("y")))
    few = M.Schedule(rounds=2, early=1, sample=100)
    maps = [
        {r["item"]: (r["x"], r["y"]) for r in M.neighbour_map(edges.repartition(n), start.repartition(n), few).collect()} for n in (1, 5)
    ]
    assert maps[0] == maps[1] and set(maps[0]) == set(items)
    schedule = M.Schedule(rounds=24, early=8, sample=1000)
    drawn = {r["item"]: (r["x"], r["y"]) for r in M.neighbour_map(edges, start, schedule).collect()}
    flat = {r["item"]: (r["x"], r["y"]) for r in flat.collect()}
    assert kept_neighbours(items, drawn, cosine) > kept_neighbours(items, flat, cosine) + 0.1
    assert M.neighbour_map(edges.limit(0), start.limit(1), schedule).count() == 1
