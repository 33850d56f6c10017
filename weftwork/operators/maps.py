"""Maps of items in the plane: stress majorisation over landmarks, and neighbour embedding.

Both work on tables of pairs that share something; no matrix of all items by all items is made.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.operators.ranking import top_rows
from weftwork.session import materialise

Spots = dict[str, tuple[float, float]]

#: Landmarks of a map at most: their table of distances lies in one task.
MOST_LANDMARKS = 1000
_NEAR = 1e-12


# ---------------------------------------------------------------- stress majorisation

def landmark_distances(rows: DataFrame, landmarks: list[str], item: str, feature: str, weight: str) -> DataFrame:
    """(item, cosines): a map from landmark to cosine, landmarks without a common feature left out (cosine 0).

    rows hold one weight per item and feature. Items meet landmarks at their features only.
    """
    if not 0 < len(landmarks) <= MOST_LANDMARKS or len(set(landmarks)) < len(landmarks):
        raise ValueError(f"between 1 and {MOST_LANDMARKS} different landmarks are needed")
    unit = materialise(rows.select(F.col(item).alias("item"), F.col(feature).alias("feature"), F.col(weight).alias("w")), "features")
    norms = unit.groupBy("item").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    norms = materialise(norms, "norms")
    marks = unit.filter(F.col("item").isin(landmarks)).withColumnsRenamed({"item": "landmark", "w": "v"})
    marks = materialise(marks, "landmark-features")
    dots = unit.join(marks, "feature").groupBy("item", "landmark").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    of_mark = norms.withColumnsRenamed({"item": "landmark", "norm": "_n"})
    cosine = F.least(F.lit(1.0), F.try_divide("dot", F.col("norm") * F.col("_n")))
    found = dots.join(norms, "item").join(of_mark, "landmark").select("item", "landmark", cosine.alias("cosine"))
    lists = found.filter("cosine IS NOT NULL").groupBy("item").agg(
        F.map_from_entries(F.collect_list(F.struct("landmark", "cosine"))).alias("cosines")  # MOST_LANDMARKS at most
    )
    nothing = F.create_map().cast("map<string,double>")
    return norms.select("item").join(lists, "item", "left").select(
        F.col("item").alias(item), F.coalesce("cosines", nothing).alias("cosines")
    )


def stress(points: np.ndarray, target: np.ndarray) -> float:
    """Sum over pairs of the squared difference between distance and target."""
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2)) - target
    return float(np.triu(gaps**2, 1).sum())


def guttman(points: np.ndarray, target: np.ndarray) -> np.ndarray:
    """One majorisation step of all points against each other; their stress never rises."""
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    ratio = np.divide(target, apart, out=np.zeros_like(target), where=apart > _NEAR)
    np.fill_diagonal(ratio, 0.0)
    return (ratio.sum(axis=1)[:, None] * points - ratio @ points) / len(points)


def place_landmarks(target: np.ndarray, rounds: int = 300, tolerance: float = 1e-10) -> np.ndarray:
    """Points whose distances approach target: classical scaling, then steps until the stress stops falling.

    Axes follow the largest spread; the point farthest out along each lies on its positive side.
    """
    n = len(target)
    centre = np.eye(n) - 1.0 / n
    values, axes = np.linalg.eigh(-0.5 * centre @ (target**2) @ centre)
    points = np.zeros((n, 2))
    points[:, :min(2, n)] = (axes[:, ::-1] * np.sqrt(np.maximum(values[::-1], 0.0)))[:, :2]
    before = stress(points, target)
    for _ in range(rounds):
        points = guttman(points, target)
        now = stress(points, target)
        if before - now <= tolerance * max(before, 1e-300):
            break
        before = now
    points -= points.mean(axis=0)
    points = points @ np.linalg.eigh(points.T @ points)[1][:, ::-1]
    signs = np.sign(points[np.abs(points.round(9)).argmax(axis=0), range(2)])
    return points * np.where(signs == 0, 1.0, signs)


def landmark_spots(distances: DataFrame, landmarks: list[str], item: str) -> Spots:
    """The landmarks' places, from landmark_distances."""
    target = np.ones((len(landmarks), len(landmarks)))
    place = {name: i for i, name in enumerate(landmarks)}
    for row in distances.filter(F.col(item).isin(landmarks)).collect():  # bounded by MOST_LANDMARKS
        for name, cosine in row["cosines"].items():
            target[place[row[item]], place[name]] = 1.0 - cosine
    target = (target + target.T) / 2
    np.fill_diagonal(target, 0.0)
    return dict(zip(landmarks, map(tuple, place_landmarks(target).tolist())))


def _listed(rows: list[dict], fields: str) -> Column:
    """A constant array of structs, as one literal however many rows there are."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{fields}>>")


def _marks(spots: Spots) -> Column:
    """Per row an array of the landmarks with their places and the row's wanted distance, 1 - cosine."""
    listed = _listed([{"name": name, "x": float(x), "y": float(y)} for name, (x, y) in spots.items()], "name:string,x:double,y:double")
    return F.transform(listed, lambda m: F.struct(
        m["x"].alias("x"), m["y"].alias("y"), (1 - F.coalesce(F.try_element_at("cosines", m["name"]), F.lit(0.0))).alias("wanted")
    ))


def _mean_of(marks: Column, value) -> Column:
    return F.aggregate(marks, F.lit(0.0), lambda total, m: total + value(m)) / F.size(marks)


def _apart(spot: Column, m: Column) -> Column:
    return F.sqrt((spot["x"] - m["x"]) * (spot["x"] - m["x"]) + (spot["y"] - m["y"]) * (spot["y"] - m["y"]))


def majorised(spot: Column, marks: Column) -> Column:
    """One Guttman step of a point against fixed landmarks: the mean of the places where each landmark
    wants it. Its stress never rises."""
    def pulled(axis: str):
        def place(m: Column) -> Column:
            apart = _apart(spot, m)
            return m[axis] + F.when(apart > _NEAR, m["wanted"] / apart * (spot[axis] - m[axis])).otherwise(0.0)

        return place

    return F.struct(_mean_of(marks, pulled("x")).alias("x"), _mean_of(marks, pulled("y")).alias("y"))


def place_points(distances: DataFrame, spots: Spots, item: str, rounds: int = 30) -> DataFrame:
    """(item, x, y, stress) of all items against landmarks at fixed places.

    A point starts between the landmarks, nearer to those it is near to, and takes so many steps. All
    steps of a point happen in its row: nothing is shuffled, whatever the number of items or rounds.
    """
    ready = distances.select(item, _marks(spots).alias("marks"))
    near = lambda m: 1 / (m["wanted"] + 0.05)
    total = _mean_of(F.col("marks"), near)
    start = F.struct(*[(_mean_of(F.col("marks"), lambda m: near(m) * m[a]) / total).alias(a) for a in "xy"])
    moved = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda spot, _: majorised(spot, F.col("marks"))) if rounds else start
    placed = ready.select(item, "marks", moved.alias("spot"))
    gap = lambda m: (_apart(F.col("spot"), m) - m["wanted"]) * (_apart(F.col("spot"), m) - m["wanted"])
    return placed.select(item, "spot.x", "spot.y", (_mean_of(F.col("marks"), gap) * F.size("marks")).alias("stress"))


def stress_map(rows: DataFrame, landmarks: list[str], item: str, feature: str, weight: str, rounds: int = 30) -> DataFrame:
    """(item, x, y, stress): every item near landmarks that it is like, by the distances 1 - cosine.

    The landmarks are placed against each other first, then every item against the landmarks. An item
    without features does not appear; one that shares no feature with a landmark is at distance 1 of it.
    """
    distances = materialise(landmark_distances(rows, landmarks, item, feature, weight), "landmark-distances")
    return place_points(distances, landmark_spots(distances, landmarks, item), item, rounds)


# ---------------------------------------------------------------- neighbour embedding

#: Steps of the bisection for a row's width, and units of a sum in fixed point.
BISECTIONS, UNIT = 60, float(1 << 40)


def nearest_table(pairs: DataFrame, n: int, left: str = "left", right: str = "right", distance: str = "distance") -> DataFrame:
    """(item, other, distance): the n nearest of each item, from unordered pairs; ties by name."""
    both = pairs.select(F.col(left).alias("item"), F.col(right).alias("other"), F.col(distance).alias("distance")).unionByName(
        pairs.select(F.col(right).alias("item"), F.col(left).alias("other"), F.col(distance).alias("distance"))
    )
    return top_rows(both, n, ["item"], [F.col("distance").asc(), F.col("other").asc()])


def calibrated(neighbours: DataFrame, perplexity: float) -> DataFrame:
    """(item, other, p, beta): p = exp(-beta distance^2), scaled to sum 1 per item, has the given perplexity.

    beta is found by bisection between 0 and 2^40. An item with fewer neighbours than the perplexity cannot
    have it and gets beta 0: all its neighbours weigh the same.
    """
    kind = neighbours.schema["item"].dataType.simpleString()
    rows = neighbours.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("distance", "other"))).alias("near"))

    def bisect(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            betas, shares = [], []
            for near in part["near"]:
                square = np.array([x["distance"] for x in near]) ** 2
                beta, share = width(square - square.min(), perplexity)
                betas.append(beta)
                shares.append(share.tolist())
            yield pd.DataFrame({"item": part["item"], "other": [[x["other"] for x in near] for near in part["near"]], "p": shares, "beta": betas})

    found = rows.mapInPandas(bisect, f"item {kind}, other array<{kind}>, p array<double>, beta double")
    zipped = F.explode(F.arrays_zip("other", "p")).alias("_z")
    return found.select("item", "beta", zipped).select("item", F.col("_z.other").alias("other"), F.col("_z.p").alias("p"), "beta")


def width(square: np.ndarray, perplexity: float) -> tuple[float, np.ndarray]:
    """beta and the shares of one item, from squared distances less their smallest."""
    low, high = 0.0, float(1 << 40)
    if len(square) <= perplexity:
        return 0.0, np.full(len(square), 1.0 / len(square))
    for _ in range(BISECTIONS):
        beta = (low + high) / 2
        share = np.exp(-beta * square)
        total = share.sum()
        entropy = np.log(total) + beta * (share @ square) / total
        low, high = (beta, high) if entropy > math.log(perplexity) else (low, beta)
    return beta, share / total


def affinities(shares: DataFrame) -> DataFrame:
    """(item, other, p): symmetric affinities of both directions, their sum 1 over all items."""
    shares = materialise(shares.select("item", "other", "p"), "shares")
    n = shares.select("item").distinct().count()
    both = shares.unionByName(shares.select(F.col("other").alias("item"), F.col("item").alias("other"), "p"))
    return both.groupBy("item", "other").agg((F.sum("p") / (2 * max(1, n))).alias("p"))


@dataclass(frozen=True)
class Schedule:
    """Rounds of the embedding; affinities are exaggerated in the first ones, no step is longer than `longest`."""

    rounds: int = 60
    early: int = 20
    exaggeration: float = 4.0
    longest: float = 2.0
    sample: int = 500
    seed: int = 1


def _exact(value: Column) -> Column:
    """A value in fixed point: sums are the same in any order."""
    return F.round(value * UNIT).cast("decimal(38,0)")


def _closeness(x: Column, y: Column, other_x: Column, other_y: Column) -> Column:
    return 1 / (1 + (x - other_x) * (x - other_x) + (y - other_y) * (y - other_y))


def _push(others: Column, scale: float) -> Column:
    """Struct of z, x, y: how close a row's item is to all others, and their push, both scaled up."""
    def add(total: Column, o: Column) -> Column:
        q = F.when(o["item"] == F.col("item"), 0.0).otherwise(_closeness(F.col("x"), F.col("y"), o["x"], o["y"]) )
        return F.struct(
            (total["z"] + q).alias("z"), (total["x"] + q * q * (F.col("x") - o["x"])).alias("x"), (total["y"] + q * q * (F.col("y") - o["y"])).alias("y")
        )

    zero = F.struct(*[F.lit(0.0).alias(name) for name in "zxy"])
    return F.aggregate(others, zero, add, lambda total: F.struct(*[(total[name] * scale).alias(name) for name in "zxy"]))


def neighbour_map(edges: DataFrame, start: DataFrame, schedule: Schedule = Schedule()) -> DataFrame:
    """(item, x, y): items drawn to those they have affinity with and pushed from all others.

    edges(item, other, p) are symmetric affinities, start(item, x, y) holds every item once. In a round
    every edge pulls its ends together; the push of all other items is that of a sample, chosen by hash
    anew in every round and scaled up (of up to `sample` items all push, and the gradient is exact). Sums
    are taken in fixed point, so the map does not depend on how the tables are partitioned.
    """
    edges = materialise(edges, "affinities")
    state = materialise(start.select("item", "x", "y", F.lit(0.0).alias("vx"), F.lit(0.0).alias("vy")), "places")
    n, kind = state.count(), state.schema["item"].dataType.simpleString()
    if n < 2:
        return state.select("item", "x", "y")
    for number in range(schedule.rounds):
        early = number < schedule.early
        sampled = state.orderBy(F.xxhash64(F.lit(schedule.seed + number), "item"), "item").limit(schedule.sample).select("item", "x", "y").collect()
        pushers = _listed([r.asDict() for r in sampled], f"item:{kind},x:double,y:double")
        push = _push(pushers, n / len(sampled))
        total = float(state.agg(F.sum(_exact(push["z"]))).first()[0]) / UNIT
        ends = state.select(F.col("item").alias("other"), F.col("x").alias("_ox"), F.col("y").alias("_oy"))
        pull = F.col("p") * _closeness(F.col("x"), F.col("y"), F.col("_ox"), F.col("_oy")) * n
        pulled = edges.join(state.select("item", "x", "y"), "item").join(ends, "other").groupBy("item").agg(
            F.sum(_exact(pull * (F.col("x") - F.col("_ox")))).alias("_ax"), F.sum(_exact(pull * (F.col("y") - F.col("_oy")))).alias("_ay")
        )
        rate, keep = n / 2, 0.5 if early else 0.8
        strength = schedule.exaggeration if early else 1.0
        speed = {
            axis: F.col(f"v{axis}") * keep - 4 * rate * (
                strength * F.coalesce(F.col(f"_a{axis}").cast("double"), F.lit(0.0)) / (UNIT * n) - F.col(f"_push.{axis}") / total
            )
            for axis in "xy"
        }
        moved = state.withColumn("_push", push).join(pulled, "item", "left").select("item", "x", "y", speed["x"].alias("vx"), speed["y"].alias("vy"))
        length = F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy"))
        short = F.when(length > schedule.longest, schedule.longest / length).otherwise(1.0)
        moved = moved.select("item", "x", "y", (F.col("vx") * short).alias("vx"), (F.col("vy") * short).alias("vy"))
        state = materialise(moved.withColumns({"x": F.col("x") + F.col("vx"), "y": F.col("y") + F.col("vy")}), "places")
    return state.select("item", "x", "y")


def scattered(items: DataFrame, spread: float = 1e-2, seed: int = 1) -> DataFrame:
    """(item, x, y): a start from the hash of the item."""
    def draw(axis: int) -> Column:
        return (F.pmod(F.xxhash64(F.lit(seed), F.lit(axis), "item"), F.lit(1 << 20)) / float(1 << 20) - 0.5) * spread

    return items.select("item", draw(0).alias("x"), draw(1).alias("y"))


def shrunk(places: DataFrame, spread: float = 1e-2) -> DataFrame:
    """(item, x, y) moved to the middle and scaled to a small spread: a start from another map."""
    middle = places.agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.greatest(F.stddev_pop("x"), F.stddev_pop("y")).alias("s")).first()
    size = spread / middle["s"] if middle["s"] else 0.0
    return places.select("item", *[
        F.round((F.col(a) - float(middle[f"m{a}"] or 0.0)) * size, 12).alias(a) for a in "xy"
    ])
