import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from weftwork.operators import community as M
from weftwork.operators import graph as G
from weftwork.operators import pairs as P
from weftwork.operators import similarity as U
from weftwork.operators import twomode as K
from weftwork.plans.network import QUERIES
from weftwork.session import materialise


def edge_table(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string")


def test_build_graph(spark):
    edges = edge_table(spark, [("A", "B"), ("B", "A"), ("B", "C")])
    nodes = spark.createDataFrame([("Z",)], "id string")
    vertices, undirected = G.build_graph(edges, nodes)
    assert vertices.count() == 4 and undirected.count() == 2
    assert G.build_graph(edges, directed=True)[1].count() == 3
    keyed = edges.withColumn("k", F.lit(1)).unionByName(edges.withColumn("k", F.lit(2)))
    assert G.build_graph(keyed, key="k")[1].count() == 4
    rows = {r["id"]: r["degree"] for r in G.degrees(vertices, undirected.unionByName(edge_table(spark, [("C", "C")]))).collect()}
    assert rows == {"A": 1, "B": 2, "C": 3, "Z": 0}


def test_last_written(spark):
    df = spark.createDataFrame([("a", 1, 20, None), ("a", 2, None, "car"), ("a", 3, 21, None)], "id string, seq int, age int, travel string")
    assert tuple(G.last_written(df, ["id"], "seq", ["age", "travel"]).first()) == ("a", 21, "car")


COMMENTS = [
    ("1", None, "p", "ann"), ("2", "1", "p", "bob"), ("3", "2", "p", "ann"), ("4", "3", "p", "ann"),
    ("5", "1", "p", "[deleted]"), ("6", "5", "p", "bob"), ("7", "lost", "p", "cid"), ("8", None, "q", None),
    ("9", "8", "q", "cid"), ("10", "1", "p", "bob"),
]


@pytest.fixture(scope="module")
def comments(spark):
    return spark.createDataFrame(COMMENTS, "comment_id string, parent_id string, post_id string, author string")


def test_threads(comments):
    nodes, edges = G.comment_tree(comments)
    assert {tuple(r) for r in edges.collect()} == {
        ("p", "1"), ("1", "2"), ("2", "3"), ("3", "4"), ("1", "5"), ("5", "6"), ("q", "8"), ("8", "9"), ("1", "10")
    }
    assert nodes.filter("type = 'post'").count() == 2
    assert G.comment_tree(comments, include_root=False)[1].count() == 7
    assert {tuple(r) for r in G.user_interactions(comments).collect()} == {("ann", "bob"), ("ann", "ann")}
    assert {tuple(r) for r in G.weighted_replies(comments).collect()} == {("bob", "ann", 2), ("ann", "bob", 1), ("ann", "ann", 1)}
    assert {tuple(r) for r in G.weighted_replies(comments, directed=False).collect()} == {("ann", "bob", 3), ("ann", "ann", 1)}
    vertices, edges = G.user_post_network(comments)
    assert edges.count() == 4 and vertices.count() == 5
    shape = {r["post_id"]: (r["depth"], r["width"]) for r in G.thread_shape(G.comment_levels(comments)).collect()}
    assert shape == {"p": (4, 3), "q": (2, 1)}


def test_circular_replies_are_refused(spark):
    df = spark.createDataFrame([("1", "2", "p"), ("2", "1", "p")], "comment_id string, parent_id string, post_id string")
    with pytest.raises(RuntimeError):
        G.comment_levels(df)


def union_find(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark):
    draw = random.Random(5)
    edges = [(f"n{draw.randrange(300):03}", f"n{draw.randrange(300):03}") for _ in range(200)]
    edges += [(f"x{i:03}", f"x{i + 1:03}") for i in range(60)]
    table = edge_table(spark, edges)
    vertices, _ = G.build_graph(table)
    got = {r["id"]: r["component"] for r in G.connected_components(vertices, table).collect()}
    assert got == union_find(edges)
    kept, inside = G.largest_component(vertices, table)
    sizes = {}
    for c in got.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert kept.count() == max(sizes.values())
    stats = G.network_stats(*G.build_graph(table)).first()
    assert stats["components"] == len(sizes) and stats["nodes"] == len(got)


def test_stats_of_a_single_vertex(spark):
    vertices = spark.createDataFrame([("a",)], "id string")
    r = G.network_stats(vertices, edge_table(spark, []))
    assert tuple(r.first()) == (1, 0, 0.0, 1)


def test_communities(spark):
    groups = [[f"{g}{i}" for i in range(6)] for g in "abc"]
    edges = [e for g in groups for e in itertools.combinations(g, 2)] + [("a0", "b0"), ("b1", "c1")]
    table = edge_table(spark, edges)
    vertices, _ = G.build_graph(table)
    found = M.communities(vertices, table).collect()
    assert len(found) == 18
    parts = {}
    for r in found:
        parts.setdefault(r["community"], set()).add(r["id"])
    assert sorted(map(sorted, parts.values())) == groups and set(parts) == {0, 1, 2}
    q = M.modularity(table, spark.createDataFrame(found)).first()["modularity"]
    m = len(edges)
    assert q == pytest.approx(sum(15 / m - (d / (2 * m)) ** 2 for d in (31, 32, 31)))


def test_split_keys_give_every_pair_once(spark):
    rows = [("hot", f"m{i:03}") for i in range(90)] + [("cold", f"m{i:03}") for i in range(0, 90, 9)]
    df = materialise(spark.createDataFrame(rows, "k string, m string"))
    got = [tuple(r) for r in P.pairs_within(df, "k", "m", block_rows=7).select("k", "left", "right").collect()]
    want = [(k, a, b) for k in ("hot", "cold") for a, b in itertools.combinations([m for q, m in rows if q == k], 2)]
    assert sorted(got) == sorted(want)


def random_vectors(seed, hub=False):
    draw = random.Random(seed)
    vectors = {}
    for o in range(60):
        items = {f"i{min(int(draw.expovariate(0.15)), 40)}" for _ in range(draw.randrange(1, 9))}
        if hub and o % 3:
            items = {"hub"} if o % 3 == 1 else items | {"hub"}
        vectors[f"o{o:02}"] = {i: 1.0 + draw.random() for i in sorted(items)}
    vectors["o98"] = dict(vectors["o05"])
    for v in vectors.values():
        length = math.sqrt(sum(x * x for x in v.values()))
        for i in v:
            v[i] /= length
    return vectors


@pytest.mark.parametrize("hub", [False, True])
@pytest.mark.parametrize("bound", [0.2, 0.5, 0.9])
def test_bounded_pairs_are_complete(spark, bound, hub):
    vectors = random_vectors(3, hub)
    rows = [(o, i, w) for o, v in vectors.items() for i, w in v.items()]
    df = materialise(spark.createDataFrame(rows, "owner string, item string, weight double"))
    want = {
        (a, b) for a, b in itertools.combinations(sorted(vectors), 2)
        if sum(w * vectors[b].get(i, 0.0) for i, w in vectors[a].items()) >= bound
    }
    got = {(r["left"], r["right"]) for r in P.similar_pairs(df, bound).collect()}
    assert got == want


@pytest.mark.parametrize("few", [True, False])
def test_document_classes_expand_to_all_pairs(spark, few, monkeypatch):
    from weftwork.operators.vectors import document_similarities, expand_classes

    monkeypatch.setattr(P, "_PAIRS_PER_ROW", 1000 if few else 0)
    vectors = random_vectors(4, True)
    rows = [(o, i, w) for o, v in vectors.items() for i, w in v.items()]
    df = spark.createDataFrame(rows, "doc string, term string, weight double")
    pairs, members = document_similarities(df, "doc", 0.6)
    got = {(r["left"], r["right"]): r["similarity"] for r in expand_classes(pairs, members).collect()}
    want = {}
    for a, b in itertools.combinations(sorted(vectors), 2):
        s = sum(w * vectors[b].get(i, 0.0) for i, w in vectors[a].items())
        if s >= 0.6:
            want[(a, b)] = s
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def brute_users(edges, metric):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = []
    for a, b in itertools.combinations(sorted(near), 2):
        c, x, y = len(near[a] & near[b]), len(near[a]), len(near[b])
        if c:
            out.append((a, b, {"cosine": c / math.sqrt(x * y), "jaccard": c / (x + y - c), "euclidean": math.sqrt(x + y - 2 * c)}[metric]))
    sign = 1 if metric == "euclidean" else -1
    return sorted(out, key=lambda r: (sign * round(r[2], 12), r[0], r[1]))


@pytest.mark.parametrize("metric", U.METRICS)
@pytest.mark.parametrize("few", [True, False])
def test_similar_users(spark, metric, few, monkeypatch):
    monkeypatch.setattr(P, "_PAIRS_PER_ROW", 1000 if few else 0)
    draw = random.Random(8)
    edges = {tuple(sorted((f"u{draw.randrange(25):02}", f"u{draw.randrange(25):02}"))) for _ in range(60)}
    # A third of the users only know the hub.
    edges |= {("hub", f"v{i:02}") for i in range(14)} | {("hub", "u01")}
    table = edge_table(spark, sorted(edges))
    want = brute_users(edges, metric)
    # A list of distances also holds pairs without a common neighbour.
    listed = want
    if metric == "euclidean":
        listed = sorted(all_pairs_by_brute_force(edges, metric), key=lambda r: (round(r[2], 12), r[0], r[1]))
    for n in (5, 120):
        got = [tuple(r) for r in U.find_similar_users(table, giant_component=False, top_n=n, metric=metric).collect()]
        assert [g[:2] for g in got] == [w[:2] for w in listed[:n]]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in listed[:n]])
    everything = U.find_similar_users(table, giant_component=False, metric=metric).collect()
    assert {(r["user1"], r["user2"]) for r in everything} == {w[:2] for w in want}
    if metric != "euclidean":
        some = U.find_similar_users(table, giant_component=False, metric=metric, min_similarity=0.4).collect()
        assert {(r["user1"], r["user2"]) for r in some} == {w[:2] for w in want if w[2] >= 0.4}


def test_co_purchases(spark):
    cells = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "b")], "row_item int, col_item string")
    assert {tuple(r) for r in K.project(cells).collect()} == {(1, 2, 2), (1, 3, 1), (2, 3, 1)}
    assert {tuple(r) for r in K.project(cells, diagonal=True).collect()} >= {(1, 1, 2), (3, 3, 1)}
    assert {tuple(r) for r in K.project(cells, onto="col_item").collect()} == {("a", "b", 2)}


@pytest.mark.parametrize("weighted", [False, True])
def test_bounded_projections(spark, monkeypatch, weighted):
    draw = random.Random(5)
    held = {(f"h{h}", f"i{int(60 * draw.random() ** 2)}"): draw.randint(-2, 6) for h in range(40) for _ in range(12)}
    held |= {("hub", f"i{i}"): 1 for i in range(60)}
    table = spark.createDataFrame([(*k, w) for k, w in held.items()], "row_item string, col_item string, w long")
    want = {}
    for a, b in itertools.combinations(sorted({h for h, _ in held}), 2):
        both = [(held[a, i], held[b, i]) for i in {i for _, i in held} if (a, i) in held and (b, i) in held]
        if both:
            want[a, b] = sum(x * y for x, y in both) if weighted else len(both)
    ranked = sorted(((*k, w) for k, w in want.items()), key=lambda r: (-r[2], r[:2]))
    weight = F.col("w") if weighted else None
    for per_row, leasts, counts in ((0, (9,), (790 if weighted else 7,)), (128, (4,), ())):  # pruned, and meeting at every item
        monkeypatch.setattr(P, "_PAIRS_PER_ROW", per_row)
        for least in leasts:
            got = K.project(table, weight=weight, min_weight=least).collect()
            assert {tuple(r) for r in got} == {r for r in ranked if r[2] >= least}
        for n in counts:
            assert [tuple(r) for r in K.project(table, weight=weight, top_n=n).collect()] == ranked[:n]
    both = K.project(table, weight=weight, top_n=20, min_weight=8, diagonal=True).filter("left <> right").collect()
    assert {tuple(r) for r in both} == set([r for r in ranked if r[2] >= 8][:20])
    nothing = table.limit(0)
    assert K.project(nothing, weight=weight, top_n=3).count() == K.project(nothing, weight=weight, min_weight=2).count() == 0


def test_choices(spark):
    wide = spark.createDataFrame([("ann", "nlp", "nets"), ("bob", "nlp", "econ"), ("cid", "nlp", "nets")], "student string, c1 string, c2 string")
    long = K.melt(wide, ["student"], ["c1", "c2"], value="course")
    assert long.count() == 6
    cells = K.incidence(long, "student", "course")
    pairs = {tuple(r) for r in K.project(cells).collect()}
    assert pairs == {("ann", "bob", 1), ("ann", "cid", 2), ("bob", "cid", 1)}
    widths = {r["weight"]: r["width"] for r in K.scaled_weights(K.project(cells)).collect()}
    assert widths == {1: 1.5, 2: 3.0}
    row = K.incidence_matrix(cells, ["econ", "nets"]).filter("row_item = 'bob'").first()
    assert (row["econ"], row["nets"]) == (1, 0)


# ---------------------------------------------------------------- communities with known optima

def test_communities_of_a_path(spark):
    edges = spark.range(400).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = materialise(M.communities(spark.range(401), edges, 0.8))
    assert M.modularity(edges, found, 0.8).first()[0] > 0.90


def test_communities_of_two_cliques(spark):
    rows = [(a + x, a + y) for a in (0, 10) for x in range(6) for y in range(x)] + [(0, 10)]
    edges = spark.createDataFrame(rows, "src long, dst long")
    vertices = spark.createDataFrame([(i,) for a in (0, 10) for i in range(a, a + 6)] + [(99,)], "id long")
    found = {r["id"]: r["community"] for r in M.communities(vertices, edges).collect()}
    assert len({found[i] for i in range(6)}) == len({found[i] for i in range(10, 16)}) == 1
    assert len(set(found.values())) == 3


def test_quality_rises_every_round(spark):
    rows = [(i, (i * i + 7 * i) % 60) for i in range(60)] + [(0, i) for i in range(1, 40)]
    edges, strengths, total = M.start_tables(spark.createDataFrame(rows, "src long, dst long"))
    merges = {r["id"]: r["to"] for r in M.merge_round(edges, strengths, total).collect()}
    assert merges and not set(merges) & set(merges.values())
    ids = {x for r in rows for x in r}
    quality = []
    for names in ({}, merges):
        member = spark.createDataFrame([(i, names.get(i, i)) for i in ids], "id long, community long")
        quality.append(M.modularity(spark.createDataFrame(rows, "src long, dst long"), member).first()[0])
    assert quality[1] > quality[0]


# ---------------------------------------------------------------- lists over all pairs

def all_pairs_by_brute_force(links, metric):
    sets = {}
    for a, b in links:
        sets.setdefault(a, set()).add(b)
        sets.setdefault(b, set()).add(a)
    out = []
    for u in sorted(sets):
        for v in sorted(sets):
            if u < v:
                c, d = len(sets[u] & sets[v]), len(sets[u]) + len(sets[v])
                out.append((u, v, {"euclidean": (d - 2 * c) ** 0.5, "cosine": c / (len(sets[u]) * len(sets[v])) ** 0.5, "jaccard": c / (d - c)}[metric]))
    return out


@pytest.mark.parametrize("metric,ascending", [("euclidean", None), ("euclidean", False), ("cosine", None), ("cosine", True), ("jaccard", None)])
def test_lists_hold_pairs_without_a_common_neighbour(spark, metric, ascending):
    draw = random.Random(5)
    shapes = {
        "path": [("a", "b"), ("b", "c"), ("c", "d")],
        "parts": [(f"x{i}", f"y{i % 4}") for i in range(20)] + [(f"p{i}", f"q{i}") for i in range(10)],
        "random": sorted({(f"u{draw.randrange(25)}", f"v{draw.randrange(12)}") for _ in range(60)}),
    }
    up = metric == "euclidean" if ascending is None else ascending
    for links in shapes.values():
        edges = spark.createDataFrame(links, "src string, dst string")
        for n in (3, 40):
            got = U.find_similar_users(edges, False, n, metric, ascending=ascending, include_zero=True).collect()
            want = sorted(all_pairs_by_brute_force(links, metric), key=lambda r: (r[2] if up else -r[2], r[0], r[1]))[:n]
            assert [r["similarity"] for r in got] == pytest.approx([w[2] for w in want], abs=1e-9)
            assert [(r["user1"], r["user2"]) for r in got] == [w[:2] for w in want]


# The friendships of a karate club (Zachary 1977).
KARATE = """1-2 1-3 1-4 1-5 1-6 1-7 1-8 1-9 1-11 1-12 1-13 1-14 1-18 1-20 1-22 1-32 2-3 2-4 2-8 2-14 2-18 2-20 2-22 2-31 3-4 3-8 3-9
3-10 3-14 3-28 3-29 3-33 4-8 4-13 4-14 5-7 5-11 6-7 6-11 6-17 7-17 9-31 9-33 9-34 10-34 14-34 15-33 15-34 16-33 16-34 19-33
19-34 20-34 21-33 21-34 23-33 23-34 24-26 24-28 24-30 24-33 24-34 25-26 25-28 25-32 26-32 27-30 27-34 28-34 29-32 29-34
30-33 30-34 31-33 31-34 32-33 32-34 33-34"""


def quality_of(edges, of, resolution):
    m, strength, inside = len(edges), {}, 0
    for a, b in edges:
        inside += of[a] == of[b]
        for v in (a, b):
            strength[of[v]] = strength.get(of[v], 0) + 1
    return inside / m - resolution * sum(s * s for s in strength.values()) / (4 * m * m)


def test_moved_vertices_raise_the_quality_of_the_club(spark):
    edges = [tuple(map(int, e.split("-"))) for e in KARATE.split()]
    table = spark.createDataFrame(edges, "src long, dst long")
    vertices = spark.createDataFrame([(i,) for i in range(1, 35)] + [(99,)], "id long")
    before = {r["id"]: r["community"] for r in M.communities(vertices, table, 0.8).collect()}
    after = {r["id"]: r["community"] for r in M.moved_communities(vertices, table, 0.8).collect()}
    assert set(after) == {*range(1, 35), 99} and sorted(set(after.values())) == list(range(len(set(after.values()))))
    assert quality_of(edges, after, 0.8) >= quality_of(edges, before, 0.8) - 1e-9
    # No vertex gains by moving to the community of a neighbour.
    best = quality_of(edges, after, 0.8)
    for v in range(1, 35):
        for target in {after[b if a == v else a] for a, b in edges if v in (a, b)}:
            assert quality_of(edges, {**after, v: target}, 0.8) <= best + 1e-9


def test_a_moving_round_raises_the_quality(spark):
    draw = random.Random(9)
    rows = sorted({(a, b) for a, b in ((draw.randrange(60), draw.randrange(60)) for _ in range(220)) if a != b} | {(0, i) for i in range(1, 50)})
    edges, strengths, total = M.start_tables(spark.createDataFrame(rows, "src long, dst long"))
    of = {v: draw.randrange(6) for v in range(60)}
    rounds = 0
    for salt in range(4):
        member = spark.createDataFrame(list(of.items()), "id long, community long")
        places = materialise(M.better_places(edges, strengths, member, total))
        for r in places.orderBy("id", "to").limit(40).collect():  # a single move is worth what it says
            gain = quality_of(rows, {**of, r["id"]: r["to"]}, 1.0) - quality_of(rows, of, 1.0)
            assert gain * len(rows) == pytest.approx(r["gain"], abs=1e-6)
        moves = {r["id"]: r["to"] for r in M.moving_round(places, total, 1.0, salt).collect()}
        assert not set(moves.values()) & {of[v] for v in moves}
        if moves:
            rounds += 1
            assert quality_of(rows, {**of, **moves}, 1.0) > quality_of(rows, of, 1.0)
        of.update(moves)
    assert rounds >= 2


def test_disconnected_communities_are_taken_apart(spark):
    edges, _, _ = M.start_tables(spark.createDataFrame([(1, 2), (2, 3), (4, 5), (3, 4)], "src long, dst long"))
    member = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, 7), (5, 7), (6, 7)], "id long, community long")
    assert dict(M.connected_parts(edges, member).collect()) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6}


@pytest.mark.parametrize("top_n", [1, 12, 400])
def test_nearest_sets_are_found_without_scoring_all_that_share(spark, monkeypatch, top_n):
    monkeypatch.setattr(U.P, "few_pairs", lambda rows: False)
    draw = random.Random(top_n)
    base = [{f"i{draw.randrange(40)}" for _ in range(draw.randint(1, 12))} | {"hub"} for _ in range(25)]
    links = []
    for k, items in enumerate(base * 2):  # every set has a copy, some with an item more or less
        kept = sorted(items)[draw.randrange(3):] if draw.random() < 0.6 else sorted(items)
        links += [(f"u{k:02}", i) for i in kept] + ([(f"u{k:02}", f"own{k}")] if draw.random() < 0.5 else [])
    got = U.find_similar_users(spark.createDataFrame(links, "src string, dst string"), False, top_n, "euclidean").collect()
    want = sorted(all_pairs_by_brute_force(links, "euclidean"), key=lambda r: (round(r[2], 12), r[0], r[1]))[:top_n]
    assert [(r["user1"], r["user2"]) for r in got] == [w[:2] for w in want]


# ---------------------------------------------------------------- sums over meetings

@pytest.mark.parametrize("block_rows", [3, 1000])
def test_pair_totals_sum_all_meetings(spark, monkeypatch, block_rows):
    monkeypatch.setattr(P, "MEETINGS_PER_TASK", 50)
    draw = random.Random(5)
    rows = [(f"i{draw.randrange(9)}", f"o{draw.randrange(25)}", float(draw.randrange(1, 5))) for _ in range(150)]
    rows += rows[:4] + [(None, "o1", 1.0), (None, "o2", 1.0), ("i1", None, 1.0), ("i2", "o3", None)]
    rows += [(f"j{k}", "hub", 1.0) for k in range(12)] + [(f"j{k}", f"o{k}", 2.0) for k in range(12)]
    want = {}
    for (i, a, x), (j, b, y) in itertools.product(rows, rows):
        if i is not None and i == j and a is not None and b is not None and a < b:
            total = want.setdefault((a, b), [0, 0])
            total[0] += (x or 0) * (y or 0)
            total[1] += 1
    df = P.materialise(spark.createDataFrame(rows, "item string, owner string, weight double"))
    totals = [F.sum(F.col("left_weight") * F.col("right_weight")).alias("dot"), F.count("*").alias("n")]
    got = P.pair_totals(df, "item", "owner", totals, ["weight"], block_rows=block_rows)
    assert {(r["left"], r["right"]): [r["dot"] or 0, r["n"]] for r in got.collect()} == want
    assert {tuple(r) for r in P.pair_totals(df, "item", "owner", [], block_rows=block_rows).collect()} == set(want)


def test_projection_takes_tasks_by_its_meetings(spark, monkeypatch):
    monkeypatch.setattr(P, "MEETINGS_PER_TASK", 100)
    cells = spark.createDataFrame([(r, c) for c in range(20) for r in range(c, c + 30)], "row_item long, col_item long")
    found = K.project(cells)
    assert found.rdd.getNumPartitions() >= 20 * 435 / 100
    assert {(r["left"], r["right"]): r["weight"] for r in found.collect()} == {
        (a, b): n for a in range(49) for b in range(a + 1, 49) if (n := sum(c <= a and b < c + 30 for c in range(20)))
    }


@pytest.mark.parametrize("metric", ["cosine", "jaccard", "euclidean"])
def test_a_bound_that_saves_nothing_is_given_up(spark, monkeypatch, metric):
    monkeypatch.setattr(U.P, "few_pairs", lambda rows: False)
    draw = random.Random(3)
    edges = [(f"u{a}", f"v{b}") for a in range(30) for b in draw.sample(range(12), 6)]
    asked = []
    opened = P.opened_products
    monkeypatch.setattr(U.P, "opened_products", lambda rows, candidates: asked.append(candidates.count()) or opened(rows, candidates))
    got = U.find_similar_users(spark.createDataFrame(edges, "src string, dst string"), top_n=5, metric=metric, giant_component=False)
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def score(a, b):
        both = len(near[a] & near[b])
        if metric == "euclidean":
            return (len(near[a]) + len(near[b]) - 2 * both) ** 0.5
        return both / ((len(near[a]) * len(near[b])) ** 0.5 if metric == "cosine" else len(near[a] | near[b]))

    every = sorted((round(score(a, b), 12) * (1 if metric == "euclidean" else -1), a, b) for a in near for b in near if a < b)
    assert [(r["user1"], r["user2"]) for r in got.collect()] == [(a, b) for _, a, b in every[:5]]
    assert sum(asked) < 30 * 29 / 2


@pytest.mark.parametrize("metric,ascending", [("cosine", None), ("jaccard", True)])
def test_pairs_without_a_common_neighbour_are_listed_in_order_and_never_shuffled(spark, monkeypatch, metric, ascending):
    monkeypatch.setattr(P, "BLOCK_ROWS", 4)
    monkeypatch.setattr(U, "_PAIRS_PER_TASK", 30)
    draw = random.Random(9)
    for links in ([("a", "b")], sorted({(f"u{draw.randrange(25)}", f"v{draw.randrange(12)}") for _ in range(60)})):
        found = U.find_similar_users(edge_table(spark, links), False, None, metric, ascending=ascending, include_zero=True)
        want = sorted(all_pairs_by_brute_force(links, metric), key=lambda r: (r[2] if ascending else -r[2], r[0], r[1]))
        assert [(r["user1"], r["user2"]) for r in found.collect()] == [w[:2] for w in want]
        assert [r["similarity"] for r in found.collect()] == pytest.approx([w[2] for w in want], abs=1e-9)
        assert "LeftAnti" not in found._jdf.queryExecution().executedPlan().toString()
    empty = U.find_similar_users(edge_table(spark, []), False, None, metric, ascending=ascending, include_zero=True)
    assert empty.collect() == []


@pytest.mark.parametrize("elements", [20, 4_000_000])
def test_bounded_pairs_meet_in_blocks_and_shuffle_neither_meetings_nor_candidates(spark, monkeypatch, elements):
    from weftwork.operators.vectors import document_similarities

    def never(*args, **kwargs):
        raise AssertionError("a meeting or a candidate was shuffled")

    monkeypatch.setattr(P, "few_pairs", lambda rows: False)
    monkeypatch.setattr(P, "_BOUND_SAVES", 0)
    monkeypatch.setattr(P, "BLOCK_ELEMENTS", elements)
    monkeypatch.setattr(P, "_MEETINGS_AT_ONCE", 7)
    for name in ("pair_totals", "opened_products"):
        monkeypatch.setattr(P, name, never)
    draw = random.Random(5)
    vectors = {}
    for d in range(40):
        words = {f"w{draw.randrange(30)}": draw.choice([1.0, 2.0, 5.0]) for _ in range(draw.randrange(1, 9))}
        if d % 4 == 3:
            words = {**vectors[d - 1], f"x{d}": 0.2}
        length = math.sqrt(sum(w * w for w in words.values()))
        vectors[d] = {i: w / length for i, w in words.items()}
    # Parts of a weight in two rows are its whole.
    rows = [(d, i, w * part) for d, v in vectors.items() for i, w in v.items() for part in (0.25, 0.75)]
    pairs, _ = document_similarities(spark.createDataFrame(rows, "doc long, term string, weight double"), "doc", 0.6)
    got = {(r["left"], r["right"]): r["similarity"] for r in pairs.filter("left < right").collect()}
    want = {}
    for a, b in itertools.combinations(sorted(vectors), 2):
        s = sum(w * vectors[b].get(i, 0.0) for i, w in vectors[a].items())
        if s >= 0.6:
            want[a, b] = s
    heads = {a: min(b for b in vectors if vectors[b] == pytest.approx(vectors[a], abs=1e-12)) for a in vectors}
    want = {(a, b): s for (a, b), s in want.items() if heads[a] == a and heads[b] == b}
    assert len(want) > 10
    assert got == pytest.approx(want)


def test_cells_are_gathered_in_tasks_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "ROWS_PER_TASK", 50)
    draw = random.Random(2)
    rows = [(draw.randrange(40), draw.choice([None, *range(30)]), draw.randrange(9)) for _ in range(900)]
    df = spark.createDataFrame(rows, "r long, c long, q long")
    found, summed = K.incidence(df, "r", "c"), K.summed_cells(df, "r", "c", "q")
    known = sum(c is not None for _, c, _ in rows)
    assert found.rdd.getNumPartitions() == math.ceil(known / 50) and summed.rdd.getNumPartitions() == 18
    got = [(r["row_item"], r["col_item"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == {(r, c) for r, c, _ in rows if c is not None}
    want = {}
    for r, c, q in rows:
        want[r, c] = want.get((r, c), 0) + q
    assert {(r["row_item"], r["col_item"]): r["w"] for r in summed.collect()} == want


def test_lists_of_meetings_are_written_by_tasks_that_follow_the_meetings(spark, monkeypatch):
    monkeypatch.setattr(P, "MEETINGS_PER_TASK", 100)
    cells = spark.createDataFrame([(r, c) for c in range(20) for r in range(c, c + 30)], "row_item long, col_item long")
    plan = K.project(cells)._jdf.queryExecution().optimizedPlan().toString()
    tasks = [int(n) for n in re.findall(r"RepartitionByExpression \[item#\d+L?\], (\d+)", plan)]
    assert tasks == [math.ceil(20 * 435 / 400)]


def test_moving_rounds_look_at_borders_only(spark):
    rng = random.Random(11)
    rows = sorted({(min(a, b), max(a, b)) for a, b in ((rng.randrange(30), rng.randrange(30)) for _ in range(90)) if a != b})
    table = spark.createDataFrame(rows, "src long, dst long")
    edges, strengths, total = M.start_tables(table)
    member = materialise(spark.range(30).select("id", (F.col("id") % 4).alias("community")))
    places = materialise(M.better_places(edges, strengths, member, total))
    first = M._open_throw(places, 5)
    assert all(M.moving_round(places, total, 1.0, s).isEmpty() for s in range(5, first)) and not M.moving_round(places, total, 1.0, first).isEmpty()
    # Communities that lost a vertex are all that may fall apart, the others only take their smallest name.
    start = materialise(M.connected_parts(edges, member))
    settled, lost = M._moved(edges, strengths, start, total, 1.0)
    settled, names = materialise(settled), {r[0] for r in lost.collect()}
    before, after = dict(start.collect()), dict(settled.collect())
    assert {before[v] for v in before if before[v] != after[v]} <= names and names
    assert M.better_places(edges, strengths, settled, total).isEmpty()
    every, some = M.connected_parts(edges, settled), M.connected_parts(edges, settled, lost)
    assert dict(some.collect()) == dict(every.collect())


def test_a_vertex_inside_its_community_is_not_looked_at(spark):
    # Two triangles with one link between them: only its two ends have links summed.
    edges = spark.createDataFrame([(1, 2, 1.0), (1, 3, 1.0), (2, 3, 1.0), (4, 5, 1.0), (4, 6, 1.0), (5, 6, 1.0), (3, 4, 1.0)], "a long, b long, w double")
    member = spark.createDataFrame([(i, i > 3) for i in range(1, 7)], "id long, community boolean")
    labels = {}
    write = M.materialise
    M.materialise = lambda df, label: labels.setdefault(label, write(df, label))
    try:
        assert M.better_places(edges, M._strengths(edges), member, 7.0).isEmpty()
    finally:
        M.materialise = write
    assert {r["id"] for r in labels["community-links"].collect()} == {3, 4}


def test_scaled_weights_read_the_shuffled_projection_twice(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(8), rng.randrange(20)) for _ in range(80)]
    spark.createDataFrame(rows, "l_suppkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = QUERIES["K6_scaled_weights"].run(spark, str(tmp_path))
    parts = {s: {p for t, p in rows if t == s} for s, _ in rows}
    want = {(a, b): len(parts[a] & parts[b]) for a, b in itertools.combinations(sorted(parts), 2) if parts[a] & parts[b]}
    most = max(want.values())
    assert {(r["left"], r["right"]): (r["weight"], r["width"]) for r in found.collect()} == {k: (w, round(w / most * 3, 6)) for k, w in want.items()}
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def test_shared_counts_carry_no_weights(spark):
    rng = random.Random(4)
    rows = sorted({(f"u{rng.randrange(12)}", f"i{rng.randrange(9)}") for _ in range(50)})
    table = materialise(spark.createDataFrame([(o, i, 0.5) for o, i in rows], "owner string, item string, weight double"))
    want = {(r["left"], r["right"]): r["common"] for r in P.shared_products(table).collect()}
    counts = P.shared_counts(table)
    assert {(r["left"], r["right"]): r["common"] for r in counts.collect()} == want
    assert "_c_weight" not in counts._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_meet_a_few_pairs_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(P, "_BOUND_SAVES", 0)
    monkeypatch.setattr(P, "BLOCK_ELEMENTS", 30)
    monkeypatch.setattr(P, "BLOCK_PAIRS", 4)
    written, write = [], P.materialise

    def noted(df, label="stage"):
        table = write(df, label)
        written.append((label, df.rdd.getNumPartitions() if label == "found" else 0))
        return table

    monkeypatch.setattr(P, "materialise", noted)
    draw = random.Random(6)
    vectors = {}
    for d in range(40):
        words = {f"w{draw.randrange(12)}": draw.choice([1.0, 2.0, 5.0]) for _ in range(5)}
        length = math.sqrt(sum(w * w for w in words.values()))
        vectors[d] = {i: w / length for i, w in words.items()}
    rows = spark.createDataFrame([(d, i, w) for d, v in vectors.items() for i, w in v.items()], "owner long, item string, weight double")
    found = P.similar_products(P.materialise(rows), 0.8)
    got = {(r["left"], r["right"]): (r["dot"], r["common"]) for r in found.collect()}
    want = {}
    for a in vectors:
        for b in range(a + 1, 40):
            dot = sum(w * vectors[b].get(i, 0.0) for i, w in vectors[a].items())
            if dot >= 0.8:
                want[a, b] = dot, len(set(vectors[a]) & set(vectors[b]))
    assert set(got) == set(want) and len(want) > 5 and found.count() == len(want)
    assert all(got[k][0] == pytest.approx(want[k][0]) and got[k][1] == want[k][1] for k in want)
    at_once = [n for label, n in written if label == "found"]
    assert len(at_once) > 2 and max(at_once) <= 4


def test_all_pairs_are_found_once_before_they_are_sorted(spark, monkeypatch):
    written, write = [], U.materialise
    monkeypatch.setattr(U, "materialise", lambda df, label="stage": written.append(label) or write(df, label))
    links = [(f"u{i}", f"u{j}") for i in range(12) for j in range(i) if (i * j) % 5 == 1]
    found = U.find_similar_users(edge_table(spark, links), False)
    assert "found-pairs" in written and not [x for x in ("Join", "Generate") if x in found._jdf.queryExecution().executedPlan().toString()]
    scores = [r["similarity"] for r in found.collect()]
    assert scores == sorted(scores, reverse=True) and scores
