"""Graphs as vertex and edge tables: vertices(id), edges(src, dst)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.operators.ranking import top_rows
from weftwork.session import discard, materialise

DELETED = "[deleted]"


# ---------------------------------------------------------------- building

def build_graph(
    edges: DataFrame, nodes: DataFrame | None = None, directed: bool = False,
    key: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges). Undirected edges are stored smaller id first; equal edges become one.

    With a key column parallel edges stay apart. Isolated vertices must be listed in nodes.
    """
    ends = [F.col("src"), F.col("dst")]
    if not directed:
        ends = [F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")]
    kept = edges.select(*ends, *([key] if key else [])).distinct()
    ids = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    if nodes is not None:
        ids = ids.unionByName(nodes.select("id"))
    return ids.distinct(), kept


def last_written(updates: DataFrame, keys: list[str], seq: str, attributes: list[str]) -> DataFrame:
    """One row per key; every attribute holds its last non-NULL value by seq."""
    return updates.groupBy(*keys).agg(
        *[
            F.max_by(a, F.when(F.col(a).isNotNull(), F.col(seq))).alias(a)
            for a in attributes
        ]
    )


def with_attributes(nodes: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Node rows that have a partner in the attribute table."""
    return nodes.join(table, key, "inner")


# ---------------------------------------------------------------- degrees

def degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, degree), a self-loop counting twice, isolated vertices 0."""
    seen = edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(
        F.count("*").alias("degree")
    )
    return vertices.select("id").join(seen, "id", "left").select(
        "id", F.coalesce("degree", F.lit(0)).alias("degree")
    )


def directed_degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, in_degree, out_degree, degree)."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(0).alias("_in"), F.lit(1).alias("_out")),
                F.struct(F.col("dst").alias("id"), F.lit(1).alias("_in"), F.lit(0).alias("_out")),
            )
        )
    )
    seen = ends.groupBy("id").agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out"))
    zero = F.lit(0)
    return vertices.select("id").join(seen, "id", "left").select(
        "id", F.coalesce("_in", zero).alias("in_degree"), F.coalesce("_out", zero).alias("out_degree"),
        (F.coalesce("_in", zero) + F.coalesce("_out", zero)).alias("degree"),
    )


def degree_centrality(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, degree, centrality) with centrality = degree / (n - 1), 1 for a single vertex."""
    n = vertices.agg(F.count("*")).scalar()
    return degrees(vertices, edges).select(
        "id", "degree",
        F.coalesce(F.try_divide(F.col("degree"), n - 1), F.lit(1.0)).alias("centrality"),
    )


def most_central(vertices: DataFrame, edges: DataFrame, n: int = 3) -> DataFrame:
    return top_rows(degree_centrality(vertices, edges), n, [], [F.col("centrality").desc(), F.col("id").asc()])


# ---------------------------------------------------------------- comments

def known_author(author: str | Column) -> Column:
    author = F.col(author) if isinstance(author, str) else author
    return author.isNotNull() & (author != DELETED)


def comment_tree(comments: DataFrame, include_root: bool = True) -> tuple[DataFrame, DataFrame]:
    """(vertices(id, type, author), edges(src, dst)): post to top comment, comment to reply.

    A reply whose parent is not in the table hangs on nothing. The parent is sought without
    regard to row order.
    """
    ids = comments.select(F.col("comment_id").alias("parent_id"))
    replies = (
        comments.filter(F.col("parent_id").isNotNull()).select("parent_id", "comment_id")
        .join(ids, "parent_id", "left_semi")
        .select(F.col("parent_id").alias("src"), F.col("comment_id").alias("dst"))
    )
    nodes = comments.select(F.col("comment_id").alias("id"), F.lit("comment").alias("type"), "author")
    if not include_root:
        return nodes, replies
    tops = comments.filter(F.col("parent_id").isNull())
    posts = tops.select(F.col("post_id").alias("id")).distinct().select(
        "id", F.lit("post").alias("type"), F.lit(None).cast("string").alias("author")
    )
    roots = tops.select(F.col("post_id").alias("src"), F.col("comment_id").alias("dst"))
    return nodes.unionByName(posts), replies.unionByName(roots)


def reply_pairs(comments: DataFrame) -> DataFrame:
    """(author, parent_author, n): who answered whom how often within a post.

    Answers of one author to one comment are counted before the join.
    """
    answers = (
        comments.filter(F.col("parent_id").isNotNull() & known_author("author"))
        .groupBy("post_id", "parent_id", "author").agg(F.count("*").alias("_n"))
    )
    parents = comments.filter(known_author("author")).select(
        "post_id", F.col("comment_id").alias("parent_id"), F.col("author").alias("parent_author")
    )
    return answers.join(parents, ["post_id", "parent_id"]).groupBy("author", "parent_author").agg(
        F.sum("_n").alias("n")
    )


def user_interactions(comments: DataFrame) -> DataFrame:
    """Undirected distinct (src, dst); answering oneself gives a self-loop."""
    return reply_pairs(comments).select(
        F.least("author", "parent_author").alias("src"),
        F.greatest("author", "parent_author").alias("dst"),
    ).distinct()


def weighted_replies(comments: DataFrame, directed: bool = True) -> DataFrame:
    """(src, dst, weight): number of replies from src to dst."""
    pairs = reply_pairs(comments)
    if directed:
        return pairs.select(F.col("author").alias("src"), F.col("parent_author").alias("dst"),
                            F.col("n").alias("weight"))
    return pairs.groupBy(
        F.least("author", "parent_author").alias("src"),
        F.greatest("author", "parent_author").alias("dst"),
    ).agg(F.sum("n").alias("weight"))


def user_post_network(comments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices(id, side), edges(src=author, dst=post)); side 0 = post, 1 = user; all posts stay."""
    edges = comments.filter(known_author("author")).select(
        F.col("author").alias("src"), F.col("post_id").alias("dst")
    ).distinct()
    posts = comments.select(F.col("post_id").alias("id"), F.lit(0).alias("side")).distinct()
    users = edges.select(F.col("src").alias("id"), F.lit(1).alias("side")).distinct()
    return posts.unionByName(users), edges


# ---------------------------------------------------------------- components

def _contract(links: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """(moves(u, to), links between the new names): every vertex takes the name of the neighbour
    with the smallest hash, or keeps its own if that is smaller.

    A name is always that of a neighbour, so the links between names connect what the links between
    vertices did. Hashes change with the turn, so even a long path shrinks by a constant factor.
    """
    ends = links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    order = F.struct(F.xxhash64("v", F.lit(turn)).alias("h"), F.col("v"))
    own = F.struct(F.xxhash64("u", F.lit(turn)).alias("h"), F.col("u").alias("v"))
    moves = materialise(
        ends.groupBy("u").agg(F.min(order).alias("_least")).select("u", F.least("_least", own)["v"].alias("to")),
        "moves",
    )
    named = links.join(moves, "u").select(F.col("to").alias("_a"), F.col("v").alias("u")).join(moves, "u").select(
        F.least("_a", "to").alias("u"), F.greatest("_a", "to").alias("v")
    )
    return moves, materialise(named.filter(F.col("u") != F.col("v")).distinct(), "links")


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that can be reached, direction ignored.

    Randomised contraction until no link is left; about log(n) rounds, each over fewer links. Names
    are resolved from the last round back to the first. All sides of all joins are written tables,
    so AQE can split the key of a hub or of a giant component.
    """
    links = materialise(
        edges.filter(F.col("src") != F.col("dst")).select(
            F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")
        ).distinct(),
        "links",
    )
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        moves, shorter = _contract(links, len(rounds))
        discard(links)
        rounds.append(moves)
        links = shorter
    ids = vertices.select("id")
    if not rounds:
        return ids.withColumn("component", F.col("id"))
    names = rounds.pop()
    while rounds:
        moves = rounds.pop()
        later = names.select(F.col("u").alias("to"), F.col("to").alias("_last"))
        resolved = materialise(
            moves.join(later, "to", "left").select("u", F.coalesce("_last", "to").alias("to")), "names"
        )
        discard(moves, names)
        names = resolved
    least = materialise(names.groupBy("to").agg(F.min("u").alias("component")), "least")
    found = names.join(least, "to").select(F.col("u").alias("id"), "component")
    return ids.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def induced(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with both ends among the vertices."""
    return edges.join(vertices.select(F.col("id").alias("src")), "src", "left_semi").join(
        vertices.select(F.col("id").alias("dst")), "dst", "left_semi"
    ).select(*edges.columns)


def largest_component(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges of the biggest component; equal sizes go to the smallest id."""
    parts = materialise(connected_components(vertices, edges), "components")
    best = parts.groupBy("component").agg(F.count("*").alias("_n")).orderBy(
        F.col("_n").desc(), F.col("component").asc()
    ).limit(1)
    kept = materialise(parts.join(best, "component", "left_semi").select("id"), "giant")
    # Both ends of an edge share a component, so one end decides.
    return kept, edges.join(kept.select(F.col("id").alias("src")), "src", "left_semi").select(*edges.columns)


def network_stats(vertices: DataFrame, edges: DataFrame, directed: bool = False) -> DataFrame:
    """One row (nodes, edges, density, components)."""
    parts = connected_components(vertices, edges).agg(
        F.count("*").alias("nodes"), F.count_if(F.col("id") == F.col("component")).alias("components")
    )
    parts = parts.withColumn("edges", edges.agg(F.count("*")).scalar())
    factor = 1 if directed else 2
    return parts.select(
        "nodes", "edges",
        F.coalesce(
            F.try_divide(factor * F.col("edges"), F.col("nodes") * (F.col("nodes") - 1)), F.lit(0.0)
        ).alias("density"),
        "components",
    )


def group_sizes(vertices: DataFrame, attribute: str) -> DataFrame:
    """(attribute, n) of vertices; the members are the rows of vertices themselves."""
    return vertices.groupBy(attribute).agg(F.count("*").alias("n"))


def edges_inside_groups(vertices: DataFrame, edges: DataFrame, attribute: str) -> DataFrame:
    """Edges whose ends have the same attribute value, with that value."""
    vertices = materialise(vertices.select("id", attribute), "vertices")
    here = vertices.select(F.col("id").alias("src"), F.col(attribute))
    there = vertices.select(F.col("id").alias("dst"), F.col(attribute).alias("_other"))
    return edges.join(here, "src").join(there, "dst").filter(
        F.col(attribute) == F.col("_other")
    ).select(attribute, *edges.columns)


# ---------------------------------------------------------------- threads

def comment_levels(comments: DataFrame) -> DataFrame:
    """(post_id, comment_id, level), top comments at level 1; an orphan starts a thread of its own.

    Every round doubles the distance a comment looks up, so a chain of length d takes log2(d)
    rounds.
    """
    ids = comments.select(F.col("comment_id").alias("parent_id"), F.lit(True).alias("_known"))
    state = materialise(
        comments.select("post_id", "comment_id", "parent_id").join(ids, "parent_id", "left").select(
            "post_id", "comment_id", F.when(F.col("_known"), F.col("parent_id")).alias("up"),
            F.lit(1).cast("long").alias("level"),
        ),
        "levels",
    )
    left = state.filter(F.col("up").isNotNull()).count()
    while left:
        above = state.select(
            F.col("comment_id").alias("up"), F.col("up").alias("_up2"), F.col("level").alias("_more")
        )
        moved = state.filter(F.col("up").isNotNull()).join(above, "up").select(
            "post_id", "comment_id", F.col("_up2").alias("up"), (F.col("level") + F.col("_more")).alias("level")
        )
        longer = materialise(state.filter(F.col("up").isNull()).unionByName(moved), "levels")
        discard(state)
        state, before = longer, left
        left = state.filter(F.col("up").isNotNull()).count()
        # A chain holds comments at every distance, so each round resolves some unless all are in circles.
        if left == before:
            raise RuntimeError("replies form a circle")
    return state.select("post_id", "comment_id", "level")


def thread_shape(levels: DataFrame) -> DataFrame:
    """(post_id, depth, width, n_comments); width is the size of the fullest level."""
    per_level = levels.groupBy("post_id", "level").agg(F.count("*").alias("_n"))
    return per_level.groupBy("post_id").agg(
        F.max("level").alias("depth"), F.max("_n").alias("width"), F.sum("_n").alias("n_comments")
    )
