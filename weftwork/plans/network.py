"""Comment threads, reply networks, components and two-mode networks on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.operators import community as M
from weftwork.operators import graph as G
from weftwork.operators import twomode as K
from weftwork.operators.classify import classification_report, confusion_matrix
from weftwork.operators.cluster import label_clusters
from weftwork.operators.similarity import find_similar_users
from weftwork.plans import snippets as Q
from weftwork.plans.registry import Registry
from weftwork.plans.terms import rounded
from weftwork.plans.text import documents
from weftwork.session import materialise
from weftwork.sources.tables import read_table

QUERIES = Registry()

# A hundred consecutive events form a post; an event answers one a few places before it.
# A few authors are unknown or deleted, a few parents are missing.
COMMENTS = """
    SELECT 'c' || event_id AS comment_id, 'p' || event_id // 100 AS post_id,
           CASE WHEN event_id % 97 = 1 THEN 'lost' || event_id
                WHEN event_id % 100 > user_id % 7 THEN 'c' || (event_id - 1 - user_id % 7) END AS parent_id,
           CASE WHEN event_id % 20 = 0 THEN '[deleted]' WHEN user_id % 50 <> 0 THEN 'u' || user_id END AS author
    FROM events
"""


def comments(spark, folder: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")

    def named(prefix, value):
        return F.concat(F.lit(prefix), value.cast("string"))

    return read_table(spark, folder, "events").select(
        named("c", e).alias("comment_id"), named("p", F.expr("event_id div 100")).alias("post_id"),
        F.when(e % 97 == 1, named("lost", e)).when(e % 100 > u % 7, named("c", e - 1 - u % 7)).alias("parent_id"),
        F.when(e % 20 == 0, G.DELETED).when(u % 50 != 0, named("u", u)).alias("author"),
    )


THREADS = f"WITH RECURSIVE cm AS ({COMMENTS})"
PAIRS = f"""{THREADS}, rp AS (SELECT a.author AS author, b.author AS parent_author, count(*) AS n FROM cm a JOIN cm b
    ON a.post_id = b.post_id AND a.parent_id = b.comment_id WHERE a.author <> '[deleted]' AND b.author <> '[deleted]' GROUP BY ALL),
    e AS (SELECT DISTINCT least(author, parent_author) AS src, greatest(author, parent_author) AS dst FROM rp),
    v AS (SELECT src AS id FROM e UNION SELECT dst FROM e)"""


# ---------------------------------------------------------------- building

SHIP = "SELECT 's' || l_suppkey AS src, 'p' || l_partkey AS dst, l_linenumber AS line FROM lineitem"


def shipments(spark, folder) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"),
        F.col("l_linenumber").alias("line"),
    )


@QUERIES.add("J1_build_graph", f"""
    {PAIRS} SELECT 'directed' AS kind, author AS src, parent_author AS dst FROM rp
    UNION ALL SELECT 'undirected', src, dst FROM e UNION ALL SELECT 'vertex', id, NULL FROM v
""")
def build_graph(spark, folder):
    answers = G.reply_pairs(comments(spark, folder)).select(F.col("author").alias("src"), F.col("parent_author").alias("dst"))
    _, directed = G.build_graph(answers, directed=True)
    vertices, undirected = G.build_graph(answers)
    return (
        directed.select(F.lit("directed").alias("kind"), "src", "dst")
        .unionByName(undirected.select(F.lit("undirected").alias("kind"), "src", "dst"))
        .unionByName(vertices.select(F.lit("vertex").alias("kind"), F.col("id").alias("src"), F.lit(None).cast("string").alias("dst")))
    )


@QUERIES.add("J2_multi_edges", f"SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst, line FROM ({SHIP})")
def multi_edges(spark, folder):
    return G.build_graph(shipments(spark, folder), key="line")[1]


@QUERIES.add("J3_last_written", """
    SELECT user_id AS id, max_by(event_type, event_id) FILTER (event_type <> 'view') AS event_type,
           round(max_by(value, event_id), 6) AS value FROM events GROUP BY user_id
""")
def last_written(spark, folder):
    updates = read_table(spark, folder, "events").select(
        F.col("user_id").alias("id"), "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"), "value"
    )
    return rounded(G.last_written(updates, ["id"], "event_id", ["event_type", "value"]), "value")


def reply_graph(spark, folder) -> tuple[DataFrame, DataFrame]:
    return G.build_graph(G.user_interactions(comments(spark, folder)))


DEGREES = "deg AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id)"


@QUERIES.add("J4_degrees", f"{PAIRS}, {DEGREES} SELECT id, degree FROM deg")
def degrees(spark, folder):
    return G.degrees(*reply_graph(spark, folder))


@QUERIES.add("J4_directed_degrees", f"""
    {PAIRS}, i AS (SELECT parent_author AS id, count(*) AS n FROM rp GROUP BY 1), o AS (SELECT author AS id, count(*) AS n FROM rp GROUP BY 1)
    SELECT id, coalesce(i.n, 0) AS in_degree, coalesce(o.n, 0) AS out_degree, coalesce(i.n, 0) + coalesce(o.n, 0) AS degree
    FROM v LEFT JOIN i USING (id) LEFT JOIN o USING (id)
""")
def directed_degrees(spark, folder):
    answers = G.reply_pairs(comments(spark, folder)).select(F.col("author").alias("src"), F.col("parent_author").alias("dst"))
    return G.directed_degrees(*G.build_graph(answers, directed=True))


@QUERIES.add("J5_node_attributes", f"""
    {PAIRS}, {DEGREES}, t AS (SELECT 'u' || user_id AS id, count(*) AS n_events, round(sum(value), 4) AS total FROM events GROUP BY user_id)
    SELECT id, degree, n_events, total FROM deg JOIN t USING (id)
""")
def node_attributes(spark, folder):
    table = read_table(spark, folder, "events").groupBy(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id")).agg(
        F.count("*").alias("n_events"), F.round(F.sum("value"), 4).alias("total")
    )
    return G.with_attributes(G.degrees(*reply_graph(spark, folder)), table)


@QUERIES.add("J6_most_central", f"""
    {PAIRS}, {DEGREES} SELECT id, degree, round(degree / ((SELECT count(*) FROM v) - 1), 6) AS centrality FROM deg ORDER BY degree DESC, id LIMIT 3
""")
def most_central(spark, folder):
    return rounded(G.most_central(*reply_graph(spark, folder)), "centrality")


@QUERIES.add("J7_comment_tree", f"""
    {THREADS} SELECT post_id AS src, comment_id AS dst FROM cm WHERE parent_id IS NULL
    UNION ALL SELECT parent_id, comment_id FROM cm WHERE parent_id IN (SELECT comment_id FROM cm)
""")
def comment_tree(spark, folder):
    return G.comment_tree(comments(spark, folder))[1]


@QUERIES.add("J7_tree_nodes", f"""
    {THREADS} SELECT comment_id AS id, 'comment' AS type, author FROM cm
    UNION ALL SELECT DISTINCT post_id, 'post', NULL FROM cm WHERE parent_id IS NULL
""")
def tree_nodes(spark, folder):
    return G.comment_tree(comments(spark, folder))[0]


@QUERIES.add("J8_user_interactions", f"{PAIRS} SELECT src, dst FROM e")
def user_interactions(spark, folder):
    return G.user_interactions(comments(spark, folder))


@QUERIES.add("J9_weighted_replies", f"{PAIRS} SELECT author AS src, parent_author AS dst, n AS weight FROM rp")
def weighted_replies(spark, folder):
    return G.weighted_replies(comments(spark, folder))


@QUERIES.add("J10_user_post_network", f"{THREADS} SELECT DISTINCT author AS src, post_id AS dst FROM cm WHERE author <> '[deleted]'")
def user_post_network(spark, folder):
    return G.user_post_network(comments(spark, folder))[1]


# ---------------------------------------------------------------- components

# Documents and the distinct lines they contain, as one graph.
LINES = """ed AS (SELECT DISTINCT 'd' || doc_id AS src, 'l' || md5(line) AS dst
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line) <> ''),
    vx AS (SELECT src AS id FROM ed UNION SELECT dst FROM ed),
    b AS (SELECT src AS a, dst AS b FROM ed UNION ALL SELECT dst, src FROM ed)"""
COMPONENTS = f"""WITH RECURSIVE {LINES},
    cc(id, component) USING KEY (id) AS (
        SELECT a, min(least(a, b)) FROM b GROUP BY a
        UNION
        SELECT b.a, min(cc.component) FROM cc JOIN b ON b.b = cc.id JOIN recurring.cc r ON r.id = b.a
        WHERE cc.component < r.component GROUP BY b.a),
    giant AS (SELECT component FROM cc GROUP BY component ORDER BY count(*) DESC, component LIMIT 1)"""


def line_graph(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Written once: vertices, links and counts are all derived from the links."""
    lines = documents(spark, folder).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    edges = lines.filter(F.trim("line") != "").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("src"), F.concat(F.lit("l"), F.md5("line")).alias("dst")
    ).distinct()
    edges = materialise(edges, "line-edges")
    return materialise(edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), "line-vertices"), edges


@QUERIES.add("J11_network_stats", f"""{COMPONENTS}
    SELECT (SELECT count(*) FROM vx) AS nodes, (SELECT count(*) FROM ed) AS edges,
           round(2 * (SELECT count(*) FROM ed) / ((SELECT count(*) FROM vx) * ((SELECT count(*) FROM vx) - 1)), 9) AS density,
           (SELECT count(DISTINCT component) FROM cc) AS components
""")
def network_stats(spark, folder):
    return G.network_stats(*line_graph(spark, folder)).withColumn("density", F.round("density", 9))


@QUERIES.add("J12_connected_components", f"{COMPONENTS} SELECT id, component FROM cc")
def connected_components(spark, folder):
    return G.connected_components(*line_graph(spark, folder))


@QUERIES.add("J13_largest_component", f"{COMPONENTS} SELECT src, dst FROM ed JOIN cc ON id = src SEMI JOIN giant USING (component)")
def largest_component(spark, folder):
    return G.largest_component(*line_graph(spark, folder))[1]


CLUBS = "club AS (SELECT id, CASE WHEN CAST(substr(id, 2) AS BIGINT) % 2 = 0 THEN 'even' ELSE 'odd' END AS club FROM v)"


def clubs(vertices: DataFrame) -> DataFrame:
    number = F.expr("CAST(substr(id, 2) AS BIGINT)")
    return vertices.withColumn("club", F.when(number % 2 == 0, "even").otherwise("odd"))


@QUERIES.add("J14_groups", f"{PAIRS}, {CLUBS} SELECT club, count(*) AS n FROM club GROUP BY club")
def groups(spark, folder):
    return G.group_sizes(clubs(reply_graph(spark, folder)[0]), "club")


@QUERIES.add("J14_edges_inside", f"""{PAIRS}, {CLUBS}
    SELECT a.club, src, dst FROM e JOIN club a ON a.id = src JOIN club b ON b.id = dst WHERE a.club = b.club
""")
def edges_inside(spark, folder):
    vertices, edges = reply_graph(spark, folder)
    return G.edges_inside_groups(clubs(vertices), edges, "club")


RESOLUTION = 0.8


def merge_sql(rounds: int) -> str:
    """CTEs: e0, k0 and, after each round, m<r>(id, community); rounds after the last merge change nothing."""
    parts = [f"""{LINES}, e0 AS MATERIALIZED (SELECT src AS a, dst AS b, 1.0::DOUBLE AS w FROM ed),
        k0 AS MATERIALIZED (SELECT id, sum(w) AS k FROM (SELECT a AS id, w FROM e0 UNION ALL SELECT b, w FROM e0) GROUP BY id),
        total AS (SELECT sum(w) AS t FROM e0), m0 AS (SELECT id, id AS community FROM vx)"""]
    for r in range(rounds):
        parts.append(f"""o{r} AS MATERIALIZED (SELECT round(w - {RESOLUTION} * x.k * y.k / (2 * t), 9) AS gain, md5(a || '|' || b) AS tie, a, b, w, x.k AS ka, y.k AS kb
            FROM e{r} JOIN k{r} x ON x.id = a JOIN k{r} y ON y.id = b, total WHERE a <> b AND gain > 0),
        x{r} AS MATERIALIZED (SELECT * FROM (SELECT a AS id, b AS dst, ka AS k, * FROM o{r} UNION ALL SELECT b AS id, a AS dst, kb AS k, * FROM o{r})
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY gain DESC, tie DESC, a DESC, b DESC) = 1),
        c{r} AS (SELECT CASE WHEN ka >= kb THEN a ELSE b END AS dst, greatest(ka, kb) AS kc FROM x{r} GROUP BY a, b, ka, kb HAVING count(*) = 2),
        g{r} AS MATERIALIZED (SELECT id, dst FROM (SELECT id, dst, w, k, kc, sum(k) OVER (PARTITION BY dst ORDER BY gain DESC, tie DESC, id ROWS UNBOUNDED PRECEDING) - k AS before
            FROM x{r} JOIN c{r} USING (dst)), total WHERE round(w - {RESOLUTION} * k * (kc + before) / (2 * t), 9) > 0),
        e{r + 1} AS MATERIALIZED (SELECT least(coalesce(x.dst, a), coalesce(y.dst, b)) AS a, greatest(coalesce(x.dst, a), coalesce(y.dst, b)) AS b, sum(w) AS w
            FROM e{r} LEFT JOIN g{r} x ON x.id = a LEFT JOIN g{r} y ON y.id = b GROUP BY 1, 2),
        k{r + 1} AS MATERIALIZED (SELECT coalesce(dst, k.id) AS id, sum(k) AS k FROM k{r} k LEFT JOIN g{r} g ON g.id = k.id GROUP BY 1),
        m{r + 1} AS MATERIALIZED (SELECT m.id, coalesce(dst, community) AS community FROM m{r} m LEFT JOIN g{r} g ON g.id = community)""")
    return "WITH " + ", ".join(parts)


ROUNDS = 12
COMMUNITIES = f"""{merge_sql(ROUNDS)}, sizes AS (SELECT community, row_number() OVER (ORDER BY count(*) DESC, min(id)) - 1 AS number FROM m{ROUNDS} GROUP BY community),
    co AS (SELECT id, number AS community FROM m{ROUNDS} JOIN sizes USING (community))"""


@QUERIES.add("J15_merge_round", f"{merge_sql(1)} SELECT id, dst AS \"to\" FROM g0")
def merge_round(spark, folder):
    edges, strengths, total = M.start_tables(line_graph(spark, folder)[1])
    return M.merge_round(edges, strengths, total, RESOLUTION)


@QUERIES.add("J15_communities", f"{COMMUNITIES} SELECT id, community FROM co")
def communities(spark, folder):
    vertices, edges = line_graph(spark, folder)
    return M.communities(vertices, edges, RESOLUTION)


# One moving round from sixteen communities, dealt by the hash of the vertex.
@QUERIES.add("J15_moving_round", f"""{merge_sql(0)}, mb AS (SELECT id, substr(md5(id), 1, 1) AS c FROM vx),
    ways AS (SELECT a AS id, b AS other, w FROM e0 WHERE a <> b UNION ALL SELECT b, a, w FROM e0 WHERE a <> b),
    links AS MATERIALIZED (SELECT ways.id, c AS dst, sum(w) AS w FROM ways JOIN mb ON mb.id = other GROUP BY ALL),
    own AS (SELECT mb.id, c AS src, k FROM mb JOIN k0 ON k0.id = mb.id),
    sums AS MATERIALIZED (SELECT src, sum(k) AS s FROM own GROUP BY src),
    offers AS (SELECT l.id, own.src, l.dst, l.w, coalesce(o.w, 0) AS wo, k, x.s AS ss, y.s AS sd
               FROM links l JOIN own ON own.id = l.id AND own.src <> l.dst LEFT JOIN links o ON o.id = l.id AND o.dst = own.src
               JOIN sums x ON x.src = own.src JOIN sums y ON y.src = l.dst),
    gains AS (SELECT *, round(w - wo - {RESOLUTION} * k * (sd - (ss - k)) / (2 * t), 9) AS gain FROM offers, total),
    best AS (SELECT * FROM gains WHERE gain > 0 AND substr(md5('3|' || dst), 1, 1) >= '8' AND substr(md5('3|' || src), 1, 1) < '8'
             QUALIFY row_number() OVER (PARTITION BY id ORDER BY gain DESC, dst) = 1),
    lined AS (SELECT *, sum(k) OVER (PARTITION BY dst ORDER BY gain DESC, id ROWS UNBOUNDED PRECEDING) - k AS joined,
                     sum(k) OVER (PARTITION BY src ORDER BY gain DESC, id ROWS UNBOUNDED PRECEDING) - k AS gone FROM best)
    SELECT id, dst AS "to" FROM lined WHERE round(w - wo - {RESOLUTION} * k * (sd + joined - (ss - k - gone)) / (2 * t), 9) > 0
""")
def moving_round(spark, folder):
    vertices, edges = line_graph(spark, folder)
    summed, strengths, total = M.start_tables(edges)
    member = materialise(vertices.select("id", F.substring(F.md5(F.col("id").cast("binary")), 1, 1).alias("community")), "members")
    places = materialise(M.better_places(summed, strengths, member, total, RESOLUTION), "better-places")
    return M.moving_round(places, total, RESOLUTION, salt=3)


@QUERIES.add("J15_moved_communities")
def moved_communities(spark, folder):
    vertices, edges = line_graph(spark, folder)
    return M.moved_communities(vertices, edges, RESOLUTION)


@QUERIES.add("J16_modularity", f"""{PAIRS}, {CLUBS}, {DEGREES},
    ins AS (SELECT count(*) AS n FROM e JOIN club a ON a.id = src JOIN club b ON b.id = dst WHERE a.club = b.club),
    tot AS (SELECT club, sum(degree) AS s FROM deg JOIN club USING (id) GROUP BY club)
    SELECT round((SELECT n FROM ins) / (SELECT count(*) FROM e) - 0.8 * sum(s * s) / pow(2 * (SELECT count(*) FROM e), 2), 6) AS modularity FROM tot
""")
def modularity(spark, folder):
    vertices, edges = reply_graph(spark, folder)
    member = clubs(vertices).withColumnRenamed("club", "community")
    return rounded(M.modularity(edges, member, 0.8), "modularity")


TRUTH = f"""{COMMUNITIES}, x AS (SELECT community, lang FROM documents JOIN co ON id = 'd' || doc_id),
    k AS (SELECT community, lang, count(*) AS n FROM x GROUP BY ALL),
    best AS (SELECT community, lang AS predicted FROM k QUALIFY row_number() OVER (PARTITION BY community ORDER BY n DESC, lang) = 1),
    pred AS (SELECT lang AS truth, predicted FROM x JOIN best USING (community))"""


@QUERIES.add("J17_communities_against_truth", f"{TRUTH} SELECT truth, predicted, count(*) AS n FROM pred GROUP BY ALL")
def communities_against_truth(spark, folder):
    truth = read_table(spark, folder, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "lang")
    marked = communities(spark, folder).join(truth, "id")
    return confusion_matrix(label_clusters(materialise(marked, "marked"), "community", "lang"), "lang", "predicted")


# ---------------------------------------------------------------- similar users

NEIGHBOURS = f"""{PAIRS}, nb AS (SELECT src AS o, dst AS i FROM e UNION SELECT dst, src FROM e), s AS (SELECT o, count(*) AS d FROM nb GROUP BY o),
    x AS (SELECT a.o AS user1, b.o AS user2, count(*) AS c FROM nb a JOIN nb b ON a.i = b.i AND a.o < b.o GROUP BY ALL),
    m AS (SELECT user1, user2, c, a.d AS d1, b.d AS d2 FROM x JOIN s a ON a.o = user1 JOIN s b ON b.o = user2)"""
# Every pair of users, with a common neighbour or not.
ALL_PAIRS = """, every AS (SELECT a.o AS user1, b.o AS user2, coalesce(c, 0) AS c, a.d AS d1, b.d AS d2
    FROM s a JOIN s b ON a.o < b.o LEFT JOIN x ON x.user1 = a.o AND x.user2 = b.o)"""
# Customers and their nations: one star per nation.
STARS = """WITH nb AS (SELECT 'c' || c_custkey AS o, 'n' || c_nationkey AS i FROM customer UNION SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
    s AS (SELECT o, count(*) AS d FROM nb GROUP BY o),
    x AS (SELECT a.o AS user1, b.o AS user2, count(*) AS c FROM nb a JOIN nb b ON a.i = b.i AND a.o < b.o GROUP BY ALL)"""


def user_edges(spark, folder) -> DataFrame:
    return G.user_interactions(comments(spark, folder))


@QUERIES.add("J18_similar_users", f"""{NEIGHBOURS}, r AS (SELECT user1, user2, round(c / sqrt(d1 * d2), 12) AS v FROM m)
    SELECT user1, user2, round(v, 6) AS similarity FROM r ORDER BY v DESC, user1, user2 LIMIT 50
""")
def similar_users(spark, folder):
    return rounded(find_similar_users(user_edges(spark, folder), top_n=50), "similarity")


@QUERIES.add("J18_all_user_pairs", f"{NEIGHBOURS} SELECT user1, user2, round(c / sqrt(d1 * d2), 6) AS similarity FROM m")
def all_user_pairs(spark, folder):
    return rounded(find_similar_users(user_edges(spark, folder), giant_component=False), "similarity")


@QUERIES.add("J19_jaccard_users", f"""{NEIGHBOURS}, r AS (SELECT user1, user2, round(c / (d1 + d2 - c), 12) AS v FROM m)
    SELECT user1, user2, round(v, 6) AS similarity FROM r ORDER BY v DESC, user1, user2 LIMIT 50
""")
def jaccard_users(spark, folder):
    return rounded(find_similar_users(user_edges(spark, folder), top_n=50, metric="jaccard"), "similarity")


@QUERIES.add("J18_zero_pairs", f"{NEIGHBOURS}{ALL_PAIRS} SELECT user1, user2, round(c / sqrt(d1 * d2), 6) AS similarity FROM every")
def zero_pairs(spark, folder):
    return rounded(find_similar_users(user_edges(spark, folder), giant_component=False, include_zero=True), "similarity")


@QUERIES.add("J18_least_similar_users", f"""{NEIGHBOURS}{ALL_PAIRS}, r AS (SELECT user1, user2, round(c / sqrt(d1 * d2), 12) AS v FROM every)
    SELECT user1, user2, round(v, 6) AS similarity FROM r ORDER BY v, user1, user2 LIMIT 50
""")
def least_similar_users(spark, folder):
    found = find_similar_users(user_edges(spark, folder), giant_component=False, top_n=50, ascending=True, include_zero=True)
    return rounded(found, "similarity")


@QUERIES.add("J19_least_similar_users", f"""{NEIGHBOURS}{ALL_PAIRS}, r AS (SELECT user1, user2, round(c / (d1 + d2 - c), 12) AS v FROM every)
    SELECT user1, user2, round(v, 6) AS similarity FROM r ORDER BY v, user1, user2 LIMIT 50
""")
def least_similar_users_by_jaccard(spark, folder):
    found = find_similar_users(
        user_edges(spark, folder), giant_component=False, top_n=50, metric="jaccard", ascending=True, include_zero=True
    )
    return rounded(found, "similarity")


@QUERIES.add("J20_euclidean_users", f"""{NEIGHBOURS}{ALL_PAIRS}, r AS (SELECT user1, user2, round(sqrt(d1 + d2 - 2 * c), 12) AS v FROM every)
    SELECT user1, user2, round(v, 6) AS similarity FROM r ORDER BY v, user1, user2 LIMIT 50
""")
def euclidean_users(spark, folder):
    return rounded(find_similar_users(user_edges(spark, folder), top_n=50, metric="euclidean"), "similarity")


@QUERIES.add("J20_farthest_users", f"""{NEIGHBOURS}{ALL_PAIRS}, r AS (SELECT user1, user2, round(sqrt(d1 + d2 - 2 * c), 12) AS v FROM every)
    SELECT user1, user2, round(v, 6) AS similarity FROM r ORDER BY v DESC, user1, user2 LIMIT 50
""")
def farthest_users(spark, folder):
    return rounded(find_similar_users(user_edges(spark, folder), top_n=50, metric="euclidean", ascending=False), "similarity")


@QUERIES.add("J20_farthest_stars", f"""{STARS}{ALL_PAIRS}, r AS (SELECT user1, user2, round(sqrt(d1 + d2 - 2 * c), 12) AS v FROM every)
    SELECT user1, user2, round(v, 6) AS similarity FROM r ORDER BY v DESC, user1, user2 LIMIT 500
""")
def farthest_stars(spark, folder):
    stars = read_table(spark, folder, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("src"), F.concat(F.lit("n"), "c_nationkey").alias("dst")
    )
    found = find_similar_users(stars, giant_component=False, top_n=500, metric="euclidean", ascending=False)
    return rounded(found, "similarity")


@QUERIES.add("J21_thread_shape", f"""{THREADS},
    up AS (SELECT comment_id, post_id, CASE WHEN parent_id IN (SELECT comment_id FROM cm) THEN parent_id END AS parent FROM cm),
    lv(comment_id, post_id, level) AS (SELECT comment_id, post_id, 1 FROM up WHERE parent IS NULL
        UNION ALL SELECT up.comment_id, up.post_id, level + 1 FROM lv JOIN up ON up.parent = lv.comment_id),
    w AS (SELECT post_id, level, count(*) AS n FROM lv GROUP BY ALL)
    SELECT post_id, CAST(max(level) AS BIGINT) AS depth, max(n) AS width, CAST(sum(n) AS BIGINT) AS n_comments FROM w GROUP BY post_id
""")
def thread_shape(spark, folder):
    return G.thread_shape(G.comment_levels(comments(spark, folder)))


# ---------------------------------------------------------------- two-mode networks

@QUERIES.add("K1_melt", """
    SELECT o_orderkey, 'o_orderstatus' AS choice, o_orderstatus AS value FROM orders
    UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders
""")
def melt(spark, folder):
    return K.melt(read_table(spark, folder, "orders"), ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@QUERIES.add("K2_incidence", "SELECT DISTINCT l_suppkey AS row_item, l_partkey AS col_item FROM lineitem")
def incidence(spark, folder):
    return K.incidence(read_table(spark, folder, "lineitem"), "l_suppkey", "l_partkey")


@QUERIES.add("K2_incidence_matrix", """
    SELECT user_id AS row_item, max(CAST(event_type = 'click' AS BIGINT)) AS click, max(CAST(event_type = 'error' AS BIGINT)) AS error,
           max(CAST(event_type = 'view' AS BIGINT)) AS view FROM events GROUP BY user_id
""")
def incidence_matrix(spark, folder):
    cells = K.incidence(read_table(spark, folder, "events"), "user_id", "event_type")
    return K.incidence_matrix(cells, ["click", "error", "view"])


CELLS = "WITH b AS (SELECT DISTINCT l_suppkey AS r, l_partkey AS c FROM lineitem)"


def cells(spark, folder) -> DataFrame:
    return K.incidence(read_table(spark, folder, "lineitem"), "l_suppkey", "l_partkey")


@QUERIES.add("K3_row_projection", f"""{CELLS}
    SELECT x.r AS "left", y.r AS "right", count(*) AS weight FROM b x JOIN b y ON x.c = y.c AND x.r <= y.r GROUP BY ALL
""")
def row_projection(spark, folder):
    return K.project(cells(spark, folder), diagonal=True)


@QUERIES.add("K4_column_projection", """
    WITH b AS (SELECT DISTINCT user_id AS r, event_type AS c FROM events)
    SELECT x.c AS "left", y.c AS "right", count(*) AS weight FROM b x JOIN b y ON x.r = y.r AND x.c <= y.c GROUP BY ALL
""")
def column_projection(spark, folder):
    choices = K.incidence(read_table(spark, folder, "events"), "user_id", "event_type")
    return K.project(choices, onto="col_item", diagonal=True)


PROJECTED = f"{CELLS}, pr AS (SELECT x.r AS l, y.r AS r, count(*) AS weight FROM b x JOIN b y ON x.c = y.c AND x.r < y.r GROUP BY ALL)"


@QUERIES.add("K5_relabelled_projection", f"""{PROJECTED}
    SELECT a.s_name AS left_name, z.s_name AS right_name, weight FROM pr JOIN supplier a ON a.s_suppkey = l JOIN supplier z ON z.s_suppkey = r
""")
def relabelled_projection(spark, folder):
    return K.relabel(K.project(cells(spark, folder)), read_table(spark, folder, "supplier"), "s_suppkey", "s_name")


@QUERIES.add("K6_scaled_weights", f"""{PROJECTED}
    SELECT l AS "left", r AS "right", weight, round(weight / (SELECT max(weight) FROM pr) * 3, 6) AS width FROM pr
""")
def scaled_weights(spark, folder):
    return rounded(K.scaled_weights(K.project(cells(spark, folder))), "width")


@QUERIES.add("K7_weighted_projection", """
    WITH b AS (SELECT l_suppkey AS r, l_partkey AS c, sum(l_quantity) AS w FROM lineitem GROUP BY ALL)
    SELECT x.r AS "left", y.r AS "right", round(sum(x.w * y.w), 2) AS weight FROM b x JOIN b y ON x.c = y.c AND x.r < y.r GROUP BY ALL
""")
def weighted_projection(spark, folder):
    amounts = K.summed_cells(read_table(spark, folder, "lineitem"), "l_suppkey", "l_partkey", "l_quantity")
    return K.project(amounts, weight=F.col("w")).withColumn("weight", F.round("weight", 2))


@QUERIES.add("K3_bought_together", """
    WITH b AS (SELECT DISTINCT l_orderkey AS r, l_partkey AS c FROM lineitem)
    SELECT x.c AS "left", y.c AS "right", count(*) AS weight FROM b x JOIN b y ON x.r = y.r AND x.c < y.c
    GROUP BY ALL HAVING count(*) >= 2
""")
def bought_together(spark, folder):
    bought = K.incidence(read_table(spark, folder, "lineitem"), "l_orderkey", "l_partkey")
    return K.project(bought, onto="col_item", min_weight=2)


@QUERIES.add("K3_close_suppliers", f"{PROJECTED} SELECT l AS \"left\", r AS \"right\", weight FROM pr WHERE weight >= 150")
def close_suppliers(spark, folder):
    return K.project(cells(spark, folder), min_weight=150)


@QUERIES.add("K7_heaviest_pairs", """
    WITH b AS (SELECT l_suppkey AS r, l_partkey AS c, sum(l_quantity) AS w FROM lineitem GROUP BY ALL)
    SELECT x.r AS "left", y.r AS "right", round(sum(x.w * y.w), 2) AS weight FROM b x JOIN b y ON x.c = y.c AND x.r < y.r
    GROUP BY ALL ORDER BY weight DESC, "left", "right" LIMIT 50
""")
def heaviest_pairs(spark, folder):
    amounts = K.summed_cells(read_table(spark, folder, "lineitem"), "l_suppkey", "l_partkey", "l_quantity")
    return K.project(amounts, weight=F.col("w"), top_n=50).withColumn("weight", F.round("weight", 2))


@QUERIES.add("J17_report", f"{TRUTH}, {Q.REPORT_SQL.format(source='pred')}")
def community_report(spark, folder):
    return rounded(classification_report(communities_against_truth(spark, folder)), "precision", "recall", "f1")
