"""Similarity, embeddings, classification and clustering on the given tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.functions import text as T
from weftwork.operators import classify as N
from weftwork.operators import cluster as C
from weftwork.operators import embeddings as E
from weftwork.operators import maps as M
from weftwork.operators import skipgram as S
from weftwork.operators import tfidf as W
from weftwork.operators import vectors as X
from weftwork.operators.cells import build_cells
from weftwork.plans import snippets as Q
from weftwork.plans.registry import Registry
from weftwork.plans.terms import MEANS, POOLED, content_words, matrix, matrix_sql, rounded
from weftwork.plans.text import STOP, documents
from weftwork.session import materialise, new_folder
from weftwork.sources.tables import read_table, spread

QUERIES = Registry()


# ---------------------------------------------------------------- terms and documents as vectors

TERM_PAIRS = f"""{MEANS},
    top AS (SELECT lang, term FROM m QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) <= 15),
    t AS (SELECT w.* FROM w SEMI JOIN top USING (lang, term)),
    nn AS (SELECT lang, term, sqrt(sum(weight * weight)) AS n FROM t GROUP BY ALL),
    d AS (SELECT a.lang, a.term AS l, b.term AS r, sum(a.weight * b.weight) AS p FROM t a JOIN t b
          ON a.doc_id = b.doc_id AND a.lang = b.lang AND a.term < b.term GROUP BY ALL),
    g AS (SELECT a.lang, a.term AS "left", b.term AS "right", coalesce(p, 0) / (a.n * b.n) AS cosine FROM nn a
          JOIN nn b ON a.lang = b.lang AND a.term < b.term LEFT JOIN d ON d.lang = a.lang AND l = a.term AND r = b.term)"""


def term_pairs(spark, folder) -> DataFrame:
    weighted = matrix(spark, folder)
    # Read twice: for the mean scores and for the products.
    weighted.weights = materialise(weighted.weights, "weights")
    return X.term_similarities(weighted.weights, W.mean_scores(weighted, ["lang"]), ["lang"], "doc_id", 15)


@QUERIES.add("H1_term_similarities", f'{TERM_PAIRS} SELECT lang, "left", "right", round(cosine, 6) AS cosine, round(1 - cosine, 6) AS distance FROM g')
def term_similarities(spark, folder):
    return rounded(term_pairs(spark, folder), "cosine", "distance")


@QUERIES.add("H2_similarity_edges", f'{TERM_PAIRS} SELECT lang, "left", "right", round(cosine, 6) AS cosine FROM g WHERE cosine > 0.3')
def similarity_edges(spark, folder):
    return rounded(X.similarity_edges(term_pairs(spark, folder)), "cosine").drop("distance")


DOC_BOUND = 0.8
DOC_CLASSES = f"""WITH {matrix_sql('corpus', 1000000000, 1, '', POOLED)},
    key AS (SELECT doc_id, string_agg(term || '=' || CAST(round(weight, 7) AS VARCHAR), ' ' ORDER BY term) AS k FROM w GROUP BY doc_id),
    cl AS (SELECT k, min(doc_id) AS head, count(*) AS size FROM key GROUP BY k),
    h AS (SELECT doc_id, term, weight FROM w JOIN cl ON doc_id = head),
    p AS (SELECT a.doc_id AS l, b.doc_id AS r, sum(a.weight * b.weight) AS s FROM h a JOIN h b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY ALL)"""


def pooled_matrix(spark, folder, max_terms=None, min_doc_freq=1) -> W.Weighted:
    pooled = documents(spark, folder).withColumn("corpus", F.lit("all"))
    return W.tfidf_matrix(pooled, ["corpus"], "doc_id", T.vectoriser_tokens("text"), max_terms, min_doc_freq)


@QUERIES.add("H3_document_similarities", f"""{DOC_CLASSES}
    SELECT l AS "left", r AS "right", round(s, 6) AS similarity, a.size AS left_size, b.size AS right_size
    FROM p JOIN cl a ON a.head = l JOIN cl b ON b.head = r WHERE s >= {DOC_BOUND}
    UNION ALL SELECT head, head, 1.0, size, size FROM cl WHERE size > 1
""")
def document_similarities(spark, folder):
    pairs, _ = X.document_similarities(pooled_matrix(spark, folder).weights, "doc_id", DOC_BOUND)
    return rounded(pairs, "similarity")


@QUERIES.add("H4_document_coordinates")
def document_coordinates(spark, folder):
    weighted = pooled_matrix(spark, folder, max_terms=100, min_doc_freq=2)
    terms = sorted(r["term"] for r in weighted.vocabulary.select("term").collect())
    rows = X.dense_rows(documents(spark, folder), weighted.weights, "doc_id", terms)
    return rounded(X.plane_coordinates(rows, "doc_id", "vector"), "x", "y")


@QUERIES.add("H4_term_coordinates")
def term_coordinates(spark, folder):
    return rounded(X.term_coordinates(term_pairs(spark, folder), ["lang"]), "x", "y")


MAP_TERMS, MAP_LANDMARKS, MAP_NEIGHBOURS, MAP_PERPLEXITY = 300, 12, 30, 10
MAP_SQL = f"""WITH RECURSIVE {matrix_sql('corpus', MAP_TERMS, 2, '', POOLED)},
    m AS (SELECT term, row_number() OVER (ORDER BY sum(weight) DESC, term) - 1 AS place FROM w GROUP BY term),
    nn AS (SELECT term, sqrt(sum(weight * weight)) AS n FROM w GROUP BY term),
    dots AS (SELECT a.term AS l, b.term AS r, sum(a.weight * b.weight) AS p FROM w a JOIN w b ON a.doc_id = b.doc_id GROUP BY ALL),
    cosines AS (SELECT l, r, least(1.0, p / (a.n * b.n)) AS c FROM dots JOIN nn a ON a.term = l JOIN nn b ON b.term = r)"""


def map_matrix(spark, folder) -> tuple[DataFrame, list[str]]:
    """Weights of the pooled terms, and all of them by falling mean."""
    weighted = pooled_matrix(spark, folder, max_terms=MAP_TERMS, min_doc_freq=2)
    weighted.weights = materialise(weighted.weights, "weights")
    best = W.mean_scores(weighted, ["corpus"]).orderBy(F.col("score").desc(), "term").select("term")
    return weighted.weights, [r["term"] for r in best.collect()]


# Landmarks stand on a circle; every term starts between them and takes one majorisation step.
@QUERIES.add("H4_mds_step", f"""{MAP_SQL},
    marks AS (SELECT term AS mark, cos(2 * pi() * place / {MAP_LANDMARKS}) AS mx, sin(2 * pi() * place / {MAP_LANDMARKS}) AS my
              FROM m WHERE place < {MAP_LANDMARKS}),
    wanted AS (SELECT term, mark, mx, my, 1 - coalesce(c, 0) AS delta FROM m CROSS JOIN marks LEFT JOIN cosines ON l = term AND r = mark),
    start AS (SELECT term, sum(mx / (delta + 0.05)) / sum(1 / (delta + 0.05)) AS x, sum(my / (delta + 0.05)) / sum(1 / (delta + 0.05)) AS y
              FROM wanted GROUP BY term),
    gaps AS (SELECT *, sqrt((x - mx) * (x - mx) + (y - my) * (y - my)) AS d FROM wanted JOIN start USING (term)),
    step AS (SELECT term, avg(mx + CASE WHEN d > 1e-12 THEN delta / d * (x - mx) ELSE 0 END) AS x,
                    avg(my + CASE WHEN d > 1e-12 THEN delta / d * (y - my) ELSE 0 END) AS y FROM gaps GROUP BY term),
    after AS (SELECT term, any_value(s.x) AS x, any_value(s.y) AS y, sum(pow(sqrt((s.x - mx) * (s.x - mx) + (s.y - my) * (s.y - my)) - delta, 2)) AS stress
              FROM wanted JOIN step s USING (term) GROUP BY term)
    SELECT term, round(x, 6) AS x, round(y, 6) AS y, round(stress, 6) AS stress FROM after
""")
def mds_step(spark, folder):
    weights, terms = map_matrix(spark, folder)
    marks = terms[:MAP_LANDMARKS]
    turn = 2 * math.pi / MAP_LANDMARKS
    spots = {name: (math.cos(turn * i), math.sin(turn * i)) for i, name in enumerate(marks)}
    distances = materialise(M.landmark_distances(weights, marks, "term", "doc_id", "weight"), "landmark-distances")
    return rounded(M.place_points(distances, spots, "term", rounds=1), "x", "y", "stress")


@QUERIES.add("H4_mds_map")
def mds_map(spark, folder):
    weights, terms = map_matrix(spark, folder)
    return rounded(M.stress_map(weights, terms[:MAP_LANDMARKS * 5], "term", "doc_id", "weight"), "x", "y", "stress")


def map_neighbours(spark, folder) -> DataFrame:
    weights, terms = map_matrix(spark, folder)
    scores = weights.groupBy("term").agg(F.sum("weight").alias("score"))
    pairs = X.term_similarities(weights, scores, [], "doc_id", len(terms))
    return M.nearest_table(pairs.withColumn("distance", F.round("distance", 9)), MAP_NEIGHBOURS)


# The width of every term's neighbourhood by bisection, step by step.
@QUERIES.add("H4_tsne_calibration", f"""{MAP_SQL},
    far AS (SELECT a.term AS item, b.term AS other, round(1 - coalesce(c, 0), 9) AS d FROM m a JOIN m b ON a.term <> b.term
            LEFT JOIN cosines ON l = a.term AND r = b.term),
    near AS (SELECT * FROM far QUALIFY row_number() OVER (PARTITION BY item ORDER BY d, other) <= {MAP_NEIGHBOURS}),
    sq AS MATERIALIZED (SELECT item, d * d - min(d * d) OVER (PARTITION BY item) AS s FROM near),
    bis AS (
        SELECT DISTINCT item, 0.0::DOUBLE AS low, pow(2, 40)::DOUBLE AS high, 0 AS step FROM sq
        UNION ALL
        SELECT item, CASE WHEN entropy > ln({MAP_PERPLEXITY}) THEN (low + high) / 2 ELSE low END,
               CASE WHEN entropy > ln({MAP_PERPLEXITY}) THEN high ELSE (low + high) / 2 END, step + 1
        FROM (SELECT item, low, high, step, ln(sum(exp(-(low + high) / 2 * s)))
                     + (low + high) / 2 * sum(exp(-(low + high) / 2 * s) * s) / sum(exp(-(low + high) / 2 * s)) AS entropy
              FROM bis JOIN sq USING (item) WHERE step < {M.BISECTIONS} GROUP BY item, low, high, step)
    ),
    widths AS (SELECT item, (low + high) / 2 AS beta FROM bis WHERE step = {M.BISECTIONS}),
    shares AS (SELECT item, beta, exp(-beta * s) / sum(exp(-beta * s)) OVER (PARTITION BY item) AS p FROM sq JOIN widths USING (item))
    SELECT item, count(*) AS neighbours, round(any_value(beta), 3) AS beta,
           round(exp(-sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END)), 4) AS perplexity FROM shares GROUP BY item
""")
def tsne_calibration(spark, folder):
    shares = M.calibrated(map_neighbours(spark, folder), MAP_PERPLEXITY)
    entropy = -F.sum(F.when(F.col("p") > 0, F.col("p") * F.log("p")).otherwise(0.0))
    return shares.groupBy("item").agg(
        F.count("*").alias("neighbours"), F.round(F.first("beta"), 3).alias("beta"), F.round(F.exp(entropy), 4).alias("perplexity")
    )


@QUERIES.add("H4_tsne_map")
def tsne_map(spark, folder):
    edges = M.affinities(M.calibrated(map_neighbours(spark, folder), MAP_PERPLEXITY))
    start = M.scattered(edges.select("item").distinct())
    found = M.neighbour_map(edges, start, M.Schedule(rounds=24, early=8))
    return rounded(found, "x", "y").withColumnRenamed("item", "term")


@QUERIES.add("H5_highlight_top", f"""{MEANS},
    r AS (SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) AS rn, dense_rank() OVER (ORDER BY lang) - 1 AS colour FROM m)
    SELECT lang, term, rn <= 5 AS highlighted, colour FROM r
""")
def highlight_top(spark, folder):
    weighted = matrix(spark, folder)
    scores = materialise(W.mean_scores(weighted, ["lang"]), "scores")
    return X.colour_groups(X.highlight_top(scores, ["lang"], 5), "lang").drop("score")


# ---------------------------------------------------------------- classification

SPLIT = """ordered AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS pos FROM lab),
    split AS (SELECT doc_id, pos < ceil((SELECT count(*) FROM lab) * 0.3) AS is_test FROM ordered)"""
LABELLED = f"""lab AS (SELECT doc_id, CASE quality WHEN 1 THEN 'good' ELSE 'poor' END AS label FROM labels JOIN documents USING (doc_id)), {SPLIT},
    docs AS (SELECT 'all' AS corpus, doc_id, text FROM documents SEMI JOIN lab USING (doc_id))"""
BAYES = f"""WITH {LABELLED}, {matrix_sql('corpus', 1000000000, 1, '', 'docs')},
    train AS (SELECT doc_id, label FROM lab JOIN split USING (doc_id) WHERE NOT is_test),
    size AS (SELECT count(DISTINCT term) AS v FROM w),
    ct AS (SELECT label, term, sum(weight) AS s FROM w JOIN train USING (doc_id) GROUP BY ALL),
    cls AS (SELECT label, ln(count(*) / (SELECT count(*) FROM train)) AS log_prior FROM train GROUP BY label),
    base AS (SELECT label, log_prior, (SELECT sum(s) FROM ct WHERE ct.label = cls.label) + (SELECT v FROM size) AS b FROM cls),
    model AS (SELECT label, term, ln((s + 1) / b) AS log_prob FROM ct JOIN base USING (label)),
    pairs AS (SELECT doc_id, base.label, w.weight, coalesce(model.log_prob, ln(1 / b)) AS lp FROM w JOIN split USING (doc_id) CROSS JOIN base
              LEFT JOIN model ON model.label = base.label AND model.term = w.term WHERE is_test),
    score AS (SELECT doc_id, base.label, any_value(log_prior) + coalesce(sum(weight * lp), 0) AS s FROM split CROSS JOIN base
              LEFT JOIN pairs USING (doc_id, label) WHERE is_test GROUP BY ALL),
    pred AS (SELECT doc_id, q.label AS predicted, lab.label AS truth FROM (SELECT doc_id, label FROM score
             QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(s, 9) DESC, label) = 1) q JOIN (SELECT doc_id AS i, label FROM lab) lab ON lab.i = doc_id)"""


def labelled(spark, folder) -> DataFrame:
    label = F.when(F.col("quality") == 1, "good").otherwise("poor")
    return documents(spark, folder).join(
        read_table(spark, folder, "labels").select("doc_id", label.alias("label")), "doc_id"
    ).select(F.lit("all").alias("corpus"), "doc_id", "text", "label")


def bayes(spark, folder):
    """(model, weights, docs with label and is_test). The vocabulary is that of all documents."""
    docs = materialise(N.train_test_split(labelled(spark, folder), "doc_id"), "labelled")
    weights = materialise(
        W.tfidf_matrix(docs, ["corpus"], "doc_id", T.vectoriser_tokens("text"), None, 1).weights, "weights"
    )
    return N.fit_naive_bayes(weights, docs.filter(~F.col("is_test")), "doc_id"), weights, docs


def predictions(spark, folder) -> DataFrame:
    model, weights, docs = bayes(spark, folder)
    test = docs.filter("is_test")
    seen = weights.join(test.select("doc_id"), "doc_id", "left_semi")
    return N.predict(N.class_scores(model, test, seen, "doc_id"), "doc_id").join(
        test.select("doc_id", F.col("label").alias("truth")), "doc_id"
    )


@QUERIES.add("I1_train_test_split", f"WITH {LABELLED} SELECT doc_id, label, is_test FROM lab JOIN split USING (doc_id)")
def train_test_split(spark, folder):
    return N.train_test_split(labelled(spark, folder).drop("text", "corpus"), "doc_id")


@QUERIES.add("I2_naive_bayes_model", f"{BAYES} SELECT label, term, round(log_prob, 6) AS log_prob, round(log_prior, 6) AS log_prior FROM model JOIN base USING (label)")
def naive_bayes_model(spark, folder):
    model, _, _ = bayes(spark, folder)
    return rounded(model.terms.join(model.classes.drop("log_default"), "label"), "log_prob", "log_prior")


@QUERIES.add("I3_naive_bayes_scores", f"{BAYES} SELECT doc_id, label, round(s, 6) AS score FROM score")
def naive_bayes_scores(spark, folder):
    model, weights, docs = bayes(spark, folder)
    return rounded(N.class_scores(model, docs.filter("is_test"), weights, "doc_id"), "score")


@QUERIES.add("I3_naive_bayes_predictions", f"{BAYES} SELECT doc_id, predicted, truth FROM pred")
def naive_bayes_predictions(spark, folder):
    return predictions(spark, folder)


@QUERIES.add("I4_classification_report", f"{BAYES}, {Q.REPORT_SQL.format(source='pred')}")
def classification_report(spark, folder):
    confusion = N.confusion_matrix(predictions(spark, folder), "truth", "predicted")
    return rounded(N.classification_report(confusion), "precision", "recall", "f1")


@QUERIES.add("I5_confusion_matrix", f"{BAYES} SELECT truth, predicted, count(*) AS n FROM pred GROUP BY ALL")
def confusion_matrix(spark, folder):
    return N.confusion_matrix(predictions(spark, folder), "truth", "predicted")


@QUERIES.add("I6_informative_features", f"""{BAYES}
    SELECT label, term, round(log_prob, 6) AS log_prob, round(exp(log_prob), 6) AS prob,
           row_number() OVER (PARTITION BY label ORDER BY round(log_prob, 9) DESC, term) AS rank FROM model QUALIFY rank <= 10
""")
def informative_features(spark, folder):
    return rounded(N.most_informative_features(bayes(spark, folder)[0], 10), "log_prob", "prob")


# ---------------------------------------------------------------- clustering

def vectors(spark, folder) -> DataFrame:
    return spread(read_table(spark, folder, "embeddings"))


ITERATIONS = 20


def lloyd_sql(k: int, name: str) -> str:
    """CTEs of k-means from fixed starts: {name}a(vec_id, label, cluster, apart) and {name}c(cluster, centre)."""
    parts = [f"""{name}s AS MATERIALIZED (SELECT row_number() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) AS place, embedding::DOUBLE[] AS e
        FROM embeddings QUALIFY place <= {C.SAMPLE * k}), {name}f1 AS MATERIALIZED (SELECT 0 AS cluster, e AS centre FROM {name}s WHERE place = 1)"""]
    for i in range(1, k):
        parts.append(f"""{name}f{i + 1} AS MATERIALIZED (SELECT * FROM {name}f{i} UNION ALL SELECT {i}, arg_min(e, (-apart, place)) FROM (
            SELECT place, any_value(e) AS e, round(min(pow(list_distance(e, centre), 2)), 9) AS apart FROM {name}s, {name}f{i} GROUP BY place))""")
    parts.append(f"{name}c0 AS (SELECT CAST(cluster AS INTEGER) AS cluster, centre FROM {name}f{k})")
    assign = """(SELECT vec_id, label, e, cluster, greatest(round(list_inner_product(e, e) + list_inner_product(centre, centre) - 2 * list_inner_product(e, centre), 9), 0) AS apart
        FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), {c} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY apart, cluster) = 1)"""
    for r in range(ITERATIONS):
        parts.append(f"""{name}a{r} AS MATERIALIZED {assign.format(c=f'{name}c{r}')},
        {name}m{r} AS (SELECT cluster, i, avg(x) AS v FROM (SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM {name}a{r}) GROUP BY cluster, i),
        {name}c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(n.centre, c.centre) AS centre FROM {name}c{r} c
            LEFT JOIN (SELECT cluster, list(v ORDER BY i) AS centre FROM {name}m{r} GROUP BY cluster) n USING (cluster))""")
    return ", ".join(parts) + f", {name}c AS (SELECT * FROM {name}c{ITERATIONS}), {name}a AS MATERIALIZED {assign.format(c=f'{name}c')}"


@QUERIES.add("I7_kmeans", f"WITH {lloyd_sql(10, 'x')} SELECT vec_id, label, cluster FROM xa")
def kmeans(spark, folder):
    return fitted(spark, folder).assignments.select("vec_id", "label", "cluster")


def fitted(spark, folder) -> C.Clustering:
    return C.fit_kmeans(vectors(spark, folder), "embedding", 10, "vec_id", ITERATIONS)


@QUERIES.add("I8_fitted_centres", f"""WITH {lloyd_sql(10, 'x')}, s AS (SELECT cluster, unnest(centre) AS value, generate_subscripts(centre, 1) - 1 AS i FROM xc)
    SELECT cluster, CAST(i AS INTEGER) AS i, round(value, 6) AS value, (SELECT round(sum(apart), 4) FROM xa) AS inertia FROM s
""")
def fitted_centres(spark, folder):
    found = fitted(spark, folder)
    return rounded(found.centres.select("cluster", F.posexplode("centre").alias("i", "value")), "value").withColumn(
        "inertia", F.round(F.lit(found.cost), 4)
    )


CELLS_SQL = """cl AS (SELECT vec_id, label AS cluster, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
    ce AS (SELECT cluster, i, avg(CAST(x AS DOUBLE)) AS value, count(*) AS n, sum(CAST(x AS DOUBLE) * x) AS sq FROM cl GROUP BY ALL)"""


@QUERIES.add("I8_centres", f"WITH {CELLS_SQL} SELECT cluster, CAST(i AS INT) AS i, round(value, 6) AS value, n FROM ce")
def centres(spark, folder):
    rows = vectors(spark, folder).select(F.col("label").alias("cluster"), "embedding")
    return rounded(C.centres_from(rows, "embedding"), "value")


@QUERIES.add("I8_inertia", f"""WITH {CELLS_SQL}
    SELECT cl.cluster, any_value(ce.n) AS n, round(sum((CAST(x AS DOUBLE) - value) * (CAST(x AS DOUBLE) - value)), 5) AS inertia
    FROM cl JOIN ce USING (cluster, i) GROUP BY cl.cluster
""")
def inertia(spark, folder):
    rows = vectors(spark, folder).select(F.col("label").alias("cluster"), "embedding")
    return C.inertia_from(rows, "embedding").withColumn("inertia", F.round("inertia", 5))


SWEEP = (2, 5, 10)


@QUERIES.add("I9_inertia_sweep", f"""WITH {', '.join(lloyd_sql(k, f'k{k}_') for k in SWEEP)}
    {' UNION ALL '.join(f"SELECT 'embeddings' AS data, {k} AS k, round(sum(apart), 4) AS inertia FROM k{k}_a" for k in SWEEP)}
""")
def inertia_sweep(spark, folder):
    rows = materialise(vectors(spark, folder).select("vec_id", "embedding"), "vectors")
    sweep = C.inertia_sweep({"embeddings": rows}, "embedding", list(SWEEP), "vec_id")
    return sweep.withColumn("inertia", F.round("inertia", 4))


@QUERIES.add("I10_majority_labels", """
    WITH k AS (SELECT props, event_type, count(*) AS n FROM events GROUP BY ALL),
    b AS (SELECT props, event_type AS predicted FROM k QUALIFY row_number() OVER (PARTITION BY props ORDER BY n DESC, event_type) = 1)
    SELECT event_id, props, event_type, predicted FROM events JOIN b USING (props)
""")
def majority_labels(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "props", "event_type")
    return C.label_clusters(events, "props", "event_type")


@QUERIES.add("I11_nearest_to_centres", f"""WITH {CELLS_SQL},
    d AS (SELECT cl.cluster, vec_id, sqrt(sum((CAST(x AS DOUBLE) - value) * (CAST(x AS DOUBLE) - value))) AS distance FROM cl JOIN ce USING (cluster, i) GROUP BY ALL)
    SELECT cluster, vec_id, round(distance, 6) AS distance, row_number() OVER (PARTITION BY cluster ORDER BY round(distance, 9), vec_id) AS rank FROM d QUALIFY rank <= 5
""")
def nearest_to_centres(spark, folder):
    rows = vectors(spark, folder).select("vec_id", F.col("label").alias("cluster"), "embedding")
    means = C.centres_from(rows, "embedding").groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda c: c["value"]).alias("centre")
    )
    return rounded(C.nearest_to_centres(rows, materialise(means, "centres"), "vec_id", "embedding"), "distance")


# ---------------------------------------------------------------- embeddings

def model(spark, folder) -> DataFrame:
    return vectors(spark, folder).select(F.col("vec_id").alias("token"), F.col("embedding").alias("vec"))


MODEL = "e AS (SELECT vec_id AS token, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


@QUERIES.add("L1_model_size", "SELECT count(*) AS n_tokens, CAST(max(len(embedding)) AS INT) AS dimension FROM embeddings")
def model_size(spark, folder):
    return E.model_size(model(spark, folder))


@QUERIES.add("L1_lookup", f"WITH {MODEL} SELECT token, round(v[1], 6) AS first, round(v[64], 6) AS last FROM e WHERE token IN (3, 14, 159)")
def lookup(spark, folder):
    found = E.lookup(model(spark, folder), [3, 14, 159])
    return found.select(
        "token", F.round(F.element_at("vec", 1).cast("double"), 6).alias("first"),
        F.round(F.element_at("vec", 64).cast("double"), 6).alias("last"),
    )


@QUERIES.add("L2_pair_similarities", f"""WITH {MODEL}
    SELECT a.token AS token1, b.token AS token2, round(list_cosine_similarity(a.v, b.v), 6) AS similarity
    FROM e a JOIN e b ON b.token = a.token * 7 % (SELECT count(*) FROM e)
""")
def pair_similarities(spark, folder):
    rows = model(spark, folder)
    n = rows.agg(F.count("*")).scalar()
    pairs = rows.select(F.col("token").alias("token1"), (F.col("token") * 7 % n).alias("token2"))
    return rounded(E.pair_similarities(rows, pairs), "similarity")


WORDS = [1, 22, 333, 44, 55]


@QUERIES.add("L3_compare_models", f"""WITH {MODEL},
    mm AS (SELECT 'full' AS model, token, v FROM e UNION ALL SELECT 'half', token, v[1:32] FROM e)
    SELECT a.model, a.token AS word1, b.token AS word2, round(list_cosine_similarity(a.v, b.v), 6) AS similarity
    FROM mm a JOIN mm b ON a.model = b.model WHERE a.token IN ({', '.join(map(str, WORDS))}) AND b.token IN ({', '.join(map(str, WORDS))})
""")
def compare_models(spark, folder):
    full = model(spark, folder)
    half = full.select("token", F.slice("vec", 1, 32).alias("vec"))
    return rounded(E.compare_models(WORDS, {"full": full, "half": half}), "similarity")



@QUERIES.add("L4_nearest", f"""WITH {MODEL},
    q AS (SELECT token, v FROM e WHERE token IN (7, 70, 170)),
    s AS (SELECT CAST(q.token AS VARCHAR) AS query, e.token, list_cosine_similarity(e.v, q.v) AS sim FROM e JOIN q ON true)
    SELECT query, token, round(sim, 6) AS similarity, row_number() OVER (PARTITION BY query ORDER BY round(sim, 9) DESC, token) AS rank
    FROM s QUALIFY rank <= 10
""")
def nearest(spark, folder):
    rows = model(spark, folder)
    queries = {str(t): v for t, v in E.vectors_of(rows, [7, 70, 170]).items()}
    return rounded(E.nearest(rows, queries, 10), "similarity")


@QUERIES.add("L4_nearest_by_cells", QUERIES["L4_nearest"].sql)
def nearest_by_cells(spark, folder):
    rows = model(spark, folder)
    queries = {str(t): v for t, v in E.vectors_of(rows, [7, 70, 170]).items()}
    index = build_cells(rows, new_folder(spark, "cells"), 16)
    return rounded(index.search(queries, 10), "similarity")


@QUERIES.add("L4_similar_to", f"""WITH {MODEL}, q AS (SELECT v AS u FROM e WHERE token = 7),
    s AS (SELECT token, list_cosine_similarity(v, u) AS sim FROM e JOIN q ON token <> 7)
    SELECT '7' AS query, token, round(sim, 6) AS similarity, row_number() OVER (ORDER BY round(sim, 9) DESC, token) AS rank FROM s QUALIFY rank <= 10
""")
def similar_to(spark, folder):
    return rounded(E.similar_to(model(spark, folder), 7, 10), "similarity")


@QUERIES.add("L5_vector_arithmetic", f"""WITH {MODEL},
    a AS (SELECT v AS a FROM e WHERE token = 5), b AS (SELECT v AS b FROM e WHERE token = 6), t AS (SELECT v AS t FROM e WHERE token = 9),
    q AS (SELECT 'difference' AS query, list_transform(list_zip(a, b), lambda p: p[1] - p[2]) AS u FROM a, b
          UNION ALL SELECT 'analogy', list_transform(list_zip(a, b, t), lambda p: p[1] - p[2] + p[3]) FROM a, b, t),
    s AS (SELECT query, token, list_cosine_similarity(v, u) AS sim FROM e JOIN q ON true)
    SELECT query, token, round(sim, 6) AS similarity, row_number() OVER (PARTITION BY query ORDER BY round(sim, 9) DESC, token) AS rank
    FROM s QUALIFY rank <= 50
""")
def vector_arithmetic(spark, folder):
    return rounded(E.vector_arithmetic(model(spark, folder), 5, 6, 9), "similarity")


@QUERIES.add("L6_cooccurrences", f"""
    WITH t AS (SELECT doc_id, list_filter({Q.vectoriser_tokens('text')}, lambda w: w NOT IN ({STOP})) AS w FROM documents),
    o AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS at FROM t),
    k AS (SELECT token FROM o GROUP BY token HAVING count(*) >= 2),
    p AS (SELECT a.token AS token, b.token AS context FROM o a JOIN o b ON a.doc_id = b.doc_id AND b.at <> a.at AND abs(b.at - a.at) <= 5)
    SELECT token, context, count(*) AS n FROM p SEMI JOIN k USING (token)
    WHERE context IN (SELECT token FROM k) GROUP BY ALL
""")
def cooccurrences(spark, folder):
    words = documents(spark, folder).select(content_words().alias("w"))
    return E.cooccurrences(words, "w")


@QUERIES.add("L6_train_vectors")
def train_vectors(spark, folder):
    words = documents(spark, folder).select(content_words().alias("w"))
    return E.train_vectors(words, "w", size=16)


# Contexts are sampled by their observed pairs to the power 3/4.
@QUERIES.add("L6_sampling_table", f"""
    WITH t AS (SELECT doc_id, list_filter({Q.vectoriser_tokens('text')}, lambda w: w NOT IN ({STOP})) AS w FROM documents),
    o AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS at FROM t),
    k AS (SELECT token FROM o GROUP BY token HAVING count(*) >= 2),
    p AS (SELECT a.token AS token FROM o a JOIN o b ON a.doc_id = b.doc_id AND b.at <> a.at AND abs(b.at - a.at) <= 5
          WHERE a.token IN (SELECT token FROM k) AND b.token IN (SELECT token FROM k)),
    c AS (SELECT token, count(*) AS n FROM p GROUP BY token)
    SELECT token, n, round(pow(n, 0.75) / sum(pow(n, 0.75)) OVER (), 9) AS share FROM c
""")
def sampling_table(spark, folder):
    words = documents(spark, folder).select(content_words().alias("w"))
    table = S.sampling_table(E.cooccurrences(words, "w"))
    return table.withColumn("share", F.round("share", 9))


@QUERIES.add("L6_skipgram_vectors")
def skipgram_vectors(spark, folder):
    words = documents(spark, folder).select(content_words().alias("w"))
    return S.train_skipgram(words, "w", training=S.Training(size=16, epochs=2, passes=2), blocks=2)
