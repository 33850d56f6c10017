"""Vocabulary, TF-IDF, time series and corpus comparison on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.functions import text as T
from weftwork.operators import compare as C
from weftwork.operators import tfidf as W
from weftwork.operators import timeseries as D
from weftwork.operators import vocabulary as V
from weftwork.operators.similarity import find_similar_sets
from weftwork.plans import snippets as Q
from weftwork.plans.registry import Registry
from weftwork.plans.text import STOP, documents
from weftwork.session import materialise
from weftwork.sources.tables import read_table

QUERIES = Registry()


def tokens():
    return T.vectoriser_tokens("text")


def content_words():
    return T.without_stop_words(T.vectoriser_tokens("text"))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


FREQ = f"WITH {Q.counts('lang, doc_id')}, freq AS (SELECT lang, term AS word, CAST(sum(tf) AS BIGINT) AS frequency FROM c GROUP BY ALL)"
N_DOCS = "n AS (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang)"


@QUERIES.add("E1_frequency_table", f"""{FREQ}
    SELECT lang, word, frequency, round(frequency / sum(frequency) OVER (PARTITION BY lang) * 100, 6) AS percentage,
           round(sum(frequency) OVER (PARTITION BY lang ORDER BY frequency DESC, word ROWS UNBOUNDED PRECEDING)
                 / sum(frequency) OVER (PARTITION BY lang) * 100, 6) AS cumulative_percentage
    FROM freq
""")
def frequency_table(spark, folder):
    freq = V.frequencies(documents(spark, folder), ["lang"], tokens())
    return rounded(V.frequency_table(freq, ["lang"]), "percentage", "cumulative_percentage")


STATS_SQL = """ranked AS (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY frequency DESC, word) AS rn FROM freq)
    SELECT {k}, CAST(sum(frequency) AS BIGINT) AS total_words, count(*) AS unique_words,
           count_if(frequency >= 2) AS words_min_freq,
           round(CASE WHEN count(*) < 1000 THEN 100.0
                 ELSE sum(CASE WHEN rn <= 1000 THEN frequency END) / sum(frequency) * 100 END, 6) AS coverage_top_1000
    FROM ranked GROUP BY {k}"""


@QUERIES.add("E2_vocabulary_stats", f"{FREQ}, {STATS_SQL.format(k='lang')}")
def vocabulary_stats(spark, folder):
    freq = V.frequencies(documents(spark, folder), ["lang"], tokens())
    return rounded(V.vocabulary_stats(freq, ["lang"]), "coverage_top_1000")


@QUERIES.add("E3_presence_stats", f"""
    WITH {Q.counts('lang, doc_id', stop=STOP)},
    freq AS (SELECT DISTINCT lang, term AS word, 1 AS frequency FROM c), {STATS_SQL.format(k='lang')}
""")
def presence_stats(spark, folder):
    freq = V.frequencies(documents(spark, folder), ["lang"], content_words(), mode="presence")
    return rounded(V.vocabulary_stats(freq, ["lang"]), "coverage_top_1000")


@QUERIES.add("E4_vocabulary_index", f"""
    WITH {Q.counts('lang, doc_id')}, v AS (SELECT DISTINCT lang, term FROM c)
    SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY term) - 1 AS idx FROM v
""")
def vocabulary_index(spark, folder):
    return V.vocabulary_index(documents(spark, folder), ["lang"], tokens())


def doc_counts(spark, folder):
    return V.term_counts(documents(spark, folder), ["lang", "doc_id"], tokens())


@QUERIES.add("E5_document_frequency", f"""
    WITH {Q.counts('lang, doc_id')} SELECT lang, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf FROM c GROUP BY ALL
""")
def document_frequency(spark, folder):
    return V.document_frequencies(doc_counts(spark, folder), ["lang"])


@QUERIES.add("E6_relative_frequency", f"""
    WITH {Q.counts('lang, doc_id')} SELECT lang, doc_id, term, tf, CAST(n_tokens AS BIGINT) AS n_tokens, round(tf / n_tokens, 6) AS tf_ratio FROM c
""")
def relative_frequency(spark, folder):
    return rounded(W.relative_frequencies(doc_counts(spark, folder)), "tf_ratio")


IDF_A = f"{N_DOCS}, idf AS (SELECT lang, term, count(*) AS df, ln(any_value(n_docs) / (1 + count(*))) + 1 AS idf FROM c JOIN n USING (lang) GROUP BY ALL)"


@QUERIES.add("E7_plain_idf", f"WITH {Q.counts('lang, doc_id')}, {IDF_A} SELECT lang, term, df, round(idf, 6) AS idf FROM idf")
def plain_idf(spark, folder):
    n = V.document_counts(read_table(spark, folder, "documents"), ["lang"])
    return rounded(W.plain_idf(doc_counts(spark, folder), n, ["lang"]), "idf")


WEIGHTS_A = f"WITH {Q.counts('lang, doc_id')}, {IDF_A}, w AS MATERIALIZED (SELECT lang, doc_id, term, tf / n_tokens * idf AS weight FROM c JOIN idf USING (lang, term))"


def weights_a(spark, folder):
    return W.tfidf_plain(documents(spark, folder), ["lang"], "doc_id", tokens())


@QUERIES.add("E8_tfidf_plain", f"{WEIGHTS_A} SELECT lang, doc_id, term, round(weight, 6) AS weight FROM w")
def tfidf_plain(spark, folder):
    return rounded(weights_a(spark, folder), "weight")


def matrix_sql(corpus: str, max_terms: int, min_df: int, stop: str = "", source: str = "documents") -> str:
    """CTEs voc and w: the pruned vocabulary and the normalised weights."""
    return f"""{Q.counts(f'{corpus}, doc_id', source=source, stop=stop)},
    n AS (SELECT {corpus}, count(*) AS n_docs FROM {source} GROUP BY ALL),
    voc0 AS (SELECT {corpus}, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf FROM c GROUP BY ALL HAVING count(*) >= {min_df}),
    voc AS (SELECT * FROM voc0 QUALIFY row_number() OVER (PARTITION BY {corpus} ORDER BY total_tf DESC, term) <= {max_terms}),
    raw AS (SELECT c.{corpus}, doc_id, c.term, tf * (ln((1 + n_docs) / (1 + df)) + 1) AS raw
            FROM c JOIN voc ON c.{corpus} = voc.{corpus} AND c.term = voc.term JOIN n ON n.{corpus} = c.{corpus}),
    w AS (SELECT {corpus}, doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


MATRIX = f"WITH {matrix_sql('lang', 1000, 2, STOP)}"
MEANS = f"{MATRIX}, m AS (SELECT lang, term, sum(weight) / any_value(n_docs) AS score FROM w JOIN n USING (lang) GROUP BY lang, term)"


def matrix(spark, folder, corpus: str = "lang", **options) -> W.Weighted:
    return W.tfidf_matrix(documents(spark, folder), [corpus], "doc_id", content_words(), **options)


def means(spark, folder) -> DataFrame:
    return W.mean_scores(matrix(spark, folder), ["lang"])


@QUERIES.add("E9_tfidf_matrix", f"{MATRIX} SELECT lang, doc_id, term, round(weight, 6) AS weight FROM w")
def tfidf_matrix(spark, folder):
    return rounded(matrix(spark, folder).weights, "weight")


@QUERIES.add("E10_pruned_vocabulary", f"{MATRIX} SELECT lang, term, df, total_tf FROM voc")
def pruned_vocabulary(spark, folder):
    counts = V.term_counts(documents(spark, folder), ["lang", "doc_id"], content_words())
    return V.pruned_vocabulary(counts, ["lang"], 2, 1000)


@QUERIES.add("E11_count_vectors", f"""{MATRIX}
    SELECT lang, doc_id, term, CAST(tf AS DOUBLE) AS weight FROM c SEMI JOIN voc USING (lang, term)
""")
def count_vectors(spark, folder):
    return W.count_vectors(documents(spark, folder), ["lang"], "doc_id", content_words(), 1000, 2).weights


@QUERIES.add("E12_mean_scores", f"{MEANS} SELECT lang, term, round(score, 6) AS score FROM m")
def mean_scores(spark, folder):
    return rounded(means(spark, folder), "score")


TOP_SQL = """SELECT {k}, term, round(score, 6) AS score, row_number() OVER (PARTITION BY {k} ORDER BY score DESC, term) AS rank
    FROM m QUALIFY rank <= {n}"""


@QUERIES.add("E13_top_terms", f"{MEANS} {TOP_SQL.format(k='lang', n=10)}")
def top_terms(spark, folder):
    return rounded(W.top_terms(means(spark, folder), ["lang"], 10), "score")


@QUERIES.add("E14_term_importance", f"""{WEIGHTS_A},
    r AS MATERIALIZED (SELECT lang, doc_id, term, round(weight, 12) AS weight FROM w),
    s AS MATERIALIZED (SELECT lang, term, sum(weight) / any_value(n_docs) AS avg_tfidf, max(weight) AS max_tfidf FROM r JOIN n USING (lang) GROUP BY ALL)
    SELECT lang, term, doc_id, round(avg_tfidf, 6) AS avg_tfidf, round(max_tfidf, 6) AS max_tfidf
    FROM s JOIN r USING (lang, term) WHERE weight = max_tfidf
""")
def term_importance(spark, folder):
    n = V.document_counts(read_table(spark, folder, "documents"), ["lang"])
    weights = materialise(weights_a(spark, folder).withColumn("weight", F.round("weight", 12)), "weights")
    return rounded(W.term_importance(weights, n, ["lang"], "doc_id"), "avg_tfidf", "max_tfidf")


SHAPE_SQL = """SELECT lang, n_docs AS n_rows, count(term) AS n_cols, CAST(sum(df) AS BIGINT) AS nnz,
    round(100 * (1 - sum(df) / (n_docs * count(term))), 6) AS sparsity FROM n LEFT JOIN voc USING (lang) GROUP BY lang, n_docs"""


@QUERIES.add("E15_matrix_shape", f"{MATRIX} {SHAPE_SQL}")
def matrix_shape(spark, folder):
    return rounded(W.matrix_shape(matrix(spark, folder), ["lang"]), "sparsity")


@QUERIES.add("E16_report", f"""{MEANS},
    freq AS (SELECT lang, term AS word, CAST(sum(tf) AS BIGINT) AS frequency FROM c GROUP BY ALL),
    f AS (SELECT lang, CAST(sum(frequency) AS BIGINT) AS total_words, count(*) AS unique_words FROM freq GROUP BY lang),
    sh AS ({SHAPE_SQL}), b AS (SELECT lang, round(max(score), 6) AS best_score FROM m GROUP BY lang)
    SELECT lang, total_words, unique_words, n_rows, n_cols, nnz, sparsity, best_score FROM f JOIN sh USING (lang) JOIN b USING (lang)
""")
def report(spark, folder):
    r = W.create_report(documents(spark, folder), ["lang"], "doc_id", content_words())
    best = r.tf_idf_scores.groupBy("lang").agg(F.round(F.max("score"), 6).alias("best_score"))
    stats = r.vocab_stats.select("lang", "total_words", "unique_words")
    return stats.join(rounded(r.matrix_shape, "sparsity"), "lang").join(best, "lang")


@QUERIES.add("E17_per_source_top_terms", f"""
    WITH {matrix_sql('source', 500, 2, STOP)},
    m AS (SELECT source, term, sum(weight) / any_value(n_docs) AS score FROM w JOIN n USING (source) GROUP BY source, term)
    {TOP_SQL.format(k='source', n=5)}
""")
def per_source_top_terms(spark, folder):
    scores = W.mean_scores(matrix(spark, folder, "source", max_terms=500), ["source"])
    return rounded(W.top_terms(scores, ["source"], 5), "score")


POOLED = "(SELECT 'all' AS corpus, * FROM documents)"


@QUERIES.add("E17_pooled_top_terms", f"""
    WITH {matrix_sql('corpus', 1000, 2, STOP, POOLED)},
    m AS (SELECT corpus, term, sum(weight) / any_value(n_docs) AS score FROM w JOIN n USING (corpus) GROUP BY corpus, term)
    {TOP_SQL.format(k='corpus', n=20)}
""")
def pooled_top_terms(spark, folder):
    pooled = documents(spark, folder).withColumn("corpus", F.lit("all"))
    scores = W.mean_scores(W.tfidf_matrix(pooled, ["corpus"], "doc_id", content_words()), ["corpus"])
    return rounded(W.top_terms(scores, ["corpus"], 20), "score")


# ---------------------------------------------------------------- time

@QUERIES.add("F1_daily_term_counts", f"""
    WITH t AS (SELECT CAST(ts AS DATE) AS date, {Q.split_words(Q.clean_light("event_type || ' ' || props"))} AS w FROM events),
    terms AS (SELECT unnest(['click', 'view', 'error', 'k']) AS term), days AS (SELECT DISTINCT date FROM t),
    hits AS (SELECT date, unnest(w) AS term FROM t)
    SELECT days.date, terms.term, count(hits.term) AS n FROM days CROSS JOIN terms
    LEFT JOIN hits ON hits.date = days.date AND hits.term = terms.term GROUP BY ALL
""")
def daily_term_counts(spark, folder):
    posts = read_table(spark, folder, "events").select("ts", F.col("event_type").alias("title"), F.col("props").alias("selftext"))
    words = T.simple_tokens(T.joined_text("title", "selftext"))
    return D.daily_term_counts(posts, "ts", words, ["click", "view", "error", "k"])


@QUERIES.add("F2_unknown_terms", f"""
    SELECT term FROM (SELECT unnest(['the', 'and', 'zzyzx', 'qqfoo']) AS term)
    WHERE term NOT IN (SELECT unnest({Q.vectoriser_tokens('text')}) FROM documents)
""")
def unknown_terms(spark, folder):
    missing = D.missing_terms(documents(spark, folder), tokens(), ["the", "and", "zzyzx", "qqfoo"])
    return spark.createDataFrame([(t,) for t in missing], "term string")


# ---------------------------------------------------------------- comparison

def jaccard_sql(owner: str, pairs: str) -> str:
    return f"""p AS (SELECT DISTINCT {owner} AS o, {pairs}), s AS (SELECT o, count(*) AS n FROM p GROUP BY o),
    x AS (SELECT a.o AS l, b.o AS r, count(*) AS shared FROM p a JOIN p b ON a.item = b.item AND a.o < b.o GROUP BY ALL)
    SELECT a.o AS "left", b.o AS "right", coalesce(shared, 0) AS shared,
           round(coalesce(shared, 0) / (a.n + b.n - coalesce(shared, 0)), 6) AS jaccard
    FROM s a JOIN s b ON a.o < b.o LEFT JOIN x ON x.l = a.o AND x.r = b.o"""


@QUERIES.add("G1_jaccard_languages", f"WITH {Q.counts('lang, doc_id')}, {jaccard_sql('lang', 'term AS item FROM c')}")
def jaccard_languages(spark, folder):
    words = V.term_rows(documents(spark, folder), ["lang"], tokens())
    return rounded(C.jaccard_report(words, "lang", "term"), "jaccard")


@QUERIES.add("G1_jaccard_sources", f"WITH {Q.counts('source, doc_id')}, {jaccard_sql('source', 'term AS item FROM c')}")
def jaccard_sources(spark, folder):
    words = V.term_rows(documents(spark, folder), ["source"], tokens())
    return rounded(C.jaccard_report(words, "source", "term"), "jaccard")


COMMON = f"WITH {Q.counts('lang, doc_id')}, p AS (SELECT DISTINCT lang, term FROM c), common AS (SELECT term FROM p GROUP BY term HAVING count(*) = (SELECT count(DISTINCT lang) FROM p))"


def lang_terms(spark, folder):
    return V.term_rows(documents(spark, folder), ["lang"], tokens())


@QUERIES.add("G2_common_terms", f"{COMMON} SELECT term FROM common")
def common_terms(spark, folder):
    return C.common_terms(lang_terms(spark, folder), "lang")


@QUERIES.add("G3_unique_terms", f"{COMMON} SELECT lang, term FROM p ANTI JOIN common USING (term)")
def unique_terms(spark, folder):
    return C.unique_terms(lang_terms(spark, folder), "lang")


LANGS = ["de", "en", "es", "fr"]
WIDE_SQL = "wide AS (SELECT term, " + ", ".join(f"max(CASE WHEN lang = '{x}' THEN score END) AS {x}" for x in LANGS) + " FROM m GROUP BY term)"
ALL_THERE = " AND ".join(f"{x} IS NOT NULL" for x in LANGS)


@QUERIES.add("G4_common_score_table", f"""{MEANS}, {WIDE_SQL}
    SELECT term, {', '.join(f'round({x}, 6) AS {x}' for x in LANGS)}, round(({' + '.join(LANGS)}) / 4, 6) AS mean
    FROM wide WHERE {ALL_THERE} ORDER BY ({' + '.join(LANGS)}) / 4 DESC, term LIMIT 5
""")
def common_score_table(spark, folder):
    return rounded(C.common_score_table(means(spark, folder), "lang", LANGS), *LANGS, "mean")


# Sources share far more terms than languages do.
SOURCES = ["src0", "src1", "src2", "src3"]
SOURCE_MEANS = f"""WITH {matrix_sql('source', 500, 2, STOP)},
    m AS (SELECT source, term, sum(weight) / any_value(n_docs) AS score FROM w JOIN n USING (source) GROUP BY source, term),
    wide AS (SELECT term, {', '.join(f"max(CASE WHEN source = '{x}' THEN score END) AS {x}" for x in SOURCES)} FROM m GROUP BY term)"""
SOURCES_THERE = " AND ".join(f"{x} IS NOT NULL" for x in SOURCES)


def source_means(spark, folder) -> DataFrame:
    weighted = W.tfidf_matrix(documents(spark, folder), ["source"], "doc_id", content_words(), 500, 2)
    return W.mean_scores(weighted, ["source"])


@QUERIES.add("G4_source_score_table", f"""{SOURCE_MEANS}
    SELECT term, {', '.join(f'round({x}, 6) AS {x}' for x in SOURCES)}, round(({' + '.join(SOURCES)}) / 4, 6) AS mean FROM wide WHERE {SOURCES_THERE}
""")
def source_score_table(spark, folder):
    return rounded(C.score_table(source_means(spark, folder), "source", SOURCES), *SOURCES, "mean")


@QUERIES.add("G5_source_ranks", f"""{SOURCE_MEANS}, shared AS (SELECT term FROM wide WHERE {SOURCES_THERE}),
    r AS (SELECT source, term, rank() OVER (PARTITION BY source ORDER BY round(score, 9) DESC) AS rank FROM m SEMI JOIN shared USING (term))
    SELECT term, {', '.join(f"max(CASE WHEN source = '{x}' THEN rank END) AS {x}" for x in SOURCES)} FROM r GROUP BY term
""")
def source_ranks(spark, folder):
    return C.rank_comparison(source_means(spark, folder), "source", SOURCES)


@QUERIES.add("G5_rank_comparison", f"""{MEANS}, {WIDE_SQL}, shared AS (SELECT term FROM wide WHERE {ALL_THERE}),
    r AS (SELECT lang, term, rank() OVER (PARTITION BY lang ORDER BY round(score, 9) DESC) AS rank FROM m SEMI JOIN shared USING (term))
    SELECT term, {', '.join(f"max(CASE WHEN lang = '{x}' THEN rank END) AS {x}" for x in LANGS)} FROM r GROUP BY term
""")
def rank_comparison(spark, folder):
    return C.rank_comparison(means(spark, folder), "lang", LANGS)


DISTANCE_SQL = """nn AS (SELECT lang, sum(score * score) AS sq FROM m GROUP BY lang),
    dots AS (SELECT a.lang AS l, b.lang AS r, sum(a.score * b.score) AS d FROM m a JOIN m b ON a.term = b.term AND a.lang < b.lang GROUP BY ALL),
    g AS (SELECT a.lang AS l, b.lang AS r, a.sq AS a, b.sq AS b, coalesce(d, 0) AS d FROM nn a JOIN nn b ON a.lang < b.lang
          LEFT JOIN dots ON dots.l = a.lang AND dots.r = b.lang)"""


@QUERIES.add("G6_corpus_distances", f'{MEANS}, {DISTANCE_SQL} SELECT l AS "left", r AS "right", round(sqrt(a + b - 2 * d), 6) AS distance FROM g')
def corpus_distances(spark, folder):
    return rounded(C.report_distances(means(spark, folder), "lang"), "distance").drop("angle")


@QUERIES.add("G7_corpus_angles", f"""{MEANS}, {DISTANCE_SQL}
    SELECT l AS "left", r AS "right", round(degrees(acos(least(1.0, greatest(-1.0, d / sqrt(a * b))))), 6) AS angle FROM g""")
def corpus_angles(spark, folder):
    return rounded(C.report_distances(means(spark, folder), "lang"), "angle").drop("distance")


@QUERIES.add("G8_term_space", f"""{MEANS}
    SELECT lang, round(coalesce(max(CASE WHEN term = 'que' THEN score END), 0), 6) AS x,
           round(coalesce(max(CASE WHEN term = 'tion' THEN score END), 0), 6) AS y FROM m GROUP BY lang
""")
def term_space(spark, folder):
    return rounded(C.term_space(means(spark, folder), "lang", "que", "tion"), "x", "y")


@QUERIES.add("G9_jaccard_of_posts", f"""
    WITH {jaccard_sql('props', 'user_id AS item FROM events')} QUALIFY true
""".replace(" QUALIFY true", ""))
def jaccard_of_posts(spark, folder):
    commenters = read_table(spark, folder, "events")
    return rounded(C.jaccard_report(commenters, "props", "user_id"), "jaccard")


@QUERIES.add("G9_similar_posts", f"""
    WITH p AS (SELECT DISTINCT props AS o, user_id AS item FROM events), s AS (SELECT o, count(*) AS n FROM p GROUP BY o),
    x AS (SELECT a.o AS l, b.o AS r, count(*) AS c FROM p a JOIN p b ON a.item = b.item AND a.o < b.o GROUP BY ALL),
    j AS (SELECT l, r, c / (a.n + b.n - c) AS v FROM x JOIN s a ON a.o = l JOIN s b ON b.o = r)
    SELECT l AS "left", r AS "right", round(v, 6) AS similarity FROM j WHERE v >= 0.3
""")
def similar_posts(spark, folder):
    commenters = read_table(spark, folder, "events")
    return rounded(find_similar_sets(commenters, "props", "user_id", min_similarity=0.3), "similarity")
