"""Sources, cleaning, tokens and sentiment on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.functions import text as T
from weftwork.operators import lexicon as L
from weftwork.operators import sentiment as S
from weftwork.operators import vocabulary as V
from weftwork.operators.cleaning import preprocess
from weftwork.plans import snippets as Q
from weftwork.plans.registry import Registry
from weftwork.session import materialise, new_folder
from weftwork.sources import encoding, listings
from weftwork.sources.corpora import parse_corpus
from weftwork.sources.tables import load_results, read_table, save_results, spread
from weftwork.sources.snapshots import SnapshotStore
from weftwork.sources.threads import parse_comments

QUERIES = Registry()
STOP = Q.quoted(T.ENGLISH_STOP_WORDS)


def documents(spark, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "documents"))


# ---------------------------------------------------------------- sources

@QUERIES.add("A1_load_corpus", """
    SELECT doc_id // 8 AS part, CAST(row_number() OVER (PARTITION BY doc_id // 8 ORDER BY doc_id) - 1 AS INT) AS doc_id,
           text, CAST(quality AS VARCHAR) AS label
    FROM documents JOIN labels USING (doc_id)
""")
def load_corpus(spark, folder):
    # Corpus files of up to eight documents each, as text.
    rows = documents(spark, folder).select("doc_id", "text").join(read_table(spark, folder, "labels"), "doc_id")
    pair = F.struct("doc_id", F.array("text", F.col("quality").cast("string")).alias("pair"))
    files = rows.groupBy(F.expr("doc_id div 8").alias("part")).agg(F.array_sort(F.collect_list(pair)).alias("p"))
    meta = F.struct(F.lit("labelled documents").alias("description"), F.lit("1").alias("version"))
    files = files.select("part", F.to_json(F.struct(F.col("p.pair").alias("documents"), meta.alias("metadata"))).alias("json"))
    return parse_corpus(files, "json", ["part"])


@QUERIES.add("A2_listing_posts", """
    SELECT doc_id // 25 AS page, CAST(row_number() OVER (PARTITION BY doc_id // 25 ORDER BY doc_id) - 1 AS INT) AS pos,
           CAST(doc_id AS VARCHAR) AS id, lang || ' ' || source AS title, text AS selftext, source AS author,
           n_chars AS score, CAST(doc_id * 60 AS DOUBLE) AS created_utc, CAST(NULL AS BIGINT) AS num_comments,
           'https://' || source || '.example.org/' || doc_id AS url
    FROM documents
""")
def listing_posts(spark, folder):
    post = F.struct(
        F.col("doc_id").cast("string").alias("id"), F.concat_ws(" ", "lang", "source").alias("title"),
        F.col("text").alias("selftext"), F.col("source").alias("author"), F.col("n_chars").alias("score"),
        (F.col("doc_id") * 60).cast("double").alias("created_utc"),
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), F.col("doc_id").cast("string")).alias("url"),
    )
    pages = documents(spark, folder).groupBy(F.expr("doc_id div 25").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", post.alias("data")))).alias("p")
    )
    children = F.transform("p", lambda c: F.struct(c["data"].alias("data")))
    pages = pages.select("page", F.to_json(F.struct(F.struct(children.alias("children")).alias("data"))).alias("json"))
    return listings.parse_listings(pages, "json", ["page"])


PAGE_POSTS = """
    SELECT 'page ' || page_id AS title, CASE WHEN page_id % 3 <> 0 THEN html END AS selftext, url,
           CASE WHEN page_id % 10 <> 0 THEN CAST(page_id * 3600 AS DOUBLE) END AS created_utc,
           'author ' || page_id % 7 AS author
    FROM pages
"""


def page_posts(spark, folder):
    return spread(read_table(spark, folder, "pages")).select(
        F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("title"),
        F.when(F.col("page_id") % 3 != 0, F.col("html")).alias("selftext"), "url",
        F.when(F.col("page_id") % 10 != 0, (F.col("page_id") * 3600).cast("double")).alias("created_utc"),
        F.concat(F.lit("author "), (F.col("page_id") % 7).cast("string")).alias("author"),
    )


@QUERIES.add("A3_posts_table", rf"""
    SELECT title, length(selftext) AS n_self, url, nullif(regexp_extract(url, '(https?://[^/]+)', 1), '') AS domain,
           strftime(epoch_ms(CAST(coalesce(created_utc, 0) * 1000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS time, author
    FROM ({PAGE_POSTS})
""")
def posts_table(spark, folder):
    posts = listings.posts_table(page_posts(spark, folder))
    return posts.select(
        "title", F.char_length("selftext").cast("long").alias("n_self"), "url", "domain",
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "author",
    )


@QUERIES.add("A4_parse_comments", """
    WITH t AS (SELECT 't' || conv_id || '-' || turn AS post_id, conv_id || '-' || turn AS k, role, text FROM conversations)
    SELECT 'c' || k AS comment_id, NULL AS parent_id, post_id, role AS author, text AS body, '0' AS path FROM t
    UNION ALL SELECT 'r' || k, 'c' || k, post_id, 'reader', role, '0.0' FROM t
    UNION ALL SELECT 's' || k, 'r' || k, post_id, role, text, '0.0.0' FROM t
    UNION ALL SELECT 'm' || k, 'c' || k, post_id, NULL, NULL, '0.1' FROM t
""")
def comments_from_json(spark, folder):
    rows = read_table(spark, folder, "conversations").withColumn(
        "k", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    )

    def comment(prefix, author, body, replies):
        return F.struct(F.struct(
            F.concat(F.lit(prefix), "k").alias("id"), author.alias("author"), body.alias("body"), replies.alias("replies"),
        ).alias("data"))

    def listing(*children):
        return F.struct(F.struct(F.array(*children).alias("children")).alias("data"))

    leaf = F.to_json(comment("s", F.col("role"), F.col("text"), F.lit("")))
    nothing = F.lit('{"kind":"more"}')
    stub = F.to_json(F.struct(F.struct(F.concat(F.lit("m"), "k").alias("id")).alias("data")))
    inner = F.to_json(comment("r", F.lit("reader"), F.col("role"), F.lit("@INNER")))
    outer = F.to_json(comment("c", F.col("role"), F.lit("@BODY"), F.lit("@OUTER")))
    wrap = '{"data":{"children":['
    middle = F.replace(inner, F.lit('"@INNER"'), F.concat(F.lit(wrap), leaf, F.lit(","), nothing, F.lit("]}}")))
    body = F.get_json_object(F.to_json(F.struct(F.array("text").alias("t"))), "$.t")
    body = F.substring(body, F.lit(2), F.char_length(body) - 2)
    top = F.replace(outer, F.lit('"@OUTER"'), F.concat(F.lit(wrap), middle, F.lit(","), stub, F.lit("]}}")))
    top = F.replace(top, F.lit('"@BODY"'), body)
    threads = rows.select(F.concat(F.lit("t"), "k").alias("thread"), F.concat(F.lit("["), top, F.lit("]")).alias("json"))
    return parse_comments(threads, "thread", "json").withColumn("path", F.array_join("path", "."))


@QUERIES.add("A5_stack_corpora", """
    SELECT 'documents' AS subreddit, doc_id AS id, text, NULL AS role FROM documents
    UNION ALL SELECT 'conversations', conv_id, text, role FROM conversations
    UNION ALL SELECT 'benchmark', item_id, text, NULL FROM benchmark
""")
def stack_corpora(spark, folder):
    return listings.stack({
        "documents": read_table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text"),
        "conversations": read_table(spark, folder, "conversations").select(F.col("conv_id").alias("id"), "text", "role"),
        "benchmark": read_table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text"),
    })


@QUERIES.add("A6_fresh_snapshot", """
    SELECT event_type AS corpus, user_id AS lim, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS fetched_at
    FROM events WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR GROUP BY ALL
""")
def fresh_snapshot(spark, folder):
    snapshots = read_table(spark, folder, "events").select(
        F.col("event_type").alias("corpus"), F.col("user_id").alias("lim"), F.col("ts").alias("fetched_at")
    )
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    fresh = listings.fresh_snapshot(snapshots, ["corpus", "lim"], "fetched_at", 24, now)
    return fresh.withColumn("fetched_at", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss"))


# Two commits: the events up to a day, then all of later days; wanted keys without a fresh result are filled.
@QUERIES.add("A7_snapshot_store", """
    WITH e AS (SELECT event_type AS corpus, user_id AS lim, ts, value FROM events),
    last AS (SELECT corpus, lim, max(ts) AS ts FROM e GROUP BY ALL),
    kept AS (SELECT corpus, lim, e.ts, value FROM e JOIN last USING (corpus, lim, ts)),
    stale AS (SELECT corpus, lim FROM last WHERE ts <= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR)
    SELECT corpus, lim, strftime(ts, '%Y-%m-%d %H:%M:%S') AS fetched_at, round(value, 6) AS value FROM kept ANTI JOIN stale USING (corpus, lim)
    UNION ALL SELECT corpus, lim, '2024-01-30 12:00:00', -1.0 FROM stale
""")
def snapshot_store(spark, folder):
    events = read_table(spark, folder, "events").select(
        F.col("event_type").alias("corpus"), F.col("user_id").alias("lim"), F.col("ts").alias("fetched_at"), "value"
    )
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    cut = F.col("fetched_at") < F.lit("2024-01-15").cast("timestamp_ntz")
    store = SnapshotStore(spark, new_folder(spark, "snapshots"), ["corpus", "lim"])
    store.commit(events.filter(cut))
    store.commit(events.filter(~cut))
    found = store.reuse_or_fill(events, lambda keys: keys.select("corpus", "lim", now.alias("fetched_at"), F.lit(-1.0).alias("value")), 24, now)
    return found.select("corpus", "lim", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), F.round("value", 6).alias("value"))


@QUERIES.add("A7_save_results", f"""
    WITH {Q.counts('lang, doc_id')}
    SELECT lang AS corpus, term AS word, CAST(sum(tf) AS BIGINT) AS frequency FROM c GROUP BY ALL
""")
def saved_results(spark, folder):
    freq = V.frequencies(documents(spark, folder), ["lang"], T.vectoriser_tokens("text"))
    target = new_folder(spark, "results")
    save_results({"frequency": freq.withColumnRenamed("lang", "corpus")}, target)
    return load_results(spark, target, ["frequency"])["frequency"]


@QUERIES.add("A8_write_audit", r"""
    SELECT doc_id, 'ascii' AS encoding, regexp_full_match(text, '[\x{00}-\x{7f}]*') AS ok FROM documents
    UNION ALL SELECT doc_id, 'latin-1', regexp_full_match(text, '[\x{00}-\x{ff}]*') FROM documents
    UNION ALL SELECT doc_id, 'utf-8', true FROM documents
""")
def write_audit(spark, folder):
    return encoding.write_audit(documents(spark, folder), ["doc_id"], "text").drop("message")


@QUERIES.add("A8_read_audit", r"""
    SELECT doc_id, 'ascii' AS encoding, regexp_full_match(text, '[\x{00}-\x{7f}]*') AS ok FROM documents
    UNION ALL SELECT doc_id, 'latin-1', true FROM documents
    UNION ALL SELECT doc_id, 'utf-8', text = '' OR unicode(right(text, 1)) < 128 FROM documents
""")
def read_audit(spark, folder):
    # The bytes of each text; its last byte is 0xff where the last character is not ASCII.
    raw = F.encode("text", "UTF-8")
    broken = F.concat(F.expr("substring(encode(text, 'UTF-8'), 1, octet_length(text) - 1)"), F.unhex(F.lit("FF")))
    content = F.when(F.ascii(F.right("text", F.lit(1))) < 128, raw).when(F.col("text") == "", raw).otherwise(broken)
    files = documents(spark, folder).select("doc_id", content.alias("content"))
    return encoding.read_audit(files, ["doc_id"]).drop("message")


@QUERIES.add("A9_character_profile", r"""
    WITH ch AS (SELECT unnest(regexp_extract_all(text, '(?s).')) AS ch FROM documents)
    SELECT ch, unicode(ch) AS code_point,
           CASE WHEN unicode(ch) > 65535 THEN '\U' || upper(printf('%08x', unicode(ch)))
                ELSE '\u' || upper(printf('%04x', unicode(ch))) END AS escape,
           count(*) AS n
    FROM ch GROUP BY ch
""")
def character_profile(spark, folder):
    return encoding.character_profile(documents(spark, folder), "text")


# ---------------------------------------------------------------- text functions

@QUERIES.add("B1_clean_light", f"SELECT doc_id, {Q.clean_light('text')} AS clean FROM documents")
def clean_light(spark, folder):
    return documents(spark, folder).select("doc_id", T.clean_light("text").alias("clean"))


SPLIT_SQL = "CASE w " + " ".join(
    f"WHEN '{form}' THEN [{Q.quoted(parts)}]" for form, parts in T.SPLIT_FORMS.items()
) + " ELSE [w] END"
FULL_TOKENS = f"flatten(list_transform({Q.split_words(Q.clean_full('text'))}, lambda w: {SPLIT_SQL}))"


@QUERIES.add("B2_preprocess", f"""
    SELECT doc_id, array_to_string(list_filter({FULL_TOKENS},
           lambda w: w NOT IN ({STOP}) AND length(w) > 2), ' ') AS clean FROM documents
""")
def preprocess_texts(spark, folder):
    return preprocess(documents(spark, folder), "text").select("doc_id", "clean")


# A lemma lexicon that grows with the tables: every word ending in s, as a noun, loses it.
LEXICON_SQL = """lex AS (SELECT DISTINCT term AS form, left(term, length(term) - 1) AS lemma
                 FROM tok WHERE term LIKE '%s' AND length(term) > 3)"""


def lemma_lexicon(words: DataFrame) -> DataFrame:
    plural = words.filter(F.col("term").endswith("s") & (F.char_length("term") > 3)).select("term").distinct()
    return plural.select(
        F.col("term").alias("form"), F.lit("n").alias("pos"),
        F.expr("left(term, char_length(term) - 1)").alias("lemma"),
    )


@QUERIES.add("B2_preprocess_lemmas", f"""
    WITH tok AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS i
                 FROM (SELECT doc_id, list_filter({FULL_TOKENS}, lambda w: w NOT IN ({STOP})) AS t FROM documents)),
    {LEXICON_SQL},
    x AS (SELECT doc_id, i, coalesce(lemma, term) AS lemma FROM tok LEFT JOIN lex ON form = term),
    y AS (SELECT doc_id, string_agg(lemma, ' ' ORDER BY i) AS clean FROM x WHERE length(lemma) > 2 GROUP BY doc_id)
    SELECT doc_id, coalesce(clean, '') AS clean FROM documents LEFT JOIN y USING (doc_id)
""")
def preprocess_lemmas(spark, folder):
    docs = documents(spark, folder)
    words = V.term_rows(docs, [], T.without_stop_words(T.full_tokens("text")))
    return preprocess(docs, "text", lexicon=lemma_lexicon(words), doc="doc_id").select("doc_id", "clean")


def _token_counts(df, tokens):
    return V.term_rows(df, [], tokens).groupBy("term").agg(F.count("*").alias("n"))


def _token_sql(tokens: str) -> str:
    return f"SELECT term, count(*) AS n FROM (SELECT unnest({tokens}) AS term FROM documents) GROUP BY term"


EDGE = "'^[{0}]+|[{0}]+$'".format(T.PUNCTUATION)


@QUERIES.add("B3_outer_stripped", _token_sql(
    f"list_transform(string_split(text, ' '), lambda w: lower(regexp_replace(w, {EDGE}, '', 'g')))"
))
def outer_stripped(spark, folder):
    return _token_counts(documents(spark, folder), T.outer_stripped_tokens("text"))


@QUERIES.add("B4_word_tokens", _token_sql(rf"regexp_extract_all(text, '[{Q.WORD}]+(?:''\p{{L}}+)?')"))
def word_tokens(spark, folder):
    return _token_counts(documents(spark, folder), T.word_tokens("text"))


# The texts' words are joined forms and contractions too rarely: half of them get some, by the document's number.
TREEBANK_TAIL = '" can\'t (cannot) they\'re John\'s gonna gonna; Mr. X paid 3,000.50, etc. He\'d left... U.S. '


@QUERIES.add("B4_treebank_tokens", f"""
    SELECT term, count(*) AS n FROM (SELECT unnest({Q.treebank_tokens('s')}) AS term
        FROM (SELECT CASE WHEN doc_id % 2 = 0 THEN concat('"', text, {Q.quoted([TREEBANK_TAIL])}, doc_id % 7, '.') ELSE text END AS s FROM documents)) GROUP BY term
""")
def treebank_tokens(spark, folder):
    longer = F.concat(F.lit('"'), "text", F.lit(TREEBANK_TAIL), (F.col("doc_id") % 7).cast("string"), F.lit("."))
    told = documents(spark, folder).withColumn("s", F.when(F.col("doc_id") % 2 == 0, longer).otherwise(F.col("text")))
    return _token_counts(told, T.treebank_tokens("s"))


@QUERIES.add("B5_simple_tokens", _token_sql(Q.split_words(Q.clean_light("text"))))
def simple_tokens(spark, folder):
    return _token_counts(documents(spark, folder), T.simple_tokens("text"))


@QUERIES.add("B6_vectoriser_tokens", _token_sql(Q.vectoriser_tokens("text")))
def vectoriser_tokens(spark, folder):
    return _token_counts(documents(spark, folder), T.vectoriser_tokens("text"))


@QUERIES.add("B7_without_stop_words", f"""
    SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest({Q.vectoriser_tokens('text')}) AS term FROM documents)
    WHERE term NOT IN ({STOP}) GROUP BY ALL
""")
def without_stop_words(spark, folder):
    words = T.without_stop_words(T.vectoriser_tokens("text"))
    return V.term_rows(documents(spark, folder), ["lang"], words).groupBy("lang", "term").agg(F.count("*").alias("n"))


@QUERIES.add("B7_drop_listed", f"""
    WITH b AS (SELECT unnest({Q.vectoriser_tokens('text')}) AS term FROM benchmark),
    d AS (SELECT unnest({Q.vectoriser_tokens('text')}) AS term FROM documents)
    SELECT term, count(*) AS n FROM d WHERE term NOT IN (SELECT term FROM b) GROUP BY term
""")
def drop_listed(spark, folder):
    # The word list is the vocabulary of another table. Words are counted before they are dropped.
    listed = V.term_rows(read_table(spark, folder, "benchmark"), [], T.vectoriser_tokens("text")).distinct()
    return L.drop_listed(_token_counts(documents(spark, folder), T.vectoriser_tokens("text")), listed)


def _shape(word: str) -> str:
    """V or C per letter as SQL; see lexicon.py for the rules."""
    marks = f"regexp_replace(translate({word}, 'aeiou', 'VVVVV'), '[^Vy]', 'C', 'g')"
    marks = f"regexp_replace({marks}, '^y', 'C')"
    for _ in range(4):
        marks = f"replace(replace({marks}, 'Cy', 'CV'), 'Vy', 'VC')"
    return marks


def _has(word: str, pattern: str) -> str:
    return f"regexp_matches({_shape(word)}, '{pattern}')"


def _short(word: str) -> str:
    return f"({_has(word, 'CVC$')} AND NOT regexp_matches({word}, '[wxy]$'))"


def _by_suffix(rules, measure: str, extra: str = "true") -> str:
    pattern = "^(.*?)(" + "|".join(a for a, _ in rules) + ")$"
    new = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rules)
    stem, suffix = f"regexp_extract(w, '{pattern}', 1)", f"regexp_extract(w, '{pattern}', 2)"
    extra = extra.format(stem=stem, suffix=suffix)
    return f"CASE WHEN {suffix} <> '' AND {_has(stem, measure)} AND {extra} THEN {stem} || CASE {suffix} {new} END ELSE w END"


def _stem_sql() -> str:
    """CTEs w0 to w9(term, n, w) from words(term, n)."""
    cut = lambda n: f"left(w, length(w) - {n})"
    steps = [
        f"CASE WHEN regexp_matches(term, '(sses|ies)$') THEN left(term, length(term) - 2) WHEN regexp_matches(term, '[^s]s$') THEN left(term, length(term) - 1) ELSE term END",
        None,
        f"CASE WHEN w LIKE '%y' AND {_has(cut(1), 'V')} THEN {cut(1)} || 'i' ELSE w END",
        _by_suffix(L.STEP2, L.SOME), _by_suffix(L.STEP3, L.SOME),
        _by_suffix([(x, "") for x in L.STEP4], L.MANY, "({suffix} <> 'ion' OR regexp_matches({stem}, '[st]$'))"),
        f"CASE WHEN w LIKE '%e' AND ({_has(cut(1), L.MANY)} OR ({_has(cut(1), L.ONE)} AND NOT {_short(cut(1))})) THEN {cut(1)} ELSE w END",
        f"CASE WHEN w LIKE '%ll' AND {_has('w', L.MANY)} THEN {cut(1)} ELSE w END",
    ]
    parts = [f"w0 AS (SELECT term, n, {steps[0]} AS w FROM words)"]
    parts.append(f"""c1 AS (SELECT *, CASE WHEN w LIKE '%eed' THEN NULL WHEN w LIKE '%ed' AND {_has(cut(2), 'V')} THEN {cut(2)}
        WHEN w LIKE '%ing' AND {_has(cut(3), 'V')} THEN {cut(3)} END AS c FROM w0)""")
    parts.append(f"""w1 AS (SELECT term, n, CASE WHEN w LIKE '%eed' THEN CASE WHEN {_has(cut(3), L.SOME)} THEN {cut(1)} ELSE w END
        WHEN c IS NULL THEN w WHEN regexp_matches(c, '(at|bl|iz)$') THEN c || 'e'
        WHEN length(c) > 1 AND right(c, 1) = left(right(c, 2), 1) AND {_has('c', 'C$')} AND NOT regexp_matches(c, '[lsz]$') THEN left(c, length(c) - 1)
        WHEN {_has('c', L.ONE)} AND {_short('c')} THEN c || 'e' ELSE c END AS w FROM c1)""")
    for i, step in enumerate(steps[2:], 2):
        parts.append(f"w{i} AS (SELECT term, n, {step} AS w FROM w{i - 1})")
    return ", ".join(parts)


@QUERIES.add("B8_stems", f"""
    WITH tok AS (SELECT unnest({Q.vectoriser_tokens('text')}) AS term FROM documents),
    words AS (SELECT term, count(*) AS n FROM tok GROUP BY term), {_stem_sql()}
    SELECT term, n, CASE WHEN length(term) <= 2 THEN term ELSE w END AS stem FROM w7
""")
def stems(spark, folder):
    counts = _token_counts(documents(spark, folder), T.vectoriser_tokens("text"))
    return counts.join(L.stem_table(counts), "term")


@QUERIES.add("B9_lemmas", f"""
    WITH tok AS (SELECT unnest({Q.vectoriser_tokens('text')}) AS term FROM documents), {LEXICON_SQL}
    SELECT coalesce(lemma, term) AS lemma, count(*) AS n FROM tok LEFT JOIN lex ON form = term GROUP BY 1
""")
def lemmas(spark, folder):
    counts = _token_counts(documents(spark, folder), T.vectoriser_tokens("text"))
    return L.lemmatise(counts, lemma_lexicon(counts)).groupBy("lemma").agg(F.sum("n").alias("n"))


def _ending_sql(pos: str, end: str, new: str) -> str:
    return (
        f"SELECT form, pos, left(form, length(form) - {len(end)}) || '{new}' FROM forms "
        f"WHERE pos = '{pos}' AND suffix(form, '{end}') AND length(form) > {len(end)}"
    )


# Words of even length are nouns, others verbs; words that occur three times are lemmas of both, long words exceptions.
@QUERIES.add("B9_rule_lemmas", f"""
    WITH tok AS (SELECT unnest({Q.vectoriser_tokens('text')}) AS form FROM documents),
    forms AS MATERIALIZED (SELECT DISTINCT form, CASE WHEN length(form) % 2 = 0 THEN 'n' ELSE 'v' END AS pos FROM tok),
    lemmas AS (SELECT form AS lemma FROM tok GROUP BY form HAVING count(*) >= 3),
    made(form, pos, lemma) AS (SELECT form, pos, form FROM forms
        {' '.join('UNION ALL ' + _ending_sql(pos, end, new) for pos, endings in L.ENDINGS.items() for end, new in endings)}),
    best AS (SELECT form, lemma FROM made SEMI JOIN lemmas USING (lemma) QUALIFY row_number() OVER (PARTITION BY form ORDER BY length(lemma), lemma) = 1)
    SELECT form, pos, CASE WHEN length(form) >= 12 THEN left(form, 6) ELSE lemma END AS lemma
    FROM forms LEFT JOIN best USING (form) WHERE length(form) >= 12 OR lemma IS NOT NULL
""")
def rule_lemmas(spark, folder):
    counts = materialise(_token_counts(documents(spark, folder), T.vectoriser_tokens("text")), "token-counts")
    pos = F.when(F.char_length("term") % 2 == 0, "n").otherwise("v")
    words = counts.select(F.col("term").alias("form"), pos.alias("pos"))
    lemmas = counts.filter("n >= 3").select(F.col("term").alias("lemma"), F.explode(F.array(F.lit("n"), F.lit("v"))).alias("pos"))
    exceptions = words.filter(F.char_length("form") >= 12).withColumn("lemma", F.substring("form", 1, 6))
    return L.rule_lexicon(words, lemmas, exceptions)


@QUERIES.add("B10_wordnet_class", """
    SELECT l_linenumber, l_returnflag AS tag, CASE left(l_returnflag, 1) WHEN 'J' THEN 'a' WHEN 'V' THEN 'v' WHEN 'R' THEN 'r' ELSE 'n' END AS class,
           count(*) AS n
    FROM lineitem GROUP BY ALL
""")
def wordnet_class(spark, folder):
    return read_table(spark, folder, "lineitem").groupBy(
        "l_linenumber", F.col("l_returnflag").alias("tag"), T.wordnet_class("l_returnflag").alias("class")
    ).agg(F.count("*").alias("n"))


@QUERIES.add("B11_joined_text", f"""
    SELECT title, {Q.clean_light("title || ' ' || coalesce(selftext, '')")} AS clean FROM ({PAGE_POSTS})
""")
def joined_text(spark, folder):
    return page_posts(spark, folder).select("title", T.clean_light(T.joined_text("title", "selftext")).alias("clean"))


@QUERIES.add("B12_link_origins", """
    SELECT nullif(regexp_extract(url, '(https?://[^/]+)', 1), '') AS origin, count(*) AS n
    FROM pages GROUP BY 1 HAVING origin IS NOT NULL ORDER BY n DESC, origin LIMIT 10
""")
def link_origins(spark, folder):
    origins = read_table(spark, folder, "pages").select(T.link_origin("url").alias("origin"))
    counted = origins.filter(F.col("origin").isNotNull()).groupBy("origin").agg(F.count("*").alias("n"))
    return counted.orderBy(F.col("n").desc(), "origin").limit(10)


@QUERIES.add("B13_word_pairs", f"""
    WITH t AS (SELECT lang, {Q.vectoriser_tokens('text')} AS t FROM documents),
    p AS (SELECT lang, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS pair FROM t)
    SELECT lang, pair, count(*) AS n FROM p GROUP BY ALL
""")
def word_pairs(spark, folder):
    words = documents(spark, folder).select("lang", F.explode(F.array(T.vectoriser_tokens("text"))).alias("w"))
    pairs = words.select("lang", F.explode(T.word_pairs(F.col("w"))).alias("pair"))
    return pairs.groupBy("lang", "pair").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- sentiment

SIMPLE_SQL = f"""len(list_filter(w, lambda x: x IN ({Q.quoted(S.POSITIVE)})))
              - len(list_filter(w, lambda x: x IN ({Q.quoted(S.NEGATIVE)})))"""
TEXTS_SQL = "SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations"
WORDS_SQL = f"SELECT id, text, {Q.split_words(Q.squeeze('lower(text)'))} AS w FROM ({TEXTS_SQL})"


def texts(spark, folder) -> DataFrame:
    docs = documents(spark, folder).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    turns = read_table(spark, folder, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"), "text"
    )
    return docs.unionByName(turns)


@QUERIES.add("C1_simple_score", f"SELECT id, {SIMPLE_SQL} AS score FROM ({WORDS_SQL})")
def simple_score(spark, folder):
    return texts(spark, folder).select("id", S.simple_score("text").alias("score"))


# Valences by word length, so that a lexicon covers every word of the tables.
LENGTHS_SQL = """SELECT id, CAST(sum(CASE WHEN length(x) % 7 <> 3 THEN length(x) % 7 - 3 END) AS DOUBLE) AS warm,
                 CAST(sum(CASE WHEN length(x) % 5 <> 2 THEN 2 - length(x) % 5 END) AS DOUBLE) AS cool
                 FROM (SELECT id, unnest(w) AS x FROM words) GROUP BY id"""
SCORES_SQL = f"""words AS ({WORDS_SQL}), s AS ({LENGTHS_SQL}),
    f AS (SELECT id, text, w, coalesce(warm, 0.0) AS warm, coalesce(cool, 0.0) AS cool FROM words LEFT JOIN s USING (id))"""


def _lexicons(df: DataFrame) -> dict[str, DataFrame]:
    words = df.select(F.explode(S.blank_split(F.lower("text"))).alias("word")).distinct()
    n = F.char_length("word")
    return {
        "warm": words.select("word", (n % 7 - 3).alias("valence")).filter("valence <> 0"),
        "cool": words.select("word", (2 - n % 5).alias("valence")).filter("valence <> 0"),
    }


@QUERIES.add("C2_lexicon_scores", f"WITH {SCORES_SQL} SELECT id, warm, cool FROM f")
def lexicon_scores(spark, folder):
    rows = texts(spark, folder)
    return S.lexicon_scores(rows, "id", "text", _lexicons(rows))


def _near_sql(column: str, weight: float) -> str:
    return (
        f"CASE WHEN {column} IN ({Q.quoted(S.BOOSTERS)}) THEN {weight * S.BOOST}::DOUBLE "
        f"WHEN {column} IN ({Q.quoted(S.DAMPENERS)}) THEN {-weight * S.BOOST}::DOUBLE ELSE 0 END"
    )


# The three words before each word by window; the lexicon is the first of _lexicons.
@QUERIES.add("C2_compare_scores", rf"""
    WITH words AS ({WORDS_SQL}),
    lex AS (SELECT DISTINCT x AS word, (length(x) % 7 - 3)::DOUBLE AS valence FROM (SELECT unnest(w) AS x FROM words) WHERE length(x) % 7 <> 3),
    raw AS (SELECT id, {Q.split_words(Q.squeeze('text'))} AS r, least(length(text) - length(replace(text, '!', '')), 4) AS bangs,
                   NOT (upper(text) = text AND lower(text) <> text) AS mixed FROM words),
    pos AS (SELECT id, unnest(r) AS x, generate_subscripts(r, 1) AS i, len(r) AS n, bangs, mixed FROM raw),
    bare AS (SELECT *, regexp_replace(x, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g') AS s FROM pos),
    near AS (SELECT *, lower(s) AS word, coalesce(lower(lag(s, 1) OVER o), '') AS b1, coalesce(lower(lag(s, 2) OVER o), '') AS b2,
                    coalesce(lower(lag(s, 3) OVER o), '') AS b3 FROM bare WINDOW o AS (PARTITION BY id ORDER BY i)),
    ctx AS (SELECT *, {' + '.join(_near_sql(f'b{k + 1}', w) for k, w in enumerate(S.DISTANCE))} AS boost,
                   {' OR '.join(f'b{k} IN ({Q.quoted(S.NEGATORS)})' for k in (1, 2, 3))} AS negated,
                   upper(s) = s AND lower(s) <> s AND mixed AS caps FROM near),
    hits AS (SELECT id, n, bangs, valence, (valence + sign(valence) * (CASE WHEN caps THEN {S.CAPS}::DOUBLE ELSE 0 END + boost))
                    * CASE WHEN negated THEN {S.NEGATION}::DOUBLE ELSE 1 END AS force FROM ctx JOIN lex USING (word)),
    sums AS (SELECT id, sum(force) AS total, avg(valence) AS polarity, sum(CASE WHEN force > 0 THEN force + 1 ELSE 0 END) AS up0,
                    sum(CASE WHEN force < 0 THEN 1 - force ELSE 0 END) AS down0, max(n) - count_if(force <> 0) AS flat,
                    max(bangs) * {S.EXCLAMATION}::DOUBLE AS extra FROM hits GROUP BY id),
    loud AS (SELECT *, total + sign(total) * extra AS whole, up0 + CASE WHEN up0 > down0 THEN extra ELSE 0 END AS up,
                    down0 + CASE WHEN up0 < down0 THEN extra ELSE 0 END AS down FROM sums)
    SELECT words.id, {SIMPLE_SQL} AS simple_score, round(coalesce(polarity, 0), 3) AS polarity,
           round(coalesce(whole / sqrt(whole * whole + {S.ALPHA}), 0), 3) AS compound, round(coalesce(up / nullif(up + down + flat, 0), 0), 3) AS positive,
           round(coalesce(down / nullif(up + down + flat, 0), 0), 3) AS negative,
           round(coalesce(flat / nullif(up + down + flat, 0), CASE WHEN len(w) = 0 THEN 0.0 ELSE 1.0 END), 3) AS neutral
    FROM words LEFT JOIN loud USING (id)
""")
def compare_scores(spark, folder):
    rows = texts(spark, folder)
    return S.compare_scores(rows, "id", "text", _lexicons(rows)["warm"])


@QUERIES.add("C3_disagreement_notes", f"""
    WITH {SCORES_SQL}, g AS (SELECT id, text, {SIMPLE_SQL} AS simple, warm / sqrt(warm * warm + 15) AS a,
                             cool / sqrt(cool * cool + 15) AS b FROM f)
    SELECT id, abs(a - b) > 0.3 AS substantial_difference,
           abs(a - b) > 0.3 AND (contains(text, '!!!') OR (upper(text) = text AND lower(text) <> text)) AS emphasis_likely,
           contains(lower(text), 'not') AND simple <> 0 AS negation_missed
    FROM g
""")
def disagreement_notes(spark, folder):
    rows = texts(spark, folder)
    scored = rows.join(S.lexicon_scores(rows, "id", "text", _lexicons(rows)), "id")
    bounded = [F.col(c) / F.sqrt(F.col(c) * F.col(c) + S.ALPHA) for c in ("warm", "cool")]
    return scored.select("id", *S.disagreement_notes(F.col("text"), S.simple_score("text"), *bounded))
