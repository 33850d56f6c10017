"""The registered queries of this package, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftwork.llm import alignment, chat, decontamination, html, language_model, merkle, mixing, neighbours, quality, secrets, sharding, simhash, warc
from weftwork.llm.tables import fold
from weftwork.plans.registry import Registry
from weftwork.session import materialise, new_folder
from weftwork.sources.tables import read_table

QUERIES = Registry()

#: Production parameters of the queries.
DUPLICATE_DISTANCE, DUPLICATE_SHINGLE = 4, 4
MIX_SEED, MIX_EXPONENT = 17, 0.5
SHARD_BYTES = 1 << 20
QUERY_EVERY, NEAREST = 20, 20


@QUERIES.add("op1_quality_ranking")
def quality_ranking(spark, folder):
    return quality.quality_scores(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


# The given tables hold no judged findings, so the training folds are judged by rule: a value that is
# assigned to a secret's name and mixes letters with digits is a secret, all else is a false alarm.
@QUERIES.add("op2_secret_scan")
def secret_scan(spark, folder):
    findings = materialise(secrets.find_candidates(read_table(spark, folder, "documents"), path="source"), "findings")
    named = F.col("before").rlike(r"(?i)\b(token|password|passwd|secret|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?$")
    mixed = F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")
    labels = findings.filter(fold("doc_id") != 0).select("doc_id", "start", F.when(named & mixed, 1).otherwise(0).alias("secret"))
    return secrets.judged(findings, labels).select(
        "doc_id", "start", F.length("candidate").alias("length"), (fold("doc_id") == 0).alias("held_out"), "probability", "is_secret"
    )


# DuckDB has no base 32: the digits are cut from the binary digits of the SHA-1.
@QUERIES.add("op3_warc_archives", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    g AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM p),
    b AS (
        SELECT *, array_to_string(list_transform(range(0, 20), lambda i:
            lpad(bin(('0x' || substr(sha1(body), 1 + 2 * i::INTEGER, 2))::INTEGER), 8, '0')), '') AS bits FROM g
    )
    SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + list_sum(list_transform(range(0, 5), lambda j:
                   substr(bits, 1 + 5 * i::INTEGER + j::INTEGER, 1)::INTEGER * (16 >> j::INTEGER)))::INTEGER, 1)), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM b
""")
def warc_archives(spark, folder):
    archives = new_folder(spark, "archives")
    warc.write_archives(read_table(spark, folder, "pages"), archives)
    records = warc.resolved(warc.read_records(spark, archives, with_payload=False))
    return records.select(
        warc.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_number("refers_to").alias("refers_to"),
    )


@QUERIES.add("op4_lattice_scores")
def lattice_scores(spark, folder):
    return language_model.text_scores(read_table(spark, folder, "documents"))


@QUERIES.add("op5_simhash_near_dedup")
def simhash_near_dedup(spark, folder):
    found = simhash.near_duplicates(
        read_table(spark, folder, "documents"), shingle=DUPLICATE_SHINGLE, distance=DUPLICATE_DISTANCE
    )
    return found.selectExpr("doc_id", "lower(lpad(hex(code), 16, '0')) AS fingerprint", "component AS component_id")


@QUERIES.add("op7_spaced_seed_decontamination")
def spaced_seed_decontamination(spark, folder):
    return decontamination.contaminated(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )


@QUERIES.add("op6_visible_text")
def visible_text(spark, folder):
    return html.extract_text(read_table(spark, folder, "pages"))


# A copy count is the number of Poisson steps at or below the row's number; terms of the distribution
# are built from logarithms as in the operator.
@QUERIES.add("op8_poisson_mixing", f"""
    WITH held AS (SELECT source, count(*) AS n, pow(count(*), {MIX_EXPONENT}) AS weight FROM documents GROUP BY source),
    rates AS (
        SELECT source, weight / (SELECT sum(weight) FROM held) * (SELECT sum(n) FROM held) / n AS rate FROM held
    ),
    terms AS (
        SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
        FROM rates, (SELECT unnest(range(0, 200)) AS k)
    ),
    steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS reached FROM terms),
    draws AS (
        SELECT *, ('0x' || substr(md5('{MIX_SEED}|' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS draw FROM documents
    ),
    counted AS (
        SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(s.k) FILTER (s.reached <= d.draw) AS n
        FROM draws d JOIN steps s USING (source) GROUP BY ALL
    )
    SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy FROM counted WHERE n > 0
""")
def poisson_mixing(spark, folder):
    docs = read_table(spark, folder, "documents")
    return mixing.mix(docs, mixing.temperature_weights(docs, exponent=MIX_EXPONENT), seed=MIX_SEED)


# The shard of a row is the shortest prefix of its hash whose rows fit; 24 bits are more than any
# prefix needs unless one row exceeds the limit.
@QUERIES.add("op9_extendible_sharding", f"""
    WITH hashed AS (
        SELECT *, strlen(text) AS size,
               lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), 1, 10))::BIGINT), 40, '0') AS bits FROM documents
    ),
    depths AS (SELECT unnest(range(0, 25)) AS depth),
    buckets AS (
        SELECT depth, substr(bits, 1, depth) AS bucket, sum(size) AS bytes FROM hashed, depths GROUP BY ALL
    ),
    placed AS (
        SELECT h.*, b.depth, b.bucket, b.bytes,
               row_number() OVER (PARTITION BY h.doc_id ORDER BY b.depth) AS place
        FROM hashed h, depths d JOIN buckets b ON b.depth = d.depth AND b.bucket = substr(h.bits, 1, d.depth)
        WHERE b.bytes <= {SHARD_BYTES}
    )
    SELECT doc_id, text, lang, source, n_chars, bucket AS shard, CAST(depth AS INTEGER) AS shard_depth,
           CAST(bytes AS BIGINT) AS shard_bytes
    FROM placed WHERE place = 1
""")
def extendible_sharding(spark, folder):
    return sharding.shard(read_table(spark, folder, "documents"), limit=SHARD_BYTES)


@QUERIES.add("op10_one_bit_neighbours", f"""
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score,
               row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS place
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0
    )
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM scored WHERE place <= {NEAREST}
""")
def one_bit_neighbours(spark, folder):
    return neighbours.nearest(
        read_table(spark, folder, "embeddings"), lambda key: key % QUERY_EVERY == 0, top=NEAREST
    )


#: Tokeniser files that op11 aligns.
TOKENISER_A, TOKENISER_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


@QUERIES.add("op11_tokenizer_alignment")
def tokenizer_alignment(spark, folder):
    aligned = alignment.alignments(read_table(spark, folder, "documents"), "doc_id", "text", TOKENISER_A, TOKENISER_B)
    digest = F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256))
    aligned = materialise(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    scores = alignment.link_scores(aligned, materialise(alignment.pair_counts(aligned), "pairs"))
    sums = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return aligned.drop("links").join(scores, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", *sums, "groups_sha256")


#: A conversation whose texts hold the template's own control strings.
CONTROL_TEXT = f"{chat.END}{chat.START}assistant ok"


# The SQL writes each turn by the template and takes the digests from the plain texts.
@QUERIES.add("op12_chat_formatting", rf"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
    ),
    turns AS (
        SELECT *, concat('{chat.START}', regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g'), chr(10),
                         regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'), '{chat.END}', chr(10)) AS segment FROM rows
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, segment)) AS turns_sha256,
           coalesce(CAST(sum(length(text)) FILTER (role = 'assistant') AS BIGINT), 0) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, segment) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(segment)) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id
""")
def chat_formatting(spark, folder):
    rows = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], rows.schema)
    segments = chat.formatted(
        rows.unionByName(control), F.col("conv_id"), F.col("turn"), F.col("role"), chat.text_part(F.col("text"))
    )
    return chat.read_back(segments).withColumnRenamed("conversation", "conv_id")


def _leaf_sql(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    parts = ", ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}, '-')" for v in values)
    return f"sha256(concat({parts}))"


def _levels_sql(group: str) -> str:
    """The recursive part of a tree: every run of three nodes becomes one while several are left."""
    return f"""SELECT {group}, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
        FROM {{name}} WHERE n > 1 GROUP BY {group}, level, pos // 3, n"""


# DuckDB has no CRC-32: it is taken byte by byte, bit by bit. Both trees then grow level by level; a
# leaf's steps are the runs that it passes on its way up, in the tree of its source and that of the sources.
@QUERIES.add("op13_merkle_manifest", f"""
    WITH RECURSIVE given AS (
        SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) AS crc
        FROM documents
    ),
    hashed AS (
        SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
               {_leaf_sql("(CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS claimed FROM given
    ),
    placed AS MATERIALIZED (
        SELECT *, coalesce('1' || source, '') AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
               count(*) OVER (PARTITION BY source) AS n FROM hashed
    ),
    low AS (SELECT g, 0 AS level, pos, leaf AS h, n FROM placed UNION ALL {_levels_sql("g").format(name="low")}),
    subroots AS (SELECT g, h AS subroot, level AS height, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
    high AS (SELECT 0 AS one, 0 AS level, place AS pos, subroot AS h, n FROM subroots UNION ALL {_levels_sql("one").format(name="high")}),
    steps AS MATERIALIZED (
        SELECT p.g, p.pos AS leaf, l.level, l.pos, l.h, l.pos = p.pos // pow(3, l.level)::BIGINT AS own
        FROM placed p JOIN low l ON l.g = p.g AND l.n > 1 AND l.pos // 3 = p.pos // pow(3, l.level + 1)::BIGINT
        UNION ALL
        SELECT p.g, p.pos, s.height + u.level, u.pos, u.h, u.pos = s.place // pow(3, u.level)::BIGINT
        FROM placed p JOIN subroots s USING (g) JOIN high u ON u.n > 1 AND u.pos // 3 = s.place // pow(3, u.level + 1)::BIGINT
    ),
    proofs AS (SELECT g, leaf, sha256(string_agg(h, '' ORDER BY level, pos) FILTER (NOT own)) AS proof FROM steps GROUP BY ALL),
    folds AS (
        SELECT g, pos AS leaf, 0 AS level, claimed AS h FROM placed
        UNION ALL
        SELECT f.g, f.leaf, f.level + 1, sha256(string_agg(CASE WHEN s.own THEN f.h ELSE s.h END, '' ORDER BY s.pos))
        FROM folds f JOIN steps s USING (g, leaf, level) GROUP BY f.g, f.leaf, f.level
    ),
    ends AS (SELECT g, leaf, max_by(h, level) AS folded_root FROM folds GROUP BY ALL)
    SELECT p.doc_id, p.leaf, s.subroot, r.h AS root, coalesce(o.proof, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.h AS verified
    FROM placed p JOIN subroots s USING (g) JOIN ends e ON e.g = p.g AND e.leaf = p.pos
         LEFT JOIN proofs o ON o.g = p.g AND o.leaf = p.pos, (SELECT h FROM high WHERE n = 1) r
""")
def merkle_manifest(spark, folder):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    stored = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    found = merkle.manifest(
        read_table(spark, folder, "documents"), F.col("source"), [F.col("doc_id")], [*stored, F.col("text")],
        {"doc_id": F.col("doc_id"), "claimed": merkle.row_digest(*stored, text)},
    )
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"),
        merkle.fold(F.col("claimed"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
