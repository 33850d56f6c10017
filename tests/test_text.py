import json

import pytest
from pyspark.sql import functions as F

from weftwork.functions import text as T
from weftwork.operators import lexicon as L
from weftwork.operators import sentiment as S
from weftwork.operators.cleaning import preprocess
from weftwork.sources import encoding, listings
from weftwork.sources.corpora import load_corpus
from weftwork.sources import threads
from weftwork.sources.threads import parse_comments


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("text, clean", [
    (None, ""), ("", ""), ("  A-b,  C! ", "ab c"), ("don't", "dont"), ("Été très_bon", "été très_bon"), ("日本語。", "日本語"),
])
def test_clean_light(spark, text, clean):
    assert one(spark, text, T.clean_light("t")) == clean


@pytest.mark.parametrize("text, clean", [
    ("See http://x.y/z?a=1 and www.q.r now", "see"),
    ("ab1c is 22 cats", "abc cats"),
    ("You cannot wanna go_on", "wan go_on"),
    ("the of and", ""), (None, ""),
])
def test_preprocess(spark, text, clean):
    df = spark.createDataFrame([(text,)], "t string")
    assert preprocess(df, "t").first()["clean"] == clean


def test_preprocess_with_lemmas(spark):
    df = spark.createDataFrame([(1, "cats running and cats"), (2, "the")], "id int, t string")
    lexicon = spark.createDataFrame([("cats", "n", "cat"), ("running", "v", "run")], "form string, pos string, lemma string")
    tags = spark.createDataFrame([("running", "VBG")], "term string, tag string")
    rows = {r["id"]: r["clean"] for r in preprocess(df, "t", lexicon=lexicon, doc="id", tags=tags).collect()}
    assert rows == {1: "cat run cat", 2: ""}
    plain = preprocess(df, "t", lexicon=lexicon, doc="id").filter("id = 1").first()["clean"]
    assert plain == "cat running cat"


def test_tokens(spark):
    assert one(spark, "“Can't” (stop) !", T.outer_stripped_tokens("t")) == ["“can't”", "stop", ""]
    assert one(spark, "Can't stop, x.", T.word_tokens("t")) == ["Can't", "stop", "x"]
    assert one(spark, "I am a_b C3PO é", T.vectoriser_tokens("t")) == ["am", "a_b", "c3po"]
    assert one(spark, "", T.vectoriser_tokens("t")) == []
    assert one(spark, "a b c", T.word_pairs(F.split("t", " "))) == ["a b", "b c"]
    assert one(spark, "a", T.word_pairs(F.split("t", " "))) == []
    assert len(set(T.ENGLISH_STOP_WORDS)) == 179


def test_links_tags_and_escapes(spark):
    assert one(spark, "https://a.b/c/d", T.link_origin("t")) == "https://a.b"
    assert one(spark, "nothing", T.link_origin("t")) is None
    assert [one(spark, t, T.wordnet_class("t")) for t in ("JJ", "VBD", "NN", "RB", "DT")] == ["a", "v", "n", "r", "n"]
    rows = encoding.character_profile(spark.createDataFrame([("a😂",)], "t string"), "t").collect()
    assert {(r["ch"], r["code_point"], r["escape"]) for r in rows} == {("a", 97, "\\u0061"), ("😂", 128514, "\\U0001F602")}


def test_encoding_audit(spark):
    rows = encoding.write_audit(spark.createDataFrame([("abc",), ("é",), ("日",)], "t string"), ["t"], "t").collect()
    ok = {(r["t"], r["encoding"]) for r in rows if r["ok"]}
    assert ok == {("abc", "ascii"), ("abc", "latin-1"), ("abc", "utf-8"), ("é", "latin-1"), ("é", "utf-8"), ("日", "utf-8")}


@pytest.mark.parametrize("word, stem", [
    ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"),
    ("motoring", "motor"), ("hopping", "hop"), ("filing", "file"), ("happy", "happi"), ("relational", "relat"),
    ("conditional", "condit"), ("generalization", "gener"), ("adjustment", "adjust"), ("adoption", "adopt"),
    ("controlling", "control"), ("sky", "sky"), ("probate", "probat"), ("rate", "rate"), ("running", "run"),
])
def test_porter_stem(spark, word, stem):
    assert L.stem_table(spark.createDataFrame([(word,)], "term string")).first()["stem"] == stem


def test_stem_table(spark):
    rows = L.stem_table(spark.createDataFrame([("cats",), ("cats",), ("cat",)], "term string")).collect()
    assert sorted((r["term"], r["stem"]) for r in rows) == [("cat", "cat"), ("cats", "cat")]


# Golden input for the sentiment scores.
TEXTS = [
    "This is a good and wonderful day!",
    "The movie was terrible and disappointing.",
    "The food was okay, nothing special.",
    "This is REALLY GREAT!!!",
    "The book was not bad at all.",
    "The service was good, but the food was terrible.",
]
SENTENCES = list(enumerate(TEXTS, 1))


def test_simple_score(spark):
    df = spark.createDataFrame(SENTENCES, "id int, t string")
    rows = {r["id"]: r["s"] for r in df.select("id", S.simple_score("t").alias("s")).collect()}
    # Words with punctuation attached do not count: "GREAT!!!", "disappointing.", "good,", "terrible."
    assert rows == {1: 2, 2: -1, 3: 0, 4: 0, 5: -1, 6: 0}


def test_rule_scores(spark):
    df = spark.createDataFrame(SENTENCES, "id int, t string")
    lexicon = spark.createDataFrame(
        [("good", 1.9), ("wonderful", 2.7), ("terrible", -2.1), ("great", 3.1), ("bad", -2.5)], "word string, valence double"
    )
    rows = {r["id"]: r for r in S.compare_scores(df, "id", "t", lexicon).collect()}
    assert rows[1]["compound"] == pytest.approx(4.892 / (4.892 ** 2 + 15) ** 0.5, abs=1e-3)
    assert rows[3]["compound"] == 0 and rows[3]["neutral"] == 1
    assert rows[5]["compound"] > 0 > rows[2]["compound"]
    plain = S.rule_scores(spark.createDataFrame([(4, "this is great")], "id int, t string"), "id", "t", lexicon).first()
    assert rows[4]["compound"] > plain["compound"]
    for r in rows.values():
        assert r["positive"] + r["negative"] + r["neutral"] == pytest.approx(1, abs=2e-3)


def test_corpus_and_listing_files(spark, tmp_path):
    corpus = tmp_path / "corpus.json"
    corpus.write_text(json.dumps({"documents": [["a cat", "pets"], ["a goal", "sports"]], "metadata": {"version": "1"}}, indent=1))
    rows = load_corpus(spark, str(corpus)).collect()
    assert [(r["doc_id"], r["text"], r["label"]) for r in rows] == [(0, "a cat", "pets"), (1, "a goal", "sports")]
    for i in range(2):
        page = {"data": {"children": [{"data": {"id": f"{i}{k}", "title": "t", "created_utc": 60.0}} for k in range(3)], "after": None}}
        (tmp_path / f"page{i}.json").write_text(json.dumps(page))
    posts = listings.load_listings(spark, str(tmp_path / "page*.json"), limit=4)
    assert sorted(r["id"] for r in posts.collect()) == ["00", "01", "02", "10"]
    row = listings.posts_table(posts).first()
    assert row["time"].timestamp() >= 0 and row["author"] is None


def test_snapshots(spark):
    rows = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00"), ("a", "2024-01-02 05:00:00"), ("b", "2024-01-01 00:00:00")], "corpus string, at string"
    ).withColumn("at", F.col("at").cast("timestamp"))
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "corpus string")
    stored, fetch = listings.reuse_or_fetch(rows, rows, wanted, ["corpus"], "at", 24, F.lit("2024-01-02 06:00:00").cast("timestamp"))
    assert [r["corpus"] for r in stored.collect()] == ["a"]
    assert sorted(r["corpus"] for r in fetch.collect()) == ["b", "c"]


def test_parse_comments(spark):
    def comment(i, replies=""):
        return {"kind": "t1", "data": {"id": f"c{i}", "author": f"a{i}", "body": f"b{i}", "replies": replies}}

    chain = comment(20)
    for i in range(19, 0, -1):
        children = [chain] + ([{"kind": "more", "data": {"id": "m"}}] if i == 3 else [])
        chain = comment(i, {"data": {"children": children}})
    answer = [{"data": {}}, {"data": {"children": [chain, comment(99), {"kind": "nothing"}]}}]
    df = spark.createDataFrame([("p", json.dumps(answer)), ("q", "[]")], "post string, json string")
    rows = parse_comments(df, "post", "json", response=True).orderBy("path").collect()
    assert len(rows) == 22
    by_id = {r["comment_id"]: r for r in rows}
    assert by_id["c1"]["parent_id"] is None and by_id["c20"]["parent_id"] == "c19" and by_id["m"]["parent_id"] == "c3"
    assert [r["comment_id"] for r in rows][:5] == ["c1", "c2", "c3", "c4", "c5"] and rows[-1]["comment_id"] == "c99"
    assert parse_comments(df, "post", "json", drop_stubs=True, response=True).count() == 21


def nested(depth):
    """A chain of replies, with a second reply at every seventh level."""
    text = '""'
    for level in range(depth, 0, -1):
        second = f', {{"data": {{"id": "s{level}", "author": "o", "body": "x"}}}}' if level % 7 == 0 else ""
        text = f'{{"data": {{"children": [{{"kind": "t1", "data": {{"id": "c{level}", "author": "a", "body": "b{level}", "replies": {text}}}}}{second}]}}}}'
    return text[len('{"data": {"children": '):-2]


def test_threads_of_any_depth_are_read_in_one_scan(spark):
    depth = 5000
    table = spark.createDataFrame([(1, nested(depth)), (2, nested(3)), (3, "[" * 9000), (4, None)], "p long, j string")
    rows = parse_comments(table, "p", "j").select("post_id", "comment_id", "parent_id", F.size("path").alias("level")).collect()
    chain = {r["comment_id"]: r for r in rows if r["post_id"] == 1}
    assert len(chain) == depth + depth // 7 and {r["post_id"] for r in rows} == {1, 2}
    for level in (1, 2, 700, 4999, 5000):
        assert chain[f"c{level}"]["parent_id"] == (f"c{level - 1}" if level > 1 else None) and chain[f"c{level}"]["level"] == level
    assert chain["s4900"]["parent_id"] == "c4899" and chain["s4900"]["level"] == 4900


@pytest.mark.parametrize("text", [
    "[]", "{}", ' [1, -2.5e3, true, null, "a\\u00e9\\n", {"k": [[], {}], "k2": {"a": []}}] ', '"x"', "5", "[1,]", "[,1]", "{,}", '{"a":1,}', '{"a" 1}',
    "[1 2]", "[1]]", "]", "", "[", '{"a"}', "nul", "[01]", "[1.]", '["\\x"]', '{"a":1 "b":2}', "[1],", '{1:2}', "[}", '["a\nb"]',
])
def test_deep_reader_agrees_with_the_plain_one(text):
    def outcome(reader):
        try:
            return reader(text)
        except ValueError:
            return "broken"

    assert outcome(threads._read_deep) == outcome(json.loads)


@pytest.mark.parametrize("text, tokens", [
    ("It was the best of times, it was the worst of times.", "It was the best of times it was the worst of times"),
    ("I don't think they've seen John's dog; it's here!", "I do n't think they 've seen John 's dog it 's here"),
    ("cannot CANNOT gonna gonna wanna lemme gimme gotta", "can not CAN NOT gon na gon na wan na lem me gim me got ta"),
    ("\'Tis more'n enough, 'twas said. d'ye know?", "'T is more 'n enough 't was said d 'ye know"),
    ("Mr. Smith paid $3,000.50 on the 3rd. He left the U.S. in 1999.", "Mr. Smith paid 3,000.50 on the 3rd He left the U.S. in 1999"),
    ('He said "stop it" (twice)... and left -- quickly: 10:30.', "He said stop it twice and left quickly 10:30"),
    ("the dogs' bowls, we'll, I'd, I'M, HE'S", "the dogs bowls we 'll I 'd I 'M HE 'S"),
    ("", ""), (None, ""), (" ,.!? ", ""), ("état n'est", "état n'est"),
])
def test_treebank_tokens(spark, text, tokens):
    assert one(spark, text, T.treebank_tokens("t")) == tokens.split()


def test_rule_lemmas(spark):
    lemmas = [("dog", "n"), ("box", "n"), ("leaf", "n"), ("woman", "n"), ("city", "n"), ("bus", "n"), ("bu", "v"), ("glass", "n"), ("make", "v"),
              ("run", "v"), ("carry", "v"), ("walk", "v"), ("go", "v"), ("fine", "a"), ("big", "a"), ("walking", "n"), ("e", "v")]
    forms = {("dogs", "n"): "dog", ("boxes", "n"): "box", ("leaves", "n"): "leaf", ("women", "n"): "woman", ("cities", "n"): "city",
             ("buses", "n"): "bus", ("bus", "n"): "bus", ("glass", "n"): "glass", ("making", "v"): "make", ("runs", "v"): "run", ("carries", "v"): "carry",
             ("walked", "v"): "walk", ("walking", "v"): "walk", ("walking", "n"): "walking", ("went", "v"): "go", ("finest", "a"): "fine",
             ("finer", "a"): "fine", ("dogs", "v"): None, ("ing", "v"): None, ("fast", "r"): None, ("dogs", "x"): None}
    words = spark.createDataFrame([*forms, ("dogs", "n"), (None, "n"), ("dogs", None)], "form string, pos string")
    exceptions = spark.createDataFrame([("went", "v", "go"), ("unused", "n", "x")], "form string, pos string, lemma string")
    table = L.rule_lexicon(words, spark.createDataFrame(lemmas, "lemma string, pos string"), exceptions)
    assert {(r["form"], r["pos"]): r["lemma"] for r in table.collect()} == {k: v for k, v in forms.items() if v}
    tagged = spark.createDataFrame([("walking", "VBG"), ("walking", "NN"), ("zebras", "NNS")], "term string, tag string")
    found = L.lemmatise(tagged, table, tag=F.col("tag"))
    assert {(r["term"], r["tag"]): r["lemma"] for r in found.collect()} == {("walking", "VBG"): "walk", ("walking", "NN"): "walking", ("zebras", "NNS"): "zebras"}


def test_word_kinds_are_found_once_per_word(spark):
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -3.0)], "word string, valence double")
    texts = spark.createDataFrame([(1, "Very GOOD, not so very bad"), (2, "barely good"), (3, "")], "id int, text string")
    scored = S.rule_scores(texts, "id", "text", lexicon)
    first = (2 + S.CAPS + S.BOOST) + (-3 - S.BOOST * (S.DISTANCE[0] + S.DISTANCE[1])) * S.NEGATION
    second = 2 - S.BOOST
    want = {1: round(first / (first**2 + S.ALPHA) ** 0.5, 3), 2: round(second / (second**2 + S.ALPHA) ** 0.5, 3), 3: 0.0}
    assert {r["id"]: r["compound"] for r in scored.collect()} == want
    # The list of boosters is searched in one place of the plan, not for each of the three words before a word.
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("extremely") == 1
