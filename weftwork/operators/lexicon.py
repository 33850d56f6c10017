"""Word tables joined to text: stop words beyond a literal list, stems, lemmas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.functions.text import wordnet_class
from weftwork.session import materialise


def drop_listed(rows: DataFrame, word_list: DataFrame, term: str = "term") -> DataFrame:
    """Anti join with a word table of any size; all other occurrences stay."""
    return rows.join(word_list.select(F.col(word_list.columns[0]).alias(term)), term, "left_anti")


# The suffix rules of Porter (1980), steps 2 to 4, as (suffix, replacement).
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"),
)
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
)
#: Regular expressions over shapes (V and C per letter): measure above 0, above 1, exactly 1.
SOME, MANY, ONE = "V+C", "V+C+V+C", "^C*V+C+V*$"


def _shape(word: Column) -> Column:
    """V or C per letter; y is a vowel after a consonant."""
    marks = F.regexp_replace(F.translate(word, "aeiou", "VVVVV"), "[^Vy]", "C")
    marks = F.when(marks.startswith("y"), F.concat(F.lit("C"), F.substring(marks, 2, 1 << 30))).otherwise(marks)
    for _ in range(4):  # each turn settles two letters of a run of y
        marks = F.replace(F.replace(marks, F.lit("Cy"), F.lit("CV")), F.lit("Vy"), F.lit("VC"))
    return marks


def _without(word: Column, n: int | Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _short(word: Column) -> Column:
    """Consonant, vowel, consonant at the end, the last not w, x or y."""
    return _shape(word).endswith("CVC") & ~word.rlike("[wxy]$")


def _by_suffix(word: Column, rules: tuple[tuple[str, str], ...], measure: str, extra: Column | None = None) -> Column:
    """The longest suffix of the rules gives way to its replacement if the stem has the measure."""
    pattern = "^(.*?)(" + "|".join(a for a, _ in rules) + ")$"
    suffix, stem = F.regexp_extract(word, pattern, 2), F.regexp_extract(word, pattern, 1)
    allowed = _shape(stem).rlike(measure)
    if extra is not None:
        allowed = allowed & ((suffix != "ion") | stem.rlike("[st]$"))
    new = F.create_map(*[F.lit(x) for rule in rules for x in rule])
    return F.when((suffix != "") & allowed, F.concat(stem, F.try_element_at(new, suffix))).otherwise(word)


def stem_table(terms: DataFrame, term: str = "term") -> DataFrame:
    """(term, stem) by the published suffix rules, in column expressions.

    Every distinct word is stemmed once, however often it occurs. Words are expected in lower case;
    those of up to two letters stay.
    """
    words = terms.select(term).filter(F.col(term).isNotNull()).distinct()
    w = F.col("_w")
    steps = words.withColumn("_w", F.col(term))
    steps = steps.withColumn(
        "_w", F.when(w.rlike("(sses|ies)$"), _without(w, 2)).when(w.rlike("[^s]s$"), _without(w, 1)).otherwise(w)
    )
    cut = F.when(w.endswith("ed"), _without(w, 2)).when(w.endswith("ing"), _without(w, 3))
    steps = steps.withColumn("_cut", F.when(~w.endswith("eed") & _shape(cut).contains("V"), cut))
    c = F.col("_cut")
    tidy = (
        F.when(c.rlike("(at|bl|iz)$"), F.concat(c, F.lit("e")))
        .when(c.rlike(r"(.)\1$") & _shape(c).endswith("C") & ~c.rlike("[lsz]$"), _without(c, 1))
        .when(_shape(c).rlike(ONE) & _short(c), F.concat(c, F.lit("e")))
        .otherwise(c)
    )
    eed = F.when(_shape(_without(w, 3)).rlike(SOME), _without(w, 1)).otherwise(w)
    steps = steps.withColumn("_w", F.when(w.endswith("eed"), eed).when(c.isNotNull(), tidy).otherwise(w))
    steps = steps.withColumn(
        "_w", F.when(w.endswith("y") & _shape(_without(w, 1)).contains("V"), F.concat(_without(w, 1), F.lit("i"))).otherwise(w)
    )
    steps = steps.withColumn("_w", _by_suffix(w, STEP2, SOME)).withColumn("_w", _by_suffix(w, STEP3, SOME))
    steps = steps.withColumn("_w", _by_suffix(w, tuple((x, "") for x in STEP4), MANY, F.lit(True)))
    bare = _without(w, 1)
    drop_e = w.endswith("e") & (_shape(bare).rlike(MANY) | (_shape(bare).rlike(ONE) & ~_short(bare)))
    steps = steps.withColumn("_w", F.when(drop_e, bare).otherwise(w))
    steps = steps.withColumn("_w", F.when(w.endswith("ll") & _shape(w).rlike(MANY), _without(w, 1)).otherwise(w))
    return steps.select(term, F.when(F.length(term) <= 2, F.col(term)).otherwise(w).alias("stem"))


def lemmatise(rows: DataFrame, lexicon: DataFrame, term: str = "term", tag: Column | None = None) -> DataFrame:
    """Adds lemma from a (form, pos, lemma) table; a word not listed is its own lemma.

    Without a tag every word counts as a noun, with one the tag decides.
    """
    tagged = rows.withColumn("_pos", F.lit("n") if tag is None else wordnet_class(tag))
    forms = lexicon.select(
        F.col("form").alias(term), F.col("pos").alias("_pos"), F.col("lemma").alias("_lemma")
    )
    return (
        tagged.join(forms, [term, "_pos"], "left")
        .withColumn("lemma", F.coalesce("_lemma", F.col(term)))
        .drop("_lemma", "_pos")
    )


# The usual English endings of inflected forms by part of speech, and what stands in their place.
ENDINGS = {
    "n": (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")),
    "v": (("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")),
    "a": (("er", ""), ("est", ""), ("er", "e"), ("est", "e")),
    "r": (),
}


def rule_lexicon(words: DataFrame, lemmas: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """(form, pos, lemma) of words(form, pos), to be used by lemmatise(); a word without a lemma gives no row.

    An exception(form, pos, lemma) comes first. Otherwise the word itself and what its endings leave are
    candidates, and the shortest that lemmas(lemma, pos) knows is taken (then the first by name). Every
    distinct word is looked up once; no part of speech but n, v, a and r has endings. NULLs give no row.
    """
    words = materialise(words.select("form", "pos").dropna().distinct(), "words")
    form = F.col("form")
    made = F.array(form)
    for pos, endings in ENDINGS.items():
        cut = [
            F.when((F.col("pos") == pos) & form.endswith(end) & (F.length(form) > len(end)), F.concat(_without(form, len(end)), F.lit(new)))
            for end, new in endings
        ]
        made = F.concat(made, F.array(*cut)) if cut else made
    candidates = words.select("form", "pos", F.explode(F.array_distinct(F.array_compact(made))).alias("lemma"))
    known = candidates.join(lemmas.select("lemma", "pos").distinct(), ["lemma", "pos"], "left_semi")
    found = known.groupBy("form", "pos").agg(F.min(F.struct(F.length("lemma").alias("n"), "lemma")).alias("_l")).select("form", "pos", "_l.lemma")
    if exceptions is None:
        return found
    special = exceptions.groupBy("form", "pos").agg(F.min("lemma").alias("_special"))
    both = words.join(special, ["form", "pos"], "left").join(found, ["form", "pos"], "left")
    return both.select("form", "pos", F.coalesce("_special", "lemma").alias("lemma")).filter(F.col("lemma").isNotNull())
