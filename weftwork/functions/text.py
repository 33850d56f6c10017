"""Column expressions for cleaning and tokenising text. No shuffle, no Python workers."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode word and space classes, written so that Java and RE2 agree on them.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}"
PUNCTUATION = r"\x{21}-\x{2f}\x{3a}-\x{40}\x{5b}-\x{60}\x{7b}-\x{7e}"

# The usual English stop-word list of 179 words.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them their
    theirs themselves what which who whom this that that'll these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as until while of at
    by for with about against between into through during before after above below to from up down
    in out on off over under again further then once here there when where why how all any both
    each few more most other some such no nor not only own same so than too very s t can will just
    don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
    doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't
    needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# Joined forms that a Treebank tokeniser always takes apart.
SPLIT_FORMS = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}

#: Stands for a full stop that belongs to its word while a text is split.
KEPT_STOP = "\ue000"

# The conventions of Treebank tokens as rewriting steps over a text between blanks, in this order. Each
# pattern is replaced everywhere; \1 and \2 are its groups. Java and RE2 read the patterns alike.
TREEBANK_STEPS = (
    # Stops of short titles and forms, and those between single letters, belong to the word.
    (r"( (?:Mr|Mrs|Ms|Dr|Prof|St|Jr|Sr|vs|etc|e\.g|i\.e))\.", r"\1" + KEPT_STOP),
    (r"( [\p{L}])\.([\p{L}])\.", r"\1" + KEPT_STOP + r"\2" + KEPT_STOP),
    # Quotes that open, then dots, marks, brackets and dashes stand alone; colons and commas inside numbers do not.
    (r"([ (\[{<])\"", r"\1 `` "),
    (r"(\.\.\.)", r" \1 "),
    (r"([:,])([^0-9])", r" \1 \2"),
    (r"([;@#$%&?!\]\[(){}<>])", r" \1 "),
    (r"(--)", r" \1 "),
    # The stop at the end of a sentence: before a blank, behind a small letter, a digit or a bracket, or at the end.
    (r"([\p{Ll}\p{Nd})'])\.([\"']* )", r"\1 . \2"),
    (r"([^. ])\.([\"' ]*)$", r"\1 . \2"),
    # Quotes that close, possessives and contractions.
    (r"\"", r" '' "),
    (r"([^' ])('[sSmMdD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", r"\1 \2 "),
    (r"([^' ])(') ", r"\1 \2 "),
    # Joined forms; blanks are doubled so that neighbours do not share one.
    (r" ", r"  "),
    (r" ([Cc][Aa][Nn])([Nn][Oo][Tt]) ", r" \1 \2 "),
    (r" ([Dd])('[Yy][Ee]) ", r" \1 \2 "),
    (r" ([Gg][Ii][Mm]|[Ll][Ee][Mm])([Mm][Ee]) ", r" \1 \2 "),
    (r" ([Gg][Oo][Nn]|[Ww][Aa][Nn])([Nn][Aa]) ", r" \1 \2 "),
    (r" ([Gg][Oo][Tt])([Tt][Aa]) ", r" \1 \2 "),
    (r" ([Mm][Oo][Rr][Ee])('[Nn]) ", r" \1 \2 "),
    (r" ('[Tt])([Ii][Ss]|[Ww][Aa][Ss]) ", r" \1 \2 "),
    (KEPT_STOP, "."),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def plain(c: Column | str) -> Column:
    """NULL becomes the empty text."""
    return F.coalesce(_col(c), F.lit(""))


def squeeze(c: Column | str) -> Column:
    """Runs of white space become one blank, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), f"[{SPACE}]+", " "))


def clean_light(c: Column | str) -> Column:
    """Lower case without punctuation; punctuation leaves no gap behind."""
    return squeeze(F.regexp_replace(F.lower(plain(c)), f"[^{WORD}{SPACE}]", ""))


def clean_full(c: Column | str) -> Column:
    """Lower case without links, punctuation (which leaves a gap) and digits (which leave none)."""
    text = F.lower(plain(c))
    text = F.regexp_replace(text, f"http[^{SPACE}]+|www[^{SPACE}]+", "")
    text = F.regexp_replace(text, f"[^{WORD}{SPACE}]", " ")
    return squeeze(F.regexp_replace(text, r"\p{Nd}+", ""))


def split_words(c: Column | str) -> Column:
    """Pieces of an already squeezed text; the empty text has none."""
    return F.filter(F.split(_col(c), " "), lambda w: w != "")


def full_tokens(c: Column | str) -> Column:
    """Words of the fully cleaned text, joined forms taken apart."""
    def take_apart(word: Column) -> Column:
        parts = F.array(word)
        for form, pieces in SPLIT_FORMS.items():
            parts = F.when(word == form, F.array(*map(F.lit, pieces))).otherwise(parts)
        return parts

    return F.flatten(F.transform(split_words(clean_full(c)), take_apart))


def outer_stripped_tokens(c: Column | str) -> Column:
    """Split at every single blank, then lower case without punctuation at either end."""
    edge = f"^[{PUNCTUATION}]+|[{PUNCTUATION}]+$"
    return F.transform(F.split(plain(c), " "), lambda w: F.lower(F.regexp_replace(w, edge, "")))


def word_tokens(c: Column | str) -> Column:
    """Words with inner apostrophes, case kept; punctuation yields no token."""
    return F.regexp_extract_all(plain(c), F.lit(rf"[{WORD}]+(?:'\p{{L}}+)?"), F.lit(0))


def treebank_tokens(c: Column | str) -> Column:
    """Tokens by the conventions of the Penn Treebank, case kept: contractions and possessives are taken apart ("do n't",
    "John 's", "can not"), quotes and marks split off; tokens that are punctuation throughout are dropped.

    There is no sentence splitter before it: a stop behind a small letter, a digit or a bracket and before a blank ends a
    sentence, unless it belongs to a short title. NULL and empty texts have no tokens.
    """
    text = F.concat(F.lit(" "), squeeze(plain(c)), F.lit(" "))
    for pattern, by in TREEBANK_STEPS:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(re.sub(r"\\([12])", r"$\1", by)))
    return F.filter(F.split(text, " +"), lambda w: ~w.rlike(f"^[{PUNCTUATION}]*$"))


def simple_tokens(c: Column | str) -> Column:
    """Lower-case words after punctuation was deleted."""
    return split_words(clean_light(c))


def vectoriser_tokens(c: Column | str) -> Column:
    """Lower-case runs of two or more word characters.

    Splitting at the gaps gives the same runs as matching them, at less cost on long texts.
    """
    return longer_than(F.split(F.lower(plain(c)), f"[^{WORD}]+"), 1)


def without_stop_words(tokens: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """Drop stop words; every other occurrence stays, in order."""
    words = sorted(set(stop_words))
    return F.filter(tokens, lambda w: ~w.isin(words)) if words else tokens


def longer_than(tokens: Column, n: int) -> Column:
    return F.filter(tokens, lambda w: F.char_length(w) > n)


def word_pairs(tokens: Column, n: int = 2) -> Column:
    """n-grams of neighbouring words, joined by a blank."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def wordnet_class(tag: Column | str) -> Column:
    """Part-of-speech tag to word class: adjective, verb, noun or adverb; noun otherwise."""
    tag = _col(tag)
    return (
        F.when(tag.startswith("J"), "a")
        .when(tag.startswith("V"), "v")
        .when(tag.startswith("N"), "n")
        .when(tag.startswith("R"), "r")
        .otherwise("n")
    )


def joined_text(*parts: Column | str) -> Column:
    """Several text fields as one, NULL counting as empty."""
    return F.concat_ws(" ", *[plain(p) for p in parts])


def link_origin(url: Column | str) -> Column:
    """Scheme and host of a link, NULL if there is none."""
    return F.nullif(F.regexp_extract(_col(url), "(https?://[^/]+)", 1), F.lit(""))


def code_point_escape(ch: Column) -> Column:
    """\\uXXXX, or \\UXXXXXXXX beyond the basic plane."""
    code = F.ascii(ch)
    return F.when(code > 0xFFFF, F.format_string("\\U%08X", code)).otherwise(
        F.format_string("\\u%04X", code)
    )
