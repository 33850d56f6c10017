"""SQL pieces shared by the side-by-side checks."""

from weftwork.functions.text import PUNCTUATION, TREEBANK_STEPS

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}"


def quoted(words) -> str:
    return ", ".join("'" + str(w).replace("'", "''") + "'" for w in words)


def squeeze(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{SPACE}]+', ' ', 'g'))"


def clean_light(text: str) -> str:
    return squeeze(f"regexp_replace(lower(coalesce({text}, '')), '[^{WORD}{SPACE}]', '', 'g')")


def clean_full(text: str) -> str:
    text = f"regexp_replace(lower(coalesce({text}, '')), 'http[^{SPACE}]+|www[^{SPACE}]+', '', 'g')"
    text = f"regexp_replace({text}, '[^{WORD}{SPACE}]', ' ', 'g')"
    return squeeze(rf"regexp_replace({text}, '\p{{Nd}}+', '', 'g')")


def split_words(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda w: w <> '')"


def treebank_tokens(text: str) -> str:
    text = f"concat(' ', {squeeze(f'coalesce({text}, {chr(39) * 2})')}, ' ')"
    for pattern, by in TREEBANK_STEPS:
        pattern, by = (part.replace("'", "''") for part in (pattern, by))
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return f"list_filter(regexp_split_to_array({text}, ' +'), lambda w: NOT regexp_full_match(w, '[{PUNCTUATION}]*'))"


def vectoriser_tokens(text: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '[^{WORD}]+'), "
        "lambda w: length(w) >= 2)"
    )


def counts(keys: str, source: str = "documents", text: str = "text", stop: str = "") -> str:
    """CTEs tok and c: words and their counts per document."""
    where = f" WHERE term NOT IN ({stop})" if stop else ""
    return (
        f"tok0 AS (SELECT {keys}, unnest({vectoriser_tokens(text)}) AS term FROM {source}), "
        f"tok AS (SELECT * FROM tok0{where}), "
        f"c0 AS (SELECT {keys}, term, count(*) AS tf FROM tok GROUP BY ALL), "
        f"c AS MATERIALIZED (SELECT *, sum(tf) OVER (PARTITION BY {keys}) AS n_tokens FROM c0)"
    )


# A report from rows of truth and prediction in the table named by source.
REPORT_SQL = """cf AS (SELECT truth, predicted, count(*) AS n FROM {source} GROUP BY ALL),
    lb AS (SELECT truth AS label FROM cf UNION SELECT predicted FROM cf),
    rt AS (SELECT label, coalesce((SELECT sum(n) FROM cf WHERE truth = label AND predicted = label), 0) AS hit,
                  coalesce((SELECT sum(n) FROM cf WHERE predicted = label), 0) AS claimed,
                  coalesce((SELECT sum(n) FROM cf WHERE truth = label), 0) AS support FROM lb),
    rr AS (SELECT label, coalesce(hit / nullif(claimed, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall,
                  coalesce(2 * hit / nullif(claimed + support, 0), 0) AS f1, support, hit FROM rt),
    al AS (SELECT label, precision, recall, f1, support FROM rr
           UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM rr
           UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM rr
           UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                            sum(f1 * support) / sum(support), sum(support) FROM rr)
    SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM al"""
