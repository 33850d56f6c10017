"""Tokeniser alignment against whole texts encoded and compared token by token."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tests.llm import odd
from tokenizers import Tokenizer

from weftwork.llm import alignment, plans
from weftwork.session import materialise

A, B = plans.TOKENISER_A, plans.TOKENISER_B


@pytest.fixture(scope="module")
def coders():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


def shown_bytes():
    """Character to byte, as byte-level vocabularies define it."""
    table, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            table[chr(b)] = b
        else:
            table[chr(256 + n)] = b
            n += 1
    return table


def whole(text, coders, table=shown_bytes()):
    """(n_a, n_b, groups, links) of a text encoded in one piece."""
    if not text:
        return 0, 0, "", Counter()
    a = coders[0].encode(" " + text, add_special_tokens=False)
    data_a = [bytes(table[c] for c in t) for t in a.tokens]
    ids_b = coders[1].encode(text)
    pieces = [coders[1].id_to_piece(i) for i in ids_b]
    data_b = [bytes([int(p[3:5], 16)]) if p[:3] == "<0x" and len(p) == 6 else p.replace("▁", " ").encode() for p in pieces]
    if not b"".join(data_a) == b"".join(data_b) == (" " + text).encode():
        return 0, 0, "", Counter()
    ends_a, ends_b = list(accumulate(map(len, data_a))), list(accumulate(map(len, data_b)))
    groups = [[[], []] for _ in set(ends_a) & set(ends_b)]
    marks = sorted(set(ends_a) & set(ends_b))
    for side, (ids, ends) in enumerate(((a.ids, ends_a), (ids_b, ends_b))):
        g = 0
        for i, end in zip(ids, ends):
            while marks[g] < end:
                g += 1
            groups[g][side].append(str(i))
    links, j = Counter(), 0
    for i, end, data in zip(a.ids, ends_a, data_a):
        while ends_b[j] <= end - len(data):
            j += 1
        k = j
        while k < len(ends_b) and ends_b[k] - len(data_b[k]) < end:
            links[i, ids_b[k]] += 1
            k += 1
    return len(a.ids), len(ids_b), ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups), links


ODD = [
    "a", " lead", "trail ", "two  spaces", "\n\n", "tab\tx y", "<s> hi </s> <|endoftext|> x", "<0x41> <unk>", "a▁b", "x ▁y", "é ﬁ 日本語 𝒳 ø", " x   y",
    "a\x00b c", "don't can't 'll 's we've", "x" * 300, "日本語のテキスト" * 50, "1234567 89 \r\n z", "é ä", "﻿mark", "ÿ\x85 y\x1c z",
]


def as_row(r):
    return r["n_a"], r["n_b"], r["groups"], Counter({(x["a"], x["b"]): x["times"] for x in r["links"]})


@pytest.mark.parametrize("size", [7, 64, 32 << 10])
def test_texts_are_aligned_as_in_one_piece(spark, coders, size, monkeypatch):
    monkeypatch.setattr(alignment, "RANGE", size)
    draw = random.Random(size)
    texts = ODD + ["".join(draw.choice("ab  é\n'.,日▁<|\t") for _ in range(draw.randint(1, 80))) for _ in range(150)]
    texts += [" ".join(draw.choice(ODD) for _ in range(60)), "y" * 5000 + " tail", odd.words(3, 900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: as_row(r) for r in alignment.alignments(docs, "doc_id", "text", A, B).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert rows[i] == whole(text, coders), repr(text[:60])


class Sizes:
    """Tokenisers whose token n has n bytes."""

    size_a = size_b = np.arange(9)
    names = alignment.id_names(9)


def test_fragments_compose_associatively():
    draw = random.Random(1)
    for _ in range(200):
        sides = []
        for _ in range(2):
            ids, left = [], 40
            while left:
                ids.append(draw.randint(1, min(5, left)))
                left -= ids[-1]
            sides.append(np.array(ids))
        aligned = alignment.Aligned(Sizes, *sides)
        bounds = sorted(draw.sample(range(1, 40), 12))
        pieces = [aligned.fragment(i, j) for i, j in zip([0, *bounds], [*bounds, 40])]
        whole = aligned.fragment(0, 40)
        while len(pieces) > 1:
            i = draw.randrange(len(pieces) - 1)
            pieces[i:i + 2] = [alignment.Fragment.of_json((pieces[i] + pieces[i + 1]).to_json())]
        got, want = (alignment.START + f + alignment.START for f in (pieces[0], whole))
        assert ";".join(got.groups) == ";".join(want.groups) == aligned.groups(0, 40)[0]
        assert (got.links, got.n_a, got.n_b, got.n_groups) == (want.links, want.n_a, want.n_b, want.n_groups)
        groups, links = alignment.close(aligned.open(0, 40))
        assert ";".join(groups) == aligned.groups(0, 40)[0] and links == aligned.links(0, 40).tolist()


def test_counts_and_odd_rows(spark, coders):
    docs = odd.documents(spark)
    aligned = alignment.alignments(docs, "doc_id", "text", A, B)
    aligned = materialise(aligned)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = [(key, *whole(text, coders)) for key, text in texts]
    got = [(r["doc_id"], *as_row(r)) for r in aligned.collect()]
    plain = lambda rows: sorted((str(k), a, b, g, sorted(links.items())) for k, a, b, g, links in rows)
    assert plain(got) == plain(want)
    held, best = Counter(), defaultdict(int)
    for *_, links in want:
        held.update(links.keys())
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    pairs = {(r["a"], r["b"]): (r["docs"], r["best"]) for r in alignment.pair_counts(aligned).collect()}
    assert pairs == {p: (n, n == best[p[0]]) for p, n in held.items()}
    scores = alignment.link_scores(aligned, materialise(alignment.pair_counts(aligned))).drop("row")
    assert sorted(map(tuple, scores.collect())) == sorted(
        (sum(l.values()), sum(n for p, n in l.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in l.items())) for *_, l in want if l
    )
    empty = alignment.alignments(odd.empty(spark), "doc_id", "text", A, B)
    assert empty.collect() == [] and alignment.pair_counts(empty).collect() == []


def test_query_on_given_documents(spark, coders):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r.asDict() for r in plans.tokenizer_alignment(spark, folder).collect()}
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    found = {k: whole(t, coders) for k, t in texts.items()}
    held, best = Counter(), defaultdict(int)
    for *_, links in found.values():
        held.update(links.keys())
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    for key, (n_a, n_b, groups, links) in found.items():
        assert got[key] == {
            "doc_id": key, "n_a": n_a, "n_b": n_b, "n_groups": groups.count(";") + 1 if groups else 0, "n_links": sum(links.values()),
            "n_best": sum(n for p, n in links.items() if held[p] == best[p[0]]), "count_sum": sum(n * held[p] for p, n in links.items()),
            "groups_sha256": hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        }
    assert len(got) == len(texts)


def test_tasks_hold_little_at_once(spark, monkeypatch):
    made, held = alignment.Aligner(A, B), []
    laid_out = made.laid_out
    monkeypatch.setattr(made, "laid_out", lambda texts: held.append(sum(map(len, texts))) or laid_out(texts))
    texts = ["some words " * 1000] * 150
    assert len(list(made.texts(texts))) == 150 and sum(held) == 150 * len(texts[0])
    assert max(held) <= (1 << 20) + len(texts[0])
    # Fragments of long texts leave the task as they are made, too.
    slices, map_text = [], alignment.map_text
    monkeypatch.setattr(alignment, "map_text", lambda *given: slices.append(given[4:]) or map_text(*given))
    docs = spark.createDataFrame([(1, "some words " * 9000), (2, "short")], "doc_id long, text string")
    rows = {r["doc_id"]: r["n_a"] for r in alignment.alignments(docs, "doc_id", "text", A, B).collect()}
    assert rows[1] > 18000 and slices == [(alignment.AT_ONCE,), (), (alignment.AT_ONCE,)]
