"""Alignment of two tokenisers over the same bytes, composed from fragments of byte ranges.

A group ends wherever a token of A and a token of B end at the same byte. A byte range of a text yields a
fragment: an open prefix up to its first common end, the groups closed inside, and an open suffix. Fragments
compose associatively (the suffix of one and the prefix of the next close a group), so a very long text is
cut into ranges that separate tasks tokenise, and their fragments are reduced as a tree.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.llm.tables import arrow_schema, as_bytes, map_text
from weftwork.session import materialise

#: Bytes of a range, fragments that one task composes in a round, bytes of text that a task of the long texts
#: receives, and bytes of text that a task aligns at once.
RANGE, FAN, TASK_BYTES, AT_ONCE = 32 << 10, 8, 4 << 20, 1 << 20
#: Words whose tokens a task remembers, the longest of them, and characters that are tokenised in one go.
REMEMBERED, REMEMBERED_LENGTH, IN_ONE_GO = 250_000, 64, 32 << 10
#: A single space between two characters that are no white space. Both tokenisers begin a token there
#: and neither lets what stands before it influence what follows, so texts are tokenised word by word.
CUT = re.compile(r" (?<=\S )(?=\S)")
LINKS = "array<struct<a:int,b:int,times:int>>"


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def id_names(n: int) -> np.ndarray:
    """Ids below n as text, each followed by ',' (first row), '|' or ';'."""
    return np.array([[f"{i}{mark}" for i in range(n)] for mark in ",|;"], object)


class Tokenisers:
    """Both tokenisers, with the bytes of every token. A takes a text behind a space, B adds its own."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        alphabet, vocabulary = byte_alphabet(), self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in piece)
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.size_a, self.size_b = (np.array([len(x) for x in held], np.int64) for held in (self.bytes_a, self.bytes_b))
        self.names = id_names(max(len(self.bytes_a), len(self.bytes_b)))

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tokens of A and of B of every text behind a space; none if either does not give the bytes back."""
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        for text, a, b in zip(texts, ids_a, self.b.encode(texts, out_type=int, num_threads=1)):
            data = (" " + text).encode()
            same = b"".join([self.bytes_a[i] for i in a]) == data == b"".join([self.bytes_b[i] for i in b])
            yield np.array(a if same else [], np.int32), np.array(b if same else [], np.int32)


class Words:
    """Words by number with their tokens: word n has a[starts_a[n]:starts_a[n + 1]], and b alike.

    A word without tokens is one that a tokeniser does not give back.
    """

    def __init__(self, tokenisers: Tokenisers):
        self.tokenisers = tokenisers
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.a, self.b = np.empty(0, np.int32), np.empty(0, np.int32)
        self.starts_a, self.starts_b = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of the words, which hold until the next call. What is remembered is dropped beyond a bound."""
        if len(self.number) > REMEMBERED:
            self.forget()
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if new:
            self.learn(new)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        for long in [w for w in new if len(w) > REMEMBERED_LENGTH]:
            del self.number[long]
        return numbers

    def learn(self, new: list[str]) -> None:
        """Words that neither begin nor end with white space are tokenised many at a time, joined by spaces."""
        plain = [w for w in new if w and not w[0].isspace() and not w[-1].isspace()]
        odd = [] if len(plain) == len(new) else [w for w in new if not w or w[0].isspace() or w[-1].isspace()]
        bounds = np.cumsum([len(w) + 1 for w in plain]) // IN_ONE_GO if plain else np.empty(0, np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(bounds)) + 1).tolist(), len(plain)]
        groups = [plain[i:j] for i, j in zip(cuts, cuts[1:]) if j > i]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        names: list[str] = []
        for group, (a, b) in zip(groups, self.tokenisers.encode([" ".join(g) for g in groups])):
            ends = np.cumsum([len(w.encode()) + 1 for w in group])
            ends_a, ends_b = np.cumsum(self.tokenisers.size_a[a]), np.cumsum(self.tokenisers.size_b[b])
            if np.isin(ends, ends_a).all() and np.isin(ends, ends_b).all():
                names += group
                found.append((a, b, np.searchsorted(ends_a, ends) + 1, np.searchsorted(ends_b, ends) + 1))
            else:
                odd += group
        for start in range(0, len(odd), 1000):
            for word, (a, b) in zip(odd[start:start + 1000], self.tokenisers.encode(odd[start:start + 1000])):
                names.append(word)
                found.append((a, b, np.array([len(a)]), np.array([len(b)])))
        first = len(self.starts_a) - 1
        self.number.update((word, first + i) for i, word in enumerate(names))
        self.append(found)

    def append(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        for tokens, starts, ids, cuts in (("a", "starts_a", 0, 2), ("b", "starts_b", 1, 3)):
            first = len(getattr(self, tokens))
            before = np.cumsum([0, *[len(f[ids]) for f in found]])
            setattr(self, tokens, np.concatenate([getattr(self, tokens), *[f[ids] for f in found]]))
            setattr(self, starts, np.concatenate([getattr(self, starts), *[f[cuts] + n + first for f, n in zip(found, before)]]))

    def tokens(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of A and of B of the words in turn, and how many of each every word has."""
        out = []
        for flat, starts in ((self.a, self.starts_a), (self.b, self.starts_b)):
            sizes = starts[numbers + 1] - starts[numbers]
            shift = np.repeat(starts[numbers] - np.cumsum(sizes) + sizes, sizes)
            out += [flat[shift + np.arange(len(shift))], sizes]
        return out[0], out[2], out[1], out[3]


@dataclass
class Span:
    """Tokens of A and B as [id, bytes] whose group is not closed yet."""

    a: list[list[int]] = field(default_factory=list)
    b: list[list[int]] = field(default_factory=list)

    def __add__(self, other: Span) -> Span:
        return Span(self.a + other.a, self.b + other.b)


def close(span: Span) -> tuple[list[str], list[int]]:
    """Groups of a span that starts and ends at common ends, and a code (A id, B id) for every linked pair.

    Every step of the merge is one pair of overlapping tokens.
    """
    groups, links = [], []
    i = j = first_a = first_b = 0
    end_a, end_b = (span.a[0][1], span.b[0][1]) if span.a else (0, 0)
    while i < len(span.a):
        links.append(span.a[i][0] << 32 | span.b[j][0])
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a and step_b:
            ids = [",".join([str(t[0]) for t in part]) for part in (span.a[first_a:i + 1], span.b[first_b:j + 1])]
            groups.append("|".join(ids))
            first_a, first_b = i + 1, j + 1
        if step_a:
            i += 1
            end_a += span.a[i][1] if i < len(span.a) else 0
        if step_b:
            j += 1
            end_b += span.b[j][1] if j < len(span.b) else 0
    return groups, links


@dataclass
class Fragment:
    """What a byte range knows of its groups. Without a common end (tail None) all its tokens are in head."""

    head: Span = field(default_factory=Span)
    groups: list[str] = field(default_factory=list)
    n_groups: int = 0
    links: Counter = field(default_factory=Counter)
    tail: Span | None = None
    n_a: int = 0
    n_b: int = 0
    whole: bool = True

    def __add__(self, other: Fragment) -> Fragment:
        counts = {"n_a": self.n_a + other.n_a, "n_b": self.n_b + other.n_b, "whole": self.whole and other.whole}
        if self.tail is None:
            return Fragment(self.head + other.head, other.groups, other.n_groups, other.links, other.tail, **counts)
        if other.tail is None:
            return Fragment(self.head, self.groups, self.n_groups, self.links, self.tail + other.head, **counts)
        groups, links = close(self.tail + other.head)
        return Fragment(
            self.head, self.groups + groups + other.groups, self.n_groups + len(groups) + other.n_groups,
            self.links + Counter(links) + other.links, other.tail, **counts,
        )

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "head": self.head.__dict__, "tail": self.tail and self.tail.__dict__, "links": list(self.links.items())})

    @staticmethod
    def of_json(text: str) -> Fragment:
        held = json.loads(text)
        tail = Span(**held.pop("tail")) if held["tail"] else held.pop("tail")
        return Fragment(**{**held, "head": Span(**held["head"]), "tail": tail, "links": Counter(dict(held["links"]))})


#: The fragment of a range that starts at a common end: a text's own start.
START = Fragment(tail=Span())


_POWERS = 10 ** np.arange(1, 10)


class Aligned:
    """Tokens of A and B that cover the same bytes, laid out from byte 0: their groups and links.

    Every byte at which a token of either side ends closes the overlap of one token of A with one of B.
    """

    def __init__(self, tokenisers: Tokenisers, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        self.sizes_a, self.sizes_b = tokenisers.size_a[a], tokenisers.size_b[b]
        self.ends_a, self.ends_b = np.cumsum(self.sizes_a), np.cumsum(self.sizes_b)
        mark = np.zeros(int(self.ends_a[-1]) + 1 if len(a) else 1, np.uint8)
        mark[self.ends_a] = 1
        mark[self.ends_b] += 2
        self.ends = np.flatnonzero(mark)
        sides = mark[self.ends]
        # The token that covers an end is the one after all that end before it.
        at_a, at_b = (np.cumsum(sides & side > 0) - (sides & side > 0) for side in (1, 2))
        self.codes = a[at_a].astype(np.int64) << 32 | b[at_b]
        self.common = self.ends[sides == 3]
        self.write_groups(tokenisers.names)

    def write_groups(self, names: np.ndarray) -> None:
        """text holds all groups, each behind it ';'; group g begins at spots[g]."""
        up_a, up_b = np.searchsorted(self.ends_a, self.common) + 1, np.searchsorted(self.ends_b, self.common) + 1
        kinds, ids = np.zeros(len(self.a) + len(self.b), np.int64), np.zeros(len(self.a) + len(self.b), np.int64)
        # Of every group first the tokens of A, then those of B.
        group_a = np.repeat(np.arange(len(up_a)), np.diff(up_a, prepend=0))
        group_b = np.repeat(np.arange(len(up_b)), np.diff(up_b, prepend=0))
        place_a = np.arange(len(group_a)) + np.concatenate([[0], up_b])[group_a]
        place_b = np.arange(len(group_b)) + up_a[group_b]
        ids[place_a], ids[place_b] = self.a, self.b
        kinds[up_a + up_b - 1] = 2
        kinds[up_a - 1 + np.concatenate([[0], up_b[:-1]])] = 1
        self.text = "".join(names[kinds, ids].tolist())
        sizes = np.cumsum(np.searchsorted(_POWERS, ids, "right") + 2)
        self.spots = np.concatenate([[0], sizes[up_a + up_b - 1]]).astype(np.int64)

    def groups(self, after: int, to: int) -> tuple[str, int]:
        """The groups that end behind byte `after`, up to byte `to`, and their number."""
        i, j = np.searchsorted(self.common, [after, to], "right")
        return self.written(i, j), int(j - i)

    def written(self, first: int, behind: int) -> str:
        """The groups from `first` on, up to the one before `behind`."""
        return self.text[self.spots[first]:max(self.spots[first], self.spots[behind] - 1)]

    def links(self, after: int, to: int) -> np.ndarray:
        i, j = np.searchsorted(self.ends, [after, to], "right")
        return self.codes[i:j]

    def open(self, after: int, to: int) -> Span:
        """The tokens that end behind byte `after`, up to byte `to`."""
        parts = []
        for ids, sizes, ends in ((self.a, self.sizes_a, self.ends_a), (self.b, self.sizes_b, self.ends_b)):
            i, j = np.searchsorted(ends, [after, to], "right")
            parts.append([list(t) for t in zip(ids[i:j].tolist(), sizes[i:j].tolist())])
        return Span(*parts)

    def count(self, after: int, to: int) -> tuple[int, int]:
        """Tokens of A and of B that end there."""
        return tuple(int(np.diff(np.searchsorted(ends, [after, to], "right"))[0]) for ends in (self.ends_a, self.ends_b))

    def fragment(self, after: int, to: int, whole: bool = True) -> Fragment:
        """The fragment of a byte range; a token belongs to the range it ends in."""
        n_a, n_b = self.count(after, to)
        i, j = np.searchsorted(self.common, [after, to], "right")
        if i == j:
            return Fragment(self.open(after, to), n_a=n_a, n_b=n_b, whole=whole)
        first, last = int(self.common[i]), int(self.common[j - 1])
        text, n_groups = self.groups(first, last)
        codes, times = np.unique(self.links(first, last), return_counts=True)
        links = Counter(dict(zip(codes.tolist(), times.tolist())))
        return Fragment(self.open(after, first), [text] if text else [], n_groups, links, self.open(last, to), n_a, n_b, whole)


class Aligner:
    """Aligns texts, many at once."""

    def __init__(self, path_a: str, path_b: str):
        self.tokenisers = Tokenisers(path_a, path_b)
        self.words = Words(self.tokenisers)

    def laid_out(self, texts: list[str]) -> tuple[Aligned, np.ndarray, np.ndarray]:
        """All texts behind each other, the byte at which each ends, and whether its bytes came back."""
        split = [CUT.split(t) for t in texts]
        numbers = self.words.numbers([w for words in split for w in words])
        a, b, sizes_a, _ = self.words.tokens(numbers)
        cuts = np.cumsum([len(words) for words in split])
        aligned = Aligned(self.tokenisers, a, b)
        tokens_to = np.cumsum(sizes_a)[cuts - 1]
        ends = np.concatenate([[0], aligned.ends_a])[tokens_to]
        lost = np.concatenate([[0], np.cumsum(sizes_a == 0)])
        return aligned, ends, lost[cuts] == lost[np.concatenate([[0], cuts[:-1]])]

    def texts(self, texts: list[str]) -> Iterator[tuple[str, int, np.ndarray, int, int] | None]:
        """(groups, n_groups, link codes, n_a, n_b) per text; None where a tokeniser does not give the bytes back."""
        start, held = 0, 0
        for stop, text in enumerate(texts, 1):
            held += len(text)
            if held >= AT_ONCE or stop == len(texts):
                aligned, ends, whole = self.laid_out(texts[start:stop])
                bounds = np.concatenate([[0], ends])
                places = [aligned.common, aligned.ends, aligned.ends_a, aligned.ends_b]
                spots = np.column_stack([np.searchsorted(at, bounds, "right") for at in places]).tolist()
                for (g, c, a, b), (to_g, to_c, to_a, to_b), kept in zip(spots, spots[1:], whole.tolist()):
                    yield (aligned.written(g, to_g), to_g - g, aligned.codes[c:to_c], to_a - a, to_b - b) if kept else None
                start, held = stop, 0

    def fragments(self, at: int, text: str) -> Iterator[tuple[int, Fragment]]:
        """(start, fragment) for every byte range that the part of a text from byte `at` reaches into."""
        aligned, ends, whole = self.laid_out([text])
        last = int(ends[-1])
        bounds = [*range(RANGE - at % RANGE, last, RANGE), last]
        for after, to in zip([0, *bounds], bounds):
            made = aligned.fragment(after, to, bool(whole[0]))
            yield at + after, Fragment(tail=Span()) + made if after == 0 else made


def link_rows(codes: list[np.ndarray]) -> pa.Array:
    """One list of (a, b, times) per text, from the codes of its links."""
    sizes = np.array([len(c) for c in codes])
    text = np.repeat(np.arange(len(codes)), sizes)
    flat = np.concatenate([*codes, np.empty(0, np.int64)])
    # The ids are packed as tightly as they allow, so that one sort tells the distinct links of all texts.
    low = int((flat & 0xFFFFFFFF).max(initial=1)).bit_length()
    high = int((flat >> 32).max(initial=1)).bit_length()
    packed = (text << high | flat >> 32) << low | flat & 0xFFFFFFFF
    packed, times = np.unique(packed, return_counts=True)
    offsets = np.searchsorted(packed >> (high + low), np.arange(len(codes) + 1))
    pairs = pa.StructArray.from_arrays(
        [pa.array((packed >> low & (1 << high) - 1).astype(np.int32)), pa.array((packed & (1 << low) - 1).astype(np.int32)),
         pa.array(times.astype(np.int32))],
        names=["a", "b", "times"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pairs)


_NOTHING = ("", 0, np.empty(0, np.int64), 0, 0)


def short_alignments(docs: DataFrame, schema: str, path_a: str, path_b: str) -> DataFrame:
    """Alignments of docs(row, _key, _text), each text in one piece."""
    made: list[Aligner] = []

    def work(columns: list[list]) -> dict:
        made[:] = made or [Aligner(path_a, path_b)]
        rows, keys, raw = columns
        texts = [decoded(t) for t in raw]
        results = iter(made[0].texts([t for t in texts if t]))
        found = [(next(results) or _NOTHING) if t else _NOTHING for t in texts]
        groups, n_groups, codes, n_a, n_b = zip(*found)
        return {
            "row": rows, "_key": keys, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "groups": groups,
            "links": link_rows(list(codes)),
        }

    return map_text(docs, [F.col("row"), F.col("_key"), F.col("_text")], work, schema, AT_ONCE)


def decoded(data: bytes | None) -> str | None:
    """The text, or None for what is not UTF-8."""
    try:
        return as_bytes(data).decode()
    except UnicodeDecodeError:
        return None


def long_alignments(docs: DataFrame, schema: str, key_type: str, path_a: str, path_b: str) -> DataFrame:
    """The same for long texts: parts of a range each, fragments by range, and a tree of compositions."""
    def parts(columns: list[list]) -> dict:
        out = {"row": [], "_key": [], "at": [], "part": []}
        for row, key, data in zip(*columns):
            text, start, at = decoded(data), 0, 0
            # A text that is no UTF-8 is one empty part: it has no tokens.
            while text is None or start < len(text):
                cut = CUT.search(text, start + RANGE) if text else None
                piece = text[start:cut.start() if cut else len(text)] if text else None
                for name, value in zip(out, (row, key, at, piece)):
                    out[name].append(value)
                if not cut:
                    break
                at, start = at + 1 + len(piece.encode()), cut.end()
        return out

    cut = map_text(docs, [F.col("row"), F.col("_key"), F.col("_text")], parts, f"row long, _key {key_type}, at long, part string")
    cut = materialise(cut, "parts")
    # Only one number comes to the driver: the bytes of the long texts set the number of tasks.
    size = cut.agg(F.sum(F.octet_length("part"))).first()[0] or 0
    made: list[Aligner] = []

    def work(columns: list[list]) -> dict:
        made[:] = made or [Aligner(path_a, path_b)]
        out = {"row": [], "_key": [], "at": [], "fragment": []}
        for row, key, at, part in zip(*columns):
            pieces = made[0].fragments(at, part.decode()) if part else [(0, Fragment(whole=False))]
            for start, fragment in pieces:
                for name, value in zip(out, (row, key, start, fragment.to_json())):
                    out[name].append(value)
        return out

    columns = f"row long, _key {key_type}, at long, fragment string"
    dealt = cut.repartition(max(1, -(-size // TASK_BYTES)), "row", "at")
    level = materialise(map_text(dealt, [F.col("row"), F.col("_key"), F.col("at"), F.col("part")], work, columns, AT_ONCE), "fragments")

    def compose(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        first, *rest = rows["fragment"].to_pylist()
        whole = Fragment.of_json(first)
        for other in rest:
            whole = whole + Fragment.of_json(other)
        return rows.slice(0, 1).select(["row", "_key", "at"]).append_column("fragment", pa.array([whole.to_json()]))

    width, last = RANGE, level.agg(F.max("at")).first()[0] or 0
    while True:
        width *= FAN
        level = materialise(level.groupBy("row", F.floor(F.col("at") / width)).applyInArrow(compose, columns), "composed")
        if last < width:
            break
    target = arrow_schema(docs, schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = START + Fragment.of_json(row["fragment"]) + START
                links = held.links if held.whole else {}
                yield pa.RecordBatch.from_pylist([{
                    "row": row["row"], "_key": row["_key"], "n_a": held.n_a if held.whole else 0, "n_b": held.n_b if held.whole else 0,
                    "n_groups": held.n_groups if held.whole else 0, "groups": ";".join(held.groups) if held.whole else "",
                    "links": [{"a": c >> 32, "b": c & 0xFFFFFFFF, "times": n} for c, n in sorted(links.items())],
                }], schema=target)

    return level.mapInArrow(finish, schema)


def alignments(docs: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """row (an own number), key, n_a, n_b, n_groups, groups ('a1,a2|b1;...': ids in order), links
    (distinct linked pairs and how often they overlap) for every row of docs.

    Tokeniser A (a byte-level file of the tokenizers library) takes a space and the text, tokeniser B (a
    sentencepiece model that adds its own space) the text. A text that is NULL, empty or no UTF-8, or whose
    tokens do not give its bytes back, has none. Repeated rows are rows of their own; further columns are
    not read. Texts beyond RANGE bytes are cut into parts at spaces and composed from fragments; a stretch
    without any single space is tokenised in one task. Write the result before using it twice: row numbers
    follow the input's partitions.
    """
    key_type = docs.select(key).schema[0].dataType.simpleString()
    schema = f"row long, _key {key_type}, n_a long, n_b long, n_groups long, groups string, links {LINKS}"
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    fits = F.coalesce(F.octet_length("_text"), F.lit(0)) <= RANGE
    short = short_alignments(source.filter(fits), schema, path_a, path_b)
    # The two halves are written by separate scans: negative numbers keep their rows apart.
    long = long_alignments(source.filter(~fits).withColumn("row", -1 - F.col("row")), schema, key_type, path_a, path_b)
    return short.unionByName(long).withColumnRenamed("_key", key)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, docs (rows that hold the pair linked), best (whether no pair of the A id is held by more).

    aligned must be a written table. The window holds the pairs of one A id: B's vocabulary at most.
    """
    pairs = aligned.select(F.explode("links").alias("_l")).groupBy("_l.a", "_l.b").agg(F.count(F.lit(1)).alias("docs"))
    return pairs.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def link_scores(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """row, n_links, n_best (links whose pair is its A id's best), count_sum (of the pairs' docs) per row with links.

    Both tables must be written ones: pairs are broadcast if their file is small, else merged, and a pair
    that very many rows hold is split by AQE.
    """
    links = aligned.select("row", F.explode("links").alias("_l")).select("row", "_l.*")
    times = F.col("times").cast("long")
    return links.join(pairs, ["a", "b"]).groupBy("row").agg(
        F.sum(times).alias("n_links"), F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"),
        F.sum(times * F.col("docs")).alias("count_sum"),
    )
