import base64
import gzip
import random
import subprocess
import zlib
from pathlib import Path

import pytest

from weftwork.llm import warc
from weftwork.session import new_folder

SCHEMA = "page_id long, url string, html string, sha string, body string, page string"


def pages(spark):
    noise = "".join(chr(33 + i * i % 90) for i in range(200_000))
    rows = [
        (5, "http://a/ b", "<p>é</p>"), (3, None, "<p>é</p>"), (9, "u", "<p>é</p>"), (4, "u", None), (2, "u", ""),
        (7, "u", "x" * (17 << 20)), (8, "u", noise), (6, "u\r\nInjected: 1", "line\r\n\r\nWARC/1.1\r\n"), (10, "u", "one"), (10, "u", "one"),
    ]
    return spark.createDataFrame([(*r, "s", "b", "p") for r in rows], SCHEMA)


def files_of(folder):
    return sorted(Path(folder.removeprefix("file:")).rglob("part-*"))


def test_round_trip(spark):
    folder = new_folder(spark, "warc")
    table = pages(spark)
    warc.write_archives(table, folder)
    rows = {r["record_id"]: r for r in warc.resolved(warc.read_records(spark, folder)).collect()}
    for page, _, html, *_ in table.collect():
        row = rows[warc.record_id(page)]
        body = (html or "").encode()
        assert bytes(row["payload"]) == body and row["payload_bytes"] == len(body)
        assert row["payload_digest"] == warc.digest(body)
    kinds = {k: (r["record_type"], r["refers_to"]) for k, r in rows.items()}
    revisit = lambda n: ("revisit", warc.record_id(n))
    assert kinds[warc.record_id(5)] == kinds[warc.record_id(9)] == revisit(3)
    assert kinds[warc.record_id(4)] == revisit(2) and kinds[warc.record_id(2)] == ("response", None)
    records = warc.read_records(spark, folder)
    assert records.count() == table.count()
    # Of the rows that repeat a key one is the response, the other revisits it.
    again = records.filter(records["record_id"] == warc.record_id(10)).collect()
    assert sorted((r["record_type"], r["refers_to"]) for r in again) == [("response", None), revisit(10)]


def test_archives_are_plain_gzip_with_one_member_per_record(spark):
    folder = new_folder(spark, "warc")
    warc.write_archives(pages(spark).coalesce(1), folder, archive_bytes=8 << 20)
    files = files_of(folder)
    assert len(files) > 1
    text = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 10
    assert sum(1 for f in files for one in warc.members(iter([f.read_bytes()])) if list(one)) == 10
    assert b"\r\nInjected" not in text


def test_payloads_below_the_least_size_are_all_responses(spark):
    folder = new_folder(spark, "warc")
    warc.write_archives(pages(spark), folder, least=5)
    kinds = {r["record_id"]: r["record_type"] for r in warc.read_records(spark, folder, with_payload=False).collect()}
    assert kinds[warc.record_id(4)] == "response" and kinds[warc.record_id(9)] == "revisit"


def test_reader_takes_any_chunks():
    records = [warc.record(i, "u", bytes([65 + i]) * (10**i), None) for i in range(6)]
    stored = b"".join(warc.member(r) + (b"\0" if i == 2 else b"") for i, r in enumerate(records))
    for size in (1, 7, 1000, len(stored)):
        chunks = (stored[i:i + size] for i in range(0, len(stored), size))
        found = [warc.payload_of(*warc.parse(one)) for one in warc.members(chunks)]
        assert found == [bytes([65 + i]) * (10**i) for i in range(6)]
    # A caller may skip a record.
    assert sum(1 for _ in warc.members(iter([stored]))) == 6


@pytest.mark.parametrize("spoil", [
    lambda r: r.replace(b"AAAA", b"AAAB", 1), lambda r: r[:-1], lambda r: r + b"x", lambda r: r.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 1),
    lambda r: r.replace(b"WARC/1.1", b"XARC/1.1"), lambda r: r[:40], lambda r: r.replace(b"WARC-Type:", b"WARC-Type"),
])
def test_broken_records_are_told(spoil):
    good = warc.record(1, "u", b"AAAA", None)
    assert spoil(good) != good
    with pytest.raises(warc.WarcError):
        for one in warc.members(iter([warc.member(spoil(good))])):
            warc.payload_of(*warc.parse(one))


def test_broken_members_are_told():
    stored = warc.member(warc.record(1, "u", b"AAAA", None))
    for bad in (stored[:-9], stored[:30] + bytes([stored[30] ^ 255]) + stored[31:], b"plain text"):
        with pytest.raises(warc.WarcError):
            for one in warc.members(iter([bad])):
                warc.parse(one)
    assert zlib.decompress(stored, 31).startswith(b"WARC/1.1")


def test_empty_table_and_missing_keys(spark):
    folder = new_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert warc.read_records(spark, folder).collect() == []
    folder = new_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame([(None, None, None, None, None, None), (None, "u", "abc", "", "", "")], SCHEMA), folder)
    rows = warc.resolved(warc.read_records(spark, folder)).collect()
    assert sorted(r["payload_bytes"] for r in rows) == [0, 3] and {r["record_type"] for r in rows} == {"response"}


def test_records_beyond_16_mib_and_skewed_sizes(spark):
    draw = random.Random(4)
    noise = lambda n: base64.b64encode(draw.randbytes(n)).decode()
    bodies = ["small one", noise(15 << 20), "small two", *(noise(1 << 20) for _ in range(6)), *(f"tiny {i}" for i in range(500))]
    table = spark.createDataFrame([(i, "u", b) for i, b in enumerate(bodies)], "page_id long, url string, html string").coalesce(1).sortWithinPartitions("page_id")
    folder = new_folder(spark, "warc")
    warc.write_archives(table, folder, archive_bytes=2 << 20)
    files = files_of(folder)
    # An archive ends once it holds two MiB, so it is larger by less than its last record.
    assert 3 <= len(files) <= 8 and not (Path(folder.removeprefix("file:")) / "_temporary").exists()
    for f in files:
        subprocess.run(["gzip", "-t", str(f)], check=True, capture_output=True)
    assert sum(gzip.decompress(f.read_bytes()).count(b"WARC/1.1\r\nWARC-Type: ") for f in files) == len(bodies)
    rows = {r["record_id"]: r for r in warc.read_records(spark, folder).collect()}
    assert all(bytes(rows[warc.record_id(i)]["payload"]) == b.encode() for i, b in enumerate(bodies))


def test_rows_that_repeat_the_smallest_key(spark):
    rows = [(3, "b", "x"), (3, "a", "x"), (3, "a", "x"), (3, None, "x"), (5, "c", "x"), (4, "d", "y"), (None, "e", "x")]
    folder = new_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    got = warc.read_records(spark, folder, with_payload=False).filter("record_id LIKE '<urn:page:%'").collect()
    of = lambda page: sorted(((r["record_type"], r["url"], r["refers_to"]) for r in got if r["record_id"] == warc.record_id(page)), key=str)
    third = warc.record_id(3)
    assert of(3) == [("response", "about:blank", None), *[("revisit", u, third) for u in ("a", "a", "b")]]
    assert of(5) == [("revisit", "c", third)] and of(4) == [("response", "d", None)]
