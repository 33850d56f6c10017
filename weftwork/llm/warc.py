"""WARC archives: one gzip member per record, written by tasks, committed by renaming, read back record by record."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.session import materialise

VERSION = b"WARC/1.1"
#: Stored bytes at which a task begins the next archive, and bytes that are decompressed in one step.
ARCHIVE_BYTES, STEP = 32 << 20, 64 << 10
#: Records carry one fixed date unless the caller gives one, so that archives are reproducible.
DATE = "2024-01-01T00:00:00Z"
LEVEL = 5


class WarcError(ValueError):
    """A record that breaks the format or does not match its digest."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(number: int) -> str:
    """The record's name; the page's number can be read from it."""
    return f"<urn:page:{number}>"


# ---------------------------------------------------------------- writing

def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A response record, or a revisit without payload where it refers to another page."""
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = status if refers_to is not None else status + payload
    name = record_id(page) if page is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest(payload))}>"
    target = re.sub(r"[\x00-\x20\x7f]+", "%20", url or "about:blank")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name),
        ("WARC-Date", date), ("WARC-Target-URI", target),
        ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields[3:3] = [
            ("WARC-Refers-To", record_id(refers_to)),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, in a task as well as on the driver."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
    least: int = 0, archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write a record per row of pages into archives below folder, a folder that every task can write to.

    Of rows with equal payloads of at least so many bytes that with the smallest key is the response
    and the others revisit it; of rows that repeat the smallest key one is the response. Rows without a
    key are responses. NULL html is an empty payload; further columns are not read; a payload of any
    length is one record, and a task begins the next archive once one holds archive_bytes. An empty
    table writes no archive. Digests are compared first, so payloads are moved only if the list of
    repeated digests does not fit into a broadcast.

    Every attempt of a task writes files of its own below _temporary; what successful tasks report is
    then renamed, so lost or repeated tasks leave no archive behind.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    named = pages.select(F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"), body.alias("body"))
    sizes = named.select("page", F.sha1("body").alias("sha"), F.length("body").cast("long").alias("size"))
    per_page = sizes.groupBy("sha", "page").agg(F.max("size").alias("size"), F.count("*").alias("n"))
    firsts = per_page.groupBy("sha").agg(
        F.min_by("page", F.coalesce("page", F.lit(2**63 - 1))).alias("first"), F.max("size").alias("size"), F.sum("n").alias("n"),
        F.min_by("n", F.coalesce("page", F.lit(2**63 - 1))).alias("n_first"),
    ).filter((F.col("n") > 1) & (F.col("size") >= least) & F.col("first").isNotNull())
    shared = materialise(firsts.select(F.col("sha").alias("_sha"), "first", "n_first"), "shared_digests")
    found = named.withColumn("sha", F.sha1("body")).join(shared, F.col("sha") == F.col("_sha"), "left")
    own = F.col("first") == F.col("page")
    again = own & (F.col("n_first") > 1)
    records = found.filter(~F.coalesce(again, F.lit(False))).select(
        "page", "url", F.when(F.col("first") < F.col("page"), F.col("first")).alias("refers_to"), "body"
    )
    if not shared.filter("n_first > 1").isEmpty():
        # Rows that repeat a response's key: equal ones are counted, the first by address is the response.
        equal = found.filter(again).groupBy("page", "url", "sha").agg(F.count("*").alias("n"), F.first("body").alias("body"))
        equal = materialise(equal, "repeated")
        lead = equal.groupBy("page", "sha").agg(F.min(F.struct(F.col("url").isNotNull().alias("named"), "url")).alias("lead"))
        equal = equal.join(lead, ["page", "sha"]).withColumn(
            "is_lead", F.col("url").eqNullSafe(F.col("lead.url"))
        )
        revisits = equal.withColumn("n", F.col("n") - F.col("is_lead").cast("int")).filter("n > 0").select(
            "page", "url", F.col("page").alias("refers_to"), "body", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("_i")
        ).drop("_i")
        responses = equal.filter("is_lead").select("page", "url", F.lit(None).cast("long").alias("refers_to"), "body")
        records = records.unionByName(responses).unionByName(revisits)
    files, path = _open(folder)
    files.create_dir(f"{path}/_temporary", recursive=True)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(folder)
        attempt, names, out = uuid.uuid4().hex, [], None
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page", "url", "body", "refers_to"))):
                if out is None or out.tell() >= archive_bytes:
                    if out is not None:
                        out.close()
                    names.append(f"{attempt}-{len(names):05}.warc.gz")
                    out = files.open_output_stream(f"{path}/_temporary/{names[-1]}", compression=None)
                out.write(member(record(*(value.as_py() for value in row))))
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    written = materialise(records.select("page", "url", "body", "refers_to").mapInArrow(pack, "name string"), "archive_names")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                # A repeated task finds that its file has already been moved.
                if files.get_file_info(f"{path}/_temporary/{name}").type != fs.FileType.NotFound:
                    files.move(f"{path}/_temporary/{name}", f"{path}/part-{name}")
            yield batch

    written.mapInArrow(commit, "name string").write.format("noop").mode("overwrite").save()
    files.delete_dir(f"{path}/_temporary")


# ---------------------------------------------------------------- reading

def members(chunks: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream in order, each as pieces of at most STEP decompressed bytes."""
    rest = b""

    def pieces(first: bytes) -> Iterator[bytes]:
        nonlocal rest
        unpack, data = zlib.decompressobj(31), first
        while True:
            try:
                out = unpack.decompress(data, STEP)
            except zlib.error as error:
                raise WarcError(f"broken gzip member: {error}") from error
            if out:
                yield out
            if unpack.eof:
                rest = unpack.unused_data
                return
            data = unpack.unconsumed_tail or next(chunks, b"")
            if not data and not out:
                raise WarcError("archive ends inside a gzip member")

    while True:
        rest = rest.lstrip(b"\0")  # padding between members
        while not rest:
            rest = next(chunks, None)
            if rest is None:
                return
            rest = rest.lstrip(b"\0")
        one = pieces(rest)
        yield one
        for _ in one:  # what the caller left unread
            pass


def parse(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """(fields in lower case, block) of a record: the header up to an empty line, then content-length
    bytes, then two line ends; the block must match its digest."""
    data = bytearray()
    while (cut := data.find(b"\r\n\r\n")) < 0:
        piece = next(pieces, None)
        if piece is None:
            raise WarcError("record ends inside its header")
        data += piece
    lines = bytes(data[:cut]).split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise WarcError("not a WARC record")
    fields: dict[str, str] = {}
    last = ""
    for line in lines[1:]:
        if line[:1] in b" \t" and last:  # a folded line goes on with the field before
            fields[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError("header line without a colon")
        last = name.strip().decode("utf-8", "replace").lower()
        fields[last] = value.strip().decode("utf-8", "replace")
    del data[:cut + 4]
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError) as error:
        raise WarcError("record without a content length") from error
    for piece in pieces:
        data += piece
    if len(data) != length + 4 or data[length:] != b"\r\n\r\n":
        raise WarcError(f"content length {length} does not fit the record")
    block = bytes(data[:length])
    _verify(fields.get("warc-block-digest"), block, "block")
    return fields, block


def _verify(named: str | None, data: bytes, what: str) -> None:
    if named is None:
        return
    kind, _, value = named.partition(":")
    if kind.lower() == "sha1" and value.upper() != digest(data):
        raise WarcError(f"{what} digest does not match")


def payload_of(fields: dict[str, str], block: bytes) -> bytes | None:
    """The body behind the HTTP header of a response, checked against its digest; None for a revisit."""
    if fields.get("warc-type") == "revisit":
        return None
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    _verify(fields.get("warc-payload-digest"), block, "payload")
    return block


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """(record_id, record_type, url, date, refers_to, payload_digest, payload_bytes, payload) of all records
    of all archives below folder, each archive read from front to back by one task.

    Memory holds a step of stored and of decompressed data and one record. payload and its
    length are NULL for revisits, payload also without with_payload. A broken record raises WarcError.
    """
    # Only names and lengths are listed; the task opens the file itself.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder)
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("date", pa.string()),
        ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
    ])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, path = _open(name)
                for one in members(iter(partial(files.open_input_stream(path, compression=None).read, STEP), b"")):
                    fields, block = parse(one)
                    body = payload_of(fields, block)
                    rows.append({
                        "record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type"),
                        "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
                        "refers_to": fields.get("warc-refers-to"),
                        "payload_digest": (fields.get("warc-payload-digest") or "").partition(":")[2].upper() or None,
                        "payload_bytes": None if body is None else len(body), "payload": body if with_payload else None,
                    })
                    held += len(body or b"") if with_payload else 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("path").mapInArrow(
        unpack,
        "record_id string, record_type string, url string, date string, refers_to string, payload_digest string, "
        "payload_bytes long, payload binary",
    )


def resolved(records: DataFrame) -> DataFrame:
    """Records with the payload length (and payload, where read) of the response that a revisit refers to.

    A revisit whose digest is not that of the response keeps NULL there. Both sides are written first,
    so a response that very many revisits refer to can be split.
    """
    records = materialise(records, "records")
    revisits = records.filter(F.col("record_type") == "revisit").drop("payload", "payload_bytes")
    targets = records.filter(F.col("record_type") == "response").dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_to"), F.col("payload_digest").alias("_digest"), "payload_bytes", "payload"
    )
    wanted = materialise(revisits.select("refers_to").distinct(), "targets")
    targets = materialise(targets.join(wanted, "refers_to", "left_semi"), "responses")
    same = F.col("payload_digest") == F.col("_digest")
    full = revisits.join(targets, "refers_to", "left").withColumns({
        "payload_bytes": F.when(same, F.col("payload_bytes")), "payload": F.when(same, F.col("payload")),
    })
    columns = records.columns
    return records.filter(F.col("record_type") != "revisit").select(*columns).unionByName(full.select(*columns))


def page_number(name: str | Column) -> Column:
    return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
