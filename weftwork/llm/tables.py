"""What the operators of this package share: reading columns safely, folds and hash numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and bytes of text that a task's Python function holds at once (beyond one single row).
SLICE_ROWS, SLICE_BYTES = 2000, 16 << 20


def fold(key: str | Column, folds: int = 5) -> Column:
    """crc32 of the key as text, modulo the number of folds; a NULL key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def uniform(*parts: Column, seed: int = 0) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 over seed and parts joined by '|'."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def as_bytes(text: str | bytes | None) -> bytes:
    """UTF-8; NULL counts as empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""


def map_text(
    df: DataFrame, columns: list[Column], work: Callable[[list[list]], dict[str, list]], schema: str,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Give work() the columns as lists, a bounded slice of rows at a time; it returns columns of schema.

    The last of the columns is the text and comes as UTF-8 bytes. A slice ends after SLICE_ROWS rows or
    slice_bytes of text, so very long texts do not pile up in one worker.
    """
    source = df.select(*columns[:-1], columns[-1].cast("string").cast("binary").alias("_text"))
    target = arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held = 0, 0
            sizes = pa.compute.binary_length(batch.column(batch.num_columns - 1)).to_pylist()
            for i, size in enumerate(sizes):
                held += size or 0
                if held >= slice_bytes or i + 1 - start >= SLICE_ROWS or i + 1 == len(sizes):
                    part = batch.slice(start, i + 1 - start)
                    out = work([c.to_pylist() for c in part.columns])
                    yield pa.RecordBatch.from_pydict(out, schema=target)
                    start, held = i + 1, 0

    return source.mapInArrow(run, schema)


def arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
