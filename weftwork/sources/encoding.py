"""Can bytes be read, or texts be written, in an encoding? And which characters occur?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.functions.text import code_point_escape

ENCODINGS = ("ascii", "latin-1", "utf-8")


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of whole files."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _known(encoding: str) -> None:
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")


def can_write(text: Column, encoding: str) -> Column:
    """Every character of the text exists in the encoding."""
    _known(encoding)
    highest = {"ascii": r"^[\x{00}-\x{7f}]*$", "latin-1": r"^[\x{00}-\x{ff}]*$"}.get(encoding)
    return F.lit(True) if highest is None else text.rlike(highest)


def can_read(content: Column, encoding: str) -> Column:
    """The bytes are valid in the encoding; latin-1 accepts any."""
    _known(encoding)
    if encoding == "utf-8":
        return F.is_valid_utf8(content.cast("string"))
    if encoding == "ascii":
        # Read as latin-1, one character per byte.
        return F.decode(content, "ISO-8859-1").rlike(r"^[\x{00}-\x{7f}]*$")
    return F.lit(True)


def _message(ok: Column, verb: str, encoding: str) -> Column:
    return F.when(ok, f"{verb} {encoding}").otherwise(f"not {verb} {encoding}")


def write_audit(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, encoding, ok, message) for every row and encoding."""
    cells = [
        F.struct(
            F.lit(e).alias("encoding"), can_write(F.col(text), e).alias("ok"),
            _message(can_write(F.col(text), e), "written as", e).alias("message"),
        )
        for e in ENCODINGS
    ]
    return df.select(*keys, F.inline(F.array(*cells)))


def read_audit(df: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """(keys, encoding, ok, message) for every file and encoding."""
    cells = [
        F.struct(
            F.lit(e).alias("encoding"), can_read(F.col(content), e).alias("ok"),
            _message(can_read(F.col(content), e), "read as", e).alias("message"),
        )
        for e in ENCODINGS
    ]
    return df.select(*keys, F.inline(F.array(*cells)))


def character_profile(df: DataFrame, text: str) -> DataFrame:
    """(ch, code_point, escape, n) of all characters in a column."""
    chars = df.select(F.explode(F.split(F.col(text), "")).alias("ch")).filter(F.col("ch") != "")
    return chars.groupBy("ch").agg(F.count("*").alias("n")).select(
        "ch", F.ascii("ch").alias("code_point"), code_point_escape(F.col("ch")).alias("escape"), "n"
    )
