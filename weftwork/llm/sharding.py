"""Shards of bounded size by extendible hashing, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.session import materialise

#: Bits of the hash that come from the key, and further ones from the place of the row.
KEY_BITS, ROW_BITS = 40, 20
TOP = KEY_BITS + ROW_BITS
#: Bits that a directory reaches beyond those that even sizes would need.
SLACK = 4
_HASH, _SIZE = "_shard_hash", "_shard_size"


def row_hash(key: Column, row: Column) -> Column:
    """60 bits: 40 of the key's MD5, then 20 of the row's number.

    Rows with the same key differ only in the last bits, which are reached only where the rows of
    one key exceed a shard by themselves.
    """
    text = F.coalesce(key.cast("string"), F.lit("")).cast("binary")
    high = F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")
    low = F.xxhash64(row).bitwiseAND((1 << ROW_BITS) - 1)
    return F.shiftleft(high, ROW_BITS) + low


def _prefix(bits: Column | int) -> Column:
    return F.shiftright(F.col(_HASH), TOP - bits)


def directory(sizes: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """[(bits, table(prefix, depth, bytes))]: for every prefix of so many bits its shard's depth and size.

    The first table covers all rows; a later one only prefixes that still exceed the limit at the
    depth before (depth NULL there). A bucket is split on its next bit only if it exceeds the limit.
    """
    total = sizes.agg(F.coalesce(F.sum(_SIZE), F.lit(0))).first()[0]
    bits = min(TOP, max(1, math.ceil(math.log2(max(2, 2 * total / limit)))) + SLACK)
    shallow, levels = 0, []
    while True:
        fine = materialise(sizes.groupBy(_prefix(bits).alias("prefix")).agg(F.sum(_SIZE).alias("bytes")), "prefixes")
        # The size of every bucket of every depth from the level before to this one.
        buckets = fine.select(
            F.explode(F.sequence(F.lit(shallow), F.lit(bits))).alias("depth"), "prefix", "bytes"
        ).select("depth", F.expr(f"shiftright(prefix, {bits} - depth)").alias("bucket"), "bytes")
        buckets = materialise(buckets.groupBy("depth", "bucket").agg(F.sum("bytes").alias("bytes")), "buckets")
        # Sizes fall with depth: the shard of a prefix is its first bucket that fits. These tables grow
        # with the number of shards and take far more memory than their files, so they are merged.
        fits = buckets.filter((F.col("bytes") <= limit) | (F.col("depth") == TOP))
        of_prefix = fine.select("prefix", F.explode(F.sequence(F.lit(shallow), F.lit(bits))).alias("depth")).select(
            "prefix", "depth", F.expr(f"shiftright(prefix, {bits} - depth)").alias("bucket")
        ).join(fits.hint("merge"), ["depth", "bucket"])
        shards = of_prefix.groupBy("prefix").agg(F.min(F.struct("depth", "bytes")).alias("_s")).select(
            "prefix", F.col("_s.depth").alias("depth"), F.col("_s.bytes").alias("bytes")
        )
        table = materialise(fine.select("prefix").join(shards.hint("merge"), "prefix", "left"), "directory")
        levels.append((bits, table))
        over = table.filter(F.col("depth").isNull())
        if bits == TOP or over.isEmpty():
            return levels
        sizes = sizes.withColumn("prefix", _prefix(bits)).join(over.select("prefix"), "prefix", "left_semi").select(_HASH, _SIZE)
        shallow, bits = bits, min(TOP, bits + 8)


def shard(docs: DataFrame, key: str = "doc_id", size: Column | None = None, limit: int = 1 << 20) -> DataFrame:
    """All rows and columns of docs plus shard (its hash prefix in binary digits), shard_depth and
    shard_bytes.

    size defaults to the bytes of column text; a NULL text counts 0. Every shard fits the limit
    unless it holds one row that is larger by itself (or rows that agree in all 60 bits). NULL keys
    are one key; repeated rows are told apart by their place in the input, which must be a stored
    table. An empty table gives an empty result. Columns with these names are replaced.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") if size is None else size
    hashed = docs.drop("shard", "shard_depth", "shard_bytes").select(
        "*", row_hash(F.col(key), F.monotonically_increasing_id()).alias(_HASH), size.alias(_SIZE)
    )
    levels = directory(materialise(hashed.select(_HASH, _SIZE), "sizes"), limit)
    found, depth, held = hashed, F.lit(None), F.lit(None)
    for i, (bits, table) in enumerate(levels):
        entry = table.select(
            F.col("prefix").alias(f"_p{i}"), F.col("depth").alias(f"_d{i}"), F.col("bytes").alias(f"_b{i}")
        )
        found = found.withColumn(f"_p{i}", _prefix(bits)).join(entry, f"_p{i}", "left")
        depth, held = F.coalesce(depth, f"_d{i}"), F.coalesce(held, f"_b{i}")
    name = F.expr(f"substring(lpad(bin({_HASH}), {TOP}, '0'), 1, _depth)")
    return found.withColumn("_depth", depth.cast("int")).withColumn("_held", held).select(
        *docs.drop("shard", "shard_depth", "shard_bytes").columns, name.alias("shard"),
        F.col("_depth").alias("shard_depth"), F.col("_held").alias("shard_bytes"),
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One file per shard below folder/shard=...; the empty prefix of a single shard is named 'all'."""
    named = sharded.withColumn("shard", F.when(F.col("shard") == "", "all").otherwise(F.col("shard")))
    named.repartition("shard").write.partitionBy("shard").parquet(folder)
