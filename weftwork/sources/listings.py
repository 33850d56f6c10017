"""Landed listing pages as post tables, stacked corpora, and reuse of stored snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LISTING_SCHEMA = """
    data struct<
        children: array<struct<data: struct<
            id: string, title: string, selftext: string, author: string, score: bigint,
            created_utc: double, num_comments: bigint, url: string>>>,
        after: string>
"""


def listing_posts(pages: DataFrame, order: list[str], listing: str = "data", limit: int | None = None,
                  corpus: list[str] | None = None) -> DataFrame:
    """(order, pos, the eight post fields); fields that a page lacks are NULL.

    With limit only the first posts in page order remain, per corpus if corpus columns are given.
    """
    keys = [*(corpus or []), *order]
    rows = pages.select(*keys, F.posexplode(f"{listing}.children").alias("pos", "_c"))
    posts = rows.filter(F.col("_c.data").isNotNull()).select(*keys, "pos", "_c.data.*")
    if limit is None:
        return posts
    if not corpus:
        return posts.orderBy(*order, "pos").limit(limit)
    window = Window.partitionBy(*corpus).orderBy(*order, "pos")
    return posts.withColumn("_at", F.row_number().over(window)).filter(F.col("_at") <= limit).drop("_at")


def load_listings(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Posts of page files, pages in the order of their names."""
    pages = spark.read.schema(LISTING_SCHEMA).json(path, multiLine=True)
    return listing_posts(pages.select(F.col("_metadata.file_name").alias("page"), "data"), ["page"], limit=limit)


def parse_listings(df: DataFrame, json: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Posts of listing pages held in a text column."""
    return listing_posts(
        df.select(*order, F.from_json(json, LISTING_SCHEMA).alias("_page")).select(*order, "_page.data"),
        order, limit=limit,
    )


def posts_table(posts: DataFrame) -> DataFrame:
    """(title, selftext, url, domain, time, author); a missing creation time counts as 0.

    A feed without a domain field gets the origin of the link.
    """
    from weftwork.functions.text import link_origin

    domain = F.col("domain") if "domain" in posts.columns else link_origin("url")
    return posts.select(
        "title", "selftext", "url", domain.alias("domain"),
        F.timestamp_seconds(F.coalesce("created_utc", F.lit(0.0))).alias("time"), "author",
    )


def stack(corpora: dict[str, DataFrame], column: str = "subreddit") -> DataFrame:
    """Several tables as one, each with its name; absent columns become NULL."""
    named = [df.withColumn(column, F.lit(name)) for name, df in corpora.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def fresh_snapshot(snapshots: DataFrame, keys: list[str], fetched_at: str, ttl_hours: float, now: Column) -> DataFrame:
    """(keys, fetched_at) of the latest stored result younger than the limit; other keys need a fetch.

    keys should hold everything that decides the result: corpus, sort and limit.
    """
    age = F.make_interval(secs=F.lit(ttl_hours * 3600.0))
    return snapshots.filter(F.col(fetched_at) > now - age).groupBy(*keys).agg(
        F.max(fetched_at).alias(fetched_at)
    )


def reuse_or_fetch(rows: DataFrame, snapshots: DataFrame, wanted: DataFrame, keys: list[str],
                   fetched_at: str, ttl_hours: float, now: Column) -> tuple[DataFrame, DataFrame]:
    """(stored rows that are still fresh, wanted keys that have none)."""
    fresh = fresh_snapshot(snapshots, keys, fetched_at, ttl_hours, now)
    return (
        rows.join(fresh, [*keys, fetched_at], "left_semi"),
        wanted.join(fresh, keys, "left_anti"),
    )
