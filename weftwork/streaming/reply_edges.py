"""Reply networks over a stream of comments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.operators.graph import known_author


def streaming_reply_edges(comments: DataFrame, time: str, within: str = "30 days", lateness: str = "2 days") -> DataFrame:
    """(post_id, src, dst, parent_author, author, time) of replies, in whichever order they and their parents arrive.

    comments is a streaming table (comment_id, parent_id, post_id, author and an event time). Either side
    waits in the state until the other arrives; once the watermark has passed the time in which a partner
    could still come, it is dropped. A reply is attached if it was written at most `within` after its
    parent and neither came later than the watermark allows. Top comments hang on their post and give no row.
    """
    marked = comments.select("comment_id", "parent_id", "post_id", "author", F.col(time).alias("time"))
    replies = marked.filter(F.col("parent_id").isNotNull()).select(
        F.col("post_id"), F.col("parent_id").alias("src"), F.col("comment_id").alias("dst"), "author", "time"
    ).withWatermark("time", lateness)
    parents = marked.select(
        F.col("post_id").alias("_post"), F.col("comment_id").alias("_id"), F.col("author").alias("parent_author"), F.col("time").alias("_since")
    ).withWatermark("_since", lateness)
    near = (F.col("time") >= F.col("_since")) & (F.col("time") <= F.col("_since") + F.expr(f"INTERVAL {within}"))
    same = (F.col("post_id") == F.col("_post")) & (F.col("src") == F.col("_id"))
    return replies.join(parents, same & near).select("post_id", "src", "dst", "parent_author", "author", "time")


def reply_authors(edges: DataFrame) -> DataFrame:
    """(author, parent_author, time) of streaming_reply_edges between authors that are known."""
    return edges.filter(known_author("author") & known_author("parent_author")).select("author", "parent_author", "time")
