import random

from pyspark.sql import functions as F

from weftwork.streaming.daily_counts import streaming_term_counts
from weftwork.streaming.reply_edges import reply_authors, streaming_reply_edges


def test_days_close_with_the_watermark(spark, tmp_path):
    schema = "at timestamp, text string"
    for i, rows in enumerate([
        [("2024-01-01 10:00:00", "cat dog cat"), ("2024-01-02 09:00:00", "dog")],
        [("2024-01-09 09:00:00", "cat")],
        [("2024-01-10 09:00:00", "cat")],
        [("2024-01-01 11:00:00", "cat"), ("2024-01-20 09:00:00", "bird")],
    ]):
        df = spark.createDataFrame(rows, "at string, text string").withColumn("at", F.col("at").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"part={i}"))
    posts = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "part=*"))
    query = (
        streaming_term_counts(posts.select("at", "text"), "at", F.split("text", " "), ["cat", "dog"])
        .writeStream.format("memory").queryName("daily").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    rows = {(str(r["date"]), r["term"]): r["n"] for r in spark.table("daily").collect()}
    # The last file's late row belongs to a closed day and is not counted again.
    assert rows[("2024-01-01", "cat")] == 2 and rows[("2024-01-01", "dog")] == 1 and rows[("2024-01-02", "dog")] == 1


def test_replies_meet_their_parents_in_any_order_of_arrival(spark, tmp_path):
    draw = random.Random(6)
    rows = []
    for i in range(200):
        parent = draw.randrange(i) if i and draw.random() < 0.8 else None
        post = f"p{rows[parent][2][1:]}" if parent is not None else f"p{draw.randrange(5)}"
        rows.append((f"c{i}", None if parent is None else f"c{parent}", post, draw.choice(["ann", "bob", None, "[deleted]"]), f"2024-01-01 {i // 60:02}:{i % 60:02}:00"))
    arrived = draw.sample(rows, len(rows))
    late = [("d0", None, "p0", "ann", "2024-06-01 00:00:00"), ("d1", "c0", rows[0][2], "bob", "2024-06-01 00:00:00")]
    batches = [arrived[:70], arrived[70:140], arrived[140:], late, [("d2", None, "p0", "ann", "2024-06-02 00:00:00")], [("d3", "c1", rows[1][2], "x", "2024-01-01 00:05:00")]]
    for i, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "comment_id string, parent_id string, post_id string, author string, at string")
        df.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
    schema = "comment_id string, parent_id string, post_id string, author string, at timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "part=*"))
    query = (
        streaming_reply_edges(stream.select(*[c.split()[0] for c in schema.split(", ")]), "at").writeStream.format("memory").queryName("replies")
        .outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination(240)
    by_id = {r[0]: r for r in rows}
    got = {(r["src"], r["dst"], r["parent_author"], r["author"]) for r in spark.table("replies").collect()}
    # The reply after five months, and the one that the watermark has passed, are not attached.
    assert got == {(r[1], r[0], by_id[r[1]][3], r[3]) for r in rows if r[1]}
    held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert max(held) > 150 and held[-1] <= 4  # what can meet no partner any more is gone
    pairs = reply_authors(spark.table("replies")).collect()
    assert len(pairs) == sum(1 for r in rows if r[1] and r[3] in ("ann", "bob") and by_id[r[1]][3] in ("ann", "bob"))
