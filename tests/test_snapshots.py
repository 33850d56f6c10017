"""The snapshot store: commits, reuse, failed writes, conflicts, compaction."""

import pytest
from pyspark.sql import functions as F

from weftwork.sources.snapshots import CommitConflict, SnapshotStore

SCHEMA = "corpus string, fetched_at timestamp_ntz, value int"


def at(hour):
    return F.lit(f"2024-01-01 {hour:02}:00:00").cast("timestamp_ntz")


def rows(spark, *values):
    table = spark.createDataFrame(list(values), "corpus string, hour int, value int")
    return table.select("corpus", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours="hour")).alias("fetched_at"), "value")


def held(df):
    return sorted(((r["corpus"], r["value"]) for r in df.collect()), key=str)


def test_commits_reuse_and_versions(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"), ["corpus"])
    assert store.latest() is None and store.versions() == []
    store.commit(rows(spark, ("a", 1, 1), ("a", 1, 2), ("b", 1, 3), (None, 1, 4)))
    store.commit(rows(spark, ("a", 5, 5), ("c", 5, 6)))
    assert store.versions() == [1, 2]
    assert held(store.latest()) == [("a", 5), ("b", 3), ("c", 6), (None, 4)]
    assert held(store.latest(1)) == [("a", 1), ("a", 2), ("b", 3), (None, 4)]
    asked = []

    def fetch(keys):
        asked.append(sorted(map(str, (r["corpus"] for r in keys.collect()))))
        return keys.select("corpus", at(8).alias("fetched_at"), F.lit(9).alias("value"))

    wanted = spark.createDataFrame([("a",), ("b",), ("d",), (None,), ("a",)], "corpus string")
    assert held(store.reuse_or_fill(wanted, fetch, 4, at(8))) == [("a", 5), ("b", 9), ("d", 9), (None, 9)]
    assert asked == [["None", "b", "d"]]
    assert held(store.reuse_or_fill(wanted, fetch, 4, at(8))) == [("a", 5), ("b", 9), ("d", 9), (None, 9)] and len(asked) == 1


def test_a_failed_write_leaves_the_old_version_readable(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"), ["corpus"])
    store.commit(rows(spark, ("a", 1, 1)))
    broken = rows(spark, ("a", 2, 0), ("b", 2, 1)).withColumn("value", F.expr("CASE WHEN value = 0 THEN raise_error('lost') ELSE value END"))
    with pytest.raises(Exception, match="lost"):
        store.commit(broken)
    assert store.versions() == [1] and held(store.latest()) == [("a", 1)]


def test_two_writers_of_one_version(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"), ["corpus"])
    store.commit(rows(spark, ("a", 1, 1)))
    with pytest.raises(CommitConflict):
        store._publish(1, ["data/other"])
    assert held(store.latest()) == [("a", 1)]
    assert not [p for p in (tmp_path / "store" / "manifests").iterdir() if "draft" in p.name and not p.name.endswith(".crc")]


def test_expiry_compaction_and_vacuum(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"), ["corpus"])
    with pytest.raises(ValueError):
        store.compact()
    store.commit(rows(spark, ("a", 1, 1), ("b", 2, 2)))
    store.commit(rows(spark, ("a", 6, 3)))
    before = store.folders()
    store.compact(oldest=at(3))
    assert held(store.latest()) == [("a", 3)] and held(store.latest(2)) == [("a", 3), ("b", 2)]
    assert store.vacuum() == sorted(before) and store.versions() == [3]
    assert held(store.latest()) == [("a", 3)] and store.vacuum() == []
