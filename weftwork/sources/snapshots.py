"""A store of fetched results: commits that appear at once, reuse or refill per key, expiry and compaction.

A commit writes a data folder and then a manifest that lists all folders of the new version. The manifest is
renamed into place, so a reader sees the old version or the new one, and a failed write changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.session import file_system
from weftwork.sources.listings import fresh_snapshot


class CommitConflict(RuntimeError):
    """Another writer has committed the version first."""


class SnapshotStore:
    """Rows with key columns and the time at which they were fetched, below one folder.

    All commits hold the same columns. The newest rows of a key count: those with its latest time over
    all commits; older ones stay readable in older versions until vacuum(). NULL is a key like any other.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], fetched_at: str = "fetched_at"):
        self.spark, self.folder, self.keys, self.fetched_at = spark, folder.rstrip("/"), keys, fetched_at

    # ------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        files, path = file_system(self.spark, f"{self.folder}/manifests")
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(int(name[1:-5]) for name in names if name.startswith("v") and name.endswith(".json"))

    def folders(self, version: int | None = None) -> list[str]:
        """Data folders of a version, by default the last one."""
        known = self.versions()
        if not known:
            return []
        text = self.spark.read.text(f"{self.folder}/manifests/v{known[-1] if version is None else version}.json", wholetext=True)
        return json.loads(text.first()[0])["folders"]

    def _publish(self, version: int, folders: list[str]) -> int:
        """Write the manifest beside its place and rename it; fails if the version exists by then."""
        files, target = file_system(self.spark, f"{self.folder}/manifests/v{version}.json")
        files.mkdirs(target.getParent())
        _, draft = file_system(self.spark, f"{self.folder}/manifests/.draft-{uuid.uuid4().hex}")
        out = files.create(draft)
        try:
            out.write(json.dumps({"version": version, "folders": folders}).encode())
        finally:
            out.close()
        if files.exists(target) or not files.rename(draft, target):
            files.delete(draft, False)
            raise CommitConflict(f"version {version} exists")
        return version

    def _write(self, rows: DataFrame) -> str:
        name = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{name}")
        return name

    def commit(self, rows: DataFrame) -> int:
        """Add rows as a new version and return its number; nothing is visible before all of it is written."""
        version = max(self.versions(), default=0)
        held = self.folders(version) if version else []
        return self._publish(version + 1, [*held, self._write(rows)])

    # ------------------------------------------------------------ reading

    def stored(self, version: int | None = None) -> DataFrame | None:
        """All rows of a version, superseded ones too; None without a commit."""
        folders = self.folders(version)
        return self.spark.read.parquet(*[f"{self.folder}/{name}" for name in folders]) if folders else None

    def _newest(self, rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*self.keys).agg(F.max(self.fetched_at).alias("_last"))
        return _join_keys(rows, last, self.keys, F.col(self.fetched_at) == F.col("_last"))

    def latest(self, version: int | None = None) -> DataFrame | None:
        """The newest rows of every key."""
        rows = self.stored(version)
        return None if rows is None else self._newest(rows)

    def reuse_or_fill(
        self, wanted: DataFrame, fetch: Callable[[DataFrame], DataFrame], ttl_hours: float, now: Column
    ) -> DataFrame:
        """The rows of all wanted keys: stored ones that are fresh enough, all others from fetch(missing keys).

        What was fetched is committed first, so the next call reuses it. fetch is not called if nothing is missing.
        """
        wanted = wanted.select(*self.keys).distinct()
        rows = self.stored()
        missing = wanted
        if rows is not None:
            fresh = fresh_snapshot(rows, self.keys, self.fetched_at, ttl_hours, now)
            missing = _join_keys(wanted, fresh.drop(self.fetched_at), self.keys, how="left_anti")
        if not missing.isEmpty():
            self.commit(fetch(missing))
        return _join_keys(self.latest(), wanted, self.keys)

    # ------------------------------------------------------------ upkeep

    def compact(self, oldest: Column | None = None) -> int:
        """A version that holds only the newest rows of every key in one folder, without those fetched before oldest."""
        rows = self.latest()
        if rows is None:
            raise ValueError("nothing has been committed")
        version = self.versions()[-1]
        kept = rows if oldest is None else rows.filter(F.col(self.fetched_at) >= oldest)
        return self._publish(version + 1, [self._write(kept)])

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete all but the last `keep` versions, and the data folders that none of those lists."""
        files, data = file_system(self.spark, f"{self.folder}/data")
        versions = self.versions()
        kept = versions[-keep:] if keep > 0 else versions
        used = {name for version in kept for name in self.folders(version)}
        for version in versions:
            if version not in kept:
                files.delete(file_system(self.spark, f"{self.folder}/manifests/v{version}.json")[1], False)
        gone = [f"data/{s.getPath().getName()}" for s in files.listStatus(data) if f"data/{s.getPath().getName()}" not in used] if kept else []
        for name in gone:
            files.delete(file_system(self.spark, f"{self.folder}/{name}")[1], True)
        return sorted(gone)


def _join_keys(rows: DataFrame, other: DataFrame, keys: list[str], also: Column | None = None, how: str = "left_semi") -> DataFrame:
    """rows with (or without) a partner in other; NULL keys are equal to each other."""
    other = other.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = F.lit(True) if also is None else also
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return rows.join(other, same, how)
