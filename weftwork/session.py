"""Session defaults, and the shared folder where intermediate tables are cut off."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

#: Whether what a query has shuffled is deleted when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}
_run_folders: set[str] = set()


def get_spark(app: str = "weftwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; a cluster's own settings come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stage_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local session may go without the setting (it then gets a folder of its own): on a
    cluster a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="weftwork-")
    return _local_folders[context.applicationId]


def file_system(spark: SparkSession, folder: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def run_folder(spark: SparkSession) -> str:
    """This session's own part of the shared folder; it is deleted when the session's JVM ends."""
    folder = f"{stage_folder(spark)}/{spark.sparkContext.applicationId}"
    if folder not in _run_folders:
        files, path = file_system(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _run_folders.add(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write df to the shared folder and read it back.

    This cuts lineage (a lost executor re-reads files instead of replaying an iteration), fixes
    values that depend on partitioning, and gives the planner the true size of the table, so that
    it broadcasts the table only if it fits under spark.sql.autoBroadcastJoinThreshold. What was
    shuffled for it is deleted as soon as it is written, as nothing else reads that.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    written = spark.read.schema(df.schema).parquet(path)
    written._stage_path = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialise() wrote and that nothing reads any more."""
    for table in tables:
        files, path = file_system(table.sparkSession, table._stage_path)
        files.delete(path, True)
