"""Session set-up and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs want; each is applied only where the session has none.
PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys: split the oversized shuffle partition, even if that costs a shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a broadcast side is sized by its files; text shrinks a lot in them
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # documents reach Python in batches bounded by size; a batch is held on both sides at once
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    # a stream names its files one by one; by default each would be listed by a task of its own
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
    "spark.sql.session.timeZone": "UTC",
}


def build(app_name: str = "docpipe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**PREFERRED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the preferred settings to a session made elsewhere; set values stay."""
    for key, value in PREFERRED.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_name(spark: SparkSession) -> str:
    """What the work files and databases of this application are named after."""
    return "docpipe_" + "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the shared folder; nothing there is ever overwritten."""
    return f"{shared_folder(spark)}/{run_name(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the work files and databases of this application. Call it when no result is read any more."""
    for database in spark.catalog.listDatabases(f"{run_name(spark)}*"):
        spark.sql(f"DROP DATABASE IF EXISTS `{database.name}` CASCADE")
    remove(spark, f"{shared_folder(spark)}/{run_name(spark)}")


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system for a path, so any URI the cluster knows will do."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    where, files = _file_system(spark, path)
    return files.exists(where)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of work files; none if there is no such folder."""
    where, files = _file_system(spark, folder)
    return [status.getPath().getName() for status in files.listStatus(where)] if files.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    where, files = _file_system(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole or not at all; false if there is one already."""
    where, files = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, where, no_options)  # refuses a target that exists
        return True
    except Exception:
        if not files.exists(where):
            raise
        files.delete(draft, False)
        return False


def remove(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again; it cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
