"""Manifests as a stream: what came is what the checkpoint has, so there is no backlog to work out.

A batch of manifest files is brought into the key history, and that it was is part of the same commit. A day whose manifest
comes late, or comes again under another name, is taken when it comes; each file is taken once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.operators.key_history import add_days, history_state
from docpipe.sinks.state import reports
from docpipe.sources.files import packed, raw_file_stream
from docpipe.sources.manifests import parse_manifests
from docpipe.streaming.ingest import stream_id

REJECT_SCHEMA = "path string, line int, record string, reason string, batch_id bigint"


def ingest_manifests(
    spark: SparkSession, root: str, history: str, checkpoint: str, rejects: str, encoding: str = "windows-1252", files_per_batch: int = 10_000
) -> None:
    """Take the manifests under ``root`` that were not taken before, then stop.

    Records and files that cannot be taken are rows of ``rejects``, a partition per batch that a repeated batch replaces.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        manifest = parse_manifests(packed(batch), encoding, extra=["object_id"])
        refused = manifest.rejects.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        refused.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(rejects)
        add_days(manifest.rows, history, source=stream_id(batch.sparkSession, checkpoint), batch=batch_id)

    files = raw_file_stream(spark, f"{root}/{'[0-9]' * 8}/Metadata", ["csv"], files_per_batch)
    query = files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    return spark.read.schema(REJECT_SCHEMA).parquet(rejects)


def manifest_log(spark: SparkSession, history: str) -> DataFrame:
    """``source, batch, n_rows, n_days`` of every batch of manifests that is in the history."""
    done = reports(spark, history_state(history).path).where("source IS NOT NULL")
    return done.select("source", "batch", *[F.col("measures").getItem(c).alias(c) for c in ("n_rows", "n_days")])
