"""Log of manifest days that have been processed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([T.StructField("manifest_date", T.DateType())])


def mark_processed(days: DataFrame, path: str) -> None:
    """Append the distinct days of a finished run. A day may be logged twice."""
    days.select("manifest_date").distinct().write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def last_processed(spark: SparkSession, path: str) -> dt.date | None:
    """The high-water mark."""
    return read_log(spark, path).agg(F.max("manifest_date")).first()[0]
