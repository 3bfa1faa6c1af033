"""CSV and Parquet output. Paths may be any URI the cluster can write to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.session import snapshot

# A multi-line CSV part is read by one task, so parts are bounded by their bytes.
CSV_BYTES_PER_PART = 128 * 1024 * 1024

# These settings keep quotes, line ends and outer blanks of a cell as they are.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def csv_name(name: str, ext: str, run_date: dt.date) -> str:
    """``Docx_MergedDataFrame_2019_05_08.csv``, a folder."""
    return f"{ext.title()}_{name}_{run_date:%Y_%m_%d}.csv"


def _in_parts(df: DataFrame, stored: bool = False) -> DataFrame:
    """Rows dealt so that a CSV part holds about ``CSV_BYTES_PER_PART`` of text or less.

    The rows are computed once, into a work table unless they are ``stored`` in one; their size is read off that table. Rows are dealt by
    a hash, so one long run of long texts spreads. A frame that is small as a whole keeps its partitions.
    """
    rows = df if stored else snapshot(df, "csv-rows")
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts), F.lit(0).cast("bigint"))
    total, widest = rows.agg(F.sum(size), F.max(size)).first()
    parts = -(-(total or 0) // max(1, CSV_BYTES_PER_PART - min(widest or 0, CSV_BYTES_PER_PART // 2)))
    return rows.repartition(int(parts), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])) if parts > 1 else rows


def write_csv(df: DataFrame, folder: str, name: str, ext: str, run_date: dt.date, stored: bool = False) -> tuple[str, int]:
    """Write a CSV folder; returns its path and the number of rows written. ``stored`` says that ``df`` is a scan of a table."""
    path = f"{folder}/{csv_name(name, ext, run_date)}"
    return path, write_counted(_in_parts(df, stored), lambda rows: _csv_writer(rows).csv(path))


def _csv_writer(df: DataFrame) -> DataFrameWriter:
    return df.write.mode("overwrite").options(**CSV_OPTIONS).option("emptyValue", "")


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return how many rows went through it, without another read."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what ``write_csv`` wrote; an empty cell comes back as null."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", True).csv(path)


def write_snapshot(outcomes: DataFrame, path: str, run_date: dt.date) -> None:
    """Outcome rows of all formats; the partitions that get rows are replaced."""
    (
        outcomes.withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ext", "run_date")
        .parquet(path)
    )


def write_format_snapshot(outcomes: DataFrame, path: str, ext: str, run_date: dt.date) -> None:
    """Outcome rows of one format and day; earlier ones are replaced, also by none."""
    outcomes.drop("ext").write.mode("overwrite").parquet(f"{path}/ext={ext}/run_date={run_date}")


def write_pages(pages: DataFrame, path: str, run_date: dt.date) -> None:
    """Page rows of one day; earlier ones are replaced, also by none."""
    pages.write.mode("overwrite").parquet(f"{path}/run_date={run_date}")


def write_errors(errors: DataFrame, folder: str, ext: str, run_date: dt.date) -> str:
    """The error list of one format, ``ErrorFileDocx_2019_05_08.csv``."""
    path = f"{folder}/ErrorFile{ext.title()}_{run_date:%Y_%m_%d}.csv"
    _csv_writer(_in_parts(errors)).csv(path)
    return path
