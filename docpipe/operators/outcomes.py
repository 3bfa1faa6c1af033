"""Counts, error lists and one-row-per-file over outcome rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_outcomes(outcomes: DataFrame) -> DataFrame:
    """Files, successes, failures and the rest per extension.

    ``n_partial`` counts the successes of which a part, such as a page, failed.
    """
    status = F.col("status")
    return outcomes.groupBy("ext").agg(
        F.count("*").alias("n_files"),
        F.count_if(status == "ok").alias("n_ok"),
        F.count_if((status == "ok") & F.col("error").isNotNull()).alias("n_partial"),
        F.count_if(status == "error").alias("n_error"),
        F.count_if(status == "skipped").alias("n_skipped"),
        F.count_if(status == "unsupported").alias("n_unsupported"),
    )


def error_listing(outcomes: DataFrame) -> DataFrame:
    """Each file that failed, in whole or in part, once, with its (first by text) error."""
    failed = outcomes.where(F.col("error").isNotNull())
    return failed.groupBy("files").agg(F.min("error").alias("error"))


def latest_per_file(rows: DataFrame, *order: str) -> DataFrame:
    """The last row per file in the given order; ties are broken by the later columns.

    The winners are found from the file names and order columns alone, so a file that is written
    over and over is reduced before any text moves; the rows that won are then joined to them.
    Order columns must tell the rows of a file apart: rows equal in all of them all stay.
    """
    version = F.struct(*order)
    winners = rows.select("files", version.alias("version")).groupBy("files").agg(F.max("version").alias("version"))
    winners = winners.select("files", *[F.col(f"version.{c}").alias(c) for c in order])
    keyed, w = rows.alias("r"), winners.alias("w")
    same = F.col("r.files").eqNullSafe(F.col("w.files"))
    for c in order:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"w.{c}"))
    rest = [c for c in rows.columns if c != "files"]
    return keyed.join(w, same, "left_semi").select("files", *rest)
