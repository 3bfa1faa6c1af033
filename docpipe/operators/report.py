"""Reconciliation report: how many rows each stage holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stages_of(wide: DataFrame, stages: list[str]) -> DataFrame:
    """One row of stage totals to ``position, stage, n, change``.

    ``change`` is the difference to the stage before; the first has none.
    """
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(stage).alias("stage"),
            F.col(stage).cast("bigint").alias("n"),
            (F.col(stage) - F.col(stages[i - 1]) if i else F.lit(None)).cast("bigint").alias("change"),
        )
        for i, stage in enumerate(stages)
    ]
    return wide.select(F.inline(F.array(*rows)))


def reconcile_outcomes(outcomes: DataFrame, daily: Column, published: dict[str, int]) -> DataFrame:
    """The daily report.

    Source total, daily files, extracted, then what the writes of a run counted (``published``: rows
    of the CSV, of the table, and on the cluster's file system), total without the daily files, extracted plus errors.
    ``daily`` is true for files of the daily delta. The outcome rows are read once.
    """
    status = F.col("status")
    wide = outcomes.agg(
        F.count("*").alias("source_total"),
        F.count_if(daily).alias("daily_files"),
        F.count_if(status == "ok").alias("extracted"),
        *[F.lit(n).cast("bigint").alias(stage) for stage, n in published.items()],
        F.count_if(~daily).alias("source_less_daily"),
        F.count_if(status.isin("ok", "error")).alias("extracted_and_errors"),
    )
    return stages_of(wide, wide.columns)
