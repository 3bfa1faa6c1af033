"""Manifest filters, backlog days and joins of manifests with text."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.functions.names import DAY_STAMP, replace_suffix
from docpipe.operators.joins import compare_names, left_join_heavy_right, pinned
from docpipe.sources.manifests import MANIFEST_COLUMNS


def project(manifest: DataFrame) -> DataFrame:
    return manifest.select(*[F.col(f"`{c}`") for c in MANIFEST_COLUMNS])


def for_day(manifest: DataFrame, run_date: dt.date) -> DataFrame:
    """Rows of the day before ``run_date``."""
    return manifest.where(F.col("manifest_date") == F.lit(run_date - dt.timedelta(days=1)))


def in_backlog(manifest: DataFrame, run_date: dt.date, days: int) -> DataFrame:
    """Rows of the ``days`` days before ``run_date``, that day excluded."""
    first, last = run_date - dt.timedelta(days=days), run_date - dt.timedelta(days=1)
    return manifest.where(F.col("manifest_date").between(F.lit(first), F.lit(last)))


def union_manifests(*manifests: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), manifests)


def preview(manifest: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """First ``n`` rows in a fixed order."""
    return manifest.orderBy(*order).limit(n)


def changed(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("`new/changed`") == "Changed")


def has_prior(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("Prior_Version_Object_Name").isNotNull())


def backlog_days(run_date: Column, days: int) -> Column:
    """Array of the ``days`` dates before ``run_date``, oldest first."""
    if days < 1:
        return F.array().cast("array<date>")
    return F.sequence(F.date_sub(run_date, days), F.date_sub(run_date, 1))


def backlog_dates(run_dates: DataFrame, days: int, date_col: str = "run_date") -> DataFrame:
    """One row per backlog day of each run date, stamped ``yyyyMMdd``."""
    day = F.explode(backlog_days(F.col(date_col), days))
    return run_dates.select(F.col(date_col), day.alias("manifest_date")).select(
        "*", F.date_format("manifest_date", DAY_STAMP).alias("day_stamp")
    )


def unprocessed(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """Manifest rows of days that are not in the processed log."""
    days = processed.select("manifest_date").where(F.col("manifest_date").isNotNull()).distinct()
    return manifest.join(days, "manifest_date", "left_anti")


def prior_version_join(texts: DataFrame, manifest: DataFrame, suffix: str = ".docx") -> DataFrame:
    """Text of the earlier version of each manifest object."""
    named = texts.withColumn("files", replace_suffix(F.col("files"), suffix))
    named = named.withColumnRenamed("files", "Prior_Version_Object_Name")
    return pinned(named).join(has_prior(manifest), "Prior_Version_Object_Name", "inner")


def delta_vs_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Names (without extension) in the delta folder against manifest object names."""
    return compare_names(
        files.select("Object_name"), manifest.select("Object_name"), on="Object_name"
    )


def attach_keys(texts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Object, claim and earlier name next to the text; text without a manifest row stays."""
    keys = manifest.select("Object_name", "object_id", "claim_id", "Prior_Version_Object_Name")
    return left_join_heavy_right(texts, keys, "Object_name")
