"""Joins of extracted text with mapping and manifest rows.

The text side holds one row per file. The other side may hold any number of rows
for one file. Inner joins are left to the optimizer: it broadcasts a side only if
its size is known to be under ``spark.sql.autoBroadcastJoinThreshold`` (the session
settings count compressed files at a multiple of their size), and adaptive execution
splits an oversized shuffle partition on either side. An outer join can
be split on its kept side only, so the one below is an inner join with a completed right side.

Generated code evaluates a projected column where it is first used. Behind a join
that is once per joined row, so a costly text column is pinned before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pinned(df: DataFrame, *texts: str) -> DataFrame:
    """The same rows, the text columns computed here and once per row.

    A generator over an array of one row is a point the code generator does not
    defer past; no shuffle, no copy of the values. Columns that are not named go around it, so a
    filter on a key still reaches the source; without names ``raw_text`` is pinned.
    """
    held = [c for c in (texts or ("raw_text",)) if c in df.columns]
    if not held:
        return df
    free = [F.col(f"`{c}`") for c in df.columns if c not in held]
    values = F.struct(*[F.col(f"`{c}`") for c in held])
    return df.select(*free, F.inline(F.array(values))).select(*[F.col(f"`{c}`") for c in df.columns])


def natural_inner_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all common columns; no common column is an error.

    ``right`` is the side with the computed text.
    """
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError(f"no common column in {left.columns} and {right.columns}")
    return left.join(pinned(right), common, "inner")


def left_join_heavy_right(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join whose right side may have hot keys.

    Adaptive execution splits both sides of an inner join only. So the right side is made
    complete: it gets one row of nulls for each left key that it lacks, found from the keys alone,
    and then an inner join finds a partner for every left row. The left side, text and all, is read and
    shuffled once. Null keys match the row of nulls through a stand-in.
    """
    rest = [c for c in right.columns if c != on]
    keys = left.select(on).distinct()
    known = right.where(F.col(on).isNotNull())
    lacking = keys.join(known.select(on).distinct(), on, "left_anti")
    nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rest]
    complete = known.select(on, *rest).union(lacking.select(on, *nulls))

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"_no_key": F.col(on).isNull(), "_key": F.coalesce(F.col(on), F.lit(""))})

    left, complete = pinned(keyed(left)), keyed(complete).drop(on)
    joined = left.join(complete, ["_key", "_no_key"], "inner")
    return joined.drop("_key", "_no_key")


def compare_names(files: DataFrame, manifest: DataFrame, on: str) -> DataFrame:
    """Which names are in the folder, in the manifest, or in both.

    Both sides are counted per name first, so the join meets one row per name.
    """
    in_files = files.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("n_files"))
    in_manifest = manifest.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("n_manifest"))
    status = (
        F.when(F.col("n_manifest").isNull(), "file_only")
        .when(F.col("n_files").isNull(), "meta_only")
        .otherwise("both")
    )
    return in_files.join(in_manifest, on, "full_outer").select(
        on,
        status.alias("status"),
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
        F.coalesce("n_manifest", F.lit(0)).alias("n_manifest"),
    )
