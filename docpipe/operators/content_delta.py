"""Changes of a folder by the bytes of its files, and what the manifest says against it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def digests(raw: DataFrame) -> DataFrame:
    """``files, length, digest`` of raw file rows: a row per name to keep for the next run.

    Content is hashed where it is read and goes no further. Files that were not read have no digest. If several folders have a file
    of one name, its digest is that of all their contents, whichever order they come in.
    """
    content = F.col("content")
    one = raw.select("files", F.octet_length(content).cast("bigint").alias("length"), F.sha2(content, 256).alias("digest"))
    # equal contents count once; a name has few contents, whatever the number of files
    distinct = one.groupBy("files", "length", "digest").agg(F.lit(1).alias("_"))
    return distinct.groupBy("files").agg(
        F.sum("length").cast("bigint").alias("length"),
        F.when(F.count("*") == 1, F.min("digest")).otherwise(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ""), 256)).alias("digest"),
    )


def delta_by_content(before: DataFrame, now: DataFrame) -> DataFrame:
    """``files, status, old_length, new_length``: ``same``, ``changed``, ``new`` or ``gone`` between two runs' digests.

    A file that was not read in one of the runs is ``unread``: nothing is known of its bytes.
    """
    b, a = before.alias("b"), now.alias("a")
    joined = b.join(a, F.col("b.files") == F.col("a.files"), "full_outer")
    status = (
        F.when(F.col("b.files").isNull(), "new")
        .when(F.col("a.files").isNull(), "gone")
        .when(F.col("a.digest").isNull() | F.col("b.digest").isNull(), "unread")
        .when((F.col("a.digest") == F.col("b.digest")) & (F.col("a.length") == F.col("b.length")), "same")
        .otherwise("changed")
    )
    return joined.select(
        F.coalesce("a.files", "b.files").alias("files"), status.alias("status"),
        F.col("b.length").alias("old_length"), F.col("a.length").alias("new_length"),
    )


def checked_claims(delta: DataFrame, manifest: DataFrame, name_col: str = "files") -> DataFrame:
    """Every object of the delta with what the manifest claims, ``New``, ``Changed`` or null, and whether the bytes agree.

    ``manifest`` has one row per object at most in ``Object_name`` and ``new/changed``, such as ``key_history.in_force``.
    """
    claim = manifest.select(F.col("Object_name").alias("claimed_name"), F.col("`new/changed`").alias("claim"))
    agrees = (
        F.when(F.col("status") == "unread", F.lit(None).cast("boolean"))
        .when(F.col("claim").isNull(), F.col("status").isin("same", "gone"))
        .when(F.col("claim") == "Changed", F.col("status") == "changed")
        .otherwise(F.col("status") == "new")
    )
    return delta.join(claim, F.col(name_col) == F.col("claimed_name"), "left").drop("claimed_name").withColumn("agrees", agrees)
