"""What the manifests of all days said about an object, as intervals, and joins as of a day.

An object has one row per manifest day that names it: the keys of that day, in force from that day until the next
day that names it. Days may come in any order and again; a day that is loaded again replaces what it said before. The rows are kept in
a state (``sinks.state``), so a run reads and rewrites only the buckets of the objects that its days name.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docpipe.operators.joins import pinned
from docpipe.sinks.state import Conflict, State, exists, merge, newest, read_state

KEYS = ["object_id", "claim_id", "Prior_Version_Object_Name", "new/changed"]
MEASURES = {"n_rows": "count(1)", "n_days": "approx_count_distinct(valid_from, 0.01)"}
HISTORY_SCHEMA = (
    "Object_name string, valid_from date, valid_to date, object_id string, claim_id string, "
    "Prior_Version_Object_Name string, `new/changed` string, loaded bigint"
)


def intervals(rows: DataFrame) -> DataFrame:
    """One row per object and day, that of the last load, each in force until the object's next day.

    Rows are reduced per object and day first, so an object has as many rows as there are days at most,
    whatever the number of manifest rows. Of several rows of one load the greatest by its values counts.
    """
    keys = F.struct("loaded", *[F.col(f"`{c}`") for c in KEYS])
    one = rows.groupBy("Object_name", "valid_from").agg(F.max(keys).alias("said"))
    until = F.lead("valid_from").over(Window.partitionBy("Object_name").orderBy("valid_from"))
    return one.select(
        "Object_name", "valid_from", until.alias("valid_to"), *[F.col(f"said.`{c}`").alias(c) for c in KEYS], F.col("said.loaded").alias("loaded")
    )


def history_state(path: str, buckets: int = 64) -> State:
    return State(path, "Object_name", HISTORY_SCHEMA, intervals, buckets)


def add_days(manifest: DataFrame, path: str, buckets: int = 64, source: str | None = None, batch: int | None = None) -> bool:
    """Bring manifest rows into the history; false if this batch of the source is in it.

    Rows without a name or a day take no part.
    """
    spark = manifest.sparkSession
    state = history_state(path, buckets)
    known = manifest.where(F.col("Object_name").isNotNull() & F.col("manifest_date").isNotNull())
    for tries_left in (2, 1, 0):
        rows = known.select(
            "Object_name", F.col("manifest_date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
            *[F.col(f"`{c}`") for c in KEYS], F.lit(newest(spark, path)["version"] + 1).cast("bigint").alias("loaded"),
        )
        try:
            return merge(rows, state, source, batch, MEASURES)
        except Conflict:
            if not tries_left:
                raise
    return False


def has_history(spark: SparkSession, path: str) -> bool:
    return exists(spark, history_state(path))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return read_state(spark, history_state(path)).drop("loaded")


def in_force(history: DataFrame, day: dt.date) -> DataFrame:
    """The keys of every object as of one day: one row per object that a manifest had named by then."""
    return history.where((F.col("valid_from") <= F.lit(day)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(day))))


def attach_keys_as_of(texts: DataFrame, history: DataFrame, day_col: str) -> DataFrame:
    """Every text with the keys in force on its own day; texts without any stay.

    The join is on the object with the day between the ends of the interval, so a text meets at most one
    interval. An object has at most one interval per day, so only the text side can have hot keys, and that side of
    a left join is split by adaptive execution.
    """
    t, h = pinned(texts).alias("t"), history.alias("h")
    day = F.col(f"t.{day_col}")
    fits = (F.col("h.valid_from") <= day) & (F.col("h.valid_to").isNull() | (F.col("h.valid_to") > day))
    joined = t.join(h, (F.col("t.Object_name") == F.col("h.Object_name")) & fits, "left")
    return joined.select("t.*", "h.valid_from", *[F.col(f"h.`{c}`") for c in KEYS])
