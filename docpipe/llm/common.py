"""What several operators share: the word definition, work tables, and the splits by id."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe import session

# A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session.configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A DataFrame as a Parquet table in the shared work folder, read again. It cuts the lineage: later
# steps, and tasks repeated after a lost executor, read files.
written = session.snapshot


def crc_bucket(doc_id: Column, n: int) -> Column:
    """``crc32`` of the id's decimal digits modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def word_count(text: Column) -> Column:
    """Words of the whole text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def kept_by_worker(name: str, make: Callable[[], Any]) -> Any:
    """A value that a Python worker makes once and keeps from task to task.

    This package travels with each task by value, so its own globals do not outlive the task.
    """
    kept = sys.modules.setdefault("docpipe_kept_by_worker", ModuleType("docpipe_kept_by_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


# A bitmap of ids: its size is fixed, so it can be sent to every task however many ids there are.
BITMAP_BITS = 1 << 27


def _bit(ids: np.ndarray) -> np.ndarray:
    """The bit of each id."""
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) % np.uint64(BITMAP_BITS)


def among(ids: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A test for tasks: false only for ids that are not in the one long column of ``ids``.

    It spares a shuffle the rows that surely find no partner. What it lets through is decided by a join afterwards, so
    with more ids than bits less is spared and nothing is lost. Bits are put together by tasks; what comes to the driver is the bitmap.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(_bit(batch.column(0).drop_null().to_numpy()))
            place = (bits >> np.uint64(6)).astype(np.int32)
            at, start = np.unique(place, return_index=True)
            values = np.bitwise_or.reduceat(np.uint64(1) << (bits & np.uint64(63)), start) if len(bits) else np.empty(0, np.uint64)
            yield pa.record_batch([pa.array(at, pa.int32()), pa.array(values.view(np.int64))], names=["place", "bits"])

    column = F.col(f"`{ids.columns[0]}`").cast("long")
    rows = ids.select(column).mapInArrow(words, "place int, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(BITMAP_BITS >> 6, np.uint64)
    bitmap[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    sent = ids.sparkSession.sparkContext.broadcast(bitmap)

    def test(values: np.ndarray) -> np.ndarray:
        bits = _bit(values)
        return ((sent.value[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1)).astype(bool)

    return test
