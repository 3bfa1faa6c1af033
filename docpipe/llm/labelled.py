"""Bounded samples of labelled documents, and sparse rows of features on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.llm.common import written

# Ids and labels of a sample are broadcast: 20,000 rows of 12 bytes.
MOST_ROWS = 20_000


def sample_ids(labels: DataFrame, label: str, learn: Column, most_rows: int = MOST_ROWS) -> DataFrame:
    """``doc_id``, ``y`` and ``weight`` of at most ``most_rows`` labelled documents.

    Each class gives up to half of them, those with small hashes; the weight says how many
    labelled documents a sampled one stands for. An id that is labelled more than once gets the
    mean of its labels, one half counting as 1. Null labels and ids teach nothing.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn)
    known = written(
        known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
        .withColumn("at", F.shiftrightunsigned(F.xxhash64("doc_id"), 1) / float(1 << 63)), "labels-known",
    )
    n = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # one row per class
    # a little under the bound, which the limit then only guards
    share = {y: min(1.0, 0.97 * (most_rows // 2) / n.get(y, 1)) for y in (0, 1)}
    of_class = lambda values: F.when(F.col("y") == 1, F.lit(values[1])).otherwise(F.lit(values[0]))
    chosen = known.where(F.col("at") < of_class(share)).withColumn("weight", 1 / of_class(share))
    return written(chosen.select("doc_id", "y", "weight").limit(most_rows), "label-sample")


@dataclass
class Rows:
    """Sparse indicator rows: the features of row i are ``index[begin[i]:begin[i + 1]]``."""

    begin: np.ndarray
    index: np.ndarray
    y: np.ndarray
    weight: np.ndarray
    key: np.ndarray

    def __len__(self) -> int:
        return len(self.y)

    def row(self, i: int) -> np.ndarray:
        return self.index[self.begin[i]:self.begin[i + 1]]

    @property
    def of(self) -> np.ndarray:
        """The row of every entry of ``index``."""
        return np.repeat(np.arange(len(self)), np.diff(self.begin))

    def taken(self, keep: np.ndarray) -> Rows:
        """The rows where ``keep`` holds."""
        lengths = np.diff(self.begin)
        return Rows(np.concatenate([[0], np.cumsum(lengths[keep])]), self.index[np.repeat(keep, lengths)], self.y[keep], self.weight[keep], self.key[keep])

    def only(self, features: np.ndarray) -> Rows:
        """The same rows without the features that are false in the mask ``features``."""
        keep = features[self.index]
        lengths = np.bincount(self.of[keep], minlength=len(self))
        return Rows(np.concatenate([[0], np.cumsum(lengths)]), self.index[keep], self.y, self.weight, self.key)


def sampled_rows(docs: DataFrame, chosen: DataFrame, features: Callable[[str], np.ndarray], most_rows: int = MOST_ROWS) -> Rows:
    """Features of the sampled documents, made in the tasks that read them.

    The sample is broadcast: it has ``most_rows`` short rows at most. Of documents that share an
    id one is used, so what comes to the driver is ``most_rows`` rows of feature numbers.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [features(t.as_py() or "").tolist() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(lists, pa.list_(pa.int32())), batch.column(2), batch.column(3)], names=["doc_id", "x", "y", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y", "weight").mapInArrow(
        made, "doc_id long, x array<int>, y int, weight double"
    )
    one = rows.groupBy("doc_id").agg(F.min(F.struct("x", "y", "weight")).alias("r")).select("doc_id", "r.*")
    got = written(one, "label-rows").sort("doc_id").limit(most_rows).toArrow()
    x = got.column("x").combine_chunks()
    if isinstance(x, pa.ChunkedArray):
        x = x.chunk(0) if x.num_chunks else pa.array([], pa.list_(pa.int32()))
    lengths = np.diff(x.offsets.to_numpy()) if len(x) else np.empty(0, np.int64)
    return Rows(
        np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), x.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
        got.column("y").to_numpy().astype(np.int64), got.column("weight").to_numpy(), got.column("doc_id").to_numpy().astype(np.int64),
    )


def scored(docs: DataFrame, score: Callable[[str], float], held_out: Column) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([score(t.as_py() or "") for t in batch.column(2)], np.float64)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def calibration(keys: np.ndarray, one_in: int = 5) -> np.ndarray:
    """Rows set apart to calibrate on, by their ids."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(33)) % np.uint64(one_in) == 0


def platt(margins: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset that make a sigmoid of the margins fit the labels (Newton, smoothed targets)."""
    if len(margins) == 0 or len(set(y.tolist())) < 2:
        return 1.0, 0.0
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target = np.where(y == 1, high, low)
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    at = np.zeros(2)
    for _ in range(rounds):
        p = sigmoid(x @ at)
        slope = x.T @ (weight * (p - target)) + 1e-3 * at
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        at = at - np.linalg.solve(curve, slope)
    return float(at[0]), float(at[1])
