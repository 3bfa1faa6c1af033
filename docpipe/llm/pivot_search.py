"""Exact top-k by inner product with pivot tables.

Distances from every vector to a few pivots are computed once. For a query q and a candidate x
the triangle inequality gives |d(q, p) - d(x, p)| <= d(q, x) for every pivot p, and the
largest of these is a lower bound of the distance. With the norms known, a lower bound of the
distance is an upper bound of the inner product. Candidates are evaluated in the order of that
bound, and a query is done when the next bound is below its k-th best score: nothing that is
left could still enter, ties included.

Candidates are dealt into blocks of a fixed number of rows, queries likewise, and each pair of
blocks is one group of one task. Only k rows per query and block leave it.

Vectors that are null, or hold null or non-finite components, take no part, nor do rows without
an id. Vectors are compared with vectors of the same length. A row is no candidate for queries
with its own id. Repeated rows are candidates each; a repeated query gets its answer each time.
Components times the scale must fit into 31 bits and scores into 63.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpipe.llm.common import written


@dataclass(frozen=True)
class Settings:
    k: int = 5
    scale: int = 256
    query_step: int = 50
    pivots: int = 24
    candidates_per_block: int = 16_384
    queries_per_block: int = 2_048
    chunk: int = 256  # candidates evaluated between two looks at the bound


def scaled(vectors: DataFrame, s: Settings) -> DataFrame:
    """``id``, ``dim`` and ``x`` (array of long) of the vectors that take part."""
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * s.scale))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True))
    ).select(F.col("vec_id").cast("long").alias("id"), F.size("embedding").alias("dim"), whole.alias("x"))


def pivots(rows: DataFrame, s: Settings) -> dict[int, np.ndarray]:
    """The same few vectors per length on every run: those with the smallest hashes.

    Any vectors give true bounds; the choice only decides how tight they are. What comes to the
    driver is ``pivots`` rows per length.
    """
    order = Window.partitionBy("dim").orderBy("h", "id")
    chosen = rows.select("dim", "id", "x", F.xxhash64("id").alias("h")).withColumn("nth", F.row_number().over(order))
    by_dim: dict[int, list] = {}
    for r in chosen.where(F.col("nth") <= s.pivots).select("dim", "x").collect():
        by_dim.setdefault(r.dim, []).append(r.x)
    return {dim: np.array(sorted(xs), dtype=np.float64).reshape(len(xs), dim) for dim, xs in by_dim.items()}


def _tabler(by_dim: dict[int, np.ndarray]):
    def tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for dim, x in zip(batch.column("dim").to_pylist(), batch.column("x")):
                v = np.asarray(x.values, dtype=np.float64)
                p = by_dim[dim]
                out.append(np.sqrt(np.square(p - v).sum(axis=1)) if dim else np.zeros(len(p)))
            yield pa.record_batch([*batch.columns, pa.array(out, pa.list_(pa.float64()))], names=[*batch.schema.names, "to_pivots"])

    return tabled


def table_of(rows: DataFrame, s: Settings) -> DataFrame:
    """The pivot table: every vector with its distances to the pivots of its length."""
    kinds = "id long, dim int, x array<long>, to_pivots array<double>"
    return written(rows.mapInArrow(_tabler(pivots(rows, s)), kinds), "pivot-table")


def search_block(queries: tuple[np.ndarray, ...], block: tuple[np.ndarray, ...], k: int, chunk: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (its place) the ids and scores of its best ``k`` in the block.

    ``queries`` and ``block`` are ids, vectors and distances to the pivots; the block's ids ascend.
    """
    q_ids, q, q_table = queries
    ids, x, x_table = block
    q_norm, x_norm = (np.square(v.astype(np.float64)).sum(axis=1) for v in (q, x))
    for i in range(len(q_ids)):
        least = np.zeros(len(ids))
        for p in range(x_table.shape[1]):
            np.maximum(least, np.abs(x_table[:, p] - q_table[i, p]), out=least)
        # a margin for rounding: scores are whole numbers, bounds are not
        bound = (q_norm[i] + x_norm - np.square(np.maximum(least * (1 - 1e-9) - 1e-6, 0))) / 2 + 0.5
        bound[ids == q_ids[i]] = -np.inf
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        left, size = np.arange(len(ids)), chunk
        while len(left):
            if len(left) > size:
                cut = np.argpartition(-bound[left], size)
                now, left = left[cut[:size]], left[cut[size:]]
            else:
                now, left = left, left[:0]
            now = now[bound[now] > -np.inf]
            if len(best) == k:
                now = now[bound[now] >= best[-1]]
                if not len(now):
                    break  # those left have no larger bounds
            best_ids = np.concatenate([best_ids, ids[now]])
            best = np.concatenate([best, x[now] @ q[i]])
            order = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[order], best[order]
            size *= 4
        yield i, best_ids, best


def top(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the best of every query."""
    s = settings
    table = table_of(scaled(vectors, s), s)
    asked = F.col("id") % s.query_step == 0
    counts = table.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(asked, 1)).alias("q"))
    blocks = written(counts.select(
        "dim", F.ceil(F.col("n") / s.candidates_per_block).alias("n_blocks"), F.ceil(F.col("q") / s.queries_per_block).alias("q_blocks")
    ).where("q_blocks > 0"), "pivot-blocks")
    # a row's number is fixed once, in a written table; blocks take rows in turn, so none is hot
    numbered = written(table.withColumn("row", F.monotonically_increasing_id()), "pivot-rows").join(blocks, "dim")
    range_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = F.pmod(F.xxhash64("row"), F.col("n_blocks"))
    candidates = numbered.withColumn("block", own).withColumn("q_block", range_to("q_blocks"))
    queries = numbered.where(asked).withColumn("q_block", F.pmod(F.xxhash64("row"), F.col("q_blocks"))).withColumn("block", range_to("n_blocks"))
    columns = ["dim", "block", "q_block", "row", "id", "x", "to_pivots"]

    def searched(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        def parts(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
            rows = rows.sort_values("id", kind="stable")
            return (
                rows["id"].to_numpy(np.int64), np.array(rows["x"].tolist(), dtype=np.int64).reshape(len(rows), int(key[0])),
                np.array(rows["to_pivots"].tolist(), dtype=np.float64).reshape(len(rows), -1),
            )

        if not len(left) or not len(right):
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        numbers = left.sort_values("id", kind="stable")["row"].to_numpy()
        asked_here = parts(left)
        found = list(search_block(asked_here, parts(right), s.k, s.chunk))
        n = [len(ids) for _, ids, _ in found]
        at = np.repeat([i for i, _, _ in found], n).astype(np.int64)
        return pd.DataFrame({
            "row": numbers[at], "query_id": asked_here[0][at],
            "vec_id": np.concatenate([ids for _, ids, _ in found]), "score": np.concatenate([b for _, _, b in found]),
        })

    keys = ["dim", "block", "q_block"]
    found = queries.select(columns).toDF(*columns).groupBy(keys).cogroup(candidates.select(columns).groupBy(keys)).applyInPandas(
        searched, "row long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.k).select("query_id", "rank", "vec_id", "score")
