"""Clusters of integer vectors around centroids, by JVM expressions alone.

Every vector is scaled to whole numbers once and written. A round is one pass over that table: ``zip_with``
and ``aggregate`` give the squared distance to each centroid, a literal array in the plan;
``array_min`` over structs of distance and number picks the cluster, so ties go to the smaller number; sums of the
columns per cluster, combined in each task first, give the next centroids. What crosses the
shuffle is one row per cluster and task, and what comes to the driver is one row per cluster, so neither a hot
cluster nor the number of vectors changes the shape of a round.

Defined cases: vectors that are null, of another length, or with a null or non-finite component take no part.
Rows without an id are clustered but never start a centroid. Repeated rows count each; where
equal ids meet among the starts, the smaller vector comes first. With fewer rows than centroids there are as many
centroids as rows; an empty table gives no rows. Other columns are not read. Squared distances, their sums and the sums
of a component must fit into 63 bits; beyond that Spark raises an overflow error instead of a wrong number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.llm.common import written


@dataclass(frozen=True)
class Settings:
    dims: int = 64
    scale: int = 1024
    centroids: int = 8
    rounds: int = 10
    seed: str = "3"


def scaled(vectors: DataFrame, s: Settings) -> DataFrame:
    """``vec_id`` and ``x`` (array of long) of the vectors that take part."""
    vector = F.col("embedding")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where((F.size(vector) == s.dims) & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda c: F.floor(c.cast("double") * s.scale)).alias("x")
    )


def starts(rows: DataFrame, s: Settings) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids, the same on every run."""
    hashed = rows.where("vec_id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("vec_id").cast("string")), 256))
    return [r.x for r in hashed.orderBy("h", "x").limit(s.centroids).collect()]


def longs(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def distance(x: Column, centroid: list[int]) -> Column:
    squares = F.zip_with(x, longs(centroid), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda total, v: total + v)


def nearest(x: Column, centroids: list[list[int]]) -> Column:
    """Struct of ``distance`` and ``cluster``."""
    return F.array_min(F.array(*[
        F.struct(distance(x, c).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(centroids)
    ]))


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round; one without vectors stays."""
    sums = rows.select("x", nearest(F.col("x"), centroids)["cluster"].alias("cluster")).groupBy("cluster").agg(
        F.count("*").alias("n"), *[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(len(centroids[0]))]
    )
    after = list(centroids)
    for r in sums.collect():  # one row per cluster
        after[r.cluster] = [total // r.n for total in r[2:]]
    return after


def clustered(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector that takes part."""
    s = settings
    rows = written(scaled(vectors, s), "cluster-vectors")
    centroids = starts(rows, s)
    if not centroids:
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        )
    for _ in range(s.rounds):
        centroids = moved(rows, centroids)
    placed = written(rows.select("vec_id", nearest(F.col("x"), centroids).alias("best")).select("vec_id", "best.*"), "cluster-placed")
    sums = {r.cluster: r.total for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    inertia = [sums.get(k, 0) for k in range(len(centroids))]
    return placed.select(
        "vec_id", "cluster", "distance", F.get(longs(inertia), F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"), F.get(F.array(*map(longs, centroids)), F.col("cluster")).alias("centroid"),
    )
