"""Sets of word n-grams as hashes: making them, verifying pairs of them, and the components of links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.llm.common import written

MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, repeats included; fewer words are one run."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - k + 1)
    out = np.full(n, len(words) if len(words) < k else k, np.uint64)
    for j in range(min(k, len(words))):
        out = mixed(out * STEP + h[j:j + n])
    return out


def list_array(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate(rows) if rows else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def similar(a: Column, b: Column, common: Column, percent: int) -> Column:
    """``common / (a + b - common) >= percent / 100`` in whole numbers."""
    return common * (100 + percent) >= (a + b) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").where(
        similar(F.size("sa"), F.size("sb"), common, percent)
    ).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``root``, the smallest id that links lead to, for every id with a link.

    Each round takes the smallest root among an id's neighbours and then the root of that root,
    so the number of rounds grows with the logarithm of the longest chain.
    """
    both = written(links.select(F.col("a").alias("id"), F.col("b").alias("to")).union(
        links.select(F.col("b").alias("id"), F.col("a").alias("to"))
    ).distinct(), "link-edges")
    roots = written(both.groupBy("id").agg(F.least("id", F.min("to")).alias("root")), "link-roots")
    while True:
        near = both.join(roots.select(F.col("id").alias("to"), "root"), "to").groupBy("id").agg(F.min("root").alias("least"))
        lower = roots.join(near, "id").select("id", F.col("root").alias("was"), F.least("root", "least").alias("root"))
        jump = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        after = written(
            lower.join(jump, "root", "left").select("id", "was", F.coalesce("next", "root").alias("root")), "link-roots"
        )
        moved = after.where("was <> root").limit(1).count()
        roots = after.select("id", "root")
        if not moved:
            return roots
