"""Centroid clusters against a plain loop."""

import hashlib
import math
import random

from docpipe.llm import centroid_clusters as cc

SCHEMA = "vec_id long, embedding array<double>, cluster string, x int"


def plain(rows, s):
    """Rows of ``vec_id, cluster, distance, inertia of the cluster, centroid``."""
    vectors = [(i, [math.floor(c * s.scale) for c in v]) for i, v in rows]
    named = sorted((hashlib.sha256(f"{s.seed}:{i}".encode()).hexdigest(), x) for i, x in vectors if i is not None)
    centroids = [x for _, x in named[: s.centroids]]

    def best(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))

    for _ in range(s.rounds):
        members = {}
        for _, x in vectors:
            members.setdefault(best(x)[1], []).append(x)
        for k, xs in members.items():
            centroids[k] = [sum(column) // len(xs) for column in zip(*xs)]
    placed = [(i, *best(x)) for i, x in vectors]
    total = {k: sum(d for _, d, c in placed if c == k) for _, _, k in placed}
    return sorted([(i, k, d, total[k], sum(total.values()), tuple(centroids[k])) for i, d, k in placed], key=repr)


def run(spark, rows, s):
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in rows], SCHEMA).repartition(3)
    got = cc.clustered(df, s).collect()
    return sorted([(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in got], key=repr)


def test_equals_a_plain_loop(spark):
    random.seed(5)
    s = cc.Settings(dims=6, centroids=4, rounds=5)
    rows = [(i, [random.uniform(-2, 2) for _ in range(6)]) for i in range(120)]
    rows += [(7, rows[7][1]), (None, rows[9][1]), *[(500 + i, [0.25] * 6) for i in range(60)]]
    assert run(spark, rows, s) == plain(rows, s)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    s = cc.Settings(dims=1, centroids=3, rounds=2, scale=1)
    rows = [(i, [1.0]) for i in range(5)] + [(9, [4.0])]
    assert run(spark, rows, s) == plain(rows, s)


def test_rows_that_take_no_part(spark):
    s = cc.Settings(dims=2, centroids=2, rounds=1)
    odd = [(1, None), (2, []), (3, [1.0, None]), (4, [1.0, float("nan")]), (5, [float("-inf"), 0.0]), (6, [1.0, 2.0, 3.0])]
    assert run(spark, odd, s) == []
    assert run(spark, [], s) == []
    assert [r[0] for r in run(spark, odd + [(8, [0.5, -0.5])], s)] == [8]
    assert run(spark, [(None, [1.0, 2.0])], s) == []  # nothing to start from
