"""Exact search against all inner products."""

import math
import random

import numpy as np
import pytest

from docpipe.llm import pivot_search
from docpipe.llm.pivot_search import Settings


def brute(rows, k=5):
    good = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in good:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def got(docs, settings):
    return sorted(map(tuple, pivot_search.top(docs, settings).collect()))


@pytest.mark.parametrize("settings", [Settings(), Settings(pivots=3, candidates_per_block=40, queries_per_block=2, chunk=4)])
def test_equals_brute_force_with_ties_nulls_and_hot_vectors(spark, settings):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 8) for i in range(200)]  # one vector in a third of all rows
    rows += [(50, [0.1] * 8), (7, [0.1] * 8), (7, [0.1] * 8), (None, [1.0] * 8), (2000, None), (2001, [0.1, None]), (2050, [float("nan")] * 8)]
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3050, []), (3051, []), (2002, [float("inf")] * 8)]
    docs = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, row int")
    assert got(docs, settings) == brute(rows)
    assert got(docs.limit(0), settings) == []


def test_bound_order_stops_early_and_exactly():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 300, (8, 16))
    x = np.concatenate([c + rng.normal(0, 5, (200, 16)) for c in centres]).astype(np.int64)
    ids = np.arange(len(x))
    table = np.sqrt(((x[:, None, :] - centres[None]) ** 2).sum(axis=2))
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if self.ndim == 2 and isinstance(at, np.ndarray):
                read.append(len(at))
            return super().__getitem__(at)

    ((_, best, scores),) = pivot_search.search_block((ids[:1], x[:1], table[:1]), (ids, x.view(Counted), table), 5, 16)
    every = x @ x[0]
    order = [i for i in np.lexsort((ids, -every)).tolist() if i != 0][:5]
    assert np.array(best).tolist() == order and np.array(scores).tolist() == every[order].tolist()
    assert sum(read) < len(x) / 2
