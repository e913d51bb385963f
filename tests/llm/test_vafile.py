"""Exact top-k against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from commutewell.llm import vafile

SCHEMA = "vec_id long, embedding array<float>, dims int, v string, low int, cells string, i int, j int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "v", 2, "c", 3, 4) for i, v in rows], SCHEMA)


def brute_force(rows, k):
    import numpy as np

    whole = [
        (i, [math.floor(64 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    cut = lambda s: max(1 - 2**63, min(2**63 - 1, s))
    out = []
    for n_q, (q, w) in enumerate(whole):
        if q % 20 == 0:
            scores = sorted((-cut(sum(a * b for a, b in zip(w, v))), i) for n, (i, v) in enumerate(whole) if n != n_q and len(v) == len(w))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.02, 1.0, 50.0])
def test_equals_brute_force(spark, spread):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, spread) for _ in range(16)]) for i in range(700)]
    rows += [(1000 + i, rows[40][1]) for i in range(60)]  # ties
    got = vafile.top_k(table(spark, rows), F.col("vec_id") % 20 == 0, data_block=200, query_block=16)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_force(rows, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0]), (20, [0.5, 0.25]), (20, [0.5, 0.25]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [])]
    rows += [(None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (7, [1.0, 1.0]), (8, [1e30, 1.0]), (9, [0.0, 0.0])]
    got = vafile.top_k(table(spark, rows), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_force(rows, 20)
    assert vafile.top_k(table(spark, rows).limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("large", [3e5, 1e9, 1e12, 1e30])
def test_large_components_and_repeated_ids(spark, large):
    """The best answers are vectors of any size, and every row of a repeated id counts."""
    rng = random.Random(7)
    rows = [(i % 90, [rng.gauss(0, 1) * (large if rng.random() < 0.1 else 1) for _ in range(6)]) for i in range(300)]
    rows += [(500, [large, 1.0, 0.0, 0.0, 0.0, 0.0]), (60, rows[5][1]), (60, rows[5][1])]
    got = vafile.top_k(table(spark, rows), F.col("vec_id") % 20 == 0, data_block=100, query_block=8)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_force(rows, 20)


def test_bounds_spare_reads():
    import numpy as np

    rng = np.random.default_rng(1)
    v = rng.integers(-60, 60, (3000, 8)).astype(float)
    low = v.min(axis=0)
    width = vafile._width(low, v.max(axis=0))
    cells = ((v - low) // width).astype(np.uint8)
    read = []

    class Counting(np.ndarray):
        def __getitem__(self, at):
            out = np.asarray(self).__getitem__(at)
            read.append(len(out))
            return out

    found = vafile.search_block(np.arange(3000), np.arange(3000), v.view(Counting), cells, low, width, np.array([5]), v[5:6], 20)
    scores = sorted(((-int(v[i] @ v[5]), i) for i in range(3000) if i != 5))[:20]
    assert [(i, s) for _, i, s in found] == [(i, -s) for s, i in scores]
    assert sum(read) < 1500
