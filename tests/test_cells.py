"""Retrieval from cells against all pairs: clustered and plain vectors, ties, nulls, several blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunemill.operators import cells
from tunemill.operators import retrieval as rt

SCHEMA = "vec_id long, embedding array<float>"


def clustered(n=3000, dim=12, centres=30, seed=2):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    x = c[rng.integers(0, centres, n)] + 0.05 * rng.normal(size=(n, dim))
    return [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]


def both(spark, rows, asked, k, **kw):
    e = spark.createDataFrame(rows, SCHEMA).repartition(4)
    q = spark.createDataFrame(asked, "query_id long, qv array<double>")
    stats = {}
    got = sorted(map(tuple, cells.search_cells(q, cells.build_cells(e, **kw), k, stats).collect()))
    whole = lambda v: F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    want = sorted(map(tuple, rt.retrieve_topk(q.where(whole("qv")), e.where(whole("embedding")), k).collect()))
    return got, want, stats


@pytest.mark.parametrize("n_cells", [1, 16, 64])
def test_equals_all_pairs(spark, n_cells):
    rows = clustered()
    got, want, stats = both(spark, rows, [(i, v) for i, v in rows[:60]], 5, cells=n_cells)
    assert got == want and len(got) == 300
    assert stats["pairs"] == 60 * 3000
    if n_cells == 64:  # clusters apart from each other: most pairs are not scored
        assert stats["scored"] < 0.3 * stats["pairs"]


def test_plain_vectors_and_large_k(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(400)]
    got, want, _ = both(spark, rows, [(i, rng.normal(size=6).tolist()) for i in range(20)], 70, cells=20)
    assert got == want
    got, want, stats = both(spark, rows[:30], [(1, [1.0] * 6)], 70, cells=20)
    assert got == want and len(got) == 30 and stats["scored"] == 30


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(cells, "QUERIES", 16)
    rows = clustered(500)
    got, want, _ = both(spark, rows, rows[:50], 3, cells=10)
    assert got == want and len(got) == 150


def test_ties_repeats_nulls_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (9, [0.0, 0.0]), (4, [0.0, 1.0]), (None, [1.0, 1.0]),
            (6, None), (7, [nan, 1.0]), (8, [None, 1.0]), (10, [inf, 0.0])]
    asked = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 0.0])]
    rows_in = [r for r in rows if r[0] is not None]
    got, want, _ = both(spark, rows_in, asked, 4, cells=3)
    assert got == want
    assert [r[1:3] for r in got if r[0] == 1] == [(3, 1.0), (3, 1.0), (4, 0.0), (5, 1.0)]
    assert {r[0] for r in got} == {1, 2}
    assert both(spark, [], asked, 4)[0] == [] == both(spark, rows_in, [], 4)[0]
