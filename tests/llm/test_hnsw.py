import numpy as np
import pytest

from tunemill.llm import hnsw


def brute(rows, k, wanted):
    seen, ids, vecs = set(), [], []
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        if (i, tuple(v)) not in seen:
            seen.add((i, tuple(v)))
            ids.append(i)
            vecs.append(v)
    out = {}
    for i, v in zip(ids, vecs):
        if wanted(i):
            own = [(-float(np.sum(np.array(v) * np.array(w))), j) for j, w in zip(ids, vecs) if j != i and len(w) == len(v)]
            out[i] = [j for _, j in sorted(own)[:k]]
    return out


def result(df, k, wanted=lambda i: i % 20 == 0):
    out = {}
    for r in hnsw.nearest(df, wanted, k=k).collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [x[i + 1][0] for i in range(len(x))] for q, x in out.items()}, out


def test_small_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 10.0 ** rng.integers(-2, 3), 6)]) for i in range(160)]
    rows += [(200 + i, rows[5][1]) for i in range(100)]  # one vector shared by very many
    rows += [(1000, None), (1020, [0.0] * 6), (1040, [float("nan")] * 6), (1060, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (1080, [float("inf")] + [1.0] * 5), (1100, []), (None, [1.0] * 6), (1120, [1.0, 2.0]), (1121, [2.0, 0.5]),
             (1140, [1.0, 2.0, 3.0]), (0, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, dim int")
    for k in (3, 20):
        got, full = result(df, k)
        want = {q: x for q, x in brute(rows, k, lambda i: i % 20 == 0).items() if x}
        assert got == want
    vec = {i: v for i, v in rows}
    for q, x in full.items():
        for vec_id, score in x.values():
            assert score == pytest.approx(float(np.dot(vec[q], vec[vec_id])), rel=1e-12)
    assert hnsw.op6(df.limit(0)).count() == 0
    assert hnsw.op6(df.where("vec_id % 20 <> 0")).count() == 0


def test_ids_with_several_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(int(rng.integers(0, 70)), [float(x) for x in rng.integers(-9, 10, 4)]) for _ in range(240)]
    rows += [(i, rows[0][1]) for i in range(0, 70, 3)]  # and one vector under several of them
    rows += [(20, [float(x), 1.0, 2.0, 3.0]) for x in range(60)]  # one id with very many vectors
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {}
    for q in {i for i, _ in rows if i % 20 == 0}:
        best = {}
        for i, v in rows:
            for a in (w for j, w in rows if j == q and i != q):
                best[i] = max(best.get(i, -np.inf), float(np.dot(a, v)))
        want[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))
    for shard in (8192, 90):
        monkeypatch.setattr(hnsw, "SHARD", shard)
        for k in (1, 5, 200):
            _, full = result(df, k)
            assert {q: [x[r] for r in sorted(x)] for q, x in full.items()} == {q: x[:k] for q, x in want.items()}


def test_recall_over_shards(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").limit(4000)
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    want = brute(rows, 20, lambda i: i % 20 == 0)
    for shard in (8192, 1500):
        monkeypatch.setattr(hnsw, "SHARD", shard)
        got, _ = result(df, 20)
        assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
        recall = np.mean([len(set(got[q]) & set(x)) / 20 for q, x in want.items()])
        assert recall >= 0.9, recall


def test_flat_lists_hold_neighbours():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (700, 8)).astype(np.float32)
    g = hnsw.Graph.build(x, hnsw.level_counts(len(x)))
    assert [len(a) for a in g.lists] == hnsw.level_counts(len(x))
    for level in g.lists:
        n = len(level)
        for i, near in enumerate(level):
            near = near[near < n]
            assert len(set(near.tolist())) == len(near) > 0 and i not in near
    found = g.search(x[:100], 64)
    assert (found[:, 0] == np.arange(100)).mean() > 0.97
