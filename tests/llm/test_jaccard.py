import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tunemill.llm import jaccard
from tunemill.llm.components import components


def sets_of(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    return ({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}) if w else set()


def brute(rows, n, num, den, groups=False):
    """(id, set size, smallest reachable id) per row, all pairs compared; or the groups' smallest ids."""
    s = [sets_of(t, n) for _, t in rows]
    holders = defaultdict(list)
    for i, x in enumerate(s):
        for g in x:
            holders[g].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, x in enumerate(s):
        both = defaultdict(int)
        for g in x:
            for j in holders[g]:
                if j < i:
                    both[j] += 1
        for j, c in both.items():
            if den * c >= num * (len(x) + len(s[j]) - c):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)].append(d)
    if groups:
        return [min(ids[r], default=None) for r in {root(i) for i in range(len(rows)) if s[i]}]
    return sorted(((d, len(s[i]), d if not s[i] else min(ids[root(i)], default=None))
                   for i, (d, _) in enumerate(rows)), key=repr)


def result(spark, rows, n, num, den):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, key int")
    out = jaccard.join(df, n=n, num=num, den=den)
    return sorted(((r.id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)


def edited(rng, words, edits):
    w = list(words)
    for _ in range(edits):
        i = rng.randrange(len(w))
        w[i:i + rng.randint(0, 2)] = [f"e{rng.randrange(10**6)}"] * rng.randint(0, 2)
    return " ".join(w)


def fixture():
    rng = random.Random(3)
    rows = [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "a b"), (906, "A  B"), (907, "a b c"),
            (None, "a b c"), (None, "nobody else has this text at all"), (908, "x " * 3000), (909, "x " * 2000)]
    d = 0
    for size in (6, 9, 14, 25, 60, 150, 400, 1200):
        for _ in range(4):
            base = [f"w{rng.randrange(3000)}" for _ in range(size)]
            for _ in range(7):
                rows.append((d, edited(rng, base, rng.randint(0, max(1, size // 25)))))
                d += 3
    common = " ".join(f"c{i}" for i in range(80))
    for k in (10, 40, 300):
        for _ in range(25):
            rows.append((d, " ".join(f"w{rng.randrange(9000)}" for _ in range(k)) + " " + common))
            d += 1
    chain = [f"k{i}" for i in range(300)]  # each is near the next, the ends are not near
    for i in range(0, 120, 6):
        rows.append((d, " ".join(chain[i:i + 150])))
        d += 1
    rows += [(d + i, rows[30][1]) for i in range(40)]  # copies
    rows += [rows[31], rows[31], (rows[31][0], "same id, other text of its own")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 4, 5), (2, 1, 2)])
def test_against_all_pairs(spark, n, num, den, monkeypatch):
    rows = fixture()
    monkeypatch.setattr(jaccard, "LOCAL", 3)
    monkeypatch.setattr(jaccard, "TILE", 4)
    monkeypatch.setattr(jaccard, "FLUSH", 3000)
    assert result(spark, rows, n, num, den) == brute(rows, n, num, den)


def test_hot_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    rows = [(i, edited(rng, base, rng.randint(0, 5))) for i in range(700)]
    assert result(spark, rows, 4, 85, 100) == brute(rows, 4, 85, 100)


def test_signatures_meet():
    """Every linked pair shares a signature, also where groups are empty."""
    rng = np.random.default_rng(0)
    for num, den in ((85, 100), (1, 2), (4, 5)):
        limit = jaccard.Threshold(num, den)
        for _ in range(1500):
            size = int(rng.integers(1, 60))
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(num / den, 1)],
                                          rng.integers(0, 2**63, int(rng.integers(0, 4))).astype(np.uint64)]))
            if len(b) and limit.linked(a, b) and a.tobytes() != b.tobytes():
                assert len(np.intersect1d(jaccard.signatures(a, limit), jaccard.signatures(b, limit)))


def test_tree_keeps_what_the_bound_allows():
    rng = np.random.default_rng(1)
    limit = jaccard.Threshold(4, 5)
    points = rng.poisson(2, (400, 30))
    tree = jaccard.RTree(points, points.sum(1))
    for q in points[:40] + rng.poisson(0.1, (40, 30)):
        bound = np.minimum(points, q).sum(1)
        want = np.flatnonzero(bound >= limit.overlap(points.sum(1) + q.sum()))
        assert set(want) <= set(tree.search(q, int(q.sum()), limit).tolist())


def test_points_never_exclude_links():
    rng = np.random.default_rng(2)
    limit = jaccard.Threshold(4, 5)
    for _ in range(1500):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(6, 90))).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93],
                                      rng.integers(0, 2**63, int(rng.integers(0, 6))).astype(np.uint64)]))
        for m in (3, 17, 60):
            if len(b) and limit.linked(a, b):
                assert jaccard.allowed(*jaccard.read_point(jaccard.point_of(a, m)),
                                       *jaccard.read_point(jaccard.point_of(b, m)), limit)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    rng.shuffle(edges)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for a, b in edges for x in (a, b) if a != b}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one(spark):
    rows = fixture()
    df = spark.createDataFrame([(d, t, 1, "q") for d, t in rows], "doc_id long, text string, key int, root string")
    got = jaccard.keep_one(df)
    assert got.columns == df.columns
    out = [(r.doc_id, len(sets_of(r.text, 5))) for r in got.collect()]
    want = brute(rows, 5, 4, 5)
    assert sorted(map(str, (d for d, n in out if n))) == sorted(map(str, brute(rows, 5, 4, 5, groups=True)))
    assert sum(1 for _, n in out if not n) == sum(1 for _, n, _ in want if not n)
    assert jaccard.keep_one(df.limit(0)).count() == 0


def test_query_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op9(docs).collect()), key=repr)
    assert got == brute(rows, 4, 85, 100)


def test_texts_of_null_and_repeated_ids_meet_their_own_sets_only(spark):
    """A null or repeated id is no join key: as many texts come out of it as sets went in."""
    n = 120
    texts = [f"alpha beta {i} gamma delta {i} epsilon zeta {i} eta" for i in range(n)]
    rows = [(None if i % 2 else 7, t, i) for i, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark int")
    out = jaccard.join(docs, n=2).collect()
    assert len(out) == 2 * n and len({r.key for r in out}) == n
    assert all(r.component_id in (7, None) for r in out)
    sets = jaccard.describe(docs, "doc_id", "text", 2)
    of = sets.groupBy("key").agg({"mark": "min"})
    assert of.count() == n == sets.select("id", "mark").distinct().count()
