import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tunemill.llm import lexical

RULE = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, items, k=10):
    split = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in RULE.findall(t or "")]
    docs = [(d, split(t)) for d, t in rows]
    n_docs, n_terms = sum(1 for _, w in docs if w), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out = []
    for item, text in set(items):
        scored = []
        for d, w in docs:
            if not w:
                continue
            tf, m = Counter(w), 100 - 90 + 90 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (1000000000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in set(split(text)) if tf[t])
            if s > 0:
                scored.append((-s, d is None, d if d is not None else 0))
        out += [(item, r, None if gone else d, -s) for r, (s, gone, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def made(n, seed, words=60):
    rng = random.Random(seed)
    zipf = [f"w{int(words * rng.random() ** 3)}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(zipf) for _ in range(int(3 / (rng.random() + .02))))) for i in range(n)]
    items = [(i, " ".join(rng.choice(zipf) for _ in range(rng.randrange(1, 12)))) for i in range(15)]
    return rows, items


def frames(spark, rows, items):
    return (spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, score int"),
            spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc int"))


@pytest.mark.parametrize("postings", [1, 300, 1 << 20])
def test_against_brute_force(spark, monkeypatch, postings):
    rows, items = made(500, 3)
    rows += [(7, rows[7][1])] * 30 + [(600 + i, "W1, w2.w3\tÉté") for i in range(40)] + [(None, "w1 w2 w3")] * 3
    rows += [(900, None), (901, ""), (902, " -- "), (903, "w4 " * 20000 + "été")]
    items += [(50, "w1 w2 w3 été"), (50, "w1 w2 w3 été"), (50, "w4"), (51, None), (52, "nowhere"), (None, "w5 Été"), (53, "w0 w0 W0")]
    parts = 2

    def run():
        docs, asked = frames(spark, rows, items)
        counts = lexical.search(docs.repartition(parts), asked)
        return sorted(map(tuple, counts.collect()), key=repr)
    if postings > 1:
        monkeypatch.setattr(lexical, "POSTINGS", postings)
    got = run()
    assert got == brute(rows, items)


def test_shards_ties_and_floor():
    """Every document of a score above the k-th is found, in whatever shard, and ties are whole."""
    rng = np.random.default_rng(5)
    for n in (1, 40, 3000):
        have = rng.random((n, 12)) < .3
        value = rng.integers(1, 5, (n, 12)) * have
        doc, term = np.nonzero(have)
        shard = lexical.Shard(doc, term, value[doc, term], n, 12)
        for of in ([0], [1, 5], list(range(12)), []):
            of = np.array(of, np.int64)
            score = value[:, of].sum(axis=1)
            for floor in (0, 3, 10 ** 6):
                kth = max(np.sort(score)[-10:].min() if n >= 10 else 0, floor, 1)
                docs, got, _ = shard.best(of, 10, floor)
                assert sorted(docs) == np.flatnonzero(score >= kth).tolist()
                assert (got == score[docs]).all() and not shard.seen.any()


def test_stops_before_the_end_of_the_lists():
    n = 20000
    value = np.stack([np.arange(n, 0, -1), np.arange(n, 0, -1)], axis=1)
    doc, term = np.nonzero(value)
    docs, _, read = lexical.Shard(doc, term, value[doc, term], n, 2).best(np.array([0, 1]), 10, 0)
    assert set(range(10)) <= set(docs.tolist()) and read <= 4 * lexical.STEP


def test_blocks_and_empty(spark, monkeypatch):
    rows, items = made(60, 4)
    docs, asked = frames(spark, rows, items)
    monkeypatch.setattr(lexical, "BLOCK", 100)
    assert sorted(map(tuple, lexical.search(docs, asked, k=3).collect()), key=repr) == brute(rows, items, 3)
    assert lexical.search(docs.limit(0), asked).count() == 0
    assert lexical.search(docs, asked.limit(0)).count() == 0
