import hashlib
import random
import zlib

import numpy as np
import pytest

from tunemill.llm import periodic


def brute_runs(w, least=12):
    """All stretches that hold a period and are extended by no neighbour, with their smallest period."""
    found, n = set(), len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                s, size = i, j + q - i
                if not any(all(w[x] == w[x + r] for x in range(s, s + size - r)) for r in range(1, q)):
                    found.add((s, size, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("least", [2, 3, 7, 12])
def test_runs_against_brute_force(least):
    rng = random.Random(least)
    for _ in range(400):
        w = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(1, 60))]
        if rng.random() < .5:
            p = rng.randrange(1, 9)
            w += [w[-p:][i % p if len(w) >= p else 0] for i in range(rng.randrange(40))]
        assert sorted(periodic.runs_of(np.array(w), least), key=lambda r: (r[0], r[2])) == brute_runs(w, least), w


def test_lcp_levels():
    w = np.array([1, 2, 1, 2, 1, 2, 3])
    order, levels = periodic.suffix_order(w)
    assert [w[i:].tolist() for i in order] == sorted(w[i:].tolist() for i in range(7))
    assert periodic.common_prefixes(order[:-1], order[1:], levels).tolist() == [4, 2, 0, 3, 1, 0]


def test_op13_against_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t ", "one", "a " * 5000, "x y " * 3000, "\xa0w " * 30, "ü v " * 40, "a b c a b c\n" * 4]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(80))) for _ in range(200)]
    texts += ["\x0b".join(f"w{rng.randrange(40)}" for _ in range(300)) * 2 for _ in range(20)]
    rows = list(enumerate(texts)) + [(None, "a b " * 9), (None, None), (3, "a b " * 9), (5, "x y " * 3000), (5, "x y " * 3000)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, runs int")
    short = [r for r in rows if r[1] is None or len(r[1]) < 3000]
    got = sorted(map(tuple, periodic.op13(docs.where("text is null or length(text) < 3000")).collect()), key=repr)
    assert got == sorted((brute_row(*r) for r in short), key=repr)
    long = {r.doc_id: r for r in periodic.op13(docs.where("length(text) >= 3000")).collect()}
    assert (long[4].n_runs, long[4].length, long[4].period, long[4].exponent_milli) == (1, 5000, 1, 5000000)
    assert long[5].n_runs >= 1


def test_columns_and_empty(spark):
    docs = spark.createDataFrame([("a a a", 7, "q")], "text string, runs int, Collapsed string")
    out = periodic.find_runs(docs, min_words=2)
    assert out.columns == ["text", "runs", "Collapsed", "n_words", "runs_1", "collapsed_1"]
    assert out.first()[3:] == (3, [(0, 3, 1)], "a")
    assert periodic.find_runs(docs.limit(0)).count() == 0


def test_stretches_do_not_change_results(spark, monkeypatch):
    import pyarrow as pa
    texts = pa.array(["a b " * 20, None, "c d e " * 30, "", "a b " * 20])
    whole = [list(periodic.collapse(s, 12)) for s in periodic.stretches(texts)]
    monkeypatch.setattr(periodic, "WORDS", 10)
    parts = [list(periodic.collapse(s, 12)) for s in periodic.stretches(texts)]
    assert len(whole) == 1 and len(parts) == 5
    assert sum(parts, []) == whole[0]
