import hashlib
import random

import numpy as np
import pytest

from tunemill.llm import suffixdedup as sd

N = sd.LENGTH


def brute(rows):
    owner = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - N + 1):
            if d is not None:
                owner[b[i:i + N]] = min(d, owner.get(b[i:i + N], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - N + 1):
            if d is not None and owner[b[i:i + N]] < d:
                gone[i:i + N] = b"\1" * N
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghéß", k=rng.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(40), "All of this is a line that a great many documents hold, word by word."
    rows = [(500, None), (501, ""), (502, "x" * 49), (503, "x" * 50), (504, "x" * 51), (None, passage), (505, "ab" * 400),
            (506, "b" + "ab" * 300 + "c"), (507, "\0" * 120), (508, "\0" * 60 + "q"), (509, line)]
    for i in range(60):
        t = text(rng.randint(5, 120))
        if i % 3 == 0:
            t = t[:50] + passage[rng.randint(0, 60):rng.randint(100, 200)] + t[50:]
        if i % 4 == 0:
            t += "\n" + line + "\n" + text(3)
        if i % 7 == 0:
            t += passage + passage
        rows.append((i, t))
    base = text(150)
    for i in range(40):  # near copies
        w = base.split(" ")
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = word()
        rows.append((100 + i, " ".join(w)))
    rows += [(200 + i, rows[30][1]) for i in range(30)] + [rows[31], (rows[31][0], base)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK", 64), ("FLUSH_HASHES", 500), ("FLUSH_SEGMENTS", 200), ("CHUNK", 50)):
            monkeypatch.setattr(sd, name, value)
    rows = fixture()
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, z int")
    got = sorted(map(tuple, sd.op8(df.repartition(5)).collect()), key=repr)
    assert got == brute(rows)


@pytest.mark.parametrize("wide", [1, 2, 8, 30])
def test_wide_anchors_against_brute_force(spark, wide):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sd.remove_repeats(df, wide=wide)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                  for r in out.collect()), key=repr)
    assert got == brute(rows)


def hot_rows():
    """One string of 20 bytes in a third of all texts, in contexts of their own, and two passages around it."""
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choices("abcdefghij", k=n))
    hot, one, two = "<<a frequent string>", noise(30), noise(30)
    rows = []
    for i in range(1500):
        a, z = (one, two) if i % 50 == 0 else (noise(60), noise(60))
        rows.append((i, a + hot + z if i % 3 == 0 else noise(140)))
    return hot, rows


def test_hot_anchor_in_many_contexts(spark):
    hot, rows = hot_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    shared = sd.shared_hashes(df, "doc_id", "text", 100)
    assert len(sd.widest(shared))
    out = sd.remove_repeats(df, wide=100).collect()
    assert sorted((r.doc_id, len(r.kept), r.n_removed) for r in out) == sorted(
        (d, n - gone, gone) for d, n, gone, _, _ in brute(rows))
    assert any(r.n_removed for r in out)


def test_windows_of_a_hot_anchor_spread():
    hot, rows = hot_rows()
    buckets = 16
    found = [(r, lo, hi, first, np.full(len(lo), d), np.zeros(len(lo), np.int64)) for d, t in rows if hot in t
             for r, lo, hi, first in sd.segments_of(t.encode(), np.unique(sd.piece_hashes(np.frombuffer(hot.encode(), np.uint8)) >> np.uint64(16)))]
    parts = [np.concatenate(x) for x in zip(*found)]
    sent = [len(np.frombuffer(sd.expand(body), np.uint64)) // 2
            for _, kind, _, body in sd.dealt_windows(*parts, buckets) if kind == 2]
    assert len(sent) == buckets and max(sent) < 2 * sum(sent) / buckets


def test_settle_beyond_a_chunk(monkeypatch):
    """An anchor with more segments than a chunk gives the spans that the rounds give."""
    hot, rows = hot_rows()
    shared = np.unique(sd.piece_hashes(np.frombuffer(hot.encode(), np.uint8)) >> np.uint64(16))
    found = [(r, lo, hi, first, np.full(len(lo), d), np.zeros(len(lo), np.int64)) for d, t in rows
             for r, lo, hi, first in sd.segments_of(t.encode(), shared)]
    parts = [np.concatenate(x) for x in zip(*found)]
    by_rounds = sorted(zip(*(x.tolist() for x in sd.settle(*parts))))
    monkeypatch.setattr(sd, "CHUNK", 20)
    assert by_rounds and sorted(zip(*(x.tolist() for x in sd.settle(*parts)))) == by_rounds


def test_ids_that_are_no_integers(spark):
    with pytest.raises(TypeError, match="integer"):
        sd.remove_repeats(spark.createDataFrame([("a", "x")], "doc_id string, text string"))


@pytest.mark.parametrize("owners", [sd.window_owners, sd.hashed_owners])
def test_rounds_find_equal_windows(owners):
    """The column-wise rounds, and the digests, against a dictionary of all windows."""
    rng = np.random.default_rng(0)
    n = 400
    rows = rng.integers(97, 99, (n, sd.COLUMNS)).astype(np.uint8)
    for i in range(1, n):  # copies with single changes
        if rng.random() < 0.8:
            rows[i] = rows[rng.integers(0, i)]
            rows[i, rng.integers(0, sd.COLUMNS)] = 99
    lo = rng.integers(0, sd.OFFSETS, n).astype(np.uint8)
    hi = (lo + rng.integers(N, sd.COLUMNS + 1, n)).clip(max=sd.COLUMNS).astype(np.uint8)
    doc = rng.integers(0, 50, n)
    column = np.arange(sd.COLUMNS)
    rows = np.where((column >= lo[:, None]) & (column < hi[:, None]), rows, 0).astype(np.uint8)
    seen = []
    for c, owner in owners(rows, lo, hi, doc):
        want = {}
        for i in range(n):
            if lo[i] <= c and c + N <= hi[i]:
                w = rows[i, c:c + N].tobytes()
                want[w] = min(int(doc[i]), want.get(w, 10**9))
        for i in range(n):
            ok = lo[i] <= c and c + N <= hi[i]
            assert owner[i] == (want[rows[i, c:c + N].tobytes()] if ok else sd.NO_OWNER)
        seen.append(c)
    assert seen == list(range(sd.OFFSETS - 1, -1, -1))


def test_anchors_are_leftmost_least():
    rng = np.random.default_rng(1)
    for data in (rng.integers(0, 256, 300), rng.integers(97, 99, 300), np.full(200, 97), np.tile([97, 98, 99], 90)):
        b = data.astype(np.uint8)
        h = sd.piece_hashes(b)
        value, place = sd.anchors(h)
        assert (value == sd.least(h)).all() and len(value) == len(b) - N + 1
        for i in range(len(value)):
            assert place[i] == i + int(np.argmin(h[i:i + sd.OFFSETS]))


def test_pack():
    v = np.random.default_rng(2).integers(0, 2**48, 1000).astype(np.uint64)
    assert (sd.unpack48(sd.pack48(v)) == v).all()


def test_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "t" * 60), (2, "b", "t" * 60)], "doc_id long, kept string, text string")
    out = sd.remove_repeats(df)
    assert out.columns == ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_1"]
    assert sorted((r.doc_id, r.kept, r.n_removed, bytes(r.kept_1)) for r in out.collect()) == [
        (1, "a", 0, b"t" * 60), (2, "b", 60, b"")]
    assert sd.remove_repeats(df.limit(0)).count() == 0


def test_query_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, sd.op8(docs).collect()), key=repr) == brute(rows)
