import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from tunemill.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def files():
    return bpe.read_ranks(PATH), bpe.class_table()


def texts():
    rng = random.Random(7)
    alphabet = ["a", "st", "re", "ve", "ll", "s", "t", "'", "'", " ", " ", "\n", "\t", "\x85", "　", "é",
                "漢", "1", "²", "!", "$%", "😀", "́", "\x1c", "՘", "<|endoftext|>", "I'm", "\r\n"]
    out = ["", " ", "  ", "'", "'s", " 's", "''s", "don't we'll", "a  b", "a \n b", "x\n\n", "%" * 5000,
           "ab" * 3000, " " * 4000, "a" + " " * 1500 + "b", "é" * 1100]
    return out + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(1500)]


def test_ids_equal_the_library(library, files):
    ts = texts()
    ids, offsets = bpe.encode_texts([t.encode() for t in ts], *files)
    for t, x, o in zip(ts, ids, offsets):
        assert np.frombuffer(x, "<u4").tolist() == library.encode_ordinary(t), repr(t)
        assert bpe.decode_ids(x, o, files[0]) == t.encode()


def test_scan_equals_stepping():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 64, 65, 1000):
        symbols = rng.integers(0, 2 * bpe.N_SYMBOLS, n).astype(np.uint8)
        state, want = bpe.START, []
        for y in symbols.tolist():
            s = bpe.START if y >= bpe.N_SYMBOLS else state
            state, begins = bpe.step(s, y % bpe.N_SYMBOLS)
            want.append(begins or y >= bpe.N_SYMBOLS)
        assert bpe.match_starts(symbols, block=16).tolist() == want


def test_composition_is_associative():
    *_, compose, funcs = bpe.automaton()
    rng = np.random.default_rng(2)
    a, b, c = rng.integers(0, len(funcs), (3, 500))
    assert (compose[compose[a, b], c] == compose[a, compose[b, c]]).all()


def test_cache_stays_bounded(files, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    ranks = {bytes([i]): i for i in range(256)}
    cache = bpe.PieceCache(ranks)
    for i in range(1000):
        assert cache[b"%d" % i] == np.frombuffer(b"%d" % i, np.uint8).astype("<u4").tobytes()
        assert len(cache) <= 10 and len(cache.older) <= 10
    cache[b"x" * 1000]
    assert b"x" * 1000 not in cache


def test_too_many_ranks(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_RANKS", 1)
    f = tmp_path / "v"
    f.write_bytes(b"YQ== 0\nYg== 1\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(f))


def test_rows(spark, library):
    rows = [(1, "don't  stop", "x"), (1, "don't  stop", "x"), (2, None, None), (None, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.round_trip(df, PATH)
    assert out.columns == ["doc_id", "text", "ids", "ids_1", "offsets", "decoded"]
    got = sorted((r.text or "", np.frombuffer(r.ids_1, "<u4").tolist(), bytes(r.decoded)) for r in out.collect())
    want = sorted((t or "", library.encode_ordinary(t or ""), (t or "").encode()) for _, t, _ in rows)
    assert got == want
    assert bpe.round_trip(df.limit(0), PATH).count() == 0


def test_query_on_the_table(spark, library):
    import hashlib
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in bpe.op10(spark, docs, PATH).collect()}
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
