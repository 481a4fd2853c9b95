import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from test_jaccard import brute as brute_groups
from test_linededup import brute as brute_lines
from test_mixing import brute_targets

import corpus_pipeline as cp
from tunemill.llm.common import cut, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, SF, "documents")]
    for name, f in cp.STAGES:
        out.append(cut(f(spark, out[-1], SF), name))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
        assert [f.dataType for f in df.schema] == [f.dataType for f in stages[0].schema]


def test_language(stages):
    before, after = stages[0].collect(), stages[1].collect()
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert not any(r.doc_id in gone and r.text and any(c.isalpha() for c in r.text) and len(r.text) > 30 for r in before)
    kept = Counter(after)
    assert all(n <= 1 for n in (kept - Counter(before)).values()) and not kept - Counter(before)


def test_lines(stages):
    want = {x[0]: x[3] for x in brute_lines(texts(stages[1]))}
    got = stages[2].collect()
    assert {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)


def test_near_copies(stages):
    before = texts(stages[2])
    found = brute_groups(before, 5, 4, 5)
    want = {d for d, n, c in found if not n or d == c}
    assert sorted(d for d, _ in texts(stages[3])) == sorted(want)
    assert set(texts(stages[3])) <= set(before)


def test_mix(stages):
    before, after = stages[3].collect(), stages[4].collect()
    size = lambda t: len([w for w in (t or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w])
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += size(r.text)
    for r in after:
        taken[r.source] += size(r.text)
    assert set(after) <= set(before)
    assert max(Counter(after).values()) <= 3
    longest = max(size(r.text) for r in before)
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= longest + 100


def test_tokens(stages):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((d, enc.encode_ordinary(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in texts(stages[4]))
    got = sorted((r.doc_id, np.frombuffer(r["ids"], "<u4").tolist(), r.decoded_sha256) for r in stages[5].collect())
    assert got == want


def test_run_equals_stages(spark, stages):
    got = cp.run(spark, SF).select("doc_id", "n_tokens", "decoded_sha256").collect()
    assert Counter(got) == Counter(stages[5].select("doc_id", "n_tokens", "decoded_sha256").collect())
