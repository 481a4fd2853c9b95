"""Invariants of the operators on the driver's tables."""

import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL, py_token_regex
from tunemill.config import SftConfig, TOKEN_PATTERN
from tunemill.operators import retrieval as rt
from tunemill.operators import sampling as smp
from tunemill.operators import templates as tpl
from tunemill.operators import tokens as tk
from tunemill.plans import catalog as cat


def test_encode_invariants(spark):
    ex = cat.rendered_pairs(spark, SF_ORACLE)
    cfg = cat.CFG
    enc = tk.encode_examples(ex, cat.dialogue_vocab(spark, SF_ORACLE), cfg).collect()
    assert len(enc) == 233
    for e in enc:
        assert len(e.input_ids) == len(e.labels) == len(e.attention_mask) == cfg.max_len
        loss = sum(1 for x in e.labels if x != -100)
        assert loss + min(e.prompt_len, e.length) == e.length  # mask + loss = real tokens
        assert sum(e.attention_mask) == e.length == min(e.n_tokens, cfg.max_len)


def test_prefix_property_of_tokenizer(spark):
    """tokens(prompt + answer) == tokens(prompt) ++ tokens(answer) for every row."""
    tok = py_token_regex()
    for tpl_name in ("inst", "alpaca"):
        ex = tpl.render(cat.chat_examples(spark, SF_ORACLE), tpl_name).collect()
        for r in ex:
            assert tok.findall(r.prompt + r.answer) == tok.findall(r.prompt) + tok.findall(r.answer)


def test_subset_monotone(spark):
    ex = cat.all_examples(spark, SF_SMALL)
    small = {(r.source, r.example_id) for r in smp.subset_pct(ex, 10, 42).collect()}
    big = {(r.source, r.example_id) for r in smp.subset_pct(ex, 60, 42).collect()}
    assert small < big


def test_global_index_equals_row_number(spark):
    o = spark.read.parquet(f"{SF_ORACLE}/orders.parquet").select("o_orderkey")
    key = smp.seeded_key(42, "o_orderkey")
    got = {r.o_orderkey: r.idx for r in smp.global_index(o, key, "o_orderkey", (), 2).collect()}
    w = Window.orderBy(key, "o_orderkey")
    exp = {r.o_orderkey: r.idx for r in o.select("o_orderkey", (F.row_number().over(w) - 1)
                                                   .alias("idx")).collect()}
    assert got == exp


def test_decode_encode_roundtrip(spark):
    ex = cat.rendered_pairs(spark, SF_SMALL).withColumn("text", F.concat("prompt", "answer"))
    vocab = tk.build_vocab(ex, ["text"], 100000)  # covers every token
    t = ex.select("example_id", tk.tokenize("text").alias("tok"))
    enc = tk.encode_tokens(t, "tok", vocab, "ids")
    dec = tk.decode_ids(enc.select("example_id", "ids"), "ids", vocab, "d",
                        skip_special=False)
    tok = py_token_regex()
    want = {r.example_id: " ".join(tok.findall(r.text)) for r in ex.collect()}
    assert {r.example_id: r.d for r in dec.collect()} == want


def test_retrieval_blocks_make_no_difference(spark, monkeypatch):
    import numpy as np
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    q = rt.mean_vectors(e, "label")
    a = sorted(tuple(r) for r in rt.retrieve_topk(q, e, 5).collect())
    monkeypatch.setattr(rt, "CELLS", 60)
    monkeypatch.setattr(rt, "QUERIES", 3)
    assert a == sorted(tuple(r) for r in rt.retrieve_topk(q, e, 5).collect())
    rows = e.collect()
    ids = np.array([r.vec_id for r in rows])
    m = np.array([r.embedding for r in rows], np.float64)
    label = np.array([r.label for r in rows])
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    for k in set(label.tolist()):
        sims = np.round(unit(m) @ unit(m[label == k].mean(0)), 6)
        best = sorted(zip(-sims, ids))[:5]
        assert [x[1] for x in a if x[0] == k and x[3] == 1] == [best[0][1]]
    assert rt.retrieve_topk(q.limit(0), e, 5).count() == 0 == rt.retrieve_topk(q, e.limit(0), 5).count()


def test_pad_falls_back_to_eos(spark):
    cfg = SftConfig(max_len=64, vocab_size=100, pad_id=None)
    assert cfg.effective_pad_id == cfg.eos_id
    ex = cat.rendered_pairs(spark, SF_SMALL).limit(3)
    e = tk.encode_examples(ex, tk.build_vocab(ex, ["prompt", "answer"], 100), cfg).collect()
    for r in e:
        assert all(x == cfg.eos_id for x in r.input_ids[r.length:])


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(min_value=-10**6, max_value=10**6), min_size=0, max_size=300,
                     unique=True),
       groups=st.integers(min_value=1, max_value=3), prefix=st.integers(min_value=1, max_value=3))
def test_global_index_matches_row_number_random(spark, keys, groups, prefix):
    rows = [(k % groups, k) for k in keys]
    df = spark.createDataFrame(rows, "g long, k long")
    key = smp.seeded_key(7, "k")
    got = {r.k: (r.idx, r.group_n) for r in smp.global_index(df, key, "k", ["g"], prefix).collect()}
    w = Window.partitionBy("g").orderBy(key, "k")
    exp = {r.k: (r.idx, r.n) for r in df.select(
        "k", (F.row_number().over(w) - 1).alias("idx"),
        F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n")).collect()}
    assert got == exp


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ties=st.integers(min_value=2, max_value=40))
def test_global_index_breaks_equal_keys_by_tie_column(spark, ties):
    """Equal order keys (same md5 input) are ordered by the tie column."""
    df = spark.range(ties).select(F.lit("same").alias("v"), F.col("id"))
    got = [r.id for r in smp.global_index(df, F.md5("v"), "id", (), 2).orderBy("idx").collect()]
    assert got == list(range(ties))


def test_external_tokenizer_file_equals_vocab_tokenizer(spark, tmpdir_path):
    """X2 from a serialized tokenizer.json gives the same ids as the tokenizer
    built from the vocabulary table, and the prefix check holds on every row."""
    import os
    from functools import partial

    from tunemill.operators import udfs
    from tunemill.sources.io import write_table
    ex = cat.rendered_pairs(spark, SF_SMALL).select(
        "example_id", "prompt", F.concat("prompt", "answer").alias("text"))
    vpath = write_table(tk.build_vocab(ex, ["text"], 300), os.path.join(tmpdir_path, "vocab"))
    tok_file = os.path.join(tmpdir_path, "tokenizer.json")
    udfs.word_level_tokenizer_from_vocab(vpath).save(tok_file)
    a = udfs.encode_external(ex, "example_id", "text",
                             partial(udfs.word_level_tokenizer_from_vocab, vpath), prompt_col="prompt")
    b = udfs.encode_external(ex, "example_id", "text",
                             partial(udfs.tokenizer_from_file, tok_file), prompt_col="prompt")
    ra = sorted((r.example_id, tuple(r.ids), r.prompt_len, r.prefix_ok) for r in a.collect())
    rb = sorted((r.example_id, tuple(r.ids), r.prompt_len, r.prefix_ok) for r in b.collect())
    assert ra == rb and all(r[3] for r in ra) and len(ra) == ex.count()
