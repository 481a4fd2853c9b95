"""Chat history: batch form against its plain definition,
golden eviction cases, and the stream against the batch form."""

import os
import time

import pytest
import regex
from pyspark.sql import functions as F

from conftest import SF_ORACLE, py_token_regex
from tunemill.config import (HISTORY_OTHER_TAIL, HISTORY_USER_HEAD, HISTORY_USER_TAIL,
                             TOKEN_PATTERN)
from tunemill.operators import history as hist
from tunemill.streaming.history_stream import run_history_stream

TOK = py_token_regex()


def n_tok(s):
    return len(TOK.findall(s))


def render(messages):
    """The rendered text of (turn, role, text) messages."""
    forms = {True: (HISTORY_USER_HEAD, HISTORY_USER_TAIL), False: ("", HISTORY_OTHER_TAIL)}
    return "".join(m.strip().join(forms[role == "user"]) for _, role, m in messages)


def brute_force(turns, budget, align=False):
    """By definition: a user turn keeps the longest run of messages that ends with it and
    fits the budget, or itself alone; the chat ends before its first blank user message."""
    chats, out = {}, {}
    for conv, *message in sorted(turns, key=lambda t: t[:2]):
        chats.setdefault(conv, []).append(tuple(message))
    for conv, messages in chats.items():
        blank = [i for i, (_, role, text) in enumerate(messages) if role == "user" and not text.strip()]
        messages = messages[:min(blank, default=len(messages))]
        for last, (turn, role, _) in enumerate(messages):
            if role != "user":
                continue
            first = last
            while first and n_tok(render(messages[first - 1:last + 1])) <= budget:
                first -= 1
            kept = messages[first:last + 1]
            if align:
                kept = kept[[m[1] for m in kept].index("user"):]
            out[conv, turn] = (kept[0][0], len(kept), render(kept))
    return out


def batch(spark, df, budget, align=False):
    return {(r.conv_id, r.turn): (r.start_turn, r.n_messages, r.prompt)
            for r in hist.history_budget(df, budget, align).collect()}


@pytest.fixture(scope="module")
def conv(spark):
    return spark.read.parquet(f"{SF_ORACLE}/conversations.parquet")


@pytest.mark.parametrize("budget", [64, 128, 256, 896])
def test_history_equals_definition(spark, conv, budget):
    rows = [tuple(r) for r in conv.select("conv_id", "turn", "role", "text").collect()]
    assert batch(spark, conv, budget) == brute_force(rows, budget)


def test_align_to_user(spark, conv):
    rows = [tuple(r) for r in conv.select("conv_id", "turn", "role", "text").collect()]
    got = batch(spark, conv, 128, align=True)
    assert got == brute_force(rows, 128, align=True)
    assert all(p.startswith("<s>[INST]") for _, _, p in got.values())


GOLD = [
    (1, 0, "user", "a " * 20), (1, 1, "assistant", "b b"), (1, 2, "user", "c"),  # over budget alone
    (2, 0, "user", "x"), (2, 1, "assistant", "y y y y"), (2, 2, "user", "z"),  # exact budget
    (3, 0, "user", "q"), (3, 1, "assistant", "r"), (3, 2, "user", "  "),  # blank user ends it
    (3, 3, "assistant", "never"), (3, 4, "user", "never"),
]


def test_golden_eviction(spark):
    df = spark.createDataFrame(GOLD, "conv_id long, turn long, role string, text string")
    # conv 2: tokens 4 + 5 + 4 = 13
    got = batch(spark, df, 13)
    assert got == brute_force(GOLD, 13)
    assert got[(1, 0)][:2] == (0, 1)          # single message over budget kept whole
    assert got[(2, 2)][:2] == (0, 3)          # budget hit exactly: nothing dropped
    assert batch(spark, df, 12)[(2, 2)][:2] == (1, 2)  # one over: starts at the assistant
    assert (3, 4) not in got and (3, 0) in got
    assert [r.turn for r in hist.chat_cut(df).where("conv_id = 3").orderBy("turn").collect()] == [0, 1]


def test_blocks_do_not_change_histories(spark, conv, monkeypatch):
    """A conversation in many blocks, with gaps, negative turns and a blank user turn in a late block."""
    turns = "conv_id long, turn long, role string, text string"
    rows = [(1, t, ("user", "assistant", "system")[t % 3], f"w {t} " * (t % 5 + 1)) for t in range(-30, 90) if t % 7]
    rows += [(2, t, "user", "x" if t != 50 else " \t") for t in range(0, 80, 2)]
    df = spark.createDataFrame(rows, turns)
    monkeypatch.setattr(hist, "BLOCK", 8)
    assert batch(spark, df, 40) == brute_force(rows, 40)
    assert {(r.conv_id, r.turn) for r in hist.chat_cut(df).collect()} == {(c, t) for c, t, _, _ in rows if c == 1 or t < 50}
    assert batch(spark, conv, 128) == brute_force([tuple(r) for r in conv.collect()], 128)


BAD = [(1, 0, "user", "a b"), (1, 0, "user", "a b"), (1, 1, "assistant", "c"), (1, 1, "user", "later role"), (1, 2, "user", "d"),
       (None, 0, "user", "x"), (None, 1, "assistant", "y"), (2, None, "user", "z"), (2, 0, "user", "q"), (None, None, "user", "n"),
       (2, 1, None, "no role"), (2, 2, "user", None), (2, 3, "user", "after")]
KEPT = [(1, 0, "user", "a b"), (1, 1, "assistant", "c"), (1, 2, "user", "d"), (2, 0, "user", "q"), (2, 1, "", "no role")]


def test_repeated_and_null_turns(spark, tmpdir_path):
    """One message per turn number; what is left out is listed, by the batch form and by the stream."""
    df = spark.createDataFrame(BAD, "conv_id long, turn long, role string, text string")
    want = brute_force(KEPT, 128)
    got = batch(spark, df, 128)
    assert got == want
    reasons = sorted(r.reason for r in hist.unused_turns(df).collect())
    assert reasons == ["no conversation"] * 2 + ["no conversation; no turn number", "no turn number"] + ["repeated turn"] * 2
    from tunemill.streaming.history_stream import read_late, whole_history
    src, sink = os.path.join(tmpdir_path, "t"), os.path.join(tmpdir_path, "sink")
    df.repartition(3).write.parquet(src)
    run_history_stream(spark, src, 128, sink=sink)
    late = sorted(r.reason.replace("late", "repeated") for r in read_late(spark, sink).collect())  # by the order of arrival
    assert late == ["no conversation"] * 2 + ["no conversation; no turn number", "no turn number"] + ["repeated"] * 2
    out = {(r.conv_id, r.turn): (r.start_turn, r.n_messages, r.prompt) for r in whole_history(spark, src, sink, 128).collect()}
    assert out == got


def test_stream_equals_batch_split_triggers(spark, conv, tmpdir_path):
    src = os.path.join(tmpdir_path, "turns")
    conv.where("turn < 3").coalesce(1).write.parquet(os.path.join(src, "part_a"))
    conv.where("turn >= 3").coalesce(1).write.parquet(os.path.join(src, "part_b"))
    files = sorted(os.path.join(dp, f) for dp, _, fs in os.walk(src) for f in fs
                   if f.endswith(".parquet"))
    flat = os.path.join(tmpdir_path, "flat")
    os.makedirs(flat)
    for i, f in enumerate(files):  # trigger order follows file order
        os.link(f, os.path.join(flat, f"{i:03d}.parquet"))
        os.utime(os.path.join(flat, f"{i:03d}.parquet"), (1_000_000 + i, 1_000_000 + i))
    out = run_history_stream(spark, flat, 128, files_per_trigger=1)
    got = {(r.conv_id, r.turn): (r.start_turn, r.n_messages, r.prompt) for r in out.collect()}
    assert got == batch(spark, conv, 128)


def test_stream_with_idle_timeout_equals_batch(spark, conv, tmpdir_path):
    """A continuous query with a long idle timeout gives the batch result."""
    from tunemill.sources.io import read_turn_stream
    from tunemill.streaming.history_stream import STORE, history_stream
    src = os.path.join(tmpdir_path, "t")
    conv.coalesce(1).write.parquet(src)
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    out = history_stream(read_turn_stream(own, src), 128, idle_timeout_ms=3_600_000)
    q = (out.writeStream.format("memory").queryName("hist_idle").outputMode("append")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
         .trigger(processingTime="1 second").start())
    want = batch(spark, conv, 128)
    try:  # pending timeouts keep the query busy: wait for the rows, bounded
        deadline = time.time() + 180
        while own.table("hist_idle").count() < len(want) and time.time() < deadline:
            time.sleep(1)
    finally:
        q.stop()
    got = {(r.conv_id, r.turn): (r.start_turn, r.n_messages, r.prompt)
           for r in own.table("hist_idle").collect()}
    assert got == want


def test_stream_goes_on_from_a_batch_state(spark, tmpdir_path):
    """Any cut between backlog and stream, restarts, evictions, an ended chat; the state holds a budget, not the conversation."""
    from tunemill.streaming.history_stream import history_state, read_history, run_history_stream
    rows = [(1, t, ("user", "assistant")[t % 2], f"w {t} " * (t % 5 + 1)) for t in range(600)]
    rows += [(2, 0, "user", "a"), (2, 1, "user", " "), (2, 2, "user", "never"), (3, 0, "user", "new"), (4, 0, "user", "x " * 100), (4, 1, "user", "y")]
    early = [r for r in rows if r[0] == 1 and r[1] < 333 or r[0] == 2 and r[1] < 2 or r[:2] == (4, 0)]
    schema = "conv_id long, turn long, role string, text string"
    src, sink = os.path.join(tmpdir_path, "t"), os.path.join(tmpdir_path, "sink")
    late = [r for r in rows if r not in early]
    spark.createDataFrame(late[:50], schema).coalesce(1).write.parquet(src)
    state = history_state(spark.createDataFrame(early, schema), 60)
    assert {r.conv_id: (r.ended, r.last_turn) for r in state.collect()} == {1: (False, 332), 2: (True, 1), 4: (False, 0)}
    run_history_stream(spark, src, 60, sink=sink, state=state)
    spark.createDataFrame(late[50:], schema).coalesce(1).write.mode("append").parquet(src)
    run_history_stream(spark, src, 60, sink=sink, state=state)  # goes on where it stopped, the state is not read again
    got = {(r.conv_id, r.turn): (r.start_turn, r.n_messages, r.prompt) for r in read_history(spark, sink).collect()}
    want = brute_force(rows, 60)
    assert got == {k: v for k, v in want.items() if k not in {r[:2] for r in early}}
    own = spark.newSession()
    kept = own.read.format("statestore").option("stateVarName", "history").option("flattenCollectionTypes", "true").load(f"{sink}/checkpoint")
    assert 0 < kept.count() < 60


def test_prompt_len_padded_undercounts_when_pad_is_eos(spark):
    """T8a with pad = end-of-text misses an end-of-text inside the prompt;
    the encode's own prompt length counts before padding."""
    from tunemill.config import SftConfig
    from tunemill.operators import tokens as tk
    df = spark.createDataFrame([(1, "<s>[INST] a </s> b [/INST] ", "c </s>")],
                               "example_id long, prompt string, answer string")
    cfg = SftConfig(max_len=16, vocab_size=20, pad_id=None)
    vocab = tk.build_vocab(df, ["prompt", "answer"], 20)
    t = df.select("example_id", tk.tokenize("prompt").alias("tok"))
    enc = tk.encode_tokens(t, "tok", vocab, "ids")
    row = enc.select(tk.prompt_len_padded(tk.pad_right(F.col("ids"), 16, cfg.effective_pad_id),
                                          cfg.effective_pad_id).alias("a"),
                     F.size("ids").alias("b")).first()
    assert (row.a, row.b) == (5, 6)  # <s> [INST] a </s> b [/INST]
    e = tk.encode_examples(df, vocab, cfg).first()
    assert e.prompt_len == 6
