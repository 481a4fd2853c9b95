"""Hot keys: one conversation holding a third of all turns, one source holding
most examples. Results must stay exact (no rows dropped or capped)."""

import os
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from test_history import batch, brute_force
from tunemill.operators import sampling as smp
from tunemill.sources.examples import dialogue_pairs
from tunemill.streaming.history_stream import read_late, run_history_stream


def skewed_turns(spark):
    base = spark.read.parquet(f"{SF_ORACLE}/conversations.parquet")
    n = base.count()
    # conversation 10**6: the base texts repeated as one long chat (~n/2 turns)
    texts = base.where("role <> 'system'").select("text")
    hot = texts.select(F.lit(10 ** 6).cast("long").alias("conv_id"),
                       (F.row_number().over(Window.orderBy(F.md5("text"), "text")) - 1)
                       .cast("long").alias("turn"), "text")
    hot = hot.withColumn("role", F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant"))
    turns = base.unionByName(hot.select("conv_id", "turn", "role", "text"))
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert sum(1 for r in rows if r[0] == 10 ** 6) * 3 >= n
    return turns, rows


def test_hot_conversation_pairs_and_history(spark):
    turns, rows = skewed_turns(spark)
    pairs = {(r.conv_id, r.turn) for r in dialogue_pairs(turns, keep_turn_cols=True).collect()}
    by = {(c, t): (r, x) for c, t, r, x in rows}
    want = {(c, t) for (c, t), (r, _) in by.items()
            if r == "user" and by.get((c, t + 1), ("", ""))[0] == "assistant"}
    assert pairs == want
    few = {(r.conv_id, r.turn) for r in dialogue_pairs(turns, keep_turn_cols=True, block=3).collect()}
    assert few == want
    assert batch(spark, turns, 128) == brute_force(rows, 128)


def test_hot_source_exact_subset(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") < 19000, "hot").otherwise("cold").alias("source"),
        F.col("id").alias("example_id"))
    got = {r.source: r.n for r in smp.subset_pct(df, 12.5, 42, prefix_hex=2)
           .groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"hot": int(19000 * 12.5 / 100), "cold": int(1000 * 12.5 / 100)}


SCHEMA = "conv_id long, turn long, role string, text string"


def files(spark, folder, parts, start=0):
    """One parquet file per part in ``folder/src``, in order of time."""
    src = os.path.join(folder, "src")
    os.makedirs(src, exist_ok=True)
    for i, part in enumerate(parts, start):
        out = os.path.join(folder, f"w{i}")
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(out)
        f = [x for x in os.listdir(out) if x.endswith(".parquet")][0]
        os.link(os.path.join(out, f), os.path.join(src, f"{i:03d}.parquet"))
        os.utime(os.path.join(src, f"{i:03d}.parquet"), (1_000_000 + i, 1_000_000 + i))
    return src


def test_stream_waits_for_late_turns_and_lists_the_rest(spark, tmpdir_path):
    first = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 3, "user", "d"), (2, 5, "user", "x")]
    then = [(1, 2, "assistant", "c"), (1, 4, "assistant", "e"), (1, 5, "user", "f"), (1, 5, "user", "f")]
    src = files(spark, tmpdir_path, [first, then])
    for hold, want, late in (
            (64, {(1, 0): (0, 1), (1, 3): (0, 4), (1, 5): (0, 6)}, {(1, 5, "repeated")}),
            (0, {(1, 0): (0, 1), (1, 3): (0, 3), (1, 5): (0, 5), (2, 5): (5, 1)}, {(1, 2, "late"), (1, 5, "repeated")})):
        sink = os.path.join(tmpdir_path, f"sink{hold}")
        got = run_history_stream(spark, src, 1000, files_per_trigger=1, sink=sink, hold=hold)
        assert {(r.conv_id, r.turn): (r.start_turn, r.n_messages) for r in got.collect()} == want
        assert {tuple(r) for r in read_late(spark, sink).collect()} == late


def test_stream_stops_and_goes_on(spark, tmpdir_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    random.Random(1).shuffle(rows)
    parts = [rows[i::8] for i in range(8)]
    sink = os.path.join(tmpdir_path, "sink")
    src = files(spark, tmpdir_path, parts[:5])
    some = run_history_stream(spark, src, 128, sink=sink).count()
    files(spark, tmpdir_path, parts[5:], 5)
    got = run_history_stream(spark, src, 128, sink=sink).collect()
    assert some < len(got)
    assert {(r.conv_id, r.turn): (r.start_turn, r.n_messages, r.prompt) for r in got} == brute_force(rows, 128)
    assert read_late(spark, sink).count() == 0


def test_registered_stream_is_whole(spark, tmpdir_path):
    """Over 1,000 turns in one conversation, gaps, and a first turn other than 0: all as in the batch form."""
    from tunemill.operators.history import history_budget
    from tunemill.plans import catalog
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} " + "word " * 40) for t in range(1200)]
    rows += [(2, t, "user", f"gap {t}") for t in (0, 1, 5, 6, 9)] + [(3, 4, "user", "x"), (3, 5, "assistant", "y")]
    rows += [(4, t, "user", f"in order {t}") for t in range(5)]
    turns = spark.createDataFrame(rows, SCHEMA)
    turns.coalesce(1).write.parquet(os.path.join(tmpdir_path, "conversations.parquet"))
    got = catalog.history_stream(spark, tmpdir_path)
    want = history_budget(turns, catalog.CFG.history_budget)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 600 + 5 + 1 + 5


def test_registered_seeded_stream_is_whole(spark, tmpdir_path):
    """From a backlog: more turns wait than the stream holds, gaps, no first half, repeated turns on either side,
    a blank user row that does not count, an ended chat: all as in the batch form."""
    from tunemill.operators.history import history_budget
    from tunemill.plans import catalog
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} " + "word " * 40) for t in range(1200)]
    rows += [(2, t, "user", f"gap {t}") for t in (0, 1, 5, 6, 9)] + [(3, 4, "user", "x"), (3, 5, "user", "y")]
    rows += [(4, t, "user", f"in order {t}") for t in range(5)]
    rows += [(5, t, "user", x) for t, x in ((0, "a"), (1, "b"), (2, "d"), (2, "c"), (3, "e"))]
    rows += [(6, 0, "user", "a"), (6, 1, "assistant", "counts"), (6, 1, "user", " "), (6, 2, "user", "b"), (6, 3, "user", "c")]
    rows += [(7, t, "user", x) for t, x in ((0, "a"), (1, " "), (2, "never"), (3, "never"))]
    rows += [(8, t, "user", f"{t}") for t in (0, 1, 2, 3, 3, 5)] + [(8, None, "user", "x"), (None, 1, "user", "y")]
    turns = spark.createDataFrame(rows, SCHEMA)
    turns.coalesce(1).write.parquet(os.path.join(tmpdir_path, "conversations.parquet"))
    got = catalog.history_seeded(spark, tmpdir_path)
    want = history_budget(turns, catalog.CFG.history_budget)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 600 + 5 + 2 + 5 + 4 + 3 + 1 + 5
