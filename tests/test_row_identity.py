"""Repeated and null ids: no row is lost, doubled or merged."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunemill.config import SftConfig
from tunemill.operators import sampling as smp
from tunemill.plans.training_set import build_training_set

EX = "source string, example_id string, instruction string, input string, output string"


def test_every_copy_is_in_the_shards(spark):
    rows = [("s", "1", "q", "", "a"), ("s", "1", "q", "", "a"), ("s", "2", "q", "", "b"), ("s", None, "q", "", "c"),
            ("s", None, "q", "", "c"), ("s", None, "q", "", "d"), ("s", "1", "other", "", "a"), ("t", "1", "q", "", "a"), ("s", "9", "", "", "x")]
    hot = [("s", "h", "q", "", "same")] * 300
    df = spark.createDataFrame(rows + hot, EX).repartition(5)
    cfg = SftConfig(max_len=32, vocab_size=50, epochs=2, batch_size=4, world_size=2)
    for shuffle in (True, False):
        ts = build_training_set(spark, [df], cfg.with_(shuffle=shuffle))
        out = spark.read.parquet(ts.shards_path)
        for e in range(2):
            got = out.where(F.col("epoch") == e).collect()
            assert sorted(r.pos for r in got) == list(range(308))
            assert Counter((r.source, r.example_id) for r in got) == Counter((s, i) for s, i, q, _, _ in rows + hot if q)
        assert spark.read.parquet(ts.rejected_path).count() == 1
    half = build_training_set(spark, [df.where("source = 's'"), df.where("source = 't'")], cfg.with_(train_pct=50.0, epochs=1))
    assert Counter(r.source for r in spark.read.parquet(half.shards_path).collect()) == {"s": 307 // 2}


@pytest.mark.parametrize("few,digits", [(4096, 4), (1, 1), (3, 2)])
def test_subset_by_radix_selection_equals_numbering(spark, few, digits):
    rng = random.Random(few)
    rows = [(rng.choice(["a", "b", None]), str(i) if i % 7 else None, f"t{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "source string, example_id string, text string")
    for pct in (0.0, 0.1, 12.5, 50.0, 99.99, 100.0):
        old = smp.subset_pct(df.where("example_id is not null"), pct, 7).select("source", "example_id").collect()
        new = smp.subset_exact(df.where("example_id is not null"), pct, 7, few=few, digits=digits).collect()
        assert Counter((r.source, r.example_id) for r in new) == Counter(map(tuple, old))
        tied = smp.subset_exact(df, pct, 7, few=few, digits=digits, tie=("text",)).collect()
        want = {s: int(n * pct / 100) for s, n in Counter(r[0] for r in rows).items()}
        assert Counter(r.source for r in tied) == Counter({s: n for s, n in want.items() if n})


def test_alike_rows_and_many_groups_are_numbered(spark):
    df = spark.createDataFrame([("a", "x")] * 50 + [("b", str(i)) for i in range(10)], "source string, example_id string")
    got = smp.subset_exact(df, 30.0, 1, few=5, digits=3)
    assert got.columns == ["source", "example_id"]
    assert Counter(r.source for r in got.collect()) == {"a": 15, "b": 3}
    assert Counter(r.source for r in smp.subset_exact(df, 30.0, 1, max_groups=1).collect()) == {"a": 15, "b": 3}
    assert smp.subset_exact(df.limit(0), 30.0, 1).count() == 0
    assert "Window" not in smp.subset_exact(df.where("source = 'b'"), 30.0, 1)._jdf.queryExecution().executedPlan().toString()


def test_a_stopped_build_goes_on(spark, tmpdir_path, monkeypatch):
    """A write that breaks off: the second start writes the missing runs only and the shards equal those of one go."""
    from tunemill.plans import training_set as ts_mod
    rows = [("s", str(i), f"q {i}", "", f"a {i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, EX).repartition(3)
    cfg = SftConfig(max_len=32, vocab_size=50, epochs=2, batch_size=2, grad_accum=2, world_size=2)
    whole = build_training_set(spark, [df], cfg, rows_per_file=10)
    want = sorted(map(repr, spark.read.parquet(whole.shards_path).collect()))
    wrote, real = [], ts_mod._write_runs

    def breaks(plan, enc, cfg, paths):
        if len(wrote) == 3:
            # half a run is left in place without an entry
            plan.limit(1).join(enc, "row_id").select("epoch", "rank", "run", "pos").write.mode("append").partitionBy(
                "epoch", "rank", "run").parquet(paths.shards_path)
            raise RuntimeError("stopped")
        wrote.append(plan.count())
        real(plan, enc, cfg, paths)
    monkeypatch.setattr(ts_mod, "_write_runs", breaks)
    out = f"{tmpdir_path}/shards"
    with pytest.raises(RuntimeError, match="stopped"):
        build_training_set(spark, [df], cfg, out, rows_per_file=10, runs_per_commit=2)
    monkeypatch.setattr(ts_mod, "_write_runs", lambda *a: (wrote.append(a[0].count()), real(*a)))
    before = spark.read.parquet(f"{out}-manifest").agg(F.sum("rows")).first()[0]
    ts = build_training_set(spark, [df], cfg, out, rows_per_file=10, runs_per_commit=2, resume=True)
    assert before == 60 and sum(wrote[3:]) == 60
    assert sorted(map(repr, spark.read.parquet(ts.shards_path).select(spark.read.parquet(whole.shards_path).columns).collect())) == want
    manifest = spark.read.parquet(ts.manifest_path)
    assert manifest.agg(F.sum("rows")).first()[0] == 120 and manifest.count() == manifest.select("epoch", "rank", "run").distinct().count()
    once = spark.read.parquet(whole.manifest_path)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, manifest.select(once.columns).collect()))
    mid = ts_mod.read_shards(spark, ts, from_step=4)
    assert sorted((r.epoch, r.pos) for r in mid.collect()) == sorted(
        (r.epoch, r.pos) for r in spark.read.parquet(whole.shards_path).collect() if r.step >= 4)
    assert {r.epoch for r in ts_mod.read_shards(spark, ts, epoch=1).collect()} == {1}
    assert ts_mod.read_shards(spark, ts, from_step=10 ** 6).count() == 0
    with pytest.raises(ValueError, match="other parameters"):
        build_training_set(spark, [df], cfg.with_(seed=1), out, rows_per_file=10, runs_per_commit=2, resume=True)
