"""Rows that plain data lacks: gaps, long conversations, null keys, repeated rows."""

from pyspark.sql import functions as F

from tunemill.config import SftConfig
from tunemill.operators import evaluate as ev
from tunemill.operators import sampling as smp
from tunemill.operators import templates as tpl
from tunemill.operators import tokens as tk
from tunemill.operators import validate as val
from tunemill.plans.training_set import assign_example_ids, build_training_set, examples_from_json
from tunemill.sources.examples import dialogue_pairs, role_prompts
from tunemill.sources.io import write_instruction_json

TURNS = "conv_id long, turn long, role string, text string"


def test_pairs_over_gaps_and_many_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 2, "assistant", "b"), (1, 9000, "user", "c"), (1, 20000, "assistant", "d"),
            (2, 2, "user", "e"), (2, 3, "user", "f"), (2, 1002, "assistant", "g"), (1, 1002, "system", "s"),
            (None, 0, "user", "x"), (None, 1, "assistant", "y"), (3, 5, "assistant", "z")]
    df = spark.createDataFrame(rows, TURNS)
    got = {(r.example_id, r.input, r.output) for r in dialogue_pairs(df).collect()}
    assert got == {("1:0", "a", "b"), ("1:9000", "c", "d"), ("2:3", "f", "g")}
    ids = [r.prompt_id for r in role_prompts(spark.createDataFrame(
        [(1, 1002, "user", "a"), (2, 2, "user", "b")], TURNS)).collect()]
    assert sorted(ids) == ["1:1002", "2:2"]


def test_null_keys_stay(spark):
    df = spark.createDataFrame([("a", "1"), (None, "2"), ("a", None), (None, None)], "source string, example_id string")
    assert smp.shuffle_index(df, 42).count() == 4
    assert sorted(r.pos for r in smp.shuffle_index(df, 42).collect()) == [0, 1, 2, 3]
    assert smp.subset_pct(df, 100.0, 42).count() == 4
    half = smp.subset_pct(df, 50.0, 42).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in half} == {"a": 1, None: 1}


def test_repeated_rows_are_encoded_each(spark):
    rows = [(7, "a b a", " c </s>")] * 3 + [(None, "", ""), (8, None, None)]
    df = spark.createDataFrame(rows, "example_id long, prompt string, answer string").fillna("", ["prompt", "answer"])
    vocab = tk.build_vocab(df, ["prompt", "answer"], 50)
    out = tk.encode_examples(df, vocab, SftConfig(max_len=16), pad=False).collect()
    assert len(out) == 5
    want = next(r.input_ids for r in out if r.example_id == 7)
    assert len(want) == 5 and all(r.input_ids == want for r in out if r.example_id == 7)
    dec = tk.decode_parts(df.sparkSession.createDataFrame([(want,), (want,), ([],), (None,), ([999],)], "ids array<long>"),
                          "ids", vocab)
    got = sorted((r.t or "") for r in dec.select(tk.join_tokens("_dec", False).alias("t")).collect())
    assert got == ["", "", "<unk>", "a b a c </s>", "a b a c </s>"]


def test_vocabulary_over_the_limit_is_refused(spark, monkeypatch):
    import pytest
    monkeypatch.setattr(tk, "MAX_VOCAB", 5)
    df = spark.createDataFrame([(1, "a b c", "d")], "example_id long, prompt string, answer string")
    with pytest.raises(ValueError):
        tk.encode_examples(df, tk.build_vocab(df, ["prompt", "answer"], 50), SftConfig())


def test_sources_without_input(spark):
    df = spark.createDataFrame([("g", "1", "i", "o")], "source string, example_id string, instruction string, output string")
    assert smp.mix_lenient(df, df).select("input").distinct().collect()[0].input == ""
    for template in ("inst", "alpaca"):
        assert tpl.render(df, template).count() == 1


def test_unanswered_items_count(spark):
    gold = spark.createDataFrame([("b", 1, 1), ("b", 2, 1), ("c", 3, 0)], "benchmark string, item_id long, gold int")
    preds = spark.createDataFrame([("m", "b", 1, 1), ("n", "b", 1, 0), ("n", "c", 3, 0)],
                                  "model string, benchmark string, item_id long, predicted int")
    got = {(r.model, r.benchmark, r.grouping_id): (r.n_items, r.n_correct, r.n_unanswered, r.accuracy)
           for r in ev.accuracy_rollup(preds, gold).collect()}
    assert got["m", "b", 0] == (2, 1, 1, 0.5)
    assert got["m", "c", 0] == (1, 0, 1, 0.0)
    assert got["n", "c", 0] == (1, 1, 0, 1.0)
    assert got["m", None, 1] == (3, 1, 2, 0.333333)
    assert got[None, None, 3] == (6, 2, 3, 0.333333)


def test_repeated_and_null_keys_in_scoring(spark):
    gold = spark.createDataFrame([("b", 1, 1), ("b", 1, 1), (None, 2, 1), ("b", None, 0)], "benchmark string, item_id long, gold int")
    preds = spark.createDataFrame([("m", "b", 1, 1), ("m", "b", 1, 1), ("m", None, 2, 1), ("m", "b", None, 0), ("m", "b", None, 1)],
                                  "model string, benchmark string, item_id long, predicted int")
    total = ev.accuracy_rollup(preds, gold).where("grouping_id = 3").first()
    assert (total.n_items, total.n_correct, total.n_unanswered, total.accuracy) == (3, 3, 0, 1.0)
    assert sorted((r.item_id or 0, r.n_answers) for r in ev.repeated_answers(preds).collect()) == [(0, 2), (1, 2)]
    want = spark.createDataFrame([("1", "a b"), ("1", "a c"), (None, "x"), ("2", "")], "example_id string, expected string")
    made = spark.createDataFrame([("1", "a b"), ("1", "z"), (None, "x")], "example_id string, generated string")
    cmp = ev.compare_outputs(want, made)
    assert sorted(map(repr, (tuple(r) for r in cmp.collect()))) == sorted(map(repr, [
        ("1", "a b", "a b", 2), ("1", "a c", "a b", 2), (None, "x", "x", 1), ("2", "", None, 0)]))
    assert ev.exact_match(cmp).first().n_rows == 4
    f1 = sorted((r.example_id or "", r.np, r.ng, r.overlap, r.f1) for r in ev.token_f1(cmp).collect())
    assert f1 == [("", 1, 1, 1, 1.0), ("1", 2, 2, 1, 0.5), ("1", 2, 2, 2, 1.0), ("2", 0, 0, 0, 1.0)]


def test_filter_states_every_reason(spark):
    ex = spark.createDataFrame([("1", "i", "ok"), ("2", "i", "x" * 50), ("3", "i", ""), ("4", "i", "ok")],
                               "example_id string, input string, output string")
    lab = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.example_id: r.reason for r in val.filter_rows(ex, lab, 1, 40, 45.0).collect()}
    assert got == {"1": "", "2": "quality; toxic; output too long; output too long for its input",
                   "3": "output too short", "4": "unlabelled"}
    assert {r.reason for r in val.filter_rows(ex, lab, require_label=False).collect()} == {"", "quality; toxic"}


def test_json_files_to_training_set(spark, tmp_path):
    rows = [("Ask [INST] this", "in", "out")] * 5 + [("q", None, "answer"), ("", "x", "no instruction"), ("q", "", " ")]
    df = spark.createDataFrame(rows, "instruction string, input string, output string").repartition(3)
    a = write_instruction_json(df, str(tmp_path / "a"), form="array")
    b = write_instruction_json(df.limit(2).drop("input"), str(tmp_path / "b"))
    (tmp_path / "b" / "part-bad.json").write_text("{broken\n")
    tables, bad = examples_from_json(spark, {"one": a, "two": b})
    ids = [r.example_id for r in tables[0].collect()]
    assert len(ids) == len(set(ids)) == len(rows)
    assert sorted(ids) == sorted(r.example_id for r in assign_example_ids(df.coalesce(1), "one").collect())
    cfg = SftConfig(max_len=64, vocab_size=100, shuffle=False, batch_size=1, grad_accum=1)
    ts = build_training_set(spark, tables, cfg, also_rejected=bad)
    out = spark.read.parquet(ts.shards_path).orderBy("pos").collect()
    valid = sum(1 for s in (rows, [tuple(r) for r in df.limit(2).select("instruction", F.lit(None), "output").collect()])
                for i, _, o in s if i.strip() and o.strip())
    assert len(out) == valid and [r.pos for r in out] == list(range(valid))
    assert [r.source for r in out] == sorted(r.source for r in out)  # not shuffled: in source order
    assert {r.template for r in out} == {"inst"}
    rejected = spark.read.parquet(ts.rejected_path).collect()
    assert sum(r.reason == "not a record" for r in rejected) == 1
    assert len(rejected) == len(rows) + 2 - valid + 1
    assert spark.read.parquet(ts.config_path).first().template == "inst"
    vocab = {r.token: r.n for r in spark.read.parquet(ts.vocab_path).collect()}
    assert vocab["[INST]"] == valid  # the template's own, none from the texts


def test_all_masked_rows_can_be_left_out(spark):
    rows = [("s", "1", "w " * 30, "", "o"), ("s", "2", "w", "", "o")]
    df = spark.createDataFrame(rows, "source string, example_id string, instruction string, input string, output string")
    for drop, n in ((True, 1), (False, 2)):
        ts = build_training_set(spark, [df], SftConfig(max_len=20, vocab_size=50, drop_all_masked=drop))
        assert spark.read.parquet(ts.shards_path).count() == n


def test_left_out_prompts_are_rejected_with_a_reason(spark):
    rows = [("s", "1", "short", "", "answer"), ("s", "2", "long " * 100, "", "answer")]
    df = spark.createDataFrame(rows, "source string, example_id string, instruction string, input string, output string")
    cfg = SftConfig(max_len=64, vocab_size=100, shuffle=False, batch_size=1, grad_accum=1, drop_all_masked=True)
    ts = build_training_set(spark, [df], cfg)
    assert [r.example_id for r in spark.read.parquet(ts.shards_path).collect()] == ["1"]
    rejected = spark.read.parquet(ts.rejected_path).collect()
    assert [(r.source, r.reason) for r in rejected] == [("s", "prompt fills max_len")]
    assert '"example_id":"2"' in rejected[0].record
