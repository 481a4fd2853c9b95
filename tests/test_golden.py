"""Hand-written golden cases (invented text) for the edge rules."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tunemill.config import SftConfig
from tunemill.functions.text import py_strip
from tunemill.operators import batches as bat
from tunemill.operators import evaluate as ev
from tunemill.operators import sampling as smp
from tunemill.operators import templates as tpl
from tunemill.operators import tokens as tk
from tunemill.operators import validate as val
from tunemill.sources.io import (read_instruction_json, split_records,
                                 write_instruction_json)

SCHEMA = "source string, example_id long, instruction string, input string, output string"

FIVE = [
    ("golden", 1, "Act as a careful nurse.", "My knee hurts after running.", "Rest and ice it."),
    ("golden", 2, "Act as a careful nurse.", "I feel dizzy when I stand.", "Stand up slowly."),
    ("golden", 3, "Act as a careful nurse.", "", "Drink more water."),
    ("golden", 4, "Act as a careful nurse.", "My child has a rash.", "See a doctor soon."),
    ("golden", 5, "Act as a careful nurse.", "I cannot sleep.", "Keep a regular bedtime."),
]


def test_five_rows_shape(spark):
    df = spark.createDataFrame(FIVE, SCHEMA)
    r = tpl.render(df, "inst").orderBy("example_id").collect()
    for row, (_, _, i, x, o) in zip(r, FIVE):
        assert row.prompt == f"<s>[INST] {i} {x} [/INST] "
        assert row.answer == f"{o} </s>"
    assert r[2].prompt == "<s>[INST] Act as a careful nurse.  [/INST] "  # two spaces
    cfg = SftConfig(max_len=32, vocab_size=64)
    ex = tpl.render(df, "inst")
    vocab = tk.build_vocab(ex, ["prompt", "answer"], cfg.vocab_size)
    enc = tk.encode_examples(ex, vocab, cfg).collect()
    for e in enc:
        assert len(e.input_ids) == len(e.attention_mask) == len(e.labels) == 32
        assert sum(e.attention_mask) == e.length
        assert e.labels[:e.prompt_len] == [-100] * e.prompt_len
        assert all(l == -100 for l in e.labels[e.length:])
        assert e.input_ids[e.length:] == [0] * (32 - e.length)


def test_input_empty_missing_null(spark):
    rows = [("g", 1, "Do it.", "", "ok"), ("g", 2, "Do it.", None, "ok"),
            ("g", 3, "Do it.", "  \t ", "ok"), ("g", 4, " Do it. ", " extra ", " ok ")]
    df = spark.createDataFrame(rows, SCHEMA)
    inst = {r.example_id: r.prompt for r in tpl.render(df, "inst").collect()}
    assert inst[1] == inst[2] == "<s>[INST] Do it.  [/INST] "
    al = {r.example_id: (r.prompt, r.answer) for r in tpl.render(df, "alpaca").collect()}
    head = ("<s>[INST] Below is an instruction that describes a task. Write a response that "
            "appropriately completes the request.\n\n### Instruction:\n")
    assert al[1][0] == al[2][0] == al[3][0] == head + "Do it. [/INST]"
    assert al[4][0] == head + "Do it.\n\n### Input:\nextra [/INST]"
    assert al[4][1] == "\n\n### Response:\nok </s>"
    lenient = smp.mix_lenient(df.drop("input"), df).where("source_rank = 0").collect()
    assert all(r.input == "" for r in lenient)


def test_required_fields(spark):
    rows = [("g", 1, None, "x", "y"), ("g", 2, "  ", "x", "y"), ("g", 3, "i", "x", None),
            ("g", 4, "i", None, "　"), ("g", 5, "i", None, "y")]
    out = {r.example_id: (r.valid, r.reason) for r in
           val.required_fields(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[1] == (False, "instruction: missing")
    assert out[2] == (False, "instruction: blank")
    assert out[3] == (False, "output: missing")
    assert out[4] == (False, "output: blank")
    assert out[5] == (True, "")


def test_marker_guard(spark):
    rows = [("g", 1, "i", "hi <s> there [INST] x [/INST] </s>", "fine"), ("g", 2, "i", "plain", "ok")]
    df = spark.createDataFrame(rows, SCHEMA)
    g = {r.example_id: r for r in val.marker_guard(df).collect()}
    assert g[1].had_marker and g[1].input == "hi  there  x  "
    assert not g[2].had_marker and g[2].input == "plain"
    assert [r.example_id for r in val.marker_guard(df, mode="reject").collect()] == [2]


def test_marker_guard_leaves_no_nested_marker(spark):
    nested = ["[IN[INST]ST] x <<s>/s>", "<</s>s>", "[/IN[/IN[INST]ST]ST]", "[IN" * 9 + "[INST]" + "ST]" * 9, None]
    df = spark.createDataFrame([("g", i, "i", t, "o") for i, t in enumerate(nested)], SCHEMA)
    got = {r.example_id: r.input for r in val.marker_guard(df).collect()}
    assert got[0] == " x " and got[1] == "" and got[2] == "" and got[4] is None
    assert not any(m in (t or "") for t in got.values() for m in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_strip_matches_python(spark):
    texts = ["\t  text \x1c", "\x1c\x1d x \x85", "​keep​", "", "   "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in df.select(py_strip("t").alias("s")).collect()]
    assert got == [t.strip() for t in texts]


@pytest.mark.parametrize("words,expect_loss", [(7, 0), (6, 1), (8, 0)])
def test_prompt_at_max_len(spark, words, expect_loss):
    """prompt = max_len, max_len - 1, max_len + 1 tokens (max_len 10)."""
    ins = " ".join(["w"] * words)
    df = spark.createDataFrame([("g", 1, ins, "", "ok")], SCHEMA)
    ex = tpl.render(df, "inst")
    cfg = SftConfig(max_len=10, vocab_size=20)
    vocab = tk.build_vocab(ex, ["prompt", "answer"], cfg.vocab_size)
    e = tk.encode_examples(ex, vocab, cfg).first()
    assert e.prompt_tokens == words + 3
    assert len(e.labels) == 10
    assert sum(1 for x in e.labels if x != -100) == expect_loss
    r = tk.encode_examples(ex, vocab, cfg, pad=False).first()
    assert len(r.labels) == len(r.input_ids) == min(words + 3 + 2, 10)  # never longer


def test_batch_padding_fill(spark):
    rows = [(0, 0, [5, 6, 7], [1, 1, 1], [-100, 6, 7]), (0, 0, [5, 6, 7, 8, 9], [1] * 5, [-100, -100, 7, 8, 9]),
            (0, 1, [4], [1], [4])]
    df = spark.createDataFrame(rows, "epoch int, batch_id long, input_ids array<long>, "
                                     "attention_mask array<long>, labels array<long>")
    out = bat.pad_to_batch(df, pad_id=0).orderBy("batch_id", "batch_len").collect()
    short = [r for r in out if r.batch_id == 0 and r.input_ids[:3] == [5, 6, 7] and r.input_ids[3] == 0][0]
    assert short.batch_len == 5
    assert short.input_ids == [5, 6, 7, 0, 0]
    assert short.attention_mask == [1, 1, 1, 0, 0]
    assert short.labels == [-100, 6, 7, -100, -100]
    assert [r for r in out if r.batch_id == 1][0].input_ids == [4]


@pytest.mark.parametrize("n", [0, 1, 3, 1000])
@pytest.mark.parametrize("pct", [0, 0.1, 33.3, 99.9, 100, 150])
def test_subset_exact_size(spark, n, pct):
    df = spark.range(n).select(F.lit("s").alias("source"), F.col("id").alias("example_id"))
    got = smp.subset_pct(df, pct, 42, prefix_hex=2).count()
    assert got == (n if pct >= 100 else int(n * pct / 100.0))


def test_strip_prompt_replace_and_slice(spark):
    rows = [(1, "P: ", "P: answer P: again"), (2, "", "  text  "), (3, "Q", "Q tail")]
    df = spark.createDataFrame(rows, "example_id long, prompt string, full string")
    out = {r.example_id: r.a for r in df.select(
        "example_id", ev.strip_prompt_replace(F.col("full"), F.col("prompt")).alias("a")).collect()}
    assert out == {1: "answer again", 2: "text", 3: "tail"}
    # by position: ids after the prompt's length, decoded
    vocab = tk.build_vocab(df, ["full"], 50)
    t = df.select("example_id", F.size(tk.tokenize("prompt")).alias("pl"),
                  tk.tokenize("full").alias("tok"))
    enc = tk.encode_tokens(t, "tok", vocab, "ids")
    tail = enc.select("example_id", F.slice("ids", F.col("pl") + 1, 1000).alias("tail"))
    dec = {r.example_id: r.text for r in tk.decode_ids(tail, "tail", vocab).collect()}
    assert dec[1] == "answer P : again" and dec[2] == "text" and dec[3] == "tail"


def test_json_readers(spark, tmpdir_path):
    arr = os.path.join(tmpdir_path, "array.json")
    with open(arr, "w") as f:
        json.dump([{"instruction": "a", "input": "b", "output": "c"},
                   {"instruction": "d", "output": "e"}], f)
    jl = os.path.join(tmpdir_path, "lines.json")
    with open(jl, "w") as f:
        f.write('{"instruction": "x", "input": "y", "output": "z"}\n')
        f.write('{"instruction": "broken", \n')
        f.write('{"instruction": "u", "input": "", "output": "w"}\n')
    a, bad = split_records(read_instruction_json(spark, arr))
    assert sorted((r.instruction, r.input, r.output) for r in a.collect()) == [("a", "b", "c"), ("d", None, "e")]
    assert bad.count() == 0
    b, bad = split_records(read_instruction_json(spark, jl))
    assert sorted(r.instruction for r in b.collect()) == ["u", "x"]
    rejected = bad.collect()
    assert len(rejected) == 1 and "broken" in rejected[0].record and rejected[0].reason
    both, _ = split_records(read_instruction_json(spark, [jl, arr]))
    assert both.count() == 4 and both.select("source_file").distinct().count() == 2
    pretty = os.path.join(tmpdir_path, "pretty.json")
    with open(pretty, "w") as f:
        json.dump([{"instruction": "p", "input": "q", "output": "r"}] * 2, f, indent=2)
    assert split_records(read_instruction_json(spark, pretty))[0].count() == 2
    no = os.path.join(tmpdir_path, "no.json")
    with open(no, "w") as f:
        f.write("this is no json\n")
    good, bad = split_records(read_instruction_json(spark, no))
    assert good.count() == 0 and bad.count() == 1  # never silently nothing


def test_json_array_writer(spark, tmpdir_path):
    rows = [("a\n]", None, "c, "), ("d", "", "]")]
    df = spark.createDataFrame(rows, "instruction string, input string, output string")
    path = write_instruction_json(df, os.path.join(tmpdir_path, "arr"), form="array")
    part = [f for f in os.listdir(path) if f.startswith("part")]
    assert len(part) == 1
    with open(os.path.join(path, part[0])) as f:
        assert sorted((x["instruction"], x["input"], x["output"]) for x in json.load(f)) == sorted(rows)
    back, bad = split_records(read_instruction_json(spark, path))
    assert sorted((r.instruction, r.input, r.output) for r in back.collect()) == sorted(rows) and bad.count() == 0


def test_json_arrays_stay_small(spark, tmpdir_path):
    """A table beyond one array's bound, a third of it one record: many files, all records."""
    rows = [("same", None, "x" * 40_000)] * 300 + [(f"q{i}", "", "y" * 30_000) for i in range(600)]
    df = spark.createDataFrame(rows, "instruction string, input string, output string")
    path = write_instruction_json(df, os.path.join(tmpdir_path, "arr"), form="array")
    parts = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part")]
    assert len(parts) > 1 and max(map(os.path.getsize, parts)) < 10_000_000
    back = read_instruction_json(spark, path)
    assert back.where("_corrupt_record is not null").count() == 0
    assert sorted((r.instruction, r.input or "", r.output) for r in back.collect()) == sorted(
        (a, b or "", c) for a, b, c in rows)


def test_token_f1_edges(spark):
    df = spark.createDataFrame([(1, "", ""), (2, "a b", ""), (3, "a a b", "a b b"), (4, None, "x")],
                               "example_id long, generated string, expected string")
    got = sorted(tuple(r) for r in ev.token_f1(df).collect())
    assert got == [(1, 0, 0, 0, 1.0), (2, 2, 0, 0, 0.0), (3, 3, 3, 2, 0.666667), (4, 0, 1, 0, 0.0)]


def test_markers_of_any_depth_go_and_other_brackets_stay(spark):
    import re

    from tunemill.config import MARKER_PATTERN
    from tunemill.functions.text import remove_markers
    nest = lambda m, cut, n: m if n == 1 else m[:cut] + nest(m, cut, n - 1) + m[cut:]
    ten = nest("[INST]", 3, 10)
    mixed = "a [x] <b> " + nest("<s>", 2, 10) + nest("[/INST]", 4, 10) + nest("</s>", 1, 10) + " [IN] </ s> >]"
    texts = [ten, "[" + ten + "INST]", mixed, "[INST", None, "", "plain <i>", "<<s>s><[INST]/s>[", "[IN<s>ST] <[/INST]s>x" * 500]

    def rounds(t):
        while t is not None and re.search(MARKER_PATTERN, t):
            t = re.sub(MARKER_PATTERN, "", t, count=1)
        return t
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in df.select("i", remove_markers("t").alias("x")).orderBy("i").collect()]
    assert got == [rounds(t) for t in texts]
    assert got[:3] == ["", "", "a [x] <b>  [IN] </ s> >]"]
