import json

import pytest
from pyspark.sql import functions as F

from tunemill.plans.training_set import examples_from_json
from tunemill.sources.raw_records import RecordShape, map_records

CHAT = RecordShape(example_id=("$.id",), instruction=("$.meta.system", "$['sys text']"), each="$.turns",
                   input=("@.q",), output=("@.a.text", "@.a"), fixed_instruction="Answer.")


def rows_of(spark, shape, *records):
    df = spark.createDataFrame([(r if r is None or isinstance(r, str) else json.dumps(r), 1) for r in records], "value string, reason int")
    return [r.asDict() for r in map_records(df, shape).collect()]


def test_paths_in_order_and_elements(spark):
    got = rows_of(spark, CHAT, {"id": 7, "meta": {"system": "S"}, "turns": [{"q": "1", "a": {"text": "x"}}, {"a": "y"}], "lang": "en", "n": [1]},
                  {"sys text": "T", "turns": [{"q": 2.5, "a": [1, "z"]}]}, {"turns": [{"q": "no answer"}, None]},
                  {"id": "e", "turns": []}, {"id": "f", "turns": "text"})
    assert [(r["example_id"], r["instruction"], r["input"], r["output"], r["reason"]) for r in got] == [
        ("7", "S", "1", "x", ""), ("7", "S", "", "y", ""), (None, "T", "2.5", '[1,"z"]', ""),
        (None, "Answer.", "no answer", None, "output: no value"), (None, "Answer.", "", None, "output: no value"),
        ("e", "Answer.", "", None, "$.turns: no element"), ("f", "Answer.", "", None, "$.turns: no element")]
    assert [json.loads(r["extra"]) if r["extra"] else None for r in got[:3]] == [{"lang": "en", "n": [1]}] * 2 + [None]
    assert [r["record"] is None for r in got] == [True] * 3 + [False] * 4


def test_what_is_no_record(spark):
    shape = RecordShape(output=("$.o",), instruction=("$.i",))
    got = rows_of(spark, shape, None, "", "{", "5", "null", "[1]", '{"o":1,"o":2}', '{"i":null,"o":"x"}', '{}')
    assert [r["reason"] for r in got] == ["not a record"] * 7 + ["instruction: no value", "instruction: no value; output: no value"]
    df = spark.createDataFrame([('{"i":"a","o":"b"}', True), ('{"i":"a","o":"b"} {"i":1}', False)], "value string, whole boolean")
    assert [r.reason for r in map_records(df, shape).collect()] == ["", "not a record"]
    assert map_records(df.limit(0), shape).count() == 0
    for bad in (dict(output=("o",)), dict(output=("@.o",))):
        with pytest.raises(ValueError):
            RecordShape(**bad)


def test_raw_files_to_examples(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"turns": [{"q": "1", "a": "x"}, {"q": "1", "a": "x"}]}, {"turns": 3}, 4]))
    (tmp_path / "b.json").write_text('{"sys text": "s", "turns": [{"q": "2", "a": "y"}]}\n{broken\n')
    tables, bad = examples_from_json(spark, {"chat": str(tmp_path)}, {"chat": CHAT})
    assert sorted((r.instruction, r.input, r.output) for r in tables[0].collect()) == [("Answer.", "1", "x")] * 2 + [("s", "2", "y")]
    assert tables[0].select(F.countDistinct("example_id")).first()[0] == 3
    assert sorted((r.source, r.reason) for r in bad.collect()) == [("chat", "$.turns: no element")] + [("chat", "not a record")] * 2
