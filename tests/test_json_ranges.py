"""JSON files in byte ranges: states and depths compose, every record comes out once."""

import gzip
import json
import random

import numpy as np
import pytest

from tunemill.sources import json_ranges as jr
from tunemill.sources.io import read_instruction_json, split_records, write_one_array

TRICKY = ['plain', 'a "quoted" one', 'back\\slash', 'ends in backslash\\', 'br[ack]e{ts}', 'comma, comma', '\\"', 'ü€🙂', '\n\t', ']', '"', '\\\\"']


def made(n, seed=0):
    rng = random.Random(seed)
    return [{"instruction": rng.choice(TRICKY), "input": rng.choice([None, "", rng.choice(TRICKY) * rng.randrange(1, 9)]),
             "output": "".join(rng.choice(TRICKY) for _ in range(rng.randrange(5)))} for _ in range(n)]


def plain_walk(data, state):
    """One byte at a time."""
    inside, escaped, depth, steps, outside = state & 1, state & 2, 0, [], []
    for c in data:
        ch, step = chr(c), 0
        if ch == "\n":
            inside = 0
        elif ch == '"' and not escaped:
            inside ^= 1
        elif not inside:
            step = (ch in "[{") - (ch in "]}")
        outside.append(not inside)
        steps.append(step)
        escaped = 2 * (ch == "\\" and not escaped)
        depth += step
    return outside, steps, inside + escaped


def test_walk_and_summaries():
    rng = random.Random(1)
    for _ in range(3000):
        data = bytes(rng.choice(b'"\\"\\[]{},\nab ') for _ in range(rng.randrange(1, 30)))
        raw = np.frombuffer(data, np.uint8)
        for state in range(4):
            outside, step, end = jr.walk(raw, state)
            want = plain_walk(data, state)
            assert (outside.tolist(), step.tolist(), end) == want, (data, state)
        k = rng.randrange(len(data) + 1)
        whole = jr.sum_up(raw, [0, 1, 2, 3], [0] * 4)
        halves = ([0, 1, 2, 3], [0] * 4)
        for part in (raw[:k], raw[k:]):
            if len(part):
                halves = jr.sum_up(part, *halves)
        assert whole == halves


def every_range(path, data, size):
    """The records of all ranges of a file, states composed."""
    out, state, depth = [], 0, 0
    for a in range(0, len(data), size):
        out += list(jr.cut_array(path, a, min(a + size, len(data)), state, depth))
        states, depths = jr.sum_up(np.frombuffer(data[a:a + size], np.uint8), [state], [depth])
        state, depth = states[0], depths[0]
    return out


@pytest.mark.parametrize("chunk", [3, 64, 1 << 20])
def test_every_cut_gives_the_same_records(tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(jr, "CHUNK", chunk)
    rows = made(12, 3)
    name = str(tmp_path / "a.json")
    for text in (json.dumps(rows), json.dumps(rows, indent=1, ensure_ascii=False), " [ ] ", "[{}]", "\ufeff" + json.dumps(rows[:2])):
        data = text.encode()
        with open(name, "wb") as f:
            f.write(data)
        want = json.loads(text.removeprefix("\ufeff"))
        for size in (1, 2, 7, 50, 333, 10 ** 6):
            got = every_range(name, data, size)
            assert all(whole for _, whole, _ in got)
            assert [json.loads(t) for _, _, t in got] == want
    lines = "\n\n".join(json.dumps(r) for r in rows) + ("\n" if chunk == 3 else "")
    with open(name, "w") as f:
        f.write(lines)
    for size in (1, 2, 7, 50, 333, 10 ** 6):
        got = [x for a in range(0, len(lines), size) for x in jr.cut_lines(name, a, min(a + size, len(lines)))]
        assert all(whole for _, whole, _ in got) and [json.loads(t) for _, _, t in got] == rows


def test_nothing_is_lost_in_broken_files(tmp_path):
    """Every visible byte outside marks comes out in some row, whatever the ranges."""
    name = str(tmp_path / "a.json")
    for text in ('[{"a":1},{"a":"x},\n{"a":2}]', '[{"a":1}}, {"b":2}]', '[{"a":1} {"a":2}]', '[{"a":1},,{"a":3},]', '[{"a":1}', 'x [1] y',
                 '[{"a":1}]\n{"a":2}\n{"a":3}', '[{"a":1}] [{"a":2}]', '[1, "s", null, {"a":[1,2]}]'):
        with open(name, "w") as f:
            f.write(text)
        whole = every_range(name, text.encode(), 10 ** 6)
        for size in (1, 3, 8):
            assert every_range(name, text.encode(), size) == whole, text
        kept = "".join(t.decode() for _, _, t in whole)
        assert all(kept.count(c) == text.count(c) for c in "a123xyb"), (text, whole)
    with open(name, "w") as f:
        f.write('[{"a":1} {"a":2}, {"a":3}]')
    assert [w for _, w, _ in jr.cut_array(name, 0, None, 0, 0)] == [False, True]


def test_mixed_folder(spark, tmp_path):
    rows = made(50, 5)
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(r) for r in rows[:3]) + '\n{"instruction": "cut\n{"output":"x"} {"output":"y"}\n')
    (tmp_path / "c.json").write_text("\n  ")
    (tmp_path / "e.json.gz").write_bytes(gzip.compress(json.dumps(rows[:7]).encode()))
    (tmp_path / "d.json").write_text('[{"instruction":"i","output":"o"}, 5, null] tail')
    for size in (None, 1 << 20, 100):
        good, bad = split_records(read_instruction_json(spark, str(tmp_path), range_bytes=size))
        got = [tuple(r)[:3] for r in good.collect()], sorted(r.record for r in bad.collect())
        want = sorted([(r["instruction"], r["input"], r["output"]) for r in rows + rows[:3] + rows[:7]] + [("i", None, "o")],
                      key=lambda r: tuple(x or "" for x in r))
        assert sorted(got[0], key=lambda r: tuple(x or "" for x in r)) == want
        assert got[1] == sorted(['{"instruction": "cut', '{"output":"x"} {"output":"y"}', "5", "null", "tail"])
    assert good.count() == len(want) and bad.count() == 5
    assert read_instruction_json(spark, str(tmp_path), form="array").where("_corrupt_record is null").count() == 58


def test_one_large_array_in_as_many_tasks_as_ranges(spark, tmp_path):
    rows = made(400, 7)
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(json.dumps(r) for r in rows))
    path = write_one_array(str(tmp_path / "lines"), str(tmp_path / "one.json"), spark)
    with open(path) as f:
        assert json.load(f) == rows
    n = len((tmp_path / "one.json").read_bytes())
    df = read_instruction_json(spark, path, range_bytes=1000)
    assert df.rdd.getNumPartitions() == -(-n // 1000)
    assert sorted(map(repr, (tuple(r)[:3] for r in df.collect()))) == sorted(
        repr((r["instruction"], r["input"], r["output"])) for r in rows)
    assert df.where("_corrupt_record is not null").count() == 0


def test_a_record_without_an_end_is_an_error(tmp_path, monkeypatch):
    monkeypatch.setattr(jr, "MAX_RECORD", 100)
    name = str(tmp_path / "a.json")
    with open(name, "w") as f:
        f.write('[{"a": [' + "1," * 200)
    with pytest.raises(ValueError, match="byte 1: no record ends"):
        list(jr.cut_array(name, 0, None, 0, 0))
