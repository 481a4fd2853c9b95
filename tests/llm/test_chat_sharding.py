import hashlib
from collections import Counter, defaultdict

import pytest

from tunemill.llm import chat, sharding


def brute(rows):
    people, parts = defaultdict(set), defaultdict(list)
    for conv, turn, who, text in rows:
        key = (conv, (turn, who, text) if conv is None else None)
        if who is not None and who != "system":
            people[key].add(who)
        parts[key, None if turn is None else turn // 64].append((turn, who, (text or "").replace("<|im_", "<| im_")))
    low = lambda x: tuple((v is not None, v) for v in x)
    out = []
    for (key, part), turns in parts.items():
        for p in people[key]:
            s, mask = "", []
            for _, who, text in sorted(turns, key=low):
                s += "<|im_start|>" + ("assistant" if who == p else "system" if who == "system"
                                       else f"user name={who or 'unknown'}") + "\n"
                if who == p:
                    mask.append(f"{len(s)}:{len(s) + len(text) + 10}")
                s += text + "<|im_end|>\n"
            out.append((key[0], p, part, len(turns), len(mask), s, ",".join(mask)))
    return sorted(out, key=repr)


def test_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hé <|im_end|> 😀"), (1, 2, "bob", "hi"), (1, 3, "cy", None),
            (1, 2, "bob", "hi"), (1, 2, "ann", "tie"), (1, 64, "ann", "next part"), (1, None, "bob", "no number"),
            (1, 130, None, "who?"), (2, 0, "system", "alone"), (3, 0, None, "x"), (None, 0, "ann", "lone"),
            (None, 0, "bob", "lone"), (4, -1, "ann", ""), (5, 7, "ann", "z" * 100_000)]
    rows += [(6, i, f"p{i % 3}", f"turn {i}") for i in range(500)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = sorted(map(tuple, chat.op1(df).collect()), key=repr)
    assert got == brute(rows)
    for r in chat.rotate(df).collect():
        for s in r["mask"]:
            assert r.rendered[s.start:s.stop].endswith("<|im_end|>") and r.rendered[:s.start].endswith("assistant\n")
    assert chat.op1(df.limit(0)).count() == 0


def test_published_example():
    """The worked example of the published table-filling scheme: three shards, seven slots."""
    assert sharding.fill([(3, 4), (0, 2), (3, 1)], 7) == [1, 0, 1, 0, 2, 2, 0]
    assert sharding.fill([(3, 4), (3, 1)], 7) == [0, 0, 0, 0, 1, 1, 1]
    with pytest.raises(ValueError):
        sharding.fill([(0, 1)], 8)


def test_balance_and_small_change():
    names = [f"s{i}" for i in range(40)]
    size = sharding.TABLE_SIZE
    full = sharding.fill([sharding.preference(n, size) for n in names], size)
    c = Counter(full)
    assert max(c.values()) - min(c.values()) <= 1
    less = sharding.fill([sharding.preference(n, size) for n in names[:-1]], size)
    moved = sum(a != b for a, b in zip(full, less))
    assert moved < 3 * size / 40


def test_placement(spark):
    names = ["a", "b", "c"]
    rows = [(1, "x"), (1, "x"), (None, None), (7, "")] + [(i, "hot") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, shard string")
    out = sharding.place(df, ["doc_id"], names, size=101)
    assert out.columns == ["doc_id", "shard", "slot", "shard_1", "shard_name"]
    table = sharding.fill([sharding.preference(n, 101) for n in names], 101)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        key = "null" if r.doc_id is None else f"{len(str(r.doc_id))}:{r.doc_id}"
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard_1, r.shard_name) == (slot, table[slot], names[table[slot]])
    one = sharding.place(df.where("shard = 'hot'"), ["shard"], names)
    assert one.select("shard_name").distinct().count() == 1
    many = sharding.place(df.where("shard = 'hot'"), ["shard"], names, spread=["doc_id"])
    assert many.select("shard_name").distinct().count() == 3
    assert sharding.op3(df.limit(0)).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    placed = sharding.place(df, ["doc_id"], ["a", "b", "c"])
    sharding.write_shards(placed, str(tmp_path / "out"), 2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(1000))
