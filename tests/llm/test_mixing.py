import pytest
from pyspark.sql import functions as F

from tunemill.llm import mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, target, open_ = float(sum(sizes.values())), dict.fromkeys(names, 0.0), set(names)
    while open_ and left > 1e-9:
        level, left = left / sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += level * weight[s]
            if target[s] > 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def check(rows, slack):
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack, (s, taken[s], want[s])


def result(docs):
    per_doc, _ = mixing.mix(mixing.lay_out(docs, docs.columns))
    return per_doc.select("row.*", "size", "source_size", "target", "taken")


def test_small(spark):
    rows = []
    for s, n, k in (("a", 3, 5), ("b", 40, 7), ("Ä", 30, 11), (None, 25, 6), ("c", 1, 900), ("d", 50, 3), ("e", 2, 0)):
        rows += [(i, s, " ".join(["w"] * k) if k else None, "x") for i in range(n)]
    rows += [(1, "b", "same row", "x")] * 5 + [(None, "b", "\t \n", "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size string")
    out = result(docs.withColumnRenamed("size", "rank"))
    got = out.collect()
    assert len(got) == len(rows)
    check(got, slack=5 * 16)
    again = result(docs.withColumnRenamed("size", "rank").repartition(3)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.op2(docs).collect() == []
    assert mixing.mix_documents(docs).collect() == []
    docs = spark.createDataFrame([(1, "a", None), (2, None, "")], docs.schema)
    assert [(r.size, r.target, r.taken) for r in mixing.op2(docs).collect()] == [(0, 0.0, 0)] * 2


def test_table_and_schedule(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "text")
    rows = mixing.lay_out(docs, docs.columns)
    per_doc, mixed = mixing.mix(rows)
    check(per_doc.select("row.*", "size", "source_size", "target", "taken").collect(), slack=6 * 16)
    pieces = mixed.join(rows.select("rid", "source"), "rid").collect()
    per_slot = {}
    for p in pieces:
        per_slot.setdefault(p.slot, [0, set()])
        per_slot[p.slot][0] += p.n
        per_slot[p.slot][1].add(p.source)
    assert all(len(s) == 1 and n <= 16 for n, s in per_slot.values())  # one source, one block a slot
    total = sum(n for n, _ in per_slot.values())
    target = {r.source: r.target for r in per_doc.select("row.source", "target").collect()}
    for prefix in (200, 1000, 5000):  # every stretch is close to the targets
        first = [per_slot[i] for i in range(prefix) if i in per_slot]
        for s, t in target.items():
            share = sum(s in x[1] for x in first) / prefix
            assert abs(share - t / sum(target.values())) < 12 / prefix, (s, prefix)
    assert total == sum(r.taken for r in per_doc.select("taken").collect())


def test_documents_repeat(spark):
    rows = [(1, "a", "x " * 10, 7), (2, "b", "y " * 200, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, row int")
    got = mixing.mix_documents(docs)
    assert got.columns == docs.columns
    assert got.where("doc_id = 1").count() == 3
    assert got.where(F.col("row") != 7).count() == 0


def test_tiny_sources_beside_a_huge_one(spark):
    """28 million words: a block is as long as in a small table, and every tiny source is mixed."""
    huge = spark.range(1400).select("id", F.lit("huge").alias("source"), F.repeat(F.lit("w "), 20000).alias("text"))
    tiny = spark.range(40).select("id", F.format_string("tiny%02d", "id").alias("source"),
                                  F.repeat(F.lit("v "), 1 + F.col("id").cast("int")).alias("text"))
    per_doc, mixed = mixing.mix(mixing.lay_out(huge.union(tiny), ["id"]))
    got = per_doc.groupBy("source_size").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert len(got) == 41
    for r in got:
        assert r.taken == pytest.approx(r.target, abs=1), r
        assert r.source_size > 40 or r.taken == 3 * r.source_size
    assert mixed.groupBy("slot").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] == 16


def test_the_schedule_shows_in_the_result(spark, tmpdir_path, monkeypatch):
    """Documents carry their slots, files have the sources interleaved, and other points give another order."""
    docs = spark.createDataFrame([(i, "abc"[i % 3], " ".join(["w"] * 40)) for i in range(900)], "doc_id long, source string, text string")
    out = mixing.op2(docs.repartition(1)).collect()
    assert all((r.first_slot is None) == (r.taken == 0) and r.n_slots * 16 >= r.taken for r in out)
    source = {r.doc_id: r.source for r in docs.collect()}
    target = {}
    for r in out:
        target[source[r.doc_id]] = r.target
    total = sum(target.values())
    path = f"{tmpdir_path}/mix"
    for n in (1, 4):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        mixing.mix_documents(docs).write.mode("overwrite").parquet(path)
        import glob

        import pyarrow.parquet as pq
        for f in glob.glob(f"{path}/*.parquet"):
            got = pq.read_table(f)["source"].to_pylist()
            for a in range(0, len(got) - 99, 100):  # every stretch of every file
                for s, t in target.items():
                    assert abs(got[a:a + 100].count(s) / 100 - t / total) < .2, (n, a, s)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    before = {r.doc_id: r.first_slot for r in out}
    monkeypatch.setattr(mixing, "_point", lambda i: F.pmod(i, F.lit(100)) / 100 + 0.001)
    after = {r.doc_id: r.first_slot for r in mixing.op2(docs.repartition(1)).collect()}
    assert before != after
