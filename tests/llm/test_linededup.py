import hashlib
import re
from collections import defaultdict

from tunemill.llm import linededup

WHITE = " \t\n\x0b\x0c\r"


def brute(rows):
    holders = defaultdict(set)
    key = lambda x: re.sub(r"[A-Z]", lambda m: m[0].lower(), x.strip(WHITE))
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    a, b, c = "A line that is Long enough", "ünïcode líne of twenty é", "short line"
    rows = [(1, f"{a}\n{c}\n{b}"), (2, f"  {a.upper()}\t\n{c}"), (3, f"{c}\n{a}\n{a}\n\n"), (4, f"{b}\n{c}"),
            (5, b + "\r"), (6, None), (7, ""), (8, "\n"), (None, f"{a}\nx"), (None, f"{a}\nx"), (3, f"{c}\n{a}\n{a}\n\n"),
            (3, f"other text\n{b}\n{a}"), (9, "y" * 19 + "\n" + "z" * 20), (10, "z" * 20), (11, "z" * 20 + "\n" + "y" * 19),
            (12, "y" * 19 + "\n" + "\n".join([f"line number {i} of a long text" for i in range(3000)] * 2))]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, pos int")
    got = sorted(map(tuple, linededup.op7(spark, "", docs).collect()), key=repr)
    assert got == brute(rows)


def test_columns_and_empty(spark):
    docs = spark.createDataFrame([(1, "x", 5, "q")], "doc_id long, text string, n_lines int, gone string")
    out = linededup.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "n_lines", "gone", "n_lines_1", "n_dropped"]
    assert out.first()[:] == (1, "x", 5, "q", 1, 0)
    assert linededup.dedup_lines(docs.limit(0)).count() == 0
    assert linededup.dedup_lines(spark.createDataFrame([(1, None)], "doc_id long, text string")).first().text is None
