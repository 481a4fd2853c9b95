"""Patterns that are only tried where they can match give what they give everywhere; clean text costs no such pass."""

import random

from pyspark.sql import functions as F

from tunemill.config import MARKER_PATTERN
from tunemill.functions import text as tx


def test_guarded_patterns_equal_plain_ones(spark):
    rng = random.Random(3)
    parts = ["a", " ", "  ", "\n", "\r", "\t", " ", "　", "\x07", "\x0b", "é", "<s>", "</s>", "[INST]", "[/INST]", "<", "s>", "[", "INST]", "한"]
    rows = [(None,), ("",)] + [("".join(rng.choices(parts, k=rng.randint(1, 30))),) for _ in range(3000)]
    x = F.regexp_replace("t", r"\r\n?", "\n")
    for pattern, by in ((tx.CONTROL_CHARS, ""), (tx.BLANK_RUN, " "), (tx.SPACED_BREAK, "\n"), (r"\n{3,}", "\n\n")):
        x = F.regexp_replace(x, pattern, by)
    df = spark.createDataFrame(rows, "t string")
    got = df.select("t", tx.clean_text("t").alias("c"), tx.py_strip(x).alias("want"), tx.remove_markers("t").alias("m")).collect()
    for r in got:
        assert r.c == r.want
        assert r.m == (None if r.t is None else tx.cancel_markers(r.t))


def test_clean_text_is_not_scanned_for_markers(spark):
    df = spark.range(1).select(F.lit("plain text").alias("t"))
    plan = df.select(tx.remove_markers("t").alias("m"))._jdf.queryExecution().analyzed().toString()
    guard = plan.count("Contains(")
    assert guard >= 2 * plan.count("regexp_replace(")
    assert MARKER_PATTERN in plan
