import re
from collections import Counter
from math import comb, exp

import pytest
from pyspark.sql import functions as F

from tunemill.llm import quality


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed)


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [None, "", " \n\t", "a b c d e", "a b c d e f a b c d e", "x " * 5, "x " * 6, "x\n" * 40, "é#é 漢<漢\x0b| a",
           "l\nl\n l\n\n\nl", "a\xa0b c d e f\x1cg a\xa0b c d e f\x1cg"]
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in quality.counts(both, ["doc_id"]).collect()}
    for r in both.collect():
        assert got[r.doc_id] == brute(r.text), r


def test_binomial(spark):
    cases = [(k, n, p) for n in (1, 10, 400) for k in (0, 1, 3, 7) for p in (0.01, 0.3, 0.5)]
    for p in (0.01, 0.3, 0.5):
        df = spark.createDataFrame([(k, n) for k, n, q in cases if q == p], "k long, n long")
        for r in df.select("k", "n", F.exp(quality.log_binomial_cdf(F.col("k"), F.col("n"), p)).alias("v")).collect():
            want = sum(comb(r.n, j) * p**j * (1 - p)**(r.n - j) for j in range(min(r.k, r.n) + 1))
            assert r.v == pytest.approx(1.0 if r.k >= r.n * p else want)
    big = spark.createDataFrame([(450, 100000)], "k long, n long")
    v = big.select(F.exp(quality.log_binomial_cdf(F.col("k"), F.col("n"), 0.005))).first()[0]
    assert exp(-6) < v < 0.02  # about 2.2 standard deviations below the mean


def labelled(spark, n_good, n_bad, good_upper, stratum="x"):
    cols = "stratum string, quality int, n_words long, n_repeat_words long, n_lines long, n_dup_lines long, " \
           "word_chars long, n_symbols long, n_upper long"
    rows = [(stratum, 1, 100, 0, 10, 0, 500, 0, good_upper if i == 0 else 0) for i in range(n_good)]
    rows += [(stratum, 0, 100, 0, 10, 0, 500, 170, 0) for _ in range(n_bad)]
    return spark.createDataFrame(rows, cols)


def test_thresholds(spark):
    r = quality.thresholds(labelled(spark, 2000, 50, 0)).first()
    assert r.cut_symbols == 0.3  # the most lenient of those that catch all bad
    assert r.cut_upper is None and r.cut_dup_lines is None and r.cut_repeats is None
    assert quality.thresholds(labelled(spark, 100, 50, 0)).first().cut_symbols is None  # too few labels
    both = labelled(spark, 2000, 50, 0).union(labelled(spark, 100, 50, 0, None))
    assert {x.stratum: x.cut_symbols for x in quality.thresholds(both).collect()} == {"x": 0.3, None: None}


def test_guarantee_holds_on_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = quality.judge(docs, labels)
    good = out.join(labels.where("quality = 1"), "doc_id").where("not base_failed")
    for r in good.groupBy("stratum").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect():
        assert r.k >= 0.98
    bad = out.join(labels.where("quality = 0"), "doc_id").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert bad < 0.75


def plain_cutoffs(rows, risk=0.02, delta=0.05):
    """The rule's definition over (stratum, quality, counts) of holdout documents."""
    out, strata = {}, {r[0] for r in rows}
    sequences = [list(quality.RULES), *[[r] for r in quality.RULES]]
    for s in strata:
        own = [(q, {r: c[a] / max(c[b], 1) for r, ((a, b), _) in quality.RULES.items()}) for t, q, c in rows if t == s]
        n, options = sum(q for q, _ in own), []
        for of in sequences:
            sure = 0
            for i in range(quality.STEPS):
                k = sum(q == 1 and any(v[r] > quality.RULES[r][1][i] for r in of) for q, v in own)
                p = sum(comb(n, j) * risk**j * (1 - risk)**(n - j) for j in range(k + 1)) if k < n * risk else 1.0
                if p > delta / (len(sequences) * len(strata)):
                    break
                sure = i + 1
            total, cuts = 0, {}
            for r in of:
                gains = [(sum((q == 0) - (q == 1) for q, v in own if v[r] > c), c) for c in quality.RULES[r][1][:sure]]
                gain, cutoff = max(gains, default=(0, None))
                if gain > 0:
                    total, cuts[r] = total + gain, cutoff
            options.append((total, cuts))
        out[s] = max(options, key=lambda o: o[0])[1]
    return out


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_kept_against_the_definition(spark, sf):
    d = f"/root/testdata/sf{sf}"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.judge(docs, labels).collect()
    marks = {}
    for r in labels.collect():
        marks.setdefault(r.doc_id, set()).add(r.quality)
    marks = {i: q & {0, 1} for i, q in marks.items()}
    hold = [(r.stratum, next(iter(marks[r.doc_id])), r.asDict()) for r in got
            if not r.base_failed and len(marks.get(r.doc_id, ())) == 1]
    cuts = plain_cutoffs(hold)
    for r in got:
        own = cuts.get(r.stratum, {})
        above = any(own.get(rule) is not None and r[a] / max(r[b], 1) > own[rule]
                    for rule, ((a, b), _) in quality.RULES.items())
        assert r.kept == (not r.base_failed and not above), r
    sure = {s for s, c in cuts.items() if c}
    assert sure == ({"de", "en", "es", "fr"} if sf == "0.1" else set()), cuts  # sf0.01 has too few labels


def test_sequences_of_all_rules_and_of_one(spark):
    assert all(len(cuts) == quality.STEPS for _, cuts in quality.RULES.values())
    base = labelled(spark, 400, 50, 0)
    r = quality.thresholds(base).first()
    assert (r.decided, r.cut_symbols) == ("all", 0.3)
    # 40 good documents in capitals end the sequence of all rules at its fourth set, not that of symbols
    caps = base.union(labelled(spark, 40, 0, 0).withColumn("n_upper", F.lit(250)))
    assert quality.thresholds(caps).first().asDict() == {**r.asDict(), "n_good": 440}
    more = caps.union(labelled(spark, 0, 30, 0).withColumn("n_symbols", F.lit(60)))
    r = quality.thresholds(more).first()
    assert (r.decided, r.cut_symbols, r.cut_upper) == ("symbols", 0.1, None)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "a " * 30, "en", 2)],
                                 "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, None)], "doc_id long, quality int")
    out = quality.op5(docs, labels).collect()
    assert sorted((r.n_words, r.base_failed, r.kept) for r in out) == [(0, True, False)] * 2 + [(30, True, False)]
    assert quality.op5(docs.limit(0), labels.limit(0)).count() == 0
