import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunemill.llm import langid


def naive(text):
    s = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    s = " " + " ".join(s.split(" ")).strip() + " "
    s = " " + " ".join(x for x in s.split(" ") if x) + " "
    return [] if not s.strip() else [s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)]


def test_all_ngrams_count(monkeypatch):
    texts = ["", "12 3!", "a", "Ab  c", "  éÈ, x1y\nİ z", "ab" * 5000]
    for block in (langid.BLOCK, 7):
        monkeypatch.setattr(langid, "BLOCK", block)
        for t in texts:
            assert langid.frequencies(langid.letters(t)).sum() == len(naive(t)), t
    whole = langid.frequencies(langid.letters("the cat sat on the mat " * 40))
    monkeypatch.setattr(langid, "BLOCK", 11)
    assert (whole == langid.frequencies(langid.letters("the cat sat on the mat " * 40))).all()


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    ftrl = langid.Ftrl(20, 2, l1=0.5)
    for _ in range(400):
        y = int(rng.integers(2))
        x = rng.normal(0, 0.1, 20)
        x[y] += 1
        ftrl.learn(np.arange(21), np.append(x, 1.0), y)
    w = ftrl.weights(np.arange(21))
    assert w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0 > w[1, 0]
    assert (w[2:20] == 0).mean() > 0.5


def test_calibration():
    rng = np.random.default_rng(0)
    logits = rng.normal(0, 2, (4000, 3))
    label = np.array([rng.choice(3, p=p) for p in langid.softmax(logits)])
    assert langid.calibrate(logits * 5, label) == pytest.approx(5, rel=0.15)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.op4(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r.lang == r.lang_pred for r in out if r.held_out]
    assert sum(held) / len(held) > 0.98
    sure = np.mean([r.score for r in out if r.held_out])
    assert abs(sure - sum(held) / len(held)) < 0.03


def test_edges(spark):
    rows = [(i, "the and of with " * 5, "en", 1.0) for i in range(60)]
    rows += [(100 + i, "der die und das " * 5, "de", 1.0) for i in range(60)]
    rows += [(1000, None, "en", 0.0), (1001, "", "de", 0.0), (1002, "12 %% \n", None, 0.0), (None, "das und die", None, 0.0),
             (1, "the and of with " * 5, "en", 1.0), (1003, "of the and " * 50_000, "de", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = langid.identify(df)
    assert out.columns == ["doc_id", "text", "lang", "score", "lang_pred", "score_1"]
    got = {r.doc_id: (r.lang_pred, r.score_1) for r in out.collect()}
    assert out.count() == len(rows)
    assert got[1000] == got[1001] == got[1002] == ("und", 0.0)
    assert got[None][0] == "de" and got[1003][0] == "en" and got[5][0] == "en"
    assert langid.keep_identified(df).count() == len(rows) - 3
    assert langid.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.op4(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_the_sample_is_bounded_whatever_the_ids(spark, monkeypatch):
    """One id, null ids and one repeated row make it no larger; too many languages are refused."""
    rows = [(1, f"text number {i} of many", "aa") for i in range(400)] + [(None, f"another {i}", "bb") for i in range(300)]
    rows += [(5, "the same words again", "cc")] * 500 + [(6, "only one", "dd")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = langid.sample(df, "doc_id", "text", "lang", 50)
    count = {x: sum(r[0] == x for r in got) for x in ("aa", "bb", "cc", "dd")}
    assert count["aa"] == count["bb"] == 50 and count["cc"] <= 50 and count["dd"] == 1
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3 languages"):
        langid.sample(df, "doc_id", "text", "lang", 50)


def test_training_and_prediction_against_a_plain_version(spark):
    """TF-IDF, regularised leader steps and the softmax, one weight at a time."""
    import math
    from collections import Counter
    rng = random.Random(3)
    words = {"aa": ["der", "die", "und", "nicht"], "bb": ["the", "and", "not", "with"]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(12)), x) for i in range(60) for x in ("aa", "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    freq, n = langid.document_frequencies(df.select("text"), "text")
    assert n == 120
    held = Counter()
    for _, t, _ in rows:
        held.update(np.flatnonzero(langid.frequencies(langid.letters(t))).tolist())
    assert {b: int(freq[b]) for b in np.flatnonzero(freq)} == dict(held)
    model = langid.train(df)
    scaled = model.scaled()
    for _, text, lang in rows[:10]:
        count = langid.frequencies(langid.letters(text))
        norm = math.sqrt(sum((int(c) * float(model.idf[b])) ** 2 for b, c in enumerate(count) if c))
        z = [sum(int(count[b]) * float(scaled[b, k]) for b in np.flatnonzero(count)) / norm + float(model.bias[k])
             for k in range(len(model.languages))]
        e = [math.exp(x / model.temperature - max(z) / model.temperature) for x in z]
        want = max(e) / sum(e)
        row = langid.predict(spark.createDataFrame([(text,)], "text string"), model).first()
        assert row.lang_pred == lang and abs(row.score - want) < 1e-9


def test_leader_steps_against_single_weights():
    import math
    rng = random.Random(9)
    model = langid.Ftrl(5, 2)
    z, n = [[0.0, 0.0] for _ in range(6)], [[0.0, 0.0] for _ in range(6)]

    def weight(i, k):
        if abs(z[i][k]) <= model.l1:
            return 0.0
        return -(z[i][k] - math.copysign(model.l1, z[i][k])) / ((model.beta + math.sqrt(n[i][k])) / model.alpha + model.l2)
    for _ in range(200):
        rows = sorted(rng.sample(range(6), 3))
        x, label = [rng.random() for _ in rows], rng.randrange(2)
        model.learn(np.array(rows), np.array(x), label)
        w = {i: [weight(i, 0), weight(i, 1)] for i in rows}
        e = [math.exp(sum(a * w[i][k] for i, a in zip(rows, x))) for k in (0, 1)]
        for i, a in zip(rows, x):
            for k in (0, 1):
                g = a * (e[k] / sum(e) - (k == label))
                z[i][k] += g - (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / model.alpha * w[i][k]
                n[i][k] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)
    assert np.allclose(model.weights(np.arange(6)), [[weight(i, k) for k in (0, 1)] for i in range(6)])
