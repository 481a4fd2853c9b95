"""Language identification (operator 4): sparse multinomial logistic regression on
TF-IDF character n-grams, trained with follow-the-regularised-leader and
elastic-net penalties, then calibrated by a temperature.

Features. Letters are lower-cased, everything between two runs of letters is one
blank, and the n-grams of 1 to 3 characters are hashed into ``BUCKETS``; a text
is the relative frequency of each bucket times the bucket's inverse document
frequency. All of a text counts; its n-grams are hashed in blocks, so a task holds the
text, its letters (four bytes each) and one block.

Training. Document frequencies are summed over all training documents: one
counter per bucket and task, then by bucket. The classifier is fitted on a
bounded sample: of each language exactly the ``PER_LANGUAGE`` rows (or all, if fewer) with the
smallest hashes of id and text (a documented parameter), so neither a repeated id nor a repeated
row makes it larger. More than ``LANGUAGES`` labels are an error. A sampled document is at
most ``BUCKETS`` (bucket, weight) pairs, so what the driver receives is bounded
by the sample whatever the texts' length. A fifth of the sample fits the
temperature and trains nothing. Weights (languages x ``BUCKETS``) go to the
tasks, which predict every whole text; nothing is shuffled there.

Defined results: a null text or one without a letter gets ``und`` with score 0;
without labelled training documents every text does; a null label trains
nothing; repeated rows count (and are predicted) each; other columns, whatever
their names, are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh

BITS = 15
BUCKETS = 1 << BITS
ORDERS = 3
PER_LANGUAGE = 600
LANGUAGES = 1000
BLOCK = 1 << 18  # characters of a text that are hashed at once
UNKNOWN = "und"


def _letter_table() -> np.ndarray:
    """Code point -> lower-case letter, or a blank; by Python's own tables."""
    table = np.full(0x110000, 0x20, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_TABLE: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """The text's lower-cased letters as code points, a blank around every run of them."""
    if not _TABLE:
        _TABLE.append(_letter_table())
    points = _TABLE[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = points == 0x20
    keep = ~blank
    keep[1:] |= keep[:-1] & blank[1:]  # the first blank after a letter
    points = points[keep]
    if not len(points) or not (points != 0x20).any():
        return points[:0]
    edge = np.array([0x20], np.uint32)
    return np.concatenate([edge, points] if points[-1] == 0x20 else [edge, points, edge])


def buckets(points: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams, block after block."""
    for a in range(0, len(points), BLOCK):
        p = points[a:a + BLOCK + ORDERS - 1].astype(np.uint32)
        n = min(BLOCK, len(points) - a)
        h, out = np.zeros(len(p), np.uint32), []
        for order in range(1, ORDERS + 1):
            if len(p) < order:
                break
            m = len(p) - order + 1
            h = (h[:m] * np.uint32(0x01000193)) ^ p[order - 1:]
            x = (h + np.uint32(order)) * np.uint32(0x9E3779B1)
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x85EBCA77)
            out.append((x >> np.uint32(32 - BITS))[:n])
        yield np.concatenate(out).astype(np.intp)


def frequencies(points: np.ndarray) -> np.ndarray:
    """How often each bucket occurs in the letters of a text."""
    total = np.zeros(BUCKETS, np.int64)
    for b in buckets(points):
        total += np.bincount(b, minlength=BUCKETS)
    return total


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float

    def scaled(self) -> np.ndarray:
        return (self.idf[:, None] * self.weights).astype(np.float32)


class Ftrl:
    """Follow the regularised leader, per coordinate, elastic net (l1 and l2)."""

    def __init__(self, buckets: int, classes: int, alpha=2.0, beta=1.0, l1=1e-3, l2=1e-3):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((buckets + 1, classes))  # the last row is the bias
        self.n = np.zeros((buckets + 1, classes))

    def weights(self, rows) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, rows: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(rows)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        sigma = (np.sqrt(self.n[rows] + g * g) - np.sqrt(self.n[rows])) / self.alpha
        self.z[rows] += g - sigma * w
        self.n[rows] += g * g


def softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(samples: list[tuple[str, bytes, bytes, float]], doc_freq: np.ndarray, n_docs: int,
        epochs: int = 5, seed: int = 1) -> Model | None:
    """A model from (language, buckets, counts, fold in 0..1) of sampled documents."""
    languages = sorted({s[0] for s in samples})
    if not languages:
        return None
    idf = np.log((1 + n_docs) / (1 + doc_freq)) + 1
    number = {x: i for i, x in enumerate(languages)}
    rows = []
    for lang, at, count, fold in samples:
        at, count = np.frombuffer(at, "<i4").astype(np.intp), np.frombuffer(count, "<i8")
        if len(at):
            x = count / count.sum() * idf[at]
            rows.append((number[lang], np.append(at, BUCKETS), np.append(x / np.linalg.norm(x), 1.0), fold))
    train = [r for r in rows if r[3] >= 0.2] or rows
    held = [r for r in rows if r[3] < 0.2] or rows
    ftrl, rng = Ftrl(BUCKETS, len(languages)), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            label, at, x, _ = train[i]
            ftrl.learn(at, x, label)
    w = ftrl.weights(np.arange(BUCKETS + 1))
    temperature = 1.0
    if held:
        logits = np.array([x @ w[at] for _, at, x, _ in held])
        label = np.array([r[0] for r in held])
        temperature = calibrate(logits, label)
    return Model(languages, idf, w[:-1], w[-1], temperature)


def calibrate(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature with the least log loss (golden section on its logarithm)."""
    def loss(log_t):
        p = softmax(logits / np.exp(log_t))[np.arange(len(label)), label]
        return -np.log(np.maximum(p, 1e-300)).mean()

    a, b, r = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def document_frequencies(texts: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Over all rows: in how many texts each bucket occurs, and how many texts there are."""
    at = texts.columns.index(text_col)

    def run(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(at):
                seen = np.zeros(BUCKETS, bool)
                for b in buckets(letters(text.as_py() or "")):
                    seen[b] = True
                total += seen
                n += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*found.tolist(), -1], pa.int32()), pa.array([*total[found].tolist(), n], pa.int64())],
            ["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    freq, n = np.zeros(BUCKETS, np.int64), 0  # at most BUCKETS + 1 rows
    for r in rows:
        if r.bucket < 0:
            n = r.n
        else:
            freq[r.bucket] = r.n
    return freq, n


def sample(training: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> list[tuple]:
    """Bucket counts of a bounded sample of each language, picked by a hash of id and text."""
    # Written, so that Spark sees its size before it plans the join: no text is shuffled but the sample's.
    per = cut(training.groupBy(F.col(lang_col).alias("_lang")).agg(F.count(F.lit(1)).alias("_n")), "languages")
    if len(per.limit(LANGUAGES + 1).collect()) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    unit = lambda salt, *of: (F.xxhash64(F.lit(salt), *of) / F.lit(2.0**64) + 0.5)
    # About twice the sample by its expected share, then exactly the smallest hashes: the limit is taken in every task first.
    least = Window.partitionBy("lang").orderBy("u")
    picked = (training.select(id_col, text_col, lang_col, unit("pick", id_col, text_col).alias("u"), unit("fold", id_col).alias("fold"))
              .join(per, F.col(lang_col) == F.col("_lang"))
              .where(F.col("u") * F.col("_n") < 2 * per_language + 100)
              .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), "fold", "u")
              .withColumn("_r", F.row_number().over(least)).where(F.col("_r") <= per_language).select("lang", "text", "fold"))

    def run(batches):
        for batch in batches:
            out = []
            for lang, text, fold in zip(*(c.to_pylist() for c in batch.columns)):
                f = frequencies(letters(text or ""))
                at = np.flatnonzero(f)
                out.append((lang, at.astype("<i4").tobytes(), f[at].astype("<i8").tobytes(), fold))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4,
                                                (pa.string(), pa.binary(), pa.binary(), pa.float64()))],
                ["lang", "at", "count", "fold"])

    rows = picked.mapInArrow(run, "lang string, at binary, count binary, fold double").collect()
    return sorted((r.lang, bytes(r["at"]), bytes(r["count"]), r.fold) for r in rows)


def train(training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model | None:
    """A model of the labelled rows; None if there are none."""
    own = training.select(id_col, text_col, lang_col).where(F.col(lang_col).isNotNull())
    freq, n = document_frequencies(own.select(text_col), text_col)
    return fit(sample(own, id_col, text_col, lang_col, per_language), freq, n)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (named anew if taken)."""
    names = [fresh(docs, "lang_pred"), fresh(docs, "score")]
    at = docs.columns.index(text_col)
    if model is not None:
        scaled, idf2 = model.scaled(), (model.idf**2).astype(np.float64)
        languages, bias, temperature = model.languages, model.bias, model.temperature

    def one(text):
        points = letters(text or "")
        if model is None or not len(points):
            return UNKNOWN, 0.0
        count = frequencies(points)
        found = np.flatnonzero(count)
        x = count[found].astype(np.float64)
        p = softmax(((x @ scaled[found]) / np.sqrt(x * x @ idf2[found]) + bias) / temperature)
        k = int(p.argmax())
        return languages[k], float(p[k])

    def run(batches):
        for batch in batches:
            found = [one(x.as_py()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())], [*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4: such rows train nothing."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Training on the rows that are not held out, then a prediction for every row."""
    return predict(docs, train(docs.where(~held_out(id_col)), id_col, text_col, lang_col), text_col)


def keep_identified(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """``docs`` without those that are ``und`` or whose language scores under ``min_score``."""
    out = identify(docs)
    lang, score = out.columns[-2:]
    return out.where((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4(docs: DataFrame) -> DataFrame:
    """The row per document of the dealt query."""
    own = docs.select("doc_id", "text", "lang")
    model = train(own.where(~held_out("doc_id")))
    return (predict(own.select("doc_id", "text"), model)
            .select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"))
