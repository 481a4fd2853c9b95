"""Quality rules with risk-controlled thresholds (operator 5), DataFrame functions only.

Counts of a text (words, symbols, repeated lines and windows) feed a fixed base
rule and a few ratio rules. The ratio rules have no fixed cutoff: per stratum
(language), labelled documents that pass the base rule serve as a holdout. The
cutoffs form fixed sequences of sets, from lenient to strict: one for all rules, whose set
``i`` rejects a document if any rule is above its ``i``-th cutoff, and one for each
rule alone. A set is certified if the exact binomial test refutes "it rejects more
than ``risk`` of the good documents": P(Binomial(n_good, risk) <= good documents that
the set rejects) at most ``delta / (sequences * strata)``. Unions are counted directly,
so rules share no risk; within a sequence, which stops at its first failure, no
correction is needed; sequences and strata share ``delta`` (Bonferroni). Rejected
documents only grow along a sequence, so its certified sets are its beginning, and
whatever takes of each rule in it no cutoff or one of a certified set rejects no more than
that set does. Within this freedom a rule takes the cutoff whose rejected bad minus
rejected good is largest, the most lenient of equals, or none without a gain. The
sequence with the largest sum of these gains decides (of equals that of all rules,
then in their order). With few labels nothing can be certified and nothing is
rejected: with no good one rejected it takes
ln(delta / (sequences * strata)) / ln(1 - risk) of them.

One pass computes all counts in the row; their narrow table is written once.
Labels join it by id; what is summed per stratum has partial aggregation.
Thresholds are one row per stratum and join by stratum, as a broadcast only
where Spark sees that they are small.

Defined results: null or blank text has no words and fails the base rule; a null
stratum is a stratum; labels that are null, conflict for an id or name no
document calibrate nothing; repeated labels count once; repeated documents are
each returned (and each calibrate).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import log
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, cut, words

# FIXED VALUES of the base rule.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Ratio rules: (numerator, denominator), cutoffs from lenient to strict, as many for each rule.
RULES = {
    "symbols": (("n_symbols", "word_chars"), (0.6, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02)),
    "upper": (("n_upper", "word_chars"), (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1)),
    "dup_lines": (("n_dup_lines", "n_lines"), (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05)),
    "repeats": (("n_repeat_words", "n_words"), (0.19, 0.17, 0.15, 0.12, 0.1, 0.08, 0.05, 0.02)),
}
STEPS = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row (not once per use in a lambda)."""
    return F.get(F.transform(F.array(value), body), 0)


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeat_words(w: Column) -> Column:
    """Words covered by windows of five words that occur twice or more in the array.

    Windows are compared by a 64-bit hash within one text. Only texts with an
    equal pair sort their windows; the rest stop at the distinct count.
    """
    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            same = lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | F.coalesce(
                F.get(s, j + 1)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        def union(p: Column) -> Column:
            step = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(
                F.get(p, j + 1) - x, F.lit(WINDOW))))
            return F.aggregate(step, F.lit(0), lambda a, x: a + x)

        return let(let(ordered, marked), union)

    windows = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
                          lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    return F.when(F.size(w) <= WINDOW, 0).otherwise(let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))


def counts(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` with the counts of each text and ``base_failed``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    long = lambda c, name: c.cast("long").alias(name)
    lines = F.filter(F.split(text, "\n", -1), lambda x: without(x, WHITE) != "")
    of_words = let(words(F.col(text_col)), lambda w: F.struct(
        long(F.size(w), "n_words"), long(repeat_words(w), "n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(
        long(F.size(x), "n_lines"), long(F.size(x) - F.size(F.array_distinct(x)), "n_dup_lines")))
    chars = F.char_length(text)
    out = docs.select(
        *keys, of_words.alias("_w"), of_lines.alias("_l"),
        long(F.char_length(without(text, WHITE)), "word_chars"),
        long(chars - F.char_length(without(text, SYMBOLS)), "n_symbols"),
        long(chars - F.char_length(F.regexp_replace(text, r"\p{Lu}", "")), "n_upper"))
    out = out.select(*keys, "_w.*", "_l.*", "word_chars", "n_symbols", "n_upper")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def value(rule: str) -> Column:
    (a, b), _ = RULES[rule]
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """log P(Binomial(n, p) <= k), summed term by term in logarithms; 0 (no
    evidence) where k is at or above the mean, so at most n * p terms are summed."""
    first = n * log(1 - p)
    odds = log(p) - log(1 - p)

    def add(acc: Column, j: Column) -> Column:
        term = acc["t"] + F.log((n - j + 1) / j) + odds
        high, low = F.greatest(acc["s"], term), F.least(acc["s"], term)
        return F.struct(term.alias("t"), (high + F.log1p(F.exp(low - high))).alias("s"))

    total = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.struct(first.alias("t"), first.alias("s")),
                        add, lambda acc: acc["s"])
    return F.when(k >= n * p, 0.0).when(k == 0, first).otherwise(total)


def thresholds(labelled: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """One row per stratum of ``labelled`` (``stratum``, ``quality`` 0 or 1, counts of
    documents that pass the base rule): ``n_good``, ``decided`` (the sequence that
    decides) and the chosen cutoff per rule, or null."""
    good = F.col("quality") == 1
    sequences = {"all": list(RULES), **{rule: [rule] for rule in RULES}}
    sums = [F.count_if(good).alias("n_good")]
    for i in range(STEPS):
        above = {rule: value(rule) > cutoffs[i] for rule, (_, cutoffs) in RULES.items()}
        sums += [F.count_if(good & reduce(or_, [above[r] for r in of])).alias(f"good_{name}_{i}")
                 for name, of in sequences.items()]
        sums += [F.count_if(~good & hit).alias(f"bad_{rule}_{i}") for rule, hit in above.items()]
    per = labelled.groupBy("stratum").agg(*sums)
    per = per.withColumn("strata", F.count(F.lit(1)).over(
        Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    level = F.log(F.lit(delta) / (len(sequences) * F.col("strata")))

    def certified(name: str) -> Column:
        """How many sets of the sequence pass before the first that does not."""
        passed = F.array(*[log_binomial_cdf(F.col(f"good_{name}_{i}"), F.col("n_good"), risk) <= level
                           for i in range(STEPS)])
        return F.coalesce(F.nullif(F.array_position(passed, False), F.lit(0)) - 1, F.lit(STEPS)).cast("int")

    def best(name: str, rule: str) -> Column:
        tries = F.array(*[F.struct((F.col(f"bad_{rule}_{i}") - F.col(f"good_{rule}_{i}")).alias("gain"),
                                   F.lit(float(c)).alias("cutoff")) for i, c in enumerate(RULES[rule][1])])
        return F.array_max(F.filter(F.slice(tries, F.lit(1), F.col(f"sure_{name}")), lambda t: t["gain"] > 0))

    per = per.select("*", *[certified(name).alias(f"sure_{name}") for name in sequences])
    options = []
    for at, (name, of) in enumerate(sequences.items()):
        found = {rule: best(name, rule) for rule in of}
        none = F.lit(None).cast("double")
        options.append(F.struct(
            reduce(lambda a, b: a + b, [F.coalesce(f["gain"], F.lit(0)) for f in found.values()]).alias("gain"),
            F.lit(-at).alias("order"), F.lit(name).alias("name"),
            *[(found[r]["cutoff"] if r in found else none).alias(f"cut_{r}") for r in RULES]))
    chosen = per.select("stratum", "n_good", F.array_max(F.array(*options)).alias("one"))
    return chosen.select("stratum", "n_good", F.col("one.name").alias("decided"),
                         *[F.col(f"one.cut_{r}") for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``id_col``, ``stratum``, the counts, ``base_failed`` and ``kept`` per document."""
    own = docs.select(F.col(id_col), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col))
    found = cut(counts(own, [id_col, "stratum"], text_col), "quality")
    agreed = (labels.where(F.col("quality").isin(0, 1)).groupBy(F.col(id_col).alias("_id"))
              .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
              .where(F.col("quality") == F.col("_most")).drop("_most"))
    labelled = found.where(~F.col("base_failed")).join(agreed, F.col(id_col) == F.col("_id"))
    cuts = cut(thresholds(labelled, risk, delta).withColumnRenamed("stratum", "_stratum"), "cutoffs")
    judged = found.join(cuts, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(value(rule) > F.col(f"cut_{rule}"), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("_stratum", "n_good", "decided")


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The row per document of the dealt query."""
    return judge(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
