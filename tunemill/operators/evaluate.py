"""Generation post-processing and evaluation.

Model outputs are rows; scoring is joins and aggregations. Token F1 counts
the token multiset overlap with a (example, token) aggregation after a
pre-partition by example, so both aggregation levels share one exchange and
the input is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip, tokenize


def strip_prompt_replace(full, prompt):
    """``full.replace(prompt, '').strip()`` (every occurrence removed)."""
    return py_strip(F.replace(full, prompt, F.lit("")))


def compare_outputs(expected: DataFrame, generated: DataFrame, key: str = "example_id",
                    ordered: bool = False) -> DataFrame:
    """Every expected row beside the generated one of its key (left join; null is a key like others); W7 with
    ``ordered`` (a global sort, wanted for a report, not for scoring).

    A key has one answer: of several the least by all its columns stands there, and ``n_answers`` says how
    many there were (0: none), so expected rows are never multiplied."""
    rest = [c for c in generated.columns if c != key]
    one = generated.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*rest)).alias("_one"), F.count(F.lit(1)).alias("_n"))
    out = expected.join(one, F.col(key).eqNullSafe(F.col("_key")), "left").select(
        *expected.columns, *[F.col(f"_one.{c}").alias(c) for c in rest], F.coalesce("_n", F.lit(0)).cast("long").alias("n_answers"))
    return out.orderBy(key) if ordered else out


def exact_match(cmp: DataFrame, pred: str = "generated", gold: str = "expected") -> DataFrame:
    """Share of rows whose stripped prediction equals the stripped gold."""
    eq = F.coalesce(py_strip(pred) == py_strip(gold), F.lit(False))
    return cmp.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.sum(F.when(eq, 1).otherwise(0)).alias("n_exact"),
                   F.round(F.avg(F.when(eq, 1.0).otherwise(0.0)), 6).alias("exact_rate"))


def token_f1(cmp: DataFrame, key: str = "example_id", pred: str = "generated",
             gold: str = "expected") -> DataFrame:
    """Per-row token F1 over token multisets (built-in tokenizer).

    Both empty -> 1, one empty -> 0. Rows are told apart by a number of their own, so rows with one
    key, or a null one, stay apart. One aggregation chain on one partitioning by that
    number: counts per (row, token), then per row the sizes
    (sums of the counts) and the overlap (sum of the smaller counts); the
    input is read once. ``explode_outer`` keeps rows with no tokens at all.
    """
    d = cmp.select(F.monotonically_increasing_id().alias("_row"), key, tokenize(F.coalesce(F.col(pred), F.lit(""))).alias("_p"),
                   tokenize(F.coalesce(F.col(gold), F.lit(""))).alias("_g")).repartition("_row")
    toks = d.select("_row", key, F.explode_outer(F.concat(
        F.transform("_p", lambda t: F.struct(t.alias("t"), F.lit(1).alias("ip"), F.lit(0).alias("ig"))),
        F.transform("_g", lambda t: F.struct(t.alias("t"), F.lit(0).alias("ip"), F.lit(1).alias("ig")))
    )).alias("x")).select("_row", key, "x.t", F.coalesce("x.ip", F.lit(0)).alias("ip"),
                          F.coalesce("x.ig", F.lit(0)).alias("ig"))
    per_tok = toks.groupBy("_row", key, "t").agg(F.sum("ip").alias("cp"), F.sum("ig").alias("cg"))
    j = per_tok.groupBy("_row", key).agg(F.sum("cp").cast("int").alias("np"),
                                 F.sum("cg").cast("int").alias("ng"),
                                 F.sum(F.least("cp", "cg")).alias("overlap"))
    p = F.col("overlap") / F.col("np")
    r = F.col("overlap") / F.col("ng")
    f1 = (F.when((F.col("np") == 0) & (F.col("ng") == 0), F.lit(1.0))
          .when((F.col("np") == 0) | (F.col("ng") == 0) | (F.col("overlap") == 0), F.lit(0.0))
          .otherwise(2 * p * r / (p + r)))
    return j.select(key, "np", "ng", "overlap", F.round(f1, 6).alias("f1"))


# ------------------------------------------------------ benchmark scoring
def accuracy_rollup(preds: DataFrame, gold: DataFrame) -> DataFrame:
    """J2 + A5: every model against every gold item; accuracy per model and
    benchmark, per model, and overall (ROLLUP, told apart by ``grouping_id``).

    An item that a model left out counts as wrong and in ``n_unanswered``. Items
    are counted per benchmark, so gold is not repeated per model: only the few
    benchmark totals are (a scalar subquery). An item counts once: of several answers of a model, or several gold rows,
    the least counts (``repeated_answers`` lists the others); null benchmarks and items are keys like others.
    Answers and gold are dealt out by (benchmark, item) once, for both the counting once and the join.
    """
    item = ["benchmark", "item_id"]
    gold = gold.groupBy(*item).agg(F.min("gold").alias("gold"))
    answers = preds.repartition(*item).groupBy("model", *item).agg(F.min("predicted").alias("predicted"))
    ok = F.when(F.col("predicted") == F.col("gold"), 1).otherwise(0)
    known = gold.select(F.col("benchmark").alias("_b"), F.col("item_id").alias("_i"), "gold")
    given = (answers.join(known, F.col("benchmark").eqNullSafe(F.col("_b")) & F.col("item_id").eqNullSafe(F.col("_i")), "inner")
             .groupBy("model", "benchmark").agg(F.count(F.lit(1)).alias("n_answered"), F.sum(ok).alias("n_correct")))
    totals = gold.groupBy("benchmark").agg(F.count(F.lit(1)).alias("n_items"))
    every = preds.select("model").distinct().select("model", F.inline(
        totals.agg(F.collect_list(F.struct("benchmark", "n_items"))).scalar()))
    got = given.select(F.col("model").alias("m"), F.col("benchmark").alias("b"), "n_answered", "n_correct")
    per = every.join(got, F.col("model").eqNullSafe(F.col("m")) & F.col("benchmark").eqNullSafe(F.col("b")), "left")
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per.rollup("model", "benchmark").agg(
        F.grouping_id().cast("long").alias("grouping_id"), n("n_items").alias("n_items"),
        n("n_correct").alias("n_correct"), (n("n_items") - n("n_answered")).alias("n_unanswered"),
        F.round(n("n_correct") / n("n_items"), 6).alias("accuracy"))


def repeated_answers(preds: DataFrame) -> DataFrame:
    """(model, benchmark, item_id, ``n_answers``) where a model answered an item more than once."""
    return (preds.groupBy("model", "benchmark", "item_id").agg(F.count(F.lit(1)).alias("n_answers")).where("n_answers > 1"))


def rubric_pivot(scores: DataFrame, criteria=("coherence", "empathy", "factuality")) -> DataFrame:
    """Mean score per model and criterion, criteria as columns."""
    return (scores.groupBy("model").pivot("criterion", list(criteria))
            .agg(F.round(F.avg("score"), 6)))


def win_tie_loss(scores: DataFrame, model_a: str, model_b: str, group: str = "benchmark") -> DataFrame:
    """J3 + A7: per prompt, total score of A against B; counts of wins, ties
    and losses of A. The pairing is a conditional aggregation per prompt (one
    shuffle) instead of a self-join."""
    per = (scores.where(F.col("model").isin(model_a, model_b))
           .groupBy(group, "prompt_id")
           .agg(F.sum(F.when(F.col("model") == model_a, F.col("score"))).alias("sa"),
                F.sum(F.when(F.col("model") == model_b, F.col("score"))).alias("sb"))
           .where(F.col("sa").isNotNull() & F.col("sb").isNotNull()))
    return per.groupBy(group).agg(
        F.sum(F.when(F.col("sa") > F.col("sb"), 1).otherwise(0)).alias("wins"),
        F.sum(F.when(F.col("sa") == F.col("sb"), 1).otherwise(0)).alias("ties"),
        F.sum(F.when(F.col("sa") < F.col("sb"), 1).otherwise(0)).alias("losses"))
