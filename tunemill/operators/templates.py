"""Prompt templates (P1-P7) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (ALPACA_CLOSE, ALPACA_HEAD, ALPACA_INPUT, ALPACA_RESPONSE,
                      HISTORY_OTHER_TAIL, HISTORY_USER_HEAD, HISTORY_USER_TAIL,
                      INST_ANSWER_TAIL, INST_PROMPT_HEAD, INST_PROMPT_TAIL,
                      MCQ_LETTERS, MCQ_NO_OPTION, ROLE_PROMPT_HEAD,
                      SINGLE_TURN_TAIL)
from ..functions.text import py_strip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def inst_prompt(instruction="instruction", input_="input") -> Column:
    """P1 prompt, no stripping; a missing input renders as empty (P10)."""
    return F.concat(F.lit(INST_PROMPT_HEAD), _c(instruction), F.lit(" "),
                    F.coalesce(_c(input_), F.lit("")), F.lit(INST_PROMPT_TAIL))


def inst_answer(output="output") -> Column:
    return F.concat(_c(output), F.lit(INST_ANSWER_TAIL))


def alpaca_prompt(instruction="instruction", input_="input") -> Column:
    """P2 with F1: the input block only when non-empty after strip."""
    inp = py_strip(F.coalesce(_c(input_), F.lit("")))
    return F.concat(F.lit(ALPACA_HEAD), py_strip(_c(instruction)),
                    F.when(F.length(inp) > 0, F.concat(F.lit(ALPACA_INPUT), inp))
                    .otherwise(F.lit("")),
                    F.lit(ALPACA_CLOSE))


def alpaca_answer(output="output") -> Column:
    """P3."""
    return F.concat(F.lit(ALPACA_RESPONSE), py_strip(_c(output)), F.lit(INST_ANSWER_TAIL))


def role_prompt(user="user_text") -> Column:
    """Fixed doctor role, user text as given."""
    return F.concat(F.lit(ROLE_PROMPT_HEAD), _c(user), F.lit(INST_PROMPT_TAIL))


def single_turn_prompt(msg="text") -> Column:
    """P5."""
    return F.concat(F.lit(ALPACA_HEAD), py_strip(_c(msg)), F.lit(SINGLE_TURN_TAIL))


def history_part(role="role", text="text") -> Column:
    """P6 for one message: user form, or the assistant form for any other role."""
    msg = py_strip(_c(text))
    return F.when(_c(role) == "user",
                  F.concat(F.lit(HISTORY_USER_HEAD), msg, F.lit(HISTORY_USER_TAIL))
                  ).otherwise(F.concat(msg, F.lit(HISTORY_OTHER_TAIL)))


def render(df: DataFrame, template: str = "inst") -> DataFrame:
    """Adds ``prompt`` and ``answer`` for the chosen template; without an ``input``
    column every input is empty (P10)."""
    if "input" not in df.columns:
        df = df.withColumn("input", F.lit(""))
    if template == "inst":
        return df.withColumn("prompt", inst_prompt()).withColumn("answer", inst_answer())
    if template == "alpaca":
        return df.withColumn("prompt", alpaca_prompt()).withColumn("answer", alpaca_answer())
    raise ValueError(f"unknown template {template!r}")


def mcq_text(question="question", options="options") -> Column:
    """``Question: q\\nOptions: A) .. B) .. C) .. D) ..\\nAnswer:``."""
    opts = F.transform(_c(options), lambda o, i: F.concat(
        F.element_at(F.array(*[F.lit(x) for x in MCQ_LETTERS]), i + 1), F.lit(") "), o))
    return F.concat(F.lit("Question: "), _c(question), F.lit("\nOptions: "),
                    F.array_join(opts, " "), F.lit("\nAnswer:"))


def mcq_items(benchmark: DataFrame) -> DataFrame:
    """MCQ items from ``benchmark``: question, four options, gold letter.

    The right answer goes to the slot chosen by the first hex digit of
    md5(item_id); the other slots take the answers of items id+1..id+3
    (one equi-join on the shifted id), else a fixed filler.
    """
    text = F.col("text")
    dot = F.instr(text, ".")
    items = benchmark.select(
        "item_id",
        F.when(dot > 0, F.substring(text, 1, dot)).otherwise(text).alias("question"),
        F.when(dot > 0, py_strip(F.expr("substring(text, instr(text, '.') + 1)")))
        .otherwise(F.lit("")).alias("answer"))
    probes = items.select("item_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k"))
    probes = probes.withColumn("other_id", F.col("item_id") + F.col("k"))
    others = items.select(F.col("item_id").alias("other_id"), F.col("answer").alias("other"))
    dis = (probes.join(others, "other_id", "left")
           .groupBy("item_id")
           .agg(F.sort_array(F.collect_list(F.struct("k", F.coalesce("other", F.lit(MCQ_NO_OPTION))
                                                      .alias("o")))).alias("d")))
    g = F.ascii(F.substring(F.md5(F.col("item_id").cast("string")), 1, 1)) % 4
    d = F.transform("d", lambda x: x["o"])
    slots = [F.when(g == i, F.col("answer"))
             .otherwise(F.element_at(d, F.when(g > i, F.lit(i + 1)).otherwise(F.lit(i))))
             for i in range(4)]
    return (items.join(dis, "item_id", "left")
            .select("item_id", "question", "answer", F.array(*slots).alias("options"),
                    F.element_at(F.array(*[F.lit(x) for x in MCQ_LETTERS]), (g + 1).cast("int"))
                    .alias("gold")))
