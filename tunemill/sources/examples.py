"""Instruction examples derived from the driver's tables.

* ``dialogue``: a user turn whose next turn is an assistant's is one example;
  instruction = the conversation's system text, else the doctor instruction.
* ``mcq``: benchmark text up to and including the first '.' is the input,
  the rest (stripped) the output; it may be blank and is then rejected.
* ``docs``: first line is the input, the other lines the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DOCS_INSTRUCTION, DOCTOR_INSTRUCTION, MCQ_INSTRUCTION
from ..functions.text import py_strip

EXAMPLE_COLS = ["source", "example_id", "instruction", "input", "output"]


def turn_id(conv="conv_id", turn="turn") -> Column:
    """Example id of a turn: ``<conv_id>:<turn>``, unique for any number of turns."""
    return F.concat_ws(":", F.col(conv).cast("string"), F.col(turn).cast("string"))


def dialogue_pairs(turns: DataFrame, keep_turn_cols: bool = False, block: int = 4096) -> DataFrame:
    """Pairs (user turn, next existing turn if it is an assistant's) of one conversation.

    The next turn is a ``lead`` within blocks of ``block`` turn numbers; across
    blocks it is the first turn of the next block that exists. What a block
    needs of its conversation (that turn, the system text) comes from one row
    per block, so a very long conversation is spread over many tasks and no
    join or window is keyed by the conversation alone except over those rows. A first look at the
    turn numbers tells whether any conversation has more than one block; if none has, one window does.
    Rows without a conversation or turn cannot be paired.
    """
    t = (turns.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
         .select("conv_id", "turn", "role", "text", F.floor(F.col("turn") / block).alias("_blk")))
    here = F.struct("turn", "role", "text")
    said = F.when(F.col("role") == "system", F.struct("turn", "text"))
    own = Window.partitionBy("conv_id", "_blk")
    inner = F.lead(here).over(own.orderBy("turn", "role", "text"))
    span = t.agg(F.min("_blk").alias("a"), F.max("_blk").alias("b")).first()
    if span.a == span.b:  # no conversation has a second block: nothing comes from another one
        j = t.select("*", inner.alias("_next"), F.min(said).over(own)["text"].alias("system_text"))
    else:
        per = t.groupBy(F.col("conv_id").alias("c"), F.col("_blk").alias("b")).agg(F.min(here).alias("first"), F.min(said).alias("sys"))
        conv = Window.partitionBy("c")
        per = per.select("c", "b", F.lead("first").over(conv.orderBy("b")).alias("_after"), F.min("sys").over(conv)["text"].alias("system_text"))
        j = (t.join(per, (F.col("conv_id") == F.col("c")) & (F.col("_blk") == F.col("b")))
             .withColumn("_next", F.coalesce(inner, "_after")))
    pairs = j.where((F.col("role") == "user") & (F.col("_next.role") == "assistant"))
    out = pairs.select(
        F.lit("dialogue").alias("source"), turn_id().alias("example_id"),
        F.coalesce(F.col("system_text"), F.lit(DOCTOR_INSTRUCTION)).alias("instruction"),
        F.col("text").alias("input"), F.col("_next.text").alias("output"), "conv_id", "turn")
    return out if keep_turn_cols else out.drop("conv_id", "turn")


def mcq_examples(benchmark: DataFrame) -> DataFrame:
    text = F.col("text")
    dot = F.instr(text, ".")
    return benchmark.select(
        F.lit("mcq").alias("source"),
        F.col("item_id").cast("string").alias("example_id"),
        F.lit(MCQ_INSTRUCTION).alias("instruction"),
        F.when(dot > 0, F.substring(text, 1, dot)).otherwise(text).alias("input"),
        F.when(dot > 0, py_strip(F.expr("substring(text, instr(text, '.') + 1)")))
        .otherwise(F.lit("")).alias("output"))


def docs_examples(documents: DataFrame) -> DataFrame:
    text = F.col("text")
    nl = F.instr(text, "\n")
    return documents.select(
        F.lit("docs").alias("source"),
        F.col("doc_id").cast("string").alias("example_id"),
        F.lit(DOCS_INSTRUCTION).alias("instruction"),
        F.when(nl > 0, F.substring_index(text, "\n", 1)).otherwise(text).alias("input"),
        F.when(nl > 0, F.expr("substring(text, instr(text, '\n') + 1)"))
        .otherwise(F.lit("")).alias("output"))


def role_prompts(turns: DataFrame) -> DataFrame:
    """Prompt table (S5): every user turn is one prompt to answer."""
    return turns.where(F.col("role") == "user").select(
        turn_id().alias("prompt_id"),
        F.col("text").alias("user_text"))
