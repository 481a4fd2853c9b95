"""Chat history over a turn log: end of chat (F2), token budget (W4), prompt.

The reference keeps a deque, appends every message, and after each user
message drops the oldest until the rendered history fits the budget (a single
message is kept whole). Since adding messages only raises suffix sums, the
kept history at user turn ``u`` is the longest suffix of turns ``<= u`` whose
tokens fit the budget, or ``u`` alone. With ``cb`` the tokens before a turn and
``c = cb + n`` the tokens through it, turn ``h`` is kept iff ``cb(h) >= c(u) - B``.

A conversation has one message per turn number: of several rows with one number the
least by role, then text, counts; the others, and rows without a conversation or
a turn number, have no history and are listed with a reason by ``unused_turns``. A null text is
an empty one, a null role none of a user.

Scale: nothing is windowed over, or joined by, a whole conversation.
* One pass deals the turns out by (conversation, block of turn numbers) and finds in each
  block, with one window, repeated turns, the tokens before each turn and the first blank
  user turn. That table is written. A row per block then gives the tokens before the
  block and the turn at which the chat ends, and meets the turns again by (conversation, block).
* Candidates for ``u`` are found by a bucketed range join: every message is
  sent to its token block ``cb div B`` and the next; since ``cb(h) > cb(u) - B``
  for kept turns, ``u`` only needs the messages of its own token block. Each
  probe sees at most two budgets' worth of messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, tokenize
from ..session import materialize as write_and_read
from .templates import history_part


BLOCK = 4096  # turn numbers in a block
SALTS = 16  # tasks that a conversation's blocks are dealt to where they meet its cut


def chat_cut(turns: DataFrame) -> DataFrame:
    """drop every turn from the first blank user message on. The few cuts are repeated per salt, so
    the turns of one long conversation meet its cut in many tasks."""
    blank = (turns.where((F.col("role") == "user") & is_blank(F.coalesce("text", F.lit(""))))
             .groupBy("conv_id").agg(F.min("turn").alias("_cut"))
             .select(F.col("conv_id").alias("_c"), "_cut", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s")))
    salt = F.pmod(F.floor(F.col("turn") / BLOCK), F.lit(SALTS))
    j = turns.join(blank, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.coalesce(salt, F.lit(0)) == F.col("_s")), "left")
    return j.where(F.col("_cut").isNull() | (F.col("turn") < F.col("_cut"))).drop("_cut", "_c", "_s")


def unused_turns(turns: DataFrame) -> DataFrame:
    """The rows that histories leave out, with ``reason``: no conversation, no turn number, or one of several
    rows with one turn number."""
    own = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    missing = F.concat_ws("; ", F.when(F.col("conv_id").isNull(), "no conversation"), F.when(F.col("turn").isNull(), "no turn number"))
    some = turns.where(F.col("conv_id").isNull() | F.col("turn").isNull()).withColumn("reason", missing)
    again = (turns.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
             .withColumn("_n", F.row_number().over(own)).where("_n > 1").drop("_n").withColumn("reason", F.lit("repeated turn")))
    return some.unionByName(again)


def history_messages(turns: DataFrame) -> DataFrame:
    """Turns before the end of the chat with their rendered part, token count ``n`` and the tokens before
    them (``cb``).

    The text work (render, strip, tokenize) and the pass over blocks run once: their result is
    written in the shared folder and read back, as the offsets and the range join read it
    several times; a lost executor recomputes from there, not from the turn log.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = turns.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select(
        "conv_id", "turn", role.alias("role"), F.floor(F.col("turn") / BLOCK).cast("long").alias("blk"),
        history_part(role, text).alias("part"), F.coalesce((role == "user") & is_blank(text), F.lit(False)).alias("blank"), "text")
    t = t.withColumn("n", F.size(tokenize("part")).cast("long"))
    own = Window.partitionBy("conv_id", "blk").orderBy("turn", "role", "text")
    again = F.coalesce(F.lag("turn").over(own) == F.col("turn"), F.lit(False))
    t = t.withColumn("again", again).withColumn("n", F.when(~F.col("again"), F.col("n")).otherwise(0))
    t = t.withColumn("run", F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    m = write_and_read(t.where("not again").drop("again", "text"), "history-messages")
    per = m.groupBy("conv_id", "blk").agg(F.sum("n").alias("bn"), F.min(F.when(F.col("blank"), F.col("turn"))).alias("bcut"))
    conv = Window.partitionBy("c")
    per = per.select(F.col("conv_id").alias("c"), F.col("blk").alias("b"), "bn", "bcut").select(
        "c", "b", F.coalesce(F.sum("bn").over(conv.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"),
        F.min("bcut").over(conv).alias("cut"))
    j = m.join(per, (F.col("conv_id") == F.col("c")) & (F.col("blk") == F.col("b")))
    return (j.where(F.col("cut").isNull() | (F.col("turn") < F.col("cut")))
            .select("conv_id", "turn", "role", "part", "n", (F.col("off") + F.col("run")).alias("cb")))


def history_budget(turns: DataFrame, budget: int, align_to_user: bool = False,
                   with_prompt: bool = True) -> DataFrame:
    """W4 (+ P6): for every user turn, the kept history.

    Output: conv_id, turn, start_turn, n_messages, n_tokens and, with
    ``with_prompt``, the rendered prompt. ``align_to_user`` drops leading
    non-user messages of the kept history (never the current turn).
    """
    m = history_messages(turns)
    B = int(budget)
    m = m.withColumn("c", F.col("cb") + F.col("n"))
    probes = (m.where(F.col("role") == "user")
              .select("conv_id", F.col("turn").alias("u"), F.col("c").alias("cu"),
                      F.floor(F.col("cb") / B).cast("long").alias("tb")))
    cols = ["turn", "role", "cb", "n"] + (["part"] if with_prompt else [])
    cands = m.select("conv_id", *cols, F.explode(F.array(
        F.floor(F.col("cb") / B).cast("long"),
        F.floor(F.col("cb") / B).cast("long") + 1)).alias("tb"))
    j = probes.join(cands, ["conv_id", "tb"], "inner")
    j = j.where((F.col("turn") <= F.col("u"))
                & ((F.col("cb") >= F.col("cu") - B) | (F.col("turn") == F.col("u"))))
    if align_to_user:
        first_user = (j.where(F.col("role") == "user").groupBy("conv_id", "u")
                      .agg(F.min("turn").alias("_fu")))
        j = j.join(first_user, ["conv_id", "u"]).where(F.col("turn") >= F.col("_fu"))
    aggs = [F.min("turn").alias("start_turn"), F.count(F.lit(1)).alias("n_messages"),
            F.sum("n").alias("n_tokens")]
    if with_prompt:
        aggs.append(F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("turn", "part"))), lambda x: x["part"]), "")
            .alias("prompt"))
    return j.groupBy("conv_id", "u").agg(*aggs).withColumnRenamed("u", "turn")
