"""Chat formatting with perspective rotation (operator 1), DataFrame functions only.

For every participant of a conversation the dialogue is rendered once, with
that speaker as the assistant and all others as named users, together with the
character spans that count for the loss (what the assistant says, with the
closing marker). System turns are the system message in every rendering.

A conversation is rendered in parts of ``part_turns`` consecutive turn numbers,
so a conversation of any length is spread over rows and tasks, and no row grows
without bound; participants are collected over the whole conversation (partial
aggregation), and every part is rendered for each of them. All turns are kept.

Defined results
* a null speaker renders as user "unknown" and is no participant; null or empty
  text is an empty message.
* turns with the same number are ordered by speaker, then text; repeated rows
  are rendered each; a null turn number forms the part null.
* rows without a conversation id are conversations of their own (equal rows together).
* a conversation of system turns only, and an empty table, give no rows.
* markers inside a text are broken by a blank, so no text can open or close a message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
MARK, BROKEN = "<|im_", "<| im_"
SYSTEM, UNKNOWN = "system", "unknown"
PART_TURNS = 64


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           speaker_col: str = "role", text_col: str = "text",
           part_turns: int = PART_TURNS) -> DataFrame:
    """(``conv_col``, ``perspective``, ``part``, ``n_turns``, ``n_targets``, ``rendered``,
    ``mask``): ``mask`` is an array of (start, stop) character spans."""
    t = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                     F.col(speaker_col).cast("string").alias("who"),
                     F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARK), F.lit(BROKEN)).alias("text"))
    t = t.withColumn("lone", F.when(F.col("conv").isNull(), F.xxhash64("turn", "who", "text")))
    parts = (t.withColumn("part", F.floor(F.col("turn") / part_turns)).groupBy("conv", "lone", "part")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "who", "text"))).alias("turns")))
    people = (t.where(F.col("who").isNotNull() & (F.col("who") != SYSTEM))
              .select(F.col("conv").alias("pc"), F.col("lone").alias("pl"), F.col("who").alias("perspective"))
              .distinct())
    rows = parts.join(people, F.col("conv").eqNullSafe(F.col("pc")) & F.col("lone").eqNullSafe(F.col("pl")))

    def head(who: Column) -> Column:
        return (F.when(who == F.col("perspective"), F.lit(f"{OPEN}assistant\n"))
                .when(who == SYSTEM, F.lit(f"{OPEN}system\n"))
                .otherwise(F.concat(F.lit(f"{OPEN}user name="), F.coalesce(who, F.lit(UNKNOWN)), F.lit("\n"))))

    pieces = F.transform("turns", lambda x: F.struct(
        head(x["who"]).alias("head"), x["text"].alias("text"),
        F.coalesce(x["who"] == F.col("perspective"), F.lit(False)).alias("own")))
    rows = rows.withColumn("pieces", pieces)

    def span(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["head"])
        stop = start + F.char_length(x["text"]) + len(CLOSE)
        return F.struct((stop + 1).alias("at"), F.when(x["own"], F.concat(acc["spans"], F.array(
            F.struct(start.alias("start"), stop.alias("stop"))))).otherwise(acc["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,stop:int>>")
    mask = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), none.alias("spans")), span, lambda a: a["spans"])
    text = F.concat_ws("", F.transform("pieces", lambda x: F.concat(x["head"], x["text"], F.lit(f"{CLOSE}\n"))))
    return rows.select(F.col("conv").alias(conv_col), "perspective", "part",
                       F.size("turns").cast("long").alias("n_turns"),
                       F.size(F.filter("pieces", lambda x: x["own"])).cast("long").alias("n_targets"),
                       text.alias("rendered"), mask.alias("mask"))


def op1(turns: DataFrame) -> DataFrame:
    """All perspectives of all conversations; the mask as text, ``start:stop`` joined by commas."""
    out = rotate(turns)
    return out.withColumn("mask", F.concat_ws(",", F.transform("mask", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["stop"].cast("string")))))


SQL = """
WITH t AS (
  SELECT conv_id, turn, role, floor(turn / 64)::BIGINT AS part,
         replace(coalesce(text, ''), '<|im_', '<| im_') AS text
  FROM conversations),
people AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> 'system'),
pieces AS (
  SELECT t.*, perspective, coalesce(role = perspective, false) AS own,
         '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
                           ELSE 'user name=' || coalesce(role, 'unknown') END || chr(10) AS head
  FROM t JOIN people USING (conv_id)),
placed AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS piece,
         coalesce(sum(length(head) + length(text) + 11) OVER (
           PARTITION BY conv_id, perspective, part ORDER BY turn, role, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM pieces)
SELECT conv_id, perspective, part, count(*)::BIGINT AS n_turns, count(*) FILTER (WHERE own)::BIGINT AS n_targets,
       string_agg(piece, '' ORDER BY turn, role, text) AS rendered,
       coalesce(string_agg((pos + length(head))::BIGINT::VARCHAR || ':' ||
                           (pos + length(head) + length(text) + 10)::BIGINT::VARCHAR, ',' ORDER BY turn, role, text)
                FILTER (WHERE own), '') AS mask
FROM placed GROUP BY conv_id, perspective, part
"""
