"""Batch plans (W5, W6), batch padding.

A batch plan is a table: every example gets, per epoch, its position in that
epoch's seeded shuffle and from it the optimizer step, the accumulation
micro-step, the device rank and the micro-batch it belongs to. Ranks take
positions round-robin (position mod world), as a distributed sampler does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import LABEL_IGNORE
from .sampling import NULL_PART, global_index, seeded_key


def batch_plan(df: DataFrame, epochs: int, batch_size: int, grad_accum: int,
               world_size: int = 1, seed: int = 42, key: str = "example_id",
               source: str = "source", prefix_hex: int = 4, shuffle: bool = True, tie=()) -> DataFrame:
    """Adds ``epoch, pos, rank, step, micro_step, batch_id``; other columns stay. Rows with one key, and
    rows with a null one, are rows of their own, in the order of the columns ``tie``.

    Without ``shuffle`` every epoch has the sources one after the other, by
    ``source_rank``, each in the order of md5('<key>').

    The epoch's order is md5('<seed>:<epoch>:<source>:<key>'); ``batch_id``
    numbers micro-batches within an epoch across ranks.
    """
    ep = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    if shuffle:
        k = seeded_key(seed, "epoch", source, key)
        ix = global_index(ep, k, [key, *tie], ["epoch"], prefix_hex, out="pos").drop("group_n")
    else:
        name = F.coalesce(F.col(key).cast("string"), F.lit(NULL_PART))
        ix = global_index(ep, F.md5(name), [key, *tie], ["epoch", "source_rank"], prefix_hex, out="_i")
        before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # one row per source
        starts = df.groupBy(F.col("source_rank").alias("_r")).agg(F.count(F.lit(1)).alias("_n")).select(
            "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
        ix = (ix.join(starts, F.col("source_rank") == F.col("_r"))
              .withColumn("pos", F.col("_at") + F.col("_i")).drop("_i", "_r", "_at", "_n", "group_n"))
    rank = F.col("pos") % world_size
    local = F.floor(F.col("pos") / world_size).cast("long")
    micro = F.floor(local / batch_size).cast("long")  # micro-batch index on this rank
    return ix.select(
        "*",
        rank.cast("int").alias("rank"),
        F.floor(micro / grad_accum).cast("long").alias("step"),
        (micro % grad_accum).cast("int").alias("micro_step"),
        (micro * world_size + rank).alias("batch_id"))


def pad_to_batch(enc: DataFrame, pad_id: int, batch_cols=("epoch", "batch_id")) -> DataFrame:
    """Pad every row to the longest row of its batch (A4).

    ids with the pad id, labels with -100, the attention mask with 0. A batch
    has at most ``batch_size`` rows, so the window is small by construction.
    """
    w = Window.partitionBy(*batch_cols)
    out = enc.withColumn("batch_len", F.max(F.size("input_ids")).over(w))
    fill = F.col("batch_len") - F.size("input_ids")

    def padded(c, v):
        return F.concat(F.col(c), F.array_repeat(F.lit(v).cast("long"), fill))
    return out.select(
        *[c for c in enc.columns if c not in ("input_ids", "attention_mask", "labels")],
        "batch_len",
        padded("input_ids", pad_id).alias("input_ids"),
        padded("attention_mask", 0).alias("attention_mask"),
        padded("labels", LABEL_IGNORE).alias("labels"))
