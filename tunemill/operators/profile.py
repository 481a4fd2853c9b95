"""Profiles: row counts (A1), field profile (A2), token profile (A3), plan totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank


def field_profile(df: DataFrame, fields=("instruction", "input", "output"),
                  group: str = "source") -> DataFrame:
    """Per group and field: rows, nulls, blanks, min/avg/max length, distinct values."""
    long = df.select(group, F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"))
        for f in fields])).alias("kv")).select(group, "kv.field", "kv.value")
    ln = F.length("value")
    return long.groupBy(group, "field").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), 1).otherwise(0)).alias("n_null"),
        F.sum(F.when(F.col("value").isNotNull() & is_blank("value"), 1).otherwise(0))
        .alias("n_blank"),
        F.min(ln).alias("min_len"),
        F.round(F.avg(ln), 4).alias("avg_len"),
        F.max(ln).alias("max_len"),
        # distinct over a 256-bit digest: the shuffle carries 32 bytes per
        # value instead of whole texts (a collision is out of practical reach)
        F.countDistinct(F.unhex(F.sha2("value", 256))).alias("n_distinct"))


def token_profile(counts: DataFrame, max_len: int, group: str = "source") -> DataFrame:
    """A3 per group from token counts (``n_tokens``, ``prompt_tokens``): rows,
    exact length percentiles, share truncated, share with every label masked,
    and tokens that carry loss after truncation (no per-token work needed)."""
    L = F.lit(max_len)
    loss = F.greatest(F.least("n_tokens", L) - F.least("prompt_tokens", L), F.lit(0))
    return counts.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.percentile("n_tokens", 0.5).alias("p50_tokens"),
        F.percentile("n_tokens", 0.9).alias("p90_tokens"),
        F.max("n_tokens").alias("max_tokens"),
        F.round(F.avg(F.when(F.col("n_tokens") > max_len, 1.0).otherwise(0.0)), 6)
        .alias("share_truncated"),
        F.round(F.avg(F.when(F.col("prompt_tokens") >= max_len, 1.0).otherwise(0.0)), 6)
        .alias("share_all_masked"),
        F.sum(loss).cast("long").alias("loss_tokens"))


def plan_totals(enc: DataFrame, batch_size: int, grad_accum: int, world_size: int,
                epochs: int, max_len: int, group: str = "source") -> DataFrame:
    """Effective batch, optimizer steps per epoch and in total, tokens."""
    eff = batch_size * grad_accum * world_size
    out = enc.rollup(group).agg(F.grouping_id().alias("_all"), F.count(F.lit(1)).alias("n_rows"),
                                F.sum("length").alias("real_tokens"))  # one pass for groups and total
    out = out.withColumn(group, F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col(group)))
    steps = F.ceil(F.col("n_rows") / F.lit(eff)).cast("long")
    return out.select(group, "n_rows", F.lit(eff).alias("effective_batch"),
                      steps.alias("steps_per_epoch"),
                      (steps * epochs).alias("total_steps"),
                      (F.col("real_tokens") * epochs).alias("real_tokens"),
                      (F.col("n_rows") * max_len * epochs).alias("padded_tokens"))
