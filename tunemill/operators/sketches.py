"""Mergeable profiles (A2, A3): one small row of counts and sketches per part of a
table (a file, a day), merged without reading the rows again.

A part row holds exact counts (rows, nulls, blanks, least, greatest and summed
length), a HyperLogLog sketch of the values and a KLL sketch of the lengths.
All of them merge in any order and grouping. Texts are hashed in the scanning
task, so the shuffle moves sketches only: at most ``2**LG_K`` bytes and a few
thousand quantile items per part, group and field, whatever the rows.

Errors: ``n_distinct`` has a relative standard error of ``1.04 / sqrt(2**LG_K)``
(0.8 %); a quantile's rank is within about 0.3 % of the asked one with 99 % confidence
at ``KLL_K`` = 1000, and exact for small groups. The KLL sketch draws
random bits, so two runs may give different values within that error.

Defined results: null groups and null parts are groups and parts of their own;
null values count as rows and nulls only; a field with nulls only has no
lengths (null) and no distinct values (0); an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank

LG_K = 14
KLL_K = 1000
DISTINCT_BOUND = 0.05  # six standard errors
RANK_BOUND = 0.01
QUANTILES = (0.5, 0.9)


def _long(df: DataFrame, fields, *keep: Column) -> DataFrame:
    """One row per row and field: ``field``, ``value`` (text) and ``size`` (the length of a
    text, the number itself for integer columns)."""
    def one(f):
        number = isinstance(df.schema[f].dataType, T.IntegralType)
        return F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"),
                        (F.col(f) if number else F.length(F.col(f).cast("string"))).cast("long").alias("size"))
    kv = F.explode(F.array(*[one(f) for f in fields])).alias("kv")
    return df.select(*keep, kv).select("*", "kv.field", "kv.value", "kv.size").drop("kv")


def part_profile(df: DataFrame, part: Column, fields, group: str = "source") -> DataFrame:
    """One row per ``part``, group and field, to be merged by ``merge_parts``."""
    long = _long(df, fields, part.alias("part"), F.col(group).alias("grp"))
    return long.groupBy("part", "grp", "field").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
        F.count_if(F.col("value").isNotNull() & is_blank("value")).alias("n_blank"),
        F.min("size").alias("min_len"), F.max("size").alias("max_len"), F.sum("size").alias("sum_len"),
        F.hll_sketch_agg("value", F.lit(LG_K)).alias("values"),
        F.kll_sketch_agg_bigint("size", F.lit(KLL_K)).alias("sizes"))


def write_parts(profile: DataFrame, path: str) -> DataFrame:
    """Puts part rows into the table at ``path`` and returns the whole table. A part that is
    already there is replaced, so a stopped run can be repeated; others are not touched."""
    (profile.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("part").parquet(path))
    return profile.sparkSession.read.schema(profile.schema).parquet(path)


def merge_parts(parts: DataFrame, *keys: str) -> DataFrame:
    """Part rows of equal group and field (and ``keys``) merged into one; the result merges again."""
    return parts.groupBy(*keys, "grp", "field").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_blank")],
        F.min("min_len").alias("min_len"), F.max("max_len").alias("max_len"), F.sum("sum_len").alias("sum_len"),
        F.hll_union_agg("values", F.lit(False)).alias("values"),
        F.kll_merge_agg_bigint("sizes", F.lit(KLL_K)).alias("sizes"))


def read_profile(merged: DataFrame, group: str = "source", quantiles=QUANTILES) -> DataFrame:
    """The profile that merged rows hold: counts, lengths, ``n_distinct``, ``p50``, ``p90``."""
    some = F.col("n_rows") > F.col("n_null")
    return merged.select(
        F.col("grp").alias(group), "field", "n_rows", "n_null", "n_blank", "min_len",
        F.round(F.col("sum_len") / (F.col("n_rows") - F.col("n_null")), 4).alias("avg_len"), "max_len",
        F.when(some, F.hll_sketch_estimate("values")).otherwise(F.lit(0)).cast("long").alias("n_distinct"),
        *[F.when(some, F.kll_sketch_get_quantile_bigint("sizes", F.lit(q))).alias(f"p{round(100 * q)}")
          for q in quantiles])


def profile_errors(df: DataFrame, profile: DataFrame, fields, group: str = "source",
                   quantiles=QUANTILES) -> DataFrame:
    """``profile`` beside the exact one of ``df``: exact ``n_distinct``, ``distinct_error`` (relative)
    and, per quantile, ``p50_error``: how far the share asked for lies outside the exact ranks
    of the value given. This reads the rows; it is a report on the sketches, not a part of them."""
    names = [f"p{round(100 * q)}" for q in quantiles]
    long = _long(df, fields, F.col(group).alias("grp"))
    given = profile.select(F.col(group).alias("_g"), F.col("field").alias("_f"), "n_distinct", *names)
    met = long.join(given, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("field") == F.col("_f")))
    exact = met.groupBy("grp", "field").agg(
        F.countDistinct(F.unhex(F.sha2("value", 256))).alias("exact"), F.first("n_distinct").alias("guess"),
        F.count("size").alias("n"),
        *[F.count_if(F.col("size") < F.col(p)).alias(f"{p}_below") for p in names],
        *[F.count_if(F.col("size") <= F.col(p)).alias(f"{p}_upto") for p in names])
    out = exact.select(
        F.col("grp").alias("_g"), F.col("field").alias("_f"), F.col("exact").alias("exact_distinct"),
        (F.abs(F.col("guess") - F.col("exact")) / F.greatest("exact", F.lit(1))).alias("distinct_error"),
        *[F.coalesce(F.greatest(F.col(f"{p}_below") / F.nullif("n", F.lit(0)) - q, q - F.col(f"{p}_upto") / F.nullif("n", F.lit(0)),
                                F.lit(0.0)), F.lit(0.0)).alias(f"{p}_error") for p, q in zip(names, quantiles)])
    return profile.join(out, F.col(group).eqNullSafe(F.col("_g")) & (F.col("field") == F.col("_f"))).drop("_g", "_f")
