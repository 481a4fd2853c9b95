"""Helpers shared by the training-data operators: the word rule, table access,
lineage cuts and a prefix sum that no hot group can pull into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

# ---------------------------------------------------------------------------
# FIXED VALUES: the word rule [^\x20\x09-\x0D]+ and its white space.
# ---------------------------------------------------------------------------
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[ \t\n\x0B\f\r]+"
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that only Spark has to read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage through a table written in the cluster's shared folder."""
    return materialize(df, f"llm-{name}")


def words(text: Column) -> Column:
    """The text's words in order; null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_RUN), lambda w: w != F.lit(""))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def running_total(df: DataFrame, group: Sequence[str], block: str, order: Sequence,
                  value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group, in the order (``block``, ``order``).

    ``block`` holds the leading part of the order as a number, so blocks are
    consecutive and a group is spread over its blocks: their totals are summed
    first (partial aggregation), then only the totals are scanned per group,
    and the rows only within their block. Nulls in ``group`` match themselves.
    """
    total, before = fresh(df, "_block_sum"), fresh(df, "_block_before")
    sums = df.groupBy(*group, block).agg(F.sum(value).alias(total))
    scan = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(g).alias(f"_s_{g}") for g in (*group, block)],
                         F.coalesce(F.sum(total).over(scan), F.lit(0)).alias(before))
    on = [F.col(g).eqNullSafe(F.col(f"_s_{g}")) for g in (*group, block)]
    within = (Window.partitionBy(*group, block).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    joined = df.join(starts, on, "inner").drop(*[f"_s_{g}" for g in (*group, block)])
    return (joined.withColumn(out, F.col(before) + F.coalesce(F.sum(value).over(within), F.lit(0)))
            .drop(before))
