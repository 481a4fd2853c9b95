"""Row checks: required fields (F4), training-row filter (F6), marker guard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_marker, is_blank, remove_markers


def required_fields(df: DataFrame, required=("instruction", "output")) -> DataFrame:
    """Adds ``reason`` ('' when valid; else '; '-joined problems) and ``valid``.

    A null or blank required field rejects the row; ``input`` is optional and
    a null input counts as ''.
    """
    reasons = []
    for c in required:
        reasons.append(F.when(F.col(c).isNull(), F.lit(f"{c}: missing")))
        reasons.append(F.when(F.col(c).isNotNull() & is_blank(c), F.lit(f"{c}: blank")))
    reason = F.concat_ws("; ", *reasons)
    return df.withColumn("reason", reason).withColumn("valid", F.col("reason") == "")


def marker_guard(df: DataFrame, cols=("instruction", "input", "output"),
                 mode: str = "strip") -> DataFrame:
    """user text must not carry ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``.

    ``mode='strip'`` removes the markers (none is left, also if nested), ``'reject'`` drops such rows;
    ``had_marker`` records what was found either way.
    """
    flag = None
    for c in cols:
        f = F.coalesce(has_marker(c), F.lit(False))
        flag = f if flag is None else (flag | f)
    out = df.withColumn("had_marker", flag)
    if mode == "reject":
        return out.where(~F.col("had_marker"))
    for c in cols:
        out = out.withColumn(c, remove_markers(c))
    return out


def filter_rows(examples: DataFrame, labels: DataFrame, min_output_chars: int | None = None,
                max_output_chars: int | None = None, max_ratio: float | None = None,
                require_label: bool = True) -> DataFrame:
    """every example with ``reason``, '' if it is kept: labelled good quality and
    non-toxic, with an output within the limits the caller states (None: no limit).

    The label join is on ``example_id``; both sides grow with the data, so
    Spark picks the join strategy from runtime sizes (AQE).
    """
    lab = labels.select(F.col("doc_id").cast("string").alias("example_id"), "quality", "toxic")
    j = examples.join(lab, "example_id", "left")
    out_len, in_len = F.coalesce(F.length("output"), F.lit(0)), F.greatest(F.length("input"), F.lit(1))
    checks = [("quality", F.col("quality") != 1), ("toxic", F.col("toxic") != 0)]
    if require_label:
        checks.append(("unlabelled", F.col("quality").isNull() | F.col("toxic").isNull()))
    if min_output_chars is not None:
        checks.append(("output too short", out_len < min_output_chars))
    if max_output_chars is not None:
        checks.append(("output too long", out_len > max_output_chars))
    if max_ratio is not None:
        checks.append(("output too long for its input", out_len > F.lit(float(max_ratio)) * in_len))
    return j.withColumn("reason", F.concat_ws("; ", *[F.when(c, F.lit(name)) for name, c in checks]))
