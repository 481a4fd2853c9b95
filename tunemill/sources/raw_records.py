"""Raw JSON records of any shape as instruction examples.

A ``RecordShape`` is a table of paths: for each field the places where it may stand,
tried in order. Records are parsed once into the VARIANT type, so no schema has
to be known or inferred, records of several versions can stand in one file, and fields
are taken out by path in the JVM. What no path uses is kept as JSON text, and a
record that cannot be mapped is a row with the reason.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .json_ranges import files_under, read_records

FIELDS = ("example_id", "instruction", "input", "output")


@dataclass(frozen=True)
class RecordShape:
    """Paths (``$.a.b[0]``, ``$['a b']``) per field. With ``each``, the path of an array, every element of it
    is an example, and paths that begin with ``@`` start at the element. ``fixed_instruction`` stands where no
    path of the instruction leads to a value."""

    output: tuple[str, ...]
    instruction: tuple[str, ...] = ()
    input: tuple[str, ...] = ()
    example_id: tuple[str, ...] = ()
    each: str | None = None
    fixed_instruction: str | None = None

    def __post_init__(self):
        for p in (*self.output, *self.instruction, *self.input, *self.example_id, *([self.each] if self.each else [])):
            if not re.match(r"[$@]", p) or (p.startswith("@") and (not self.each or p == self.each)):
                raise ValueError(f"not a path: {p}")

    def names(self) -> list[str]:
        """The record's own fields that some path uses."""
        paths = [*self.output, *self.instruction, *self.input, *self.example_id, self.each or ""]
        found = (re.match(r"\$(?:\.([^.\[]+)|\['([^']*)'\]|\[\"([^\"]*)\"\])", p) for p in paths)
        return sorted({next(g for g in m.groups() if g is not None) for m in found if m})


def _value(paths: tuple[str, ...]) -> Column:
    """The first value that is there, as text: strings and numbers as they are, objects and arrays as JSON."""
    found = [F.try_variant_get(F.col("_element" if p[0] == "@" else "_record"), "$" + p[1:], "string") for p in paths]
    return F.coalesce(*found, F.lit(None).cast("string"))


def map_records(records: DataFrame, shape: RecordShape, value: str = "value") -> DataFrame:
    """Texts of records (column ``value``) as ``example_id``, ``instruction``, ``input``, ``output``, ``extra`` (the
    record's other fields as a JSON object, null if none), ``reason`` ('' if mapped) and ``record`` (the text,
    where it was not). A column ``whole`` says which texts are one record (``read_records``).

    Defined results: an ``each`` array that is missing or empty is one row with that reason; a null, blank or broken
    text, one that is no object, and one with a name twice are rows with the reason "not a record"; JSON
    null counts as missing; without a path for the id it is null."""
    parsed = F.try_parse_json(value)
    if "whole" in records.columns:
        parsed = F.when(F.col("whole"), parsed)
    fields = F.try_variant_get(F.col("_record"), "$", "map<string,variant>")
    d = records.select(F.col(value).alias("_text"), parsed.alias("_record")).withColumn("_fields", fields)
    if shape.each:
        of = F.coalesce(F.try_variant_get(F.col("_record"), shape.each, "array<variant>"), F.array().cast("array<variant>"))
        d = d.select("*", F.explode_outer(of).alias("_element"))
    used = shape.names()
    rest = F.map_filter("_fields", lambda k, _: ~k.isin(used)) if used else F.col("_fields")
    instruction = _value(shape.instruction)
    if shape.fixed_instruction is not None:
        instruction = F.coalesce(instruction, F.lit(shape.fixed_instruction))
    output = _value(shape.output)
    reason = F.when(F.col("_fields").isNull(), "not a record")
    if shape.each:
        reason = reason.when(F.col("_element").isNull(), f"{shape.each}: no element")
    reason = F.coalesce(reason, F.concat_ws("; ", F.when(instruction.isNull(), "instruction: no value"),
                                            F.when(output.isNull(), "output: no value")))
    d = d.withColumn("reason", reason)
    return d.select(_value(shape.example_id).alias("example_id"), instruction.alias("instruction"),
                    F.coalesce(_value(shape.input), F.lit("")).alias("input"), output.alias("output"),
                    F.when(F.size(rest) > 0, F.to_json(rest)).alias("extra"), "reason",
                    F.when(F.col("reason") != "", F.col("_text")).alias("record"))


def read_raw_records(spark: SparkSession, path: str, shape: RecordShape, range_bytes: int | None = None) -> DataFrame:
    """``map_records`` over JSON files of either form under ``path``, read in byte ranges."""
    return map_records(read_records(spark, files_under(spark, path), range_bytes), shape)
