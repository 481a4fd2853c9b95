"""File readers and writers."""

from __future__ import annotations

from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EXAMPLE, TURNS
from .files import file_system
from .json_ranges import cut_lines, files_under, read_records

CORRUPT = "_corrupt_record"
ARRAY_CHARS = 1 << 23


def read_instruction_json(spark: SparkSession, paths, form: str = "auto", schema: T.StructType = EXAMPLE,
                          range_bytes: int | None = None) -> DataFrame:
    """Instruction records from JSON files (S1, S2): array files and files of one record a
    line, in any mix; ``form`` 'auto' looks at the first visible character of every file.

    Files of either form are read in byte ranges by as many tasks (``json_ranges``).
    The schema is fixed (no inference pass over the data). Nothing is dropped: text
    that is not one record, in an array, on a line or outside an array, is a row with the
    text in ``_corrupt_record`` and null fields (``split_records`` parts them).
    ``source_file`` keeps provenance. No files, or only empty ones: no rows.
    """
    files = [f for path in ([paths] if isinstance(paths, str) else paths) for f in files_under(spark, path, form)]
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    rows = read_records(spark, files, range_bytes).withColumn("_r", F.from_json(
        "value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    fits = F.col("whole") & F.col("_r").isNotNull() & F.col(f"_r.{CORRUPT}").isNull()
    return rows.select(*[F.when(fits, F.col(f"_r.{c}")).alias(c) for c in schema.fieldNames()],
                       F.when(~fits, F.col("value")).alias(CORRUPT), F.col("file").alias("source_file"))


def split_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``read_instruction_json``: (records that parsed; rejected ones with their text,
    ``reason``, and ``parsed``, the fields that other readers could fill)."""
    bad = F.col(CORRUPT).isNotNull()
    fields = [c for c in df.columns if c not in (CORRUPT, "source_file")]
    return (df.where(~bad).drop(CORRUPT),
            df.where(bad).select("source_file", F.col(CORRUPT).alias("record"), F.lit("not a record").alias("reason"),
                                 F.to_json(F.struct(*fields)).alias("parsed")))


def _arrays(limit: int):
    """Joins the records of a task to arrays of up to ``limit`` characters (or one record)."""
    def fn(batches):
        held, size = [], 0
        for pdf in batches:
            for record in pdf["value"]:
                if held and size + len(record) > limit:
                    yield pd.DataFrame({"value": ["[" + ",\n".join(held) + "]"]})
                    held, size = [], 0
                held.append(record)
                size += len(record)
        if held:
            yield pd.DataFrame({"value": ["[" + ",\n".join(held) + "]"]})
    return fn


def write_instruction_json(df: DataFrame, path: str, form: str = "lines", array_chars: int = ARRAY_CHARS) -> str:
    """JSON Lines, or (``form`` 'array') files that hold one JSON array each, for other
    tools: one file for a small table, else as many as keep each array under
    ``array_chars`` characters, written and read by as many tasks."""
    if form == "array":
        spark = df.sparkSession
        rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
        rows.write.mode("overwrite").text(path + "-records")  # once: the count and the arrays see the same records
        records = spark.read.schema("value string").text(path + "-records")
        chars = records.agg(F.sum(F.length("value").cast("long"))).first()[0] or 0
        # dealt out in turn, so no content can fill one file; tasks stay well under the limit, mostly one file each
        (records.repartition(max(1, ceil(2 * chars / array_chars)))
         .mapInPandas(_arrays(array_chars), "value string")
         .write.mode("overwrite").option("maxRecordsPerFile", 1).text(path))
        return path
    df.write.mode("overwrite").json(path)
    return path


def write_one_array(lines: str, path: str, spark: SparkSession) -> str:
    """Files of one record a line joined to one array file, as other tools hand over. One file is written
    by one task, in pieces of bounded size."""
    parts = sorted(r.path for r in spark.read.format("binaryFile").load(lines).select("path").collect())

    def join(batches):
        fs, name = file_system(path)
        first = True
        for _ in batches:
            with fs.open_output_stream(name, compression=None) as out:
                out.write(b"[")
                for part in parts:
                    for _, _, text in cut_lines(part, 0, None):
                        out.write((b"" if first else b",\n") + text)
                        first = False
                out.write(b"]\n")
            yield pd.DataFrame({"path": [path]})
    spark.range(1, numPartitions=1).mapInPandas(join, "path string").collect()
    return path


def write_table(df: DataFrame, path: str, partition_by=None) -> str:
    """Parquet sink (S6, S7, S8); ``partition_by`` e.g. split or rank."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def read_turn_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Chat turns as an unbounded source (S4, streaming form)."""
    return (spark.readStream.schema(TURNS)
            .option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))
