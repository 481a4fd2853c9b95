"""Table access by name under a data folder (one parquet per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

SPREAD = "tunemill.load.partitions"


def load(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Reads ``<data_dir>/<name>.parquet``.

    The scan is left as Spark splits it, whatever the table's size. Where a
    caller knows that files are few (one row group each, as on a laptop), the
    session setting ``tunemill.load.partitions`` spreads every table's rows over
    as many partitions; it is unset unless somebody sets it.
    """
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(SPREAD, None)
    return df.repartition(int(n)) if n else df
