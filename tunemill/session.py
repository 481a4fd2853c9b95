"""Session helper and the shared folder used for written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "tunemill") -> SparkSession:
    """The session there is, unchanged; else, with ``master``, a local one.

    An existing session keeps all its settings. Without ``master`` a new session
    takes everything from the submitter (spark-submit, spark-defaults); only a
    session made here for a named master gets the settings below.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if not master:
        return b.getOrCreate()
    spark = (
        b.master(master).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TUNEMILL_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    Only a local master (tests, laptops) may go without: a private folder is
    made for it. A cluster that names no folder gets an error, as executors do
    not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    base = (sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tunemill-ckpt-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared root for one written table."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Cuts lineage: writes ``df`` as parquet in the shared folder and reads it
    back. One computation (``DataFrame.checkpoint`` on an unpersisted plan
    computes twice), fault tolerant (the table outlives executors), and later
    reads get column pruning and predicate pushdown."""
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
