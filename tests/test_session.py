"""Loader, session settings and lineage cuts."""

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from tunemill.session import get_session, materialize, shared_root
from tunemill.sources.tables import SPREAD, load


def test_loader_leaves_scans_alone_unless_asked(spark):
    docs = load(spark, SF_ORACLE, "documents")
    assert docs.rdd.getNumPartitions() == 1  # one row group
    spark.conf.set(SPREAD, "3")
    try:
        assert load(spark, SF_ORACLE, "documents").rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(SPREAD)


def test_an_existing_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        assert get_session().conf.get("spark.sql.shuffle.partitions") == "400"
        assert get_session("local[2]", shuffle_partitions=3).conf.get("spark.sql.shuffle.partitions") == "400"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).withColumn("sq", F.col("id") * F.col("id"))
    m = materialize(df, "unit")
    assert m.count() == 100 and m.agg(F.sum("sq")).first()[0] == sum(i * i for i in range(100))
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan parquet" in plan   # read back, no recompute
    assert shared_root(spark)
