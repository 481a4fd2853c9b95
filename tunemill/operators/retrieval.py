"""Exact top-k retrieval of supporting passages by cosine similarity.

The queries are a stated set: they go to the tasks in blocks of at most ``QUERIES``
(checked), and each block scans the corpus where it lies. A task keeps the k best of every query over
all its rows, and only these are shuffled, for the last ranking. Nothing of the corpus is
copied or passes through the driver; a task holds ``CELLS`` similarities at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

QUERIES = 4096
CELLS = 1 << 22
PARTIAL = "query_id long, vec_id long, sim double"


def mean_vectors(df: DataFrame, group: str, vec_col: str = "embedding") -> DataFrame:
    """(``query_id``, ``qv``): the mean vector of every group, over all its rows."""
    parts = df.select(F.col(group).cast("long").alias("query_id"), F.posexplode(vec_col).alias("pos", "x"))
    means = parts.groupBy("query_id", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy("query_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda p: p["m"]).alias("qv"))


def _unit(lists: pa.ListArray) -> np.ndarray:
    m = np.array(lists.flatten(), np.float64).reshape(len(lists), -1)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _round6(x: np.ndarray) -> np.ndarray:
    return np.sign(x) * np.floor(np.abs(x) * 1e6 + 0.5) / 1e6


def retrieve_topk(queries: DataFrame, corpus: DataFrame, k: int = 5, id_col: str = "vec_id",
                  vec_col: str = "embedding") -> DataFrame:
    """Top ``k`` corpus rows per query (``query_id``, ``qv``): ``query_id, vec_id, sim
    (6 digits), rank``; ties go to the smaller id. Rows without a vector take no part."""
    spark = corpus.sparkSession
    rows = corpus.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    asked = queries.where(F.col("qv").isNotNull()).select("query_id", F.col("qv").cast("array<double>").alias("qv"))
    first = asked.limit(QUERIES + 1).collect()
    if len(first) <= QUERIES:
        blocks = iter([first])
    else:  # blocks by hash, half full on average so that none is over the limit
        asked = materialize(asked, "queries")
        n = -(-2 * asked.count() // QUERIES)
        blocks = (asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i).collect() for i in range(n))
    found = None
    for block in blocks:
        for at in range(0, len(block), QUERIES):
            some = _best_of(rows, block[at:at + QUERIES], k)
            found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], PARTIAL)
    w = Window.partitionBy("query_id").orderBy(F.desc("sim"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _best_of(rows: DataFrame, block: list, k: int) -> DataFrame:
    """Of each task's rows the ``k`` best for every query of ``block``."""
    ids = np.array([r.query_id for r in block], np.int64)
    q = np.array([r.qv for r in block], np.float64).reshape(len(block), -1)
    q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sims, near = np.zeros((len(ids), 0)), np.zeros((len(ids), 0), np.int64)
        step = max(1, CELLS // max(1, len(ids)))
        for whole in batches:
            for a in range(0, len(whole) if len(ids) else 0, step):
                batch = whole.slice(a, step)
                new = _round6(q @ _unit(batch.column(1)).T)
                if new.shape[1] > 4 * k:  # the k-th score first; everything at it or above is ranked
                    kth = np.partition(new, new.shape[1] - k, axis=1)[:, -k]
                    cols = np.flatnonzero((new >= kth[:, None]).any(axis=0))
                    new, batch = new[:, cols], batch.take(pa.array(cols))
                sims = np.concatenate([sims, new], axis=1)
                near = np.concatenate([near, np.broadcast_to(batch.column(0).to_numpy(), new.shape)], axis=1)
                at = np.lexsort((near, -sims), axis=1)[:, :k]
                sims, near = np.take_along_axis(sims, at, 1), np.take_along_axis(near, at, 1)
        out = (np.repeat(ids, sims.shape[1]), near.ravel(), sims.ravel())
        yield pa.RecordBatch.from_arrays(list(map(pa.array, out)), names=["query_id", "vec_id", "sim"])

    return rows.mapInArrow(best, PARTIAL)
