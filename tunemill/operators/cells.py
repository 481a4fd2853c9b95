"""Exact top-k retrieval without scoring all pairs (J4): cells with a centre and a radius.

The corpus is written once with the cell of every row, the centre nearest to its unit
vector; a cell's radius is the greatest distance of a row to the centre. By the triangle inequality
no row of a cell is nearer to a query than the centre's distance less the radius, which bounds
its cosine from above. A query first scores the nearest cells that together hold k
rows; cells whose bound is under the k-th score so far are then left out, and all
others are scored. The result is that of scoring all pairs.

Centres come from k-means over at most ``SAMPLE`` rows (those with the smallest hashes of
the id); they decide how much is left out, never what is found. The driver holds the
sample, one row per cell and one block of at most ``QUERIES`` queries. The corpus is scanned where
it lies, sorted by cell within each file, so that files and row groups without
a wanted cell are skipped; a cell of any size is spread over all files.

Defined results: rows and queries with a null vector, or null or non-finite components, take no part; zero
vectors have similarity 0; rows may repeat and are ranked each; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .retrieval import CELLS, PARTIAL, QUERIES, _round6, _unit

SAMPLE = 20_000
SLACK = 1e-6  # similarities are rounded to 6 digits


@dataclass
class CellIndex:
    rows: DataFrame  # vec_id, vec, cell
    centres: np.ndarray  # one per cell
    radius: np.ndarray
    n: np.ndarray  # rows of each cell


def _whole(vec: str) -> Column:
    return F.col(vec).isNotNull() & F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))


def _norm(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * (x @ centres.T)
    return np.sqrt(np.maximum(d, 0))


def kmeans(x: np.ndarray, cells: int, rounds: int, seed: int = 7) -> np.ndarray:
    """Lloyd's rounds from ``cells`` distinct starting rows."""
    x = np.unique(x, axis=0)
    centres = x[np.random.default_rng(seed).permutation(len(x))[:cells]]
    for _ in range(rounds):
        near = np.concatenate([_distances(x[a:a + 4096], centres).argmin(1) for a in range(0, len(x), 4096)])
        n = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def build_cells(corpus: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cells: int = 256,
                rounds: int = 6) -> CellIndex:
    """The corpus as a table with cells, and the cells' centres, radii and sizes."""
    rows = corpus.where(_whole(vec_col)).select(F.col(id_col).cast("long").alias("vec_id"),
                                                F.col(vec_col).cast("array<double>").alias("vec"))
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(SAMPLE).select("vec").collect()
    centres = kmeans(_norm(np.array([r.vec for r in some], np.float64)), cells, rounds) if some else np.zeros((0, 0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // max(1, len(centres)))
        for whole in batches:
            for a in range(0, len(whole), step):
                batch = whole.slice(a, step)
                d = _distances(_unit(batch.column(1)), centres)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                    ["vec_id", "vec", "cell", "away"])

    placed = materialize(rows.mapInArrow(assign, "vec_id long, vec array<double>, cell int, away double")
                         .sortWithinPartitions("cell"), "cells")
    radius, n = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for r in placed.groupBy("cell").agg(F.max("away").alias("away"), F.count(F.lit(1)).alias("n")).collect():
        radius[r.cell], n[r.cell] = r.away + 1e-7, r.n  # distances are differences of squares
    return CellIndex(placed.select("vec_id", "vec", "cell"), centres, radius, n)


def bounds(q: np.ndarray, index: CellIndex) -> np.ndarray:
    """The greatest cosine that a row of each cell can have with each of the unit vectors ``q``."""
    apart = np.maximum(_distances(q, index.centres) - 1e-7 - index.radius, 0)
    return 1 - apart ** 2 / 2


def search_cells(queries: DataFrame, index: CellIndex, k: int = 5, stats: dict | None = None) -> DataFrame:
    """Top ``k`` rows per query (``query_id``, ``qv``), as ``retrieval.retrieve_topk`` gives them.
    ``stats`` takes the pairs there are and the pairs scored."""
    spark = index.rows.sparkSession
    asked = materialize(queries.where(_whole("qv")).select("query_id", F.col("qv").cast("array<double>").alias("qv")), "queries")
    n = max(1, -(-2 * asked.count() // QUERIES))  # blocks by hash, half full on average
    found = spark.createDataFrame([], PARTIAL)
    stats = {} if stats is None else stats
    stats.update(pairs=0, scored=0)
    for i in range(n if index.n.sum() else 0):
        block = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i).collect()
        for at in range(0, len(block), QUERIES):
            found = found.unionByName(_search_block(block[at:at + QUERIES], index, k, stats))
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("sim"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search_block(block: list, index: CellIndex, k: int, stats: dict) -> DataFrame:
    ids = np.array([r.query_id for r in block], np.int64)
    q = _norm(np.array([r.qv for r in block], np.float64))
    top = bounds(q, index)
    order = np.argsort(-top, axis=1, kind="stable")
    before = np.cumsum(index.n[order], axis=1) - index.n[order]
    wanted = np.zeros(top.shape, bool)
    np.put_along_axis(wanted, order, before < k, axis=1)  # the nearest cells until k rows are reached
    first = materialize(_ranked(_best_of(index, ids, q, wanted, k), k), "first")
    kth = dict(first.groupBy("query_id").agg(F.min("sim"), F.count(F.lit(1)).alias("n"))
               .where(F.col("n") >= k).select("query_id", "min(sim)").collect())
    floor = np.array([kth.get(x, -np.inf) for x in ids.tolist()])
    rest = ~wanted & (top + SLACK >= floor[:, None]) & (index.n > 0)
    stats["pairs"] += int(index.n.sum()) * len(ids)
    stats["scored"] += int(((wanted | rest) * index.n).sum())
    return first.drop("rank").unionByName(_best_of(index, ids, q, rest, k))


def _best_of(index: CellIndex, ids: np.ndarray, q: np.ndarray, wanted: np.ndarray, k: int) -> DataFrame:
    """Of each task's rows the ``k`` best for every query, from the cells it wants."""
    packed, shape = np.packbits(wanted), wanted.shape
    cells = np.flatnonzero(wanted.any(axis=0) & (index.n > 0)).tolist()
    rows = index.rows.where(F.col("cell").isin(cells)) if cells else index.rows.limit(0)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = np.unpackbits(packed, count=shape[0] * shape[1]).reshape(shape).astype(bool)
        sims, near = np.full((len(ids), k), -np.inf), np.zeros((len(ids), k), np.int64)
        for batch in batches:
            cell, at = np.asarray(batch.column(2)), np.asarray(batch.column(0))
            unit = _unit(batch.column(1))
            for c in np.unique(cell):
                who = np.flatnonzero(want[:, c])
                here = np.flatnonzero(cell == c)
                step = max(1, CELLS // len(who))
                for a in range(0, len(here), step):
                    some = here[a:a + step]
                    s = np.concatenate([sims[who], _round6(q[who] @ unit[some].T)], axis=1)
                    v = np.concatenate([near[who], np.broadcast_to(at[some], (len(who), len(some)))], axis=1)
                    keep = np.lexsort((v, -s), axis=1)[:, :k]
                    sims[who], near[who] = np.take_along_axis(s, keep, 1), np.take_along_axis(v, keep, 1)
        got = sims > -np.inf
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, got.sum(1))), pa.array(near[got]), pa.array(sims[got])],
            names=["query_id", "vec_id", "sim"])

    return rows.mapInArrow(best, PARTIAL)
