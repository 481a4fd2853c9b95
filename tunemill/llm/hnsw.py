"""Approximate nearest neighbours by inner product (operator 6): one hierarchical
navigable small-world graph per shard, stored as flat neighbour arrays, and the
shards' results merged.

Equal vectors are one node, known by a digest of the vector, that keeps the ids which can ever be among the
nearest (the smallest ``k + 1``; a rank limit that Spark applies before the
shuffle, so a vector that a third of all rows share moves few rows). Nodes are
dealt to shards of about ``SHARD`` by a hash; a task builds one graph. The
largest inner product is the least distance once a coordinate
sqrt(max |x|^2 - |x|^2) is added, so the graphs are built on distances.
Insertion and search run many points in step. A graph is one row of a written
table: vectors, ids, and per level the nodes and their neighbours.

Every distinct query vector is searched in every shard of its dimension, in
tasks of one graph and at most about ``QUERIES`` queries; each shard returns its
``k + 1`` best (the row itself may be among them), and the best of all shards
are ranked per query.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do rows without an id; repeated rows (same id and
vector) count once; an id with several vectors asks with each of them, is found by
each of them, and meets another id once, at their largest score; vectors are
compared within their dimension; with fewer than
``k`` candidates all are returned; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARD = 8192
QUERIES = 16384
SALTS = 12
DEGREE = 16  # neighbours per new point; lists hold twice as many on the lowest level
BEAM_BUILD, BEAM_SEARCH = 64, 128
STEP = 512  # points that are inserted or searched together


def distances(x: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distance (less |q|^2) of each query to its own candidates."""
    p = x[ids]
    return np.einsum("bkd,bkd->bk", p, p) - 2 * np.einsum("bkd,bd->bk", p, q)


def beam(x: np.ndarray, neighbours: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int):
    """Best-first search of all queries in step; (ids, distances), nearest first, -1 where none.

    ``entry`` holds one start per query; each round expands every query's nearest
    unexpanded candidate until all candidates in its beam are expanded.
    """
    b, n = len(q), len(x)
    row = np.arange(b)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # the padding
    seen[row, entry] = True
    ids = np.full((b, width), n)
    dist = np.full((b, width), np.inf, np.float32)
    done = np.ones((b, width), bool)
    ids[:, 0], dist[:, 0], done[:, 0] = entry, distances(x, q, entry[:, None])[:, 0], False
    live = row
    while len(live):
        open_ = np.where(done[live], np.inf, dist[live])
        at = open_.argmin(1)
        more = np.isfinite(open_[np.arange(len(live)), at])
        live, at = live[more], at[more]
        if not len(live):
            break
        done[live, at] = True
        near = neighbours[ids[live, at]]
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        d = np.where(fresh, distances(x, q[live], np.where(fresh, near, 0)), np.inf).astype(np.float32)
        all_d = np.concatenate([dist[live], d], 1)
        all_i = np.concatenate([ids[live], near], 1)
        all_o = np.concatenate([done[live], ~fresh], 1)
        keep = np.argpartition(all_d, width - 1, axis=1)[:, :width]
        dist[live] = np.take_along_axis(all_d, keep, 1)
        ids[live] = np.take_along_axis(all_i, keep, 1)
        done[live] = np.take_along_axis(all_o, keep, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    return np.where(np.isfinite(dist), ids, -1), dist


def choose(x: np.ndarray, ids: np.ndarray, dist: np.ndarray, norm: np.ndarray, m: int) -> np.ndarray:
    """Of each row's candidates (nearest first) at most ``m`` that are nearer to the
    point than to any chosen one, filled up with the nearest others; -1 where none."""
    b, k = ids.shape
    real = ids >= 0
    p = x[np.where(real, ids, 0)]
    sq = np.einsum("bkd,bkd->bk", p, p)
    between = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(p, p.transpose(0, 2, 1))
    near = dist + norm[:, None]
    closest = np.full((b, k), np.inf, np.float32)
    taken = np.zeros((b, k), bool)
    for j in range(k):
        take = real[:, j] & (near[:, j] < closest[:, j]) & (taken.sum(1) < m)
        taken[:, j] = take
        closest[take] = np.minimum(closest[take], between[take, j])
    rank = np.where(taken, 0, np.where(real, 1, 2)) * k + np.arange(k)
    order = np.argsort(rank, axis=1)[:, :m]
    return np.where(np.take_along_axis(real, order, 1), np.take_along_axis(ids, order, 1), -1)


def link(x: np.ndarray, neighbours: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Adds the edges new -> chosen and back; a full list keeps its nearest."""
    n, cap = len(x), neighbours.shape[1]
    src, dst = np.repeat(new, chosen.shape[1]), chosen.ravel()
    ok = dst >= 0
    a = np.concatenate([src[ok], dst[ok]])
    b = np.concatenate([dst[ok], src[ok]])
    touched = np.unique(a)
    old = neighbours[touched]
    a = np.concatenate([a, np.repeat(touched, cap)[old.ravel() < n]])
    b = np.concatenate([b, old.ravel()[old.ravel() < n]])
    pair = np.unique(a.astype(np.int64) * (n + 1) + b)
    a, b = pair // (n + 1), pair % (n + 1)
    d = ((x[a] - x[b]) ** 2).sum(1)
    order = np.lexsort((b, d, a))
    a, b = a[order], b[order]
    begin = np.searchsorted(a, touched)
    rank = np.arange(len(a)) - np.repeat(begin, np.diff(np.append(begin, len(a))))
    own = rank < cap
    neighbours[touched] = n
    neighbours[a[own], rank[own]] = b[own]


def build_level(x: np.ndarray, entries, cap: int) -> np.ndarray:
    """Neighbour lists (padded with len(x)) of one level; points are inserted in order,
    in steps no larger than what is there. ``entries``: start for given points, or None."""
    n = len(x)
    neighbours = np.full((n + 1, cap), n)
    norm = (x**2).sum(1)
    at = 0
    while at < n:
        new = np.arange(at, min(n, at + max(32, min(at, STEP))))
        inside = norm[new][None, :] - 2 * x[new] @ x[new].T
        np.fill_diagonal(inside, np.inf)
        k = min(DEGREE, len(new) - 1)
        near = np.argsort(inside, axis=1)[:, :k]
        ids, dist = new[near], np.take_along_axis(inside, near, 1)
        if at:
            start = np.zeros(len(new), int) if entries is None else entries(new, at)
            found, d = beam(x, neighbours, x[new], start, BEAM_BUILD)
            ids, dist = np.concatenate([found, ids], 1), np.concatenate([d, dist], 1)
            order = np.argsort(dist, axis=1, kind="stable")[:, :BEAM_BUILD]
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        if ids.shape[1]:
            link(x, neighbours, new, choose(x, ids, dist, norm[new], DEGREE))
        at = new[-1] + 1
    return neighbours[:n]


class Graph:
    """Levels from the lowest; ``counts[l]`` first points are on level l (points are
    ordered by falling level), ``lists[l]`` their neighbours."""

    def __init__(self, x: np.ndarray, lists: list[np.ndarray]):
        self.x, self.lists = x, lists

    @classmethod
    def build(cls, x: np.ndarray, counts: list[int]) -> Graph:
        g = cls(x, [])
        for level in range(len(counts) - 1, -1, -1):
            own = x[:counts[level]]
            above = g.lists[:]
            upper = cls(x, above) if above else None

            def entries(new, at, upper=upper):
                return np.minimum(upper.descend(x[new]), at - 1)

            g.lists.insert(0, build_level(own, entries if upper else None, DEGREE * (2 if level == 0 else 1)))
        return g

    def descend(self, q: np.ndarray) -> np.ndarray:
        """The nearest point found on the lowest level of ``lists``, level by level."""
        at = np.zeros(len(q), int)
        for near in reversed(self.lists):
            at = beam(self.x[:len(near)], near, q, at, 4)[0][:, 0]
        return at

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        entry = Graph(self.x, self.lists[1:]).descend(q)
        return beam(self.x, self.lists[0], q, entry, width)[0]


def lifted(v: np.ndarray) -> np.ndarray:
    """Vectors scaled to at most unit length, with the coordinate that makes all lengths 1."""
    size = np.sqrt((v / np.abs(v).max()) ** 2 @ np.ones(v.shape[1])) * np.abs(v).max()
    u = v / size.max()
    last = np.sqrt(np.maximum(0, 1 - (u**2).sum(1)))
    return np.concatenate([u, last[:, None]], 1).astype(np.float32)


def level_counts(n: int) -> list[int]:
    """Points per level: each level keeps one in DEGREE of the one below."""
    counts = [n]
    while counts[-1] > 2 * DEGREE:
        counts.append(counts[-1] // DEGREE)
    return counts


def nodes_of(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: ``node`` (128-bit digest), ``dim``, ``vec``, ``ids`` (the k + 1 smallest)."""
    few = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).select("vec", "salt", "id").distinct()
    for part in (["vec", "salt"], ["vec"]):  # a vector shared by very many rows is thinned in several tasks first
        few = few.withColumn("r", F.row_number().over(Window.partitionBy(*part).orderBy("id"))).where(F.col("r") <= k + 1)
    nodes = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return nodes.select(F.md5(F.col("vec").cast("string")).alias("node"), F.size("vec").alias("dim"), "vec", "ids")


def clean(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


INDEX = "dim int, shard long, vecs binary, ids binary, ends binary, lists array<binary>"


def build_index(nodes: DataFrame) -> DataFrame:
    """One row per shard: vectors, ids of each node, and the flat neighbour lists of each level."""
    per = nodes.groupBy(F.col("dim").alias("_dim")).agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("shards"))
    dealt = nodes.join(per, F.col("dim") == F.col("_dim")).withColumn(
        "shard", F.pmod(F.xxhash64("node"), F.col("shards")))

    def build(key, t):
        t = t.combine_chunks().sort_by("mix")
        v = np.array(t["vec"].combine_chunks().flatten()).reshape(len(t), -1)
        ids = t["ids"].combine_chunks()
        ends = np.cumsum(np.array(pa.compute.list_value_length(ids)))
        g = Graph.build(lifted(v), level_counts(len(v)))
        return pa.table({
            "dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int64()),
            "vecs": pa.array([v.astype("<f8").tobytes()], pa.binary()),
            "ids": pa.array([np.array(ids.flatten()).astype("<i8").tobytes()], pa.binary()),
            "ends": pa.array([ends.astype("<i8").tobytes()], pa.binary()),
            "lists": pa.array([[x.astype("<i4").tobytes() for x in g.lists]], pa.list_(pa.binary()))})

    # Inserted in the order of a hash, so that levels hold a fair share of all regions.
    # As many partitions as shards: a graph takes far more time than its bytes let Spark expect.
    return (dealt.select("dim", "shard", "vec", "ids", F.xxhash64(F.lit("order"), "node").alias("mix"))
            .repartition(max(1, -(-nodes.count() // SHARD)), "dim", "shard")
            .groupBy("dim", "shard").applyInArrow(build, INDEX))


def _search_table(index: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    empty = {"qnode": pa.string(), "vec_id": pa.int64(), "score": pa.float64()}
    if not len(index) or not len(asked):
        return pa.table({c: pa.array([], t) for c, t in empty.items()})
    r = index.slice(0, 1).to_pylist()[0]
    v = np.frombuffer(r["i_vecs"], "<f8").reshape(-1, r["i_dim"])
    ids, ends = np.frombuffer(r["i_ids"], "<i8"), np.frombuffer(r["i_ends"], "<i8")
    counts = level_counts(len(v))
    graph = Graph(lifted(v), [np.frombuffer(x, "<i4").reshape(c, -1).astype(np.int64)
                              for x, c in zip(r["i_lists"], counts)])
    qnode = np.array(asked["qnode"].to_pylist(), object)
    q = np.array(asked["qvec"].combine_chunks().flatten()).reshape(len(qnode), -1)
    out: list[list] = [[], [], []]
    for a in range(0, len(q), STEP):
        part = q[a:a + STEP]
        unit = part / np.abs(part).max(1, keepdims=True)
        unit = unit / np.sqrt((unit**2).sum(1, keepdims=True))
        unit = np.concatenate([unit, np.zeros((len(unit), 1))], 1).astype(np.float32)
        for node, vector, found in zip(qnode[a:a + STEP], part, graph.search(unit, max(BEAM_SEARCH, 2 * (k + 1)))):
            found = found[found >= 0]
            score = (v[found] * vector).sum(1)
            size = np.diff(np.concatenate([[0], ends]))[found]
            own = np.concatenate([ids[ends[f] - s:ends[f]] for f, s in zip(found, size)])
            score = np.repeat(score, size)
            best = np.lexsort((own, -score))
            best = best[np.sort(np.unique(own[best], return_index=True)[1])[:k + 1]]  # an id once, at its largest
            out[0].append(np.full(len(best), node, object))
            out[1].append(own[best])
            out[2].append(score[best])
    return pa.table({c: pa.array(np.concatenate(x), t) for (c, t), x in zip(empty.items(), out)})


def search(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(``qnode``, ``vec_id``, ``score``): the k + 1 best of all shards for each asked vector
    (``qnode``, ``dim``, ``qvec``)."""
    shards = index.select(F.col("dim").alias("_dim"), F.col("shard").alias("at"))
    blocks = F.lit(max(1, -(-asked.count() // QUERIES))).cast("long")
    spread = (asked.withColumn("block", F.pmod(F.xxhash64("qnode"), blocks))
              .join(shards, F.col("dim") == F.col("_dim")).select("dim", "at", "block", "qnode", "qvec"))
    copies = index.toDF(*[f"i_{c}" for c in index.columns]).withColumn("i_block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    found = (copies.groupBy("i_dim", "i_shard", "i_block").cogroup(spread.groupBy("dim", "at", "block"))
             .applyInArrow(lambda i, q: _search_table(i, q, k), "qnode string, vec_id long, score double"))
    found = found.groupBy("qnode", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("qnode").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")


def nearest(rows: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``) for the rows that ``is_query`` (a
    function of the id column) selects, against all other rows."""
    valid = clean(rows, id_col, vec_col)
    nodes = cut(nodes_of(valid, k), "nodes")
    index = cut(build_index(nodes), "graphs")
    queries = cut(valid.where(is_query(F.col("id"))).distinct()
                  .join(nodes.select("vec", "node", "dim"), "vec").select(F.col("id").alias("query_id"), "node"), "queries")
    asked = queries.select("node").distinct().join(nodes, "node").select(
        F.col("node").alias("qnode"), "dim", F.col("vec").alias("qvec"))
    found = search(index, asked, k)
    per = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (queries.join(found, F.col("node") == F.col("qnode")).where("query_id <> vec_id")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(per)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op6(embeddings: DataFrame) -> DataFrame:
    """The rows of the dealt query: 20 nearest of every row whose id is divisible by 20."""
    return nearest(embeddings, lambda i: i % 20 == 0)
