"""N-gram Jaccard join with a count-vector R-tree (operator 9).

A document's set is its distinct word shingles, hashed to 64 bits. The hashes
fall into m groups (ranges of the hash), and the group counts are a point: two
sets share at most the sum of the coordinates' minima. m depends on the size
class, so that a linked pair differs in fewer than m hashes: then some group
holds exactly the same hashes in both (pigeonhole), and (class, group, content)
is a signature under which the pair is sure to meet, with nothing capped.

1. Sets. Equal sets form one class (by a 64-bit digest of the set), represented once below.
2. Signatures are sent as packed arrays, dealt out by their hash. In a bucket
   the signatures of several sets give a star: every set and the smallest one.
   What occurs often within a task is starred there and sent on as one entry, so
   a signature that a third of all documents hold is no hot group.
3. Star pairs that share several signatures, or whose points allow a link, join
   their sets to candidate components (these only say who is compared with whom).
   A signature whose sets are still in several of them is a block: its points, in
   tiles of bounded size, are packed into an R-tree (nodes keep the coordinates'
   maxima and the least size), every point outside the block's largest component
   searches it, and what the bound allows joins components, one edge per join.
   So all linked sets share a candidate component; no pairs are listed.
4. The sets of a candidate component meet once, in tiles: an R-tree over their
   counts in many groups yields, for each set, partners that are not connected
   with it yet; these are verified on the sets themselves. A component of
   several tiles has its first sets in each of them, and what its tiles leave
   apart is compared across tiles, the largest connected part against the rest.

Joins with sides that grow with the input are sort-merge joins at every size (a
hint), so that a plan seen on little data is the plan on much, and Spark splits
them where a key is hot. Nothing depends on the order of rows or tasks, and each step ends in a table in
the shared folder.

Defined results: null, empty or blank text has size 0 and is linked with nothing;
fewer words than a shingle's are one shingle; repeated rows and equal texts share
a component; the component's id is the smallest id in it (rows without an id
have that of their component, or null).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh
from .components import components

GROWTH = 1.6  # ratio of size classes
FLUSH = 1 << 21  # signatures a task holds before it sends them
LOCAL = 32  # sets under one signature in a flush from which they are starred in place
TILE = 1024  # points of an R-tree
OFTEN = 3  # shared signatures from which two sets are compared without a look at their points
HUBS = 4  # sets that are in all tiles of a component
FANOUT = 16
U = np.uint64
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                        0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                        0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``n`` words (A-Z lower-cased)."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    if len(h) < n:
        return mix(np.array([xxhash.xxh3_64_intdigest(h.tobytes() + bytes([len(h)]))], np.uint64))
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        total += h[i:len(h) - n + 1 + i] * MULTIPLIERS[i % 8] * U(2 * (i // 8) + 1)
    return np.unique(mix(total))


def set_key(u: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(u.tobytes())
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


class Threshold:
    """Links are pairs with ``den * intersection >= num * union``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    @lru_cache(1024)  # noqa: B019
    def size_class(self, size: int) -> tuple[int, int]:
        """The class of a size and the largest size in it."""
        c, low = 0, 1
        while True:
            nxt = max(low + 1, int(low * GROWTH))
            if size < nxt:
                return c, nxt - 1
            c, low = c + 1, nxt

    @lru_cache(1024)  # noqa: B019
    def classes(self, size: int) -> tuple[tuple[int, int, int], ...]:
        """(class, groups, most hashes by which a pair of the class differs) for the
        classes of all sizes, up to its own, that a partner of this size can have.
        A pair is searched in the class of its smaller set. Classes whose links
        are equal sets only are left out."""
        out, s = [], max(1, -(-self.num * size // self.den))
        while s <= size:
            c, most = self.size_class(s)
            d = (self.den - self.num) * most // self.num
            if d:
                out.append((c, d + 2 + d // 4, d))
            s = most + 1
        return tuple(out)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)

    def overlap(self, sizes):
        """The least intersection of linked sets with this sum of sizes."""
        return -(-self.num * sizes // (self.num + self.den))


def group_of(u: np.ndarray, m: int) -> np.ndarray:
    """Group of each hash: ranges of the hash, so sorted hashes have sorted groups."""
    return ((u >> U(32)) * U(m)) >> U(32)


def signatures(u: np.ndarray, limit: Threshold) -> np.ndarray:
    """Signatures of a set; the lowest 8 bits are the class."""
    out = []
    mixed = mix(u ^ U(0x5851F42D4C957F2D))
    for c, m, d in limit.classes(len(u)):
        g = group_of(u, m)
        start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        content = np.add.reduceat(mixed, start)
        tag = g[start]
        if m - len(start) >= m - d:  # perhaps only empty groups agree: they count too
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), tag)
            tag, content = np.concatenate([tag, empty]), np.concatenate([content, np.zeros(len(empty), np.uint64)])
        s = mix(content + mix(tag * U(0x9E3779B97F4A7C15) + U(m)))
        out.append((s & ~U(0xFF)) | U(c))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def describe(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, ``n_shingles``, ``key``, ``mark``) per row; no key for an empty set. ``mark`` is a hash of
    the text: with the id it finds a text again, also where ids repeat or are null."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1):
                u = shingles(text.as_py(), n)
                rows.append((len(u), set_key(u)[0] if len(u) else None))
            cols = list(zip(*rows)) if rows else [[]] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols), batch.column(2)],
                                             ["id", "n_shingles", "key", "mark"])

    return own.mapInArrow(run, T.StructType([own.schema["id"], *(
        T.StructField(c, T.LongType()) for c in ("n_shingles", "key", "mark"))]))


def _shared(sig: np.ndarray, key: np.ndarray):
    """Sorted distinct (signature, key) rows, and each signature's begin and count."""
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
    sig, key = sig[new], key[new]
    begin = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, int)
    return sig, key, begin, np.diff(np.append(begin, len(sig)))


def _stars(sig, key, begin, count, wide):
    """Of the chosen signatures: rows (signature, key) and pairs (key, smallest key, class,
    how many signatures)."""
    inside = np.repeat(wide, count)
    hub = np.repeat(key[begin], count)[inside]
    sig, key = sig[inside], key[inside]
    kind = (sig & U(0xFF)).astype(np.int64)
    order = np.lexsort((kind, hub, key))
    pairs = np.stack([key, hub, kind])[:, order]
    new = np.ones(len(order), bool)
    new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(0)
    times = np.diff(np.append(np.flatnonzero(new), len(order)))
    pairs = np.concatenate([pairs[:, new], times[None, :]])
    return sig.view(np.int64), key, pairs[:, pairs[0] != pairs[1]]


def meet(docs: DataFrame, text_col: str, n: int, limit: Threshold) -> DataFrame:
    """Where sets meet: rows ``pair`` true (``a``: set, ``b``: the smallest set under a
    ``times`` shared signatures of the class) and false (``a``: shared signature, ``b``: a
    set that has it)."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(text_col).alias("text"))

    def flush(sigs, keys):
        sig = np.concatenate(sigs)
        key = np.repeat(np.array(keys, np.int64), [len(s) for s in sigs])
        sig, key, begin, count = _shared(sig, key)
        wide = count > LOCAL
        members, holders, pairs = _stars(sig, key, begin, count, wide)
        send = np.repeat(~wide, count)
        send[begin] = True
        sig, key = sig[send], key[send]
        bucket = ((sig >> U(8)) % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [(b, 0, np.stack([sig[o].view(np.int64), key[o]]).tobytes())
                for b in range(buckets) if len(o := order[edge[b]:edge[b + 1]])]
        for kind, data in ((1, pairs), (2, np.stack([members, holders]))):
            for piece in np.array_split(data, max(1, data.shape[1] // 4096), axis=1):
                if piece.shape[1]:  # anywhere, evenly
                    rows.append((int(piece[1, 0] % buckets), kind, np.ascontiguousarray(piece).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows) if rows else [[]] * 3, (pa.int32(), pa.int32(), pa.binary()))], ["bucket", "kind", "data"])

    def sign(batches):
        sigs, keys, held = [], [], 0
        for batch in batches:
            for text in batch.column(0):
                u = shingles(text.as_py(), n)
                s = signatures(u, limit)
                if len(s):
                    sigs.append(s)
                    keys.append(set_key(u)[0])
                    held += len(s)
                if held >= FLUSH:
                    yield flush(sigs, keys)
                    sigs, keys, held = [], [], 0
        if sigs:
            yield flush(sigs, keys)

    def gather(batches):
        sig, key = [], []

        def out(pair, a, b, kind, times):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), pair)), pa.array(a), pa.array(b), pa.array(kind.astype(np.int32)),
                 pa.array(times)], ["pair", "a", "b", "class", "times"])

        for batch in batches:
            for kind, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                x = np.frombuffer(data, np.int64).reshape(4 if kind == 1 else 2, -1)
                if kind:
                    yield out(True, *x) if kind == 1 else out(False, *x, x[0] & 255, np.ones_like(x[0]))
                else:
                    sig.append(x[0])
                    key.append(x[1])
        if sig:
            s, k, begin, count = _shared(np.concatenate(sig).view(np.uint64), np.concatenate(key))
            members, holders, pairs = _stars(s, k, begin, count, count > 1)
            yield out(False, members, holders, members & 255, np.ones_like(members))
            yield out(True, *pairs)

    sent = own.mapInArrow(sign, "bucket int, kind int, data binary").repartition(buckets, "bucket")
    return sent.select("bucket", "kind", "data").mapInArrow(gather, "pair boolean, a long, b long, class int, times long")


class RTree:
    """Packed over count vectors: a node keeps the coordinates' maxima and the least size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.lexsort((*points.T[:4], sizes))
        self.levels = [(points[order], sizes[order])]
        self.order = order
        while len(self.levels[-1][0]) > FANOUT:
            p, s = self.levels[-1]
            at = np.arange(0, len(p), FANOUT)
            self.levels.append((np.maximum.reduceat(p, at, axis=0), np.minimum.reduceat(s, at)))

    def search(self, q: np.ndarray, size: int, limit: Threshold) -> np.ndarray:
        """Points whose bound (the sum of minima with ``q``) allows a link."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            p, s = self.levels[depth]
            bound = np.minimum(p[at], q).sum(1, dtype=np.int64)
            at = at[bound >= limit.overlap(size + s[at])]
            if depth:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


class Forest(dict):
    """Union-find over 64-bit labels; the smallest label is a tree's root."""

    def find(self, x: int) -> int:
        while (up := self.setdefault(x, x)) != x:
            self[x] = x = self.setdefault(up, up)
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self[max(x, y)] = min(x, y)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, r) for x in list(self) if (r := self.find(x)) != x]


def point_of(u: np.ndarray, m: int) -> bytes:
    """Counts of the groups, and eight bits of each group's content."""
    g = group_of(u, m).astype(np.int64)
    content = np.zeros(m, np.uint64)
    np.add.at(content, g, mix(u))
    return np.bincount(g, minlength=m).astype("<u2").tobytes() + (mix(content) & U(0xFF)).astype(np.uint8).tobytes()


def read_point(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    m = len(data) // 3
    return np.frombuffer(data, "<u2", m), np.frombuffer(data, np.uint8, m, 2 * m)


def allowed(p, h, q, k, limit: Threshold) -> np.ndarray:
    """Whether the points ``p`` (contents ``h``) may be linked with ``q`` (``k``). A group
    of equal counts but other content shares at least one hash less than it counts."""
    both = np.minimum(p, q).sum(-1, dtype=np.int64) - ((p == q) & (h != k)).sum(-1)
    return both >= limit.overlap(p.sum(-1, dtype=np.int64) + int(q.sum()))


def count_vectors(texts: DataFrame, n: int, limit: Threshold) -> DataFrame:
    """(``key``, ``class``, ``point``) for every class in which a set is searched."""
    def run(batches):
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                u = shingles(text.as_py(), n)
                rows += [(key, c, point_of(u, m)) for c, m, _ in limit.classes(len(u))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.int32(), pa.binary()))], ["key", "class", "point"])

    return texts.select("key", "text").mapInArrow(run, "key long, class int, point binary")


def _edge_batch(found) -> pa.RecordBatch:
    u, v = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def star_edges(stars: DataFrame, points: DataFrame, limit: Threshold) -> DataFrame:
    """The star pairs (``a``, ``b``, ``class``) whose points allow a link."""
    own = lambda end: points.select(F.col("key").alias(end), "class", F.col("point").alias(f"p{end}"))
    both = stars.join(own("a").hint("merge"), ["a", "class"]).join(own("b").hint("merge"), ["b", "class"]).select("a", "b", "pa", "pb")

    def run(batches):
        for batch in batches:
            keep = [bool(allowed(*read_point(x), *read_point(y), limit))
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["u", "v"])

    return both.mapInArrow(run, "u long, v long").distinct()


def _tiled(rows: DataFrame, by: list[str], columns: list[str], work) -> DataFrame:
    """Edges that ``work`` finds in the rows of each tile (columns ``by``)."""
    k = len(by)
    dealt = rows.repartition(*by).sortWithinPartitions(*by).select(*by, *columns)

    def run(batches):
        here, held = None, []
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if here != row[:k]:
                    found += work(held)
                    here, held = row[:k], []
                held.append(row[k:])
            yield _edge_batch(found)
        yield _edge_batch(work(held))

    return dealt.mapInArrow(run, "u long, v long").distinct()


def block_edges(blocks: DataFrame, limit: Threshold) -> DataFrame:
    """Edges between components with points that allow a link, from the tiles of
    blocks (``group``, ``i``, ``j``, ``query``, ``key``, ``root``, ``point``)."""
    def work(rows):
        tree = [r for r in rows if not r[0]]
        if not tree or len(tree) == len(rows):
            return []
        p, h = (np.array(x) for x in zip(*(read_point(r[3]) for r in tree)))
        t, forest = RTree(p, p.sum(1, dtype=np.int64)), Forest()
        for _, _, root, point in (r for r in rows if r[0]):
            q, k = read_point(point)
            at = t.search(q, int(q.sum()), limit)
            for x in at[allowed(p[at], h[at], q, k, limit)]:
                forest.join(root, tree[x][2])
        return forest.edges()

    return _tiled(blocks, ["group", "i", "j"], ["query", "key", "root", "point"], work)


def connect(rows: list[tuple], n: int, limit: Threshold) -> list[tuple[int, int]]:
    """Edges that connect what is linked among (query, key, label, text): queries
    against the others, or all against all if there are no queries."""
    tree = list({r[1]: r for r in rows if not r[0]}.values())
    asked = [r for r in rows if r[0]]
    if not tree or len(tree) + len(asked) < 2:
        return []
    sets = [shingles(r[3], n) for r in tree]
    groups = int(min(2048, max(64, 2 ** np.ceil(np.log2(2 * np.median([len(u) for u in sets]) + 1)))))
    count = lambda u: np.bincount(group_of(u, groups).astype(np.int64), minlength=groups)
    points = np.array([count(u) for u in sets])
    kind = np.uint8 if points.max() < 256 else np.uint32
    sizes = np.array([len(u) for u in sets])
    t, forest = RTree(points.astype(kind), sizes), Forest()
    queries = ((r[2], shingles(r[3], n)) for r in asked) if asked else ((r[2], u) for r, u in zip(tree, sets))
    for label, u in queries:
        q = count(u)
        if q.max() > np.iinfo(kind).max:
            q = np.minimum(q, np.iinfo(kind).max)  # no count in the tree is larger
        for x in t.search(q.astype(kind), len(u), limit).tolist():
            if forest.find(label) != forest.find(tree[x][2]) and limit.linked(u, sets[x]):
                forest.join(label, tree[x][2])
    return forest.edges()


def tiles(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Tiles of the groups (``group``, ``key``) whose sets are in several components.
    Every set goes to tile row i of each tile column j; the sets outside the group's
    largest component are also the queries of column j against all rows."""
    own = members.join(roots.hint("merge"), F.col("key") == F.col("node"), "left").select(
        "group", "key", F.coalesce("root", "key").alias("root"))
    per = own.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n")).groupBy(F.col("group").alias("mixed")).agg(
        F.sum("n").alias("n"), F.max_by("root", F.struct("n", "root")).alias("major"), F.max("n").alias("most"))
    mixed = cut(per.where("n > most"), "mixed")
    rows = own.join(mixed.hint("merge"), F.col("group") == F.col("mixed"))
    high, wide = F.ceil(F.col("n") / TILE), F.ceil((F.col("n") - F.col("most")) / TILE)
    spot, zero = F.xxhash64("key"), F.lit(0).cast("long")
    base = rows.select("group", F.pmod(spot, high).alias("i"), F.explode(F.sequence(zero, wide - 1)).alias("j"),
                       F.lit(False).alias("query"), "key", "root")
    ask = rows.where(F.col("root") != F.col("major")).select(
        "group", F.explode(F.sequence(zero, high - 1)).alias("i"), F.pmod(spot, wide).alias("j"),
        F.lit(True).alias("query"), "key", "root")
    return base.union(ask)


def linked_roots(clusters: DataFrame, texts: DataFrame, n: int, limit: Threshold) -> DataFrame:
    """(``node``, ``root``) of the linked sets within candidate components (``node``, ``root``)."""
    work = lambda rows: connect(rows, n, limit)
    size = cut(clusters.groupBy(F.col("root").alias("_root")).agg(F.count(F.lit(1)).alias("n")), "sizes")
    rows = clusters.join(size, F.col("root") == F.col("_root")).select(
        F.col("root").alias("group"), F.col("node").alias("key"), "n", F.ceil(F.col("n") / TILE).alias("high"))
    wide = rows.where(F.col("n") > TILE)
    first = Window.partitionBy("group").orderBy("key")
    hubs = wide.withColumn("r", F.row_number().over(first)).where(F.col("r") <= HUBS).select(
        "group", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("high") - 1)).alias("i"))
    placed = rows.select("group", "key", F.pmod(F.xxhash64("key"), F.col("high")).alias("i")).union(hubs)
    met = placed.join(texts.hint("merge"), "key").select("group", "i", F.lit(False).alias("query"), "key",
                                           F.col("key").alias("label"), "text")
    edges = cut(_tiled(met, ["group", "i"], ["query", "key", "label", "text"], work), "linked")
    roots = cut(components(edges), "roots")
    if not wide.take(1):
        return roots
    apart = tiles(wide.select("group", "key"), roots).join(texts.hint("merge"), "key")
    more = cut(_tiled(apart, ["group", "i", "j"], ["query", "key", "root", "text"], work), "linked")
    return cut(merged(roots, more), "roots") if more.take(1) else roots


def merged(roots: DataFrame, more: DataFrame) -> DataFrame:
    """``roots`` after further edges, of which only those between components are contracted."""
    own = lambda end: roots.select(F.col("node").alias(f"{end}n"), F.col("root").alias(f"{end}r"))
    between = more
    for end in ("u", "v"):
        between = between.join(own(end), F.col(end) == F.col(f"{end}n"), "left")
    between = between.select(F.coalesce("ur", "u").alias("u"), F.coalesce("vr", "v").alias("v"))
    top = cut(components(between), "tops").select(F.col("node").alias("t"), F.col("root").alias("top"))
    moved = roots.join(top, F.col("root") == F.col("t"), "left").select("node", F.coalesce("top", "root").alias("root"))
    alone = top.join(roots.select("node"), F.col("t") == F.col("node"), "left_anti")
    return moved.union(alone.select(F.col("t").alias("node"), F.col("top").alias("root")))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
         num: int = 4, den: int = 5) -> DataFrame:
    """(``id``, ``n_shingles``, ``key``, ``root``, ``component_id``) per row of ``docs``;
    ``root`` is null for empty sets."""
    limit = Threshold(num, den)
    sets = cut(describe(docs, id_col, text_col, n), "sets")
    met = cut(meet(docs, text_col, n, limit), "met")
    members = met.where("not pair").select(F.col("a").alias("group"), F.col("b").alias("key"))

    chosen = cut(sets.where("key is not null").groupBy("key").agg(F.min(F.struct("id", "mark")).alias("of"))
                 .join(members.select("key").distinct().hint("merge"), "key").select("key", "of.id", "of.mark"), "chosen")
    by_id = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("_mark")).join(
        chosen.hint("merge"), (F.col("_mark") == F.col("mark")) & F.col("_id").eqNullSafe(F.col("id"))).select("key", "text")
    texts = cut(_own_texts(by_id, n), "texts")
    points = cut(count_vectors(texts, n, limit), "points")

    stars = cut(met.where("pair").groupBy("a", "b", "class").agg(F.sum("times").alias("times")), "stars")
    often = stars.where(F.col("times") >= OFTEN).select(F.col("a").alias("u"), F.col("b").alias("v"))
    clusters = cut(components(often.union(
        star_edges(stars.where(F.col("times") < OFTEN), points, limit))), "clusters")
    blocks = tiles(members, clusters).withColumn("class", F.col("group").bitwiseAND(255).cast("int"))
    more = cut(block_edges(blocks.join(points.hint("merge"), ["key", "class"]), limit), "block-edges")
    if more.take(1):
        clusters = cut(merged(clusters, more), "clusters")
    roots = linked_roots(clusters, texts, n, limit)

    found = sets.join(roots.hint("merge"), F.col("key") == F.col("node"), "left").select(
        "id", "n_shingles", "key", F.coalesce("root", "key").alias("root"))
    found = cut(found, "found")
    least = cut(found.where("root is not null").groupBy(F.col("root").alias("r"))
                .agg(F.min("id").alias("component_id")), "least")
    return found.join(least, F.col("root") == F.col("r"), "left").select(
        "id", "n_shingles", "key", "root",
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _own_texts(texts: DataFrame, n: int) -> DataFrame:
    """Rows may repeat: of the texts found by id and hash, one with the very set of its key."""
    def run(batches):
        for batch in batches:
            mask = pa.array([set_key(shingles(t.as_py(), n))[0] == k
                             for k, t in zip(batch.column(0).to_pylist(), batch.column(1))], pa.bool_())
            yield batch.filter(mask)

    return texts.mapInArrow(run, texts.schema).groupBy("key").agg(F.min("text").alias("text"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies (that of the smallest id);
    texts without words stay."""
    found = join(docs, id_col, text_col)
    row = fresh(docs, "_row")
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    rows = _with_key(named, row, text_col, 5)
    stay = cut(found.where(F.col("id").eqNullSafe(F.col("component_id")) & F.col("root").isNotNull())
               .groupBy("root").agg(F.min(F.struct("id", "key")).alias("s"))
               .select(F.col("s.id").alias("_id"), F.col("s.key").alias("_key")), "stay")
    picked = (rows.join(stay.hint("merge"), (F.col("key") == F.col("_key"))
                        & F.col(row)[id_col].eqNullSafe(F.col("_id")), "inner")
              .groupBy("key").agg(F.min(row).alias(row)).select(f"{row}.*"))
    return picked.unionByName(rows.where("key is null").select(f"{row}.*"))


def _with_key(rows: DataFrame, row: str, text_col: str, n: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            keys = []
            for text in batch.column(0).field(text_col):
                u = shingles(text.as_py(), n)
                keys.append(set_key(u)[0] if len(u) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64())], [row, "key"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("key", T.LongType())]))


def op9(docs: DataFrame) -> DataFrame:
    """The row per document of the dealt query: shingles of four words, 85 of 100."""
    out = join(docs.select("doc_id", "text"), n=4, num=85, den=100)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
