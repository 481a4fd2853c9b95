"""Periodic run detection (operator 13): descending-LCP Kruskal over words.

A run is a stretch of consecutive words whose smallest period q fits into it at
least twice, extended as far as that period holds. In a text's suffix order,
suffixes that share a prefix of l words are a class. Classes are united by
decreasing common prefix with union-find, each as an ordered set of positions.
When two positions p < p + q become neighbours in the united set at level l with
q <= l, the words p .. p+q+l-1 have smallest period q: a shorter one would have put
another position of the class between them. Every run is seeded so, by its first
word and the word one period on; seeds that extend to the left belong to a run
that starts earlier and are left out.

A document is a row and nothing is grouped or shuffled: each Arrow batch is worked
off in stretches of ``WORDS`` words or one document. The documents of a stretch form
one array with a unique mark after each, so prefix doubling (on what is still
tied) and common prefixes are computed for all of them at once. Classes below half
of ``min_words`` seed no run and are not united; that is a property of runs, not a cap.
Memory is that of a stretch: its words, and four bytes a word for each doubling of
its longest repeat.

Defined results
* null, empty or blank text: no words, no runs, collapsed text "".
* repeated rows, null ids: each row stands for itself.
* one word repeated n times is one run of period 1.
* other columns, whatever their names, are passed through.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, words

WORDS = 1 << 18
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix order by prefix doubling, and the ranks of the prefixes of 1, 2, 4, ... words
    (-1 behind the end). A rank is the place of its class's first suffix in the order."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = np.empty(n, bool)
    first[:1] = True
    first[1:] = ids[order[1:]] != ids[order[:-1]]
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, size = [rank], 1
    while True:
        last = np.ones(n, bool)
        last[:-1] = first[1:]
        tied = np.flatnonzero(~(first & last))  # places in the order whose class has several suffixes
        if not len(tied):
            return order, levels
        at = order[tied]
        after = rank[np.minimum(at + size, n)].astype(np.int64)
        by = np.lexsort((after, rank[at]))
        order[tied] = at = at[by]
        after, old = after[by], rank[at]
        first[tied] = np.r_[True, (old[1:] != old[:-1]) | (after[1:] != after[:-1])]
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(first[tied], tied, 0))
        levels.append(rank)
        size *= 2


def common_prefixes(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Common prefix, in words, of the suffixes at ``a`` and ``b``, from the ranks of all doublings."""
    a, b = a.copy(), b.copy()
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = (levels[k][a] == levels[k][b]).astype(np.int64) << k
        a += step
        b += step
        out += step
    return out


def find(root: list[int], x: int) -> int:
    while root[x] != x:
        root[x] = x = root[root[x]]
    return x


def runs_of(ids: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``min_words`` words."""
    least = (min_words + 1) // 2
    if len(ids) < min_words:
        return []
    order, levels = suffix_order(ids)
    a, b = order[:-1], order[1:]
    shares = levels[min(least.bit_length() - 1, len(levels) - 1)]
    near = np.flatnonzero(shares[a] == shares[b])
    a, b = a[near], b[near]
    lcp = common_prefixes(a, b, levels)
    keep = np.flatnonzero(lcp >= least)
    keep = keep[np.argsort(-lcp[keep], kind="stable")]
    a, b, lcp = a[keep], b[keep], lcp[keep]
    at, index = np.unique(np.r_[a, b], return_inverse=True)
    root = list(range(len(at)))
    members = [[p] for p in at.tolist()]
    seeds = []
    ia, ib = index[:len(a)].tolist(), index[len(a):].tolist()
    for x, y, level in zip(ia, ib, lcp.tolist()):
        x, y = find(root, x), find(root, y)
        big, small = members[x], members[y]
        if len(big) < len(small):
            x, y, big, small = y, x, small, big
        places = [bisect_left(big, p) for p in small]
        for i, (p, j) in enumerate(zip(small, places)):
            if j and p - big[j - 1] <= level and (not i or places[i - 1] != j):
                seeds.append((big[j - 1], p - big[j - 1], level))
            if j < len(big) and big[j] - p <= level and (i + 1 == len(small) or places[i + 1] != j):
                seeds.append((p, big[j] - p, level))
        if len(small) == 1:
            big.insert(places[0], small[0])
        else:
            big += small
            big.sort()
        root[y], members[y] = x, []
    return sorted((p, q + level, q) for p, q, level in seeds
                  if q + level >= min_words and (not p or ids[p - 1] != ids[p + q - 1]))


def stretches(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """The documents' words, in lists of at most ``WORDS`` words or one document."""
    held, n = [], 0
    for text in texts:
        w = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
        if held and n + len(w) > WORDS:
            yield held
            held, n = [], 0
        held.append(w)
        n += len(w)
    if held:
        yield held


def numbers(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """One array of word numbers that no two documents share, with a unique mark after
    each document, and where each document starts."""
    sizes = np.array([len(w) for w in docs], np.int64)
    starts = np.r_[0, np.cumsum(sizes + 1)]
    ids, base = np.empty(starts[-1], np.int64), 0
    for w, s in zip(docs, starts.tolist()):
        known = {x: i for i, x in enumerate(dict.fromkeys(w), base)}
        base += len(known) + 1
        ids[s:s + len(w)] = np.fromiter(map(known.__getitem__, w), np.int64, len(w))
        ids[s + len(w)] = base - 1
    return ids, starts


def collapse(docs: list[list[bytes]], min_words: int) -> Iterator[tuple[list[dict], bytes]]:
    """Each document's runs and its words without the repeats."""
    ids, starts = numbers(docs)
    found = runs_of(ids, min_words)
    edges = np.zeros(len(ids) + 1, np.int64)
    for s, n, q in found:
        edges[s + q] += 1
        edges[s + n] -= 1
    gone = np.cumsum(edges) > 0
    cuts = np.searchsorted([r[0] for r in found], starts)
    for i, w in enumerate(docs):
        s = int(starts[i])
        own = [{"start": p - s, "length": n, "period": q} for p, n, q in found[cuts[i]:cuts[i + 1]]]
        if own:
            w = [x for x, drop in zip(w, gone[s:s + len(w)].tolist()) if not drop]
        yield own, b" ".join(w)


def find_runs(docs: DataFrame, text_col: str = "text", min_words: int = 12) -> DataFrame:
    """``docs`` plus ``n_words``, ``runs`` (by start, then period) and ``collapsed``: the words of
    ``text_col`` that no run holds after its first period, joined by one space (names
    taken are given anew, see ``fresh``). Words are split at white space (ASCII)."""
    if min_words < 2:
        raise ValueError("a run has two words at least")
    names = [fresh(docs, c) for c in ("n_words", "runs", "collapsed")]
    place = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType()),
                           T.StructField(names[1], T.DataType.fromDDL(RUNS)), T.StructField(names[2], T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for some in stretches(batch.column(place)):
                runs, kept = zip(*collapse(some, min_words))
                part = batch.slice(done, len(some))
                done += len(some)
                more = [pa.array([len(w) for w in some], pa.int64()), pa.array(runs, RUNS_ARROW),
                        pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*batch.schema.names, *names])

    return docs.mapInArrow(work, schema)


def periodised(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) as the dealt query reads them: a document whose crc32 of its id ends in 0
    has the words from a on replaced by repeats of the first p of them. A null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.expr("crc32(cast(doc_id as string)) div 10")
    with_words = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    a, p = F.col("a"), F.col("p")
    n = F.size("w").cast("long")
    placed = (with_words.withColumn("a", F.when(n > 0, F.col("g") % n))
              .withColumn("p", F.when(n > 0, F.expr("1 + (size(w) - a) div (3 + g % 8)"))))
    again = F.transform("w", lambda x, i: F.when(i >= a, F.get(F.col("w"), (a + (i - a) % p).cast("int"))).otherwise(x))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.concat_ws(" ", again))
                         .otherwise(F.col("text")).alias("text"))


def op13(docs: DataFrame) -> DataFrame:
    """The digest row per document of the dealt query."""
    out = find_runs(periodised(docs.select("doc_id", "text")))
    first = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                               (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = out.withColumn("first", first)
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("first.start")).alias("start"),
                      F.col("first.length").alias("length"), (-F.col("first.period")).alias("period"),
                      F.expr("(1000 * first.length) div -first.period").cast("long").alias("exponent_milli"),
                      F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"))


SQL = r"""
WITH crc AS (
  SELECT doc_id, text, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda x, c: xor(x >> 8, list_reduce([xor(x & 255, c), 0, 0, 0, 0, 0, 0, 0, 0],
                                         lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))), 4294967295) AS h
  FROM documents),
split AS (
  SELECT doc_id, h, h // 10 AS g,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w0
  FROM crc),
placed AS (
  SELECT *, len(w0) AS n, CASE WHEN len(w0) > 0 THEN g % len(w0) END AS a,
         CASE WHEN len(w0) > 0 THEN 1 + (len(w0) - g % len(w0)) // (3 + g % 8) END AS p
  FROM split),
docs AS (
  SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
                      THEN list_transform(range(n), lambda i: w0[1 + (CASE WHEN i >= a THEN a + (i - a) % p ELSE i END)])
                      ELSE w0 END AS w
  FROM placed),
six AS (
  SELECT doc_id, unnest(range(len(w) - 5)) AS i,
         unnest(list_transform(range(len(w) - 5), lambda i: array_to_string(w[i + 1:i + 6], ' '))) AS k
  FROM docs WHERE len(w) >= 12),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM six x JOIN six y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i),
isles AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM same),
periods AS (
  SELECT doc_id, q, min(i) AS s, count(*) + 5 + q AS n FROM isles GROUP BY doc_id, q, isle
  HAVING count(*) + 5 >= q AND count(*) + 5 + q >= 12),
runs AS (
  SELECT * FROM periods r WHERE NOT EXISTS (
    SELECT 1 FROM periods o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.n >= r.s + r.n)),
told AS (
  SELECT doc_id, count(*) AS n_runs, max((n, -s, -q)) AS best,
         string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i FROM docs)
  LEFT JOIN (SELECT doc_id, i, true AS out FROM gone) USING (doc_id, i) WHERE out IS NULL GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, (-best[2])::BIGINT AS start, best[1]::BIGINT AS length,
       (-best[3])::BIGINT AS period, (1000 * best[1] // -best[3])::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM docs d LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
