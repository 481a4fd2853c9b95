"""Ranked lexical search (operator 12): the Best Position Algorithm over impact lists.

Every document is scored against every item by integer impacts (see ``impact``).
The items are a stated query set and go against all documents in blocks of
``BLOCK`` characters, so what a task or the driver holds of them is bounded.

1. One pass over the documents counts, in each, the occurrences of the block's terms:
   a table with a row per document (its length, term numbers, counts). The number
   of documents, of all terms, and of the documents per term come from that table.
2. One pass over the table makes shards of at most ``POSTINGS`` occurrences, in place:
   no posting is shuffled. A shard has a list per term, ordered by falling
   impact, and direct access to a document's place in every list.
3. For each item, the lists of its terms are read from the top, all to the same depth. A
   document met for the first time is scored by direct access to all lists, which
   marks its places there. A list's best position is the end of its unbroken marked part: it
   may lie far below the last place read. No unseen document scores more than the sum
   of the impacts right behind the best positions, so reading stops when that is strictly
   below the k-th score (at the k-th score an unseen document could still win a tie). The
   k-th score of the shards that the task has done before counts as well.
4. The shards' best documents, at most k an item and shard, are ranked by Spark.

Defined results
* null or empty text: a document without terms, not counted in N; an item without terms has no rows.
* repeated document rows: each is a document, in the counts and in the ranking.
* null document ids: documents like others; they come last in ties.
* repeated items (same id, same text) are one item; items with one id and other texts are
  ranked each on its own; a null item id is an id.
* no documents with terms: no rows.
* only id and text are read; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

BLOCK = 1 << 20  # characters of item texts in one pass over the documents
POSTINGS = 1 << 20  # occurrences in one shard
STEP = 32  # places read from each list in an item's first round; doubled from round to round

# ---------------------------------------------------------------------------
# FIXED VALUES: the term rule [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+ and A-Z lower-cased.
# ---------------------------------------------------------------------------
FOLD = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32
             for c in range(256))
# ---------------------------------------------------------------------------


def terms(text: str | bytes | None) -> list[bytes]:
    """The text's terms in order, in UTF-8."""
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A posting's impact before its term's weight, in 64-bit integers."""
    m = 100 - 90 + (90 * length * n_docs) // n_terms
    return (1000000000 * tf) // (1000 * tf + 8 * m)


def count_terms(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """(``doc``, ``n``, ``term``, ``tf``) per document that has a term: its number of terms, and the
    numbers and counts of those in ``vocab``, by rising number."""
    schema = T.StructType([docs.schema[0], *T._parse_datatype_string(
        "n bigint, term array<int>, tf array<int>").fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, found, counts = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                w = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                if w:
                    tf = Counter(map(vocab.get, w))
                    tf.pop(None, None)
                    known = sorted(tf)
                    rows.append(i)
                    sizes.append(len(w))
                    found.append(known)
                    counts.append([tf[t] for t in known])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=schema.names)

    return docs.mapInArrow(work, schema)


class Shard:
    """Impact lists of some documents, with direct access."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int, n_terms: int):
        """Postings by rising document and term; ``value`` is the impact times the term's weight."""
        by = np.lexsort((-value, term))
        self.n_docs, self.width = n_docs, n_terms
        self.key = doc * n_terms + term
        self.place = np.empty(len(by), np.int64)
        self.place[by] = np.arange(len(by))
        self.doc, self.value = doc[by], value[by]
        self.start = np.searchsorted(term[by], np.arange(n_terms + 1))
        self.seen = np.zeros(n_docs, bool)

    def direct(self, docs: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of ``docs`` over the terms ``of`` (both rising), and all their places in the lists."""
        want = docs[:, None] * self.width + of
        at = np.searchsorted(self.key, want.ravel())
        at[at == len(self.key)] = 0
        hit = (self.key[at] == want.ravel())
        place = self.place[at]
        score = np.where(hit, self.value[place], 0).reshape(want.shape).sum(axis=1)
        return score, place[hit]

    def best(self, of: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """All documents that may be among the ``k`` best over the terms ``of`` (rising), their scores,
        and the number of places read. Documents below ``floor``, or scoring 0, are left out."""
        begin, end = self.start[of], self.start[of + 1]
        full = end > begin
        of, begin, end = of[full], begin[full], end[full]
        unseen = [np.ones(e - b + 1, bool) for b, e in zip(begin, end)]  # the last one, behind the list, stays
        best_at = np.zeros(len(of), np.int64)
        found, scores, top = [], [], np.zeros(0, np.int64)
        depth, step, read = 0, STEP, 0
        while len(of):
            parts = [self.doc[b + depth:min(b + depth + step, e)] for b, e in zip(begin, end) if b + depth < e]
            docs = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
            read += sum(map(len, parts))
            docs = docs[~self.seen[docs]]
            depth, step = depth + step, step * 2
            if len(docs):
                self.seen[docs] = True
                score, places = self.direct(docs, of)
                found.append(docs)
                scores.append(score)
                top = np.r_[top, score]
                if len(top) > k:
                    top = np.partition(top, len(top) - k)[-k:]
                own = np.searchsorted(end, places, side="right")
                for t, b in enumerate(begin):
                    unseen[t][places[own == t] - b] = False
                    best_at[t] += np.argmax(unseen[t][best_at[t]:])
            behind = begin + best_at
            limit = int(self.value[np.minimum(behind, end - 1)][behind < end].sum())
            kth = max(int(top.min()) if len(top) == k else 0, floor)
            if limit < kth or limit == 0:
                break
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), read
        found, scores = np.concatenate(found), np.concatenate(scores)
        self.seen[found] = False
        kth = max(int(top.min()) if len(top) == k else 1, floor, 1)
        return found[scores >= kth], scores[scores >= kth], read


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of at most ``POSTINGS`` postings, or one document."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        a = 0
        for b, size in enumerate(sizes.tolist()):
            if n and n + size > POSTINGS:
                held.append(batch.slice(a, b - a))
                yield pa.concat_batches(held)
                held, n, a = [], 0, b
            n += size
        held.append(batch.slice(a))
    if sum(map(len, held)):
        yield pa.concat_batches(held)


def search_shards(counts: DataFrame, items: list[list[int]], weights: list[int], n_docs: int, n_terms: int,
                  k: int) -> DataFrame:
    """(``item``, ``doc``, ``score``): of each shard the documents that may be among an item's k best."""
    schema = T.StructType([*T._parse_datatype_string("item int").fields, counts.schema["doc"],
                           *T._parse_datatype_string("score bigint").fields])
    weigh = np.array(weights, np.int64)
    asked = [np.array(sorted(t for t in set(i) if weights[t]), np.int64) for i in items]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [np.zeros(0, np.int64) for _ in items]
        for rows in shards(batches):
            term = rows.column(2).flatten().to_numpy().astype(np.int64)
            tf = rows.column(3).flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(rows)), pc.list_value_length(rows.column(2)).to_numpy())
            length = rows.column(1).to_numpy()
            shard = Shard(doc, term, weigh[term] * impact(tf, length[doc], n_docs, n_terms), len(rows), len(weigh))
            order = np.empty(len(rows), np.int64)
            order[pc.sort_indices(rows.column(0)).to_numpy()] = np.arange(len(rows))
            out_item, out_doc, out_score = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, of in enumerate(asked):
                floor = int(tops[i].min()) if len(tops[i]) == k else 0
                docs, scores, _ = shard.best(of, k, floor)
                first = np.lexsort((order[docs], -scores))[:k]
                docs, scores = docs[first], scores[first]
                tops[i] = np.sort(np.r_[tops[i], scores])[-k:]
                out_item.append(np.full(len(docs), i, np.int32))
                out_doc.append(docs)
                out_score.append(scores)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out_item)), rows.column(0).take(pa.array(np.concatenate(out_doc))),
                 pa.array(np.concatenate(out_score))], names=schema.names)

    return counts.mapInArrow(work, schema)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text", k: int = 10) -> DataFrame:
    """(``item_id``, ``rank``, ``doc_id``, ``score``): each item's ``k`` documents of the highest scores above 0,
    ties by rising document id. The id columns keep their names and types; where the two have one name,
    the document's is ``doc_id``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc"), F.col(doc_text).cast("string").alias("text"))
    items = items.select(F.col(item_id).alias("id"), F.col(item_text).cast("string").alias("text")).distinct()
    size = items.agg(F.sum(F.char_length("text")).alias("n")).first().n or 0
    blocks = 1 + size // BLOCK
    named = doc_id if doc_id.lower() != item_id.lower() else "doc_id"
    out = None
    for b in range(blocks):
        some = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        wanted = [terms(r.text) for r in some]
        vocab = {t: i for i, t in enumerate(sorted({t for w in wanted for t in w}))}
        counts = cut(count_terms(docs, vocab), "term-counts")
        total = counts.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        held = counts.select(F.explode("term").alias("term")).groupBy("term").count().collect()
        df = {r.term: r["count"] for r in held}
        weights = [weight(total.docs, df.get(i, 0)) for i in range(len(vocab))]
        found = search_shards(counts, [[vocab[t] for t in w] for w in wanted], weights,
                              total.docs, total.terms or 1, k)
        names = spark.createDataFrame([(i, r.id) for i, r in enumerate(some)],
                                      T.StructType([T.StructField("no", T.IntegerType()), T.StructField("id", items.schema["id"].dataType)]))
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
        ranked = (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                  .join(F.broadcast(names), F.col("item") == F.col("no"))
                  .select(F.col("id").alias(item_id), "rank", F.col("doc").alias(named), "score"))
        out = ranked if out is None else out.unionByName(ranked)
    return out


def op12(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of the dealt query."""
    return search(docs, benchmark)


SQL = r"""
WITH docs AS (
  SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
      lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w
  FROM documents),
tf AS (SELECT doc_id, t, len(w) AS n, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS t FROM docs) GROUP BY ALL),
total AS (SELECT count(*)::BIGINT AS nd, sum(len(w))::BIGINT AS l FROM docs WHERE len(w) > 0),
weights AS (SELECT t, floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1)))::BIGINT AS wt FROM tf, total GROUP BY t),
asked AS (
  SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id, sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // l))))::BIGINT AS score
  FROM asked JOIN tf USING (t) JOIN weights USING (t), total GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
