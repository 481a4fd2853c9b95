"""Line deduplication (operator 7), DataFrame functions only.

Lines are exploded, normalised and hashed; the distinct documents per hash are
counted; lines over the threshold go, except in the largest document id that
holds them; what is left is put together again by position.

What travels: the first pass shuffles (hash, document id) pairs, once per
document and distinct line, and sums them with partial aggregation, so a line
that a third of all documents hold is a counter and never a group of rows. The
frequent hashes are written as a table and joined to line *positions* (no
text); Spark splits that join where a line is hot. Only the positions to drop
go back to the documents, one array per document.

Defined results
* null or empty text: one empty line, nothing dropped, kept text "" (null stays null
  in the text column, its digest is that of "").
* repeated rows (same id, same text) count as one document; each row is returned.
* rows whose id is null support no line; a line frequent elsewhere is dropped
  from them, as they never hold the largest id.
* rows with the same id and other texts are one document that holds all lines.
* other columns, whatever their names, are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, cut, fresh

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """A line stripped of white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, UPPER.lower())


def _hash(key: Column) -> Column:
    return F.unhex(F.md5(key))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the frequent lines removed from ``text_col``, plus ``n_lines``
    and ``n_dropped`` (named anew if taken, see ``fresh``)."""
    n_lines, n_dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    light = docs.select(F.col(id_col).alias("d"),
                        F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("t"),
                        lines.alias("lines"))
    keyed = light.select(
        "d", "t",
        F.transform("lines", line_key).alias("keys")).select(
        "d", "t",
        F.filter(F.transform("keys", lambda k, i: F.struct(
            i.alias("pos"), F.when(F.char_length(k) >= min_chars, _hash(k)).alias("h"))),
            lambda x: x["h"].isNotNull()).alias("ls"))

    holders = (keyed.where(F.col("d").isNotNull())
               .select("d", F.explode(F.array_distinct("ls.h")).alias("h")).distinct())
    frequent = cut(holders.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("last"))
                   .where(F.col("n") >= min_docs).select(F.col("h").alias("fh"), "last"), "lines")

    at = keyed.select("d", "t", F.inline("ls"))
    gone = (at.join(frequent, F.col("h") == F.col("fh"), "inner")
            .where(~F.col("d").eqNullSafe(F.col("last")))
            .groupBy(F.col("d").alias("gd"), F.col("t").alias("gt"))
            .agg(F.collect_set("pos").alias("gone")))

    d, t, g = fresh(docs, "_d"), fresh(docs, "_t"), fresh(docs, "_gone")
    gone = gone.select(F.col("gd").alias(d), F.col("gt").alias(t), F.col("gone").alias(g))
    own = F.unhex(F.md5(F.coalesce(docs[text_col], F.lit(""))))
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone[d]) & (own == gone[t]), "left")
    left = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(g)),
        lambda i: F.get(lines, i))
    kept = F.when(F.col(g).isNull(), F.col(text_col)).otherwise(F.concat_ws("\n", left))
    return joined.select(
        *[(kept if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns],
        F.size(lines).cast("long").alias(n_lines),
        F.when(F.col(g).isNull(), 0).otherwise(F.size(g)).cast("long").alias(n_dropped))


def op7(spark, sf_dir: str, docs: DataFrame) -> DataFrame:
    """The digest row per document of the dealt query."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, text, line, pos,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''),
                                  '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
often AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, line, pos, coalesce(o.last <> doc_id, false) AS gone
  FROM keyed LEFT JOIN often o USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
