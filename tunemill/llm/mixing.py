"""Mixing sources to target weights (operator 2), DataFrame functions only.

The mix is a sequence of slots of equally many words. Slot i carries the
golden-ratio point frac(i * phi), which falls into one source's interval of the
cumulative targets: a low-discrepancy schedule, every stretch of which is close
to the targets. A source's slots are ranked, its documents are shuffled by a
hash and laid end to end (again for each further pass), that line is cut into
blocks of the slots' length, and slot rank r takes block r.

No window spans a source: offsets and ranks are running totals over ranges of
the hash (or of slot numbers), so a source with a third of all rows is spread
over all ranges. Slots and intervals meet in an equi-join on a grid cell. Blocks have
the same length at any size of input. A source gives as many words as its target
(rounded up), whatever its share of the slots: the schedule can leave it a few
blocks short, or without a slot if it is tiny, and what is missing follows in
slots of its own after the schedule; slots left over stay empty. A table written
once fixes row ids, so recomputed tasks agree.

Defined results: null text has size 0; a null source is a source of its own,
last in order; documents of size 0 are returned with taken 0; repeated rows are
documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, running_total, words

# FIXED VALUES: weights by position of the source, and how often a document may be taken.
WEIGHTS = (5, 2, 1)
MAX_PASSES = 3

# Two Fibonacci numbers; their quotient is the golden ratio's fractional part. In whole
# numbers, points keep their places however many slots there are.
FIB, FIB_BEFORE = 2971215073, 1836311903
GRID = 1024


def source_targets(base: DataFrame, weights: Sequence[float] = WEIGHTS,
                   passes: int = MAX_PASSES) -> DataFrame:
    """Per source: ``source_size``, ``weight``, ``target``, and its interval ``lo``..``hi`` of [0, 1).

    The shares ``level * weight`` stop at ``passes`` times a source's size; the
    level is where all targets together reach the total. Sources are few rows.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = (base.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("place", F.row_number().over(by_name))
         .withColumn("weight", F.get(cycle, F.pmod(F.col("place") - 1, F.lit(len(weights)))))
         .withColumn("total", F.sum("source_size").over(everything))
         .withColumn("most", (F.col("source_size") * passes).cast("double"))
         .withColumn("ratio", F.col("most") / F.col("weight")))
    by_ratio = Window.orderBy("ratio", "place")
    stopped = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    still = F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("level", (F.col("total") - stopped) / still)
    s = s.withColumn("level", F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), True)
                     .over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    s = s.withColumn("target", F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most")))
    up_to = F.sum("target").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    s = s.withColumn("hi", F.when(F.col("total") > 0, up_to / F.col("total")).otherwise(0.0))
    last = F.lead("place").over(Window.orderBy("place")).isNull()
    return s.select("source", "source_size", "weight", "target",
                    F.coalesce(F.lag("hi").over(Window.orderBy("place")), F.lit(0.0)).alias("lo"),
                    F.when(last & (F.col("total") > 0), 1.0).otherwise(F.col("hi")).alias("hi"))


def wanted(passes: int = MAX_PASSES) -> Column:
    """The words that a source gives: its target, rounded up."""
    return F.least(F.ceil("target"), F.col("source_size") * passes)


def points(targets: DataFrame, n_slots: int) -> DataFrame:
    """(``source``, ``slot``): the source into whose interval each slot's point falls."""
    spark = targets.sparkSession
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), _point(F.col("id")).alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") * GRID))
    cells = targets.where(F.col("hi") > F.col("lo")).select(
        F.col("source"), "lo", "hi",
        F.explode(F.sequence(F.floor(F.col("lo") * GRID),
                             F.least(F.floor(F.col("hi") * GRID), F.lit(GRID - 1)))).alias("cell"))
    placed = slots.join(cells, "cell").where((F.col("lo") <= F.col("u")) & (F.col("u") < F.col("hi")))
    return placed.select("source", "slot")


def _point(i: Column) -> Column:
    return (F.pmod(F.pmod(i, F.lit(FIB)) * FIB_BEFORE + FIB_BEFORE // 2, F.lit(FIB)) + F.lit(0.5)) / FIB


def schedule(targets: DataFrame, n_slots: int, block: int, passes: int = MAX_PASSES) -> DataFrame:
    """(``source``, ``rank``, ``slot``): the source of each slot and its rank there, from
    0; after the ``n_slots`` scheduled ones, a slot for each block still missing."""
    placed = points(targets, n_slots)
    ranked = running_total(placed.withColumn("stretch", F.floor(F.col("slot") / 8192)),
                           ["source"], "stretch", ["slot"], F.lit(1), "rank")
    have = placed.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("have"))
    short = targets.join(have, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", F.coalesce("have", F.lit(0)).alias("have"), F.ceil(wanted(passes) / block).alias("blocks"))
    # the schedule is even to within a few slots a source, so these are few rows
    short = short.where(F.col("have") < F.col("blocks")).select(
        "source", F.explode(F.sequence("have", F.col("blocks") - 1)).alias("rank"))
    after = Window.orderBy("rank", F.col("source").asc_nulls_last())
    return ranked.select("source", "rank", "slot").unionByName(
        short.withColumn("slot", F.row_number().over(after) + F.lit(n_slots - 1).cast("long")))


def block_pieces(base: DataFrame, targets: DataFrame, block: int, passes: int = MAX_PASSES) -> DataFrame:
    """Where each document lies in its source's blocks: one row per document, pass
    and block (``rank``), with the block's words that it gives (``n``) and the
    word of the document at which they begin (``first``)."""
    t = targets.select(F.col("source").alias("_source"), "source_size", wanted(passes).alias("want"))
    line = base.where(F.col("size") > 0).join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    needed = F.ceil(F.col("want") / F.col("source_size"))
    line = line.withColumn("pass", F.explode(F.sequence(F.lit(0), needed.cast("int") - 1)))
    line = line.withColumn("a", F.col("pass") * F.col("source_size") + F.col("at")).where(F.col("a") < F.col("want"))
    line = line.withColumn("b", F.least(F.col("a") + F.col("size"), "want"))
    line = line.withColumn("rank", F.explode(F.sequence(
        F.floor(F.col("a") / block), F.floor((F.col("b") - 1) / block))))
    begin = F.greatest("a", F.col("rank") * block)
    return line.select("source", "rank", "rid", "pass", (begin - F.col("a")).alias("first"),
                       (F.least("b", (F.col("rank") + 1) * block) - begin).alias("n"))


def lay_out(docs: DataFrame, carry: Sequence[str], text_col: str = "text", source_col: str = "source",
            seed: int = 42) -> DataFrame:
    """A written table of the documents: ``row`` (the carried columns), ``source``,
    ``size``, a fixed row id and the shuffling hash."""
    return cut(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(source_col).cast("string").alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("rid"),
        F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns]).alias("h")), "mix-rows")


def mix(rows: DataFrame, weights: Sequence[float] = WEIGHTS, passes: int = MAX_PASSES,
        block: int = 16) -> tuple[DataFrame, DataFrame]:
    """From ``lay_out``: (per document ``row``, ``size``, ``source_size``, ``target``, ``taken``, ``first_slot`` and
    ``n_slots`` of the schedule that hold its words, and ``starts``, the slot at which each pass over it begins;
    the mix itself: ``slot``, ``rid``, ``pass``, ``first``, ``n`` words, in slot order)."""
    small = rows.select("rid", "source", "size", "h")
    targets = cut(source_targets(small, weights, passes), "mix-targets")
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    n_slots = ceil((total or 0) / block)
    bits = min(24, max(10, (count // 4096).bit_length()))
    ranged = small.withColumn("range", F.shiftrightunsigned("h", 64 - bits))
    placed = running_total(ranged, ["source"], "range", ["h", "rid"], F.col("size"), "at")
    slots = schedule(targets, n_slots, block, passes).select(F.col("source").alias("_source"), F.col("rank").alias("_rank"), "slot")
    pieces = block_pieces(placed, targets, block, passes)
    mixed = pieces.join(slots, F.col("source").eqNullSafe(F.col("_source"))
                        & (F.col("rank") == F.col("_rank"))).select("slot", "rid", "pass", "first", "n")
    starts = [F.min(F.when(F.col("pass") == i, F.col("slot"))) for i in range(passes)]
    taken = mixed.groupBy("rid").agg(F.sum("n").alias("taken"), F.min("slot").alias("first_slot"),
                                     F.count(F.lit(1)).alias("n_slots"), F.array(*starts).alias("starts"))
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    per_doc = (rows.join(taken, "rid", "left")
               .join(t, F.col("source").eqNullSafe(F.col("_source")))
               .select("row", "size", "source_size", "target",
                       F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot",
                       F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"), "starts"))
    return per_doc, mixed


def mix_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them, whole documents: one row for each time that
    the words taken fill the document, rounded to the nearest. Each partition, and so each file written from
    it, has its rows in the order of the schedule's slots: the sources are interleaved as their
    targets ask in every stretch."""
    per_doc, _ = mix(lay_out(docs, docs.columns))
    times = F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1)) + F.lit(0.5)).cast("int")
    repeated = per_doc.withColumn("times", times).where(F.col("times") > 0)
    slot = F.coalesce(F.get("starts", F.col("i")), "first_slot")
    return (repeated.select("row", "starts", "first_slot", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("i"))
            .select("row", slot.alias("slot")).sortWithinPartitions("slot").select("row.*"))


def op2(docs: DataFrame) -> DataFrame:
    """One row per document of the dealt query, with its place in the schedule."""
    per_doc, _ = mix(lay_out(docs.select("doc_id", "source", "text"), ["doc_id"]))
    return per_doc.select("row.doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")
