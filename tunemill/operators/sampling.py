"""Seeded order, exact-percentage subsets, mixing.

The order of a seeded shuffle is ``md5('<seed>:<key>')`` with the key as tie
break. A global position along that order is computed without a single-task
window: the first ``p`` hex digits of the md5 are an order-preserving range
bucket. Rows are counted per bucket (partial aggregation), the at most
``16**p`` counts per group are prefix-summed and broadcast (size bound:
16**p rows per group), and rows are numbered inside their bucket only. Each
bucket holds about n / 16**p rows whatever the skew of the key values, since
md5 spreads distinct keys evenly. With grouping columns the bound is
16**p rows per group; the broadcast is then left to the runtime size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


FEW = 4096  # order texts fetched of the digit group that holds a cut
MAX_GROUPS = 200  # groups whose cuts become one filter

NULL_PART = "\x00null"  # a null key is a key of its own, unlike any text


def seeded_key(seed, *parts) -> Column:
    """md5 of ``'<seed>:<part1>[:<part2>...]'``."""
    items = [F.lit(str(seed))]
    for p in parts:
        c = (F.col(p) if isinstance(p, str) else p).cast("string")
        items += [F.lit(":"), F.coalesce(c, F.lit(NULL_PART))]
    return F.md5(F.concat(*items))


def global_index(df: DataFrame, order_key: Column, tie, group=(), prefix_hex: int = 4,
                 out: str = "idx") -> DataFrame:
    """0-based position of each row along ``(order_key, tie)`` within ``group``; ``tie`` is a column or several.

    ``order_key`` must be a lowercase hex md5 string. Also adds ``group_n``
    (rows in the group), useful for exact subsets.
    """
    group = list(group)
    d = df.withColumn("_ok", order_key).withColumn("_bk", F.substring("_ok", 1, prefix_hex))
    # Counting pass: reads only the key columns (pruned) and pre-aggregates
    # map-side, so its shuffle carries at most 16**p rows per task.
    counts = d.groupBy(*group, "_bk").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy(*group).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = counts.select(*[F.col(g).alias(f"_o_{g}") for g in group], F.col("_bk").alias("_o_bk"),
                            F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"),
                            F.sum("_bn").over(whole).alias("group_n"))
    # Without groups the offsets have at most 16**prefix_hex rows: a proven
    # bound, so they are broadcast. With groups the count of groups comes from
    # the data, so the choice is left to Spark's runtime size check (AQE).
    # Null groups match themselves: no row is lost.
    on = [F.col(g).eqNullSafe(F.col(f"_o_{g}")) for g in group] + [F.col("_bk") == F.col("_o_bk")]
    j = (d.join(offsets if group else F.broadcast(offsets), on, "inner")
         .drop(*[f"_o_{g}" for g in group], "_o_bk"))
    inb = Window.partitionBy(*group, "_bk").orderBy("_ok", *([tie] if isinstance(tie, str) else tie))
    return (j.withColumn(out, F.col("_off") + F.row_number().over(inb) - 1)
            .drop("_ok", "_bk", "_off"))


def keep_count(n: Column, pct: float) -> Column:
    """``int(n * pct / 100)``, or n itself when pct >= 100."""
    if pct >= 100.0:
        return n
    return F.floor(n * F.lit(float(pct)) / F.lit(100.0)).cast("long")


def subset_pct(df: DataFrame, pct: float, seed: int, key: str = "example_id",
               group=("source",), prefix_hex: int = 4) -> DataFrame:
    """W1 + W3: exactly ``int(n*pct/100)`` rows of each group, chosen by the
    seeded order (the first rows of the seeded shuffle), with ``idx`` (position in
    the seeded order) and ``group_n``. pct >= 100 returns ``df`` as it is."""
    group = list(group)
    k = seeded_key(seed, key)
    if pct >= 100.0:  # everything: no index is needed
        return df
    ix = global_index(df, k, key, group, prefix_hex)
    return ix.where(F.col("idx") < keep_count(F.col("group_n"), pct))


def _hex_order(seed, key: str, tie=()) -> Column:
    """The seeded order as one hex text: the md5 of the key, then of the ``tie`` columns (null kept apart)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_PART)) for c in tie]
    after = [F.md5(F.concat_ws("\x1f", *parts))] if parts else []
    return F.concat(seeded_key(seed, key), *after)


def subset_exact(df: DataFrame, pct: float, seed: int, key: str = "example_id", group=("source",),
                 digits: int = 4, tie=(), few: int = FEW, max_groups: int = MAX_GROUPS) -> DataFrame:
    """W1 + W3 without numbering rows: the rows of ``subset_pct``, by one filter.

    The last row of a group's share is found by radix selection. Rows are counted by the
    next ``digits`` hex digits of the seeded order (partial aggregation); only the digit group that
    holds the cut is looked at further, until it has at most ``few`` rows, whose order
    texts are fetched. What passes through the driver is one row per group and level and
    those few. ``tie`` names columns that part rows with one key (without it such rows are alike). Where the cut falls
    among rows that are alike in all of these, or beyond ``max_groups`` groups, rows are
    numbered as in ``subset_pct``. Null groups and null keys count like others.
    """
    if pct >= 100.0:
        return df
    group = list(group)
    order = fresh_name(df, "_order")
    keyed = df.select(*group, _hex_order(seed, key, tie).alias(order))
    cuts = _cuts(keyed, order, pct, group, digits, few, max_groups)
    if cuts is None:
        number = fresh_name(df, "_idx")
        total = fresh_name(df, "group_n")
        ix = global_index(df, seeded_key(seed, key), [key, *tie], group, digits, out=number)
        return ix.where(F.col(number) < keep_count(F.col(total), pct)).select(*df.columns)
    keep = F.lit(False)
    for values, cut in cuts:
        here = F.lit(True)
        for g, v in zip(group, values):
            here = here & F.col(g).eqNullSafe(F.lit(v))
        keep = keep | (here & (_hex_order(seed, key, tie) < cut))
    return df.where(keep)


def fresh_name(df: DataFrame, stem: str) -> str:
    taken = {c.lower() for c in df.columns}
    return stem if stem.lower() not in taken else fresh_name(df, stem + "_")


def _cuts(keyed: DataFrame, order: str, pct: float, group: list[str], digits: int, few: int, max_groups: int):
    """[(group values, first order text that is not kept)], or None if the cut cannot be told by the
    order alone or there are too many groups."""
    same = lambda values: [F.col(g).eqNullSafe(F.lit(v)) for g, v in zip(group, values)]
    done, open_ = [], None
    depth = 0
    while open_ is None or open_:
        rows = keyed
        if open_ is not None:  # only what begins like a group's cut
            near = F.lit(False)
            for values, (prefix, _) in open_.items():
                here = F.substring(order, 1, depth) == prefix
                for c in same(values):
                    here = here & c
                near = near | here
            rows = keyed.where(near)
        depth += digits
        counts = rows.groupBy(*group, F.substring(order, 1, depth).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
        by = Window.partitionBy(*group)
        upto = counts.select(*group, "_p", "_n", F.sum("_n").over(by.orderBy("_p")).alias("_upto"),
                             F.sum("_n").over(by).alias("_all"))
        wanted = keep_count(F.col("_all"), pct) if open_ is None else F.lit(None).cast("long")
        if open_ is not None:
            for values, (_, left) in open_.items():
                here = F.lit(True)
                for c in same(values):
                    here = here & c
                wanted = F.when(here, F.lit(left).cast("long")).otherwise(wanted)
        at = (upto.withColumn("_k", wanted).where((F.col("_upto") > F.col("_k")) & (F.col("_upto") - F.col("_n") <= F.col("_k")))
              .limit(max_groups + 1).collect())
        if len(at) > max_groups:
            return None
        small, again = {}, {}
        for r in at:
            values, left = tuple(r[g] for g in group), r["_k"] - (r["_upto"] - r["_n"])
            if r["_n"] <= few:
                small[values] = (r["_p"], left)
            elif len(r["_p"]) < depth:  # the texts end: all these rows are alike
                return None
            else:
                again[values] = (r["_p"], left)
        for values, (prefix, left) in small.items():
            here = F.substring(order, 1, depth) == prefix
            for c in same(values):
                here = here & c
            texts = sorted(r[0] for r in keyed.where(here).select(order).collect())
            if left and texts[left - 1] == texts[left]:
                return None
            done.append((values, texts[left]))
        open_ = again
    return done


def shuffle_index(df: DataFrame, seed: int, key: str = "example_id",
                  source: str = "source", prefix_hex: int = 4, out: str = "pos",
                  group=(), tie=()) -> DataFrame:
    """Position of every row in a seeded global shuffle of the mix; rows with one key go by ``tie``."""
    k = seeded_key(seed, source, key)
    return global_index(df, k, [key, *tie], group, prefix_hex, out=out).drop("group_n")


def mix_strict(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; all inputs must have the same columns."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def mix_lenient(*dfs: DataFrame) -> DataFrame:
    """UNION ALL allowing missing columns; a missing ``input`` becomes ''
    (P10). Source order is kept through ``source_rank``."""
    out = None
    for i, d in enumerate(dfs):
        d = d.withColumn("source_rank", F.lit(i))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    given = F.col("input") if "input" in out.columns else F.lit(None).cast("string")
    return out.withColumn("input", F.coalesce(given, F.lit("")))
