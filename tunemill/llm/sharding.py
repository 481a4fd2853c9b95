"""Sharding by a permutation-filled lookup table (operator 3), DataFrame functions only.

Every shard orders the slots of a prime-sized table by its own permutation
(offset + i * skip, both from a hash of its name). The shards take turns, each
claiming the next slot of its order that is still free, until the table is
full: all get equal parts (within one slot), and adding or removing a shard
moves few slots beyond those that must move. The table's size is a parameter,
so it is broadcast whatever the data; a row finds its shard by one hash and one
lookup, without a shuffle.

Defined results: a null key column counts as a value of its own, so null keys
are placed too; equal keys share a shard; the empty table gives no rows. A key
that holds a large part of the rows fills its shard: name further columns in
``spread`` and its rows go over ``ways`` slots instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh

TABLE_SIZE = 65537  # prime


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(name: str, size: int) -> tuple[int, int]:
    """Offset and skip of a shard's permutation of the slots."""
    h = hashlib.md5(name.encode()).digest()
    return int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:], "big") % (size - 1) + 1


def fill(preferences: Sequence[tuple[int, int]], size: int) -> list[int]:
    """The shard number of each slot."""
    if not is_prime(size):
        raise ValueError(f"the table's size {size} is not a prime")
    if not 0 < len(preferences) <= size:
        raise ValueError(f"{len(preferences)} shards for {size} slots")
    table = [-1] * size
    at = [offset for offset, _ in preferences]
    free = size
    while True:
        for shard, (_, skip) in enumerate(preferences):
            slot = at[shard]
            while table[slot] >= 0:
                slot = (slot + skip) % size
            table[slot] = shard
            at[shard] = (slot + skip) % size
            free -= 1
            if not free:
                return table


def lookup(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """(``slot``, ``shard``, ``shard_name``), ``size`` rows."""
    if len(set(shards)) != len(shards):
        raise ValueError("shard names repeat")
    table = fill([preference(s, size) for s in shards], size)
    packed = F.split(F.lit(" ".join(map(str, table))), " ")  # once, in one row
    names = F.array(*[F.lit(s) for s in shards])
    return (spark.range(1, numPartitions=1).select(F.posexplode(packed).alias("slot", "shard"))
            .select(F.col("slot").cast("long").alias("slot"), F.col("shard").cast("int").alias("shard"))
            .withColumn("shard_name", F.get(names, F.col("shard"))))


def slot_of(keys: Sequence[Column], size: int = TABLE_SIZE) -> Column:
    """Slot of a key: 60 bits of its md5, modulo the size. Parts carry their length, so ("a", "bc") is not ("ab", "c")."""
    parts = []
    for k in keys:
        s = k.cast("string")
        parts += [F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("null"))]
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(size))


def place(df: DataFrame, keys: Sequence[str], shards: Sequence[str], spread: Sequence[str] = (),
          ways: int = 16, size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot``, ``shard`` and ``shard_name`` (named anew if taken)."""
    names = {c: fresh(df, c) for c in ("slot", "shard", "shard_name")}
    parts = [F.col(f"`{k}`") for k in keys]
    if spread:
        parts.append(slot_of([F.col(f"`{c}`") for c in spread], ways))
    found = lookup(df.sparkSession, shards, size).select(
        F.col("slot").alias(names["slot"]), F.col("shard").alias(names["shard"]),
        F.col("shard_name").alias(names["shard_name"]))
    placed = df.withColumn(names["slot"], slot_of(parts, size))
    return (placed.join(F.broadcast(found), names["slot"])
            .select(*[F.col(f"`{c}`") for c in df.columns], *names.values()))


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder per shard. A shard's rows go to ``files_per_shard`` tasks by
    their slot, so neither many small files nor one task per shard is forced."""
    (placed.repartition(F.col("shard"), F.pmod(F.col("slot"), F.lit(files_per_shard)))
     .write.mode("overwrite").partitionBy("shard").parquet(path))


def op3(docs: DataFrame, n_shards: int = 64) -> DataFrame:
    """Slot and shard of every document by its id."""
    out = place(docs.select("doc_id"), ["doc_id"], [f"shard-{i:03d}" for i in range(n_shards)])
    return out.select("doc_id", "slot", F.col("shard").cast("long").alias("shard"), "shard_name")
