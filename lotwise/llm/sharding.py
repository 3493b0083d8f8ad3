"""Sharding by a permutation-filled lookup table: constant-time placement that moves few keys when shards come or go."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the largest table that is built and broadcast (16 bytes a slot).
MAX_SLOTS = 1_000_003


def text_hash(text: str | Column) -> int | Column:
    """The first 60 bits of the MD5 of a text, for a Python string or a column."""
    if isinstance(text, str):
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def fill(shards: Sequence[str], slots: int) -> list[int]:
    """Shard of each slot. A shard's preference order is offset, offset + skip, offset + 2 * skip, ... modulo the prime
    `slots`; shards take turns and each claims the first slot of its order that is still free."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if not len(shards) <= slots <= MAX_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from the number of shards to {MAX_SLOTS}")
    place = [text_hash(f"{s}:offset") % slots for s in shards]
    skip = [text_hash(f"{s}:skip") % (slots - 1) + 1 for s in shards]
    table, left = [-1] * slots, slots
    while left:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % slots
            table[place[i]] = i
            left -= 1
            if not left:
                break
    return table


def slot_table(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    """(slot, shard, shard_name); its size depends on `slots` alone, never on the data."""
    table = F.split(F.lit(",".join(map(str, fill(shards, slots)))), ",").cast("array<int>")
    names = F.split(F.lit("\n".join(shards)), "\n")
    return spark.range(1).select(F.posexplode(table).alias("slot", "shard")).select(F.col("slot").cast("long"), "shard", F.get(names, F.col("shard")).alias("shard_name"))


def assign_shards(df: DataFrame, key_cols: Sequence[str], shards: Sequence[str], *, slots: int = 65_537, spread: int = 1, spread_by: Sequence[str] = ()) -> DataFrame:
    """All of `df` with slot, shard and shard_name, by a broadcast join with the slot table and no shuffle of `df`.

    Rows of equal keys go to one shard. `spread` > 1 first splits each key into that many sub-keys by the hash of the
    columns `spread_by`, so a key that holds a third of all rows does not fill one shard. Null keys are a key of their
    own; an empty table gives an empty table. Columns of `df` that already bear one of the new names are replaced."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in key_cols]
    if spread > 1:
        rest = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spread_by])
        parts.append((text_hash(rest) % spread).cast("string"))
    placed = df.drop("slot", "shard", "shard_name").withColumn("slot", text_hash(F.concat_ws("\x1f", *parts)) % slots)
    return placed.join(F.broadcast(slot_table(df.sparkSession, shards, slots)), "slot")
