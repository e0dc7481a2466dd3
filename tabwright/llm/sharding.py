"""Shard placement by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int = 4099) -> list[int]:
    """Index into ``shards`` for each of ``slots`` slots.

    Every shard walks the slots in its own order (offset and stride from its name; ``slots`` is prime, so each walk
    is a permutation); the shards take turns, each claiming the next free slot of its walk. Sizes differ by one at most,
    and adding or removing a shard moves few slots. The turn order is that of the names, so it does not matter how they are listed.
    """
    if not is_prime(slots):
        raise ValueError("the number of slots must be prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shard names must be distinct, at least one and no more than slots")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    walk = {i: (_number(f"{shards[i]}/offset") % slots, _number(f"{shards[i]}/stride") % (slots - 1) + 1) for i in turns}
    at = dict.fromkeys(turns, 0)
    table, left = [-1] * slots, slots
    while True:
        for i in turns:
            offset, stride = walk[i]
            while table[slot := (offset + at[i] * stride) % slots] >= 0:
                at[i] += 1
            table[slot] = i
            left -= 1
            if not left:
                return table


def slot_of(key: Column, slots: int) -> Column:
    """The key's slot: 60 bits of the MD5 of its text, modulo ``slots``; a null key hashes as empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long") % slots


def place(df: DataFrame, key: str, shards: list[str], slots: int = 4099, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and the shard of each row.

    The table is ``slots`` names, whatever the data, and is broadcast; placing a row is one hash and one hash lookup,
    without a shuffle of the rows. Equal keys share a shard; null keys share the shard of the empty text. Columns of ``df``
    with the names of the new ones are replaced. An empty table stays empty.
    """
    table = lookup_table(shards, slots)
    slot, shard = free_name(df, "slot_"), free_name(df, "shard_")
    lookup = df.sparkSession.createDataFrame([(s, shards[i]) for s, i in enumerate(table)], f"{slot} long, {shard} string")
    kept = [f"`{c}`" for c in df.columns if c.lower() not in (slot_col.lower(), shard_col.lower())]
    placed = df.select(*kept, slot_of(df[key], slots).alias(slot)).join(F.broadcast(lookup), slot)
    return placed.select(*kept, F.col(slot).alias(slot_col), F.col(shard).alias(shard_col))


def write_shards(placed: DataFrame, path: str, files: int = 8, shard_col: str = "shard") -> None:
    """One folder a shard, each written by ``files`` tasks, so that a large shard is not one task's work."""
    placed.repartition(F.col(shard_col), F.pmod(F.xxhash64(*placed.columns), F.lit(files))).write.partitionBy(shard_col).parquet(path)
