"""Sharding by a permutation-filled lookup table.

Each shard has an order of preference over the slots of a prime-sized table: an
offset and a step, both from a hash of its name. The shards take turns; on its
turn a shard claims its next preferred slot that is still free, until none is.
A key's hash modulo the table's size is its slot, and the slot's owner its
shard: one lookup, shares that differ by at most one slot, and few moves when a
shard comes or goes.

The table has ``table_size`` rows (at most MAX_TABLE) whatever the data, so it
is broadcast; the data are neither shuffled nor sent to Python. A null key is
placed as the empty string is. The result's own columns replace those of the
same name in the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_TABLE = 1 << 20


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], table_size: int) -> list[int]:
    """Owner (index in ``shards``) of each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not is_prime(table_size) or not len(shards) <= table_size <= MAX_TABLE:
        raise ValueError(f"table_size must be a prime from the number of shards to {MAX_TABLE}")
    at = [_number(f"{s}#offset") % table_size for s in shards]
    step = [_number(f"{s}#step") % (table_size - 1) + 1 if table_size > 2 else 1 for s in shards]
    table, free = [-1] * table_size, table_size
    while free:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % table_size
            table[at[i]] = i
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, table_size: int) -> Column:
    """The slot of a key: the first 60 bits of its md5 modulo the table's size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(table_size).cast("long"))


def table_frame(spark: SparkSession, shards: Sequence[str], table_size: int) -> DataFrame:
    """The lookup table as a frame: slot, shard, shard_name."""
    owners = F.split(F.lit(",".join(map(str, lookup_table(shards, table_size)))), ",")
    names = F.array(*map(F.lit, shards))
    return (spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
            .select(F.col("slot").cast("long"), F.col("owner").cast("int").alias("shard"),
                    F.get(names, F.col("owner").cast("int")).alias("shard_name")))


def place(rows: DataFrame, key: str, shards: Sequence[str], table_size: int = 65537) -> DataFrame:
    """``rows`` with slot, shard and shard_name of each row's key."""
    table = table_frame(rows.sparkSession, shards, table_size)
    slot = slot_of(F.col(key), table_size)
    kept = [c for c in rows.columns if c not in ("slot", "shard", "shard_name")]
    keyed = rows.select(*[F.col(f"`{c}`") for c in kept], slot.alias("slot"))
    return keyed.join(F.broadcast(table), "slot", "left").select(*[F.col(f"`{c}`") for c in kept], "slot", "shard", "shard_name")
