"""What the operators on pairs of documents share: a filter of wanted keys, joins of pairs
with values of any size, and the classes of a relation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT, int_column, mix, pack, shuffle_partitions, unpack

#: Bits of a key filter at most (it is broadcast), and for each key; bytes that are merged together.
MAX_BITS, BITS_A_KEY, SEGMENT = 1 << 29, 16, 1 << 20


def _bits(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    h = mix(keys.astype(np.uint64))
    for shift in (0, 21, 42):
        yield (h >> np.uint64(shift) ^ h >> np.uint64(shift + 13)) & np.uint64(bits - 1)


def _set_bits(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    found = np.zeros(bits >> 3, np.uint8)
    for batch in batches:
        for x in _bits(int_column(batch, "key"), bits):
            np.bitwise_or.at(found, (x >> np.uint64(3)).astype(np.int64), (np.uint64(1) << (x & np.uint64(7))).astype(np.uint8))
    for s in range(0, len(found), SEGMENT):
        if found[s:s + SEGMENT].any():
            yield pa.RecordBatch.from_arrays([pa.array([s // SEGMENT], pa.int32()), pa.array([pack(found[s:s + SEGMENT])], pa.binary())], names=["segment", "value"])


def _merge_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merged: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = unpack(value)[0]
            merged[s] = merged[s] | part if s in merged else part
    for s, part in merged.items():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([pack(part)], pa.binary())], names=["segment", "value"])


def key_filter(keys: DataFrame) -> Broadcast:
    """A Bloom filter of the column ``key`` (long), broadcast: MAX_BITS / 8 bytes at most, whatever the number of keys.
    It only spares rows the way to a join that decides: beyond its capacity more rows pass."""
    bits = min(MAX_BITS, max(1 << 16, 1 << (keys.count() * BITS_A_KEY).bit_length()))
    segments = max(1, (bits >> 3) // SEGMENT)
    parts = (keys.select("key").mapInArrow(lambda it: _set_bits(it, bits), "segment int, value binary")
             .repartitionById(segments, F.col("segment")).mapInArrow(_merge_bits, "segment int, value binary"))
    found = np.zeros(bits >> 3, np.uint8)
    for r in parts.collect():
        part = unpack(r["value"])[0]
        found[r["segment"] * SEGMENT:r["segment"] * SEGMENT + len(part)] = part
    return keys.sparkSession.sparkContext.broadcast(pack(found))


def may_hold(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter (all that are, and few others)."""
    ok = np.ones(len(keys), bool)
    for x in _bits(keys, len(found) << 3):
        ok &= (found[(x >> np.uint64(3)).astype(np.int64)] >> (x & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return ok


def most_common(n: np.ndarray, bits: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """An upper bound, from bit counts, of what the sets x and y (rows of n and bits) have in common."""
    only_x = np.bitwise_count(bits[x] & ~bits[y]).sum(axis=1, dtype=np.int64)
    only_y = np.bitwise_count(bits[y] & ~bits[x]).sum(axis=1, dtype=np.int64)
    return np.minimum(n[x] - only_x, n[y] - only_y)


def join_values(pairs: DataFrame, values: DataFrame, key: str, spread: str, of: DataFrame | None = None) -> DataFrame:
    """``pairs`` with the columns of ``values`` (one row for each ``key``, of any size). The pairs of a hot
    key are dealt over as many tasks as a shuffle has, each of which gets the value once. of: a table with the keys of ``pairs``, where that is cheaper to read."""
    salts, of = shuffle_partitions(pairs.sparkSession), pairs if of is None else of
    counts = of.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where(F.col("__n") * HOT >= max(1, of.count())).select(key, F.lit(True).alias("__hot"))  # HOT rows at most
    left = pairs.join(F.broadcast(hot), key, "left").withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(-1).cast("long")))
    right = values.join(F.broadcast(hot), key, "left").withColumn("__salt", F.explode(
        F.when(F.col("__hot"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(-1).cast("long"))))).drop("__hot")
    return left.join(right, [key, "__salt"]).drop("__salt", "__hot")


def components(links: DataFrame) -> DataFrame:
    """The smallest node (comp) that each node of the links (a, b) reaches; links are read both ways. A node's label is pulled
    down by its neighbours' and by its label's own until nothing changes. The rows of a node with many neighbours, or under one label, are
    two numbers each and meet in inner joins, of which adaptive execution splits the hot partitions."""
    both = links.select("a", "b").union(links.select("b", "a")).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("comp")).checkpoint()
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("heard"))
        low = labels.join(heard, "node").select("node", F.col("comp").alias("was"), F.least("comp", "heard").alias("mid"))
        of_label = labels.select(F.col("node").alias("mid"), F.col("comp").alias("next"))
        new = low.join(of_label, "mid").select("node", "was", F.least("mid", "next").alias("comp")).checkpoint()
        labels = new.select("node", "comp")
        if not new.where(F.col("was") != F.col("comp")).limit(1).count():
            return labels
