"""Line dedup: drop lines that many documents share.

1. Each task sets the bits of its lines' hashes in two Bloom filters: once for
   lines seen in a document, twice for lines seen in two or more. The tasks'
   filters are merged in segments (twice = either's twice, or both's once), so
   a line that two documents share is in the merged second filter for certain.
2. Lines in the second filter are suspected repeats, and only these are
   shuffled: they are counted by the line itself, exactly.
3. The keys that go are brought to the documents that hold them. A key of a third
   of all documents is dealt over SALTS tasks.

The filter's size follows the number of rows up to MAX_BITS; it is what is
broadcast. Beyond its capacity more lines are suspected, with the same result.

A null or empty text is one empty line. A key is the line without
``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case; empty keys always stay.
Each row counts as a document, also where rows repeat a doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import _SPACE, lower_ascii, pack, runs, ship, text_view, unpack, word_hashes

WHITE = b" \t\n\x0b\x0c\r"
MAX_BITS = 1 << 29
#: Bits of a filter for each row of the input, for about 32 lines a row.
BITS_A_ROW = 512
SEGMENT = 1 << 20  # bytes of a filter that are merged together
SALTS = 32


def line_keys(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the key of each line that has one."""
    ends = np.unique(np.concatenate([np.flatnonzero(data == 10), off[1:][np.diff(off) > 0] - 1]))  # a line break, or a row's last byte
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    solid = np.flatnonzero(~_SPACE[data])
    i, j = np.searchsorted(solid, starts), np.searchsorted(solid, ends, "right")
    has = i < j
    start, end = solid[i[has]], solid[j[has] - 1] + 1
    return np.searchsorted(off, start, "right") - 1, start, end


def hashed_lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first line of each key in each row: row, start, end, hash; and the lower-case bytes."""
    low = lower_ascii(data)
    row, start, end = line_keys(data, off)
    h = word_hashes(low, start, end)
    o = np.lexsort((start, h, row))
    row, start, end, h = row[o], start[o], end[o], h[o]
    # other lines with this hash in the row go as well: equal hashes need not be equal keys
    return row, start, end, h, low


def bits_of(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    m = np.uint64(bits - 1)
    return (h & m).astype(np.int64), (h >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


def in_filter(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    a, b = bits_of(h, bits)
    return ((bitmap[a >> 3] >> (a & 7)) & (bitmap[b >> 3] >> (b & 7)) & 1).astype(bool)


def add_to_filter(bitmap: np.ndarray, h: np.ndarray, bits: int) -> None:
    for x in bits_of(h, bits):
        np.bitwise_or.at(bitmap, x >> 3, (1 << (x & 7)).astype(np.uint8))


def task_filters(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    once, twice = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)
    for batch in batches:
        for _, _, data, off in runs(batch):
            row, _, _, h, _ = hashed_lines(data, off)
            if not len(h):
                continue
            h = h[np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]]
            h, count = np.unique(h, return_counts=True)
            add_to_filter(twice, h[(count > 1) | in_filter(once, h, bits)], bits)
            add_to_filter(once, h, bits)
    for s in range(0, len(once), SEGMENT):
        a, b = once[s:s + SEGMENT], twice[s:s + SEGMENT]
        if a.any():
            yield pa.RecordBatch.from_arrays([pa.array([s // SEGMENT], pa.int32()), pa.array([pack(a, b)], pa.binary())], names=["segment", "value"])


def merge_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merged: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for s, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            once, twice = unpack(value)
            if s in merged:
                a, b = merged[s]
                merged[s] = a | once, b | twice | (a & once)
            else:
                merged[s] = once, twice
    for s, (_, twice) in merged.items():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([pack(twice)], pa.binary())], names=["segment", "value"])


def repeat_filter(docs: DataFrame) -> tuple[Broadcast, int]:
    """The merged second filter, broadcast, and its size in bits."""
    rows = docs.count()
    bits = min(MAX_BITS, max(1 << 16, 1 << (rows * BITS_A_ROW).bit_length()))
    segments = max(1, (bits >> 3) // SEGMENT)
    merged = (docs.select("text").mapInArrow(lambda it: task_filters(it, bits), "segment int, value binary")
              .repartitionById(segments, F.col("segment")).mapInArrow(merge_filters, "segment int, value binary"))
    bitmap = np.zeros(bits >> 3, np.uint8)
    for r in merged.collect():  # bits / 8 bytes at most
        part = unpack(r["value"])[0]
        bitmap[r["segment"] * SEGMENT:r["segment"] * SEGMENT + len(part)] = part
    return docs.sparkSession.sparkContext.broadcast(pack(bitmap)), bits


def suspected(batches: Iterator[pa.RecordBatch], shared: Broadcast, bits: int) -> Iterator[pa.RecordBatch]:
    """One row for each row's distinct suspected key."""
    bitmap = unpack(shared.value)[0]
    for batch in batches:
        for i, _, data, off in runs(batch):
            row, start, end, h, low = hashed_lines(data, off)
            s = np.flatnonzero(in_filter(bitmap, h, bits)) if len(h) else []
            whole = low.tobytes()
            keys = sorted({(int(row[x]), whole[start[x]:end[x]]) for x in s})
            for a in range(0, len(keys), 10_000):
                at = pa.array([r + i for r, _ in keys[a:a + 10_000]], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([k for _, k in keys[a:a + 10_000]], pa.binary())],
                                                 names=["doc_id", "tag", "key"])


def cut(batches: Iterator[pa.RecordBatch], names: list[str], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = text_view(batch.column(batch.schema.get_field_index("text")))
        whole = data.tobytes()
        dropped, count, kept = [], [], []
        for i, found in enumerate(batch.column(batch.schema.get_field_index("__keys")).to_pylist()):
            row = whole[off[i]:off[i + 1]]
            if found:
                first = {x["key"]: x["first"] for x in found}  # key, and whether its first line here stays
                lines, out = row.split(b"\n"), []
                for line in lines:
                    key = line.strip(WHITE).lower()
                    if first.get(key, True):
                        out.append(line)
                        if key in first:
                            first[key] = False
                kept.append(b"\n".join(out))
                count.append(len(lines))
                dropped.append(len(lines) - len(out))
            else:
                kept.append(row)
                count.append(row.count(b"\n") + 1)
                dropped.append(0)
        last = pa.array([hashlib.sha256(x).hexdigest() for x in kept]) if digest else pa.array([x.decode() for x in kept], pa.string())
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(x)) for x in names), pa.array(count, pa.int64()),
                                          pa.array(dropped, pa.int64()), last],
                                         names=[*names, "n_lines", "n_dropped", "kept_sha256" if digest else "kept_text"])


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, keep_first: bool = False, digest: bool = False) -> DataFrame:
    """``docs`` with n_lines, n_dropped and the kept text (``kept_text``, or with digest ``kept_sha256``).

    Lines whose key at least ``min_docs`` (2 or more) documents hold go; with
    ``keep_first``, the first such line of the smallest doc_id stays."""
    if min_docs < 2:
        raise ValueError("min_docs must be 2 at least")
    spark = docs.sparkSession
    ship(spark)
    ensure_checkpoint_dir(spark)
    docs = docs.drop("n_lines", "n_dropped", "kept_sha256" if digest else "kept_text")
    rows = docs.select(F.col("doc_id").cast("long"), F.hash("text").alias("tag"), F.col("text").cast("string").alias("text"))
    shared, bits = repeat_filter(rows)
    held = rows.mapInArrow(lambda it: suspected(it, shared, bits), "doc_id long, tag int, key binary").checkpoint()
    counted = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")).where(F.col("n") >= min_docs).drop("n")
    salt = F.pmod(F.xxhash64("doc_id", "tag"), F.lit(SALTS)).cast("int")
    dealt = counted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    gone = (held.withColumn("salt", salt).join(dealt, ["key", "salt"])
            .select("doc_id", "tag", "key", (F.col("doc_id").eqNullSafe(F.col("least")) if keep_first else F.lit(False)).alias("first")))
    by_doc = gone.groupBy(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag")).agg(F.collect_set(F.struct("key", "first")).alias("__keys"))
    joined = docs.join(by_doc, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.hash("text") == F.col("__tag")), "left").drop("__id", "__tag")
    names = [c for c in docs.columns if not (digest and c == "text")]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", n_lines long, n_dropped long, " + ("kept_sha256 string" if digest else "kept_text string")
    return joined.mapInArrow(lambda it: cut(it, names, digest), schema)
