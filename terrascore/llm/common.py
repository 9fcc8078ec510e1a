"""What the operators of this package share: shipping the package to the
workers, views on Arrow text columns, polynomial hashes and packed arrays."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one in-memory run holds (one longer document makes a longer run).
RUN_BYTES = 8 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_SHIPPED: set[str] = set()
#: What a worker remembers between the tasks of one operator, dropped by ``release``.
REMEMBERED: list[dict] = []


def ship(spark: SparkSession) -> None:
    """Make this package importable on the workers, wherever the driver was started.

    The library's sources are zipped once per application and handed to
    ``addPyFile``, which serves them to every executor, later ones too."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="terrascore-src-"), "terrascore_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(full := os.path.join(folder, name), os.path.join("terrascore", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_view(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its row offsets; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"" if pa.types.is_binary(column.type) else "", column.type))
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    off = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(off), np.int64)
    return np.frombuffer(data, np.uint8, off[-1] - off[0], off[0]), off - off[0]


def runs(batch: pa.RecordBatch, text: str = "text", limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a batch at row boundaries into runs of about ``limit`` bytes: (first row, end row, bytes, offsets)."""
    data, off = text_view(batch.column(batch.schema.get_field_index(text)))
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def trim() -> None:
    """Give freed memory back, as workers live on and share their executor's limit with the next stage."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if give:
        give(0)


def release() -> None:
    """Give memory back at the end of a task. What the tasks of another operator left in the worker goes too: it is made anew when needed."""
    for kept in REMEMBERED:
        kept.clear()
    trim()


def releasing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task that gives its memory back after the last."""
    yield from batches
    release()


def int_column(batch: pa.RecordBatch, name: str, null: int = -(1 << 63)) -> np.ndarray:
    """An integer column as int64; null becomes ``null``."""
    col = batch.column(batch.schema.get_field_index(name))
    return np.asarray(pc.fill_null(col.cast(pa.int64()), null).to_numpy(zero_copy_only=False), dtype=np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random-looking 64-bit value for each byte.
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS: dict[str, np.ndarray] = {}
REMEMBERED.append(_POWERS)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's and its inverse's powers 0..n-1 modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(10, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] a hash of bytes i..j-1, times base**i (modulo 2**64)."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_HASH[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes, independent of where it stands."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all rows: start, end, and the number of words before each row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)  # where a row starts, a word may start and the one before ends
    edge[off] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """64-bit hash of each word, computed in pieces so that tables stay in the cache."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + piece, "right")))
        a = start[i]
        out[i:j] = span_hash(prefix_hash(data[a:end[j - 1]]), start[i:j] - a, end[i:j] - a)
        i = j
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; integers wider than a byte are stored as planes of bytes."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        raw = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() if a.dtype.itemsize > 1 and a.ndim == 1 else a.tobytes()
        z = _ZIP.compress(raw)
        parts.append(f"{a.dtype.str};{','.join(map(str, a.shape))};{len(z)}\n".encode() + z)
    return b"".join(parts)


def unpack(value: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(value):
        end = value.index(b"\n", at)
        kind, shape, size = value[at:end].decode().split(";")
        raw = _UNZIP.decompress(value[end + 1:end + 1 + int(size)])
        dims, dtype = tuple(map(int, shape.split(","))), np.dtype(kind)
        if dtype.itemsize > 1 and len(dims) == 1:
            out.append(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, -1).T.copy().view(dtype).reshape(dims))
        else:
            out.append(np.frombuffer(raw, dtype).reshape(dims))
        at = end + 1 + int(size)
    return out


def binary_batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


#: A key that holds at least this part of the rows is joined by broadcast: there are no more than so many.
HOT = 1000


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], size: str, total: int, spread: str) -> DataFrame:
    """Inner join with a table of one row for each key, whose column ``size`` says how many of the ``total``
    rows on the left have it. The rows of hot keys meet it by broadcast; in the shuffle of the others they are dealt evenly, by a hash of the column
    ``spread``: each side has the hash it is dealt by as a join key more, computed from its rows, so that no side's is folded away."""
    others = [c for c in right.columns if c not in keys]
    value = F.struct(*others)
    hot = right.where(F.col(size) * HOT >= total).select(*keys, value.alias("__hot"))
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("__deal", F.when(F.col("__hot").isNull(), F.xxhash64(*keys)).otherwise(F.xxhash64(spread)))
    cold = right.select(*keys, value.alias("__cold"), F.xxhash64(*keys).alias("__deal"))
    both = dealt.join(cold, [*keys, "__deal"], "left").withColumn("__value", F.coalesce("__hot", "__cold")).where(F.col("__value").isNotNull())
    return both.select(*left.columns, *[F.col(f"__value.{c}").alias(c) for c in others])
