"""Language-model scores: stupid backoff over n-gram counts of the whole corpus.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case; n-grams don't cross documents. A
word's score after its context is count(context word) / count(context) when the
n-gram stands ``min_count`` times or more in the corpus; else BACKOFF times its score after
the context without its first word, down to count(word) / words. A document's score is
the sum of the logarithms.

1. Documents are dealt into buckets of about RUN_BYTES by a hash. Each bucket explodes its
   n-grams (64-bit hashes) and sends each distinct one once, with its count there,
   to the partition its hash names: a frequent n-gram costs a partition one
   entry a bucket, so there are no hot partitions.
2. Each partition adds up its part of the count tables and returns the totals
   to the buckets, in the order in which they asked.
3. A bucket joins the totals to its exploded n-grams and sums by document.

The documents are dealt once, compressed; both 1 and 3 read that exchange. Null text counts as
empty: no words and a score of 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RUN_BYTES, int_column, lower_ascii, mix, pack, runs, shuffle_partitions, ship, unpack, word_hashes, word_spans

BACKOFF = 0.4


def grams(data: np.ndarray, off: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each length, the hash of the n-gram that ends at each word (valid from the row's
    n-th word on); each word's place in its row; words before each row."""
    low = lower_ascii(data)
    start, end, before = word_spans(low, off)
    words = word_hashes(low, start, end)
    place = np.arange(len(words)) - np.repeat(before[:-1], np.diff(before))
    out = [words]
    for n in range(1, order):
        longer = np.zeros(len(words), np.uint64)  # the n-gram before, and one word more
        longer[n:] = mix(out[-1][n - 1:-1] * np.uint64(0x9E3779B97F4A7C15) + words[n:] + np.uint64(n))
        out.append(longer)
    return out, place, before


def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put the rows of each run and bucket together: bucket, ids, and the texts with their sizes, compressed."""
    for batch in batches:
        buckets, ids = int_column(batch, "bucket"), batch.column(batch.schema.get_field_index("doc_id"))
        for i, j, data, off in runs(batch):
            order = np.argsort(buckets[i:j], kind="stable")
            dealt = buckets[i:j][order]
            edge = np.flatnonzero(np.r_[True, dealt[1:] != dealt[:-1], True])
            values = [pack(np.diff(off)[rows], np.concatenate([data[off[r]:off[r + 1]] for r in rows]))
                      for rows in (order[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True))]
            lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), ids.take(pa.array(order + i)))
            yield pa.RecordBatch.from_arrays([pa.array(dealt[edge[:-1]]), lists, pa.array(values, pa.binary())], names=["bucket", "ids", "value"])


def texts_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a bucket's texts."""
    parts = [unpack(v) for v in table.column("value").to_pylist()]
    if not parts:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return np.concatenate([x for _, x in parts]), np.r_[0, np.cumsum(np.concatenate([n for n, _ in parts]))]


def distinct(h: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams in order, which one ends at each word that has one, and their counts."""
    return np.unique(h[place >= n - 1], return_inverse=True, return_counts=True)


def send(table: pa.Table, order: int, parts: int) -> pa.Table:
    """A bucket's distinct n-grams and counts, by partition of the count tables."""
    bucket = table.column("bucket")[0].as_py()
    hashes, place, _ = grams(*texts_of(table), order)
    found = []
    for n in range(1, order + 1):
        h, _, count = distinct(hashes[n - 1], place, n)
        found.append((h, count, cuts(h, parts)))
    values = [pack(*(x for h, c, at in found for x in (steps(h[at[p]:at[p + 1]]), c[at[p]:at[p + 1]].astype(np.uint32)))) for p in range(parts)]
    keep = [p for p in range(parts) if any(at[p] < at[p + 1] for _, _, at in found)]
    return pa.table({"pid": pa.array(keep, pa.int32()), "bucket": pa.array([bucket] * len(keep), pa.int64()),
                     "value": pa.array([values[p] for p in keep], pa.binary())})


def cuts(h: np.ndarray, parts: int) -> np.ndarray:
    """Where each partition's range of hashes begins in the sorted hashes."""
    edges = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    return np.r_[0, np.searchsorted(h, edges), len(h)]


def steps(h: np.ndarray) -> np.ndarray:
    """Sorted hashes as differences, which pack well."""
    return np.diff(h, prepend=np.uint64(0))


def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partition's count tables: for each bucket that asked, the totals in its order."""
    asked: list[tuple[int, int, list[np.ndarray]]] = []
    for batch in batches:
        asked += [(*row, unpack(value)) for *row, value in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    answers: list[list[np.ndarray]] = [[] for _ in asked]
    for n in range(0, len(asked[0][2]) if asked else 0, 2):
        h = np.concatenate([np.cumsum(a[n], dtype=np.uint64) for *_, a in asked])
        _, which = np.unique(h, return_inverse=True)
        total = np.bincount(which, np.concatenate([a[n + 1] for *_, a in asked]))[which].astype(np.uint64)
        at = 0
        for (*_, a), answer in zip(asked, answers, strict=True):
            answer.append(total[at:at + len(a[n])])
            at += len(a[n])
    for (pid, bucket, _), answer in zip(asked, answers, strict=True):
        yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([bucket], pa.int64()), pa.array([pack(*answer)], pa.binary())],
                                         names=["pid", "bucket", "value"])


def score(docs: pa.Table, replies: pa.Table, order: int, words: int, min_count: int) -> pa.Table:
    """Join the totals to the bucket's n-grams; one row a document."""
    hashes, place, before = grams(*texts_of(docs), order)
    pids = np.argsort(replies.column("pid").to_numpy())
    values = replies.column("value").to_pylist()
    parts = [unpack(values[p]) for p in pids]
    count: list[np.ndarray] = []
    for n in range(1, order + 1):
        total = np.concatenate([x[n - 1] for x in parts]) if parts else np.zeros(0)
        _, which, _ = distinct(hashes[n - 1], place, n)
        c = np.zeros(len(place))
        c[place >= n - 1] = total[which]
        count.append(c)
    logs = np.log(count[0] / words) if len(place) else np.zeros(0)
    for n in range(2, order + 1):
        has = place >= n - 1
        seen = has & (count[n - 1] >= min_count)
        logs = np.where(has, logs + math.log(BACKOFF), logs)
        at = np.flatnonzero(seen)
        logs[at] = np.log(count[n - 1][at] / count[n - 2][at - 1])
    n_words = np.diff(before)
    sums = np.add.reduceat(np.r_[logs, 0.0], before[:-1]) * (n_words > 0)
    ids = docs.column("ids").combine_chunks()
    ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
    return pa.table({"doc_id": ids.flatten(), "n_words": pa.array(n_words, pa.int64()), "log_score": pa.array(sums, pa.float64())})


def size_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = words = 0
    for batch in batches:
        for _, _, data, off in runs(batch):
            size += len(data)
            words += int(word_spans(data, off)[2][-1])
    yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), pa.array([words], pa.int64())], names=["size", "words"])


def stupid_backoff(docs: DataFrame, order: int = 3, min_count: int = 2, bucket_bytes: int = RUN_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, log_score (sum of natural logarithms)."""
    spark = docs.sparkSession
    ship(spark)
    parts = shuffle_partitions(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.select("text").mapInArrow(size_of, "size long, words long").agg(F.sum("size").alias("size"), F.sum("words").alias("words")).first()
    buckets, words = max(1, (total["size"] or 0) // bucket_bytes), max(1, total["words"] or 0)
    dealt = (rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)))
             .mapInArrow(deal, f"bucket long, ids array<{kind}>, value binary"))
    asked = dealt.groupBy("bucket").applyInArrow(lambda t: send(t, order, parts), "pid int, bucket long, value binary")
    answered = asked.repartitionById(parts, F.col("pid")).mapInArrow(totals, "pid int, bucket long, value binary")
    return dealt.groupBy("bucket").cogroup(answered.groupBy("bucket")).applyInArrow(
        lambda d, r: score(d, r, order, words, min_count), f"doc_id {kind}, n_words long, log_score double")
