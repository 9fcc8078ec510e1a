"""Conversation prefix trie: the tree of all beginnings that rebuilt conversations share.

A conversation c is rebuilt from the first h turns of conversation c - c % 5 and its own turns
after its first h, h = crc32(decimal c) % 9. A node is a distinct sequence of first turns.

1. Turns are dealt by the block of five conversations, as digests of 128 bits, and read in order: each
   rebuilt conversation gives a row for each of its prefixes, the empty one included, whose digest is
   chained from the one before. Nothing but eight digests of the block's first conversation is held.
2. Each task counts prefix digests in a count-min sketch (counters stop at two); the sketches are
   added up in segments, and the sum is broadcast. Its width follows the number of rows up to MAX_WIDTH.
3. An estimate is never too low, so an estimate of one proves a prefix to be of one conversation only, and with it all longer
   ones: this tail needs no shuffle, its nodes are known where they stand. Only the possibly shared prefixes before it are grouped by
   digest. Beyond the sketch's capacity more prefixes are grouped, with the same result.
4. Subtree sums without walking the tree: a node's own weight is carried by its smallest conversation. Each
   conversation sums what it carries from a depth downwards, and a node adds this up over its members.
   The members of common prefixes meet their node by broadcast, dealt evenly.
5. The conversations that end at a node are put in order over ranges of (node, conv_id), so a conversation of
   which a third of all are copies is spread; the pieces of text are hashed one after another.

Turns are in order of ``turn``, null first; those of the same turn in order of the digest of role and text. Null role and text count
as empty; rows without a conv_id belong to no conversation and are left out. A repeated row is a turn more. Without
conversations there are no nodes. A long conversation costs a row for each turn, a long text its digest. Other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import int_column, join_counted, pack, ship, text_view, unpack

BLOCK, HEAD_TURNS = 5, 9
#: Rows of the sketch, its counters a row at most (a byte each), and counters that are merged together.
DEPTH, MAX_WIDTH, SEGMENT = 4, 1 << 24, 1 << 20
DIGEST = 16
BATCH = 20_000
PIECE = 1 << 20  # characters of a list of conversations that are put out together


def turn_digest(role, text):
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * DIGEST))


def rebuilt_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows: conv_id, depth, digest, bytes of the last text, whether the conversation ends here; sorted by conversation and depth.

    Rows come sorted by block, the block's first conversation in front, conversation, and turn."""
    out: list[tuple] = []
    block = conv = None
    head: list[tuple[bytes, int]] = []  # the digests of the first turns of the block's first conversation
    skip = own = depth = 0
    last, last_bytes = b"", 0

    def put(ends: bool) -> None:
        out.append((conv, depth, last, last_bytes, ends))

    def flush() -> pa.RecordBatch:
        c, d, g, n, e = zip(*out, strict=True)
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(g, pa.binary()), pa.array(n, pa.int64()),
                                            pa.array(e, pa.bool_())], names=["conv_id", "depth", "digest", "n_bytes", "ends"])
        out.clear()
        return batch

    for batch in batches:
        for b, c, digest, size in zip(*(batch.column(x).to_pylist() for x in ("block", "conv_id", "turn_digest", "n_bytes")), strict=True):
            if c != conv:
                if conv is not None:
                    put(True)
                if b != block:
                    block, head = b, []
                conv, own, depth, last, last_bytes = c, 0, 0, b"", 0
                skip = 0 if c == b else zlib.crc32(str(c).encode()) % HEAD_TURNS
                for g, n in head[:skip]:
                    put(False)
                    depth, last, last_bytes = depth + 1, g, n
            own += 1
            if own > skip:
                put(False)
                depth, last, last_bytes = depth + 1, hashlib.blake2b(last + digest, digest_size=DIGEST).digest(), size
                if c == b and depth < HEAD_TURNS:
                    head.append((last, size))
            if len(out) >= BATCH:
                yield flush()
    if conv is not None:
        put(True)
        yield flush()


def counters(digests: np.ndarray, width: int) -> list[np.ndarray]:
    """The counter of each digest (two 64-bit halves) in each row of the sketch."""
    a, b = digests[:, 0], digests[:, 1] | np.uint64(1)
    return [((a + np.uint64(r) * b) >> np.uint64(20) & np.uint64(width - 1)).astype(np.int64) for r in range(DEPTH)]


def halves(column: pa.Array) -> np.ndarray:
    return text_view(column)[0].view("<u8").reshape(-1, 2)


def task_sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    sketch = np.zeros((DEPTH, width), np.uint8)
    for batch in batches:
        for row, at in zip(sketch, counters(halves(batch.column(0)), width), strict=True):
            at, n = np.unique(at, return_counts=True)
            row[at] = np.minimum(row[at] + n, 2)
    flat = sketch.reshape(-1)
    for s in range(0, len(flat), SEGMENT):
        part = flat[s:s + SEGMENT]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([s // SEGMENT], pa.int32()), pa.array([pack(part)], pa.binary())], names=["segment", "value"])


def add_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = unpack(value)[0]
            total[s] = np.minimum(total[s] + part, 2) if s in total else part
    for s, part in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([pack(part)], pa.binary())], names=["segment", "value"])


def prefix_sketch(prefixes: DataFrame, rows: int, max_width: int = MAX_WIDTH) -> tuple[Broadcast, int]:
    """The count-min sketch of all prefix digests, broadcast (DEPTH * max_width bytes at most), and its width."""
    width = min(max_width, max(1 << 14, 1 << (4 * rows).bit_length()))
    segments = -(-DEPTH * width // SEGMENT)
    parts = (prefixes.where("depth > 0").select("digest").mapInArrow(lambda it: task_sketch(it, width), "segment int, value binary")
             .repartitionById(segments, F.col("segment")).mapInArrow(add_sketches, "segment int, value binary"))
    flat = np.zeros(DEPTH * width, np.uint8)
    for r in parts.collect():
        part = unpack(r["value"])[0]
        flat[r["segment"] * SEGMENT:r["segment"] * SEGMENT + len(part)] = part
    return prefixes.sparkSession.sparkContext.broadcast(pack(flat)), width


def screen(batches: Iterator[pa.RecordBatch], shared: Broadcast, width: int) -> Iterator[pa.RecordBatch]:
    """The prefix rows, split: possibly shared ones with ``tail`` (nodes of the conversation after them: 0, 1, or 2 for more), and the
    tails' nodes but the first, which are final (digest null). Rows come sorted by conversation and depth."""
    sketch = unpack(shared.value)[0].reshape(DEPTH, width)
    out: list[tuple] = []
    conv, waiting = None, None  # the last possibly shared prefix, until it is known what follows

    def flush() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int32())
        columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", "depth", "digest", "n_bytes", "ends", "tail"])

    for batch in batches:
        depth = int_column(batch, "depth")
        maybe = depth == 0
        deep = np.flatnonzero(depth > 0)
        if len(deep):
            seen = [row[at] for row, at in zip(sketch, counters(halves(batch.column("digest").take(pa.array(deep))), width), strict=True)]
            maybe[deep] = np.min(seen, axis=0) > 1
        for row, may in zip(zip(*(batch.column(x).to_pylist() for x in ("conv_id", "depth", "digest", "n_bytes", "ends")), strict=True), maybe.tolist(), strict=True):
            if row[0] != conv:
                if waiting:
                    out.append((*waiting, 0))
                conv, waiting = row[0], row  # the empty prefix
            elif waiting and may:
                out.append((*waiting, 0))
                waiting = row
            elif waiting:
                out.append((*waiting, 1 if row[4] else 2))
                waiting = None
            else:
                out.append((row[0], row[1], None, row[3], row[4], 0))
        if len(out) >= BATCH:
            yield flush()
    if waiting:
        out.append((*waiting, 0))
    if out:
        yield flush()


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined conversations of each node, in pieces with their first one; rows come sorted by digest and conv_id."""
    pieces: list[tuple[bytes, int, str]] = []
    node, ids, size = None, [], 0

    def end() -> None:
        if ids:
            pieces.append((node, int(ids[0]), ",".join(ids)))
            ids.clear()

    def flush() -> pa.RecordBatch:
        g, first, text = zip(*pieces, strict=True)
        pieces.clear()
        return pa.RecordBatch.from_arrays([pa.array(g, pa.binary()), pa.array(first, pa.int64()), pa.array(text, pa.string())], names=["digest", "first", "ids"])

    for batch in batches:
        for g, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if g != node or size > PIECE:
                end()
                node, size = g, 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
        if len(pieces) >= BATCH:
            yield flush()
    end()
    if pieces:
        yield flush()


def list_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, joined; rows come sorted by digest and first conversation, and only one piece is held."""
    found: list[tuple[bytes, str]] = []
    node, state = None, None
    for batch in batches:
        for g, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if g != node:
                if state:
                    found.append((node, state.hexdigest()))
                node, state = g, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if len(found) >= BATCH:
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in found], pa.binary()), pa.array([h for _, h in found])], names=["digest", "sha"])
            found = []
    if state:
        found.append((node, state.hexdigest()))
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in found], pa.binary()), pa.array([h for _, h in found])], names=["digest", "sha"])


def prefixes_of(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, digest, n_bytes, ends of all prefixes of all rebuilt conversations, written to the checkpoint folder."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where("conv_id IS NOT NULL").select((conv - conv % BLOCK).alias("block"), conv.alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                              turn_digest(role, text).alias("turn_digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    in_order = turns.repartition("block").sortWithinPartitions("block", F.col("conv_id") != F.col("block"), "conv_id", F.col("turn").asc_nulls_first(), "turn_digest")
    return in_order.mapInArrow(rebuilt_prefixes, "conv_id long, depth long, digest binary, n_bytes long, ends boolean").checkpoint()


def prefix_trie(conversations: DataFrame, max_width: int = MAX_WIDTH) -> DataFrame:
    """Per node: conv_id (its smallest), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    spark = conversations.sparkSession
    ship(spark)
    ensure_checkpoint_dir(spark)
    prefixes = prefixes_of(conversations)
    rows = prefixes.count()
    sketch, width = prefix_sketch(prefixes, rows, max_width)
    split = prefixes.mapInArrow(lambda it: screen(it, sketch, width), "conv_id long, depth long, digest binary, n_bytes long, ends boolean, tail int").checkpoint()
    shared = split.where("digest IS NOT NULL")

    nodes = shared.groupBy("digest").agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.min(F.col("ends")).alias("leaf"))
    met = join_counted(shared, nodes, ["digest"], "n_convs", max(1, rows), "conv_id")
    down = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    carried = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("node") == F.col("conv_id")
    path = met.select("digest", "conv_id", "depth", "node", "n_convs", "tail",
                      F.sum(F.when(own, (F.col("n_convs") - 1) * F.col("n_bytes")).otherwise(0)).over(carried).alias("saved"),
                      F.sum(F.when(own & F.col("leaf"), 1).otherwise(0) + F.when(F.col("tail") > 0, 1).otherwise(0)).over(carried).alias("leaves"),
                      (F.coalesce(F.lag(own.cast("int")).over(down), F.lit(0)) + F.when(F.col("tail") > 0, 1).otherwise(0)).alias("child"),
                      F.lead("node").over(down).alias("parent"))
    ends = (shared.where("ends").select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
            .mapInArrow(listed, "digest binary, first long, ids string").repartition("digest").sortWithinPartitions("digest", "first")
            .mapInArrow(list_hashes, "digest binary, sha string"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    path = path.checkpoint()
    inner = (path.groupBy("digest", "depth").agg(F.min("node").alias("conv_id"), F.min("parent").alias("parent_conv_id"), F.first("n_convs").alias("n_convs"),
                                                 F.sum("child").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
             .join(ends, "digest", "left").withColumn("ends_sha256", F.coalesce("sha", none)))
    alone = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    first = path.where("tail > 0").select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"), one.alias("n_convs"),
                                          (F.col("tail") - 1).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
                                          F.when(F.col("tail") == 1, alone).otherwise(none).alias("ends_sha256"))
    rest = split.where("digest IS NULL").select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
                                                F.when(F.col("ends"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
                                                F.when(F.col("ends"), alone).otherwise(none).alias("ends_sha256"))
    return inner.select(*first.columns).unionByName(first).unionByName(rest)
