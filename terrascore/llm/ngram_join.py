"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A document's set are its distinct shingles of ``words`` words, as 64-bit hashes in order; two documents are linked when
100 * intersection >= percent * union, and form the classes of that relation's closure.

1. Rows with equal sets (a 128-bit key of the set) are one class from here on, whatever their number.
2. Sizes are cut into bands, so wide that a set can only be linked with sets of its own and the next bands; two
   neighbours form a banded tile row. Linked sets of a row differ in k shingles at most (k follows from the row's largest
   size), so when shingles are dealt over k + 1 parts by a hash, linked sets agree in one whole part. The row is cut into
   tiles: the classes that agree in a part (a 64-bit hash of it). Every link so has a tile, exactly; nothing is left to chance but
   equal hashes of different texts.
3. In each tile its first class is held against all others: a star, linear in the tile. These links are closed.
4. Tiles whose classes are then still in several components are laid out with the classes' bitmaps (BITS bits, set by the hashes).
   A bit that only one side has stands for a shingle that only it has, so bit counts bound the overlap from above; the pairs of
   different components that the bound lets pass are candidates. First each class offers the one with the highest bound, and these links are closed;
   then all that are left are candidates. A tile of more than a block of classes is dealt over pairs of parts.
5. Candidates (of 3 as well) are decided by bit counts and then by intersecting the sorted arrays. A class with many candidates is dealt
   over all tasks. All links are closed.

Nothing is capped, and only classes that share a tile send their arrays. Words are ``[^\\x20\\x09-\\x0D]+``, A-Z in lower
case. A text with fewer words than a shingle has one shingle of them all; one without words, or null, has an empty
set and is linked with nothing. Each row is a document of its own, also where rows share a doc_id; a null doc_id is the smallest
one. An empty table gives no rows. Other columns are not looked at. A very long text costs a task its hashes (some 100 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import int_column, join_counted, mix, runs, shuffle_partitions, ship, text_view, unpack
from .links import components, join_values, key_filter, may_hold, most_common
from .minhash_dedup import shingle_sets

BITS = 2048
#: Classes of a tile that one task holds against as many others.
BLOCK = 1024
NULL_ID = -(1 << 63)
_KEYS = mix(np.array([1, 2], np.uint64) * np.uint64(0x9E6C63D0676A9A99))
_PART, _SUM, _BIT = (mix(np.arange(3, 6, dtype=np.uint64) * np.uint64(0x9E6C63D0676A9A99)))


def band_starts(largest: int, percent: int) -> np.ndarray:
    """The smallest size of each band up to ``largest``, and the starts of two more bands."""
    out = [1]
    while out[-1] <= largest or len(out) < 3:
        out.append(max(out[-1] + 1, (out[-1] - 1) * 100 // percent + 1))
    return np.array([*out, max(out[-1] + 1, (out[-1] - 1) * 100 // percent + 1)], np.int64)


def parts_of_rows(starts: np.ndarray, percent: int) -> np.ndarray:
    """k + 1 for the tile row of each band and the next one: sets of sizes up to u differ in 2u(100 - percent) / (100 + percent) shingles."""
    return 2 * (starts[2:] - 1) * (100 - percent) // (100 + percent) + 1


def tile_posts(h: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The tiles of each set (sorted hashes and the number before each set), and the number of tiles before each set.

    A set of band j lies in the tile rows j - 1 and j. A row of one part holds only equal sets, which are one class: no tile."""
    n = np.diff(at)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    starts = band_starts(int(n.max()), percent)
    parts = parts_of_rows(starts, percent)
    band = np.searchsorted(starts, n, "right") - 1
    row_of = np.repeat(np.arange(len(n)), n)
    posts, owners = [], []
    dealt, hashed = mix(h ^ _PART), mix(h ^ _SUM)
    for row in (band - 1, band):
        m = np.where((row >= 0) & (n > 0), parts[np.clip(row, 0, len(parts) - 1)], 0)
        m = np.where(m > 1, m, 0)
        first = np.r_[0, np.cumsum(m)]
        use = np.flatnonzero(m[row_of] > 0)
        total = np.zeros(first[-1], np.uint64)
        owner = row_of[use]
        np.add.at(total, first[:-1][owner] + (dealt[use] % m[owner].astype(np.uint64)).astype(np.int64), hashed[use])
        owner = np.repeat(np.arange(len(n)), m)
        part = np.arange(first[-1]) - first[:-1][owner]
        posts.append(mix(total + mix((row[owner].astype(np.uint64) << np.uint64(32)) + part.astype(np.uint64))).astype(np.int64))
        owners.append(owner)
    owner = np.concatenate(owners)
    o = np.argsort(owner, kind="stable")
    return np.concatenate(posts)[o], np.r_[0, np.cumsum(np.bincount(owner, minlength=len(n)))]


def set_keys(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128 bits of each set; zero for an empty one."""
    out = np.zeros((len(at) - 1, 2), np.uint64)
    has = np.flatnonzero(np.diff(at))
    if len(has):
        for c in range(2):
            out[has, c] = mix(np.add.reduceat(mix(h ^ _KEYS[c]), at[:-1][has]))
    return out


def binaries(rows: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in rows], pa.binary())


def keyed_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Per row: id, n, key of the set, and the key's first half as a number."""
    for batch in batches:
        ids = int_column(batch, "id")
        for i, j, data, off in runs(batch):
            h, at = shingle_sets(data, off, words)
            keys = set_keys(h, at)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i:j]), pa.array(np.diff(at)), binaries(keys), pa.array(keys[:, 0].astype(np.int64))], names=["id", "n", "key", "half"])


def posted_sets(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Per row with a set: key, n, posts (the tiles)."""
    for batch in batches:
        for _, _, data, off in runs(batch):
            h, at = shingle_sets(data, off, words)
            posts, before = tile_posts(h, at, percent)
            has = pa.array(np.flatnonzero(np.diff(at)))
            lists = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(posts))
            yield pa.RecordBatch.from_arrays([binaries(set_keys(h, at)).take(has), pa.array(np.diff(at)).take(has), lists.take(has)], names=["key", "n", "posts"])


def bitmaps(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros((len(at) - 1) * (BITS >> 3), np.uint8)
    x = mix(h ^ _BIT) % np.uint64(BITS)
    row_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    np.bitwise_or.at(out, row_of * (BITS >> 3) + (x >> np.uint64(3)).astype(np.int64), (np.uint64(1) << (x & np.uint64(7))).astype(np.uint8))
    return out.reshape(len(at) - 1, BITS >> 3)


def wanted_sets(batches: Iterator[pa.RecordBatch], words: int, wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    """key, bitmap and sorted array of the rows' sets whose key may be wanted."""
    found = unpack(wanted.value)[0]
    for batch in batches:
        for _, _, data, off in runs(batch):
            h, at = shingle_sets(data, off, words)
            keys = set_keys(h, at)
            keep = np.flatnonzero((np.diff(at) > 0) & may_hold(found, keys[:, 0]))
            bits = bitmaps(h, at)
            yield pa.RecordBatch.from_arrays([binaries(keys[keep]), binaries(bits[keep]), pa.array([h[at[r]:at[r + 1]].tobytes() for r in keep], pa.binary())],
                                             names=["key", "bits", "set"])


def tile_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """post, rep and first (the tile's first class) of the tiles of two classes or more; rows come sorted by post and rep."""
    last_post = last_rep = None  # the row before, and whether its tile has been seen to have two rows
    first, several = 0, False
    for batch in batches:
        if not len(batch):
            continue
        post, rep = int_column(batch, "post"), int_column(batch, "rep")
        if last_post is not None:  # the row that waited goes in front
            post, rep = np.r_[last_post, post], np.r_[last_rep, rep]
        new = np.r_[True, post[1:] != post[:-1]]
        head = np.flatnonzero(new)
        firsts = rep[head][np.cumsum(new) - 1]
        if last_post is not None:
            firsts[:head[1] if len(head) > 1 else len(post)] = first
        shared = np.r_[new[1:], True] & new  # alone so far
        keep = ~shared
        if several and last_post is not None:
            keep[0] = True
        out = np.flatnonzero(keep[:-1])
        last_post, last_rep, first = post[-1], rep[-1], firsts[-1]
        several = bool(keep[-1]) if not new[-1] else (several and len(post) == 1)
        for i in range(0, len(out), 50_000):
            s = out[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(post[s]), pa.array(rep[s]), pa.array(firsts[s])], names=["post", "rep", "first"])
    if several:
        yield pa.RecordBatch.from_arrays([pa.array([last_post]), pa.array([last_rep]), pa.array([first])], names=["post", "rep", "first"])


def tile_pairs(batches: Iterator[pa.RecordBatch], percent: int, best: bool) -> Iterator[pa.RecordBatch]:
    """Candidates (a < b) of different components in each tile and block, with ``best`` the one of the highest bound for each row;
    rows come sorted by both: post, block, rep, n, comp, rest, bits."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def done(rows: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        post, block, rep, n, comp, rest = rows
        new = np.r_[True, (post[1:] != post[:-1]) | (block[1:] != block[:-1])]
        end = np.r_[np.flatnonzero(new)[1:], len(post)][np.cumsum(new) - 1]
        share, other = np.zeros(len(post)), np.zeros(len(post), np.int64)  # each row's best: bound of the likeness, place
        x, step, found = np.arange(len(post)), 1, []
        while len(x := x[x + step < end[x]]):  # all pairs of a tile at a distance of ``step`` rows
            ok = (comp[x] != comp[x + step]) & ((rest[x] == 0) | (rest[x] != rest[x + step]))
            u = x[ok]
            for i in range(0, len(u), 1 << 15):
                p = u[i:i + (1 << 15)]
                q = p + step
                most = most_common(n, bits, p, q)
                ok = (100 + percent) * most >= percent * (n[p] + n[q])
                p, q, most = p[ok], q[ok], most[ok]
                if best:
                    likeness = most / (n[p] + n[q] - most)
                    for one, two in ((p, q), (q, p)):  # no row stands twice in either
                        more = likeness > share[one]
                        share[one[more]], other[one[more]] = likeness[more], two[more]
                else:
                    found.append(np.stack([rep[p], rep[q]]))
            step += 1
        if best:
            p = np.flatnonzero(share)
            found.append(np.stack([rep[p], rep[other[p]]]))
        if found:
            both = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
            for i in range(0, both.shape[1], 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(both[0, i:i + 50_000]), pa.array(both[1, i:i + 50_000])], names=["a", "b"])

    for batch in batches:
        if not len(batch):
            continue
        rows = np.stack([int_column(batch, c) for c in ("post", "block", "rep", "n", "comp", "rest")])
        held.append((rows, text_view(batch.column(batch.schema.get_field_index("bits")))[0].view("<u8").reshape(len(batch), -1)))
        last = rows[:2, -1]
        if (held[0][0][:2, 0] != last).any():
            rows, bits = np.concatenate([r for r, _ in held], axis=1), np.concatenate([b for _, b in held])
            cut = int(np.flatnonzero((rows[:2] != last[:, None]).any(axis=0))[-1]) + 1
            yield from done(rows[:, :cut], bits[:cut])
            held = [(rows[:, cut:], bits[cut:])]
    if held:
        yield from done(np.concatenate([r for r, _ in held], axis=1), np.concatenate([b for _, b in held]))


def linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets are linked: a, b, and the bitmap and sorted array of each."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("bits_a", "set_a", "bits_b", "set_b")]
        keep = []
        for bits_a, set_a, bits_b, set_b in zip(*columns, strict=True):
            s, t = (np.frombuffer(x.as_buffer(), "<u8") for x in (set_a, set_b))
            n, bits = np.array([len(s), len(t)]), np.stack([np.frombuffer(x.as_buffer(), "<u8") for x in (bits_a, bits_b)])
            if (100 + percent) * most_common(n, bits, np.array([0]), np.array([1]))[0] >= percent * n.sum():
                at = np.searchsorted(t, s)
                both = int(np.count_nonzero(t[np.minimum(at, len(t) - 1)] == s))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            else:
                keep.append(False)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def decided(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of the pairs (a, b), which are a table; sets: node, bits, set."""
    of = lambda c: sets.select(F.col("node").alias(c), F.col("bits").alias(f"bits_{c}"), F.col("set").alias(f"set_{c}"))
    met = join_values(pairs.join(of("b"), "b"), of("a"), "a", "b", pairs)  # the first of a pair may be many others' first as well
    return met.select("a", "b", "bits_a", "set_a", "bits_b", "set_b").mapInArrow(lambda it: linked(it, percent), "a long, b long")


def dealt_tiles(tiles: DataFrame) -> DataFrame:
    """The rows (post, rep, comp) of the tiles that hold several components, with block and rest. A tile of more than BLOCK rows
    has parts of about BLOCK; a block holds two parts (rest 1 and 2: held against each other) or one (rest 0), so each pair meets once."""
    tile = Window.partitionBy("post")
    met = (tiles.select("post", "rep", "comp", F.count(F.lit(1)).over(tile).alias("g"), F.min("comp").over(tile).alias("lo"), F.max("comp").over(tile).alias("hi"))
           .where("lo < hi").withColumn("parts", F.ceil(F.col("g") / BLOCK)).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts"))))
    to = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda j: F.struct(
        (F.least("part", j) * F.col("parts") + F.greatest("part", j)).alias("block"), F.when(F.col("part") == j, 0).when(F.col("part") < j, 1).otherwise(2).alias("rest")))
    return met.withColumn("to", F.explode(to)).select("post", "rep", "comp", "to.block", "to.rest")


def jaccard_classes(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must lie between 1 and 100")
    spark = docs.sparkSession
    ship(spark)
    ensure_checkpoint_dir(spark)
    parts = shuffle_partitions(spark)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col("text").cast("string").alias("text"))
    base = rows.mapInArrow(lambda it: keyed_sets(it, words), "id long, n long, key binary, half long").checkpoint()
    # a class of equal sets is a node; its number is fixed by the checkpoint
    classes = (base.where("n > 0").groupBy("key", "n", "half").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
               .withColumn("node", F.monotonically_increasing_id()).checkpoint())
    posts = (rows.select("text").mapInArrow(lambda it: posted_sets(it, words, percent), "key binary, n long, posts array<long>")
             .groupBy("key", "n").agg(F.first("posts").alias("posts")).join(classes, ["key", "n"]).select(F.col("node").alias("rep"), F.explode("posts").alias("post")))
    members = (posts.repartition(parts, "post").sortWithinPartitions("post", "rep").mapInArrow(tile_members, "post long, rep long, first long").checkpoint())

    wanted = key_filter(classes.join(members.select(F.col("rep").alias("node")).distinct(), "node", "left_semi").select(F.col("half").alias("key")))
    sets = (rows.select("text").mapInArrow(lambda it: wanted_sets(it, words, wanted), "key binary, bits binary, set binary")
            .groupBy("key").agg(F.first("bits").alias("bits"), F.first("set").alias("set")).join(classes.select("key", "node", "n"), "key")
            .select("node", "n", "bits", "set").checkpoint())

    stars = members.where("rep != first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct().checkpoint()
    links = decided(stars, sets, percent).checkpoint()
    for best in (True, False):
        joined = components(links)
        tiles = members.select("post", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("post", "rep", F.coalesce("comp", "rep").alias("comp"))
        laid = (dealt_tiles(tiles).join(sets.select(F.col("node").alias("rep"), "n", "bits"), "rep").select("post", "block", "rep", "n", "comp", "rest", "bits")
                .repartition(parts, "post", "block").sortWithinPartitions("post", "block"))
        others = laid.mapInArrow(lambda it, best=best: tile_pairs(it, percent, best), "a long, b long").distinct().checkpoint()
        if not others.limit(1).count():
            break
        links = links.union(decided(others, sets, percent)).checkpoint()
    else:
        joined = components(links)

    placed = classes.join(joined, "node", "left").select("key", "n", "least", "copies", F.coalesce("comp", "node").alias("comp"))
    least = placed.groupBy("comp").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("classes"))
    of_class = join_counted(placed, least, ["comp"], "classes", max(1, classes.count()), "key")
    filled = base.where("n > 0")
    known = join_counted(filled.select("id", "n", "key"), of_class.select("key", "n", "component", "copies"), ["key", "n"], "copies", max(1, base.count()), "id")
    out = known.select("id", "n", "component").union(base.where("n = 0").select("id", "n", F.col("id").alias("component")))
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(back("id").alias("doc_id"), F.col("n").alias("n_shingles"), back("component").alias("component_id"))
