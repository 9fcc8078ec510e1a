"""MinHash near-dedup: an inverted join over signature coordinates.

A document's set are its distinct shingles of ``words`` words; documents are linked when
100 * intersection >= percent * union, and form the classes of that relation's closure.

1. Each text gets its set's size, a 128-bit key of the set, a signature (the least
   hash of the set under each of COORDINATES permutations) and something finer to compare by: a bitmap of
   BITS bits set by the hashes, or, for sets over SPARSE shingles, a sketch (the set dealt
   over BINS bins by one hash, a byte of the least in each). Sets that may be linked with each other across SPARSE have both. Documents with the
   same key are one class from here on, whatever their number.
2. Classes are posted under their coordinate-value pairs. Two linked classes agree in
   ``matches`` coordinates or more (all but one in thirty million pairs at the
   very threshold; the number follows from ``percent``: 12 at 80), so it is enough to post a class under its rarest pairs, all but
   ``matches`` - 1 of those that others have too (the prefix); a class with fewer than
   ``matches`` such pairs has no partner and is skipped.
3. Each class is held against the smallest doc_id of its posts, where they collide
   ``matches`` times or more: a star for each group of near copies, linear in its size. The
   links are confirmed and closed. Then the posts are merged: those that collide ``matches`` times or more with a post of another component
   stay, found by the coordinates alone, and only they are sent with bitmaps and sketches from here on. Each offers the
   likest post of another component, if it is likely:
   at most one candidate a post and block. These are confirmed and closed as well.
4. Last, all posts of different components under one pair are candidates that may be linked: a bit that only one side has stands for a shingle
   that only it has, so bitmaps bound the overlap from above and lose no link; sketches must agree in a least share of the bins in use (it
   follows from ``percent``, a pair at the very threshold is missed with a chance of 2e-8 at most).
   Posts of one component make none (skip), so a group of near copies costs what its
   unlinked rest costs; and a pair is put out under the first two pairs that both are
   posted under, not under all. The candidates are confirmed, and all links are closed.

Links are confirmed on the full sets of both whole texts, as 64-bit hashes of the shingles. Nothing is capped. Words are
``[^\\x20\\x09-\\x0D]+``, A-Z in lower case. A text with fewer words than a shingle has one
shingle of them all; one without words has an empty set and is linked with nothing. A
null doc_id is the smallest one; rows that share a doc_id are one document with several texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import int_column, join_counted, mix, release, runs, ship, shuffle_partitions, text_view, unpack
from .links import components, join_values, key_filter, may_hold, most_common
from .lm_score import grams

COORDINATES = 32
#: Bins of the sketch.
BINS = 256
#: Bits of a set's bitmap, and the largest size that is compared by bitmaps: beyond, they get too full to tell sets apart.
BITS, SPARSE = 2048, 512
#: Per cent of the bins by which a likely partner is over the least share.
LIKELIER = 9
#: Posts of one pair that a task holds against as many others.
BLOCK = 1024
#: Bytes of text that a task cuts into shingles at a time.
RUN = 2 << 20
NULL_ID = -(1 << 63)
_SEEDS = mix(np.arange(1, COORDINATES + 5, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def least_agreeing(draws: int, percent: int, missed: float) -> int:
    """The most of ``draws`` agreements to ask for, so that a pair of ``percent`` per cent has fewer with a chance of ``missed`` at most."""
    p, below = percent / 100, 0.0
    for k in range(draws + 1):
        below += math.comb(draws, k) * p ** k * (1 - p) ** (draws - k)
        if below > missed:
            return k
    return draws


def least_matches(percent: int) -> int:
    """Coordinates in which a linked pair agrees (missed by one in thirty million at the very threshold)."""
    return max(1, least_agreeing(COORDINATES, percent, 3e-8))


def least_alike(percent: int) -> int:
    """Per cent of the bins in use in which a linked pair agrees (missed with a chance of 2e-8 at the very threshold)."""
    return 100 * least_agreeing(BINS, percent, 2e-8) // BINS


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, sorted, and the number of them before each row."""
    hashes, place, before = grams(data, off, words)
    count = np.diff(before)
    row_of = np.repeat(np.arange(len(count)), count)
    full = place >= words - 1
    few = np.flatnonzero((count > 0) & (count < words))  # all words as one shingle
    h = np.concatenate([hashes[-1][full], np.array([hashes[count[r] - 1][before[r + 1] - 1] for r in few], np.uint64)])
    row = np.concatenate([row_of[full], few])
    o = np.lexsort((h, row))
    h, row = h[o], row[o]
    new = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])][:len(h)]
    return h[new], np.r_[0, np.cumsum(np.bincount(row[new], minlength=len(count)))]


def has_bitmap(n: np.ndarray, percent: int) -> np.ndarray:
    """Sets of SPARSE shingles or fewer, and those that are linked with them perhaps."""
    return percent * n <= 100 * SPARSE


def has_sketch(n: np.ndarray) -> np.ndarray:
    return n > SPARSE


def signatures(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Per row: id, n, key of the set, posts (coordinate and value as one number), and sig: two bytes of each coordinate, the
    bitmap of the set where it has one, and a byte of each bin (0: empty) where it has a sketch."""
    for batch in batches:
        ids = int_column(batch, "id")
        for i, j, data, off in runs(batch, limit=RUN):
            h, at = shingle_sets(data, off, words)
            n, has = np.diff(at), np.flatnonzero(np.diff(at))
            start = at[:-1][has]
            keys = np.zeros((j - i, 2), np.uint64)
            posts, sketch = np.zeros((j - i, COORDINATES), np.int64), np.zeros((j - i, BINS), np.uint8)
            bits = np.zeros((j - i, BITS), bool)
            if len(has):
                for c in range(2):
                    keys[has, c] = np.add.reduceat(mix(h ^ _SEEDS[COORDINATES + c]), start)
                for c in range(COORDINATES):
                    least = np.minimum.reduceat(mix(h ^ _SEEDS[c]), start)
                    posts[has, c] = (np.uint64(c) << np.uint64(32) | least >> np.uint64(32)).astype(np.int64)
                row = np.repeat(np.arange(j - i), n)
                bits[row, (mix(h ^ _SEEDS[COORDINATES + 3]) % np.uint64(BITS)).astype(np.int64)] = True
                long = has_sketch(n)[row]
                x = mix(h[long] ^ _SEEDS[COORDINATES + 2])
                at_bin = row[long] * BINS + (x % np.uint64(BINS)).astype(np.int64)
                o = np.lexsort((x, at_bin))  # the least of each bin comes first
                o = o[np.r_[True, at_bin[o][1:] != at_bin[o][:-1]][:len(o)]]
                sketch.reshape(-1)[at_bin[o]] = (x[o] >> np.uint64(32)) % np.uint64(255) + np.uint64(1)
            maps = np.packbits(bits, axis=1)
            short = (posts & 0xFFFF).astype("<u2")
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * COORDINATES, COORDINATES, dtype=np.int32)), pa.array(posts.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[i:j]), pa.array(n), pa.array([x.tobytes() for x in keys], pa.binary()), lists,
                                              pa.array([x.tobytes() + (y.tobytes() if u else b"") + (z.tobytes() if v else b"")
                                                        for x, y, z, u, v in zip(short, maps, sketch, has_bitmap(n, percent), has_sketch(n), strict=True)], pa.binary())],
                                             names=["id", "n", "key", "posts", "sig"])
    release()


def whole_blocks(batches: Iterator[pa.RecordBatch], dense) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows (post, block, ...) and signatures of a few whole blocks at a time; rows come sorted by post and block."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not len(batch):
            continue
        rows = np.stack([np.asarray(c.to_numpy(zero_copy_only=False), np.int64) for c in batch.columns[:-1]])
        held.append((rows, dense(batch.column(batch.num_columns - 1).cast(pa.binary()), rows[3])))
        last = rows[:2, -1]
        if (held[0][0][:2, 0] != last).any():  # all but the last, perhaps unfinished, group
            rows, sig = np.concatenate([r for r, _ in held], axis=1), np.concatenate([g for _, g in held])
            cut = int(np.flatnonzero((rows[:2] != last[:, None]).any(axis=0))[-1]) + 1
            yield rows[:, :cut], sig[:cut]
            held = [(rows[:, cut:], sig[cut:])]
    if held:
        yield np.concatenate([r for r, _ in held], axis=1), np.concatenate([g for _, g in held])


def edges(rows: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each block of two rows or more."""
    edge = np.flatnonzero(np.r_[True, (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1]), True]).tolist()
    return [(x, y) for x, y in zip(edge[:-1], edge[1:], strict=True) if y - x > 1]


def may_meet(rows: np.ndarray, q: slice, percent: int) -> np.ndarray:
    """Which rows of a block each of the rows q is held against: of another component, with a set of a size that allows a link."""
    _, _, _, n, comp, _, rest = rows
    ok = (comp[q, None] != comp) & (100 * n[q, None] >= percent * n) & (100 * n >= percent * n[q, None])
    return ok & ((rest[q, None] == 0) | (rest[q, None] != rest))  # two posts of one side meet in another block, or have one component


def colliding(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The posts that collide with one of another component under ``matches`` coordinates or more (by 16 bits of each
    value: none is missed). A pair that does so does it under each coordinate-value pair that both are posted under."""
    matches = least_matches(percent)
    for rows, sig in whole_blocks(batches, lambda sigs, n: text_view(sigs)[0].reshape(len(n), -1)):
        values, found = np.ascontiguousarray(sig).view("<u2"), np.zeros(rows.shape[1], bool)
        for x, y in edges(rows):
            block, own = rows[:, x:y], values[x:y]
            for s in range(0, y - x, 128):
                q = slice(s, s + 128)
                ok = may_meet(block, q, percent)
                if ok.any():
                    count = np.zeros(ok.shape, np.uint8)
                    for c in range(COORDINATES):
                        count += own[q, c, None] == own[:, c]
                    found[x:y][q] = (ok & (count >= matches)).any(axis=1)
        if found.any():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows[:, found]], names=["post", "block", "rep", "n", "comp", "mask", "rest"])


def merge_posts(batches: Iterator[pa.RecordBatch], percent: int, best: bool) -> Iterator[pa.RecordBatch]:
    """Candidates among the posts of each pair and block (rows come sorted by both): a < b, in different components.
    All that their bitmaps let pass (a bound from above: no link is lost), or, of larger sets, whose sketches agree in the least share of bins;
    with ``best`` each post's likest one.

    A pair stands under many coordinate-value pairs; it is put out under the first two
    coordinates that both are posted under with equal values. Two, as values are compared by 16 bits
    here: one chance agreement before the first true one does no harm."""
    alike = least_alike(percent)
    at_least = min(100, alike + LIKELIER) if best else alike
    ends = np.cumsum([2 * COORDINATES, BITS >> 3, BINS])

    def likeness(n: np.ndarray, sig: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Per cent, as near as bitmaps or sketches tell; 0 for pairs that can't be linked."""
        out = np.zeros(len(x))
        by_bits = has_bitmap(np.maximum(n[x], n[y]), percent)
        for i in range(0, len(x), 16384):
            part = np.arange(i, min(i + 16384, len(x)))
            p = part[by_bits[part]]
            if len(p):
                u, v = x[p], y[p]
                most = most_common(n, sig[:, ends[0]:ends[1]].view("<u8"), u, v)
                share = 100.0 * most / (n[u] + n[v] - most)
                out[p] = np.where((100 + percent) * most >= percent * (n[u] + n[v]), share, 0)
            p = part[~by_bits[part]]
            if len(p):
                u, v = sig[x[p], ends[1]:], sig[y[p], ends[1]:]
                used = u | v
                share = 100.0 * np.count_nonzero((u == v) & (used != 0), axis=1) / np.count_nonzero(used, axis=1)
                out[p] = np.where(share >= at_least, share, 0)
        return out

    def dense(sigs: pa.Array, n: np.ndarray) -> np.ndarray:
        """The signatures as rows of one width, with zeros for the parts that a row has not."""
        data, off = text_view(sigs)
        out = np.zeros((len(n), ends[2]), np.uint8)
        maps, sketches = has_bitmap(n, percent), has_sketch(n)
        for wanted, places in ((maps & ~sketches, np.arange(ends[1])), (~maps, np.r_[:ends[0], ends[1]:ends[2]]), (maps & sketches, np.arange(ends[2]))):
            r = np.flatnonzero(wanted)
            out[r[:, None], places] = data[off[r][:, None] + np.arange(len(places))]
        return out

    def pairs(rows: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        post, _, rep, n, _, mask, _ = rows
        values = sig[:, :ends[0]].copy().view("<u2")
        own = int(post[0] >> 32)
        found_a, found_b = [], []
        for s in range(0, len(rep), 128):
            q = slice(s, s + 128)
            ok = may_meet(rows, q, percent)
            if not best:
                ok &= np.arange(len(rep))[q, None] < np.arange(len(rep))
            x, y = np.nonzero(ok)
            if not len(x):
                continue
            x += s
            share = likeness(n, sig, x, y)
            x, y, share = x[share > 0], y[share > 0], share[share > 0]
            if best:
                o = np.lexsort((-share, x))
                o = o[np.r_[True, x[o][1:] != x[o][:-1]][:len(o)]]
                x, y = x[o], y[o]
            elif own:  # earlier coordinates that both are posted under, with the same value
                posted = (mask[x] & mask[y])[:, None] >> np.arange(own) & 1
                first = np.count_nonzero((values[x, :own] == values[y, :own]) & (posted == 1), axis=1) < 2
                x, y = x[first], y[first]
            found_a.append(rep[x]), found_b.append(rep[y])
        if not found_a:
            return rep[:0], rep[:0]
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        return np.minimum(a, b), np.maximum(a, b)

    for rows, sig in whole_blocks(batches, dense):
        out = [pairs(rows[:, x:y], sig[x:y]) for x, y in edges(rows)]
        if out:
            both = np.unique(np.stack([np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])]), axis=1)
            for x in range(0, both.shape[1], 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(both[0, x:x + 50_000]), pa.array(both[1, x:x + 50_000])], names=["a", "b"])


def blocks_of(posts: DataFrame) -> DataFrame:
    """The posts (post, rep, comp) that have partners, with block and rest (the side of a block that holds two parts, or 0).

    A pair with more than BLOCK posts is dealt: those of its largest component (if that alone has more than BLOCK), and the
    rest, each have a hashed part of about BLOCK posts. A block holds one part of the rest, two of them, or one of the rest
    and one of the component, so two posts meet in one block, unless both are of that component, and no block has
    more than about 2 x BLOCK rows."""
    groups = posts.groupBy("post").agg(F.count(F.lit(1)).alias("g"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("post", "g")
    big = groups.where(F.col("g") > BLOCK)
    major = (posts.join(big, "post", "left_semi").groupBy("post", "comp").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > BLOCK).groupBy("post")
             .agg(F.max_by("comp", F.struct("k", "comp")).alias("major"), F.max("k").alias("k")))
    met = join_counted(posts, groups.join(major, "post", "left"), ["post"], "g", max(1, posts.count()), "rep")
    k = F.coalesce("k", F.lit(0))
    of_rest, of_major = F.ceil((F.col("g") - k) / BLOCK).cast("long"), F.ceil(k / BLOCK).cast("long")
    part = lambda parts: F.pmod(F.xxhash64("rep"), parts)
    zero = F.lit(0).cast("long")

    def at(block, rest):
        return F.struct(block.alias("block"), rest.cast("int").alias("rest"))

    def two(i, j):
        return at(F.least(i, j) * of_rest + F.greatest(i, j), F.when(i == j, 0).when(i < j, 1).otherwise(2))

    def mixed(i, j, side):
        return at(of_rest * of_rest + i * of_major + j, F.lit(side))

    among = F.transform(F.sequence(zero, of_rest - 1), lambda j: two(part(of_rest), j))
    in_rest = F.when(k == 0, among).otherwise(F.concat(among, F.transform(F.sequence(zero, of_major - 1), lambda j: mixed(part(of_rest), j, 1))))
    in_major = F.transform(F.sequence(zero, of_rest - 1), lambda i: mixed(i, part(of_major), 2))
    to = F.when(F.col("g") <= BLOCK, F.array(at(zero, F.lit(0)))).when(F.col("comp") == F.col("major"), in_major).otherwise(in_rest)
    return met.withColumn("to", F.explode(to)).select(*posts.columns, "to.block", "to.rest")


def laid_out(dealt: DataFrame, held: DataFrame, sig) -> DataFrame:
    """The dealt posts with their signature, or a part of it, block by block; held: rep and sig."""
    return (dealt.join(held.select("rep", sig.alias("sig")), "rep").select("post", "block", "rep", "n", "comp", "mask", "rest", "sig")
            .repartition(shuffle_partitions(dealt.sparkSession), "post", "block").sortWithinPartitions("post", "block"))


def in_collision(posts: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The posts (post, rep, n, comp, mask) that have a partner by their collisions, with block and rest: only these need more than the coordinates."""
    short = F.substring("sig", 1, 2 * COORDINATES)
    return (laid_out(blocks_of(posts), held, short)
            .mapInArrow(lambda it: colliding(it, percent), "post long, block long, rep long, n long, comp long, mask long, rest long"))


def candidates(dealt: DataFrame, held: DataFrame, percent: int, best: bool) -> DataFrame:
    """Candidate pairs (a, b) of posts that are dealt to blocks."""
    return laid_out(dealt, held, F.col("sig")).mapInArrow(lambda it: merge_posts(it, percent, best), "a long, b long").distinct()


def shared_posts(batches: Iterator[pa.RecordBatch], wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    """rep and post, one row for each of a row's posts that may be wanted."""
    found = unpack(wanted.value)[0]
    for batch in batches:
        lists = batch.column(1)
        keep = pa.array(may_hold(found, np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pc.list_parent_indices(lists).filter(keep)), lists.flatten().filter(keep)], names=["rep", "post"])


def held_rows(batches: Iterator[pa.RecordBatch], wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    """The rows whose id may be wanted."""
    found = unpack(wanted.value)[0]
    for batch in batches:
        yield batch.filter(pa.array(may_hold(found, int_column(batch, "id"))))


def packed_texts(batches: Iterator[pa.RecordBatch], wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    """id and compressed text of the rows whose id may be wanted."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for keep in held_rows(batches, wanted):
        for i, j, data, off in runs(keep, limit=RUN):
            whole = data.tobytes()
            yield pa.RecordBatch.from_arrays([keep.column(0).slice(i, j - i), pa.array([squeeze(whole[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)], pa.binary())],
                                             names=["id", "z"])


def confirm(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, and both texts) whose whole sets of shingles (64-bit hashes) are linked."""
    unpack_text = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        x, y = (batch.column(c).to_pylist() for c in (2, 3))
        i = 0
        while i < len(x):
            place: dict[bytes, int] = {}  # the distinct texts of a run, each of which is cut into shingles once
            texts, size, j = [], 0, i
            while j < len(x) and (j == i or size < RUN):
                for z in (x[j], y[j]):
                    if z not in place:
                        place[z] = len(texts)
                        texts.append(unpack_text(z))
                        size += len(texts[-1])
                j += 1
            h, at = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])], words)
            keep = []
            for u, v in zip(x[i:j], y[i:j], strict=True):
                s, t = (h[at[r]:at[r + 1]] for r in (place[u], place[v]))
                if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)) or not len(s):
                    keep.append(False)
                    continue
                both = int(np.count_nonzero(t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
            i = j


def confirmed(texts: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b), a table, whose whole texts are linked; texts: id, z. Only texts of the pairs are sent,
    those of a hub once to each task: the others are left behind by a key filter, before any shuffle."""
    wanted = key_filter(pairs.select(F.explode(F.array("a", "b")).alias("key")))
    near = texts.mapInArrow(lambda it: held_rows(it, wanted), "id long, z binary")
    of = lambda c: near.join(pairs.select(F.col(c).alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias(c), F.col("z").alias(f"z{c}"))
    met = join_values(pairs.join(of("b"), "b"), of("a"), "a", "b", pairs)
    return met.select("a", "b", "za", "zb").mapInArrow(lambda it: confirm(it, words, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (its doc_id is the component's)."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    spark = docs.sparkSession
    ship(spark)
    ensure_checkpoint_dir(spark)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col("text").cast("string").alias("text"))
    base = rows.mapInArrow(lambda it: signatures(it, words, percent), "id long, n long, key binary, posts array<long>, sig binary").checkpoint()
    classes = base.where("n > 0").groupBy("key", "n").agg(F.min("id").alias("rep"), F.first("posts").alias("posts"), F.first("sig").alias("sig"))

    matches = least_matches(percent)
    # a smaller set can only be linked with its equals
    least = next(n for n in range(1, 102) if 100 * n >= percent * (n + 1) or n == 101)
    posting = classes.where(F.col("n") >= least)
    shared = (posting.select("rep", F.explode("posts").alias("post")).groupBy("post")
              .agg(F.count(F.lit(1)).alias("f"), F.min("rep").alias("first")).where("f > 1").checkpoint())
    common = key_filter(shared.select(F.col("post").alias("key")))  # the posts that no other class has don't go to the join
    posted = posting.select("rep", "posts").mapInArrow(lambda it: shared_posts(it, common), "rep long, post long")
    of_rep = (join_counted(posted, shared, ["post"], "f", base.count() * COORDINATES, "rep").groupBy("rep")
              .agg(F.array_sort(F.collect_list(F.struct("f", "post", "first"))).alias("posts")).where(F.size("posts") >= matches))
    firsts = F.col("posts.first")
    stars = F.filter(F.array_distinct(firsts), lambda p: (p != F.col("rep")) & (F.size(F.filter(firsts, lambda x: x == p)) >= matches))
    prefix = F.slice(F.col("posts.post"), F.lit(1), F.size("posts") - (matches - 1))
    held = of_rep.select("rep", prefix.alias("prefix"), stars.alias("stars")).join(classes.select("rep", "n", "sig"), "rep").checkpoint()

    def placed(posts: DataFrame, links: DataFrame) -> DataFrame:
        """The posts, with the component that the links so far give."""
        return posts.join(components(links).withColumnRenamed("node", "rep"), "rep", "left").select("post", "rep", "n", F.coalesce("comp", "rep").alias("comp"), "mask").checkpoint()

    mask = F.aggregate("prefix", F.lit(0).cast("long"), lambda m, p: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(p, 32).cast("int"))))
    posts = held.select(F.explode("prefix").alias("post"), "rep", "n", mask.alias("mask"))
    wanted = key_filter(held.select(F.col("rep").alias("key")))
    texts = rows.mapInArrow(lambda it: packed_texts(it, wanted), "id long, z binary").checkpoint()
    pairs = held.select(F.explode("stars").alias("a"), F.col("rep").alias("b")).distinct().checkpoint()
    links = confirmed(texts, pairs, words, percent).checkpoint()
    dealt = in_collision(placed(posts, links), held, percent).checkpoint()
    for best in (True, False):
        if not best:  # components have grown: posts without a partner in another one are left behind
            dealt = blocks_of(placed(dealt.select("post", "rep", "n", "mask").distinct(), links))
        pairs = candidates(dealt, held, percent, best).checkpoint()
        links = links.union(confirmed(texts, pairs, words, percent)).checkpoint()
    final = components(links)

    of_class = (classes.select("key", "n", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left")
                .select("key", "n", F.coalesce("comp", "rep").alias("comp")))
    sizes = base.where("n > 0").groupBy("key", "n").agg(F.count(F.lit(1)).alias("size"))
    known = join_counted(base.where("n > 0").select("id", "n", "key"), of_class.join(sizes, ["key", "n"]), ["key", "n"], "size", max(1, base.count()), "id")
    # rows that share a doc_id have one component
    out = known.select("id", "n", "comp").union(base.where("n = 0").select("id", "n", F.col("id").alias("comp")))
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(back("id").alias("doc_id"), F.col("n").alias("n_shingles"), back("comp").alias("component_id"), (F.col("id") == F.col("comp")).alias("kept"))


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's."""
    name = next(n for n in (f"_kept{i}" for i in range(len(docs.columns) + 1)) if n not in {c.lower() for c in docs.columns})
    found = near_duplicates(docs, words, percent).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi")
