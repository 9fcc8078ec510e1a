"""Suffix-array dedup: remove passages that also stand earlier in the corpus.

A byte goes when a string of ``length`` bytes that covers it also starts
earlier (smaller doc_id, or the same document further left). Only suffixes at
anchors are sorted: an anchor is the position with the smallest k-mer hash
among the k-mers of a window of ``length`` bytes, so equal windows have the same
anchor at the same place, and one suffix in about 32 stands for all of them.

1. Anchors whose k-mer stands once in the corpus can't be part of a repeat. The
   hashes of all anchors are exchanged (each run's distinct ones), and the
   places of those that stand more than once go back to their documents.
2. Each run of texts (RUN_BYTES) sorts its remaining suffixes, with their common
   prefixes, and settles the windows that repeat inside the run. Of equal
   windows only the first goes on, so a passage that a third of all documents
   share leaves a run once.
3. The sorted runs are exchanged front-coded: of each suffix only what follows
   the prefix it shares with the one before. The hash of the anchor's k-mer
   names the partition, so frequent first letters make no hot partition. The
   windows of a k-mer with more than HOT_ANCHORS anchors go one by one, each by the hash of its
   own bytes: those that cross the edges of a common passage differ in
   every document and so are spread, and equal ones still meet.
4. Each partition combines its runs with a loser tree. It holds the common
   prefix of each run's head with the last suffix put out; heads with different
   ones are ordered by these alone, and equal ones are compared from there on.
5. In the merged order, equal right sides are neighbours whose common prefix is
   long enough; the left sides are sorted likewise. Both together decide each
   window exactly, on the bytes.

The texts are dealt by doc_id and text hash once; steps 2 and the removal both read that exchange.

Null text counts as empty and a null doc_id as the smallest one. Rows with the
same doc_id are one place in the order: what stands at the same place in them stays in all.
Places and spans belong to a doc_id and the 64-bit hash of the text, so rows that share a doc_id don't
meet each other's, and repeated rows are sorted once a run. An empty table gives an empty one, and other
columns of any name or type are carried along. A very long text makes a run of its own, in memory as one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .common import BYTE_HASH, binary_batch, int_column, mix, pack, prefix_hash, powers, releasing, runs, shuffle_partitions, ship, text_view, unpack

#: k-mers of one window; a power of two, so that minima are found by doubling.
WINDOW_KMERS = 64
SECTION = 1 << 20
#: Anchors of one k-mer that one task merges; and hot anchors whose windows are laid out at a time.
HOT_ANCHORS, PIECE = 1 << 15, 1 << 12
#: Hot k-mers that the tasks are told of, those with the most anchors first (8 MB); the windows of any others are merged, with the same result.
HOT_KMERS = 1 << 20
_ONE = np.uint64(1)


def anchors(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows inside rows: place, most and least bytes of a window before it, k-mer hash."""
    k, out = length - WINDOW_KMERS + 1, []
    row_end = off[1:][np.diff(off) >= length]
    row_start = off[:-1][np.diff(off) >= length]
    low = np.uint64((1 << 40) - 1 << 24)
    for a in range(0, len(data), SECTION):
        part = data[a:a + SECTION + length - 1]
        if len(part) < length:
            break
        p = prefix_hash(part)
        _, down = powers(len(p))
        h = mix((p[k:] - p[:-k]) * down[:len(p) - k])
        m = (h & low) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step < WINDOW_KMERS:
            m = np.minimum(m[:-step], m[step:])
            step *= 2
        # windows that lie inside a row
        inside = np.zeros(len(m) + 1, np.int8)
        i, j = np.searchsorted(row_end, a, "right"), np.searchsorted(row_start, a + len(m))
        first, last = np.maximum(row_start[i:j] - a, 0), np.minimum(row_end[i:j] - length + 1 - a, len(m))
        ok = first < last
        np.add.at(inside, first[ok], 1)
        np.add.at(inside, last[ok], -1)
        s = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
        if not len(s):
            continue
        at = (m[s] & np.uint64((1 << 24) - 1)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        end = np.r_[new[1:], len(s)] - 1
        place = at[new]
        out.append((place + a, place - s[new], place - s[end], h[place]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """Rows of ``width`` bytes from each start, ``size`` of them real and the rest zero."""
    col = np.arange(width)
    at = start[:, None] + step * col
    return np.where(col < size[:, None], data[np.clip(at, 0, max(len(data) - 1, 0))], 0).astype(np.uint8)


def strings(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").reshape(-1)


def common(rows: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before (0 for the first)."""
    if len(rows) < 2:
        return np.zeros(len(rows), np.int64)
    differ = rows[1:] != rows[:-1]
    n = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.r_[0, n].astype(np.int64)


def repeats(lcp: np.ndarray, left: np.ndarray, mask: np.ndarray, doc: np.ndarray, pos: np.ndarray, length: int) -> np.ndarray:
    """Which windows of suffixes in sorted order also start earlier.

    lcp: common prefix with the suffix before. left: reversed bytes before each
    anchor. mask: bit b stands for the window that starts b bytes before the
    anchor. doc, pos: the anchor's place."""
    k, n = length - WINDOW_KMERS + 1, len(lcp)
    gone = np.zeros(n, np.uint64)
    group = np.cumsum(lcp < k)
    size = np.bincount(group)
    keep = np.flatnonzero((size > 1)[group])
    if not len(keep):
        return gone
    # classes of right sides are runs of the sorted order; dropped groups only break it at their edges
    lcp, left, group = np.where(np.r_[True, np.diff(keep) > 1], 0, lcp[keep]), left[keep], group[keep]
    by_left = np.lexsort((strings(left), group))
    shared = np.where(np.r_[True, np.diff(group[by_left]) > 0], -1, common(left[by_left]))
    place = np.empty(len(keep), np.int64)
    place[by_left] = np.arange(len(keep))
    rank = np.lexsort((pos[keep], doc[keep]))  # earlier first
    mk, dk, pk = mask[keep], doc[keep], pos[keep]
    found = np.zeros(len(keep), np.uint64)
    for b in range(WINDOW_KMERS):
        bit = _ONE << np.uint64(b)
        sel = rank[(mk[rank] & bit) != 0]
        if len(sel) < 2:
            continue
        right = np.cumsum(lcp < length - b)
        key = right[sel] * (len(keep) + 1) + np.cumsum(shared < b)[place[sel]]
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        head = sel[first][which]
        later = (dk[sel] != dk[head]) | (pk[sel] != pk[head])
        found[sel[later]] |= bit
    gone[keep] = found
    return gone


def window_rows(mask: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows of each mask: index of the mask, start."""
    who, start = [], []
    for b in range(WINDOW_KMERS):
        i = np.flatnonzero(mask & (_ONE << np.uint64(b)))
        who.append(i)
        start.append(pos[i] - b)
    return np.concatenate(who), np.concatenate(start)


def spans(key: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite the windows of each key to maximal runs: key, start, end."""
    o = np.lexsort((start, key))
    key, start = key[o], start[o]
    new = np.r_[True, (key[1:] != key[:-1]) | (start[1:] > start[:-1] + length)] if len(key) else np.zeros(0, bool)
    i = np.flatnonzero(new)
    return key[i], start[i], start[np.r_[i[1:] - 1, len(key) - 1]] + length if len(i) else start[i]


class LoserTree:
    """Merge sorted runs of byte strings; every match is decided from the known
    common prefixes with the last string put out, so these are not compared again."""

    def __init__(self, texts: list[list[bytes]], lcps: list[list[int]]):
        self.texts, self.lcps, k = texts, lcps, 1
        while k < len(texts):
            k *= 2
        self.k = k
        self.at = [0] * k
        self.head: list[bytes | None] = [t[0] if t else None for t in texts] + [None] * (k - len(texts))
        self.known = [0] * k  # common prefix of the run's head with the last winner
        self.loser = [-1] * k
        level = list(range(k))
        node = [0] * (2 * k)
        node[k:] = level
        for i in range(k - 1, 0, -1):
            node[i], self.loser[i] = self.play(node[2 * i], node[2 * i + 1])
        self.top = node[1]

    def play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes the one with the winner."""
        x, y = self.head[a], self.head[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        h, g = self.known[a], self.known[b]
        if h != g:
            return (a, b) if h > g else (b, a)
        if x == y:
            first, second = min(a, b), max(a, b)
            self.known[second] = len(x)
            return first, second
        n = min(len(x), len(y))
        while h + 16 <= n and x[h:h + 16] == y[h:h + 16]:
            h += 16
        while h < n and x[h] == y[h]:
            h += 1
        if x[h:] < y[h:]:
            self.known[b] = h
            return a, b
        self.known[a] = h
        return b, a

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """Run, index in it, and common prefix with the string put out before."""
        at, head, known, loser, k, top = self.at, self.head, self.known, self.loser, self.k, self.top
        while head[top] is not None:
            i = at[top]
            yield top, i, known[top]
            at[top] = i = i + 1
            run = self.texts[top]
            if i < len(run):
                head[top], known[top] = run[i], self.lcps[top][i]
            else:
                head[top] = None
            node = (top + k) >> 1
            while node:
                rival = loser[node]
                if head[rival] is not None and (head[top] is None or known[rival] >= known[top]):
                    top, loser[node] = self.play(top, rival)
                node >>= 1
            self.top = top


def first_rows(doc: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """Whether each row is the first with its doc_id and text."""
    o, out = np.lexsort((tag, doc)), np.ones(len(doc), bool)
    out[o[1:][(doc[o[1:]] == doc[o[:-1]]) & (tag[o[1:]] == tag[o[:-1]])]] = False
    return out


def anchor_hashes(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Each run's distinct anchor hashes, with the place of those that stand once in
    it or else their number (kind 0), and the places of the others (kind 1). Without a column __tag, a doc_id is one text."""
    names = ["pid", "kind", "value"]
    for batch in batches:
        ids = int_column(batch, "doc_id")
        tags = int_column(batch, "__tag") if "__tag" in batch.schema.names else np.zeros(len(ids), np.int64)
        for i, j, data, off in runs(batch):
            pos, most, least, h = anchors(data, off, length)
            if not len(pos):
                continue
            doc, tag, row = ids[i:j], tags[i:j], np.searchsorted(off, pos, "right") - 1
            new = first_rows(doc, tag)[row]
            pos, most, least, h, row = pos[new], most[new], least[new], h[new], row[new]
            place = (pos - off[row]) << 16 | most << 8 | least
            _, first, which, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            again = count[which] > 1
            values, pids, kinds = [pack(doc[row[again]], tag[row[again]], place[again])], [int(h[0] % np.uint64(parts))], [1]
            first = np.sort(first)  # text order, in which places pack well
            pid = ((h[first] >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)
            first = first[np.argsort(pid, kind="stable")]
            bounds = np.searchsorted(np.sort(pid), np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(bounds)):
                s = first[bounds[p]:bounds[p + 1]]
                once = s[~again[s]]
                more = s[again[s]]
                values.append(pack(h[np.r_[once, more]] >> np.uint64(24), doc[row[once]], tag[row[once]], place[once], count[which[more]].astype(np.int32)))
                pids.append(p)
                kinds.append(0)
            yield binary_batch(names, pa.array(pids, pa.int32()), pa.array(kinds, pa.int32()), pa.array(values, pa.binary()))


def shared_anchors(batches: Iterator[pa.RecordBatch], bound: int = HOT_ANCHORS) -> Iterator[pa.RecordBatch]:
    """Places (doc_id, tag, place) of the anchors whose hash stands more than once, and the hashes (null, number, hash) that more than ``bound`` have."""
    got: list[list[np.ndarray]] = []

    def out(doc, tag, place):
        for i in range(0, len(doc), 50_000):
            yield binary_batch(["doc_id", "tag", "place"], doc[i:i + 50_000], tag[i:i + 50_000], place[i:i + 50_000])

    for batch in batches:
        for kind, value in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if kind == 1:
                yield from out(*unpack(value))
            else:
                got.append(unpack(value))
    if got:
        hashes, which, count = np.unique(np.concatenate([x[0] for x in got]), return_inverse=True, return_counts=True)
        many, at = count[which] > 1, 0
        anchors_of = np.bincount(which, np.concatenate([np.r_[np.ones(len(doc)), more] for _, doc, _, _, more in got]))
        hot = anchors_of > bound
        if hot.any():
            yield from out(pa.nulls(int(hot.sum()), pa.int64()), anchors_of[hot].astype(np.int64), hashes[hot].astype(np.int64))
        for h, doc, tag, place, _ in got:
            keep = many[at:at + len(doc)]
            at += len(h)
            yield from out(doc[keep], tag[keep], place[keep])


def given_anchors(data: np.ndarray, off: np.ndarray, places: pa.ListArray, length: int) -> tuple[np.ndarray, ...]:
    """The anchors named for each row: row, place, most and least bytes of a window before it, k-mer hash."""
    code = np.asarray(places.flatten(), dtype=np.int64)
    row = np.repeat(np.arange(len(places)), np.diff(np.asarray(places.offsets)))
    most, least = code >> 8 & 255, code & 255
    pos = (code >> 16) + off[row]
    fits = (pos - most >= off[row]) & (pos - least + length <= off[row + 1])  # places of another text with this doc_id and hash need not
    row, pos, most, least = row[fits], pos[fits], most[fits], least[fits]
    h = np.zeros(len(pos), np.uint64)
    up, _ = powers(length)
    for c in range(length - WINDOW_KMERS + 1):  # as anchors() has it
        h += BYTE_HASH[data[pos + c]] * up[c]
    return row, pos, most, least, mix(h)


def spread_windows(data: np.ndarray, pos: np.ndarray, mask: np.ndarray, doc: np.ndarray, tag: np.ndarray, off: np.ndarray, length: int, parts: int) -> Iterator[tuple[int, bytes]]:
    """The windows of hot anchors, with all their bytes, for the partition that these name. off: where each anchor's row starts."""
    up, _ = powers(length)
    for i in range(0, len(pos), PIECE):
        who, start = window_rows(mask[i:i + PIECE], pos[i:i + PIECE])
        who += i
        rows = data[start[:, None] + np.arange(length)]
        h = np.zeros(len(rows), np.uint64)
        for c in range(length):
            h += BYTE_HASH[rows[:, c]] * up[c]
        pid = ((mix(h) >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)
        o = np.lexsort((strings(rows), pid))  # like windows pack well together
        bounds = np.searchsorted(pid[o], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(bounds)):
            s = o[bounds[p]:bounds[p + 1]]
            yield int(p), pack(rows[s], doc[who[s]], tag[who[s]], start[s] - off[who[s]])


def sorted_runs(batches: Iterator[pa.RecordBatch], length: int, parts: int, hot: np.ndarray = np.zeros(0, np.uint64)) -> Iterator[pa.RecordBatch]:
    """Front-coded sorted runs (kind 0), the spans settled inside a run (kind 1), and the windows of the ``hot`` k-mers (kind 2)."""
    names = ["pid", "kind", "value"]
    for batch in batches:
        ids, tags = int_column(batch, "__key"), int_column(batch, "__tag")
        places = batch.column(batch.schema.get_field_index("__places"))
        for i, j, data, off in runs(batch):
            doc, tag = ids[i:j], tags[i:j]
            row, pos, most, least, h = given_anchors(data, off, places.slice(i, j - i), length)
            new = first_rows(doc, tag)[row]
            row, pos, most, least, h = row[new], pos[new], most[new], least[new], h[new]
            if not len(pos):
                continue
            right = gather(data, pos, length - least, length)
            o = np.argsort(strings(right), kind="stable")
            pos, most, least, h, row, right = pos[o], most[o], least[o], h[o], row[o], right[o]
            lcp = common(right)
            mask = (~np.uint64(0) >> (np.uint64(WINDOW_KMERS - 1) - most.astype(np.uint64))) & (~np.uint64(0) << least.astype(np.uint64))
            left = gather(data, pos - 1, most, WINDOW_KMERS - 1, -1)
            gone = repeats(lcp, left, mask, doc[row], pos - off[row], length)
            who, start = window_rows(gone, pos)
            if len(who):
                r, a, b = spans(row[who], start, length)
                yield binary_batch(names, pa.array([int(h[0] % np.uint64(parts))], pa.int32()), pa.array([1], pa.int32()),
                                   [pack(doc[r], tag[r], a - off[r], b - off[r])])
            mask &= ~gone
            if len(hot):
                s = np.flatnonzero(np.isin(h >> np.uint64(24), hot) & (mask != 0))
                for p, value in spread_windows(data, pos[s], mask[s], doc[row[s]], tag[row[s]], off[row[s]], length, parts):
                    yield binary_batch(names, pa.array([p], pa.int32()), pa.array([2], pa.int32()), [value])
                mask[s] = 0
            pid = (h >> np.uint64(24)) % np.uint64(parts)
            order = np.argsort(pid, kind="stable")
            order = order[mask[order] != 0]
            bounds = np.searchsorted(pid[order], np.arange(parts + 1))
            values, pids = [], []
            for p in np.flatnonzero(np.diff(bounds)):
                s = order[bounds[p]:bounds[p + 1]]
                bits = mask[s]
                far = length - least[s]  # right bytes; as they were sorted
                near = np.frexp(bits.astype(np.float64))[1] - 1  # left bytes needed
                near -= (_ONE << np.minimum(near, 63).astype(np.uint64)) > bits  # rounding of large masks
                head = common(right[s])
                tail = np.arange(length)
                values.append(pack(doc[row[s]], tag[row[s]], pos[s] - off[row[s]], bits, head.astype(np.uint8), far.astype(np.uint8),
                                   near.astype(np.uint8), right[s][(tail >= head[:, None]) & (tail < far[:, None])],
                                   left[s][tail[:WINDOW_KMERS - 1] < near[:, None]]))
                pids.append(p)
            yield binary_batch(names, pa.array(pids, pa.int32()), pa.array([0] * len(pids), pa.int32()), pa.array(values, pa.binary()))


def decode(run: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The right and left bytes of a front-coded run."""
    head, far, near, tail, before = run[4:]
    n, col = len(head), np.arange(length)
    right = np.zeros((n, length), np.uint8)
    own = (col >= head[:, None]) & (col < far[:, None])
    right[own] = tail
    row = np.arange(n)
    for c in range(int(head.max(initial=0))):  # a byte of the shared prefix stands in the last row that brought it
        right[:, c] = right[np.maximum.accumulate(np.where(head <= c, row, 0)), c]
    left = np.zeros((n, WINDOW_KMERS - 1), np.uint8)
    left[np.arange(WINDOW_KMERS - 1) < near[:, None]] = before
    return right, left


def equal_windows(found: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, tag and start of the windows that also start earlier; found: the windows' bytes, doc_id, tag, start."""
    rows, doc, tag, pos = (np.concatenate(x) for x in zip(*found, strict=True))
    o = np.lexsort((pos, doc, strings(rows)))  # earlier first
    rows, doc, tag, pos = rows[o], doc[o], tag[o], pos[o]
    new = np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    gone = (doc != doc[head]) | (pos != pos[head])
    return doc[gone], tag[gone], pos[gone]


def united(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Unite the windows of each text: doc_id, tag, start, end."""
    o, which = np.lexsort((tag, doc)), np.empty(len(doc), np.int64)
    new = np.r_[True, (doc[o[1:]] != doc[o[:-1]]) | (tag[o[1:]] != tag[o[:-1]])]
    which[o] = np.cumsum(new) - 1
    key, a, b = spans(which, start, length)
    return doc[o[new]][key], tag[o[new]][key], a, b


def merge_runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Merge all runs of a partition; spans to remove: doc_id, tag, start, end."""
    names, k = ["doc_id", "tag", "a", "b"], length - WINDOW_KMERS + 1
    got: list[list[np.ndarray]] = []
    windows: list[list[np.ndarray]] = []

    def out(doc, tag, a, b):
        for i in range(0, len(doc), 50_000):
            yield binary_batch(names, doc[i:i + 50_000], tag[i:i + 50_000], a[i:i + 50_000], b[i:i + 50_000])

    for batch in batches:
        for kind, value in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if kind == 1:
                yield from out(*unpack(value))
            else:
                (got if kind == 0 else windows).append(unpack(value))
    if windows:
        doc, tag, start = equal_windows(windows)
        windows.clear()
        if len(doc):
            yield from out(*united(doc, tag, start, length))
    if not got:
        return
    # k-mers that stand once need no merge
    hashes, own = [], []
    for run in got:
        right, left = decode(run, length)
        h = np.zeros(len(right), np.uint64)
        for c in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + right[:, c] + _ONE
        hashes.append(mix(h))
        own.append((right, left))
    _, which, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    many, at, kept = count[which] > 1, 0, []
    for run, (right, left) in zip(got, own, strict=True):
        keep = many[at:at + len(right)]
        at += len(right)
        kept.append([*(x[keep] for x in run[:4]), right[keep], left[keep]])
    del got, own, hashes, which, many
    texts = [[r.tobytes() for r in x[4]] for x in kept]
    tree = LoserTree(texts, [common(x[4]).tolist() for x in kept])
    base = np.cumsum([0, *(len(t) for t in texts)])
    if not base[-1]:
        return
    order, lcp = np.empty(base[-1], np.int64), np.empty(base[-1], np.int64)
    starts = base.tolist()
    for n, (run, i, shared) in enumerate(tree):
        order[n], lcp[n] = starts[run] + i, shared
    doc, tag, pos, mask, _, left = (np.concatenate([x[c] for x in kept])[order] for c in range(6))
    del kept, texts, tree
    gone = repeats(lcp, left, mask, doc, pos, length)
    who, start = window_rows(gone, pos)
    if len(who):
        yield from out(*united(doc[who], tag[who], start, length))


#: What ``remove_repeats`` returns of each text: column and type.
KEPT = {"bytes": ("kept", "binary"), "text": ("kept_text", "string"), "sha256": ("kept_sha256", "string")}


def cut(batches: Iterator[pa.RecordBatch], kept_as: str) -> Iterator[pa.RecordBatch]:
    """Remove the spans of each row from its text."""
    for batch in batches:
        data, off = text_view(batch.column(batch.schema.get_field_index("text")))
        whole = data.tobytes()
        kept, size, gone, count = [], [], [], []
        for i, found in enumerate(batch.column(batch.schema.get_field_index("__spans")).to_pylist()):
            row, parts, at, removed, n, end = whole[off[i]:off[i + 1]], [], 0, 0, 0, -1
            for a, b in sorted((x["a"], x["b"]) for x in found or ()):
                n += a > end
                end = max(end, b)
                if b > at:
                    parts.append(row[at:max(a, at)])
                    removed += b - max(a, at)
                    at = b
            parts.append(row[at:])
            kept.append(b"".join(parts))
            size.append(len(row))
            gone.append(removed)
            count.append(n)
        extra = [pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64())]
        if kept_as == "sha256":
            extra.append(pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))
        elif kept_as == "text":
            extra.append(pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()))
        else:
            extra.append(pa.array(kept, pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("__rest")), *extra],
                                         names=["__rest", "n_bytes", "n_removed", "n_spans", KEPT[kept_as][0]])


def remove_repeats(docs: DataFrame, length: int = 100, kept_as: str = "bytes") -> DataFrame:
    """The columns of ``docs`` but the text, n_bytes, n_removed, n_spans and what is kept of the text, as KEPT names it:
    the bytes, the text (code points cut apart are left out), or the bytes' SHA-256."""
    if not WINDOW_KMERS < length < 256:
        raise ValueError(f"length must lie between {WINDOW_KMERS + 1} and 255")
    spark = docs.sparkSession
    ship(spark)
    ensure_checkpoint_dir(spark)
    parts, bound = shuffle_partitions(spark), HOT_ANCHORS
    name, kind = KEPT[kept_as]
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_bytes", "n_removed", "n_spans", name)]
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))
    rows = docs.select(F.struct(*others).alias("__rest"), "text", key.alias("__key"), F.xxhash64("text").alias("__tag"))

    hashes = rows.select(F.col("__key").alias("doc_id"), "__tag", "text").mapInArrow(lambda it: releasing(anchor_hashes(it, length, parts)), "pid int, kind int, value binary")
    places = hashes.repartitionById(parts, F.col("pid")).mapInArrow(lambda it: releasing(shared_anchors(it, bound)), "doc_id long, tag long, place long")
    by_doc = places.groupBy(F.col("doc_id").alias("__id"), F.col("tag").alias("__of")).agg(F.collect_set("place").alias("__places")).checkpoint()
    hottest = by_doc.where("__id IS NULL").select("__of", F.explode("__places").alias("h")).orderBy(F.desc("__of"), "h").limit(HOT_KMERS)
    hot = spark.sparkContext.broadcast(np.array([r["h"] for r in hottest.collect()], np.int64).astype(np.uint64))
    same = (F.col("__key") == F.col("__id")) & (F.col("__tag") == F.col("__of"))
    front = rows.join(by_doc, same).mapInArrow(lambda it: releasing(sorted_runs(it, length, parts, hot.value)), "pid int, kind int, value binary")
    spans_found = front.repartitionById(parts, F.col("pid")).mapInArrow(lambda it: releasing(merge_runs(it, length)), "doc_id long, tag long, a long, b long")
    found = spans_found.groupBy(F.col("doc_id").alias("__id"), F.col("tag").alias("__of")).agg(F.collect_set(F.struct("a", "b")).alias("__spans"))
    schema = T.StructType([rows.schema["__rest"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField(name, T.BinaryType() if kind == "binary" else T.StringType())])
    out = rows.join(found, same, "left").mapInArrow(lambda it: releasing(cut(it, kept_as)), schema)
    return out.select("__rest.*", "n_bytes", "n_removed", "n_spans", name)
