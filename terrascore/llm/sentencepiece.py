"""SentencePiece encoding by sampling, and decoding.

A text is one of many sequences of pieces. Forward filtering sums, at each place of the
piece lattice, the weights of all ways to get there; backward sampling then
draws the last piece, the one before, and so on, each with its share of that
sum, so that a segmentation comes with its exact probability. The
random numbers are a hash of the seed, the row's key and the place in the
text: a row's segmentation is the same however the rows are dealt, and again after
a lost task.

A piece's weight follows Zipf's law in its rank in the model, raised to ``alpha``
(larger: fewer, more frequent pieces). A character that is no piece is spelled
in byte pieces. A lattice spans a run of spaces with what follows up to the next
space or line break (pieces don't go beyond), and each run of text works out a distinct
one once. A space is put before the text, as usual; decoding joins the pieces'
bytes and takes it off again, so the round trip gives every text back.

A null text counts as empty and gives no pieces; a null key is a key of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import int_column, mix, prefix_hash, runs, ship, span_hash, text_view

#: Longer lattices are filtered one by one, with logarithms.
LOCKSTEP = 48
#: Weights are scaled by this for each byte, so that sums stay in range (it cancels out).
SCALE = 256.0
SPACE = "▁"


class Pieces:
    """A model's pieces by bytes: ids, weights, and a hash table to look up spans of text."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.surface: list[bytes] = [b""] * model.get_piece_size()
        self.byte = np.full(256, -1, np.int64)
        order, ids = [], []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)) and SPACE not in piece.lstrip(SPACE):
                self.surface[i] = piece.replace(SPACE, " ").encode()
                order.append(-model.get_score(i))
                ids.append(i)
        if (self.byte < 0).any():
            raise ValueError("a model with byte fallback is needed")
        rank = np.empty(len(ids))
        rank[np.argsort(order, kind="stable")] = np.arange(len(ids))
        self.weight = np.zeros(len(self.surface))
        self.weight[ids] = (rank + 10.0) ** -alpha
        self.weight[self.byte] = (len(ids) + 10.0) ** -alpha
        self.longest = max(len(self.surface[i]) for i in ids)
        whole = np.frombuffer(b"".join(self.surface[i] for i in ids), np.uint8)
        end = np.cumsum([len(self.surface[i]) for i in ids])
        h = span_hash(prefix_hash(whole), np.r_[0, end[:-1]], end)
        self.mask = np.uint64((1 << (4 * len(ids)).bit_length()) - 1)
        self.slots = np.zeros(int(self.mask) + 1, np.uint64)
        self.ids = np.full(len(self.slots), -1, np.int32)
        left, chosen = h, np.array(ids, np.int32)
        shift = np.uint64(0)
        while len(left):  # open addressing; all that still look for a place try their next slot
            at = (left + shift & self.mask).astype(np.int64)
            _, first = np.unique(at, return_index=True)
            first = first[self.ids[at[first]] < 0]
            self.slots[at[first]], self.ids[at[first]] = left[first], chosen[first]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, chosen, shift = left[rest], chosen[rest], shift + np.uint64(1)
        self.tries = int(shift)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, or -1."""
        out = np.full(len(h), -1, np.int32)
        open_ = np.arange(len(h))
        for t in range(self.tries):
            at = (h[open_] + np.uint64(t) & self.mask).astype(np.int64)
            ids = self.ids[at]
            hit = self.slots[at] == h[open_]
            hit &= ids >= 0
            out[open_[hit]] = ids[hit]
            open_ = open_[~hit & (ids >= 0)]
            if not len(open_):
                break
        return out


def lattices(data: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, ...]:
    """Forward filtering of the given spans: for each byte place, the edges that end behind it (in order of
    length): first edge by place, and by edge its cumulative share, length and piece."""
    size = end - start
    base = np.r_[0, np.cumsum(size)]
    text = data[np.repeat(start - base[:-1], size) + np.arange(base[-1])]
    room = np.repeat(base[1:], size) - np.arange(len(text))  # bytes to the end of the span
    p = prefix_hash(text)
    lead = (text & 0xC0) != 0x80
    char = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
    froms, tos, ids = [], [], []
    covered = np.zeros(len(text) + 4, bool)
    for n in range(1, min(pieces.longest, int(size.max(initial=0))) + 1):
        at = np.flatnonzero((room >= n) & lead)
        found = pieces.find(span_hash(p, at, at + n))
        at, found = at[found >= 0], found[found >= 0]
        froms.append(at), tos.append(at + n - 1), ids.append(found)
        whole = at[char[at] == n]
        for k in range(n if n <= 4 else 0):
            covered[whole + k] = True
    spelled = np.flatnonzero(~covered[:len(text)])
    froms.append(spelled), tos.append(spelled), ids.append(pieces.byte[text[spelled]].astype(np.int32))
    a, b, piece = np.concatenate(froms), np.concatenate(tos), np.concatenate(ids)
    length = b - a + 1
    o = np.lexsort((length, b))
    a, b, piece, length = a[o], b[o], piece[o], length[o]
    first = np.searchsorted(b, np.arange(len(text) + 1))
    weight = pieces.weight[piece] * SCALE ** np.minimum(length, LOCKSTEP)
    # sums by place, in step over all spans: the place before a span's first byte has the sum 1
    total = np.zeros(len(text))
    depth = np.arange(len(text)) - np.repeat(base[:-1], size)
    edge_depth = depth[b]
    span_size = np.repeat(size, size)
    short = span_size[b] <= LOCKSTEP
    by_depth = np.argsort(np.where(short, edge_depth, LOCKSTEP), kind="stable")
    bounds = np.searchsorted(np.where(short, edge_depth, LOCKSTEP)[by_depth], np.arange(LOCKSTEP + 1))
    share = np.zeros(len(b))
    for d in range(LOCKSTEP):
        e = by_depth[bounds[d]:bounds[d + 1]]
        if not len(e):
            continue
        before = np.where(length[e] > d, 1.0, total[a[e] - 1])
        share[e] = before * weight[e]
        head = np.flatnonzero(np.r_[True, b[e][1:] != b[e][:-1]])  # edges of one place stand together
        total[b[e][head]] = np.add.reduceat(share[e], head)
    ok = np.flatnonzero(short)
    share[ok] /= total[b[ok]]
    for s in np.flatnonzero(size > LOCKSTEP):
        forward_logs(base[s], base[s + 1], first, a, pieces.weight[piece], share)
    # cumulative shares of the edges of a place; the last is 1
    run = np.cumsum(share)
    has = first[:-1] < first[1:]
    zero = np.where(has, run[np.minimum(first[:-1], len(run) - 1)] - share[np.minimum(first[:-1], len(run) - 1)], 0) if len(run) else np.zeros(len(text))
    cumulative = run - zero[b]
    cumulative[first[1:][has] - 1] = 2.0
    return base, first, cumulative, length, piece


def forward_logs(low: int, high: int, first: np.ndarray, a: np.ndarray, weight: np.ndarray, share: np.ndarray) -> None:
    """One long span: shares of the edges that end at each place."""
    total = np.full(high - low + 1, -np.inf)
    total[0] = 0.0
    for b in range(low, high):
        i, j = first[b], first[b + 1]
        if i == j:
            continue
        logs = total[a[i:j] - low] + np.log(weight[i:j])
        top = logs.max()
        if top == -np.inf:
            continue
        each = np.exp(logs - top)
        total[b - low + 1] = top + np.log(each.sum())
        share[i:j] = each / each.sum()


def encode_run(data: np.ndarray, off: np.ndarray, keys: np.ndarray, seed: int, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Sampled pieces of all rows in turn, and the number of them before each row."""
    size = np.diff(off)
    filled = size > 0
    moved = off + np.r_[0, np.cumsum(filled)]  # each row that isn't empty gets a space in front
    text = np.full(moved[-1], 32, np.uint8)
    text[np.arange(len(data)) + np.repeat(np.cumsum(filled), size)] = data
    if not len(text):
        return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    edge = np.zeros(len(text), bool)
    edge[moved[:-1][filled]] = True
    space, line = text == 32, text == 10
    edge[1:] |= (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    start = np.flatnonzero(edge)
    end = np.r_[start[1:], len(text)]
    h = np.empty(len(start), np.uint64)
    for i in range(0, len(start), 1 << 17):
        s, e = start[i:i + (1 << 17)], end[i:i + (1 << 17)]
        h[i:i + (1 << 17)] = span_hash(prefix_hash(text[s[0]:e[-1]]), s - s[0], e - s[0])
    _, once, which = np.unique(h, return_index=True, return_inverse=True)
    base, first, cumulative, length, piece = lattices(text, start[once], end[once], pieces)
    out = np.full(len(text), -1, np.int32)
    row_key = mix(keys.astype(np.uint64) ^ np.uint64(seed & (1 << 64) - 1))
    row = np.searchsorted(moved, start, "right") - 1
    # from the end of every span to its start, all in step; place: the last byte not yet covered
    origin = base[which]
    place, shift, noise = base[which + 1] - 1, start - origin, row_key[row] - (moved[row]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    while len(place):
        u = (mix(noise + (place + shift).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        e = first[place]
        more = np.flatnonzero(cumulative[e] <= u)
        while len(more):
            e[more] += 1
            more = more[cumulative[e[more]] <= u[more]]
        place = place - length[e]
        out[place + shift + 1] = piece[e]
        alive = place >= origin
        place, shift, noise, origin = place[alive], shift[alive], noise[alive], origin[alive]
    used = out >= 0
    return out[used].astype(np.uint32), np.r_[0, np.cumsum(used)][moved]


def decode_ids(ids: np.ndarray, surface: list[bytes]) -> bytes:
    return b"".join(map(surface.__getitem__, ids.tolist()))[1:]


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, alpha: float, seed: int, verify: bool) -> Iterator[pa.RecordBatch]:
    pieces = None
    for batch in batches:
        pieces = pieces or Pieces(path, alpha)
        keys = int_column(batch, "__key")
        for i, j, data, off in runs(batch, limit=4 << 20):
            ids, at = encode_run(data, off, keys[i:j], seed, pieces)
            raw = ids.astype("<u4").tobytes()
            part = batch.slice(i, j - i)
            columns = [*(part.column(c) for c in range(2, part.num_columns)), pa.array([raw[4 * a:4 * b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())]
            names = [*part.schema.names[2:], "ids"]
            if verify:
                whole = data.tobytes()
                columns.append(pa.array([decode_ids(ids[a:b], pieces.surface) == whole[x:y] for a, b, x, y in
                                         zip(at[:-1], at[1:], off[:-1], off[1:], strict=True)]))
                names.append("lossless")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def encode_sampled(docs: DataFrame, model: str, key: str = "doc_id", alpha: float = 1.0, seed: int = 0, verify: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text, and ``ids`` (little-endian unsigned 32 bit); with ``verify``, also
    ``lossless``: whether decoding gives the text back."""
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("text", "ids", "lossless")]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    rows = docs.select(F.xxhash64(F.col(key).cast("string")).alias("__key"), F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`") for c in others])
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), "ids binary", *["lossless boolean"] * verify])
    return rows.mapInArrow(lambda it: encode_batches(it, model, alpha, seed, verify), schema)


def decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    surface = None
    for batch in batches:
        surface = surface or Pieces(path, 1.0).surface
        at = batch.schema.get_field_index("ids")
        data, off = text_view(batch.column(at))
        ids = data.tobytes()
        text = [decode_ids(np.frombuffer(ids[a:b], "<u4"), surface).decode() for a, b in zip(off[:-1], off[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), pa.array(text, pa.string())],
                                         names=[*(x for i, x in enumerate(batch.schema.names) if i != at), "text"])


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The columns of ``encoded`` with ``text`` in place of ``ids``."""
    ship(encoded.sparkSession)
    others = [f for f in encoded.schema.fields if f.name not in ("ids", "text")]
    rows = encoded.select(*[F.col(f"`{f.name}`") for f in others], F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(lambda it: decode_batches(it, model), ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "text string"]))
