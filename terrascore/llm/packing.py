"""Packing by powers of two: no sequence crosses documents, and none is padded.

A document's token ids, with the end id, are split into pieces: as many of the
full length as fit, then one for each binary digit of the rest, the longest
first. Each piece is a sequence of its own; sequences of one length form a
bucket, and a batch is drawn from one bucket, so nothing is filled up.

The work is one pass over the documents without a shuffle. White space always
ends a token, so a text's ids are those of its words in turn, and a plain word's
those of its parts (letters, a digit, other signs). A run of texts is cut into
parts by array operations; a worker encodes a distinct part once, as long as it
remembers it. A sequence's id is the number of the input partition and
the piece's number in it, unique also where rows repeat a doc_id, and the same
when a lost task runs again. A null text counts as empty: the end id alone.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import REMEMBERED, lower_ascii, release, runs, ship, trim

#: Distinct words or parts of words that a worker remembers, and as many older ones that it met before those; and bytes of them and their ids.
WORDS_KEPT, BYTES_KEPT = 100_000, 16 << 20
#: Bytes of text that are encoded at once (one longer document makes a longer run), and pieces sent on at once.
RUN, PIECES = 2 << 20, 2_000
#: Words of these characters alone are split here; all others by the tokenizer's own rules.
_PLAIN = re.compile(rb"(?:[\x00-\x7f]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
#: What a byte of a plain word belongs to.
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[32, *range(9, 14)]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT


class WordEncoder:
    """Ids of texts by a tokenizer whose tokens never hold white space.

    New words are encoded by the tokenizer. Where its rules are the usual ones of a
    lower-case byte-level BPE (``SPLIT_RULE``), a plain word is split here and its
    parts go straight to the BPE model, each distinct part once."""

    SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task has its cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        first = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        steps = [x.get("type") for x in (rules.get("normalizer") or {}).get("normalizers", [])]
        self.direct = (first.get("pattern") == {"Regex": self.SPLIT_RULE} and steps == ["NFC", "Replace", "Lowercase"]
                       and all(x["content"].startswith("<|") for x in rules["added_tokens"]))
        self.model = self.tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level BPE shows as themselves
        rest = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def split(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where parts start: those of plain words, lower-cased, and other words whole, as they are. The text so changed, and a flag for each byte."""
        kind = _KIND[data]
        word = kind != _SPACE
        top = np.zeros(len(data) + 1, bool)
        top[off] = True
        top = top[:-1]  # of a row
        first = word.copy()
        first[1:] &= ~word[:-1] | top[1:]
        if not self.direct:
            return data, first
        start = kind == _DIGIT
        start[1:] |= kind[1:] != kind[:-1]
        start &= word
        start |= first
        low = lower_ascii(data)
        odd = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))  # "<|" may begin an added token
        if (high := np.flatnonzero(data >= 128)).size:
            after = data[high - 1] == 0xC3
            plain = after & (data[high] != 0x97) & (data[high] != 0xB7)
            low[high[plain & (data[high] < 0x9F)]] += 32
            odd = np.r_[odd, high[~plain & (data[high] != 0xC3)]]
        at = np.flatnonzero((data == 39) & start)  # an apostrophe and what is cut off with it
        if len(at):
            follows = [np.where((at + k < len(data)) & ~top[np.minimum(at + k, len(data) - 1)], low[np.minimum(at + k, len(data) - 1)].astype(np.int64), 0) for k in (1, 2)]
            one = np.isin(follows[0], list(b"stmd"))
            two = np.isin(follows[0] * 256 + follows[1], [a * 256 + b for a, b in (b"re", b"ve", b"ll")])
            start[at[one | two] + 1] = False
            stop = np.r_[at[one] + 2, at[two] + 3]
            stop = stop[stop < len(data)]
            start[stop] |= word[stop]
        if len(odd):
            begin = np.flatnonzero(first)
            whole = np.zeros(len(begin), bool)
            whole[np.searchsorted(begin, odd, "right") - 1] = True
            inside = np.zeros(len(data), bool)
            inside[begin[0]:] = np.repeat(whole, np.diff(np.r_[begin, len(data)]))
            start[inside] = first[inside]
            low[inside] = data[inside]
        return low, start

    def learn(self, parts: list[bytes]) -> list[bytes]:
        """Ids of new parts, as little-endian unsigned 32 bit."""
        got, other = [], []
        tokenize, letters = self.model.tokenize, self.letters
        for i, part in enumerate(parts):
            if self.direct and b"<|" not in part and (part.isascii() or _PLAIN.fullmatch(part)):
                got.append([t.id for t in tokenize(part.decode("latin-1").translate(letters))])
            else:
                got.append([])
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch_fast([parts[i].decode() for i in other], add_special_tokens=False), strict=True):
            got[i] = e.ids
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in got]

    def ids_of(self, parts: list[bytes]) -> list[bytes]:
        """Ids of distinct parts. What wasn't met again while as many new parts came is forgotten."""
        if len(self.known) > WORDS_KEPT or self.held > BYTES_KEPT:
            self.known, self.older, self.held = {}, self.known, 0
        known = self.known
        got = list(map(known.get, parts))
        if missing := [i for i, g in enumerate(got) if g is None]:
            found = [self.older.get(parts[i]) for i in missing]
            learned = iter(self.learn([parts[i] for i, g in zip(missing, found, strict=True) if g is None]))
            for i, g in zip(missing, found, strict=True):
                got[i] = known[parts[i]] = ids = next(learned) if g is None else g
                self.held += len(parts[i]) + len(ids)
        return got

    def encode_run(self, data: np.ndarray, off: np.ndarray, end: int) -> tuple[pa.Buffer, np.ndarray]:
        """Ids of all rows in turn, each with the end id, as little-endian unsigned 32 bit; where each row ends."""
        rows = len(off) - 1
        text, start = self.split(data, off) if len(data) else (data, np.zeros(0, bool))
        before = np.searchsorted(np.flatnonzero(start), off)
        word = _KIND[data] != _SPACE
        text = text[word]
        place = np.append(np.flatnonzero(start[word]), len(text))
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(place) - 1, [None, pa.py_buffer(place), pa.py_buffer(text)]).dictionary_encode()
        ids = self.ids_of(parts.dictionary.to_pylist())
        which = np.insert(parts.indices.to_numpy(), before[1:], len(ids))
        out = pa.array([*ids, end.to_bytes(4, "little")], pa.large_binary()).take(pa.array(which))
        _, offsets, raw = out.buffers()
        return raw, np.frombuffer(offsets, np.int64, len(out) + 1)[before[1:] + np.arange(1, rows + 1)] // 4

    def encode(self, rows: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in turn, each with the end id; where each row ends."""
        off = np.cumsum([0, *map(len, rows)])
        raw, stop = self.encode_run(np.frombuffer(b"".join(rows), np.uint8), off, end)
        return np.frombuffer(raw, "<u4", int(stop[-1]) if len(stop) else 0), stop


#: One encoder a worker and tokenizer file: tasks that follow one another know each other's words.
_ENCODERS: dict[str, WordEncoder] = {}
REMEMBERED.append(_ENCODERS)


def binary_pieces(stop: np.ndarray, full: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of rows that end at ``stop`` in one array: row, start in the array, length."""
    begin = np.r_[0, stop[:-1]] if len(stop) else stop
    total = stop - begin
    rows, starts, sizes = [], [], []
    whole = total // full
    row = np.repeat(np.arange(len(stop)), whole)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(whole) - whole, whole)
    rows.append(row), starts.append(begin[row] + nth * full), sizes.append(np.full(len(row), full))
    at = begin + whole * full
    bit = full >> 1
    while bit:
        has = np.flatnonzero(total & bit)
        rows.append(has), starts.append(at[has]), sizes.append(np.full(len(has), bit))
        at = at + (total & bit)
        bit >>= 1
    row, start, size = np.concatenate(rows), np.concatenate(starts), np.concatenate(sizes)
    o = np.lexsort((start, row))
    return row[o], start[o], size[o]


def pack_batches(batches: Iterator[pa.RecordBatch], path: str, full: int, end: int) -> Iterator[pa.RecordBatch]:
    made = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
    if path not in _ENCODERS:
        release()  # other operators' memory
    for batch in batches:
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, WordEncoder(path))
        ids = batch.column(0)
        for i, _, data, off in runs(batch, limit=RUN):
            raw, stop = encoder.encode_run(data, off, end)
            row, start, size = binary_pieces(stop, full)  # in turn, without a gap
            begin = np.r_[0, stop[:-1]]
            for a in range(0, len(row), PIECES):
                r, s, n = row[a:a + PIECES], start[a:a + PIECES], size[a:a + PIECES]
                cut = (4 * np.append(s - s[0], s[-1] + n[-1] - s[0])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(r + i)), pa.array(s - begin[r]), pa.array(n), pa.array((stop - begin)[r]),
                     pa.array(np.arange(made, made + len(r))), pa.array(np.zeros(len(r), np.int64)),
                     pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(cut), raw.slice(4 * int(s[0]), int(cut[-1]))])],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
                made += len(r)
    trim()


def pack_documents(docs: DataFrame, tokenizer: str, full: int = 2048, end: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32 bit)."""
    if full < 1 or full & (full - 1):
        raise ValueError("the full length must be a power of two")
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lambda it: pack_batches(it, tokenizer, full, end),
        f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the pieces with one folder for each length."""
    pieces.write.partitionBy("length").parquet(path)
