"""Source divergence audit: how far the term shares of two sources of a language lie apart.

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z in lower case. A language keeps the V terms
that ``min_docs`` of its documents hold. With N occurrences of kept terms, a group (lang, source), or a
whole language, gives a term of ``count`` the share p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)).

1. Each task counts the terms of its texts by group, with the documents that hold them, and sends
   each (lang, source, term) once. A term's counts in all sources meet in one row: its column.
2. Terms with the same column are one class, whatever their number: a run of equal counts for every source. The
   classes are dealt into blocks of about BLOCK_ENTRIES counts. A block puts its classes in the order
   of their counts, source by source, and encodes each source's counts as runs.
3. For a pair of sources the borders of both run lists are intersected: between two borders both
   shares, and so f = |p - q|, are constant, and f is multiplied by the number of terms there. Shares are
   computed once a run. A pair's value is the sum over the blocks.
4. The terms in which a group exceeds its language are ranked; each task keeps its own top ones before they meet.

All arithmetic is on integers (shares by long division, see ``shares``). Null text, lang and
source count as ''. Rows that share a doc_id are documents of their own, repeated rows count
each time. A language of one source has no pairs; an empty table gives no rows. Of equal values the item with the smaller UTF-8
bytes comes first. A long text is split into words in sections of SECTION bytes. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import ship

#: Letters of ASCII in lower case and all bytes beyond it stay; the rest parts terms.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SECTION = 1 << 20
#: Counters of one task that hold more terms than this are sent and begun anew.
HELD_TERMS = 300_000
#: Counts other than zero that a block of classes holds, about, and counts that it lays out at a time.
BLOCK_ENTRIES, LAID_OUT = 1 << 15, 1 << 22
#: Groups (lang, source) up to which their sizes are broadcast.
MAX_BROADCAST_GROUPS = 500_000
SCALE = 1_000_000_000


def term_counts(batches: Iterator[pa.RecordBatch], held: int = HELD_TERMS) -> Iterator[pa.RecordBatch]:
    """lang, source, term, occurrences, documents; and a row without a term for each group."""
    counts: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = [None, *n]
            for i in range(0, len(terms), 50_000):
                part = terms[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                                                  pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] if t else 0 for t in part], pa.int64()),
                                                  pa.array([docs[t] if t else 0 for t in part], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            data, seen, i = text.encode().translate(_TERMS), None, 0
            while i < len(data):
                j = data.find(b" ", i + SECTION)
                words = data[i:j if j >= 0 else len(data)].split()
                n.update(words)
                seen = set(words) if seen is None else seen.union(words)
                i = j if j >= 0 else len(data)
            docs.update(seen or ())
            size += len(n)
            if size > held:
                yield from out()
                counts.clear()
                size = 0
    yield from out()


def shares(count: np.ndarray, of: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 5) / of) for count + 5 <= of < 9.2e15, by long division in three steps of a thousand."""
    q, rest = np.divmod(count + 5, of)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, of)
        q = q * 1000 + more
    return q + 1


def column_runs(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal counts begin, and their counts."""
    first = np.flatnonzero(np.r_[True, counts[1:] != counts[:-1]]) if len(counts) else np.zeros(0, np.int64)
    return first, counts[first]


def run_distance(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], before: np.ndarray) -> int:
    """The sum of |p - q| over the terms of two run-length columns (first class of each run, share);
    before: terms before each class, and after the last."""
    borders = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], borders, "right") - 1]
    q = b[1][np.searchsorted(b[0], borders, "right") - 1]
    return int(np.sum(np.abs(p - q) * np.diff(np.r_[before[borders], before[-1]])))


def pair_sums(classes: pa.Table, groups: pa.Table) -> pa.Table:
    """Per pair of sources a < b the sum of f over the terms of one block of classes.

    classes: by (list of source and count other than zero), m (terms of the class); groups: source, d (N + 5 * V)."""
    names = groups["source"].to_pylist()
    order = sorted(range(len(names)), key=lambda i: names[i].encode())
    at = {names[s]: i for i, s in enumerate(order)}
    size = [groups["d"][s].as_py() for s in order]
    total = np.zeros((len(order), len(order)), np.int64)
    by = classes["by"].combine_chunks()
    by = pa.concat_arrays(by.chunks) if isinstance(by, pa.ChunkedArray) else by
    many = np.asarray(classes["m"], dtype=np.int64)
    if len(by) and len(order) > 1:
        flat, offsets = by.flatten(), np.asarray(by.offsets) - by.offsets[0].as_py()
        codes = flat.field(0).dictionary_encode()
        source = np.array([at[x] for x in codes.dictionary.to_pylist()], np.int64)[np.asarray(codes.indices)]
        n = np.asarray(flat.field(1), dtype=np.int64)
        step = max(1, LAID_OUT // len(order))
        for i in range(0, len(by), step):
            j = min(i + step, len(by))
            x, y = offsets[i], offsets[j]
            laid = np.zeros((j - i, len(order)), np.int64)
            laid[np.repeat(np.arange(j - i), np.diff(offsets[i:j + 1])), source[x:y]] = n[x:y]
            o = np.lexsort(laid.T[::-1])
            laid, before = laid[o], np.r_[0, np.cumsum(many[i:j][o])]
            columns = [(first, shares(count, size[s])) for s, (first, count) in enumerate(column_runs(laid[:, s]) for s in range(len(order)))]
            for s in range(len(order)):
                for t in range(s + 1, len(order)):
                    total[s, t] += run_distance(columns[s], columns[t], before)
    s, t = np.triu_indices(len(order), 1)
    names = [names[i] for i in order]
    return pa.table({"a": pa.array([names[i] for i in s], pa.string()), "b": pa.array([names[i] for i in t], pa.string()), "value": pa.array(total[s, t], pa.int64())})


def share(count, of):
    """``shares`` as a column."""
    wide = "decimal(20,0)"
    return F.expr(f"1 + ((cast({count} + 5 as {wide}) * {SCALE}BD) div cast({of} as {wide}))")


def ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    """rank in each (lang, source), by value downwards, then by item; up to ``top``."""
    out = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))
    return out if top is None else out.where(F.col("rank") <= top)


def divergence(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: in part ``pair`` every other source of the language, in part
    ``term`` the ``top`` terms whose share in the group exceeds that in the language."""
    spark = docs.sparkSession
    ship(spark)
    ensure_checkpoint_dir(spark)
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # all counts of a term come together once, which serves both sums
    found = plain.mapInArrow(term_counts, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    by_source = found.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("by"))
    held = by_term.where((F.col("docs") >= min_docs) | F.col("term").isNull()).select("lang", "term", "by").checkpoint()

    terms = held.where("term IS NOT NULL")
    each = terms.select("lang", "term", F.explode("by").alias("x"), F.aggregate("by", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("all")).select("lang", "term", "x.*", "all")
    sums = each.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    of_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum(F.aggregate("by", F.lit(0).cast("long"), lambda a, x: a + x["n"])).alias("n_lang"))
    groups = (held.where("term IS NULL").select("lang", F.explode("by.source").alias("source")).join(sums, ["lang", "source"], "left").join(of_lang, "lang", "left")
              .select("lang", "source", (F.coalesce("n", F.lit(0)) + F.coalesce("v", F.lit(0)) * 5).alias("d"), (F.coalesce("n_lang", F.lit(0)) + F.coalesce("v", F.lit(0)) * 5).alias("d_lang"))
              .checkpoint())

    entries, n_groups = terms.agg(F.sum(F.size("by"))).first()[0] or 0, groups.count()
    blocks = -(-entries // BLOCK_ENTRIES) or 1
    classes = terms.groupBy("lang", "by").agg(F.count(F.lit(1)).alias("m")).withColumn("block", F.pmod(F.xxhash64("by"), F.lit(blocks)).cast("int"))
    in_blocks = groups.select("lang", "source", "d", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))  # also where a language keeps no term

    def of_block(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = pair_sums(left.select(["by", "m"]), right.select(["source", "d"]))
        return out.append_column("lang", pa.array([key[0].as_py()] * len(out), pa.string()))

    pairs = (classes.groupBy("lang", "block").cogroup(in_blocks.groupBy("lang", "block")).applyInArrow(of_block, "a string, b string, value long, lang string")
             .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    pair_part = ranked(both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value"))

    sized = F.broadcast(groups) if n_groups <= MAX_BROADCAST_GROUPS else groups
    above = each.join(sized, ["lang", "source"]).withColumn("p", share("n", "d")).withColumn("q", share("all", "d_lang")).where("p > q")
    term_part = ranked(above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")), top)
    return pair_part.unionByName(term_part)
