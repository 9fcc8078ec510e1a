"""Document fingerprints by closed syncmers, in DataFrame functions alone.

A text's words (``[^\\x20\\x09-\\x0D]+``) are hashed. A run of ``k`` words is chosen
when the smallest hash of its inner runs of ``s`` words lies at its first or
last place (ties count). Whether a run is chosen depends on nothing outside
it, so the same passage gives the same anchors in any text. The fingerprint is
the sequence of the distinct chosen runs' 32-bit hashes; a text with words but
without a chosen run has one hash of all of them, and a text without words none.

The likeness of two fingerprints is their shared part in order: twice the longest
sequence of hashes that both have in the same order, over the sum of both
sizes; two empty ones are alike (1).

An edit leaves no run of words whole in a text whose first half has few words, or
long ones (or none, as in unspaced scripts). Such a text (``few_words``) is compared
with others by closed syncmers over code points: runs of 8 with inner runs of
3, or all runs of 2 (the text's start being one more code point) in a text under SHORT code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that stand together while each looks at the next; and most such groups.
GROUP_ROWS, MAX_GROUPS = 512, 65536
NULL_ID = -(1 << 63)
_LOW = (1 << 32) - 1
#: Whole words that hold a chosen run for sure, with a run to spare; code points under which a text is compared by runs of 2.
WORDS, SHORT = 12, 32


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def short(value: Column) -> Column:
    return F.xxhash64(value).bitwiseAND(F.lit(_LOW))


def chosen(hashes: Column, k: int, s: int) -> Column:
    """Places (from 1) of the chosen runs of an array of word hashes."""
    last = k - s  # inner runs of a k-run: 0..last
    places = F.sequence(F.lit(1), F.size(hashes) - (k - 1))

    def at_edges(inner: Column) -> Column:
        def at_edge(i: Column) -> Column:
            edge = F.least(F.get(inner, i - 1), F.get(inner, i + (last - 1)))
            return edge <= F.array_min(F.slice(inner, i, last + 1))

        return F.filter(places, at_edge)

    found = at_edges(hashes) if s == 1 else bound(F.transform(F.sequence(F.lit(1), F.size(hashes) - (s - 1)), lambda i: F.xxhash64(F.slice(hashes, i, s))), at_edges)
    return F.when(F.size(hashes) >= k, found).otherwise(F.array().cast("array<int>"))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), where the value is computed once and not anew for each use."""
    return F.get(F.transform(F.array(value), f), 0)


def anchors(hashes: Column, k: int, s: int) -> Column:
    """The distinct chosen runs' hashes of an array of hashes, or else one hash of all of them."""
    if not 1 <= s < k:
        raise ValueError("1 <= s < k is needed")

    def of(hashes: Column) -> Column:
        runs = F.transform(chosen(hashes, k, s), lambda i: short(F.slice(hashes, i, k)))
        whole = F.when(F.size(hashes) > 0, F.array(short(hashes))).otherwise(F.array().cast("array<bigint>"))
        return bound(F.array_distinct(runs), lambda r: F.when(F.size(r) > 0, r).otherwise(whole))

    return bound(hashes, of)


def fingerprint(text: Column, k: int = 6, s: int = 1) -> Column:
    """The fingerprint as an array of longs."""
    return anchors(word_hashes(text), k, s)


def few_words(text: Column) -> Column:
    """Whether less than WORDS words of a text are followed by a space."""
    return ~text.rlike(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]){%d}" % WORDS)


def fine_print(text: Column, short_text: Column) -> Column:
    """The anchors of a text's code points; short_text: runs of 2."""
    points = F.transform(F.regexp_extract_all(F.concat(F.lit("\x02"), text), F.lit("(?s)."), F.lit(0)), lambda c: F.xxhash64(c))
    return F.when(short_text, anchors(points, 2, 1)).otherwise(anchors(points, 8, 3))


def as_text(print_: Column) -> Column:
    return F.array_join(F.transform(print_, lambda x: F.hex(x)), "-")


def in_order(a: Column, b: Column) -> Column:
    """The length of the longest common subsequence of two orders of the same distinct values."""
    def step(least: Column, p: Column) -> Column:  # least[i]: the least end of an increasing sequence of i + 1 places
        below = F.size(F.filter(least, lambda t: t < p))
        put = F.concat(F.slice(least, F.lit(1), below), F.array(p), F.slice(least, below + 2, F.size(least)))
        return F.when(F.coalesce(F.get(least, F.size(least) - 1), F.lit(0)) < p, F.concat(least, F.array(p))).otherwise(put)

    ends = F.aggregate(F.transform(a, lambda x: F.array_position(b, x)), F.array().cast("array<bigint>"), step)
    return F.when(a == b, F.size(a)).otherwise(F.size(ends))


def likeness(a: Column, b: Column) -> Column:
    def of(p: Column) -> Column:
        total = F.size(p.a) + F.size(p.b)
        shared = F.struct(F.array_intersect(p.a, p.b).alias("x"), F.array_intersect(p.b, p.a).alias("y"))
        return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * bound(shared, lambda c: in_order(c.x, c.y)) / total)

    return bound(F.struct(a.alias("a"), b.alias("b")), of)


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Deal rows (key, text) into ranges of the key: group, copy, key, text, th. The first
    row of each range is also put, as a copy, behind the last of the range before (the very first behind the very
    last), so that a window over a range sees each row's successor."""
    stats = docs.agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least")).first()
    n = min(MAX_GROUPS, max(1, stats["n"] // GROUP_ROWS))
    cuts: list[int] = []
    if n > 1:
        probs = [i / n for i in range(1, n)]
        cuts = sorted({x for x in docs.agg(F.percentile_approx("key", probs, max(10_000, 4 * n)).alias("q")).first()["q"] if x > stats["least"]})
    # two levels, so that a row is compared with few of the cuts
    wide = max(1, int(len(cuts) ** 0.5))
    longs = lambda x: F.array(*[F.lit(v).cast("long") for v in x]) if x else F.array().cast("array<bigint>")
    below = lambda values: F.size(F.filter(values, lambda c: c <= F.col("key")))
    coarse = below(longs(cuts[wide - 1::wide]))
    rows = docs.withColumn("coarse", coarse).withColumn(
        "group", (F.col("coarse") * wide + below(F.slice(longs(cuts), F.col("coarse") * wide + 1, wide))).cast("int")).drop("coarse")
    first = {r["group"]: r["first"] for r in rows.groupBy("group").agg(F.min("key").alias("first")).collect()}  # one row a range
    full = sorted(first)
    before = {g: full[i - 1] for i, g in enumerate(full)}
    own = F.struct(F.col("group"), F.lit(0).alias("copy"))
    heads = longs([first.get(g, NULL_ID) for g in range(len(cuts) + 1)])
    prior = F.array(*[F.lit(before.get(g, 0)) for g in range(len(cuts) + 1)])
    head = F.struct(F.get(prior, F.col("group")).alias("group"), F.lit(1).alias("copy"))
    dealt = rows.withColumn("to", F.explode(F.when(F.col("key") == F.get(heads, F.col("group")), F.array(own, head)).otherwise(F.array(own))))
    dealt = dealt.withColumn("group", F.col("to.group")).withColumn("copy", F.col("to.copy")).drop("to")
    return dealt, Window.partitionBy("group").orderBy("copy", "key", "th")


def edited_fingerprints(docs: DataFrame, k: int = 6, s: int = 1) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n/2) code points replaced by as many of
    the next document's first ones (all, if it has fewer), in the order of
    doc_id; the first follows the last. A null text is empty; a null doc_id comes
    first; rows that share a doc_id follow one another by a hash of the text.

    near_edited and near_next are likenesses of the text with the edited and the next one: of the
    fingerprints, or of the code points' anchors where the unedited half has few words."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"), text.alias("text"))
    dealt, window = with_next(rows.withColumn("th", F.xxhash64("text")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    prints = dealt.repartition(parts, "group").withColumn("print", fingerprint(F.col("text"), k, s))
    seen = (prints.withColumn("next_text", F.lead("text").over(window)).withColumn("next_print", F.lead("print").over(window))
            .where(F.col("copy") == 0).withColumn("n_chars", F.char_length("text").cast("long")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half))
    out = seen.withColumn("edited", edited).withColumn("edited_print", fingerprint(F.col("edited"), k, s))
    few, small = few_words(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int"))), F.col("n_chars") < SHORT

    def near(other: str, other_print: str) -> Column:
        fine = likeness(fine_print(F.col("text"), small), fine_print(F.col(other), small))
        return F.when(F.col("few"), fine).otherwise(likeness(F.col("print"), F.col(other_print)))

    out = out.withColumn("few", few)
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), as_text(F.col("print")).alias("fingerprint"),
                      as_text(F.col("edited_print")).alias("edited_fingerprint"), near("edited", "edited_print").alias("near_edited"),
                      near("next_text", "next_print").alias("near_next"))
