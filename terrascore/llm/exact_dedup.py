"""Exact dedup: group by a 128-bit content hash, keep one row, compare bytes.

The grouping key is the content hash, a SHA-256 digest and the normalised text
itself, so texts are equal only byte for byte, and a collision of the content
hash makes two groups. Each task merges its own copies before the exchange: a
text of which a third of all rows are copies leaves a task once. Rows then meet
their group by the two digests; should two different texts ever share both, the
job fails rather than merging them.

A null text counts as empty. Of equal texts the row with the most code points in
the original text stays, then the smallest doc_id; a null doc_id comes last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_counted

WHITE = "\x20\t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without any of ``[\\x20\\x09-\\x0D]``."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def keyed(docs: DataFrame, content_hash: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (docs.withColumn("__norm", normalised(F.col("text"))).withColumn("__n", F.char_length(text))
            .withColumn("__hash", content_hash(F.col("__norm"))).withColumn("__sha", F.sha2(F.col("__norm").cast("binary"), 256)))


def groups(docs: DataFrame, content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per text: _hash, _sha, keep_id, group_size."""
    best = F.max(F.struct(F.col("__n"), F.bitwise_not(F.col("doc_id").cast("long")).alias("id")))  # ~ turns the order and can't overflow
    each = (keyed(docs.select("doc_id", "text"), content_hash).groupBy("__hash", "__sha", "__norm")
            .agg(best.alias("best"), F.count(F.lit(1)).alias("n")))
    one = each.groupBy("__hash", "__sha").agg(F.first("best").alias("best"), F.first("n").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    alone = F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share both digests")).cast("long")).otherwise(F.col("group_size"))
    return one.select("__hash", "__sha", F.bitwise_not(F.col("best.id")).alias("keep_id"), alone.alias("group_size"))


def exact_duplicates(docs: DataFrame, content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 of the normalised text."""
    rows = keyed(docs.select("doc_id", "text"), content_hash).select("doc_id", "__hash", "__sha")
    met = join_counted(rows, groups(docs, content_hash), ["__hash", "__sha"], "group_size", docs.count(), "doc_id")
    return met.select("doc_id", "keep_id", "group_size", F.col("doc_id").cast("long").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.col("__sha").alias("text_sha256"))


def keep_one(docs: DataFrame, content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """The rows that stay, with the columns of ``docs``, whatever their names and types; of rows alike in text length and doc_id any one.

    Each row is carried whole in one column beside the keys, and is never compared."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    keyed_rows = docs.select(row.alias("row")).select("row", normalised(F.col("row.text")).alias("norm"),
                                                      F.struct(F.char_length(text).alias("n"), F.bitwise_not(F.col("row.doc_id").cast("long")).alias("id")).alias("rank"))
    hashed = keyed_rows.select("*", content_hash(F.col("norm")).alias("hash"))
    return hashed.groupBy("hash", "norm").agg(F.max_by("row", "rank").alias("row")).select("row.*")
