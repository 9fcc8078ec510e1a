"""The corpus pipeline: toxicity filter, exact dedup, near-dedup, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns the frame that, written as
Parquet and read again, is the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascore.llm import exact_dedup, minhash_dedup, packing, suffix_dedup, toxicity
from terrascore.llm.common import documents
from terrascore.session import scratch_path

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold stay."""
    return toxicity.drop_toxic(docs, documents(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays."""
    return minhash_dedup.keep_first(docs, words=5, percent=80)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that stand earlier go; all documents stay, with their new length."""
    kept = suffix_dedup.remove_repeats(docs, 100, kept_as="text")
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths up to 2048, none across documents."""
    import public_tokenizers

    pieces = packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), 2048, 1)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("minhash near-dedup", drop_near_copies),
          ("suffix-array dedup", drop_passages), ("packing", pack)]

#: The toxicity stage learns a model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table in the shared folder."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{i}-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
