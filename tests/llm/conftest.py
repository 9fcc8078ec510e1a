"""Fixtures of the operators' tests: odd rows that every operator must take."""

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in
                         ("kept", "score", "ids", "slot", "id", "features", "prediction", "n_spans", "group_size", "_id", "_key", "_tag", "a space")]])
PASSAGE = "Of the passages that stand in many documents, this one is long enough to be found by all who look for it again. " * 2
COMMON = "one line that stands in a dozen documents"


def odd() -> list[tuple]:
    text = {
        0: None, 1: "", 2: " \t\n ", 3: "word", 4: "word", 5: "Word  \n", 6: PASSAGE + "end", 7: "Start. " + PASSAGE, 8: "é" * 60 + PASSAGE + "ü" * 70,
        9: "x" * 30_000, 10: " ".join(f"w{i}" for i in range(20_000)), 11: " ".join(f"w{i}" for i in range(20_000)) + " more", 12: "\n\nlast line\n",
        13: "日本語 テキスト \x00 🙂 ▁", 14: "you idiot, you worthless 1d10t!!!", 15: "two words",
    } | {20 + i: f"{COMMON}\nown text of number {i} that none shares\n  {COMMON.upper()} " for i in range(12)}
    rows = [(k, v, "en") for k, v in text.items()]
    rows += [(7, text[7], "en"), (7, text[7], "en"), (7, "another text with a doc_id that is taken", "de"), (None, "text without doc_id", None), (None, None, None)]
    return [(*r, *["clash"] * (len(SCHEMA) - 3)) for r in rows]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """The smallest given table, as rows and as a frame."""
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").cache()
    return frame, {r.doc_id: r.text or "" for r in frame.collect()}


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
