"""Toxicity: boosted trees over dense features, with isotonic calibration.

A lexicon is learned from labelled texts: words, and beginnings of words, that
toxic documents use far more often than others. From a whole text come dense features:
lexicon densities, lexicon words near the second person, capitals,
punctuation and obfuscation rates. Gradient-boosted trees score them, and an
isotonic regression turns the trees' probability into one that can be read as
such. The final score is its value, with a thousandth of the trees' own
probability so that texts of one step keep their order.

Learning uses the labelled rows whose crc32(doc_id) modulo 4 is not 2. The trees and
the calibration see each of these with a lexicon learned from the other two
remainders, so they meet the lexicon as it works on texts it wasn't made from; new texts
are scored with the lexicon of all three. All is fitted on a sample of
about SAMPLE rows (chosen by a hash of doc_id, whatever the table's size);
every document is scored. Nothing but the text is an input of a score. A null
text counts as empty. Without two classes to learn from, every score is the share of
toxic labels (0 without labels).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import release, runs, ship

#: Labelled rows to learn from, about; entries of the lexicon at most.
SAMPLE, LEXICON = 24_000, 600
HELD_OUT, TREES, DEPTH = 2, 24, 3
FOLDS, ALL = (0, 1, 3), -1
_COUNTS = [f"{kind}_{f}" for f in FOLDS for kind in ("other", "toxic")]
THRESHOLD = 0.3
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre vos usted ustedes tú ti vosotros os".split())
NEAR = 5  # words
#: Insults that count before any are learned, with the log odds given to them.
SEED, SEED_ODDS = frozenset("""idiot idiotic moron stupid dumb dumbass loser scum trash garbage clown pathetic worthless disgusting vermin filth
filthy jerk fool retard bastard bitch asshole fuck fucking shit cunt whore slut dickhead imbecile arschloch idiota imbécil estúpido connard
salaud salope merde dummkopf""".split()), 3.0
STEMS = (4, 5, 6)
LEET = str.maketrans("013457@$!", "oieastasi")
FEATURES = ["log_words", "hits", "hit_density", "distinct_hits", "weight_sum", "weight_density", "weight_max", "near_you", "you_density", "capitals",
            "shouted", "punctuation", "exclamation", "digits", "obfuscated", "stretched", "word_length"]
_EDGE = ".,;:!?\"'()[]{}<>|«»¿¡…-_*"
_STRETCHED = re.compile(r"(.)\1\1")


def core(token: str) -> str:
    return token.lower().strip(_EDGE)


def units(word: str) -> list[str]:
    """The word, and its beginnings marked as such."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def plain(word: str) -> str:
    """A disguised word's letters."""
    return re.sub(r"[\W_]+", "", word.translate(LEET))


class Reader(dict):
    """What a token adds to the features, worked out once for each distinct token: 0 for most, or
    (weight, unit, second person, shouted, obfuscated, stretched)."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str):
        if len(self) > 300_000:
            self.clear()
        word = core(token)
        mixed = any(c.isalpha() for c in word) and not word.isalpha() and ("'" not in word and "’" not in word and "-" not in word)
        stretched = bool(_STRETCHED.search(word))
        best, unit = self.weigh(word)
        if not best and (mixed or stretched):
            best, unit = self.weigh(plain(_STRETCHED.sub(r"\1", word)))
        you, loud = word in SECOND_PERSON, len(word) > 2 and token.strip(_EDGE).isupper()
        value = (best, unit, you, loud, mixed, stretched) if best or you or loud or mixed or stretched else 0
        self[token] = value
        return value

    def weigh(self, word: str) -> tuple[float, str]:
        return max(((self.lexicon[u], u) for u in units(word) if u in self.lexicon), default=(0.0, ""))


def features(text: str, reader: Reader, capitals: int, punctuation: int, exclamation: int, digits: int) -> list[float]:
    tokens = text.split()
    n, size = len(tokens) or 1, len(text) or 1
    marks = [(i, v) for i, v in enumerate(map(reader.__getitem__, tokens)) if v]
    hits = [(i, v) for i, v in marks if v[0]]
    you = [i for i, v in marks if v[2]]
    near = 0
    if hits and you:
        at = np.searchsorted(you, [i for i, _ in hits])
        near = sum(1 for (i, _), j in zip(hits, at, strict=True) if (j < len(you) and you[j] - i <= NEAR) or (j and i - you[j - 1] <= NEAR))
    weight = sum(v[0] for _, v in hits)
    return [math.log1p(len(tokens)), len(hits), len(hits) / n, len({v[1] for _, v in hits}), weight, weight / n, max((v[0] for _, v in hits), default=0.0),
            near, len(you) / n, capitals / size, sum(v[3] for _, v in marks) / n, punctuation / size, exclamation / size, digits / size,
            sum(v[4] for _, v in marks) / n, sum(v[5] for _, v in marks) / n, len(text) / n]


_KINDS = np.zeros((4, 256), np.int64)
_KINDS[0, 65:91] = 1
_KINDS[1, [c for c in range(33, 127) if not chr(c).isalnum()]] = 1
_KINDS[2, [ord("!"), ord("?")]] = 1
_KINDS[3, 48:58] = 1


def featurise(batches: Iterator[pa.RecordBatch], lexicons: dict[int, dict[str, float]], keep: bool = False) -> Iterator[pa.RecordBatch]:
    """Replace the text of each row by its features (``_features``), or add them with ``keep``; the other columns stay.
    The lexicon is that of the row's ``_fold``, or the one of ALL where rows have none."""
    readers = {k: Reader(v) for k, v in lexicons.items()}
    for batch in batches:
        at, by = batch.schema.get_field_index("_text"), batch.schema.get_field_index("_fold")
        which = batch.column(by).to_pylist() if by >= 0 else [ALL] * len(batch)
        rows: list[list[float]] = []
        for i, j, data, off in runs(batch, "_text", 1 << 20):
            counts = []
            for kind in _KINDS:
                total = np.r_[0, np.cumsum(kind[data])]
                counts.append((total[off[1:]] - total[off[:-1]]).tolist())
            whole = data.tobytes()
            rows += [features(whole[a:b].decode(), readers[w], *c) for w, a, b, *c in zip(which[i:j], off[:-1].tolist(), off[1:].tolist(), *counts, strict=True)]
        column = pa.array(rows, pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if keep or i != at), column],
                                         names=[*(x for i, x in enumerate(batch.schema.names) if keep or i != at), "_features"])
    readers.clear()
    release()


def count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of this task's documents hold each unit, by fold and class: columns as ``_counts``."""
    held: dict[str, list[int]] = {}
    place = {(f, y): 2 * i + y for i, f in enumerate(FOLDS) for y in (0, 1)}
    for batch in batches:
        for text, label, fold_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            c = place[fold_, label]
            for u in {u for w in {core(t) for t in (text or "").split()} if w for u in units(w)}:
                held.setdefault(u, [0] * len(place))[c] += 1
    names = list(held)
    for a in range(0, len(names), 50_000):
        part = names[a:a + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(x, pa.int64()) for x in zip(*map(held.get, part), strict=True))], names=["unit", *_COUNTS])


def lexicon_of(counts: dict[str, list[int]], docs: list[int], left_out: int | None) -> dict[str, float]:
    """Log odds of the units that at least 2 % of the toxic texts (and 3 of them) hold, seven times as often as others do."""
    use = [i for i, f in enumerate(FOLDS) if f != left_out]
    toxic_docs, other_docs = sum(docs[2 * i + 1] for i in use), sum(docs[2 * i] for i in use)
    out = dict.fromkeys(SEED, SEED_ODDS)
    for unit, c in counts.items():
        toxic, other = sum(c[2 * i + 1] for i in use), sum(c[2 * i] for i in use)
        odds = math.log((toxic + 0.5) / (toxic_docs + 1)) - math.log((other + 0.5) / (other_docs + 1))
        if toxic >= max(3, 0.02 * toxic_docs) and odds > 2:
            out[unit] = odds
    return out


def learn_lexicons(rows: DataFrame, docs: list[int]) -> dict[int, dict[str, float]]:
    """The lexicon of all (_text, label, fold) rows, and for each fold that of the others.
    The LEXICON units that tell most are looked at; docs: the rows of each fold and class."""
    toxic, other = sum(map(F.col, _COUNTS[1::2])), sum(map(F.col, _COUNTS[::2]))
    odds = F.log((toxic + 0.5) / (sum(docs[1::2]) + 1.0)) - F.log((other + 0.5) / (sum(docs[::2]) + 1.0))
    best = (rows.select("_text", "label", "fold").mapInArrow(count_units, "unit string, " + ", ".join(f"{c} long" for c in _COUNTS))
            .groupBy("unit").agg(*[F.sum(c).alias(c) for c in _COUNTS]).where(toxic >= 3)
            .withColumn("odds", odds).where(F.col("odds") > 1.5).orderBy(F.desc(F.col("odds") * F.sqrt(toxic)), "unit").limit(LEXICON))
    counts = {r["unit"]: [r[c] for c in _COUNTS] for r in best.collect()}
    return {ALL: lexicon_of(counts, docs, None)} | {f: lexicon_of(counts, docs, f) for f in FOLDS}


def fold(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)).cast("int")


def sample(labels: DataFrame) -> DataFrame:
    """_id, label and fold of about SAMPLE labelled rows outside the held-out fold; a doc_id with several labels takes the highest."""
    rows = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id"))
            .agg(F.max((F.col("toxic") > 0).cast("int")).alias("label")).withColumn("fold", fold(F.col("_id"))).where(F.col("fold") != HELD_OUT))
    n = rows.count()
    return rows if n <= SAMPLE else rows.where(F.pmod(F.xxhash64(F.lit("toxicity"), F.col("_id")), F.lit(1 << 20)) < int(SAMPLE / n * (1 << 20)))


class Model:
    """Lexicon, trees and calibration; or, without both classes, a constant."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        spark = docs.sparkSession
        ship(spark)
        self.lexicon, self.trees, self.steps, self.share = {}, None, None, 0.0
        chosen = sample(labels)
        rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text")).join(F.broadcast(chosen), "_id")
        count = {(r["fold"], r["label"]): r["n"] for r in rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
        docs_of = [count.get((f, y), 0) for f in FOLDS for y in (0, 1)]
        total = sum(docs_of)
        self.share = sum(docs_of[1::2]) / total if total else 0.0
        if not sum(docs_of[1::2]) or not sum(docs_of[::2]):
            return
        lexicons = learn_lexicons(rows, docs_of)
        self.lexicon = lexicons[ALL]
        made = (rows.select("label", F.col("fold").alias("_fold"), "_text")
                .mapInArrow(lambda it: featurise(it, lexicons), "label int, _fold int, _features array<double>").collect())  # 17 numbers a row of the sample
        fit = spark.createDataFrame(sorted((r["label"], r["_features"]) for r in made), "label int, _features array<double>")
        fit = fit.select(F.col("label").cast("double").alias("label"), array_to_vector("_features").alias("features")).coalesce(4).cache()
        self.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, maxBins=32, seed=7).fit(fit)
        scored = self.trees.transform(fit).select("label", vector_to_array("probability")[1].alias("p"))
        self.steps = IsotonicRegression(featuresCol="p", labelCol="label").fit(scored)
        fit.unpersist()

    def score_rows(self, docs: DataFrame, keep: bool) -> DataFrame:
        """The rows of ``docs``, each whole in the column ``row`` (without the text unless ``keep``), and their ``score``.
        A text that is kept goes to the workers and back once."""
        names = [c for c in docs.columns if keep or c != "text"]
        if self.trees is None:
            return docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.lit(float(self.share)).alias("score"))
        # numbered, so that no column clashes with the model's own
        place = {c: "_text" if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}
        rows = docs.select(*[F.col(f"`{c}`").alias(place[c]) for c in names if c != "text"], F.col("text").cast("string").alias("_text"))
        schema = StructType([*(f for f in rows.schema.fields if keep or f.name != "_text"), StructField("_features", ArrayType(DoubleType()))])
        lexicons, kind = {ALL: self.lexicon}, docs.schema["text"].dataType
        made = rows.mapInArrow(lambda it: featurise(it, lexicons, keep), schema).withColumn("features", array_to_vector("_features"))
        row = F.struct(*[F.col(place[c]).cast(kind).alias(c) if c == "text" else F.col(place[c]).alias(c) for c in names])
        scored = self.steps.transform(self.trees.transform(made).select(row.alias("row"), vector_to_array("probability")[1].alias("p")))
        score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * F.col("prediction") + 0.001 * F.col("p")))
        return scored.select("row", score.alias("score"))

    def score(self, docs: DataFrame, out: str = "score") -> DataFrame:
        """The columns of ``docs`` but the text, and the score as column ``out``."""
        others = [c for c in docs.columns if c not in ("text", out)]
        return self.score_rows(docs.select(*[F.col(f"`{c}`") for c in [*others, "text"]]), False).select(*[F.col(f"row.`{c}`") for c in others], F.col("score").alias(out))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    scored = Model(docs, labels).score(docs.select("doc_id", "text"))
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose score stays under THRESHOLD, with the columns of ``docs``."""
    return Model(docs, labels).score_rows(docs, True).where(F.col("score") < THRESHOLD).select("row.*")
