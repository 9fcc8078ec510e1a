"""Suffix-array, exact and line dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from terrascore.llm import exact_dedup, line_dedup, suffix_dedup

from .conftest import rows_of


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def brute_repeats(rows, length=100):
    """rows: (doc_id, text). Windows at the same (doc_id, place) don't count against each other."""
    rows = list(rows)
    first = {}
    key = lambda d: -(1 << 63) if d is None else d
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            first[w] = min(first.get(w, (key(d), i)), (key(d), i))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (key(d), i):
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g))))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffix_dedup_of_given_rows(small):
    frame, texts = small
    assert rows_of(suffix_dedup.remove_repeats(frame, 100, "sha256"), *COLUMNS) == brute_repeats(texts.items())


def test_suffix_dedup_of_odd_rows(odd_docs, no_docs):
    got = suffix_dedup.remove_repeats(odd_docs, 100, "sha256")
    assert {"lang", "kept", "_id", "a space"} <= set(got.columns)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(got, *COLUMNS) == brute_repeats(rows)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_suffix_dedup_of_rows_that_share_a_doc_id(spark):
    """Time and memory grow with the rows, whether these are alike or not; other columns may have any name."""
    rng = random.Random(11)
    own = ["".join(rng.choice("abcdefgh ") for _ in range(600)) for _ in range(3000)]
    own[7:3000:500] = [t[:200] + own[3][300:] for t in own[7:3000:500]]
    rows = [(None, t) for t in own] + [(5, own[0] + "x")] * 3000 + [(6, own[1][100:400])]
    names = ["__id", "__key", "__tag", "__of", "__places", "__spans", "__rest", "__text"]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    got = suffix_dedup.remove_repeats(frame.select("*", *[F.lit(1).alias(n) for n in names]), 100, "sha256").cache()
    assert rows_of(got, *COLUMNS) == brute_repeats(rows)
    assert {"m", *names} < set(got.columns) and got.where("m['k'] = 1 AND __spans = 1").count() == len(rows)


def test_suffix_dedup_merges_hot_kmers_it_is_not_told_of(spark, monkeypatch):
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    phrases = [word(70) for _ in range(5)]
    texts = [word(60) + phrases[i % 5] + word(60) + phrases[i % 3] for i in range(300)]
    monkeypatch.setattr(suffix_dedup, "HOT_ANCHORS", 20)
    monkeypatch.setattr(suffix_dedup, "HOT_KMERS", 2)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert rows_of(suffix_dedup.remove_repeats(frame, 100, "sha256"), *COLUMNS) == brute_repeats(enumerate(texts))


def test_suffix_dedup_keeps_valid_text(spark):
    base = "".join(map(chr, range(0xE0, 0xF7))) * 2 + "".join(f"{i:03d}" for i in range(60))
    frame = spark.createDataFrame([(1, base), (2, "x" + base[:110] + "y"), (3, "é" + base)], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in suffix_dedup.remove_repeats(frame, 100, "text").collect()}
    assert got == {1: base, 2: "xy", 3: "é"}


def test_suffix_dedup_inside_and_across_runs(monkeypatch):
    """Random texts over few letters, cut into many short runs and partitions."""
    rng = random.Random(5)
    monkeypatch.setattr(suffix_dedup, "SECTION", 700)
    base = ["".join(rng.choice("ab") for _ in range(400)) for _ in range(4)]
    texts = [(t := rng.choice(base))[rng.randrange(200):] + "".join(rng.choice("ab") for _ in range(rng.randrange(90))) + t[:rng.randrange(300)] for _ in range(60)]
    texts += ["a" * 500, "ab" * 300]
    data = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": texts})
    real = suffix_dedup.runs
    monkeypatch.setattr(suffix_dedup, "runs", lambda batch, *a: real(batch, limit=2000))
    places = defaultdict(list)
    front = list(suffix_dedup.anchor_hashes(iter([data]), 100, 3))
    for p in range(3):
        part = [b.filter(pa.compute.equal(b["pid"], p)) for b in front]
        for b in suffix_dedup.shared_anchors(iter(part)):
            for d, x in zip(b["doc_id"].to_pylist(), b["place"].to_pylist(), strict=True):
                places[d].append(x)
    joined = pa.record_batch({"__key": data["doc_id"], "__tag": pa.array([0] * len(texts), pa.int32()), "text": data["text"],
                              "__places": pa.array([places[i] for i in range(len(texts))], pa.list_(pa.int64()))})
    sorted_ = list(suffix_dedup.sorted_runs(iter([joined]), 100, 3))
    gone = [bytearray(len(t)) for t in texts]
    for p in range(3):
        for b in suffix_dedup.merge_runs(iter([b.filter(pa.compute.equal(b["pid"], p)) for b in sorted_]), 100):
            for d, x, y in zip(b["doc_id"].to_pylist(), b["a"].to_pylist(), b["b"].to_pylist(), strict=True):
                gone[d][x:y] = b"\1" * (y - x)
    got = [sha(bytes(c for c, g in zip(t.encode(), x, strict=True) if not g)) for t, x in zip(texts, gone, strict=True)]
    assert got == [r[-1] for r in sorted(brute_repeats(enumerate(texts)))]


def test_suffix_dedup_spreads_a_common_phrase(spark, monkeypatch):
    """Windows over a phrase shorter than they are differ in each document; no partition gets all of them, and equal ones meet."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    phrase, passage = word(60), word(300)
    texts = [word(90) + (phrase if i % 2 else passage) + word(90) for i in range(400)]
    texts += [t[40:200] for t in texts[:40]]
    data = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": texts})
    parts, skew = 16, {}
    for bound in (10**9, 50):
        places, hot = defaultdict(list), []
        front = list(suffix_dedup.anchor_hashes(iter([data]), 100, 1))
        for b in suffix_dedup.shared_anchors(iter(front), bound):
            for d, x in zip(b["doc_id"].to_pylist(), b["place"].to_pylist(), strict=True):
                hot.append(x) if d is None else places[d].append(x)
        joined = pa.record_batch({"__key": data["doc_id"], "__tag": pa.array([0] * len(texts), pa.int32()), "text": data["text"],
                                  "__places": pa.array([places[i] for i in range(len(texts))], pa.list_(pa.int64()))})
        load = np.zeros(parts)
        for b in suffix_dedup.sorted_runs(iter([joined]), 100, parts, np.array(hot, np.uint64)):
            for p, kind, value in zip(*(b[c].to_pylist() for c in ("pid", "kind", "value")), strict=True):
                load[p] += 0 if kind == 1 else sum(x.nbytes for x in suffix_dedup.unpack(value))
        skew[bound] = load.max() / np.median(load)
    assert skew[50] < 2 < skew[10**9]
    monkeypatch.setattr(suffix_dedup, "HOT_ANCHORS", 50)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert rows_of(suffix_dedup.remove_repeats(frame, 100, "sha256"), *COLUMNS) == brute_repeats(enumerate(texts))


def test_loser_tree_merges_with_common_prefixes():
    rng = random.Random(3)
    some = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(30)]
    runs = [sorted(rng.choice(some) for _ in range(rng.randrange(40))) for _ in range(7)]
    rows = [np.frombuffer(b"".join(r), np.uint8).reshape(-1, 12) for r in runs]
    merged = [(runs[r][i], shared) for r, i, shared in suffix_dedup.LoserTree(runs, [suffix_dedup.common(x).tolist() for x in rows])]
    assert [t for t, _ in merged] == sorted(t for r in runs for t in r)
    for (x, _), (y, shared) in zip(merged, merged[1:], strict=False):
        assert shared == next((i for i in range(12) if x[i] != y[i]), 12)


def brute_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    best, size = {}, Counter(norm)
    for (d, t), n in zip(rows, norm, strict=True):
        rank = (-len(t or ""), d is None, d or 0)
        best[n] = min(best.get(n, (rank, d)), (rank, d))
    return sorted(((d, best[n][1], size[n], d == best[n][1], sha(n.encode())) for (d, _), n in zip(rows, norm, strict=True)), key=repr)


def test_exact_dedup(odd_docs, no_docs, small):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(exact_dedup.exact_duplicates(odd_docs), *columns) == brute_exact(rows)
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    frame, texts = small
    one_bucket = exact_dedup.exact_duplicates(frame, content_hash=lambda c: F.lit(b"same"))  # collisions of the content hash
    assert rows_of(one_bucket, *columns) == brute_exact(texts.items())


def test_exact_dedup_keeps_one_row_of_each_text(odd_docs, no_docs):
    kept = exact_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and exact_dedup.keep_one(no_docs).count() == 0
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert {r[1] for r in rows_of(kept, "doc_id", "text")} <= {t for _, t in rows}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k for k, _ in {(k, s) for _, k, _, _, s in brute_exact(rows)})


def brute_lines(rows, min_docs=10, keep_first=False):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    docs = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    least = {}
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            least[k] = min(least.get(k, d), d, key=lambda x: (x is None, x))
    out = []
    for d, t in rows:
        lines, kept, seen = (t or "").split("\n"), [], set()
        for x in lines:
            k = key(x)
            if k and docs[k] >= min_docs and not (keep_first and least[k] == d and k not in seen):
                continue
            seen.add(k)
            kept.append(x)
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return sorted(out, key=repr)


def test_line_dedup(odd_docs, no_docs, small):
    columns = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = line_dedup.drop_repeated_lines(odd_docs, 10, digest=True)
    assert rows_of(got, *columns) == brute_lines(rows) and any(r[2] for r in brute_lines(rows))
    assert line_dedup.drop_repeated_lines(no_docs, 10).count() == 0
    frame, texts = small
    assert rows_of(line_dedup.drop_repeated_lines(frame, 2, keep_first=True, digest=True), *columns) == brute_lines(texts.items(), 2, True)


def test_line_dedup_with_a_full_filter(small, monkeypatch):
    """Beyond its capacity the filter suspects more lines; the result is the same."""
    monkeypatch.setattr(line_dedup, "MAX_BITS", 1 << 10)
    monkeypatch.setattr(line_dedup, "SEGMENT", 64)
    frame, texts = small
    data = pa.record_batch({"text": list(texts.values())})
    filters = list(line_dedup.task_filters(iter([data]), 1 << 10))
    merged = list(line_dedup.merge_filters(iter([*filters, *filters])))
    assert sum(len(b) for b in merged) == 2
    with pytest.raises(ValueError):
        line_dedup.drop_repeated_lines(frame, 1)
