"""Source divergence, prefix trie, n-gram join and their helpers: brute force, odd rows, hot groups."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrascore.llm import divergence, exact_dedup, links, minhash_dedup, ngram_join, prefix_trie
from terrascore.llm.common import join_counted

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- source divergence -------------------------------------------------------

def divergence_by_hand(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t in held if held[t] >= min_docs]
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2]) for s in {d[1] for d in mine}}
        whole = sum(count.values(), Counter())

        def share(c, kept=kept):
            of = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // of for t in kept}

        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in p:
            pair = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s))
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pair)]
            term = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(term)]
    return sorted(out)


COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def test_divergence_equals_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "délta", "Ω", "x", "zeta9eta", "日本"]
    rows = [(" ".join(rng.choices(words, [5, 4, 3, 2, 2, 1, 1, 1 + i % 3], k=rng.randrange(12))), rng.choice(["en", "fr", None, ""]), f"s{rng.randrange(4)}" if i % 9 else None) for i in range(150)]
    rows += [(None, "de", "only"), ("", "xx", "a"), ("rare words here", "xx", "b"), *[("alpha alpha", "en", "s0")] * 60]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit("clash")).withColumn("doc_id", F.lit(7))
    got = sorted(tuple(r[c] for c in COLUMNS) for r in divergence.divergence(docs.repartition(4), min_docs=9, top=3).collect())
    assert got == divergence_by_hand(rows, 9, 3)
    assert ("xx", "a", "pair", "b", 0, 1) in got  # no kept term at all


def test_divergence_takes_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    want = divergence_by_hand([(r.text, r.lang, r.source) for r in docs.collect()], 4, 50)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in divergence.divergence(docs, min_docs=4).collect()) == want
    assert divergence.divergence(no_docs.withColumn("source", F.lit("s"))).count() == 0


def test_shares_and_runs_are_exact():
    rng = random.Random(1)
    for of in (30, 10**9 + 7, 9 * 10**15):
        counts = [0, of - 5, *(rng.randrange(of - 5) for _ in range(50))]
        assert divergence.shares(np.array(counts), of).tolist() == [1 + 10**9 * (c + 5) // of for c in counts]
    a, b = np.array([0, 0, 2, 2, 2, 7]), np.array([1, 0, 0, 2, 2, 2])
    many = np.array([3, 1, 4, 1, 5, 9])
    runs = [divergence.column_runs(x) for x in (a, b)]
    assert divergence.run_distance(*runs, np.r_[0, np.cumsum(many)]) == int(np.sum(np.abs(a - b) * many))


def test_counters_are_sent_before_they_grow(spark):
    rows = [(" ".join(f"w{chr(97 + i % 26)}{chr(97 + j)}" for j in range(9)), "en", "s") for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]), pa.array([r[0] for r in rows])], names=["lang", "source", "text"])
    sums = [Counter(), Counter()]
    for held in (10, 10**6):
        for out in divergence.term_counts(iter([batch]), held):
            for t, n in zip(out.column(2).to_pylist(), out.column(3).to_pylist(), strict=True):
                sums[held == 10][t] += n
    assert sums[0] == sums[1]


# ---- prefix trie ---------------------------------------------------------------

def trie_by_hand(rows):
    """rows: conv_id, turn, role, text."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = turns.get(base, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    ends = lambda p, m: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p)))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], ends(p, m)) for p, m in members.items())


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes_of(frame):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in NODE) for r in frame.collect())


@pytest.mark.parametrize("width", [1 << 24, 4])
def test_trie_equals_brute_force(spark, width):
    """Also with a sketch so small that all prefixes seem shared."""
    rng = random.Random(5)
    rows = []
    for c in [*range(-7, 60), 1000, 1001]:
        if c % 11 == 4 and c > 20:
            continue  # a block's first conversation may be absent
        kind = rng.randrange(4)
        rows += [(c, t if rng.random() < .95 else None, rng.choice(["user", None]), f"turn {t} of kind {kind}" if rng.random() < .8 else rng.choice(["", None, "é🙂"]))
                 for t in range(rng.randrange(1, 14))]
    rows += [(500 + 5 * i, t, "user", f"hot {t}") for i in range(300) for t in range(3)]  # one conversation, many times
    rows += rows[:20] + [(None, 1, "user", "nobody's")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("digest", F.lit("clash"))
    if width == 4:
        prefixes = prefix_trie.prefixes_of(frame)
        sketch, _ = prefix_trie.prefix_sketch(prefixes, prefixes.count(), 1 << 2)
        assert sketch is not None
    assert nodes_of(prefix_trie.prefix_trie(frame.repartition(5), max_width=width)) == trie_by_hand(rows)


def test_trie_of_nothing_and_of_one_long_conversation(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    rows = [(0, t, "user", f"t{t}") for t in range(200)] + [(1, 0, "user", "x")]
    assert nodes_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, schema))) == trie_by_hand(rows)


def test_ends_are_hashed_piece_by_piece(monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    ids = {b"a": [1, 22, 333, 4444, 55555], b"b": [9]}
    rows = [(g, c) for g, found in ids.items() for c in found]
    pieces = list(prefix_trie.listed(iter([pa.RecordBatch.from_arrays([pa.array([g for g, _ in rows]), pa.array([c for _, c in rows])], names=["digest", "conv_id"])])))
    assert sum(len(p) for p in pieces) > 2
    got = {g: h for out in prefix_trie.list_hashes(iter(pieces)) for g, h in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True)}
    assert got == {g: hashlib.sha256(",".join(map(str, found)).encode()).hexdigest() for g, found in ids.items()}


# ---- n-gram join -----------------------------------------------------------------

def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(zip(*(found[i:] for i in range(words)), strict=False))


def classes_by_hand(rows, words, percent):
    """Per row (doc_id, n, component): rows are documents of their own."""
    sets = [shingles(t, words) for _, t in rows]
    least = -(1 << 63)
    label = [i if i is not None else least for i, _ in rows]
    near = defaultdict(set)
    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and 100 * both >= percent * len(s | sets[j]):
                near[i].add(j)
                near[j].add(i)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i not in seen:
            group, todo = set(), [i]
            while todo:
                x = todo.pop()
                if x not in group:
                    group.add(x)
                    todo += near[x]
            seen |= group
            low = min(label[x] for x in group)
            for x in group:
                out[x] = (rows[x][0], len(sets[x]), None if low == least else low)
    return sorted(out, key=repr)


def join_rows(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


def families(rng, groups, size, length, edits):
    """Texts of families whose members differ in up to ``edits`` words."""
    out = []
    for g in range(groups):
        words = [f"g{g}w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(size):
            own = list(words)
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
            out.append(" ".join(own))
    return out


@pytest.mark.parametrize("words,percent", [(3, 90), (1, 60), (2, 100)])
def test_ngram_join_equals_brute_force(spark, words, percent):
    rng = random.Random(words)
    texts = families(rng, 3, 14, 90, 4) + families(rng, 6, 6, 25, 2) + families(rng, 20, 3, 9, 1) + ["one", "one", "Two words", "two  words", "", None, " \n"] * 2
    rows = [(i, t) for i, t in enumerate(texts)]
    got = join_rows(ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words, percent))
    assert got == classes_by_hand(rows, words, percent)


def test_ngram_join_takes_odd_rows(spark, odd_docs, no_docs):
    want = classes_by_hand([(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()], 3, 90)
    assert join_rows(ngram_join.jaccard_classes(odd_docs)) == want
    assert ngram_join.jaccard_classes(no_docs).count() == 0


def test_large_tiles_are_dealt_over_pairs_of_parts(spark, monkeypatch):
    """A chain of near copies, dealt over blocks of a few classes, is found whole."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i:3 * i + 200])) for i in range(60)]  # each is like its neighbours only
    got = join_rows(ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == classes_by_hand(rows, 3, 90) and {r[2] for r in got} == {0}


def test_bit_counts_bound_the_overlap():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 3000, n).astype(np.uint64)) for n in rng.integers(1, 900, 60)]
    at = np.r_[0, np.cumsum([len(s) for s in sets])]
    bits = ngram_join.bitmaps(np.concatenate(sets), at).view("<u8").reshape(60, -1)
    x, y = (a.reshape(-1) for a in np.meshgrid(np.arange(60), np.arange(60)))
    most = ngram_join.most_common(np.diff(at), bits, x, y)
    assert all(m >= len(np.intersect1d(sets[a], sets[b])) for m, a, b in zip(most, x, y, strict=True))


# ---- helpers -----------------------------------------------------------------------

def test_components_of_hubs_and_chains(spark):
    pairs = [(0, i) for i in range(1, 500)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2001, 2000), (5, 5000)]
    got = {r.node: r.comp for r in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in [*range(500), 5000]} | {1000 + i: 1000 for i in range(71)} | {2000: 2000, 2001: 2000}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_key_filter_holds_all_keys(spark):
    found = links.unpack(links.key_filter(spark.range(-500, 500).select(F.col("id").alias("key"))).value)[0]
    assert links.may_hold(found, np.arange(-500, 500).astype(np.uint64)).all()
    assert links.may_hold(found, np.arange(10**6, 10**6 + 10**5).astype(np.uint64)).mean() < 0.01


def test_hot_keys_are_dealt_evenly(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(8000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
        right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 2)
        for met in (join_counted(left, right, ["k"], "n", 8000, "id"), links.join_values(left, right.drop("n"), "k", "id")):
            assert met.where("v != 2 * k").count() == 0 and met.count() == 8000
            sizes = [len(x) for x in met.select("id").rdd.glom().collect()]
            assert max(sizes) < 2 * sum(sizes) / len(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_keep_one_changes_no_column(spark):
    rows = [(i, "same  text" if i < 3 else f"text {i}", 7, 8, "h") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __n long, norm long, `a b` string").withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    out = exact_dedup.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r["__n"], r.norm, r["a b"], r.m["k"]) for r in out.collect()) == [(i, 7, 8, "h", i) for i in (0, 3, 4, 5)]


@pytest.mark.parametrize("percent", [50, 60, 95])
def test_minhash_finds_links_at_other_thresholds(spark, percent):
    """The asked agreements follow from the threshold: links at 50 and 60 per cent are found as those at 80."""
    rng = random.Random(percent)
    texts = families(rng, 8, 6, 120, 40 if percent < 90 else 3)
    rows = [(i, t) for i, t in enumerate(texts)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1, percent=percent)
    assert join_rows(got) == classes_by_hand(rows, 1, percent)
