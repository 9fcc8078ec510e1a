"""Sharding, packing, SentencePiece and language-model scores."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from terrascore.llm import lm_score, packing, sentencepiece, sharding
from terrascore.llm.common import pack, text_view, unpack

from .conftest import rows_of

WORD_BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_lookup_table_is_even_and_moves_little():
    names = [f"s{i}" for i in range(10)]
    table = sharding.lookup_table(names, 1009)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    less = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, less, strict=True) if a != 9)
    assert moved < 0.25 * len(table)  # a plain modulo would move nine tenths
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "a"], 7)


def test_sharding_of_odd_rows(odd_docs, no_docs):
    names = ["a", "b", "c"]
    placed = sharding.place(odd_docs, "doc_id", names, 101)
    assert placed.columns == [*(c for c in odd_docs.columns if c != "slot"), "slot", "shard", "shard_name"]
    table = sharding.lookup_table(names, 101)
    for r in placed.collect():
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard, r.shard_name) == (slot, table[slot], names[table[slot]])
    assert placed.count() == odd_docs.count() and sharding.place(no_docs, "doc_id", names, 101).count() == 0
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan


def test_packing_of_odd_rows(odd_docs, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    got = packing.pack_documents(odd_docs, WORD_BPE).collect()
    want = Counter()
    for r in odd_docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        sizes = [2048] * (len(ids) // 2048) + [1 << b for b in range(10, -1, -1) if len(ids) % 2048 >> b & 1]
        at = 0
        for n in sizes:
            want[r.doc_id, at, n, len(ids), np.array(ids[at:at + n], "<u4").tobytes()] += 1
            at += n
    assert Counter((r.doc_id, r.start, r.length, r.doc_tokens, bytes(r.ids)) for r in got) == want
    assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} == {0}
    assert packing.pack_documents(no_docs, WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(odd_docs, WORD_BPE, full=1000)


def test_words_as_the_tokenizer_splits_them(small, monkeypatch):
    from tokenizers import Tokenizer

    texts = [*small[1].values(), "", "İstanbul ΟΔΟΣ x\x1cy\x85z <|endoftext|>a <|start", "é ́x ÀÉ", "it's 'S can'T 'll x'RE 12a3", "\x00 a\x7f ß×÷ª°µ", "ǅ ﬁ Å K"]
    tokenizer = Tokenizer.from_file(WORD_BPE)
    monkeypatch.setattr(packing, "WORDS_KEPT", 3000)
    encoder = packing.WordEncoder(WORD_BPE)
    assert encoder.direct
    for i in range(0, len(texts), 40):
        out, stop = encoder.encode([t.encode() for t in texts[i:i + 40]], 1)
        for t, a, b in zip(texts[i:], [0, *stop[:-1]], stop, strict=False):
            assert out[a:b].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 1], t[:80]


def test_a_worker_remembers_parts_of_words_and_forgets_old_ones(monkeypatch):
    encoder = packing.WordEncoder(WORD_BPE)
    encoder.encode([b" ".join(b"It's%d,x%d" % (i, i % 7) for i in range(1000))], 1)
    assert len(encoder.known) <= 15  # it, 's, x, the comma and ten digits; not a thousand words
    monkeypatch.setattr(packing, "WORDS_KEPT", 50)
    for i in range(20):
        encoder.encode([" ".join(chr(97 + i) + chr(97 + j) * 9 for j in range(26)).encode() + b" often"], 1)
        assert len(encoder.known) + len(encoder.older) <= 2 * (50 + 27) and (b"often" in encoder.known or b"often" in encoder.older)
    monkeypatch.setattr(packing, "BYTES_KEPT", 1000)  # long words count by their bytes
    for i in range(5):
        encoder.encode([("\u4e00" + chr(0x4E00 + i)).encode() * 400], 1)
        assert i < 2 or len(encoder.known) + len(encoder.older) <= 2


@pytest.mark.parametrize("direct", [True, False])
def test_any_text_is_split_as_by_the_tokenizer(direct):
    from tokenizers import Tokenizer

    rng, tokenizer, encoder = np.random.default_rng(3), Tokenizer.from_file(WORD_BPE), packing.WordEncoder(WORD_BPE)
    encoder.direct = direct
    signs = [*"aAsStTmMdDrReEvVlLzZ""<|>0123  \n\t.,;!-", "'s", "'RE", "'ll", "<|", "<|endoftext|>", "\x1c", "\x85", "\xa0", "\x00",
             *("'" * 9), *"éÉÀÖ×ØÞßà÷øÿÝ", "\u0301", "İ", "Σ", "ς", "ж", "Ж", "字", "٣", "²", "½", "😀", "ﬁ", "\u200b", "\u2028"]
    texts = ["".join(rng.choice(signs, n)) for n in [*range(8), *rng.integers(0, 60, 1500).tolist()]] + ["'", "x'", "'s", "''s", "'sv", "'r", "'", "e"]
    for some in (texts, texts[:1], [], [""], ["é"], ["x", "'", "s", "'", "", "re"]):
        out, stop = encoder.encode([t.encode() for t in some], 7)
        for t, a, b in zip(some, [0, *stop[:-1]], stop, strict=False):
            assert out[a:b].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 7], repr(t)
        assert len(stop) == len(some) and len(out) == (stop[-1] if some else 0)


def test_long_documents_go_on_a_few_pieces_at_a_time(monkeypatch):
    monkeypatch.setattr(packing, "RUN", 300)
    texts = ["ab, " * 9000, None, "", "x " * 700, *["one two 3"] * 50]
    batch = pa.RecordBatch.from_arrays([pa.array([None, *range(len(texts) - 1)], pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    monkeypatch.setattr(packing, "PIECES", 3)
    got = list(packing.pack_batches(iter([batch.slice(0, 2), batch.slice(2)]), WORD_BPE, 2048, 1))
    assert max(map(len, got)) <= 3
    rows, encoder = [r for b in got for r in b.to_pylist()], packing.WordEncoder(WORD_BPE)
    assert [r["sequence_id"] for r in rows] == list(range(len(rows)))
    for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
        own = [r for r in rows if r["doc_id"] == doc]
        ids = encoder.encode([(text or "").encode()], 1)[0].tobytes()
        assert b"".join(r["ids"] for r in own) == ids and {r["doc_tokens"] for r in own} == {len(ids) // 4}
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
        assert [len(r["ids"]) for r in own] == [4 * r["length"] for r in own]


def test_buckets_hold_one_length(small, tmp_path):
    pieces = packing.pack_documents(small[0].limit(20), WORD_BPE)
    packing.write_buckets(pieces, str(tmp_path / "out"))
    again = small[0].sparkSession.read.parquet(str(tmp_path / "out"))
    assert again.count() == pieces.count() and again.where(F.octet_length("ids") != 4 * F.col("length")).count() == 0


def test_sampled_segmentations_have_their_exact_probabilities():
    pieces = sentencepiece.Pieces(PIECES, 1.0)
    data, off = text_view(pa.array(["there"] * 40_000))
    ids, at = sentencepiece.encode_run(data, off, np.arange(40_000), 3, pieces)
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True))
    known = {s: i for i, s in enumerate(pieces.surface) if s and i not in set(pieces.byte.tolist())}

    def ways(s: bytes):
        if not s:
            yield (), 1.0
        for n in range(1, len(s) + 1):
            if s[:n] in known:
                for rest, w in ways(s[n:]):
                    yield (known[s[:n]], *rest), w * pieces.weight[known[s[:n]]]

    weights = dict(ways(b" there"))
    total = sum(weights.values())
    assert set(seen) <= set(weights)
    for way, w in weights.items():
        p = w / total
        assert abs(seen[way] / 40_000 - p) < 5 * math.sqrt(p / 40_000) + 1e-4


def test_sentencepiece_round_trip(odd_docs, no_docs):
    encoded = sentencepiece.encode_sampled(odd_docs, PIECES, seed=4, verify=True)
    rows = encoded.collect()
    assert all(r.lossless for r in rows) and "a space" in encoded.columns and len(rows) == odd_docs.count()
    again = sentencepiece.encode_sampled(odd_docs.repartition(5), PIECES, seed=4).collect()
    assert sorted(map(repr, ((r.doc_id, bytes(r.ids)) for r in rows))) == sorted(map(repr, ((r.doc_id, bytes(r.ids)) for r in again)))
    other = sentencepiece.encode_sampled(odd_docs, PIECES, seed=5).collect()
    assert {bytes(r.ids) for r in rows} != {bytes(r.ids) for r in other}
    texts = sentencepiece.decode(encoded.drop("lossless"), PIECES)
    assert rows_of(texts, "doc_id", "text") == sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()), key=repr)
    assert sentencepiece.encode_sampled(no_docs, PIECES).count() == 0


def brute_scores(rows, order, min_count):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t in rows]
    counts = [Counter(tuple(w[i - n + 1:i + 1]) for w in docs for i in range(n - 1, len(w))) for n in range(1, order + 1)]
    total = sum(map(len, docs))

    def score(w, i, n):
        if n == 1:
            return math.log(counts[0][w[i],] / total)
        c = counts[n - 1][tuple(w[i - n + 1:i + 1])]
        return math.log(c / counts[n - 2][tuple(w[i - n + 1:i])]) if c >= min_count else math.log(0.4) + score(w, i, n - 1)

    return sorted(((d, len(w), round(sum(score(w, i, min(order, i + 1)) for i in range(len(w))), 4)) for (d, _), w in zip(rows, docs, strict=True)), key=repr)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores(odd_docs, order):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = lm_score.stupid_backoff(odd_docs, order, 2, bucket_bytes=50_000).withColumn("log_score", F.round("log_score", 4) + 0.0)
    for g, w in zip(rows_of(got, "doc_id", "n_words", "log_score"), brute_scores(rows, order, 2), strict=True):
        assert g[:2] == w[:2] and abs(g[2] - w[2]) < 2e-4


def test_lm_scores_of_nothing(no_docs):
    assert lm_score.stupid_backoff(no_docs).count() == 0


def test_packed_arrays_come_back():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(40), np.zeros(0, np.int64), np.array([1, 2], np.uint8), np.ones(3, bool)]
    for a, b in zip(arrays, unpack(pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
    assert zlib.crc32(pack(*arrays)) == zlib.crc32(pack(*arrays))
