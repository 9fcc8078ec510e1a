"""The queries of this package on the given tables, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, exact_dedup, fingerprints, line_dedup, lm_score, minhash_dedup, ngram_join, packing, prefix_trie, sentencepiece, sharding, suffix_dedup, toxicity
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Production parameters of the sharding query.
SHARDS, SLOTS = [f"shard-{i:02d}" for i in range(32)], 4099


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), 100, kept_as="sha256")


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir).select("doc_id"), "doc_id", SHARDS, SLOTS)


# One claim a step: the shard whose turn it is takes the first free slot of its order. nxt: where each shard's search goes on.
SQL["op2_sharding"] = f"""
WITH RECURSIVE names AS (SELECT i, printf('shard-%02d', i) AS name FROM range({len(SHARDS)}) t(i)),
prefs AS (
  SELECT list(('0x' || substr(md5(name || '#offset'), 1, 15))::BIGINT % {SLOTS} ORDER BY i) AS off,
         list(('0x' || substr(md5(name || '#step'), 1, 15))::BIGINT % ({SLOTS} - 1) + 1 ORDER BY i) AS step FROM names),
fill AS (
  SELECT 0::BIGINT AS n, NULL::BIGINT AS slot, NULL::BIGINT AS owner, list_transform(range({SLOTS}), lambda x: 0::TINYINT) AS used,
         list_transform(range({len(SHARDS)}), lambda x: 0::BIGINT) AS nxt FROM prefs
  UNION ALL
  SELECT n + 1, j_slot, n % {len(SHARDS)}, list_transform(used, lambda u, i: CASE WHEN i = j_slot + 1 THEN 1::TINYINT ELSE u END),
         list_transform(nxt, lambda x, i: CASE WHEN i = n % {len(SHARDS)} + 1 THEN j + 1 ELSE x END)
  FROM (
    SELECT *, (off[n % {len(SHARDS)} + 1] + j * step[n % {len(SHARDS)} + 1]) % {SLOTS} AS j_slot FROM (
      SELECT n, used, nxt, off, step,
             list_filter(range(nxt[n % {len(SHARDS)} + 1], {SLOTS}),
                         lambda j: used[(off[n % {len(SHARDS)} + 1] + j * step[n % {len(SHARDS)} + 1]) % {SLOTS} + 1] = 0)[1] AS j
      FROM fill, prefs WHERE n < {SLOTS}))),
placed AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT doc_id, placed.slot, owner::INTEGER AS shard, printf('shard-%02d', owner) AS shard_name
FROM placed JOIN fill ON fill.slot = placed.slot
"""


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.stupid_backoff(documents(spark, sf_dir), order=3, min_count=2)
    return scored.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"))


SQL["op3_lm_scoring"] = r"""
WITH w AS (
  SELECT doc_id, unnest(a) AS c, unnest(range(len(a))) AS i FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS a
    FROM documents)),
g AS (SELECT *, lag(c) OVER o AS b, lag(c, 2) OVER o AS a FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c1 AS (SELECT c, count(*) AS n FROM g GROUP BY c),
c2 AS (SELECT b, c, count(*) AS n FROM g WHERE i >= 1 GROUP BY b, c),
c3 AS (SELECT a, b, c, count(*) AS n FROM g WHERE i >= 2 GROUP BY a, b, c),
s AS (
  SELECT g.doc_id,
    CASE WHEN i >= 2 AND t.n >= 2 THEN ln(t.n / ctx2.n)
         WHEN i >= 1 AND bi.n >= 2 THEN ln(bi.n / ctx1.n) + CASE WHEN i >= 2 THEN ln(0.4) ELSE 0 END
         ELSE ln(u.n / (SELECT count(*) FROM w)) + least(i, 2) * ln(0.4) END AS v
  FROM g JOIN c1 u ON u.c = g.c
  LEFT JOIN c2 bi ON bi.b = g.b AND bi.c = g.c LEFT JOIN c1 ctx1 ON ctx1.c = g.b
  LEFT JOIN c3 t ON t.a = g.a AND t.b = g.b AND t.c = g.c LEFT JOIN c2 ctx2 ON ctx2.b = g.a AND ctx2.c = g.b)
SELECT d.doc_id, count(s.v) AS n_words, round(coalesce(sum(s.v), 0), 4) AS log_score
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


SQL["op4_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t, length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"), 10, digest=True)


SQL["op9_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(a) AS line, unnest(range(len(a))) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
gone AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(gone.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN gone USING (key) GROUP BY doc_id
"""


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = sentencepiece.encode_sampled(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), seed=1, verify=True)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "lossless")


@query
def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir), words=2, percent=80)


SQL["op10_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) = 0 THEN [] WHEN len(a) = 1 THEN [a[1]]
                                 ELSE list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1]) END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.x = y.x AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir), min_docs=30, top=50)


SQL["op11_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
grp AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
full_n AS (SELECT grp.lang, grp.source, k.term, coalesce(c, 0) AS c FROM grp JOIN k ON k.lang = grp.lang LEFT JOIN n ON n.lang = grp.lang AND n.source = grp.source AND n.term = k.term),
p AS (SELECT *, 1 + ((c + 5)::HUGEINT * 1000000000) // (sum(c) OVER g + 5 * count(*) OVER g)::HUGEINT AS p FROM full_n WINDOW g AS (PARTITION BY lang, source)),
q AS (SELECT lang, term, 1 + ((c + 5)::HUGEINT * 1000000000) // (sum(c) OVER g + 5 * count(*) OVER g)::HUGEINT AS q
      FROM (SELECT lang, term, sum(c) AS c FROM full_n GROUP BY ALL) WINDOW g AS (PARTITION BY lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.term = y.term AND x.lang = y.lang
                WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
         FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
term AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.c > 0 AND p.p > q.q),
r AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
      UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM term)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(documents(spark, sf_dir, "conversations"))


# crc32 by its definition: each byte goes into the state, which then is shifted out by eight steps of one bit.
SQL["op12_prefix_trie"] = r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
cs AS (SELECT c, c - c % 5 AS b, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [ord(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                 lambda s, v: xor(xor(s, v) >> 1, 3988292384 * (xor(s, v) & 1)))) % 9 AS h FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (SELECT cs.c, t.i AS k, r, x FROM cs JOIN t ON t.c = cs.b WHERE t.i <= cs.h
            UNION ALL SELECT cs.c, 1000000000 + t.i, r, x FROM cs JOIN t ON t.c = cs.c WHERE t.i > cs.h),
path AS (SELECT cs.c, coalesce(list({'r': rebuilt.r, 'x': rebuilt.x} ORDER BY k) FILTER (k IS NOT NULL), []) AS p FROM cs LEFT JOIN rebuilt ON rebuilt.c = cs.c GROUP BY cs.c),
member AS (SELECT c, unnest(range(len(p) + 1)) AS d, p FROM path),
node AS (SELECT p[1:d] AS q, d, min(c) AS conv_id, count(*) AS n, (count(*) - 1) * max(CASE WHEN d > 0 THEN strlen(p[d].x) ELSE 0 END) AS w,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(p) = d), '')) AS ends FROM member GROUP BY ALL),
child AS (SELECT q[1:d - 1] AS q, d - 1 AS d, count(*) AS k FROM node WHERE d > 0 GROUP BY ALL),
below AS (SELECT q[1:a] AS q, a AS d, sum(w) AS saved, count(*) FILTER (k IS NULL) AS leaves
          FROM (SELECT node.q, node.d, w, k, unnest(range(node.d + 1)) AS a FROM node LEFT JOIN child ON child.q = node.q AND child.d = node.d) GROUP BY ALL)
SELECT node.conv_id, node.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(child.k, 0) AS n_children, below.leaves AS n_leaves,
       below.saved::BIGINT AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN below ON below.q = node.q AND below.d = node.d LEFT JOIN child ON child.q = node.q AND child.d = node.d
LEFT JOIN node parent ON parent.d = node.d - 1 AND parent.q = node.q[1:node.d - 1]
"""


@query
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(documents(spark, sf_dir), words=3, percent=90)


SQL["op13_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 3 THEN [array_to_string(a, ' ')]
                                 ELSE list_transform(range(1, len(a) - 1), lambda i: a[i] || ' ' || a[i + 1] || ' ' || a[i + 2]) END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.x = y.x AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""
