"""The registered queries of the dealt operators: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.llm import (balltree, decontaminate, exact_dedup, knn, merkle, mixing, packing, pages, pii, sharding, simhash,
                         tokens, toxicity)
from recsift.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_harmonic_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.resolve(table(spark, sf_dir, "documents"), exact_dedup.temporary_index(spark))


ORACLE["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)"""


@query
def op3_mix_sources(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents")).drop("source")


@query
def op4_voronoi_topk(spark, sf_dir):
    return knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op4_voronoi_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
             CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op6_personal_data(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op7_vector_shards(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "tokens", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_token_counts(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


@query
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op10_page_text(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


@query
def op11_lexical_search(spark, sf_dir):
    return balltree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE["op11_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
total AS (SELECT count(*) AS big_n, sum(len(t))::BIGINT AS big_l FROM d WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT row_number() OVER () AS k, item_id, {_TERMS} AS t FROM benchmark),
qt AS (SELECT k, term, count(*) AS c FROM (SELECT k, unnest(t) AS term FROM q) GROUP BY k, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM df, total),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * len(t) * big_n) // big_l) AS m FROM d, total),
s AS (SELECT qt.k, tf.r, sum(qt.c * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m)))::BIGINT AS score
      FROM qt JOIN tf USING (term) JOIN w USING (term) JOIN m ON m.r = tf.r GROUP BY qt.k, tf.r),
o AS (SELECT s.k, m.doc_id, s.score, CAST(row_number() OVER (
             PARTITION BY s.k ORDER BY s.score DESC, m.doc_id NULLS LAST) AS INTEGER) AS rank
      FROM s JOIN m USING (r) WHERE s.score > 0)
SELECT q.item_id, o.rank, o.doc_id, o.score FROM o JOIN q USING (k) WHERE o.rank <= 10"""


@query
def op12_merkle_manifest(spark, sf_dir):
    return merkle.report(table(spark, sf_dir, "documents"))


_LEAF = """sha256(concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'),
               coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
               coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'),
               coalesce(strlen({0}) || ':' || {0}, '-')))"""
#: CRC-32 of a decimal number: a byte is added, then eight bits are shifted out.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(
    range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1)))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                             lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_LEAF.format("text")} AS leaf,
         CASE WHEN {_CRC32} % 3 = 0 THEN {_LEAF.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY lang) AS n FROM d),
low(lang, lvl, pos, n, h) AS (
  SELECT lang, 0, pos, n, leaf FROM l
  UNION ALL
  SELECT lang, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1
  GROUP BY lang, lvl, pos // 8, n),
sub AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM low WHERE n = 1),
high(lvl, pos, n, h) AS (
  SELECT 0, pos, n, subroot FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1
  GROUP BY lvl, pos // 8, n),
nodes AS (  -- per leaf, the runs on its way to the root: step, place in the run, digests
  SELECT l.r, x.lvl AS step, x.pos - (l.pos // CAST(pow(8, x.lvl) AS BIGINT)) AS rel, x.h
  FROM l JOIN low x ON l.lang IS NOT DISTINCT FROM x.lang AND x.n > 1
   AND x.pos // 8 = l.pos // CAST(pow(8, x.lvl + 1) AS BIGINT)
  UNION ALL
  SELECT l.r, 100 + x.lvl, x.pos - (s.pos // CAST(pow(8, x.lvl) AS BIGINT)), x.h
  FROM l JOIN sub s ON l.lang IS NOT DISTINCT FROM s.lang JOIN high x ON x.n > 1
   AND x.pos // 8 = s.pos // CAST(pow(8, x.lvl + 1) AS BIGINT)),
steps AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY step) AS k,
                 coalesce(string_agg(h, '' ORDER BY rel) FILTER (WHERE rel < 0), '') AS a,
                 coalesce(string_agg(h, '' ORDER BY rel) FILTER (WHERE rel > 0), '') AS b
          FROM nodes GROUP BY r, step),
folded(r, k, h) AS (
  SELECT r, 0, coalesce(tampered, leaf) FROM l
  UNION ALL
  SELECT f.r, f.k + 1, sha256(concat(s.a, f.h, s.b)) FROM folded f JOIN steps s ON s.r = f.r AND s.k = f.k + 1),
proof AS (SELECT r, string_agg(a || b, '' ORDER BY k) AS p FROM steps GROUP BY r),
last AS (SELECT r, arg_max(h, k) AS folded_root FROM folded GROUP BY r)
SELECT l.doc_id, l.leaf, s.subroot, (SELECT h FROM high WHERE n = 1) AS root,
       sha256(coalesce(p.p, '')) AS proof_sha256, folded_root,
       folded_root = (SELECT h FROM high WHERE n = 1) AS verified
FROM l JOIN sub s ON l.lang IS NOT DISTINCT FROM s.lang JOIN last ON last.r = l.r LEFT JOIN proof p ON p.r = l.r"""


@query
def op13_decontamination(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_decontamination"] = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
           FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
pos AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM t, (SELECT DISTINCT n FROM win))),
hit AS (SELECT DISTINCT p.r, p.i, p.n, w.item_id FROM pos p JOIN win w ON p.n = w.n AND p.s = w.s),
words AS (SELECT r, count(DISTINCT k) AS n_hit
          FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT t.doc_id, len(t.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""
