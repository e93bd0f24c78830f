"""One query an operator, over whole tables with production parameters, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .langid import fit, identify_languages
from .merkle import ascii_lowered, dataset_manifest, row_digest
from .neardup import near_duplicates
from .ordermin import neighbour_fingerprints
from .packing import pack_documents
from .partenum import jaccard_components
from .preference import format_preferences, swapped_replies
from .ranking import rank_documents
from .sentencepiece_backend import encode_documents
from .sharding import assign_shards
from .spans import dedup_spans
from .suffixes import dedup_bytes
from .topk import search

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify_languages(docs, fit(docs))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_spans(table(spark, sf_dir, "documents"))


def op4_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    out = format_preferences(*swapped_replies(table(spark, sf_dir, "conversations")))
    return out.withColumns({"chosen_spans": spans("chosen_spans"), "rejected_spans": spans("rejected_spans")})


def op5_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 3 divides the id's checksum the text is found lower-cased; a null id has no checksum and isn't tampered with."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, row_digest(*fields, ascii_lowered("text")))
    return dataset_manifest(table(spark, sf_dir, "documents"), [*fields, "text"], tampered=tampered)


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_language_id, op2_packing, op3_sentence_spans, op4_preference_formatting, op5_odd_sketches, op6_exact_topk, op7_order_minhash, op8_suffix_array, op9_sharding, op10_sentencepiece, op11_partenum, op12_ranked_search, op13_merkle_manifest)}

_OP4 = """
WITH turns AS (SELECT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT pair_id, arg_max(turn, (turn, text)) AS turn, arg_max(text, (turn, text)) AS text FROM turns WHERE role = 'assistant' GROUP BY pair_id),
rejected AS (
  SELECT t.* FROM turns t LEFT JOIN last l USING (pair_id)
  WHERE NOT coalesce(t.role = 'assistant' AND t.turn = l.turn AND t.text = l.text, false)
  UNION ALL SELECT l.pair_id, l.turn, 'assistant', n.text FROM last l JOIN last n ON n.pair_id = l.pair_id + 1),
c AS (SELECT pair_id, list({'t': turn, 'r': role, 'x': text} ORDER BY turn, role, text) AS c FROM turns GROUP BY pair_id),
r AS (SELECT pair_id, list({'t': turn, 'r': role, 'x': text} ORDER BY turn, role, text) AS r FROM rejected GROUP BY pair_id),
both_sides AS (SELECT pair_id, coalesce(c, []) AS c, coalesce(r, []) AS r FROM c FULL JOIN r USING (pair_id)),
cut AS (
  SELECT *, coalesce(list_position([i <= len(c) AND i <= len(r) AND c[i].r = r[i].r AND c[i].x = r[i].x FOR i IN range(1, greatest(len(c), len(r)) + 2)], false), 1) - 1 AS n
  FROM both_sides),
sides AS (SELECT pair_id, n, c[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM cut)
SELECT pair_id, n::INT AS n_common,
  array_to_string(['<|' || t.r || '|>' || chr(10) || t.x || '<|end|>' || chr(10) FOR t IN p], '') AS prompt,
  array_to_string(['<|' || t.r || '|>' || chr(10) || t.x || '<|end|>' || chr(10) FOR t IN c], '') AS chosen,
  array_to_string([(coalesce(list_sum([length(u.r) + length(u.x) + 13 FOR u IN c[1:i - 1]]), 0)::BIGINT + length(c[i].r) + 5)::VARCHAR || ':' ||
    (coalesce(list_sum([length(u.r) + length(u.x) + 13 FOR u IN c[1:i]]), 0)::BIGINT)::VARCHAR FOR i IN range(1, len(c) + 1) IF c[i].r = 'assistant'], ',') AS chosen_spans,
  array_to_string(['<|' || t.r || '|>' || chr(10) || t.x || '<|end|>' || chr(10) FOR t IN r], '') AS rejected,
  array_to_string([(coalesce(list_sum([length(u.r) + length(u.x) + 13 FOR u IN r[1:i - 1]]), 0)::BIGINT + length(r[i].r) + 5)::VARCHAR || ':' ||
    (coalesce(list_sum([length(u.r) + length(u.x) + 13 FOR u IN r[1:i]]), 0)::BIGINT)::VARCHAR FOR i IN range(1, len(r) + 1) IF r[i].r = 'assistant'], ',') AS rejected_spans
FROM sides
"""

_OP6 = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP9 = """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, coalesce(text, '') AS text FROM documents),
s AS (
  SELECT doc_id, size, xor(4294967295, list_reduce([('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(text)), '..')],
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32
  FROM d, crc),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32) - size AS before, sum(size) OVER () AS total FROM s),
q AS (SELECT *, least(7, ((2 * before + size) * 8) // (2 * total))::INT AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, NULL::INT AS grown_shard
FROM q
"""

def _jaccard_sql(k: int, percent: int, extra: str) -> str:
    """Components of documents by exact similarity of their sets of ``k``-word shingles."""
    return rf"""
WITH RECURSIVE cut AS (
  SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, text FROM documents)),
listed AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + {k - 1}], ' ') FOR i IN range(1, len(w) - {k - 2})]) END AS s FROM cut),
d AS (SELECT doc_id, len(s) AS n, s, CASE WHEN len(s) > 0 THEN md5(array_to_string(list_sort(s), chr(1))) END AS node FROM listed),
nodes AS (SELECT node, any_value(n) AS n, any_value(s) AS s, min(doc_id) AS least FROM d WHERE node IS NOT NULL AND doc_id IS NOT NULL GROUP BY node),
features AS (SELECT node, n, unnest(s) AS f FROM nodes),
links AS (
  SELECT a.node AS a, b.node AS b FROM features a JOIN features b ON a.f = b.f AND a.node < b.node
  WHERE 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) GROUP BY a.node, b.node HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (SELECT node, node FROM nodes UNION SELECT r.a, e.b FROM reached r JOIN edges e ON e.a = r.b),
components AS (SELECT r.a AS node, min(n.least) AS component FROM reached r JOIN nodes n ON n.node = r.b GROUP BY r.a)
SELECT doc_id, n::BIGINT AS n_shingles, CASE WHEN doc_id IS NULL THEN NULL WHEN n = 0 THEN doc_id ELSE component END::BIGINT AS component_id{extra}
FROM d LEFT JOIN components USING (node)
"""


_OP12 = r"""
WITH words AS (SELECT doc_id, rowid_, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)),
lengths AS (SELECT rowid_, count(*) AS n FROM words GROUP BY rowid_),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
tf AS (SELECT rowid_, doc_id, term, count(*) AS tf FROM words GROUP BY rowid_, doc_id, term),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term),
asked AS (SELECT DISTINCT item_row, item_id, term FROM (SELECT item_row, item_id,
  unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS item_row FROM benchmark))),
scored AS (
  SELECT item_row, item_id, rowid_, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (rowid_), totals GROUP BY item_row, item_id, rowid_, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""

_OP13 = """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
rows_ AS (
  SELECT doc_id, lang, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') ||
    coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS body,
    coalesce(octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lowered,
    xor(4294967295, list_reduce([('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..')],
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT)) % 3 = 0 AS tampered
  FROM documents, crc),
leaves AS (SELECT doc_id, lang, sha256(head || body) AS leaf, CASE WHEN tampered THEN sha256(head || lowered) END AS changed FROM rows_),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, changed NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER () AS id FROM leaves),
nodes(lang, level, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM ranked
  UNION ALL SELECT lang, level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lang, level, i // 8),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, i, n, h) AS (
  SELECT 0, g, n, h FROM subroots
  UNION ALL SELECT level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 8),
inner_runs AS (
  SELECT a.lang, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM nodes a JOIN nodes b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.lang, a.level, a.i),
outer_runs AS (
  SELECT a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM tops a JOIN tops b ON a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.level, a.i),
steps AS (
  SELECT r.id, s.level, s.before, s.after FROM ranked r JOIN inner_runs s ON r.lang IS NOT DISTINCT FROM s.lang AND s.i = r.i // (8 ** s.level)::BIGINT
  UNION ALL SELECT r.id, 1000 + o.level, o.before, o.after FROM ranked r JOIN subroots g ON r.lang IS NOT DISTINCT FROM g.lang JOIN outer_runs o ON o.i = g.g // (8 ** o.level)::BIGINT),
placed AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level) AS k FROM steps),
fold(id, k, h) AS (
  SELECT id, 0, coalesce(changed, leaf) FROM ranked
  UNION ALL SELECT f.id, f.k + 1, sha256(p.before || f.h || p.after) FROM fold f JOIN placed p ON p.id = f.id AND p.k = f.k + 1),
folded AS (SELECT id, arg_max(h, k) AS folded_root FROM fold GROUP BY id),
proofs AS (SELECT id, sha256(coalesce(string_agg(before || after, '' ORDER BY k), '')) AS proof_sha256 FROM ranked LEFT JOIN placed USING (id) GROUP BY id)
SELECT r.doc_id, r.leaf, g.h AS subroot, t.h AS root, p.proof_sha256, f.folded_root, f.folded_root = t.h AS verified
FROM ranked r JOIN subroots g ON r.lang IS NOT DISTINCT FROM g.lang JOIN proofs p USING (id) JOIN folded f USING (id) CROSS JOIN (SELECT h FROM tops WHERE n = 1) t
"""

ORACLE: dict[str, str] = {"op4_preference_formatting": _OP4, "op5_odd_sketches": _jaccard_sql(2, 80, ", coalesce(doc_id = CASE WHEN n = 0 THEN doc_id ELSE component END, true) AS kept"), "op6_exact_topk": _OP6, "op9_sharding": _OP9, "op11_partenum": _jaccard_sql(4, 85, ""), "op12_ranked_search": _OP12, "op13_merkle_manifest": _OP13}
