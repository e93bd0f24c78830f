"""Queries of routing rules: documents as pages, line items as attempts, orders as structures, parts as stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import routing as R
from .base import Tables, query

_PAGES = """pg AS (SELECT doc_id, doc_id // 7 AS file, CASE WHEN doc_id % 13 = 0 THEN 0 WHEN doc_id % 5 = 0 THEN n_chars % 130 ELSE n_chars % 900 END AS chars, (doc_id * 37 % 100) / 100.0::DOUBLE AS img FROM documents),
pc AS (SELECT *, CASE WHEN img >= 0.25 THEN CASE WHEN chars < 100 THEN 'image-only' WHEN chars < 400 THEN 'partial' ELSE 'text' END WHEN chars = 0 THEN 'empty' ELSE 'text' END AS class FROM pg)"""


def _pages(t: Tables) -> DataFrame:
    chars = F.when(F.col("doc_id") % 13 == 0, 0).when(F.col("doc_id") % 5 == 0, F.col("n_chars") % 130).otherwise(F.col("n_chars") % 900)
    p = t.documents.select("doc_id", F.expr("doc_id div 7").alias("file"), chars.alias("chars"), (F.col("doc_id") * 37 % 100 / 100.0).alias("img"))
    return p.withColumn("class", R.page_class(F.col("chars"), F.col("img")))


@query(f"WITH {_PAGES} SELECT doc_id, class FROM pc")
def page_classes(t: Tables) -> DataFrame:
    return _pages(t).select("doc_id", "class")


@query(f"""WITH {_PAGES}, n AS (SELECT file, count(*) AS n, count(*) FILTER (class IN ('image-only', 'partial')) AS o, count(*) FILTER (class = 'image-only') AS i, count(*) FILTER (class = 'text') AS x FROM pc GROUP BY file),
f AS (SELECT range AS file, range % 3 = 0 AS cover, range % 11 = 0 AS bad FROM range((SELECT max(doc_id) // 7 + 5 FROM documents)))
SELECT f.file, CASE WHEN bad OR n IS NULL THEN 'unreadable' WHEN o > 0 AND o / n >= 0.5 THEN 'scan' WHEN o > 0 THEN 'mixed' WHEN cover THEN 'cover-sheet' ELSE 'native' END AS route, coalesce(i > x, false) AS is_scan FROM f LEFT JOIN n USING (file)""")
def file_routes(t: Tables) -> DataFrame:
    last = t.documents.agg(F.expr("max(doc_id) div 7 + 4").alias("last"))  # one row
    files = last.select(F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("file"))
    files = files.withColumns({"cover": F.col("file") % 3 == 0, "bad": F.col("file") % 11 == 0})
    return R.file_routes(_pages(t), files, "file", "class", "cover", "bad")


@query(f"WITH {_PAGES} SELECT file, count(*) AS pages, count(*) FILTER (class = 'text') AS text_pages, sum(chars)::BIGINT AS chars, sum(CASE WHEN class = 'text' THEN chars ELSE 0 END)::BIGINT AS text_chars FROM pc GROUP BY file")
def pages_per_file(t: Tables) -> DataFrame:
    text = F.col("class") == "text"
    return _pages(t).groupBy("file").agg(F.count(F.lit(1)).alias("pages"), F.count_if(text).alias("text_pages"), F.sum("chars").alias("chars"), F.sum(F.when(text, F.col("chars")).otherwise(0)).alias("text_chars"))


@query(f"WITH {_PAGES} SELECT class, count(*) AS n, count(DISTINCT file) AS files, sum(chars)::BIGINT AS chars, round(avg(img), 6) AS mean_image FROM pc GROUP BY class")
def corpus_census(t: Tables) -> DataFrame:
    return _pages(t).groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file").alias("files"), F.sum("chars").alias("chars"), F.round(F.avg("img"), 6).alias("mean_image"))


_CODES = "[200, 403, 429, 503, 0, 404, 401, 410, 500, 202]"
_ATT = f"""att AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, ['ok', 'blocked', 'api-error', 'no-copy', 'measured'][l_partkey % 5 + 1] AS status,
  CASE WHEN l_suppkey % 7 = 0 THEN []::INT[] WHEN l_suppkey % 2 = 0 THEN [{_CODES}[l_partkey % 10 + 1]] ELSE [{_CODES}[l_suppkey % 10 + 1], {_CODES}[l_partkey % 10 + 1]] END AS codes,
  l_orderkey % 3 = 0 AS body, l_orderkey % 8 = 0 AS challenged, CASE WHEN l_orderkey % 5 = 0 THEN ['a=miss', 'b=blocked'] ELSE ['a=miss'] END AS tried, CASE WHEN l_orderkey % 9 = 0 THEN 'open_access' ELSE 'mirror' END AS route FROM lineitem),
ac AS (SELECT *, CASE WHEN status IN ('ok', 'measured', 'duplicate-held') THEN 'success' WHEN status = 'blocked' THEN 'refusal' WHEN codes[-1] IN (0, 408, 429) OR codes[-1] BETWEEN 500 AND 599 THEN 'transient' WHEN list_has_any(codes, [202, 403, 429, 503]) THEN 'refusal' ELSE 'neutral' END AS kind FROM att)"""


def _attempts(t: Tables) -> DataFrame:
    codes, kinds = F.lit([200, 403, 429, 503, 0, 404, 401, 410, 500, 202]), F.lit(["ok", "blocked", "api-error", "no-copy", "measured"])
    at = lambda a, c, n: F.element_at(a, (F.col(c) % n + 1).cast("int"))
    made = F.when(F.col("l_suppkey") % 7 == 0, F.array().cast("array<int>")).when(F.col("l_suppkey") % 2 == 0, F.array(at(codes, "l_partkey", 10))).otherwise(F.array(at(codes, "l_suppkey", 10), at(codes, "l_partkey", 10)))
    k = F.col("l_orderkey")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", at(kinds, "l_partkey", 5).alias("status"), made.alias("codes"), (k % 3 == 0).alias("body"), (k % 8 == 0).alias("challenged"),
        F.when(k % 5 == 0, F.lit(["a=miss", "b=blocked"])).otherwise(F.lit(["a=miss"])).alias("tried"), F.when(k % 9 == 0, F.lit("open_access")).otherwise(F.lit("mirror")).alias("route"))
    return rows.withColumn("kind", R.attempt_class(F.col("status"), F.col("codes")))


@query(f"WITH {_ATT} SELECT status, kind, count(*) AS n FROM ac GROUP BY ALL")
def attempt_classes(t: Tables) -> DataFrame:
    return _attempts(t).groupBy("status", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_ATT}, b AS (SELECT *, CASE WHEN challenged THEN ['challenge_or_bot_check', 'bytes'] WHEN route = 'open_access' THEN ['challenge_or_bot_check', 'inferred']
  WHEN codes[-1] = 401 THEN ['identity_required', CASE WHEN body THEN 'bytes' ELSE 'detail' END] WHEN codes[-1] IN (404, 410) THEN ['not_found', CASE WHEN body THEN 'bytes' ELSE 'detail' END]
  WHEN body AND codes[-1] = 403 THEN ['identity_required', 'bytes'] WHEN body THEN ['html_or_reader', 'bytes'] WHEN list_contains(tried, 'b=blocked') THEN ['challenge_or_bot_check', 'inferred']
  WHEN list_contains(codes, 200) THEN ['html_or_reader', 'inferred'] WHEN list_contains(codes, 403) THEN ['challenge_or_bot_check', 'inferred'] END AS v FROM ac WHERE status = 'blocked')
SELECT v[1] AS sub_status, v[2] AS basis, count(*) AS n FROM b GROUP BY ALL""")
def blocked_types(t: Tables) -> DataFrame:
    v = R.blocked_type(*(F.col(c) for c in ("codes", "body", "challenged", "tried", "route")))
    return _attempts(t).filter("status = 'blocked'").select(v.alias("v")).groupBy("v.sub_status", "v.basis").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH RECURSIVE {_ATT}, z AS (SELECT * REPLACE (CASE WHEN kind <> 'transient' AND len(list_filter(codes, lambda c: c BETWEEN 200 AND 299)) > 0 THEN 'success' ELSE kind END AS kind) FROM ac),
q AS (SELECT l_orderkey, kind, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, kind) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM z),
f(l_orderkey, i, d) AS (SELECT DISTINCT l_orderkey, 0::BIGINT, 0.0::DOUBLE FROM q UNION ALL
  SELECT f.l_orderkey, f.i + 1, CASE q.kind WHEN 'transient' THEN least(300.0, greatest(d, 1.0) * 2.0) WHEN 'success' THEN greatest(0.0, d - 1.0) ELSE d END FROM f JOIN q ON q.l_orderkey = f.l_orderkey AND q.i = f.i + 1)
SELECT q.l_orderkey, q.n::INT AS answers, f.d AS delay_s FROM q JOIN f ON f.l_orderkey = q.l_orderkey AND f.i = q.n AND q.i = q.n""")
def answer_pacing(t: Tables) -> DataFrame:
    return R.pacing(_attempts(t), "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"], "kind", "codes")


_VER = """s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE year(o_orderdate) END AS built, (1992 + o_custkey % 8)::BIGINT AS yr, ['present', 'absent', 'uncertain', 'unavailable'][o_orderkey % 4 + 1] AS vp FROM orders),
v AS (SELECT *, CASE WHEN built IS NULL THEN 'unknown' WHEN built <= yr - 1 THEN 'present' WHEN built = yr THEN 'build_year' ELSE 'pre_build' END AS va FROM s)"""


@query(f"""WITH {_VER}, x AS (SELECT o_orderkey, va, CASE WHEN va = 'present' AND vp = 'absent' THEN ['uncertain', 'disagree', 'disagree_probe_absent'] WHEN va = 'present' THEN ['present', 'assessor_backbone', '']
  WHEN va IN ('build_year', 'pre_build') AND vp = 'present' THEN ['present', 'probe', CASE WHEN va = 'pre_build' THEN 'disagree_probe_present' ELSE '' END] WHEN va IN ('build_year', 'pre_build') AND vp = 'absent' THEN ['absent', 'probe_confirms_record', '']
  WHEN va = 'pre_build' THEN ['absent', 'assessor_prebuild_weak', ''] WHEN va = 'build_year' THEN ['uncertain', 'build_year_undecided', ''] WHEN vp IN ('present', 'absent') THEN [vp, 'probe_only', ''] ELSE ['uncertain', 'no_evidence', ''] END AS r FROM v)
SELECT o_orderkey, va, r[1] AS final, r[2] AS rule, r[3] AS disagreement FROM x""")
def fused_verdicts(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 17 != 0, F.year("o_orderdate")).alias("built"), (1992 + F.col("o_custkey") % 8).alias("yr"), F.element_at(F.lit(["present", "absent", "uncertain", "unavailable"]), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("vp"))
    o = o.withColumn("va", R.record_verdict(F.col("built"), F.col("yr")))
    return o.select("o_orderkey", "va", R.fused_verdict(F.col("va"), F.col("vp")).alias("r")).select("o_orderkey", "va", "r.*")


_FILES = "f AS (SELECT p_partkey, md5((p_partkey % 150)::VARCHAR) AS digest, 'in/' || p_partkey AS path, p_partkey % 10 = 0 AS locked, (p_size * 1.5)::DOUBLE AS age FROM part), dg AS (SELECT DISTINCT md5((s_suppkey * 3)::VARCHAR) AS digest FROM supplier), pt AS (SELECT DISTINCT 'in/' || (c_custkey * 4) AS path FROM customer)"


def _stored(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    f = t.part.select("p_partkey", F.md5((F.col("p_partkey") % 150).cast("string")).alias("digest"), F.concat(F.lit("in/"), "p_partkey").alias("path"), (F.col("p_partkey") % 10 == 0).alias("locked"), (F.col("p_size") * 1.5).cast("double").alias("age"))
    return f, t.supplier.select(F.md5((F.col("s_suppkey") * 3).cast("string")).alias("digest")), t.customer.select(F.concat(F.lit("in/"), F.col("c_custkey") * 4).alias("path"))


@query(f"""WITH {_FILES}, r AS (SELECT f.*, CASE WHEN digest IN (SELECT digest FROM dg) THEN 'digest' WHEN path IN (SELECT path FROM pt) THEN 'path' WHEN locked THEN 'lock' WHEN age < 48 THEN 'age' ELSE 'none' END AS rule FROM f)
SELECT p_partkey, rule, CASE WHEN rule IN ('digest', 'path') THEN 'owned' WHEN rule IN ('lock', 'age') THEN 'young' ELSE 'orphan' END AS verdict FROM r""")
def stored_file_census(t: Tables) -> DataFrame:
    f, digests, paths = _stored(t)
    return R.ownership(f, digests, paths, "digest", "path", "locked", "age", 48).select("p_partkey", "rule", "verdict")


@query(f"""WITH {_FILES}, a AS (SELECT o_orderkey AS attempt_id, md5((o_orderkey % 170)::VARCHAR) AS digest, 'in/' || (o_orderkey % 200) AS path FROM orders WHERE o_orderkey % 9 = 0), h AS (SELECT c_custkey AS file_id, md5((c_custkey % 120)::VARCHAR) AS digest FROM customer),
al AS (SELECT digest, list(DISTINCT attempt_id) AS ids FROM a GROUP BY 1), ex AS (SELECT digest, path, min(attempt_id) AS id FROM a GROUP BY ALL), hf AS (SELECT digest, list(DISTINCT file_id) AS ids FROM h GROUP BY 1),
p AS (SELECT f.path, f.digest, coalesce(ex.id, CASE WHEN len(al.ids) = 1 THEN al.ids[1] END) AS attempt_id, coalesce(len(al.ids), 0) AS n, CASE WHEN len(hf.ids) = 1 THEN hf.ids[1] END AS file_id FROM f LEFT JOIN al USING (digest) LEFT JOIN ex ON ex.digest = f.digest AND ex.path = f.path LEFT JOIN hf ON hf.digest = f.digest)
SELECT path, digest, attempt_id, CASE WHEN attempt_id IS NULL THEN n ELSE 0 END::INT AS n_attempts, file_id FROM p""")
def payload_links(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    a = t.orders.filter(k % 9 == 0).select(k.alias("attempt_id"), F.md5((k % 170).cast("string")).alias("digest"), F.concat(F.lit("in/"), k % 200).alias("path"))
    h = t.customer.select(F.col("c_custkey").alias("file_id"), F.md5((F.col("c_custkey") % 120).cast("string")).alias("digest"))
    return R.link_payloads(_stored(t)[0].select("path", "digest"), a, h)


@query("SELECT count(*) AS n FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48) AND p_partkey NOT IN (SELECT s_suppkey * 2 FROM supplier) AND p_partkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)")
def unaccounted_parts(t: Tables) -> DataFrame:
    """Stored things that none of three tables accounts for, counted."""
    others = t.lineitem.filter("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey")), t.supplier.select((F.col("s_suppkey") * 2).alias("p_partkey")), t.customer.filter("c_nationkey < 5").select(F.col("c_custkey").alias("p_partkey"))
    return R.without(t.part, ["p_partkey"], *others).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'no customer' AS problem, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'no order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'no line', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'repeated line', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem UNION ALL SELECT 'part priced under 0', count(*) FILTER (p_retailprice <= 0) FROM part""")
def catalog_check(t: Tables) -> DataFrame:
    n = lambda d, name: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("problem"), "n")
    o, li = t.orders, t.lineitem
    out = n(R.without(o.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], t.customer), "no customer")
    out = out.unionByName(n(R.without(li.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], o), "no order"))
    out = out.unionByName(n(R.without(o.withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"], li), "no line"))
    out = out.unionByName(li.agg((F.count(F.lit(1)) - F.countDistinct("l_orderkey", "l_linenumber")).alias("n")).select(F.lit("repeated line").alias("problem"), "n"))
    return out.unionByName(t.part.agg(F.count_if(F.col("p_retailprice") <= 0).alias("n")).select(F.lit("part priced under 0").alias("problem"), "n"))
