"""Queries of linkage, search and versioned records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_title, ratio_udf
from ..operators import index as X
from ..operators import linkage as K
from ..operators import search as R
from ..operators import versioning as V
from ..operators.storage import dealt, place, written
from .base import Tables, query

_NT = "trim(regexp_replace(lower(regexp_extract(text, '^[^\\n]*')), '[^\\p{L}\\p{N}]+', ' ', 'g'))"
_GRAMS = f"g AS (SELECT doc_id, doc_id % 3 + 2000 AS yr, list_distinct(flatten([[substr('  ' || w || ' ', i::BIGINT, 3) FOR i IN range(1, length(w) + 2)] FOR w IN string_split({_NT}, ' ') IF w <> ''])) AS g FROM documents)"


def _titles(t: Tables) -> DataFrame:
    """The whole first line stands for the title that documents have no column for."""
    return t.documents.select("doc_id", F.regexp_extract("text", r"^[^\n]*", 0).alias("title"), (F.col("doc_id") % 3 + 2000).alias("yr"))


@query(f"""WITH {_GRAMS}, p AS (SELECT a.doc_id, b.doc_id AS other, len(list_intersect(a.g, b.g)) AS n, len(a.g) + len(b.g) AS m FROM g a JOIN g b ON a.doc_id <> b.doc_id AND abs(a.yr - b.yr) <= 1 AND len(a.g) > 0 AND least(len(a.g), len(b.g)) >= 0.7 * greatest(len(a.g), len(b.g)))
SELECT doc_id, other, round(n::DOUBLE / (m - n), 6) AS score FROM p WHERE n::DOUBLE / (m - n) >= 0.7 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(n::DOUBLE / (m - n), 6) DESC, other) = 1""")
def trigram_pairs(t: Tables) -> DataFrame:
    return K.similar_titles(_titles(t), None, "doc_id", "other", "title", "yr")


@query()
def title_ratio(t: Tables) -> DataFrame:
    d = _titles(t).select("doc_id", norm_title("title").alias("title"), "yr")
    j = written(trigram_pairs(t), "title-pairs").join(d, "doc_id").join(d.select(F.col("doc_id").alias("other"), F.col("title").alias("t2"), F.col("yr").alias("y2")), "other")
    verdict = K.judge(F.col("ratio"), F.col("title").substr(1, 3) == F.col("t2").substr(1, 3), F.col("yr"), F.col("y2"))
    return dealt(j, "doc_id", 100).withColumn("ratio", F.round(ratio_udf("title", "t2"), 6)).select("doc_id", "other", "ratio", verdict.alias("v")).select("doc_id", "other", "ratio", "v.accepted", "v.note")


_PTS = "a AS (SELECT s_suppkey AS a_id, s_nationkey AS g, (s_suppkey * 37 % 101)::DOUBLE AS x, (s_suppkey * 53 % 97)::DOUBLE AS y FROM supplier), b AS (SELECT c_custkey AS b_id, c_nationkey AS g, (c_custkey * 41 % 101)::DOUBLE AS x, (c_custkey * 59 % 97)::DOUBLE AS y FROM customer)"


@query(f"""WITH {_PTS}, n AS (SELECT g, a_id, b_id, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM a JOIN b USING (g) WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 64),
r AS (SELECT *, row_number() OVER wa AS ra, lead(d2) OVER wa AS na, row_number() OVER wb AS rb, lead(d2) OVER wb AS nb FROM n WINDOW wa AS (PARTITION BY g, a_id ORDER BY d2, b_id), wb AS (PARTITION BY g, b_id ORDER BY d2, a_id))
SELECT g, a_id, b_id, round(sqrt(d2), 4) AS distance FROM r WHERE ra = 1 AND rb = 1 AND (na IS NULL OR na >= d2 * 2.25) AND (nb IS NULL OR nb >= d2 * 2.25)""")
def mutual_nearest(t: Tables) -> DataFrame:
    a = t.supplier.select(F.col("s_suppkey").alias("a_id"), F.col("s_nationkey").alias("g"), (F.col("s_suppkey") * 37 % 101).cast("double").alias("x"), (F.col("s_suppkey") * 53 % 97).cast("double").alias("y"))
    b = t.customer.select(F.col("c_custkey").alias("b_id"), F.col("c_nationkey").alias("g"), (F.col("c_custkey") * 41 % 101).cast("double").alias("x"), (F.col("c_custkey") * 59 % 97).cast("double").alias("y"))
    return K.mutual_nearest(a, b, ["g"], "x", "y", "a_id", "b_id", 8.0, 1.5)


_BOX = "b AS (SELECT l_orderkey AS page, l_linenumber AS box, (l_partkey % 50)::DOUBLE AS x, (l_suppkey % 40)::DOUBLE AS y, 10.0 + l_quantity % 20 AS w, 8.0 + l_linenumber AS h FROM lineitem)"
_PAIRS = _BOX + """, p AS (SELECT a.page, a.box AS a_box, b.box AS b_box, greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS i,
  greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) / least(a.h, b.h) AS band, a.w * a.h AS aa, b.w * b.h AS ba FROM b a JOIN b ON a.page = b.page AND a.box % 2 = 0 AND b.box % 2 = 1)"""


def _boxes(lines: DataFrame) -> DataFrame:
    b = lines.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("box"), (F.col("l_partkey") % 50).cast("double").alias("x"), (F.col("l_suppkey") % 40).cast("double").alias("y"), (10.0 + F.col("l_quantity") % 20).alias("w"), (8.0 + F.col("l_linenumber")).alias("h"))
    b = b.select("page", "box", F.array("x", "y", F.col("x") + F.col("w"), F.col("y") + F.col("h")).alias("bb"))
    a = b.filter("box % 2 = 0").select("page", F.col("box").alias("a_box"), F.col("bb").alias("a"))
    return a.join(b.filter("box % 2 = 1").select("page", F.col("box").alias("b_box"), F.col("bb").alias("b")), "page")


def _overlaps(lines: DataFrame) -> DataFrame:
    r = lambda f: F.round(f(F.col("a"), F.col("b")), 6)
    return _boxes(lines).select("page", "a_box", "b_box", r(K.iou).alias("iou"), r(K.containment).alias("inside"), r(K.band_containment).alias("band"))


_OVERLAPS = f"WITH {_PAIRS} SELECT page, a_box, b_box, round(i / (aa + ba - i), 6) AS iou, round(i / least(aa, ba), 6) AS inside, round(band, 6) AS band FROM p"


@query(_OVERLAPS)
def box_overlap(t: Tables) -> DataFrame:
    return _overlaps(t.lineitem)


@query(f"""WITH RECURSIVE o AS ({_OVERLAPS.replace("WITH", "WITH", 1)}), k AS (SELECT page, a_box, b_box, iou, row_number() OVER (PARTITION BY page ORDER BY iou DESC, a_box, b_box) AS i FROM o WHERE iou >= 0.1),
g(page, i, taken, a, b) AS (SELECT DISTINCT page, 0::BIGINT, false, []::BIGINT[], []::BIGINT[] FROM k UNION ALL
  SELECT k.page, k.i, NOT list_contains(a, k.a_box) AND NOT list_contains(b, k.b_box), CASE WHEN list_contains(a, k.a_box) OR list_contains(b, k.b_box) THEN a ELSE list_append(a, k.a_box::BIGINT) END, CASE WHEN list_contains(a, k.a_box) OR list_contains(b, k.b_box) THEN b ELSE list_append(b, k.b_box::BIGINT) END FROM g JOIN k ON k.page = g.page AND k.i = g.i + 1)
SELECT k.page, a_box, b_box, iou FROM k JOIN g ON g.page = k.page AND g.i = k.i AND g.taken""")
def box_match(t: Tables) -> DataFrame:
    pairs = box_overlap(t).groupBy("page", "a_box", "b_box").agg(F.max("iou").alias("iou"))
    return K.greedy_match(pairs, "page", "a_box", "b_box", "iou", 0.1)


@query("""WITH a AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT o_custkey, o_orderkey AS other, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS m FROM orders WHERE o_orderstatus = 'O')
SELECT a.o_custkey, a.o_orderkey, b.other FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey AND (b.m = 1 OR b.k = a.k)""")
def rank_join(t: Tables) -> DataFrame:
    a = t.orders.filter("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_totalprice")
    b = t.orders.filter("o_orderstatus = 'O'").select("o_custkey", F.col("o_orderkey").alias("other"), "o_orderdate")
    return K.rank_join(a, b, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], [F.col("o_orderdate"), F.col("other")]).select("o_custkey", "o_orderkey", "other")


@query("SELECT o_orderkey, (SELECT v FROM (VALUES (1996), (1998), (2001)) d(v) ORDER BY abs(v - year(o_orderdate)), v LIMIT 1)::INT AS survey FROM orders")
def nearest_year(t: Tables) -> DataFrame:
    dim = t.orders.sparkSession.createDataFrame([(1996,), (1998,), (2001,)], "survey int")
    return K.nearest_dim(t.orders.select("o_orderkey", F.year("o_orderdate").alias("yr")), dim, "yr", "survey").select("o_orderkey", "survey")


@query("""WITH s AS (SELECT l_orderkey, (l_partkey % 80)::BIGINT AS a, (l_partkey % 80 + l_quantity)::BIGINT AS b FROM lineitem), p AS (SELECT DISTINCT l_orderkey, unnest(range(a, least(b, 100))) AS i FROM s)
SELECT s.l_orderkey, round(coalesce(n, 0) / 100.0, 6) AS covered FROM (SELECT DISTINCT l_orderkey FROM s) s LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM p GROUP BY 1) USING (l_orderkey)""")
def covered_share(t: Tables) -> DataFrame:
    s = t.lineitem.select("l_orderkey", (F.col("l_partkey") % 80).alias("a"), F.least(F.lit(100), F.col("l_partkey") % 80 + F.col("l_quantity").cast("long")).alias("b"), F.lit(100).alias("size"))
    return K.interval_cover(s, "l_orderkey", "a", "b", "size")


_WORDS = "[w FOR w IN string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') IF w <> '']"
_TOK = f"tok AS (SELECT doc_id, unnest({_WORDS}) AS token FROM documents), tf AS (SELECT token, doc_id, count(*) AS tf FROM tok GROUP BY ALL), q AS (SELECT item_id, unnest(list_distinct({_WORDS})) AS token FROM benchmark WHERE item_id % 20 = 0)"
_ANY = "round(sum(1 - 1 / (1 + tf)::DOUBLE), 6) AS score"


def _asked(t: Tables) -> DataFrame:
    """The queries of a search: every item_id divisible by 20, with its whole text."""
    return t.benchmark.filter("item_id % 20 = 0").select("item_id", "text")


def _index(t: Tables, stemmed: bool = False) -> DataFrame:
    return R.token_index(t.documents, "doc_id", "text", R.query_terms(_asked(t), "item_id", "text", stemmed), stemmed)


@query(f"WITH {_TOK}, h AS (SELECT item_id, doc_id, {_ANY} FROM q JOIN tf USING (token) GROUP BY ALL) SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM h QUALIFY rank <= 20")
def search_any(t: Tables) -> DataFrame:
    return R.ranked(R.any_term_leg(_asked(t), _index(t), "item_id", "doc_id", "text"), "item_id", "doc_id", 20)


_ALL = f"h AS (SELECT item_id, doc_id, {_ANY}, count(*) AS n FROM q JOIN tf USING (token) GROUP BY ALL), m AS (SELECT item_id, count(*) AS m FROM q GROUP BY 1)"


@query(f"WITH {_TOK}, {_ALL} SELECT item_id, doc_id, score FROM h JOIN m USING (item_id) WHERE n = m")
def search_all(t: Tables) -> DataFrame:
    return R.any_term_leg(_asked(t), _index(t), "item_id", "doc_id", "text", all_terms=True)


_STEM = "regexp_replace(CASE WHEN regexp_matches({0}, '(ed|ing)$') AND regexp_matches(regexp_replace({0}, '(ed|ing)$', ''), '[aeiouy]') THEN regexp_replace({0}, '(ed|ing)$', '') ELSE {0} END, '([^aeiou])y$', '\\1i')".format("regexp_replace(regexp_replace(token, '(ss|i)es$', '\\1'), '([^su])s$', '\\1')")


@query(f"WITH {_TOK.replace('tf AS (SELECT token,', 'tf AS (SELECT ' + _STEM + ' AS token,')}, qs AS (SELECT DISTINCT item_id, {_STEM} AS token FROM q), h AS (SELECT item_id, doc_id, {_ANY} FROM qs JOIN tf USING (token) GROUP BY ALL) SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM h QUALIFY rank <= 20")
def search_stemmed(t: Tables) -> DataFrame:
    """``search_any`` over stems."""
    return R.ranked(R.any_term_leg(_asked(t), _index(t, True), "item_id", "doc_id", "text", stemmed=True), "item_id", "doc_id", 20)


_KIND = "['paragraph', 'heading', 'page_header', 'reference', 'table'][doc_id % 5 + 1]"
_SEEN = f"seen AS (SELECT doc_id, text FROM documents WHERE doc_id % 3 = CASE WHEN (doc_id % 40) % 6 = 0 THEN NULL ELSE (doc_id % 40) % 3 END AND {_KIND} NOT IN ('page_header', 'reference') AND (doc_id % 4 <> 0 OR 'w' || (doc_id % 8) = 'w4'))"


@query(f"WITH {_SEEN}, {_TOK.replace('FROM documents', 'FROM seen')}, h AS (SELECT item_id, doc_id, {_ANY} FROM q JOIN tf USING (token) GROUP BY ALL) SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM h QUALIFY rank <= 20")
def search_visible(t: Tables) -> DataFrame:
    """A search of the blocks that a workstream may see: of current runs, of the default kinds, its own or nobody's."""
    k = F.col("doc_id")
    kind = F.element_at(F.lit(["paragraph", "heading", "page_header", "reference", "table"]), (k % 5 + 1).cast("int"))
    blocks = t.documents.select("doc_id", "text", (k % 40).alias("file"), (k % 3).alias("run"), kind.alias("kind"), F.when(k % 4 == 0, F.concat(F.lit("w"), k % 8)).alias("ws"))
    files = t.documents.sparkSession.range(40).select(F.col("id").alias("file"), F.when(F.col("id") % 6 != 0, F.col("id") % 3).alias("current"))
    seen = R.visible(blocks, files, "file", "run", "current", "kind", "", ["w4"], "ws")
    index = R.token_index(seen, "doc_id", "text", R.query_terms(_asked(t), "item_id", "text"))
    return R.ranked(R.any_term_leg(_asked(t), index, "item_id", "doc_id", "text"), "item_id", "doc_id", 20)


_GRAM = "list_distinct(flatten([[substr('  ' || w || ' ', i::BIGINT, 3) FOR i IN range(1, length(w) + 2)] FOR w IN string_split(trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') IF w <> '']))"
_TRGM = f"""qg AS (SELECT item_id, (200 * pow(2, ceil(log2(greatest(length(text), 200) / 200))))::INT AS size, {_GRAM.format('text')} AS g FROM benchmark WHERE item_id % 20 = 0), cut AS (SELECT doc_id, s.size, i, substr(text, (i * (s.size // 2) + 1)::BIGINT, s.size::BIGINT) AS part FROM documents, (SELECT DISTINCT size FROM qg) s, LATERAL range(0, greatest(0, ceil(length(text) / (s.size // 2))::INT - 2) + 1) r(i)),
pg AS (SELECT doc_id, size, {_GRAM.format('part')} AS g FROM cut), tg AS (SELECT item_id, doc_id, round(max(n / (a + b - n)), 6) AS score FROM (SELECT item_id, doc_id, len(list_intersect(qg.g, pg.g))::DOUBLE AS n, len(qg.g) AS a, len(pg.g) AS b FROM qg JOIN pg USING (size)) WHERE n > 0 GROUP BY ALL)"""


@query(f"""WITH {_TOK}, {_ALL}, {_TRGM}, l AS (SELECT item_id, doc_id, score, 1 AS leg FROM h JOIN m USING (item_id) WHERE n = m UNION ALL SELECT item_id, doc_id, score, 2 FROM h UNION ALL SELECT item_id, doc_id, score, 3 FROM tg WHERE score >= 0.2),
r AS (SELECT *, row_number() OVER (PARTITION BY leg, item_id ORDER BY score DESC, doc_id) AS k FROM l QUALIFY k <= 50) SELECT item_id, doc_id, round(sum(1 / (60 + k)), 8) AS score, count(*) AS n_legs FROM r GROUP BY ALL""")
def search_rrf(t: Tables) -> DataFrame:
    """Hybrid search: an all-terms, an any-term and a trigram leg over passages of whole texts, fused by reciprocal rank."""
    asked, index = _asked(t), _index(t)
    legs = [R.any_term_leg(asked, index, "item_id", "doc_id", "text", all_terms=True), R.any_term_leg(asked, index, "item_id", "doc_id", "text"), R.passage_leg(asked, t.documents, "item_id", "doc_id", "text", 0.2)]
    return R.fuse([R.ranked(leg, "item_id", "doc_id", 50) for leg in legs], "item_id", "doc_id")


def _scope(name: str, table: str) -> str:
    """The three legs of one scope, and their fusion with the places that each gave."""
    legs = f"{_TOK}, {_ALL}, {_TRGM}".replace("FROM documents", f"FROM {table}")
    return f"""SELECT item_id, '{name}' AS scope, doc_id AS doc, score, rank_all, rank_any, rank_trigram FROM (WITH {legs}, l AS (SELECT item_id, doc_id, score, 1 AS leg FROM h JOIN m USING (item_id) WHERE n = m UNION ALL SELECT item_id, doc_id, score, 2 FROM h UNION ALL SELECT item_id, doc_id, score, 3 FROM tg WHERE score >= 0.2),
r AS (SELECT *, row_number() OVER (PARTITION BY leg, item_id ORDER BY score DESC, doc_id)::INT AS k FROM l QUALIFY k <= 50), z AS (SELECT item_id, doc_id, round(sum(1 / (60 + k)), 8) AS score, max(k) FILTER (leg = 1) AS rank_all, max(k) FILTER (leg = 2) AS rank_any, max(k) FILTER (leg = 3) AS rank_trigram FROM r GROUP BY ALL)
SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20)"""


@query(f"WITH uses_ AS (SELECT conv_id * 100 + turn AS doc_id, text FROM conversations) {_scope('blocks', 'documents')} UNION ALL {_scope('uses', 'uses_')}")
def search_everything(t: Tables) -> DataFrame:
    """Documents and turns of conversations through an index that is written in two appends, the second over what was there: six legs."""
    spark, docs = t.documents.sparkSession, t.documents.select("doc_id", "text")
    folder = place(spark, "search-index")
    stale = docs.filter("doc_id % 5 = 0").withColumn("text", F.lit("an earlier text of this document"))
    X.add(docs.filter("doc_id % 2 = 1").unionByName(stale), folder, "blocks", "doc_id", "text", 1)
    X.add(docs.filter("doc_id % 2 = 0 OR doc_id % 5 = 0"), folder, "blocks", "doc_id", "text", 2)
    X.add(t.conversations.select((F.col("conv_id") * 100 + F.col("turn")).alias("use_id"), "text"), folder, "uses", "use_id", "text", 1)
    return X.search(_asked(t), "item_id", "text", folder, "blocks").unionByName(X.search(_asked(t), "item_id", "text", folder, "uses"))


@query("""WITH v AS (SELECT q.vec_id AS query_id, c.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score FROM embeddings q JOIN embeddings c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM v QUALIFY rank <= 5""")
def embedding_cosine(t: Tables) -> DataFrame:
    """The five nearest by cosine of every vec_id divisible by 20, in blocks of queries."""
    return R.ranked(R.cosine_leg(t.embeddings, 20, 5, "vec_id", "embedding"), "query_id", "vec_id", 5)


_VER = "ver AS (SELECT o_orderkey AS vid, o_custkey AS cid, o_totalprice AS price, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS base, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS no FROM orders), ident AS (SELECT cid, arg_max(vid, CASE WHEN no % 3 = 1 THEN no ELSE -no END) AS pointer FROM ver GROUP BY cid), heads AS (SELECT 'ws' || (cid % 2) AS ws, cid, max(vid) AS head FROM ver WHERE cid % 5 = 0 GROUP BY ALL)"


def _versions(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    ver = t.orders.select(F.col("o_orderkey").alias("vid"), F.col("o_custkey").alias("cid"), F.col("o_totalprice").alias("price"), F.lag("o_orderkey").over(w).alias("base"), F.row_number().over(w).alias("no"))
    ident = ver.groupBy("cid").agg(F.max_by("vid", F.when(F.col("no") % 3 == 1, F.col("no")).otherwise(-F.col("no"))).alias("pointer"))
    heads = ver.filter("cid % 5 = 0").groupBy(F.concat(F.lit("ws"), F.col("cid") % 2).alias("ws"), "cid").agg(F.max("vid").alias("head"))
    return ver, ident, heads


@query(f"WITH {_VER} SELECT i.cid, vid, price FROM ident i JOIN ver ON pointer = vid")
def current_view(t: Tables) -> DataFrame:
    ver, ident, _ = _versions(t)
    return V.current(ident, ver.select("vid", "price"), "pointer", "vid").select("cid", "vid", "price")


@query(f"WITH {_VER} SELECT s.ws, i.cid, vid, price FROM ident i CROSS JOIN (SELECT DISTINCT ws FROM heads) s LEFT JOIN heads h ON h.ws = s.ws AND h.cid = i.cid JOIN ver ON vid = coalesce(head, pointer)")
def overlay_view(t: Tables) -> DataFrame:
    ver, ident, heads = _versions(t)
    return V.overlay(ident, heads, ver.select("vid", "price"), "cid", "ws", "head", "pointer", "vid").select("ws", "cid", "vid", "price")


@query(f"WITH RECURSIVE {_VER}, c(head, version, depth) AS (SELECT head, head, 0 FROM heads UNION ALL SELECT c.head, base, depth + 1 FROM c JOIN ver ON vid = version WHERE base IS NOT NULL) SELECT head, version, depth FROM c")
def chain_depth(t: Tables) -> DataFrame:
    ver, _, heads = _versions(t)
    return V.chains(ver, heads, "vid", "base", "head")


@query(f"""WITH RECURSIVE {_VER}, h(vid) AS (SELECT vid FROM ver WHERE vid % 11 = 0 UNION SELECT ver.vid FROM h JOIN ver ON ver.base = h.vid) SELECT vid, CASE WHEN vid IN (SELECT vid FROM h) THEN 'hold' ELSE 'prepare' END AS mark FROM ver""")
def hold_fixpoint(t: Tables) -> DataFrame:
    ver, _, _ = _versions(t)
    return V.hold_fixpoint(ver.select("vid", (F.col("vid") % 11 == 0).alias("held")), ver.filter("base IS NOT NULL").select("vid", "base"), "vid", "held", "base")


@query(f"WITH {_VER} SELECT cid, sha256(array_to_string(list_sort(list(DISTINCT vid::VARCHAR)), ',')) AS set_hash FROM ver GROUP BY cid")
def version_set_hash(t: Tables) -> DataFrame:
    return V.set_hash(_versions(t)[0], ["cid"], "vid")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def enqueue_new(t: Tables) -> DataFrame:
    return V.enqueue(t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey")), t.orders.select("o_custkey"), "o_custkey")


@query("SELECT o_orderkey, CASE WHEN c_mktsegment IS NULL THEN 'accept' WHEN c_mktsegment = CASE WHEN o_orderkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END THEN 'corroborate' ELSE 'conflict' END AS outcome FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 3 <> 0")
def identifier_claims(t: Tables) -> DataFrame:
    held = t.customer.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("seg"))
    claimed = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 2 == 0, F.lit("BUILDING")).otherwise(F.lit("MACHINERY")).alias("seg"))
    return V.claims(held, claimed, "o_custkey", "seg").select("o_orderkey", "outcome")


_INV = "o AS (SELECT 'p' || doc_id AS path, md5(text) AS h FROM documents WHERE doc_id % 10 <> 0), n AS (SELECT 'p' || (CASE WHEN doc_id % 7 = 0 THEN doc_id + 100000 ELSE doc_id END) AS path, md5(CASE WHEN doc_id % 13 = 0 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 10 <> 1)"


@query(f"""WITH {_INV}, b AS (SELECT coalesce(o.path, n.path) AS path, o.h AS oh, n.h AS nh FROM o FULL JOIN n ON o.path = n.path), g AS (SELECT oh AS h, min(path) AS was FROM b WHERE nh IS NULL GROUP BY 1)
SELECT path, CASE WHEN oh IS NULL AND was IS NOT NULL THEN 'renamed' WHEN oh IS NULL THEN 'new' WHEN nh IS NULL THEN 'missing' WHEN oh = nh THEN 'same' ELSE 'changed' END AS state, CASE WHEN oh IS NULL THEN was END AS was FROM b LEFT JOIN g ON nh = h""")
def inventory_diff(t: Tables) -> DataFrame:
    d = t.documents
    old = d.filter("doc_id % 10 <> 0").select(F.concat(F.lit("p"), "doc_id").alias("path"), F.md5("text").alias("h"))
    new = d.filter("doc_id % 10 <> 1").select(F.concat(F.lit("p"), F.when(F.col("doc_id") % 7 == 0, F.col("doc_id") + 100000).otherwise(F.col("doc_id"))).alias("path"), F.md5(F.when(F.col("doc_id") % 13 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("h"))
    return V.inventory_diff(old, new, "path", "h")


@query("""WITH b AS (SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN p_retailprice + 1 ELSE p_retailprice + 0.001 END AS p_retailprice, CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_size END AS p_size FROM part WHERE p_partkey % 23 <> 0),
j AS (SELECT p_partkey, a.p_retailprice AS ap, b.p_retailprice AS bp, a.p_size::DOUBLE AS az, b.p_size::DOUBLE AS bz FROM part a FULL JOIN b USING (p_partkey))
SELECT p_partkey, 'p_retailprice' AS column, ap AS a, bp AS b FROM j WHERE ap IS DISTINCT FROM bp AND (ap IS NULL OR bp IS NULL OR abs(ap - bp) > 0.01) UNION ALL SELECT p_partkey, 'p_size', az, bz FROM j WHERE az IS DISTINCT FROM bz""")
def table_diff(t: Tables) -> DataFrame:
    b = t.part.filter("p_partkey % 23 <> 0").select("p_partkey", F.when(F.col("p_partkey") % 17 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice") + 0.001).alias("p_retailprice"), F.when(F.col("p_partkey") % 19 != 0, F.col("p_size")).alias("p_size"))
    return V.differs(t.part, b, ["p_partkey"], {"p_retailprice": 0.01, "p_size": 0.0})
