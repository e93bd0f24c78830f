"""Queries of names, keys, references and the citation graph: parts as works, line items as references and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..functions import markup as M
from ..functions import names as N
from ..functions import text as X
from ..operators import citations as C
from .base import Tables, query

_FOLD = "list_filter([regexp_replace(w, '[^\\p{{L}}]', '', 'g') FOR w IN regexp_split_to_array(lower(strip_accents(regexp_replace({0}, '<[^>]*>', ' ', 'g'))), '[^\\p{{L}}\\p{{N}}_''‐‑’ʼ-]+')], lambda w: w <> '')"


@query(f"WITH f AS (SELECT doc_id, {_FOLD.format('text')} AS w FROM documents WHERE lang IN ('en', 'de', 'es', 'fr')) SELECT doc_id, len(w)::INT AS n, w[1] AS first, w[-1] AS last, md5(array_to_string(w, ' ')) AS digest FROM f")
def folded_tokens(t: Tables) -> DataFrame:
    w = F.col("w")
    d = t.documents.filter(F.col("lang").isin("en", "de", "es", "fr")).select("doc_id", N.fold_tokens("text").alias("w"))
    return d.select("doc_id", F.size(w).alias("n"), F.try_element_at(w, F.lit(1)).alias("first"), F.try_element_at(w, F.lit(-1)).alias("last"), F.md5(F.array_join(w, " ")).alias("digest"))


_AUTH = "a AS (SELECT p_partkey, ['Maria', 'De', 'La', 'Cruz', 'and', 'Wang1,2', 'Delacruz', 'O''Neil'][p_partkey % 5 + 1 : p_partkey % 5 + 4] AS line, ['De la Cruz', 'Wang', 'Cruz', 'Neil', 'Mar'][p_partkey % 5 + 1] AS fam FROM part)"


@query(f"""WITH {_AUTH}, f AS (SELECT p_partkey, {_FOLD.format("array_to_string(line, ' ')")} AS w, array_to_string({_FOLD.format('fam')}, '') AS j FROM a)
SELECT p_partkey, coalesce(list_bool_or([[array_to_string(w[i : i + n - 1], '') = j OR (length(j) >= 5 AND length(array_to_string(w[i : i + n - 1], '')) = length(j) + 1 AND starts_with(array_to_string(w[i : i + n - 1], ''), j)) FOR n IN range(1, len(w) - i + 2)].list_bool_or() FOR i IN range(1, len(w) + 1)]), false) AS on_page FROM f""")
def surname_on_page(t: Tables) -> DataFrame:
    words, fams = F.lit(["Maria", "De", "La", "Cruz", "and", "Wang1,2", "Delacruz", "O'Neil"]), F.lit(["De la Cruz", "Wang", "Cruz", "Neil", "Mar"])
    k = (F.col("p_partkey") % 5 + 1).cast("int")
    line = F.array_join(F.slice(words, k, F.lit(4)), " ")
    return t.part.select("p_partkey", N.tokens_contain(N.fold_tokens(line), N.fold_tokens(F.element_at(fams, k))).alias("on_page"))


_KEYS = "k AS (SELECT doc_id, ['PAGE', 'DelaCruz', 'van der Berg', 'Müller', '', 'Land Product Validation Subgroup (Working Group on Calibration and Validation', '王'][doc_id % 7 + 1] AS author, CASE WHEN doc_id % 90 = 0 THEN 12019 ELSE 1900 + doc_id % 120 END AS yr, regexp_extract(text, '^[^\\n]*') AS title FROM documents)"
_STOPS = ", ".join(f"'{w}'" for w in N.STOP)


@query(f"""WITH {_KEYS}, p AS (SELECT doc_id, yr, array_to_string([upper(x[1:1]) || CASE WHEN length(x) > 1 AND x = upper(x) THEN lower(x[2:]) ELSE x[2:] END FOR x IN regexp_extract_all(strip_accents(author), '[A-Za-z]+')], '') AS s, regexp_extract_all(lower(strip_accents(title)), '[a-z0-9]+') AS w FROM k),
q AS (SELECT *, CASE WHEN len(list_filter(w, lambda x: x NOT IN ({_STOPS}))) > 0 THEN list_filter(w, lambda x: x NOT IN ({_STOPS})) ELSE w END AS k1 FROM p),
r AS (SELECT *, CASE WHEN len(k1) >= 2 THEN k1 ELSE list_concat(list_concat(k1, list_filter(w, lambda x: NOT list_contains(k1, x))), ['work', 'record'])[1:2] END AS k2, (CASE WHEN s = '' THEN 'Anon' WHEN length(s) > 49 THEN 'LPVSWGCV' ELSE s END) || '_' || yr || '_' AS h FROM q),
x AS (SELECT *, list_filter([h || array_to_string(k2[1:n], '-') FOR n IN [4, 3, 2]], lambda x: length(x) <= 58)[1] AS fit, 57 - length(h) AS room FROM r),
y AS (SELECT *, least(length(k2[1]), greatest(room - length(k2[2]), room // 2)) AS cut FROM x)
SELECT doc_id, CASE WHEN yr < 10000 THEN CASE WHEN fit IS NOT NULL THEN fit ELSE h || k2[1][1:cut] || '-' || k2[2][1:(room - cut)] END END AS key FROM y""")
def citation_keys(t: Tables) -> DataFrame:
    names = ["PAGE", "DelaCruz", "van der Berg", "Müller", "", "Land Product Validation Subgroup (Working Group on Calibration and Validation", "王"]
    year = F.when(F.col("doc_id") % 90 == 0, 12019).otherwise(1900 + F.col("doc_id") % 120)  # no key has five digits
    author = F.element_at(F.lit(names), (F.col("doc_id") % 7 + 1).cast("int"))
    return t.documents.select("doc_id", N.citation_key(author, year, F.regexp_extract("text", r"^[^\n]*", 0)).alias("key"))


@query("""WITH r(i, ref) AS (VALUES (0, '10.1000/AB c'), (1, 'doi:10.1000/x'), (2, 'https://doi.org/10.1000/x'), (3, 'https://doi.org/none'), (4, 'http://example.org/a'), (5, 'arXiv:2101.00001v2'), (6, 'Some title'), (7, '978-3-16-148410-0')),
k(i, kind) AS (VALUES (0, 'doi'), (1, 'doi'), (2, 'doi'), (3, NULL), (4, 'url'), (5, 'arxiv'), (6, NULL), (7, NULL)) SELECT kind, count(*) AS n FROM part JOIN k ON i = p_partkey % 8 GROUP BY kind""")
def reference_kinds(t: Tables) -> DataFrame:
    refs = F.lit(["10.1000/AB c", "doi:10.1000/x", "https://doi.org/10.1000/x", "https://doi.org/none", "http://example.org/a", "arXiv:2101.00001v2", "Some title", "978-3-16-148410-0"])
    return t.part.select(I.reference_kind(F.element_at(refs, (F.col("p_partkey") % 8 + 1).cast("int"))).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


_TN = "trim(regexp_replace(lower(regexp_replace({0}, '<[^>]*>', ' ', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


@query(f"""WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS w FROM documents), p AS (SELECT doc_id, {_TN.format("array_to_string(w[1 : 12], ' ')")} AS x, {_TN.format("array_to_string(w[doc_id % 3 + 1 : doc_id % 9 + 4], ' ')")} AS y FROM s),
q AS (SELECT doc_id, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS a, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS b FROM p)
SELECT doc_id, len(string_split(a, ' '))::INT AS words, round(length(a) / length(b), 6) AS share FROM q WHERE a <> '' AND contains(b, a) AND len(string_split(a, ' ')) >= 5 AND length(a) / length(b) >= 0.6""")
def title_containments(t: Tables) -> DataFrame:
    words = F.split(F.regexp_replace("text", r"\s+", " "), " ")
    part = lambda w, a, b: F.array_join(F.slice(w, a, F.greatest(b - a + 1, F.lit(0))), " ")
    k = F.col("doc_id")
    c = I.let(words, lambda w: N.title_containment(part(w, F.lit(1), F.lit(12)), part(w, (k % 3 + 1).cast("int"), (k % 9 + 4).cast("int"))))
    found = t.documents.select("doc_id", F.explode(F.array_compact(F.array(c))).alias("c"))  # a filter on c would work it out again
    return found.select("doc_id", "c.words", F.round("c.share", 6).alias("share"))


_WORKS = "w AS (SELECT p_partkey AS work, ' DOI:10.' || (1000 + p_partkey % 90) || '/X' || (p_partkey % 60) || '.' AS value, p_name AS title FROM part), ix AS (SELECT regexp_replace(regexp_extract(lower(regexp_replace(value, '\\s', '', 'g')), '10\\..*$'), '[/.,;:]+$', '') AS doi, min(work) AS work FROM w GROUP BY 1)"


def _works(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(k.alias("work"), F.concat(F.lit(" DOI:10."), 1000 + k % 90, F.lit("/X"), k % 60, F.lit(".")).alias("value"), F.col("p_name").alias("title"))


@query(f"WITH {_WORKS} SELECT doi, work FROM ix")
def doi_index(t: Tables) -> DataFrame:
    return C.doi_index(_works(t), "work", "value")


@query(f"""WITH {_WORKS}, r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE '10.' || (1000 + o_custkey % 120) || '/x' || (o_custkey % 60) END AS doi, CASE WHEN o_orderkey % 2 = 0 THEN upper(replace(p_name, ' ', '-')) ELSE 'other' END AS t, o_custkey FROM orders LEFT JOIN part ON p_partkey = (SELECT work FROM ix WHERE ix.doi = '10.' || (1000 + o_custkey % 120) || '/x' || (o_custkey % 60)))
SELECT CASE WHEN r.doi = '' THEN 'no-doi' WHEN h.p_name IS NULL THEN 'unknown' WHEN trim(regexp_replace(lower(r.t), '[^a-z0-9]+', ' ', 'g')) = trim(regexp_replace(lower(h.p_name), '[^a-z0-9]+', ' ', 'g')) THEN 'resolved' ELSE 'mismatch' END AS state, count(*) AS n FROM r LEFT JOIN ix ON ix.doi = r.doi LEFT JOIN part h ON h.p_partkey = ix.work GROUP BY 1""")
def reference_resolution(t: Tables) -> DataFrame:
    """A histogram of how references resolve through their own DOIs."""
    held = C.doi_index(_works(t), "work", "value").join(t.part.select(F.col("p_partkey").alias("work"), F.col("p_name").alias("held_title")), "work")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    refs = t.orders.select(k, F.concat(F.lit("10."), 1000 + c % 120, F.lit("/x"), c % 60).alias("d")).join(held.select(F.col("doi").alias("d"), F.col("held_title").alias("ht")), "d", "left")
    refs = refs.select("o_orderkey", F.when(k % 9 == 0, F.lit("")).otherwise(F.col("d")).alias("ref_doi"), F.when(k % 2 == 0, F.upper(F.replace(F.col("ht"), F.lit(" "), F.lit("-")))).otherwise(F.lit("other")).alias("title"))
    return C.resolve(refs, held, "ref_doi", "title", "held_title").groupBy("state").agg(F.count(F.lit(1)).alias("n"))


_REFS = "rf AS (SELECT o_custkey AS paper, o_orderkey AS pos, 'r' || o_orderkey AS ref_key, CASE WHEN o_orderkey % 6 = 0 THEN repeat(o_orderpriority || ' ', 300) ELSE o_orderpriority END AS raw, CASE WHEN o_orderkey % 9 > 0 THEN o_orderstatus END AS title FROM orders), ed AS (SELECT paper, ref_key FROM rf WHERE pos % 4 = 1), cd AS (SELECT paper, pos, CASE WHEN pos % 11 = 0 THEN 'x' WHEN pos % 12 = 0 THEN raw ELSE raw[1:2000] END AS raw, CASE WHEN pos % 7 = 0 THEN 'F' ELSE title END AS title FROM rf WHERE pos % 4 <> 1 AND pos % 50 <> 0)"


@query(f"""WITH {_REFS}, o AS (SELECT *, row_number() OVER (PARTITION BY paper ORDER BY pos) AS k, count(*) OVER (PARTITION BY paper) AS n FROM rf WHERE (paper, ref_key) NOT IN (SELECT (paper, ref_key) FROM ed)), c AS (SELECT *, row_number() OVER (PARTITION BY paper ORDER BY pos) AS k, count(*) OVER (PARTITION BY paper) AS n FROM cd)
SELECT o.paper, ref_key, o.k::INT AS place, CASE WHEN o.n IS DISTINCT FROM m.n THEN 'count' WHEN o.raw[1:2000] = c.raw AND o.title IS NOT DISTINCT FROM c.title THEN 'ok' ELSE 'mismatch' END AS state FROM o LEFT JOIN c USING (paper, k) LEFT JOIN (SELECT DISTINCT paper, n FROM c) m ON m.paper = o.paper""")
def candidate_pairing(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    refs = t.orders.select(F.col("o_custkey").alias("paper"), k.alias("pos"), F.concat(F.lit("r"), k).alias("ref_key"), F.when(k % 6 == 0, F.repeat(F.concat("o_orderpriority", F.lit(" ")), 300)).otherwise(F.col("o_orderpriority")).alias("raw"), F.when(k % 9 > 0, F.col("o_orderstatus")).alias("title"))
    whole = (F.col("pos") % 12 == 0) | (F.col("pos") % 11 == 0)
    cands = refs.filter("pos % 4 <> 1 AND pos % 50 <> 0").select("paper", "pos", F.when(F.col("pos") % 11 == 0, F.lit("x")).when(whole, F.col("raw")).otherwise(F.substring("raw", 1, 2000)).alias("raw"), F.when(F.col("pos") % 7 == 0, F.lit("F")).otherwise(F.col("title")).alias("title"))
    return C.pair_candidates(refs, refs.filter("pos % 4 = 1"), cands, "paper")


_ID = "own AS (SELECT p_partkey AS work, 'doi' AS scheme, 'd' || (p_partkey % 70) AS value FROM part), rel AS (SELECT l_partkey AS work, CASE WHEN l_linenumber % 2 = 0 THEN 'doi' ELSE 'arxiv' END AS scheme, 'd' || (l_suppkey % 75) AS value, ['has_version', 'has_preprint'][l_linenumber % 2 + 1] AS relation, l_orderkey * 10 + l_linenumber AS seq FROM lineitem)"


@query(f"WITH {_ID}, u AS (SELECT work, scheme, value, 'own' AS via, -1 AS s FROM own UNION ALL SELECT work, scheme, value, relation, seq FROM rel) SELECT work, scheme, value, arg_min(via, (s, via)) AS via FROM u GROUP BY ALL")
def copy_identifiers(t: Tables) -> DataFrame:
    own = t.part.select(F.col("p_partkey").alias("work"), F.lit("doi").alias("scheme"), F.concat(F.lit("d"), F.col("p_partkey") % 70).alias("value"))
    two = F.col("l_linenumber") % 2
    rel = t.lineitem.select(F.col("l_partkey").alias("work"), F.when(two == 0, F.lit("doi")).otherwise(F.lit("arxiv")).alias("scheme"), F.concat(F.lit("d"), F.col("l_suppkey") % 75).alias("value"), F.when(two == 0, F.lit("has_version")).otherwise(F.lit("has_preprint")).alias("relation"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return C.copy_identifiers(own, rel, "work")


_EDGES = "e AS (SELECT DISTINCT l_partkey AS source, ['is_part_of', 'is_version_of', 'cites', 'mentions'][l_linenumber % 4 + 1] AS relation, l_suppkey AS target FROM lineitem)"


@query(f"WITH {_EDGES}, i(relation, back) AS (VALUES ('is_part_of', 'has_part'), ('is_version_of', 'has_version'), ('cites', 'is_cited_by')) SELECT source, relation, target FROM e UNION SELECT target, back, source FROM e JOIN i USING (relation)")
def work_relations(t: Tables) -> DataFrame:
    rel = F.element_at(F.lit(["is_part_of", "is_version_of", "cites", "mentions"]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    edges = t.lineitem.select(F.col("l_partkey").alias("source"), rel.alias("relation"), F.col("l_suppkey").alias("target"))
    return C.with_inverses(edges, {"is_part_of": "has_part", "is_version_of": "has_version", "cites": "is_cited_by"})


@query("WITH e AS (SELECT DISTINCT l_partkey AS citing, l_suppkey AS cited FROM lineitem), u AS (SELECT citing AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT cited, 0, 1 FROM e) SELECT node, sum(o)::BIGINT AS cites, sum(i)::BIGINT AS cited FROM u GROUP BY 1")
def citation_degrees(t: Tables) -> DataFrame:
    return C.degrees(t.lineitem.select(F.col("l_partkey").alias("citing"), F.col("l_suppkey").alias("cited")).distinct())


@query("""WITH c AS (SELECT o_orderkey AS claim, 'v' || (o_custkey % 90) AS value FROM orders), i AS (SELECT 'v' || c_custkey AS value, c_custkey % 25 AS work FROM customer WHERE c_custkey % 3 = 0), s AS (SELECT l_orderkey AS claim, l_partkey AS work, l_quantity AS score FROM lineitem WHERE l_quantity > 45),
h AS (SELECT value, min(work) AS w FROM i GROUP BY 1), b AS (SELECT claim, arg_max(work, (score, -work)) AS w FROM s GROUP BY 1)
SELECT c.claim, CASE WHEN h.w IS NOT NULL THEN 'duplicate' WHEN b.w IS NOT NULL THEN 'similar' ELSE 'admit' END AS decision, coalesce(h.w, b.w) AS work FROM c LEFT JOIN h USING (value) LEFT JOIN b ON b.claim = c.claim""")
def admission_gate(t: Tables) -> DataFrame:
    claims = t.orders.select(F.col("o_orderkey").alias("claim"), F.concat(F.lit("v"), F.col("o_custkey") % 90).alias("value"))
    ids = t.customer.filter("c_custkey % 3 = 0").select(F.concat(F.lit("v"), "c_custkey").alias("value"), (F.col("c_custkey") % 25).alias("work"))
    near = t.lineitem.filter("l_quantity > 45").select(F.col("l_orderkey").alias("claim"), F.col("l_partkey").alias("work"), F.col("l_quantity").alias("score"))
    return C.admission(claims, ids, near, "claim")


@query("""WITH s AS (SELECT l_orderkey, l_linenumber * 1000000 + l_partkey AS i, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_partkey END AS hit FROM lineitem),
f AS (SELECT *, coalesce(max(hit) OVER (PARTITION BY l_orderkey ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS far FROM (SELECT l_orderkey, i, any_value(hit) AS hit FROM s GROUP BY l_orderkey, i)) SELECT l_orderkey, i, hit FROM f WHERE hit IS NULL OR hit < far""")
def order_violations(t: Tables) -> DataFrame:
    s = t.lineitem.select("l_orderkey", (F.col("l_linenumber").cast("long") * 1000000 + F.col("l_partkey")).alias("i"), F.when(F.col("l_suppkey") % 9 != 0, F.col("l_partkey")).alias("hit"))
    return C.order_violations(s.groupBy("l_orderkey", "i").agg(F.first("hit", True).alias("hit")), ["l_orderkey"], "i", "hit")


_REV = """rv AS (SELECT o_orderkey, 'As "x" [W' || (o_custkey % 50) || ' p.' || (o_custkey % 7) || ' #a' || (o_custkey % 40) || '] and [W1 p.2 #ff] say, not [w p.x #1].' AS text FROM orders), bl AS (SELECT 'a' || range AS block_id, 'W' || (range + range // 30) AS work_key, (range % 7)::INT AS page FROM range(36)),
ci AS (SELECT o_orderkey, unnest(regexp_extract_all(text, '\\[[A-Za-z0-9][A-Za-z0-9_.:+-]* p\\.\\d+ #[0-9a-fA-F][0-9a-fA-F-]*\\]')) AS raw, generate_subscripts(regexp_extract_all(text, '\\[[A-Za-z0-9][A-Za-z0-9_.:+-]* p\\.\\d+ #[0-9a-fA-F][0-9a-fA-F-]*\\]'), 1) AS k FROM rv),
cs AS (SELECT o_orderkey, (k - 1)::INT AS pos, regexp_extract(raw, '\\[([^ ]+) ', 1) AS w, regexp_extract(raw, 'p\\.(\\d+)', 1)::INT AS p, regexp_extract(raw, '#([0-9a-fA-F-]+)\\]', 1) AS b FROM ci)"""


@query(f"WITH {_REV}, x AS (SELECT o_orderkey, pos, CASE WHEN work_key IS NULL THEN 'no-such-block' WHEN work_key <> w THEN 'another-work' WHEN page <> p THEN 'another-page' END AS finding FROM cs LEFT JOIN bl ON block_id = b) SELECT * FROM x WHERE finding IS NOT NULL")
def review_findings(t: Tables) -> DataFrame:
    c = F.col("o_custkey")
    text = F.concat(F.lit('As "x" [W'), c % 50, F.lit(" p."), c % 7, F.lit(" #a"), c % 40, F.lit("] and [W1 p.2 #ff] say, not [w p.x #1]."))
    i = F.col("id")
    blocks = t.orders.sparkSession.range(36).select(F.concat(F.lit("a"), i).alias("block_id"), F.concat(F.lit("W"), F.expr("id + id div 30")).alias("work_key"), (i % 7).cast("int").alias("page"))
    return C.review_findings(t.orders.select("o_orderkey", text.alias("text")), blocks, "o_orderkey", "text")


_RULES = "r(suffix, template, score) AS (VALUES ('example.org', 'https://example.org/pdf/{id}', 5), ('org', 'https://org/{id}', 2), ('test', 'https://test/{id}', 3), ('org', 'https://example.org/pdf/{id}', 9))"


@query(f"""WITH {_RULES}, h AS (SELECT page_id, string_split(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS l FROM pages), s AS (SELECT page_id, unnest([array_to_string(l[i:], '.') FOR i IN range(1, len(l) + 1)]) AS suffix FROM h),
u AS (SELECT page_id, replace(template, '{{id}}', page_id::VARCHAR) AS url, max(score)::INT AS score FROM s JOIN r USING (suffix) GROUP BY ALL) SELECT page_id, url, score, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, url)::INT AS rank FROM u QUALIFY rank <= 2""")
def landing_candidates(t: Tables) -> DataFrame:
    rules = t.pages.sparkSession.createDataFrame([("example.org", "https://example.org/pdf/{id}", 5), ("org", "https://org/{id}", 2), ("test", "https://test/{id}", 3), ("org", "https://example.org/pdf/{id}", 9)], "suffix string, template string, score int")
    return C.ranked_rules(t.pages.select("page_id", "url").withColumnRenamed("url", "address"), rules, "page_id", X.url_host("address"), 2)


@query("""WITH p AS (SELECT page_id, html || CASE page_id % 3 WHEN 0 THEN '<meta name="bepress_citation_pdf_url" content="x">' WHEN 1 THEN '<link rel="alternate" type="application/pdf" href="y">' ELSE '<meta name="citation_pdf_url" content="">' END AS h FROM pages)
SELECT page_id, len(list_filter(regexp_extract_all(h, '(?is)<meta\\b[^>]*>'), lambda m: regexp_matches(m, '(?i)content\\s*=\\s*["''][^"'']') AND regexp_matches(m, '(?i)(name|property)\\s*=\\s*["''][^"'']*(citation_pdf_url|eprints\\.document_url)["'']'))) > 0 AS pdf_url,
  len(list_filter(regexp_extract_all(h, '(?is)<link\\b[^>]*>'), lambda m: regexp_matches(m, '(?i)rel\\s*=\\s*["''][^"'']*alternate') AND regexp_matches(m, '(?i)type\\s*=\\s*["'']application/pdf["'']'))) > 0 AS alternate_pdf FROM p""")
def landing_signals(t: Tables) -> DataFrame:
    extra = F.element_at(F.lit(['<meta name="bepress_citation_pdf_url" content="x">', '<link rel="alternate" type="application/pdf" href="y">', '<meta name="citation_pdf_url" content="">']), (F.col("page_id") % 3 + 1).cast("int"))
    return t.pages.select("page_id", N.landing_signals(F.concat("html", extra)).alias("s")).select("page_id", "s.*")


@query("""WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref\\s*=\\s*["'']([^"'']+)["'']', 1)) AS h FROM pages), b AS (SELECT *, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root, regexp_replace(url, '[?#].*$', '') AS bare FROM l),
f AS (SELECT *, CASE WHEN bare = root THEN root || '/' ELSE regexp_replace(bare, '[^/]*$', '') END AS folder FROM b),
x AS (SELECT page_id, CASE WHEN regexp_matches(h, '(?i)^https?://') THEN h WHEN starts_with(h, '//') THEN regexp_extract(url, '^(https?:)', 1) || h WHEN starts_with(h, '/') THEN root || h WHEN regexp_matches(h, '^(#|[A-Za-z][A-Za-z0-9+.\\-]*:)') THEN NULL ELSE folder || h END AS link FROM f)
SELECT page_id, link, count(*) AS n FROM x WHERE link IS NOT NULL GROUP BY ALL""")
def page_links(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.explode(N.absolute_links("html", "url")).alias("link")).groupBy("page_id", "link").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH j AS (SELECT p_partkey, '{"DOI": "10.1/' || p_partkey || '", "ISSN": ["0317-8471", "' || lpad((p_partkey % 1000)::VARCHAR, 4, '0') || '-0000"], "alternative-id": [' || CASE WHEN p_partkey % 3 = 0 THEN '"S' || p_partkey || '"' ELSE '' END || ']}' AS msg FROM part)
SELECT p_partkey, 'doi' AS scheme, json_extract_string(msg, '$.DOI') AS value FROM j UNION ALL SELECT p_partkey, 'issn', unnest(json_extract_string(msg, '$.ISSN[*]')) FROM j UNION ALL SELECT p_partkey, 'pii', unnest(json_extract_string(msg, '$."alternative-id"[*]')) FROM j""")
def registry_identifiers(t: Tables) -> DataFrame:
    """Identifier rows of registry records in JSON."""
    k = F.col("p_partkey")
    msg = F.concat(F.lit('{"DOI": "10.1/'), k, F.lit('", "ISSN": ["0317-8471", "'), F.lpad((k % 1000).cast("string"), 4, "0"), F.lit('-0000"], "alternative-id": ['), F.when(k % 3 == 0, F.concat(F.lit('"S'), k, F.lit('"'))).otherwise(F.lit("")), F.lit("]}"))
    j = t.part.select(k, F.from_json(msg, "DOI string, ISSN array<string>, `alternative-id` array<string>").alias("m"))
    tagged = lambda scheme, values: F.transform(values, lambda v: F.struct(F.lit(scheme).alias("scheme"), v.alias("value")))
    rows = F.concat(tagged("doi", F.array("m.DOI")), tagged("issn", F.col("m.ISSN")), tagged("pii", F.col("m.alternative-id")))
    return j.select("p_partkey", F.explode(rows).alias("x")).select("p_partkey", "x.*")


@query("""WITH b AS (SELECT o_orderkey, (o_totalprice % 100) / 100 AS ratio, o_custkey % 2 = 0 AS near, o_custkey % 3 = 0 AS layer FROM orders) SELECT CASE WHEN ratio >= 0.85 AND near THEN 'bound' WHEN NOT layer AND ratio < 0.85 THEN 'binding-pending' ELSE 'binding-failed' END AS verdict, count(*) AS n FROM b GROUP BY 1""")
def binding_verdicts(t: Tables) -> DataFrame:
    v = N.binding_verdict(F.col("o_totalprice") % 100 / 100, F.col("o_custkey") % 2 == 0, F.col("o_custkey") % 3 == 0)
    return t.orders.select(v.alias("verdict")).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


_LINES = "['A title', 'Please cite this article as', 'B', 'C', 'Body text', 'D', '[1] One.', 'Doe, J. A. (1999) x', 'E', 'F', 'References', 'G', 'H']"


@query(f"""WITH l AS (SELECT {_LINES} AS l), w AS (SELECT s::INT AS start, n::INT AS n, l, (s + n - 1) AS e FROM l, range(13) a(s), range(1, 4) b(n) WHERE s + n <= 13),
f AS (SELECT *, [regexp_matches(x, '(?i)^\\s*(references?( and notes)?|bibliography|literature cited|works cited|cited literature)\\s*:?\\s*$') FOR x IN l] AS h, [regexp_matches(x, '^\\s*(\\[\\s*\\d{{1,3}}\\s*\\]|\\d{{1,3}}\\.)\\s+\\S') OR regexp_matches(x, '\\b[A-Z][A-Za-z''’-]+,\\s+(?:[A-Z]\\.\\s*-?\\s*){{1,3}}.*\\b(1[89]|20)\\d{{2}}[a-z]?\\b') FOR x IN l] AS r, [regexp_matches(x, '(?i)please\\s+cite') FOR x IN l] AS c FROM w)
SELECT p_partkey % 3 AS k, start, n, CASE WHEN start >= 45 THEN 'region' WHEN list_bool_or(h[1 : e + 1]) THEN 'references' WHEN list_sum([x::INT FOR x IN r[greatest(0, start - 2) + 1 : e + 3]]) >= 2 THEN 'references' WHEN list_bool_or(c[greatest(0, start - 3) + 1 : e + 1]) THEN 'cover' ELSE '' END AS refusal, count(*) AS pages FROM f, part GROUP BY ALL""")
def window_refusals(t: Tables) -> DataFrame:
    lines = F.lit(["A title", "Please cite this article as", "B", "C", "Body text", "D", "[1] One.", "Doe, J. A. (1999) x", "E", "F", "References", "G", "H"])
    spark = t.part.sparkSession
    windows = spark.range(13).select(F.col("id").cast("int").alias("start"), F.explode(F.lit([1, 2, 3])).alias("n")).filter("start + n <= 13")
    told = windows.withColumn("refusal", N.window_refusal(lines, F.col("start"), F.col("n")))
    k = t.part.groupBy((F.col("p_partkey") % 3).alias("k")).agg(F.count(F.lit(1)).alias("pages"), F.lit(1).alias("_j"))
    return k.join(told.withColumn("_j", F.lit(1)), "_j").select("k", "start", "n", "refusal", "pages")


_PARENTS = """ed AS (SELECT l_orderkey * 10 + l_linenumber AS seq, l_partkey AS source, ['is_part_of', 'has_version', 'is_version_of', 'cites', 'has_part', 'is_preprint_of', 'has_preprint'][l_linenumber % 7 + 1] AS relation, l_partkey * 7 % (SELECT count(*) FROM part) + l_suppkey % 3 AS target FROM lineitem),
ch AS (SELECT seq, CASE WHEN relation LIKE 'is%' THEN source ELSE target END AS work, CASE WHEN relation LIKE '%part%' THEN 'part_of' ELSE 'version_of' END AS kind, CASE WHEN relation LIKE 'is%' THEN target ELSE source END AS parent FROM ed WHERE relation <> 'cites' AND source <> target),
he AS (SELECT p_partkey AS work, 'part_of' AS kind, p_partkey // 2 AS parent FROM part WHERE p_partkey % 9 = 4)"""


def _typed_edges(t: Tables) -> tuple[DataFrame, DataFrame]:
    n = t.part.count()
    relation = F.element_at(F.lit(["is_part_of", "has_version", "is_version_of", "cites", "has_part", "is_preprint_of", "has_preprint"]), (F.col("l_linenumber") % 7 + 1).cast("int"))
    edges = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_partkey").alias("source"), relation.alias("relation"), (F.col("l_partkey") * 7 % n + F.col("l_suppkey") % 3).alias("target"))
    held = t.part.filter("p_partkey % 9 = 4").select(F.col("p_partkey").alias("work"), F.lit("part_of").alias("kind"), F.expr("p_partkey div 2").alias("parent"))
    return held, edges


@query(f"""WITH {_PARENTS}, f AS (SELECT work, kind, min(struct_pack(seq := seq, parent := parent)) AS f FROM ch GROUP BY ALL)
SELECT seq, work, kind, ch.parent, CASE WHEN he.parent IS NULL AND seq = f.seq THEN 'filled' WHEN ch.parent = coalesce(he.parent, f.parent) THEN 'held' ELSE 'kept-existing' END AS outcome FROM ch JOIN f USING (work, kind) LEFT JOIN he USING (work, kind)""")
def parent_fills(t: Tables) -> DataFrame:
    return C.parent_fills(*_typed_edges(t))


@query(f"""WITH RECURSIVE {_PARENTS}, f AS (SELECT work, kind, arg_min(parent, (seq, parent)) AS parent FROM ch GROUP BY ALL), p AS (SELECT coalesce(f.work, he.work) AS node, coalesce(he.parent, f.parent) AS parent FROM (SELECT * FROM f WHERE kind = 'part_of') f FULL JOIN he ON he.work = f.work),
c(node, cur, depth, path) AS (SELECT node, parent, 1::BIGINT, [node] FROM p UNION ALL SELECT c.node, p.parent, depth + 1, list_append(path, c.cur) FROM c JOIN p ON p.node = c.cur WHERE NOT list_contains(path, c.cur)),
t AS (SELECT c.node, c.cur AS top, depth FROM c WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.node = c.cur)) SELECT p.node, top, depth FROM p LEFT JOIN t USING (node)""")
def part_ancestors(t: Tables) -> DataFrame:
    """The whole that each work is a part of in the end; none where parts go in a circle."""
    held, edges = _typed_edges(t)
    first = C.parent_fills(held, edges).filter("outcome = 'filled' AND kind = 'part_of'").groupBy(F.col("work").alias("node")).agg(F.min("parent").alias("parent"))  # an edge may come twice
    return C.ancestors(held.select(F.col("work").alias("node"), "parent").unionByName(first))


@query("""WITH d AS (SELECT doc_id, doc_id % 4 AS a, doc_id % 3 AS b, n_chars FROM documents) SELECT doc_id % 5 AS paper, sum(a * CASE WHEN b = 0 THEN 1 ELSE b END + 1)::BIGINT AS box_rows, sum(a + 1)::BIGINT AS elements, count(*) AS without_target, sum(a)::BIGINT AS verifiable FROM d GROUP BY 1""")
def mention_totals(t: Tables) -> DataFrame:
    """Each document as a TEI body whose sentences cite one work up to three times, in one or two boxes (none counts as one), and once no one."""
    k = F.col("doc_id")
    box = F.lit("1,10,20,30,40")
    coords = F.when(k % 3 == 0, F.lit("broken")).otherwise(F.concat_ws(";", F.array_repeat(box, (k % 3).cast("int"))))
    ref = F.concat(F.lit('<ref type="bibr" target="#b'), k.cast("string"), F.lit('" coords="'), coords, F.lit('">(A, 2020)</ref> '))
    head = F.regexp_replace(F.regexp_extract("text", r"^[^\n]*", 0), r"[<>&\x{0}-\x{1F}\x{FFFE}\x{FFFF}]", " ")
    body = F.concat(F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><p><s coords="2,0,0,9,9">'), head, F.repeat(ref, (k % 4).cast("int")), F.lit('</s><s><ref type="figure">x</ref><ref type="bibr">[1]</ref></s></p></body><back><ref type="bibr" target="#no"/></back></text></TEI>'))
    m = t.documents.select((k % 5).alias("paper"), F.explode(M.citation_mentions(body)).alias("m")).select("paper", "m.*")
    return C.mention_totals(m, ["paper"])


@query("""SELECT l_orderkey AS use_id, l_linenumber AS line, 'a' || chr(10) || 'b' || chr(10) || l_partkey AS quote, NULL AS missing FROM lineitem WHERE l_partkey % 3 = 0 AND l_suppkey % 5 > 0 AND l_partkey % 7 > 0
UNION ALL SELECT l_orderkey, l_linenumber, NULL, CASE WHEN l_suppkey % 5 = 0 AND l_partkey % 7 = 0 THEN 'page,block_id' WHEN l_suppkey % 5 = 0 THEN 'page' ELSE 'block_id' END FROM lineitem WHERE l_partkey % 3 = 0 AND (l_suppkey % 5 = 0 OR l_partkey % 7 = 0)""")
def verified_lines(t: Tables) -> DataFrame:
    """Promotable quotes with one kind of line end; those without a page or a block are named."""
    p = F.col("l_partkey")
    rows = t.lineitem.select(F.col("l_orderkey").alias("use_id"), F.col("l_linenumber").alias("line"), F.when(p % 4 > 0, p % 3 == 0).otherwise(F.when(p % 3 == 0, True)).alias("promotable"), F.concat(F.lit("a\r\nb\r"), p).alias("quote"), F.lit("w").alias("work_key"), F.when(F.col("l_suppkey") % 5 > 0, F.col("l_suppkey")).alias("page"), F.when(p % 7 > 0, p.cast("string")).otherwise("").alias("block_id"))
    lines, defects = C.verified_lines(rows, "quote", ["work_key", "page", "block_id"])
    return lines.select("use_id", "line", "quote", F.lit(None).cast("string").alias("missing")).unionByName(defects.select("use_id", "line", F.lit(None).cast("string").alias("quote"), "missing"))
