"""Queries of text and identifier functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..functions import text as X
from .base import Tables, query

_TITLE = "trim(regexp_replace(lower(regexp_replace({0}, '<[^>]*>', ' ', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_HEAD = "regexp_extract(text, '^[^\\n]*')"


@query(f"WITH t AS (SELECT doc_id, {_TITLE.format(_HEAD)} AS title FROM documents) SELECT title, count(*) AS n, min(doc_id) AS first_id FROM t GROUP BY title HAVING count(*) > 1")
def norm_title_dupes(t: Tables) -> DataFrame:
    title = t.documents.select("doc_id", X.norm_title(F.regexp_extract("text", r"^[^\n]*", 0)).alias("title"))
    return title.groupBy("title").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).filter("n > 1")


@query("""SELECT doc_id, length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS chars, len(list_filter(regexp_split_to_array(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '), lambda w: w <> ''))::INT AS words,
  regexp_matches(text, '(?i)\\breferences\\b') AS has_references FROM documents""")
def text_facts(t: Tables) -> DataFrame:
    flat = X.collapse_space("text")
    return t.documents.select("doc_id", F.length(flat).cast("long").alias("chars"), F.size(F.filter(F.split(flat, " "), lambda w: w != "")).alias("words"), F.col("text").rlike(r"(?i)\breferences\b").alias("has_references"))


_RAW = """raw AS (
  SELECT p_partkey AS k, 'doi' AS scheme, ' https://DOI.org/10.' || (1000 + p_partkey % 50) || '/A' || ['', ' ', chr(160), chr(8203), chr(173), chr(8288), chr(9), chr(65279)][p_partkey % 8 + 1] || 'BC.' || p_size || '.;' AS value FROM part
  UNION ALL SELECT p_partkey, 'arxiv', 'arXiv:2' || lpad((p_partkey % 400)::VARCHAR, 3, '0') || '.0' || lpad(p_size::VARCHAR, 4, '0') || 'v' || (p_partkey % 3 + 1) FROM part
  UNION ALL SELECT p_partkey, 'isbn', 'ISBN-10: ' || lpad((p_partkey * 7919)::VARCHAR, 9, '0') || (p_partkey % 10) FROM part
  UNION ALL SELECT p_partkey, 'issn', lpad((p_partkey * 31)::VARCHAR, 7, '0') || 'x' FROM part
  UNION ALL SELECT p_partkey, 'pmcid', 'pmc ' || p_partkey FROM part
  UNION ALL SELECT p_partkey, 'handle', 'http://hdl.handle.net/1721.1/' || p_partkey FROM part
  UNION ALL SELECT p_partkey, 'wikidata', 'https://www.wikidata.org/wiki/q' || p_partkey || '/' FROM part)"""
_D = "CASE WHEN substr(c, {0}, 1) = 'X' THEN 10 ELSE try_cast(substr(c, {0}, 1) AS INT) END"
_OK10 = "(regexp_full_match(c, '[0-9]{9}[0-9X]') AND c NOT IN ('0000000000', '000000000X') AND (" + " + ".join(f"{11 - i} * ({_D.format(i)})" for i in range(1, 11)) + ") % 11 = 0)"
_TO13 = "'978' || substr(c, 1, 9) || ((10 - (9 + 3 * 7 + 8 + " + " + ".join(f"{3 if i % 2 else 1} * ({_D.format(i)})" for i in range(1, 10)) + ") % 10) % 10)"
_CANON = f"""canon AS (SELECT k, scheme, value, CASE scheme
  WHEN 'doi' THEN regexp_replace(regexp_extract(lower(regexp_replace(value, '[\\p{{Z}}\\p{{Cf}}\\x09-\\x0D\\x1C-\\x1F\\x{{85}}]', '', 'g')), '10\\..*$'), '[/.,;:]+$', '')
  WHEN 'arxiv' THEN regexp_replace(regexp_replace(lower(trim(value)), '^arxiv:', ''), 'v[0-9]+$', '')
  WHEN 'isbn' THEN CASE WHEN {_OK10} THEN {_TO13} ELSE c END
  WHEN 'issn' THEN substr(c2, 1, 4) || '-' || substr(c2, 5)
  WHEN 'pmcid' THEN 'PMC' || regexp_extract(trim(value), '[0-9]+$')
  WHEN 'handle' THEN regexp_replace(trim(value), '^(hdl:\\s*|(https?://)?hdl\\.handle\\.net/)', '', 'i')
  ELSE upper(regexp_replace(regexp_replace(trim(value), '/+$', ''), '^.*/', '')) END AS canon
  FROM (SELECT *, regexp_replace(upper(regexp_replace(trim(value), '^\\s*isbn(-1[03])?\\s*:?\\s*', '', 'i')), '[^0-9X]', '', 'g') AS c, regexp_replace(upper(trim(value)), '[\\s-]', '', 'g') AS c2 FROM raw))"""


def _identifiers(t: Tables) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    forms = {
        "doi": F.concat(F.lit(" https://DOI.org/10."), 1000 + k % 50, F.lit("/A"), F.element_at(F.lit(["", " ", "\u00a0", "\u200b", "\u00ad", "\u2060", "\t", "\ufeff"]), (k % 8 + 1).cast("int")), F.lit("BC."), size, F.lit(".;")),
        "arxiv": F.concat(F.lit("arXiv:2"), F.lpad((k % 400).cast("string"), 3, "0"), F.lit(".0"), F.lpad(size.cast("string"), 4, "0"), F.lit("v"), k % 3 + 1),
        "isbn": F.concat(F.lit("ISBN-10: "), F.lpad((k * 7919).cast("string"), 9, "0"), k % 10),
        "issn": F.concat(F.lpad((k * 31).cast("string"), 7, "0"), F.lit("x")),
        "pmcid": F.concat(F.lit("pmc "), k),
        "handle": F.concat(F.lit("http://hdl.handle.net/1721.1/"), k),
        "wikidata": F.concat(F.lit("https://www.wikidata.org/wiki/q"), k, F.lit("/")),
    }
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("scheme"), v.alias("value")) for s, v in forms.items())))
    return t.part.select(k.alias("k"), each.alias("x")).select("k", "x.scheme", "x.value")


@query(f"WITH {_RAW}, {_CANON} SELECT k, scheme, canon FROM canon")
def norm_identifier(t: Tables) -> DataFrame:
    return _identifiers(t).select("k", "scheme", I.canonical("scheme", "value").alias("canon"))


@query(f"WITH {_RAW}, {_CANON} SELECT scheme, canon, count(DISTINCT k) AS works, min(k) AS first_k FROM canon GROUP BY scheme, canon HAVING count(DISTINCT k) > 1")
def identifier_collisions(t: Tables) -> DataFrame:
    named = norm_identifier(t)
    tasks = max(int(t.part.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-7 * t.part.count() // 1_000_000))  # a million rows a task, however large the table
    once = named.repartition(tasks, "scheme", "canon", "k").distinct()
    return once.repartition(tasks, "scheme", "canon").groupBy("scheme", "canon").agg(F.count("k").alias("works"), F.min("k").alias("first_k")).filter("works > 1")


@query(f"""WITH {_RAW}, {_CANON}, x AS (SELECT k, canon AS c FROM canon WHERE scheme = 'isbn')
SELECT k, c AS canon, regexp_full_match(c, '97[89][0-9]{{10}}') AND (10 - ({" + ".join(f"{1 if i % 2 else 3} * coalesce({_D.format(i)}, 0)" for i in range(1, 13))}) % 10) % 10 = try_cast(substr(c, 13, 1) AS INT) AS ok13 FROM x""")
def isbn_validity(t: Tables) -> DataFrame:
    c = norm_identifier(t).filter("scheme = 'isbn'")
    return c.select("k", "canon", I.isbn13_valid(F.col("canon")).alias("ok13"))


@query(f"WITH {_RAW}, {_CANON} SELECT k, canon, '10.48550/arxiv.' || canon AS doi, regexp_extract('10.48550/arxiv.' || canon, '^10\\.48550/arxiv\\.(.+)$', 1) AS back FROM canon WHERE scheme = 'arxiv'")
def arxiv_doi_roundtrip(t: Tables) -> DataFrame:
    a = norm_identifier(t).filter("scheme = 'arxiv'").withColumn("doi", I.arxiv_to_doi("canon"))
    return a.select("k", "canon", "doi", I.doi_to_arxiv("doi").alias("back"))


@query("""SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host, regexp_replace(url, '[?#].*$', '') AS bare, len(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref\\s*=\\s*["'']([^"'']+)["'']', 1))::INT AS n_links FROM pages""")
def page_hosts(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.url_host("url").alias("host"), X.without_query("url").alias("bare"), F.size(X.links("html")).alias("n_links"))


@query("""SELECT page_id, length(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script\\b[^>]*>.*?</script\\s*>', ' ', 'gis'), '<style\\b[^>]*>.*?</style\\s*>', ' ', 'gis'), '<[^>]*>', ' ', 'gs'), '\\s+', ' ', 'g'))) AS chars FROM pages""")
def page_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.length(X.html_to_text("html")).cast("long").alias("chars"))


@query("SELECT item_id, doc_id, strpos(d.text, b.text) - 1 AS start, strpos(d.text, b.text) - 1 + length(b.text) AS stop FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def quote_locate(t: Tables) -> DataFrame:
    """Where each benchmark passage stands in each document: candidates by a shared word 5-gram, then the exact test."""
    from ..operators.search import containing

    return containing(t.benchmark, t.documents, "item_id", "doc_id", "text")


@query("""WITH e AS (SELECT item_id, doc_id, b.text AS quote, d.text AS body, strpos(d.text, b.text) AS pos FROM benchmark b JOIN documents d ON contains(d.text, b.text))
SELECT item_id, doc_id, substr(body, pos, length(quote)) = quote AND NOT regexp_matches(quote, '^[\\r\\n]|[\\r\\n]$') AS verified, substr(body, pos + 1, length(quote)) = quote AS verified_shifted FROM e""")
def quote_verify(t: Tables) -> DataFrame:
    from ..operators.search import verify_quotes

    found = quote_locate(t).join(t.benchmark.select("item_id", F.col("text").alias("quote")), "item_id").join(t.documents.select("doc_id", F.col("text").alias("body")), "doc_id")
    return found.select("item_id", "doc_id", verify_quotes("body", "quote", "start", "stop").alias("verified"), verify_quotes("body", "quote", F.col("start") + 1, F.col("stop") + 1).alias("verified_shifted"))


_NAMES = "n AS (SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'Müller, J.; Smith, A.' WHEN 1 THEN 'Ana María López-Ruiz' WHEN 2 THEN 'A.B.Çelik and D. Low' WHEN 3 THEN 'Van Den Hout' WHEN 4 THEN s_name ELSE '' END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'vandenhout' ELSE 'Hout, J.' END AS other FROM supplier)"
_FAMILY = "regexp_replace(lower(CASE WHEN contains({0}, ',') THEN string_split({0}, ',')[1] ELSE coalesce(list_filter(regexp_split_to_array(replace({0}, '.', ' '), '\\s+'), lambda w: w <> '')[-1], '') END), '[^\\p{{L}}\\p{{N}}]', '', 'g')"
_FIRST = "trim(string_split(string_split(strip_accents({0}), ';')[1], ' and ')[1])"


def _names(t: Tables) -> DataFrame:
    kinds = F.lit(["Müller, J.; Smith, A.", "Ana María López-Ruiz", "A.B.Çelik and D. Low", "Van Den Hout"])
    n = F.col("s_suppkey") % 6
    name = F.when(n < 4, F.try_element_at(kinds, (n + 1).cast("int"))).when(n == 4, F.col("s_name")).otherwise(F.lit(""))
    return t.supplier.select("s_suppkey", name.alias("name"), F.when(F.col("s_suppkey") % 2 == 0, F.lit("vandenhout")).otherwise(F.lit("Hout, J.")).alias("other"))


@query(f"WITH {_NAMES}, f AS (SELECT s_suppkey, {_FIRST.format('name')} AS n, {_FIRST.format('other')} AS o FROM n), g AS (SELECT s_suppkey, {_FAMILY.format('n')} AS family, {_FAMILY.format('o')} AS b FROM f) SELECT s_suppkey, family, family <> '' AND (family = b OR (length(family) >= 3 AND ends_with(b, family))) AS matches FROM g")
def family_names(t: Tables) -> DataFrame:
    return _names(t).select("s_suppkey", X.family_name("name").alias("family"), X.family_matches("name", "other").alias("matches"))


@query("""SELECT doc_id, length(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10), 'g')) AS n, substr(regexp_extract(text, '^\\s*([^.!?\\n]*[.!?]?)', 1), 1, 200) AS sentence, regexp_replace(source || '/' || lang, '[^A-Za-z0-9._-]+', '_', 'g') AS tag FROM documents""")
def text_cleaning(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.length(X.canonical_newlines("text")).cast("long").alias("n"), X.first_sentence("text").alias("sentence"), X.safe_tag(F.concat_ws("/", "source", "lang")).alias("tag"))
