"""Queries of manifests, signatures, copies, grid windows, schema changes and SQL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators import routing as R
from .base import Tables, query
from .grids import _PX, pixels


@query("""SELECT o_orderkey AS run_id, 't' || (o_custkey % 20) AS tile_set, o_totalprice AS score, n.n AS tiles, c_name AS registered FROM orders LEFT JOIN (SELECT 't' || (p_partkey % 18) AS ts, count(*) AS n FROM part GROUP BY 1) n ON n.ts = 't' || (o_custkey % 20) LEFT JOIN customer ON c_custkey = o_orderkey""")
def run_manifests(t: Tables) -> DataFrame:
    body = F.to_json(F.struct(F.col("o_orderkey").alias("run_id"), F.concat(F.lit("t"), F.col("o_custkey") % 20).alias("tile_set"), F.col("o_totalprice").alias("score")))
    tiles = t.part.groupBy(F.concat(F.lit("t"), F.col("p_partkey") % 18).alias("tile_set")).agg(F.count(F.lit(1)).alias("tiles"))
    reg = t.customer.select(F.col("c_custkey").alias("run_id"), F.col("c_name").alias("registered"))
    return C.manifests(t.orders.select(body.alias("body")), "body", "run_id long, tile_set string, score double", tiles, reg).select("run_id", "tile_set", "score", "tiles", "registered")


@query("""SELECT l_orderkey, len(m)::INT AS n, substr(sha256('["' || array_to_string(m, '","') || '"]'), 1, 12) AS signature FROM (SELECT l_orderkey, list_sort(list(DISTINCT l_partkey::VARCHAR)) AS m FROM lineitem GROUP BY 1)""")
def tile_signatures(t: Tables) -> DataFrame:
    return C.signatures(t.lineitem, "l_orderkey", "l_partkey")


@query("""WITH s AS (SELECT 'f' || p_partkey AS path, md5(p_name || p_size) AS digest FROM part), h AS (SELECT 'f' || p_partkey AS path, md5(p_name || CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE p_size END) AS digest FROM part WHERE p_partkey % 4 <> 1)
SELECT path, s.digest, CASE WHEN h.digest IS NULL THEN 'new' ELSE 'changed' END AS why FROM s LEFT JOIN h USING (path) WHERE s.digest IS DISTINCT FROM h.digest""")
def files_to_copy(t: Tables) -> DataFrame:
    path = F.concat(F.lit("f"), "p_partkey").alias("path")
    s = t.part.select(path, F.md5(F.concat("p_name", "p_size")).alias("digest"))
    h = t.part.filter("p_partkey % 4 <> 1").select(path, F.md5(F.concat("p_name", F.when(F.col("p_partkey") % 9 == 0, 0).otherwise(F.col("p_size")))).alias("digest"))
    return C.to_copy(s, h, "path", "digest").select("path", "digest", "why")


@query(f"WITH {_PX} SELECT grid, row, col, v FROM px WHERE row BETWEEN 5 AND 11 AND col BETWEEN 3 AND 9")
def pixel_window(t: Tables) -> DataFrame:
    return C.window(pixels(t), (5, 12), (3, 10))


@query(f"WITH {_PX} SELECT grid, row // 3 AS brow, col // 3 AS bcol, arg_min(v, (abs(row - row // 3 * 3 - 1.0) + abs(col - col // 3 * 3 - 1.0), row, col)) AS v FROM px GROUP BY ALL")
def pixel_lattice(t: Tables) -> DataFrame:
    return C.on_lattice(pixels(t), "v", 3)


@query("WITH b AS (SELECT p_partkey, (p_partkey * 13 % 90)::DOUBLE AS xmin, (p_partkey * 7 % 85)::DOUBLE AS ymin, 4.0 + p_partkey % 9 AS w FROM part) SELECT p_partkey FROM b WHERE xmin <= 40 AND xmin + w >= 20 AND ymin <= 60 AND ymin + w >= 30")
def boxes_in_bounds(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    x, y, w = (k * 13 % 90).cast("double"), (k * 7 % 85).cast("double"), 4.0 + k % 9
    return C.touching(t.part.select(k, x.alias("xmin"), y.alias("ymin"), (x + w).alias("xmax"), (y + w).alias("ymax")), (20, 30, 40, 60)).select("p_partkey")


@query("""WITH a AS (SELECT n_nationkey AS no, md5(n_name) AS c FROM nation WHERE n_nationkey <> 4), b AS (SELECT n_nationkey AS no, md5(n_name || CASE WHEN n_nationkey % 6 = 0 THEN 'x' ELSE '' END) AS c FROM nation WHERE n_nationkey < 18 AND n_nationkey <> 9)
SELECT coalesce(a.no, b.no) AS no, CASE WHEN a.c IS NULL THEN 'lost' WHEN b.c IS NULL AND a.no < 17 THEN 'late' WHEN b.c IS NULL THEN 'pending' WHEN a.c = b.c THEN 'applied' ELSE 'drifted' END AS state FROM a FULL JOIN b ON a.no = b.no""")
def schema_changes(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    a = t.nation.filter(k != 4).select(k.alias("no"), F.md5("n_name").alias("checksum"))
    b = t.nation.filter((k < 18) & (k != 9)).select(k.alias("no"), F.md5(F.concat("n_name", F.when(k % 6 == 0, "x").otherwise(""))).alias("checksum"))
    return C.schema_changes(a, b)


@query(f"""WITH {_PX}, a AS (SELECT * FROM px WHERE grid < 5), b AS (SELECT grid, row, col, CASE WHEN grid = 2 AND row = 4 THEN v + 1 ELSE v END AS v FROM px WHERE grid > 0 AND NOT (grid = 3 AND col = 2)), s AS (SELECT DISTINCT a.grid FROM a JOIN b USING (grid)),
j AS (SELECT coalesce(x.grid, y.grid) AS grid, x.v IS DISTINCT FROM y.v AS d, x.row IS NULL OR y.row IS NULL AS o FROM (SELECT * FROM a SEMI JOIN s USING (grid)) x FULL JOIN (SELECT * FROM b SEMI JOIN s USING (grid)) y ON x.grid = y.grid AND x.row = y.row AND x.col = y.col), p AS (SELECT grid, count(*) AS cells, count(*) FILTER (d) AS n_differ, count(*) FILTER (o) AS n_outside FROM j GROUP BY 1)
SELECT *, n_differ = 0 AND (SELECT sum(n_outside) FROM p) = 0 AS equal FROM p""")
def stack_parity(t: Tables) -> DataFrame:
    p = pixels(t)
    b = p.filter("grid > 0 AND NOT (grid = 3 AND col = 2)").withColumn("v", F.when((F.col("grid") == 2) & (F.col("row") == 4), F.col("v") + 1).otherwise(F.col("v")))
    return C.parity(p.filter("grid < 5"), b, "grid", "v")


@query("""SELECT o_orderkey, round(2.0 * (o_custkey % 50) / nullif(2.0 * (o_custkey % 50) + o_orderkey % 30 + o_orderkey % 7, 0), 6) AS f1, substr(sha256(o_orderpriority || '|' || o_orderstatus), 1, 12) AS curve_id FROM orders WHERE o_orderstatus <> 'P'""")
def live_points(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(k, "o_orderstatus", "o_orderpriority", (F.col("o_custkey") % 50).alias("tp"), (k % 30).alias("fp"), (k % 7).alias("fn"))
    return C.curve_points(rows, F.col("o_orderstatus") != "P", "tp", "fp", "fn", ["o_orderpriority", "o_orderstatus"]).select("o_orderkey", "f1", "curve_id")


_C0 = "[' of' || chr(29) || 'ice', 'x' || chr(3) || 'y z', chr(12) || 'oating over-' || chr(10) || 'due', 'plain' || chr(173) || ' ' || chr(9) || 'text', 'a' || chr(65533) || 'b - c']"


@query(f"""WITH s AS (SELECT p_partkey, p_name || ' ' || {_C0}[p_partkey % 5 + 1] AS x FROM part), b AS (SELECT p_partkey, regexp_replace(regexp_replace(translate(x, chr(65533) || chr(173), ''), '-[ \\t\\r\\n]+', '', 'g'), '[ \\t\\r\\n]+', ' ', 'g') AS t FROM s),
f AS (SELECT *, regexp_extract_all(t, '([A-Za-z]+)[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f]([A-Za-z]+)', 1) AS a1, regexp_extract_all(t, '([A-Za-z]+)[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f]([A-Za-z]+)', 2) AS a2, regexp_extract_all(t, '(^|[^A-Za-z])[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f]([A-Za-z]{{2,}})', 2) AS b2 FROM b),
g AS (SELECT *, list_sort(list_concat([array_to_string([a1[i] || l || a2[i] FOR l IN ['', 'ff', 'fi', 'fl', 'ffi', 'ffl']], ' ') FOR i IN range(1, len(a1) + 1)], [array_to_string([l || n FOR l IN ['', 'ff', 'fi', 'fl', 'ffi', 'ffl']], ' ') FOR n IN b2])) AS e FROM f)
SELECT p_partkey, CASE WHEN len(e) > 0 THEN array_to_string(e, ' ') || ' ' ELSE '' END || t AS x FROM g""")
def search_texts(t: Tables) -> DataFrame:
    ends = F.lit([" of\x1dice", "x\x03y z", "\x0coating over-\ndue", "plain­ \ttext", "a�b - c"])
    return t.part.select("p_partkey", C.search_text(F.concat("p_name", F.lit(" "), F.element_at(ends, (F.col("p_partkey") % 5 + 1).cast("int")))).alias("x"))


@query("SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host, regexp_replace(url, '[?#].*$', '') AS bare FROM pages")
def registered_functions(t: Tables) -> DataFrame:
    """The same through SQL functions registered by name."""
    C.register_functions(t.pages.sparkSession)
    return t.pages.select("page_id", F.expr("oreline_url_host(url)").alias("host"), F.expr("oreline_without_query(url)").alias("bare"))


@query("SELECT a.p_partkey, levenshtein(a.p_name, b.p_name)::INT AS edits FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1")
def name_edits(t: Tables) -> DataFrame:
    b = t.part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other"))
    return t.part.join(b, "p_partkey").select("p_partkey", F.levenshtein("p_name", "other").alias("edits"))


@query("SELECT p_brand, p_partkey, p_size FROM part WHERE p_brand IN (SELECT DISTINCT p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)) AND p_partkey NOT IN (SELECT s_suppkey FROM supplier)")
def keyed_scan(t: Tables) -> DataFrame:
    """Rows of a keyed set, without those that a log names."""
    keys = t.part.join(t.lineitem.filter("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi").select("p_brand").distinct()
    rows = t.part.join(keys, "p_brand", "left_semi")
    return R.without(rows, ["p_partkey"], t.supplier.select(F.col("s_suppkey").alias("p_partkey"))).select("p_brand", "p_partkey", "p_size")
