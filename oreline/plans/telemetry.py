"""Queries of telemetry, healed series, pixel rules and plane geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import linkage as K
from ..operators import raster as G
from ..operators import sequence as S
from ..operators import spatial as P
from ..operators import telemetry as M
from .base import Tables, query
from .grids import _PX, pixels
from .sequence import _BITS, _DAYS, _bits, series

_REC = "rc AS (SELECT user_id % 20 AS session, 'hw_' || (user_id % 20) || CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN ' (1)' ELSE ' (2)' END AS file, date_trunc('hour', ts) AS t, event_type FROM events)"


@query(f"""WITH {_REC}, n AS (SELECT session, file, count(*) AS n FROM rc GROUP BY ALL), p AS (SELECT session, file, row_number() OVER (PARTITION BY session ORDER BY n DESC, regexp_matches(file, ' \\(\\d+\\)'), file) AS place FROM n), q AS (SELECT rc.*, place, min(place) OVER (PARTITION BY session, t) AS f FROM rc JOIN p USING (session, file)),
k AS (SELECT session, t, place FROM q WHERE place = 1 UNION ALL SELECT DISTINCT session, t, place FROM q WHERE place = f AND place > 1) SELECT session, strftime(t, '%Y-%m-%d %H') AS hour, count(*) AS n, max(place) > 1 AS added FROM k GROUP BY ALL""")
def merged_recordings(t: Tables) -> DataFrame:
    name = F.concat(F.lit("hw_"), F.col("user_id") % 20, F.when(F.col("event_type") == "view", "").when(F.col("event_type") == "click", " (1)").otherwise(" (2)"))
    rows = t.events.select((F.col("user_id") % 20).alias("session"), name.alias("file"), F.date_trunc("hour", "ts").alias("t"))
    n = rows.groupBy("session", "file").agg(F.count(F.lit(1)).alias("n"))
    lead = n.withColumn("k", F.row_number().over(Window.partitionBy("session").orderBy(F.desc("n"), F.col("file").rlike(r" \(\d+\)"), "file"))).filter("k = 1").select("session", F.col("file").alias("lead"))
    m = M.merge_recordings(rows, "session", "file", "t").join(lead, "session")
    return m.groupBy("session", F.date_format("t", "yyyy-MM-dd HH").alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("file") != F.col("lead")).alias("added"))


_LAUNCH = "r AS (SELECT l_orderkey AS session, l_shipdate AS ts, l_partkey % 40 AS fp FROM lineitem), s AS (SELECT 'L' || lpad(s_suppkey::VARCHAR, 4, '0') AS launch, TIMESTAMP '1992-01-01' + (s_suppkey % 40 * 50) * INTERVAL 1 DAY AS start, TIMESTAMP '1992-01-01' + (s_suppkey % 40 * 50 + 400) * INTERVAL 1 DAY AS stop, s_suppkey FROM supplier), p AS (SELECT DISTINCT launch, (s_suppkey * 7 + k * 3) % 40 AS fp FROM s, range(5) x(k))"


@query(f"""WITH {_LAUNCH}, f AS (SELECT session, min(ts) AS f, count(*) AS n_rows FROM r GROUP BY 1), h AS (SELECT session, launch, count(*) AS m FROM r JOIN p USING (fp) GROUP BY ALL), c AS (SELECT f.session, launch, start, coalesce(m, 0) AS m FROM f JOIN s ON f.f BETWEEN start AND stop LEFT JOIN h USING (session, launch)),
b AS (SELECT session, count(*) AS n_candidates, arg_max(launch, (m, start, launch)) AS l, max(m) AS top FROM c GROUP BY 1), t AS (SELECT c.session, count(*) AS n_tied FROM c JOIN b USING (session) WHERE m = top AND top > 0 GROUP BY 1)
SELECT f.session, n_rows, CASE WHEN top > 0 THEN l END AS launch, CASE WHEN top > 0 THEN top ELSE 0 END AS matches, coalesce(n_candidates, 0) AS n_candidates, coalesce(n_tied, 0) AS n_tied FROM f LEFT JOIN b USING (session) LEFT JOIN t USING (session)""")
def launch_attribution(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    day = lambda n: F.timestamp_seconds(F.unix_seconds(F.lit("1992-01-01").cast("timestamp")) + n * 86_400)
    s = t.supplier.select(F.concat(F.lit("L"), F.lpad(k.cast("string"), 4, "0")).alias("launch"), day(k % 40 * 50).alias("start"), day(k % 40 * 50 + 400).alias("end"), k)
    printed = s.select("launch", F.explode(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: (k * 7 + i * 3) % 40)).alias("fingerprint"))
    rows = t.lineitem.select(F.col("l_orderkey").alias("session"), F.col("l_shipdate").alias("ts"), (F.col("l_partkey") % 40).alias("fp"))
    return M.attribute_launches(rows, printed, s.drop("s_suppkey"), "session", "ts", "fp")


@query("""WITH r AS (SELECT o_custkey AS k, o_orderkey AS seq, CASE o_orderstatus WHEN 'F' THEN 'OK' WHEN 'O' THEN 'FAIL' ELSE 'RUNNING' END AS state, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE round(o_totalprice / 1000, 1) END AS minutes FROM orders), x AS (SELECT c_custkey * 3 AS k, c_nationkey + 1 AS n FROM customer),
a AS (SELECT k, arg_max(minutes, seq) FILTER (state = 'OK' AND minutes IS NOT NULL) AS m, arg_max(state, seq) AS s FROM r GROUP BY k) SELECT coalesce(a.k, x.k) AS k, m AS minutes, CASE WHEN m IS NOT NULL THEN '' WHEN s IS NOT NULL THEN 'latest state ' || s ELSE 'refused ' || n END AS note FROM a FULL JOIN x ON a.k = x.k""")
def step_minutes(t: Tables) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "OK").when(F.col("o_orderstatus") == "O", "FAIL").otherwise("RUNNING")
    r = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), state.alias("state"), F.when(F.col("o_orderkey") % 5 != 0, F.round(F.col("o_totalprice") / 1000, 1)).alias("minutes"))
    return M.step_minutes(r, ["k"], "seq", "state", "minutes", t.customer.select((F.col("c_custkey") * 3).alias("k"), (F.col("c_nationkey") + 1).alias("n")))


@query("""WITH l AS (SELECT user_id, event_id, CASE event_type WHEN 'view' THEN 'START step' || (event_id % 5) WHEN 'error' THEN 'END fail' WHEN 'purchase' THEN 'END ok' ELSE 'noise' END AS line FROM events),
m AS (SELECT *, CASE WHEN line LIKE 'START%' THEN 's' WHEN line LIKE 'END%' THEN 'e' END AS k FROM l), w AS (SELECT *, lead(k) OVER v AS nk, lead(event_id) OVER v AS ne, lead(line) OVER v AS nl FROM m WHERE k IS NOT NULL WINDOW v AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id AS first, CASE WHEN nk = 'e' THEN ne END AS last, substr(line, 7) AS label, CASE WHEN nk = 'e' THEN substr(nl, 5) ELSE 'cut' END AS outcome FROM w WHERE k = 's'""")
def log_blocks(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    line = F.when(kind == "view", F.concat(F.lit("START step"), F.col("event_id") % 5)).when(kind == "error", "END fail").when(kind == "purchase", "END ok").otherwise("noise")
    return M.log_events(t.events.select("user_id", "event_id", line.alias("line")), ["user_id"], "event_id", "line", "^START (.*)$", "^END (.*)$")


@query("SELECT event_id, user_id, value, lag(value) OVER w AS prev_value, lag(event_type) OVER w AS prev_event_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def beacons_with_previous(t: Tables) -> DataFrame:
    return M.with_previous(t.events, "user_id", ["ts", "event_id"], ["value", "event_type"]).select("event_id", "user_id", "value", "prev_value", "prev_event_type")


@query("SELECT 'named' AS kind, count(*) AS n, count(DISTINCT user_id) AS sessions FROM events WHERE event_type <> 'view' UNION ALL SELECT 'unnamed', count(*), count(DISTINCT user_id) FROM events WHERE event_type = 'view'")
def attributable_rows(t: Tables) -> DataFrame:
    rows = t.events.withColumn("session", F.when(F.col("event_type") != "view", F.col("user_id").cast("string")).otherwise(" "))
    count = lambda d, name: d.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("sessions")).select(F.lit(name).alias("kind"), "n", "sessions")
    named, other = M.split_attributable(rows, "session")
    return count(named, "named").unionByName(count(other, "unnamed"))


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE l_shipdate END AS s, CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE o_orderdate END AS o, year(l_shipdate) AS sy, year(o_orderdate) AS oy FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT basis, count(*) AS n, round(sum(y), 2) AS years FROM (SELECT CASE WHEN s IS NOT NULL AND o IS NOT NULL THEN round(date_diff('day', o, s) / 365.25, 6) ELSE sy - oy END AS y, CASE WHEN s IS NOT NULL AND o IS NOT NULL THEN 'acquisition_date' ELSE 'year_label' END AS basis FROM d) GROUP BY basis""")
def elapsed_years(t: Tables) -> DataFrame:
    k = F.col("l_orderkey")
    j = t.lineitem.join(t.orders, k == F.col("o_orderkey"))
    e = M.elapsed_years(F.when(k % 6 != 0, F.col("o_orderdate")), F.when(k % 4 != 0, F.col("l_shipdate")), F.year("o_orderdate"), F.year("l_shipdate"))
    return j.select(e.alias("e")).groupBy("e.basis").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("e.years"), 2).alias("years"))


@query(f"""WITH {_DAYS}, q AS (SELECT user_id, list(CASE s WHEN 'P' THEN 'P' WHEN 'A' THEN 'A' ELSE 'U' END ORDER BY epoch) AS h FROM st GROUP BY 1), p AS (SELECT *, list_position(h, 'P') AS f, len(h) + 1 - list_position(list_reverse(h), 'P') AS l FROM q), z AS (SELECT *, h[l + 1:] AS after, h[1:f - 1] AS before, h[f:l] AS mid FROM p)
SELECT user_id, CASE WHEN f IS NULL OR f = 0 THEN 'NEVER_SEEN' WHEN list_contains(after, 'A') THEN 'LOST' WHEN list_contains(before, 'A') THEN 'GAINED' WHEN list_contains(mid, 'A') THEN 'FLICKERING' ELSE 'PERSISTENT' END AS trajectory FROM z""")
def trajectories(t: Tables) -> DataFrame:
    return S.trajectories(series(t).withColumn("s", F.when(F.col("s") == "-", "U").otherwise(F.col("s"))), "user_id", "epoch", "s")


@query(f"""WITH {_DAYS}, p AS (SELECT user_id, epoch - 1 AS e, least(1.0, coalesce(cover, 0) / 120) AS v FROM st), a AS (SELECT user_id, min(e) FILTER (v >= 0.5) AS f, max(e) FILTER (v >= 0.5) AS l FROM p GROUP BY 1),
b AS (SELECT a.user_id, f, l, coalesce(max(e) FILTER (v <= 0.15 AND e < f), -1) AS lo, coalesce(min(e) FILTER (v <= 0.15 AND e > l), 30) AS hi FROM a JOIN p USING (user_id) GROUP BY ALL)
SELECT user_id, coalesce(f, -1) AS first_seen, coalesce(l, -1) AS last_seen, CASE WHEN f IS NULL THEN -1 ELSE lo END AS first_lo, CASE WHEN f IS NULL THEN -1 ELSE hi END AS last_hi, CASE WHEN f IS NULL THEN -1 ELSE f - lo END AS first_width, CASE WHEN f IS NULL THEN -1 ELSE hi - l END AS last_width FROM b""")
def presence_intervals(t: Tables) -> DataFrame:
    p = series(t).select("user_id", (F.col("epoch") - 1).alias("e"), F.least(F.lit(1.0), F.coalesce("cover", F.lit(0.0)) / 120).alias("v"))
    return S.presence_intervals(p, "user_id", "e", "v", 30)


@query(f"WITH {_BITS}, g AS (SELECT * FROM b WHERE (user_id + epoch) % 4 <> 0) SELECT user_id, epoch, lead(epoch) OVER w - lag(epoch) OVER w AS bracket FROM g WINDOW w AS (PARTITION BY user_id ORDER BY epoch)")
def bracket_lengths(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("epoch")
    return _bits(t).filter("(user_id + epoch) % 4 <> 0").select("user_id", "epoch", (F.lead("epoch").over(w) - F.lag("epoch").over(w)).alias("bracket"))


@query("WITH y AS (SELECT DISTINCT year(o_orderdate) || lower(o_orderstatus) AS label FROM orders) SELECT label, row_number() OVER (ORDER BY substr(label, 1, 4)::INT DESC, label)::INT AS place FROM y")
def year_labels(t: Tables) -> DataFrame:
    """Labels ordered by their four-digit year (newest first), then whole."""
    y = t.orders.select(F.concat(F.year("o_orderdate"), F.lower("o_orderstatus")).alias("label")).distinct()
    return y.withColumn("place", F.row_number().over(Window.orderBy(F.substring("label", 1, 4).cast("int").desc(), "label")))  # a row a year and status


_THREE = f"{_PX}, e AS (SELECT row, col, max(CASE WHEN grid = 0 AND v <> 255 THEN (v >= 50)::INT END) AS a, max(CASE WHEN grid = 1 AND v <> 255 THEN (v >= 50)::INT END) AS b, max(CASE WHEN grid = 2 AND v <> 255 THEN (v >= 50)::INT END) AS c FROM px GROUP BY ALL)"


@query(f"WITH {_THREE} SELECT row, col, CASE WHEN a = 1 AND b = 0 AND c = 0 THEN 1 ELSE 0 END AS lost FROM e WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL")
def persistent_loss(t: Tables) -> DataFrame:
    return G.persistent_loss(pixels(t), [0, 1, 2], "v", 50)


@query()
def loss_hotspots(t: Tables) -> DataFrame:
    """Connected cells of persistent loss, two at the least, ranked by size."""
    lost = G.persistent_loss(pixels(t), [0, 1, 2], "v", 50).withColumn("grid", F.lit(0))
    c = G.components(lost, "lost", 2).groupBy("component").agg(F.count(F.lit(1)).alias("cells"))
    return c.withColumn("place", F.row_number().over(Window.orderBy(F.desc("cells"), "component")))  # a row a hotspot


@query(f"WITH {_PX}, j AS (SELECT a.row, a.col, a.v AS m, b.v % 4 AS code FROM px a JOIN px b USING (row, col) WHERE a.grid = 0 AND b.grid = 1), k AS (SELECT row, col, CASE WHEN m = 255 THEN 255 ELSE (m >= 50)::INT END AS m, code FROM j) SELECT row, col, CASE WHEN code = 1 THEN 1 WHEN code = 2 AND m <> 1 THEN 255 WHEN code = 3 THEN 255 ELSE m END AS m FROM k")
def label_additions(t: Tables) -> DataFrame:
    p = pixels(t)
    a = p.filter("grid = 0").select("row", "col", F.when(F.col("v") == 255, 255).otherwise((F.col("v") >= 50).cast("int")).alias("m"))
    b = p.filter("grid = 1").select("row", "col", (F.col("v") % 4).alias("code"))
    return a.join(b, ["row", "col"]).select("row", "col", G.with_additions(F.col("m"), F.col("code")).alias("m"))


@query(f"WITH {_PX} SELECT p.grid AS product, count(*) AS n, count(*) FILTER (p.v >= 60) AS false_positives, round(count(*) FILTER (p.v >= 60) / count(*), 6) AS rate FROM px p JOIN px f ON f.grid = 5 AND f.row = p.row AND f.col = p.col AND f.v < 30 WHERE p.grid < 5 AND p.v <> 255 GROUP BY 1")
def certified_flat_rates(t: Tables) -> DataFrame:
    p = pixels(t)
    return G.call_rates(p.filter("grid < 5").withColumnRenamed("grid", "product"), p.filter("grid = 5 AND v < 30").select("row", "col"), "product", "v", 60)


@query(f"""WITH {_PX}, j AS (SELECT a.row, a.col, a.v >= 50 AS base, b.v >= 50 AS arm, CASE WHEN m.v < 25 THEN 'gain' WHEN m.v < 60 THEN 'flat' ELSE 'rest' END AS pop FROM px a JOIN px b USING (row, col) JOIN px m USING (row, col) WHERE a.grid = 0 AND b.grid = 1 AND m.grid = 2 AND a.v <> 255 AND b.v <> 255),
r AS (SELECT pop, count(*) AS n, avg(base::INT) AS rb, avg(arm::INT) AS ra FROM (SELECT pop, base, arm FROM j WHERE pop <> 'rest' UNION ALL SELECT 'all', base, arm FROM j) GROUP BY 1), k AS (SELECT max(ra - rb) FILTER (pop = 'gain') - max(ra - rb) FILTER (pop = 'all') AS k FROM r)
SELECT pop AS population, n, round(rb, 6) AS base_rate, round(ra, 6) AS arm_rate, round(ra - rb, 6) AS rise, '' AS flag FROM r UNION ALL SELECT 'gain_minus_all', NULL, NULL, NULL, round(k, 6), CASE WHEN k > 0.0069 THEN 'CHANGE LAUNDERING' ELSE 'PASSES' END FROM k WHERE k IS NOT NULL""")
def change_laundering(t: Tables) -> DataFrame:
    p = pixels(t)
    side = lambda g, name: p.filter((F.col("grid") == g) & (F.col("v") != 255)).select("row", "col", (F.col("v") >= 50).cast("int").alias(name))
    pop = p.filter("grid = 2").select("row", "col", F.when(F.col("v") < 25, "gain").when(F.col("v") < 60, "flat").otherwise("rest").alias("population"))
    return G.change_laundering(side(0, "base").join(side(1, "arm"), ["row", "col"]).join(pop, ["row", "col"]), "population", "base", "arm", 0.0069)


@query("SELECT s_suppkey, ceil(3.0 / (0.01 + s_suppkey % 50 / 20))::BIGINT AS least_cells FROM supplier")
def least_patch_cells(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", G.least_cells(0.01 + F.col("s_suppkey") % 50 / 20, 3.0).alias("least_cells"))


_POLY = "pt AS (SELECT c_custkey AS k, (c_custkey * 37 % 101) + 0.25 AS x, (c_custkey * 59 % 97) + 0.25 AS y FROM customer), pg AS (SELECT p_partkey AS id, (p_partkey * 13 % 90)::DOUBLE AS x0, (p_partkey * 7 % 85)::DOUBLE AS y0, 4.0 + p_partkey % 9 AS w, p_size FROM part)"


@query(f"""WITH {_POLY}, h AS (SELECT k, id, p_size FROM pt JOIN pg ON y >= y0 AND x >= x0 AND (x - x0) + (y - y0) < w)
SELECT pt.k, min(h.id) AS id, count(h.id) AS n_matched, min(h.p_size) AS p_size_min, max(h.p_size) AS p_size_max FROM pt LEFT JOIN h USING (k) GROUP BY pt.k""")
def parcel_of_points(t: Tables) -> DataFrame:
    """Points in right triangles, several of which may hold one."""
    k, c = F.col("p_partkey"), F.col("c_custkey")
    x0, y0, w = (k * 13 % 90).cast("double"), (k * 7 % 85).cast("double"), 4.0 + k % 9
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    polygons = t.part.select(k.alias("id"), F.array(at(x0, y0), at(x0 + w, y0), at(x0, y0 + w)).alias("ring"), "p_size")
    points = t.customer.select(c.alias("k"), (c * 37 % 101 + 0.25).alias("x"), (c * 59 % 97 + 0.25).alias("y"))
    return P.attach_polygon(points, polygons, "k", "id", "ring", "p_size")


@query("""WITH a AS (SELECT s_suppkey AS k, s_nationkey AS g, (s_suppkey * 37 % 101)::DOUBLE AS x, (s_suppkey * 53 % 97)::DOUBLE AS y FROM supplier), b AS (SELECT s_suppkey AS k, s_nationkey AS g, (s_suppkey * 37 % 101) + 1.5 + (s_suppkey % 3) * 0.25 AS x, (s_suppkey * 53 % 97) - 0.5 AS y FROM supplier)
SELECT a.g, count(*) AS n, CASE WHEN count(*) >= 2 THEN median(b.x - a.x) END AS dx, CASE WHEN count(*) >= 2 THEN median(b.y - a.y) END AS dy FROM a JOIN b USING (k) GROUP BY a.g""")
def median_shifts(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    x, y = (k * 37 % 101).cast("double"), (k * 53 % 97).cast("double")
    pairs = t.supplier.select(F.col("s_nationkey").alias("g"), x.alias("ax"), y.alias("ay"), (x + 1.5 + k % 3 * 0.25).alias("bx"), (y - 0.5).alias("by"))
    return P.median_shift(pairs, ["g"], 2)


@query("""WITH RECURSIVE p AS (SELECT c_custkey AS k, (c_custkey * 37 % 101)::DOUBLE AS x, (c_custkey * 59 % 97)::DOUBLE AS y FROM customer), s(place, k, done) AS (SELECT 0, min(k), [min(k)] FROM p UNION ALL
  SELECT place + 1, nk, list_append(done, nk) FROM (SELECT s.place, s.done, (SELECT arg_max(p.k, (round((SELECT min(sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))) FROM p q WHERE list_contains(s.done, q.k)), 9), -p.k)) FROM p WHERE NOT list_contains(s.done, p.k)) AS nk FROM s WHERE place < 4)) SELECT place::INT AS place, k FROM s""")
def spread_picks(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    return P.spread_pick(t.customer.select(c.alias("k"), (c * 37 % 101).alias("x"), (c * 59 % 97).alias("y")), "k", "x", "y", 5)


@query("SELECT c_custkey, CASE WHEN m.s IS NULL THEN 'unknown' ELSE m.s END AS presence FROM (SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)) LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS s FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1) m ON o_custkey = c_custkey")
def presence_defaults(t: Tables) -> DataFrame:
    """A matrix's value for one year, with a default, of the entities that another table names."""
    m = t.orders.filter(F.year("o_orderdate") == 1996).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("s"))
    known = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")
    return known.join(m, "c_custkey", "left").select("c_custkey", F.coalesce("s", F.lit("unknown")).alias("presence"))
