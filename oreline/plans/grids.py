"""Queries of pixel tables (line items on grids), rule tables, pivots and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import curves as C
from ..operators import raster as G
from ..operators import verdicts as D
from .base import Tables, query

_PX = "px AS (SELECT (o % 6)::INT AS grid, (o // 6 % 25)::INT AS row, (o // 150)::INT AS col, CASE WHEN any_value(v) % 11 = 0 THEN 255 ELSE any_value(v) % 100 END::INT AS v FROM (SELECT l_orderkey % 3750 AS o, sum(l_partkey) AS v FROM lineitem GROUP BY 1) GROUP BY o)"


def pixels(t: Tables) -> DataFrame:
    o = t.lineitem.groupBy((F.col("l_orderkey") % 3750).alias("o")).agg(F.sum("l_partkey").alias("v"))
    return o.select((F.col("o") % 6).cast("int").alias("grid"), F.expr("cast(o div 6 % 25 as int)").alias("row"), F.expr("cast(o div 150 as int)").alias("col"), F.when(F.col("v") % 11 == 0, 255).otherwise(F.col("v") % 100).cast("int").alias("v"))


_NEAR = "SELECT p.grid, p.row, p.col, any_value(p.{v}) AS {v}, min(q.{v}) FILTER (q.{v} <> 255) AS lo, max(q.{v}) FILTER (q.{v} <> 255) AS hi, avg(q.{v}) FILTER (q.{v} <> 255) AS mean FROM {t} p JOIN {t} q ON p.grid = q.grid AND abs(p.row - q.row) <= 1 AND abs(p.col - q.col) <= 1 GROUP BY 1, 2, 3"
_STEP = "(SELECT grid, row, col, CASE WHEN m <> 255 THEN coalesce({w}, m) ELSE m END AS m FROM (" + _NEAR.format(v="m", t="{t}") + "))"


@query(f"WITH {_PX}, n AS ({_NEAR.format(v='v', t='px')}) SELECT grid, row, col, v, round(mean, 6) AS smooth FROM n")
def pixel_smooth(t: Tables) -> DataFrame:
    return G.smooth(pixels(t), "v")


@query(f"WITH {_PX}, h AS (SELECT grid, row, col, CASE WHEN v = 255 THEN 255 WHEN v >= 40 THEN 1 ELSE 0 END AS m FROM px), e1 AS {_STEP.format(w='lo', t='h')}, e2 AS {_STEP.format(w='hi', t='e1')}, e3 AS {_STEP.format(w='hi', t='e2')}, e4 AS {_STEP.format(w='lo', t='e3')} SELECT * FROM e4")
def threshold_and_clean(t: Tables) -> DataFrame:
    return G.threshold_and_clean(pixels(t), "v", 40)


@query(f"WITH {_PX} SELECT grid, row // 5 AS brow, col // 5 AS bcol, sum(v)::BIGINT AS total, count(*) AS n FROM px WHERE v <> 255 GROUP BY ALL")
def block_sums(t: Tables) -> DataFrame:
    return G.block_sum(pixels(t), "v", 5)


@query(f"WITH {_PX}, a AS (SELECT * FROM px WHERE grid = 0), b AS (SELECT 0 AS grid, row, col, v FROM px WHERE grid = 1 AND row <> 3) SELECT coalesce(a.grid, b.grid) AS grid, coalesce(a.row, b.row) AS row, coalesce(a.col, b.col) AS col, CASE WHEN a.v <> 255 AND b.v <> 255 THEN greatest(a.v, b.v) ELSE 255 END AS v FROM a FULL JOIN b USING (grid, row, col)")
def fuse_max(t: Tables) -> DataFrame:
    p = pixels(t)
    return G.fuse_max(p.filter("grid = 0"), p.filter("grid = 1 AND row <> 3").withColumn("grid", F.lit(0)), "v")


@query(f"WITH {_PX} SELECT 0 AS grid, row, col, round(avg(v), 6) AS mean, max(v) AS most, median(v)::DOUBLE AS mid FROM px WHERE v <> 255 GROUP BY row, col HAVING count(*) = 6")
def arm_combination(t: Tables) -> DataFrame:
    return G.combine(pixels(t).select(F.col("grid").alias("arm"), F.lit(0).alias("grid"), "row", "col", "v"), "v")


@query(f"""WITH RECURSIVE {_PX}, n AS (SELECT grid, row, col, row * 1000 + col AS id FROM px WHERE v <> 255 AND v >= 62), e AS (SELECT a.grid, a.id AS a, b.id AS b FROM n a JOIN n b ON a.grid = b.grid AND abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1),
r(grid, a, b) AS (SELECT * FROM e UNION SELECT r.grid, r.a, e.b FROM r JOIN e ON r.grid = e.grid AND r.b = e.a), l AS (SELECT grid, a, min(b) AS l FROM r GROUP BY 1, 2), s AS (SELECT grid, l, count(*) AS cells FROM l GROUP BY 1, 2)
SELECT n.grid, n.row, n.col, (l.l // 1000)::VARCHAR || ':' || (l.l % 1000)::VARCHAR AS component, cells FROM n JOIN l ON n.grid = l.grid AND n.id = l.a JOIN s ON s.grid = l.grid AND s.l = l.l WHERE cells >= 3""")
def pixel_components(t: Tables) -> DataFrame:
    return G.components(pixels(t).withColumn("m", ((F.col("v") != 255) & (F.col("v") >= 62)).cast("int")), "m", 3)


@query(f"WITH {_PX} SELECT (row // 10)::INT AS zone, count(*) AS n, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS sd, round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75 FROM px WHERE v <> 255 GROUP BY 1")
def zonal_stats(t: Tables) -> DataFrame:
    p = pixels(t)
    return G.zonal(p, p.select("grid", "row", "col", F.expr("cast(row div 10 as int)").alias("zone")), "v", "zone")


@query(f"WITH {_PX} SELECT row, " + ", ".join(f"round(CASE WHEN count(*) FILTER (grid = {a} AND v <> 255) >= 20 THEN avg(v) FILTER (grid = {a} AND v <> 255) END, 6) AS arm_{a}" for a in range(3)) + " FROM px GROUP BY row")
def cover_matrix(t: Tables) -> DataFrame:
    return G.cover_matrix(pixels(t), "row", "grid", "v", [0, 1, 2], 20)


@query(f"WITH {_PX} SELECT a.row, a.col, round((a.v - b.v)::DOUBLE / nullif(a.v + b.v, 0), 6) AS nd FROM px a JOIN px b ON a.grid = 0 AND b.grid = 1 AND a.row = b.row AND a.col = b.col WHERE a.v <> 255 AND b.v <> 255")
def normalized_difference(t: Tables) -> DataFrame:
    p = pixels(t).filter("v <> 255")
    a, b = p.filter("grid = 0").select("row", "col", F.col("v").alias("a")), p.filter("grid = 1").select("row", "col", F.col("v").alias("b"))
    return a.join(b, ["row", "col"]).select("row", "col", G.normalized_difference(F.col("a"), F.col("b")).alias("nd"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice IS NULL THEN 'unknown' WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'large done' WHEN o_orderpriority LIKE '1%' THEN 'urgent' WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'old' ELSE 'rest' END AS verdict,
  concat_ws('|', CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_orderstatus = 'O' THEN 'open' END, CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' END) AS flags,
  greatest(CASE WHEN o_totalprice > 200000 THEN 2 ELSE 0 END, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority LIKE '1%' THEN 3 ELSE 0 END) AS severity FROM orders""")
def rule_verdicts(t: Tables) -> DataFrame:
    large, opened, urgent = F.col("o_totalprice") > 200_000, F.col("o_orderstatus") == "O", F.col("o_orderpriority").startswith("1")
    verdict = D.first_rule([(F.col("o_totalprice").isNull(), "unknown"), ((F.col("o_orderstatus") == "F") & large, "large done"), (urgent, "urgent"), (F.col("o_orderdate") < "1996-01-01", "old")], "rest")
    found = D.flags([(large, "large"), (opened, "open"), (urgent, "urgent")])
    return t.orders.select("o_orderkey", verdict.alias("verdict"), F.concat_ws("|", found).alias("flags"), D.severity(found, {"large": 2, "open": 1, "urgent": 3}).alias("severity"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 1 AND l_discount <= 0.08 AND l_tax <= 0.06 THEN 'accept' ELSE 'refuse' END AS verdict, CASE WHEN NOT l_quantity >= 1 THEN 'quantity' WHEN NOT l_discount <= 0.08 THEN 'discount' WHEN NOT l_tax <= 0.06 THEN 'tax' END AS failed,
  CASE WHEN l_quantity < 2 THEN 'REJECT' WHEN (l_discount > 0.05)::INT + (l_tax > 0.05)::INT >= 1 AND NOT l_quantity > 40 THEN 'REPLACE' ELSE 'COMPLEMENT' END AS decision FROM lineitem""")
def acceptance_steps(t: Tables) -> DataFrame:
    v = D.steps_verdict([("quantity", F.col("l_quantity") >= 1), ("discount", F.col("l_discount") <= 0.08), ("tax", F.col("l_tax") <= 0.06)])
    wins = (F.col("l_discount") > 0.05).cast("int") + (F.col("l_tax") > 0.05).cast("int")
    decision = D.replacement(wins, (F.col("l_quantity") > 40).cast("int"), F.col("l_quantity") < 2)
    return t.lineitem.select("l_orderkey", "l_linenumber", v.alias("v"), decision.alias("decision")).select("l_orderkey", "l_linenumber", "v.verdict", "v.failed", "decision")


@query("""SELECT o_custkey, count(*) AS members, CASE WHEN count(*) FILTER (c IS NULL) > 0 THEN NULL WHEN count(DISTINCT c) = 1 THEN min(c) ELSE 'mixed' END AS class FROM (SELECT o_custkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderstatus END AS c FROM orders) GROUP BY 1""")
def work_rollup(t: Tables) -> DataFrame:
    return D.rollup_class(t.orders.select("o_custkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderstatus")).alias("c")), "o_custkey", "c")


@query("""WITH j AS (SELECT user_id, event_type AS key, ts, CASE event_id % 4 WHEN 0 THEN 'dead' WHEN 1 THEN 'waiting' WHEN 2 THEN 'refused' ELSE 'done' END AS state FROM events), l AS (SELECT user_id, arg_max(key, (ts, key)) AS key FROM j GROUP BY 1)
SELECT user_id, ['dead', 'waiting', 'refused', 'done'][min(list_position(['dead', 'waiting', 'refused', 'done'], state))] AS verdict FROM j JOIN l USING (user_id, key) GROUP BY 1""")
def queue_verdicts(t: Tables) -> DataFrame:
    order = ["dead", "waiting", "refused", "done"]
    state = F.element_at(F.array(*map(F.lit, order)), (F.col("event_id") % 4 + 1).cast("int"))
    return D.queue_verdict(t.events.select("user_id", F.col("event_type").alias("key"), "ts", state.alias("state")), "user_id", "key", "ts", "state", order)


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(avg(l_discount), 6) AS disc FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""")
def pricing_summary(t: Tables) -> DataFrame:
    r = t.lineitem.filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp")).rollup("l_returnflag", "l_linestatus")
    return r.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.avg("l_discount"), 6).alias("disc"))


@query("""WITH m AS (SELECT o_orderpriority AS site, year(o_orderdate)::INT AS yr, round(avg(o_totalprice), 4) AS v FROM orders GROUP BY 1, 2), c AS (SELECT yr, v AS ctl FROM m WHERE site = '5-LOW')
SELECT site, """ + ", ".join(f"any_value(v) FILTER (yr = {y}) AS y{y}" for y in (1996, 1998, 2000)) + """, round(regr_slope(v - ctl, yr), 6) AS adjusted_slope FROM m JOIN c USING (yr) GROUP BY site""")
def pivot_trend(t: Tables) -> DataFrame:
    m = t.orders.groupBy(F.col("o_orderpriority").alias("site"), F.year("o_orderdate").alias("yr")).agg(F.round(F.avg("o_totalprice"), 4).alias("v"))
    c = m.filter("site = '5-LOW'").select("yr", F.col("v").alias("ctl"))
    return m.join(c, "yr").groupBy("site").agg(*(F.max(F.when(F.col("yr") == y, F.col("v"))).alias(f"y{y}") for y in (1996, 1998, 2000)), F.round(F.regr_slope(F.col("v") - F.col("ctl"), F.col("yr")), 6).alias("adjusted_slope"))


@query("""WITH c AS (SELECT l_suppkey // 10 AS gx, l_partkey // 200 AS gy, count(*) FILTER (l_returnflag = 'R') AS misses, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT gx, gy, misses, n, round(misses / n, 6) AS share FROM c ORDER BY share DESC, gx, gy LIMIT 10""")
def topk_cells(t: Tables) -> DataFrame:
    c = t.lineitem.groupBy(F.expr("l_suppkey div 10").alias("gx"), F.expr("l_partkey div 200").alias("gy")).agg(F.count_if(F.col("l_returnflag") == "R").alias("misses"), F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", C.ratio("misses", "n")).orderBy(F.desc("share"), "gx", "gy").limit(10)


@query("""WITH m AS (SELECT l_suppkey, median(l_quantity) AS med FROM lineitem GROUP BY 1), d AS (SELECT l_suppkey, any_value(med) AS med, median(abs(l_quantity - med)) AS mad FROM lineitem JOIN m USING (l_suppkey) GROUP BY 1) SELECT l_suppkey, med::DOUBLE AS med, round(greatest(0.5, 1.4826 * mad), 6) AS spread FROM d""")
def robust_stats(t: Tables) -> DataFrame:
    m = t.lineitem.groupBy("l_suppkey").agg(F.median("l_quantity").alias("med"))
    d = t.lineitem.join(m, "l_suppkey").groupBy("l_suppkey", "med").agg(F.median(F.abs(F.col("l_quantity") - F.col("med"))).alias("mad"))
    return d.select("l_suppkey", "med", F.round(F.greatest(F.lit(0.5), 1.4826 * F.col("mad")), 6).alias("spread"))


@query("""WITH p AS (SELECT c_nationkey AS g, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) = 1), m AS (SELECT g, median(c_acctbal) AS med FROM p GROUP BY g)
SELECT g, c_custkey, round(c_acctbal / nullif(med, 0) - 1, 6) AS deviation, abs(c_acctbal / nullif(med, 0) - 1) > 0.4 AS flagged FROM p JOIN m USING (g)""")
def consistency_flags(t: Tables) -> DataFrame:
    w = Window.partitionBy("c_nationkey", "c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")
    p = t.customer.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(F.col("c_nationkey").alias("g"), "c_custkey", "c_acctbal")
    m = p.groupBy("g").agg(F.median("c_acctbal").alias("med"))
    dev = F.try_divide(F.col("c_acctbal"), F.col("med")) - 1
    return p.join(m, "g").select("g", "c_custkey", F.round(dev, 6).alias("deviation"), (F.abs(dev) > 0.4).alias("flagged"))


@query("SELECT conv_id, turn, role, lag(role) OVER w AS prev_role, length(text) - lag(length(text)) OVER w AS growth FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def conversation_turn_lag(t: Tables) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    n = F.length("text").cast("long")
    return t.conversations.select("conv_id", "turn", "role", F.lag("role").over(w).alias("prev_role"), (n - F.lag(n).over(w)).alias("growth"))


@query("SELECT n_name, r_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def star_join(t: Tables) -> DataFrame:
    j = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
