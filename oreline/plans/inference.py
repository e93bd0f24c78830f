"""Queries of inference, sampling quotas, report joins and accumulators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import inference as N
from ..operators import sampling as S
from .base import Tables, query

_CONF = "c AS (SELECT l_shipdate::DATE - l_shipdate::DATE % 1 AS x FROM lineitem LIMIT 0), a AS (SELECT o_orderpriority AS h, count(*) FILTER (o_custkey % 3 = 0 AND o_orderkey % 4 <> 0) AS tp, count(*) FILTER (o_custkey % 3 <> 0 AND o_orderkey % 4 = 0) AS fp, count(*) FILTER (o_custkey % 3 = 0 AND o_orderkey % 4 = 0) AS fn, count(*) FILTER (o_custkey % 3 <> 0 AND o_orderkey % 4 <> 0) AS tn FROM orders GROUP BY 1), w AS (SELECT h, (tp + fp + fn + tn) / sum(tp + fp + fn + tn) OVER () AS w FROM a)"
_CONF = _CONF[_CONF.index("a AS") :]


@query(f"""WITH {_CONF}, p AS (SELECT h, w, n, tp / n AS t, fn / n AS f FROM (SELECT *, tp + fp + fn + tn AS n FROM a) JOIN w USING (h)),
s AS (SELECT sum(w * t) AS x, sum(w * f) AS g, sum(w * w * t * (1 - t) / (n - 1)) AS vx, sum(w * w * f * (1 - f) / (n - 1)) AS vf, sum(-w * w * t * f / (n - 1)) AS c FROM p),
v AS (SELECT *, x + g AS y, vx + vf + 2 * c AS vy, vx + c AS cxy, x / (x + g) AS r FROM s)
SELECT round(y, 6) AS area, round(1.96 * sqrt(greatest(vy, 0)), 6) AS area_hw, round(r, 6) AS recall, round(1.96 * sqrt(greatest((vx + r * r * vy - 2 * r * cxy) / (y * y), 0)), 6) AS recall_hw FROM v""")
def stratified_accuracy(t: Tables) -> DataFrame:
    truth, call = F.col("o_custkey") % 3 == 0, F.col("o_orderkey") % 4 != 0
    cells = {"tp": truth & call, "fp": ~truth & ~call, "fn": truth & ~call, "tn": ~truth & call}
    a = t.orders.groupBy(F.col("o_orderpriority").alias("h")).agg(*(F.count_if(c).alias(k) for k, c in cells.items()))
    total = t.orders.agg(F.count(F.lit(1)).alias("_t"))  # one row
    w = a.join(F.broadcast(total)).select("h", (sum((F.col(c) for c in N.CELLS), F.lit(0)) / F.col("_t")).alias("w"))
    return N.stratified_accuracy(a, w, "h", "w")


@query("""WITH RECURSIVE g AS (SELECT o_custkey AS k, list(o_totalprice ORDER BY o_orderkey) AS y, list((o_orderkey % 97)::DOUBLE ORDER BY o_orderkey) AS x FROM orders GROUP BY 1 HAVING count(*) = 5),
o(p) AS (SELECT []::INT[] UNION ALL SELECT list_append(p, i::INT) FROM o, range(1, 6) r(i) WHERE len(p) < 5 AND NOT list_contains(p, i::INT)), f AS (SELECT p FROM o WHERE len(p) = 5),
c AS (SELECT k, [v - list_avg(x) FOR v IN x] AS x, [v - list_avg(y) FOR v IN y] AS y FROM g), s AS (SELECT *, abs(list_dot_product(x, y)) AS seen, sqrt(list_dot_product(x, x) * list_dot_product(y, y)) AS scale FROM c)
SELECT k, count(*) AS total, round(avg((abs(list_dot_product(x, [y[i] FOR i IN p])) >= seen - 1e-12 * scale)::INT::DOUBLE), 6) AS p FROM s, f WHERE scale > 0 GROUP BY k""")
def exact_permutation(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey", (F.col("o_orderkey") % 97).alias("x"), F.col("o_totalprice").alias("y"))
    return N.exact_permutation(o, "k", "o_orderkey", "x", "y", 5)


@query("""WITH d AS (SELECT p_brand AS g, p_partkey AS k, p_size AS x, p_retailprice AS y FROM part), r AS (SELECT g, k, rank() OVER (PARTITION BY g ORDER BY x) + (count(*) OVER (PARTITION BY g, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY g ORDER BY y) + (count(*) OVER (PARTITION BY g, y) - 1) / 2.0 AS ry FROM d),
s AS (SELECT g, corr(rx, ry) AS rho FROM r GROUP BY g), a AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k) AS i FROM r), z AS (SELECT g, ry, rep, row_number() OVER (PARTITION BY g, rep ORDER BY md5('sp/' || rep || '/' || k), k) AS i FROM r, range(1, 41) q(rep)),
c AS (SELECT a.g, z.rep, corr(a.rx, z.ry) AS r FROM a JOIN z USING (g, i) GROUP BY ALL) SELECT g, round(any_value(rho), 6) AS rho, round(avg((abs(r) >= abs(rho) - 1e-12)::INT::DOUBLE), 6) AS p FROM c JOIN s USING (g) GROUP BY g""")
def spearman_permuted(t: Tables) -> DataFrame:
    d = t.part.select(F.col("p_brand").alias("g"), F.col("p_partkey").alias("k"), F.col("p_size").alias("x"), F.col("p_retailprice").alias("y"))
    return N.shuffled_p(d, "g", "k", "x", "y", 40, "sp")


_U = "(('0x' || substr(md5({0}), 1, 8))::BIGINT::DOUBLE / 4294967296.0)"


@query(f"""WITH c AS (SELECT r_regionkey AS k, 0.02 * (r_regionkey + 1) AS g, 0.01 * r_regionkey AS l FROM region), d AS (SELECT k, rep, CASE WHEN u < g THEN 1 WHEN u < g + l THEN -1 ELSE 0 END AS d FROM (SELECT k, rep, g, l, {_U.format("'pw/' || k || '/' || rep || '/' || i")} AS u FROM c, range(1, 101) a(rep), range(1, 201) b(i))),
s AS (SELECT k, rep, sum(d) AS s, sum(d * d) AS q, count(*) AS n FROM d GROUP BY ALL) SELECT k, round(avg((s * s > 1.96 * 1.96 * (q - s * s / n))::INT::DOUBLE), 6) AS power, round(avg(s / n), 6) AS mean_net FROM s GROUP BY k""")
def change_power(t: Tables) -> DataFrame:
    k = F.col("r_regionkey")
    c = t.region.select(k.alias("k"), (0.02 * (k + 1)).alias("g"), (0.01 * k).alias("l"), F.lit(200).alias("n"))
    return N.simulated_power(c, "k", "g", "l", "n", 100, "pw")


@query(f"""WITH c AS (SELECT r_regionkey AS k, 0.2::DOUBLE AS w, 0.1 * (r_regionkey + 1) AS p FROM region), d AS (SELECT k, w, p, rep, avg(({_U.format("'cv/' || k || '/' || rep || '/' || i")} < p)::INT::DOUBLE) AS e FROM c, range(1, 101) a(rep), range(1, 51) b(i) GROUP BY ALL),
s AS (SELECT rep, sum(w * e) AS e, sum(w * p) AS t, sum(w * w * e * (1 - e) / 49) AS v FROM d GROUP BY rep) SELECT round(avg((abs(e - t) <= 1.96 * sqrt(v))::INT::DOUBLE), 6) AS coverage, round(avg(1.96 * sqrt(v)), 6) AS half_width FROM s""")
def sample_coverage(t: Tables) -> DataFrame:
    k = F.col("r_regionkey")
    s = t.region.select(k.alias("k"), F.lit(0.2).alias("w"), (0.1 * (k + 1)).alias("p"), F.lit(50).alias("n"))
    return N.simulated_coverage(s, "k", "w", "p", "n", 100, "cv")


@query("""WITH g AS (SELECT o_custkey AS k, count(*) AS n, list(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_totalprice / 1000000 END ORDER BY o_orderkey) AS e FROM orders GROUP BY 1)
SELECT k, CASE WHEN len(list_filter(e, lambda x: x IS NULL)) = 0 AND e[1] * 0.3 * pow(0.7, n - 1) > 0 THEN round(0.01 * list_product([1 - x FOR x IN e]) / (e[1] * 0.3 * pow(0.7, n - 1)), 6) END AS odds FROM g""")
def fill_odds(t: Tables) -> DataFrame:
    g = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("o_orderkey", F.when(F.col("o_orderkey") % 31 != 0, F.col("o_totalprice") / 1000000).alias("e")))).alias("q"))
    odds = N.fill_odds(F.col("n"), F.lit(0.01), F.transform("q", lambda r: r["e"]), F.lit(0.3))
    return g.select("k", F.round(odds, 6).alias("odds"))


@query("WITH t AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 0.9 + n_nationkey / 50 END AS g, n_nationkey - 5.0 AS o FROM nation) SELECT c_custkey, round(least(255.0, greatest(0.0, (c_acctbal / 40) * coalesce(g, 1.0) + coalesce(o, 0.0))), 6) AS v FROM customer LEFT JOIN t ON k = c_nationkey")
def normalized_values(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    table = t.nation.select(k.alias("c_nationkey"), F.when(k % 3 != 0, 0.9 + k / 50).alias("g"), (k - 5.0).alias("o"))
    return t.customer.join(table, "c_nationkey", "left").select("c_custkey", F.round(N.normalized(F.col("c_acctbal") / 40, F.col("g"), F.col("o")), 6).alias("v"))


@query("WITH g AS (SELECT s_suppkey, s_acctbal / 10000 - 0.4 AS gap FROM supplier) SELECT s_suppkey, CASE WHEN gap >= 0.2 THEN 'REPLICATED' WHEN gap <= -0.1 THEN 'DOES NOT STAND' ELSE 'UNRESOLVED' END AS verdict FROM g")
def gap_verdicts(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", N.gap_verdict(F.col("s_acctbal") / 10000 - 0.4, 0.2, -0.1).alias("verdict"))


@query("""WITH c AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN 'many' ELSE p_size::VARCHAR END AS value, CASE WHEN p_partkey % 2 = 0 THEN 1.0 END AS tol FROM part), e AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN (p_size + p_partkey % 4)::VARCHAR ELSE p_size::VARCHAR END AS got FROM part WHERE p_partkey % 7 <> 0)
SELECT k, CASE WHEN got IS NULL THEN 'unresolved' WHEN tol IS NOT NULL THEN CASE WHEN try_cast(value AS DOUBLE) IS NULL THEN 'error' WHEN abs(got::DOUBLE - value::DOUBLE) <= tol THEN 'ok' ELSE 'drifted' END WHEN got = value THEN 'ok' ELSE 'drifted' END AS state FROM c LEFT JOIN e USING (k)""")
def claim_checks(t: Tables) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    c = t.part.select(k.alias("k"), F.when(k % 11 == 0, F.lit("many")).otherwise(size.cast("string")).alias("value"), F.when(k % 2 == 0, F.lit(1.0)).alias("tol"))
    e = t.part.filter(k % 7 != 0).select(k.alias("k"), F.when(k % 5 == 0, size + k % 4).otherwise(size).cast("string").alias("value"))
    return N.verify_claims(c, e, "k", "value", "tol").select("k", "state")


@query()
def nation_clusters(t: Tables) -> DataFrame:
    """Complete linkage over one row a nation."""
    n = t.customer.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("mean"), F.count(F.lit(1)).cast("double").alias("n"))
    return N.cluster_profiles(n, "c_nationkey", ["mean", "n"], 4)


@query("SELECT a.c_nationkey AS k, count(*) AS n, round(corr(a.v, b.v), 6) AS r FROM (SELECT c_nationkey, c_custkey % 40 AS cell, avg(c_acctbal) AS v FROM customer GROUP BY ALL) a JOIN (SELECT s_nationkey, s_suppkey % 40 AS cell, avg(s_acctbal) AS v FROM supplier GROUP BY ALL) b ON s_nationkey = c_nationkey AND a.cell = b.cell GROUP BY 1 HAVING count(*) > 2")
def field_correlation(t: Tables) -> DataFrame:
    """Two displacement fields joined on their cells."""
    a = t.customer.groupBy(F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 40).alias("cell")).agg(F.avg("c_acctbal").alias("v"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("k"), (F.col("s_suppkey") % 40).alias("cell")).agg(F.avg("s_acctbal").alias("u"))
    return a.join(b, ["k", "cell"]).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.round(F.corr("v", "u"), 6).alias("r")).filter("n > 2")


_ARMS = "ar AS (SELECT o_orderkey AS arm, year(o_orderdate) AS yr, o_orderstatus AS ref, o_orderpriority AS policy, CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE floor(o_totalprice % 1000) / 1000 END AS recall, o_custkey FROM orders)"


def _arms(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select(k.alias("arm"), F.year("o_orderdate").alias("yr"), F.col("o_orderstatus").alias("ref"), F.col("o_orderpriority").alias("policy"), F.when(k % 19 != 0, F.floor(F.col("o_totalprice") % 1000) / 1000).alias("recall"), "o_custkey")


@query(f"WITH {_ARMS} SELECT yr, ref, arm, recall, row_number() OVER (PARTITION BY yr, ref ORDER BY recall DESC NULLS LAST, arm)::INT AS place FROM ar WHERE policy = '2-HIGH'")
def year_scoreboard(t: Tables) -> DataFrame:
    """Every arm's place within its year and reference, at one policy; unknown recalls last, ties by arm."""
    w = Window.partitionBy("yr", "ref").orderBy(F.desc_nulls_last("recall"), "arm")
    return _arms(t).filter("policy = '2-HIGH'").select("yr", "ref", "arm", "recall", F.row_number().over(w).alias("place"))


@query(f"WITH {_ARMS}, c AS (SELECT yr FROM ar WHERE recall IS NOT NULL GROUP BY yr HAVING count(DISTINCT policy) = (SELECT count(DISTINCT policy) FROM ar)), m AS (SELECT policy, yr, avg(recall) AS m FROM ar SEMI JOIN c USING (yr) GROUP BY ALL) SELECT policy, count(*) AS years, round(max(m) - min(m), 6) AS spread FROM m GROUP BY 1")
def policy_spread(t: Tables) -> DataFrame:
    """Greatest less least mean over the years that every policy has."""
    a = _arms(t)
    n = a.agg(F.countDistinct("policy").alias("n"))  # one row
    common = a.filter("recall IS NOT NULL").groupBy("yr").agg(F.countDistinct("policy").alias("m")).join(F.broadcast(n)).filter("m = n").select("yr")
    m = a.join(common, "yr", "left_semi").groupBy("policy", "yr").agg(F.avg("recall").alias("m"))
    return m.groupBy("policy").agg(F.count(F.lit(1)).alias("years"), F.round(F.max("m") - F.min("m"), 6).alias("spread"))


@query(f"WITH {_ARMS} SELECT ref, policy, arg_max(arm, (recall, -arm)) AS best, max(recall) AS recall FROM ar WHERE recall IS NOT NULL GROUP BY ALL")
def policy_results(t: Tables) -> DataFrame:
    return _arms(t).filter("recall IS NOT NULL").groupBy("ref", "policy").agg(F.max_by("arm", F.struct("recall", -F.col("arm"))).alias("best"), F.max("recall").alias("recall"))


@query("""SELECT o_orderkey, c_name, n_name, r_name, coalesce(l.n, 0) AS lines, round(l.q, 2) AS quantity FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey""")
def order_passport(t: Tables) -> DataFrame:
    """One row an order from five homes; every join's other side has one row a key."""
    li = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("q"))
    c = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(t.region, F.col("r_regionkey") == F.col("n_regionkey"), "left").withColumnRenamed("c_custkey", "o_custkey")
    out = t.orders.join(c, "o_custkey", "left").join(li, "o_orderkey", "left")
    return out.select("o_orderkey", "c_name", "n_name", "r_name", F.coalesce("lines", F.lit(0)).alias("lines"), F.round("q", 2).alias("quantity"))


@query("""WITH b AS (SELECT p_partkey, p_size, p_partkey % 40 = 0 AS forced, CASE WHEN p_size % 10 <= 2 THEN 0 WHEN p_size <= 15 THEN 1 WHEN p_size <= 30 THEN 2 ELSE 3 END AS bin, md5('st/' || p_partkey) AS h FROM part), f AS (SELECT count(*) AS f FROM b WHERE forced),
p AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY h, p_partkey) AS k, (SELECT count(DISTINCT bin) FROM b WHERE NOT forced) AS nb, greatest(0, 60 - (SELECT f FROM f)) AS room FROM b WHERE NOT forced),
q AS (SELECT *, k <= greatest(1, room // greatest(1, nb)) AS quota FROM p), r AS (SELECT *, row_number() OVER (ORDER BY NOT quota, CASE WHEN quota THEN bin ELSE 0 END, CASE WHEN quota THEN k ELSE 0 END, h, p_partkey) AS place FROM q)
SELECT p_partkey, bin, true AS forced FROM b WHERE forced UNION ALL SELECT p_partkey, bin, false FROM r WHERE place <= room""")
def quota_sample(t: Tables) -> DataFrame:
    size = F.col("p_size")
    b = t.part.select("p_partkey", (F.col("p_partkey") % 40 == 0).alias("forced"), F.when(size % 10 <= 2, 0).when(size <= 15, 1).when(size <= 30, 2).otherwise(3).alias("bin"))
    return S.quota_sample(b, "p_partkey", "bin", "forced", 60, "st/")


@query("""WITH b AS (SELECT p_partkey, p_partkey % 40 = 0 AS forced, p_size % 7 = 0 AS green, CASE WHEN p_size % 10 <= 2 THEN 0 WHEN p_size <= 15 THEN 1 WHEN p_size <= 30 THEN 2 ELSE 3 END AS bin, md5('cw/' || p_partkey) AS h FROM part), n AS (SELECT greatest(0, 80 - count(*) FILTER (forced)) AS room, count(*) FILTER (NOT forced AND bin = 0) AS bg, count(*) FILTER (NOT forced AND bin = 0 AND green) AS gr, count(DISTINCT bin) FILTER (NOT forced AND bin <> 0) AS nb FROM b),
m AS (SELECT *, least(bg, round(0.22 * room)::BIGINT) AS nbg FROM n), o AS (SELECT *, least(gr, round(0.15 * nbg)::BIGINT) AS ng, room - nbg AS nc FROM m),
z AS (SELECT b.*, o.*, row_number() OVER (PARTITION BY bin = 0, bin = 0 AND green ORDER BY h, p_partkey) AS kg, row_number() OVER (PARTITION BY bin ORDER BY h, p_partkey) AS kb FROM b, o WHERE NOT forced),
a0 AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN green THEN kg > ng ELSE false END, green AND kg <= ng DESC, green, h, p_partkey) AS place FROM z WHERE bin = 0), a1 AS (SELECT *, kb <= greatest(1, nc // greatest(1, nb)) AS quota FROM z WHERE bin <> 0), a2 AS (SELECT *, row_number() OVER (ORDER BY NOT quota, CASE WHEN quota THEN bin ELSE 0 END, CASE WHEN quota THEN kb ELSE 0 END, h, p_partkey) AS place FROM a1)
SELECT p_partkey, 'forced' AS kind FROM b WHERE forced UNION ALL SELECT p_partkey, CASE WHEN green THEN 'green' ELSE 'background' END FROM a0 WHERE place <= nbg UNION ALL SELECT p_partkey, 'canopy' FROM a2 WHERE place <= nc""")
def citywide_tiles(t: Tables) -> DataFrame:
    size = F.col("p_size")
    b = t.part.select("p_partkey", (F.col("p_partkey") % 40 == 0).alias("forced"), (size % 7 == 0).alias("green"), F.when(size % 10 <= 2, 0).when(size <= 15, 1).when(size <= 30, 2).otherwise(3).alias("bin"))
    return S.citywide_tiles(b, "p_partkey", "bin", "forced", "green", 80, "cw/")


@query("SELECT CASE WHEN l_discount <= 0 THEN 0 WHEN l_discount <= 0.25 / 5 THEN 1 WHEN l_discount <= 0.5 / 5 THEN 2 ELSE 3 END AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def share_bins(t: Tables) -> DataFrame:
    d = F.col("l_discount")
    return t.lineitem.groupBy(F.when(d <= 0, 0).when(d <= 0.25 / 5, 1).when(d <= 0.5 / 5, 2).otherwise(3).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_partkey, count(DISTINCT year(l_shipdate)) AS years, round(stddev_pop(m), 6) AS sd FROM (SELECT l_partkey, l_shipdate, avg(l_discount) OVER (PARTITION BY l_partkey, year(l_shipdate)) AS m, row_number() OVER (PARTITION BY l_partkey, year(l_shipdate)) AS k FROM lineitem) WHERE k = 1 GROUP BY 1")
def yearly_flicker(t: Tables) -> DataFrame:
    """Spread over years of a part's yearly means."""
    m = t.lineitem.groupBy("l_partkey", F.year("l_shipdate").alias("yr")).agg(F.avg("l_discount").alias("m"))
    return m.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("years"), F.round(F.stddev_pop("m"), 6).alias("sd"))


@query("SELECT l_returnflag, count(*) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_pop(l_extendedprice), 4) AS sd, count(*) FILTER (l_extendedprice < 20000) AS b0, count(*) FILTER (l_extendedprice >= 20000 AND l_extendedprice < 50000) AS b1, count(*) FILTER (l_extendedprice >= 50000) AS b2 FROM lineitem GROUP BY 1")
def merged_accumulators(t: Tables) -> DataFrame:
    """Count, mean, spread and histogram of each group, merged from accumulators (n, sum, sum of squares, bins) of parts of the rows."""
    p = F.col("l_extendedprice")
    parts = t.lineitem.groupBy("l_returnflag", F.year("l_shipdate").alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("q"), *(F.count_if(c).alias(f"b{i}") for i, c in enumerate((p < 20000, (p >= 20000) & (p < 50000), p >= 50000))))
    m = parts.groupBy("l_returnflag").agg(*(F.sum(c).alias(c) for c in ("n", "s", "q", "b0", "b1", "b2")))
    mean = F.col("s") / F.col("n")
    return m.select("l_returnflag", "n", F.round(mean, 4).alias("mean"), F.round(F.sqrt(F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0))), 4).alias("sd"), "b0", "b1", "b2")


@query("SELECT * FROM (VALUES ('customers', true), ('parts', true), ('texts', true)) v(what, within)")
def approximate_distinct(t: Tables) -> DataFrame:
    """Sketched counts of distinct values against exact ones: within a tenth."""
    def one(d: DataFrame, c: str, name: str) -> DataFrame:
        value = F.sha2(c, 256) if dict(d.dtypes)[c] == "string" else F.col(c)  # texts are told apart by their digests
        # in one aggregation each distinct value would carry a sketch of its own
        a = d.agg(F.approx_count_distinct(c, 0.02).alias("a")).crossJoin(d.agg(F.countDistinct(value).alias("e")))
        return a.select(F.lit(name).alias("what"), (F.abs(F.col("a") - F.col("e")) <= 0.1 * F.col("e")).alias("within"))

    return one(t.orders, "o_custkey", "customers").unionByName(one(t.lineitem, "l_partkey", "parts")).unionByName(one(t.documents, "text", "texts"))


@query("SELECT 'lineitem' AS file, count(*) AS n, count(l_quantity) AS filled, min(l_quantity) AS least, max(l_quantity) AS most, round(avg(l_quantity), 6) AS mean, count(DISTINCT l_quantity) AS kinds FROM lineitem UNION ALL SELECT 'orders', count(*), count(o_totalprice), min(o_totalprice), max(o_totalprice), round(avg(o_totalprice), 6), count(DISTINCT o_totalprice) FROM orders")
def column_profiles(t: Tables) -> DataFrame:
    def one(d: DataFrame, c: str, name: str) -> DataFrame:
        return d.agg(F.count(F.lit(1)).alias("n"), F.count(c).alias("filled"), F.min(c).alias("least"), F.max(c).alias("most"), F.round(F.avg(c), 6).alias("mean"), F.countDistinct(c).alias("kinds")).select(F.lit(name).alias("file"), "*")

    return one(t.lineitem, "l_quantity", "lineitem").unionByName(one(t.orders, "o_totalprice", "orders"))
