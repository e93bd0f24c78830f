"""Queries of estimators, sampling and splits over orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sampling as P
from ..operators import stats as S
from .base import Tables, query

_STRATA = "strata AS (SELECT o_orderpriority, count(*) AS size FROM orders GROUP BY 1), smp AS (SELECT *, (o_orderstatus = 'F')::INT AS y, round(o_totalprice / 1000, 2) AS x FROM orders WHERE o_orderkey % 7 = 0)"


def _strata(t: Tables) -> tuple[DataFrame, DataFrame]:
    smp = t.orders.filter("o_orderkey % 7 = 0").withColumns({"y": (F.col("o_orderstatus") == "F").cast("int"), "x": F.round(F.col("o_totalprice") / 1000, 2)})
    return smp, t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("size"))


@query(f"""WITH {_STRATA}, s AS (SELECT o_orderpriority, avg(y) AS m, coalesce(var_samp(y), 0) AS v, count(y) AS n FROM smp GROUP BY 1),
j AS (SELECT s.*, size / sum(size) OVER () AS w FROM strata JOIN s USING (o_orderpriority)) SELECT sum(n)::BIGINT AS n, round(sum(w * m), 6) AS mean, round(sqrt(sum(w * w * v / n)), 6) AS se FROM j""")
def strat_estimate(t: Tables) -> DataFrame:
    smp, strata = _strata(t)
    return S.stratified_mean(smp, strata, "o_orderpriority", "y", "size")


@query(f"""WITH {_STRATA}, s AS (SELECT o_orderpriority, avg(y) AS my, avg(x) AS mx, var_samp(y) AS vy, var_samp(x) AS vx, covar_samp(y, x) AS c, count(*) AS n FROM smp GROUP BY 1),
j AS (SELECT s.*, size, sum(size * my) OVER () / sum(size * mx) OVER () AS r, sum(size * mx) OVER () AS tx FROM strata JOIN s USING (o_orderpriority))
SELECT round(any_value(r), 6) AS ratio, round(sqrt(sum(size * size / n * (vy + r * r * vx - 2 * r * c))) / abs(any_value(tx)), 6) AS se FROM j""")
def strat_ratio(t: Tables) -> DataFrame:
    smp, strata = _strata(t)
    return S.stratified_ratio(smp, strata, "o_orderpriority", "y", "x", "size")


_MONTHLY = "monthly AS (SELECT o_orderpriority, year(o_orderdate)::INT AS yr, count(*)::DOUBLE AS n FROM orders GROUP BY 1, 2)"


def _monthly(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).cast("double").alias("n"))


@query(f"""WITH {_MONTHLY}, s AS (SELECT a.o_orderpriority, median((b.n - a.n) / (b.yr - a.yr)) AS slope FROM monthly a JOIN monthly b ON a.o_orderpriority = b.o_orderpriority AND b.yr > a.yr GROUP BY 1)
SELECT o_orderpriority, round(slope, 6) AS slope, round(median(n - slope * yr), 4) AS intercept FROM monthly JOIN s USING (o_orderpriority) GROUP BY o_orderpriority, slope""")
def theil_sen(t: Tables) -> DataFrame:
    return S.theil_sen(_monthly(t), ["o_orderpriority"], "yr", "n")


@query(f"WITH {_MONTHLY} SELECT o_orderpriority, count(*) AS n, round(regr_slope(n, yr), 6) AS slope, round(regr_intercept(n, yr), 4) AS intercept, round(corr(n, yr), 6) AS r FROM monthly GROUP BY 1")
def ols(t: Tables) -> DataFrame:
    return S.ols(_monthly(t), ["o_orderpriority"], "yr", "n")


@query("""WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY l_returnflag ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_returnflag, l_discount) - 1) / 2.0 AS ry FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM r GROUP BY 1""")
def spearman(t: Tables) -> DataFrame:
    return S.spearman(t.lineitem.select("l_returnflag", "l_quantity", "l_discount"), ["l_returnflag"], "l_quantity", "l_discount")


@query("""WITH b AS (SELECT (l_orderkey % 20)::INT AS block, count(*) FILTER (l_returnflag = 'R') AS hits, count(*) AS n FROM lineitem GROUP BY 1),
d AS (SELECT r.rep::INT AS rep, (((((r.rep * 7919 + p.place + 1) * 2654435761) % 4294967296) // 65536) % 20)::INT AS block FROM range(200) r(rep), range(20) p(place)),
s AS (SELECT rep, sum(hits) AS hits, sum(n) AS n FROM d JOIN b USING (block) GROUP BY rep)
SELECT count(*) AS replicates, round(quantile_cont(hits / n, 0.025), 6) AS lo, round(quantile_cont(hits / n, 0.5), 6) AS mid, round(quantile_cont(hits / n, 0.975), 6) AS hi FROM s""")
def block_bootstrap(t: Tables) -> DataFrame:
    blocks = t.lineitem.groupBy((F.col("l_orderkey") % 20).cast("int").alias("block")).agg(F.count_if(F.col("l_returnflag") == "R").alias("hits"), F.count(F.lit(1)).alias("n"))
    s = S.block_bootstrap(blocks, "block", 20, ["hits", "n"], 200).withColumn("share", F.col("hits") / F.col("n"))
    q = lambda p: F.round(F.percentile("share", p), 6)
    return s.agg(F.count(F.lit(1)).alias("replicates"), q(0.025).alias("lo"), q(0.5).alias("mid"), q(0.975).alias("hi"))


@query("""WITH b AS (SELECT (l_orderkey % 20)::INT AS block, count(*) FILTER (l_returnflag = 'R') AS a, count(*) FILTER (l_returnflag = 'N') AS b, count(*) AS n FROM lineitem GROUP BY 1),
d AS (SELECT r.rep::INT AS rep, (((((r.rep * 7919 + p.place + 1) * 2654435761) % 4294967296) // 65536) % 20)::INT AS block FROM range(200) r(rep), range(20) p(place)),
s AS (SELECT rep, (sum(a) - sum(b)) / sum(n) AS gap FROM d JOIN b USING (block) GROUP BY rep)
SELECT round(quantile_cont(gap, 0.025), 6) AS lo, round(quantile_cont(gap, 0.975), 6) AS hi, quantile_cont(gap, 0.025) > 0 OR quantile_cont(gap, 0.975) < 0 AS significant FROM s""")
def paired_bootstrap(t: Tables) -> DataFrame:
    flag = lambda f: F.count_if(F.col("l_returnflag") == f)
    blocks = t.lineitem.groupBy((F.col("l_orderkey") % 20).cast("int").alias("block")).agg(flag("R").alias("a"), flag("N").alias("b"), F.count(F.lit(1)).alias("n"))
    s = S.block_bootstrap(blocks, "block", 20, ["a", "b", "n"], 200).withColumn("gap", (F.col("a") - F.col("b")) / F.col("n"))
    lo, hi = F.percentile("gap", 0.025), F.percentile("gap", 0.975)
    return s.agg(F.round(lo, 6).alias("lo"), F.round(hi, 6).alias("hi"), ((lo > 0) | (hi < 0)).alias("significant"))


@query("""WITH RECURSIVE c AS (SELECT source, count(*) FILTER (toxic = 1) AS k, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1),
b(source, k, n, i, lo, hi) AS (SELECT source, k, n, 0, (k / n)::DOUBLE, 1.0::DOUBLE FROM c WHERE k < n UNION ALL
  SELECT source, k, n, i + 1, CASE WHEN d > 0.05 THEN mid ELSE lo END, CASE WHEN d > 0.05 THEN hi ELSE mid END FROM (SELECT *, (lo + hi) / 2 AS mid, list_sum([exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln((lo + hi) / 2) + (n - x) * ln(1 - (lo + hi) / 2)) FOR x IN range(0, k + 1)]) AS d FROM b WHERE i < 50))
SELECT c.source, c.k, c.n, CASE WHEN c.k = c.n THEN 1.0 ELSE round(hi, 6) END AS upper FROM c LEFT JOIN b ON b.source = c.source AND b.i = 50""")
def clopper_pearson(t: Tables) -> DataFrame:
    c = t.labels.join(t.documents.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.count_if(F.col("toxic") == 1).alias("k"), F.count(F.lit(1)).alias("n"))
    return c.withColumn("upper", S.clopper_pearson_upper("k", "n"))


@query("""WITH c AS (SELECT source, count(*) FILTER (toxic = 1) AS k, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1)
SELECT source, n, round(1 - pow(0.05, 1.0 / n), 6) AS zero_bound, round(1 - pow(1 - k / n, 1.0 / 3), 6) AS annual, round(least(1.0, greatest(0.0, 0.9 * (n * 0.01) * 0.2 / nullif(0.8 * (1 - n * 0.01), 0))), 6) AS fpr FROM c""")
def rate_formulas(t: Tables) -> DataFrame:
    c = t.labels.join(t.documents.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.count_if(F.col("toxic") == 1).alias("k"), F.count(F.lit(1)).alias("n"))
    return c.select("source", "n", S.zero_failure_bound(F.col("n")).alias("zero_bound"), S.annual_rate(F.col("k") / F.col("n"), F.lit(3.0)).alias("annual"), S.false_positive_rate(F.lit(0.8), F.lit(0.9), F.col("n") * 0.01).alias("fpr"))


@query()
def latent_class(t: Tables) -> DataFrame:
    d = t.documents.join(t.labels, "doc_id").select((F.col("n_chars") > 1500).cast("int").alias("long"), F.col("quality").alias("good"), (1 - F.col("toxic")).alias("clean"))
    return S.latent_classes(d.groupBy("long", "good", "clean").agg(F.count(F.lit(1)).alias("n")), ["long", "good", "clean"])


@query("SELECT o_orderpriority, o_orderkey, rank FROM (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY sha256('s1' || o_orderkey::VARCHAR), o_orderkey)::INT AS rank FROM orders) WHERE rank <= 25")
def stratified_draw(t: Tables) -> DataFrame:
    return P.draw(t.orders, "o_orderpriority", "o_orderkey", 25, "s1").select("o_orderpriority", "o_orderkey", "rank")


@query("""WITH s AS (SELECT o_orderpriority, count(*) AS size FROM orders GROUP BY 1)
SELECT o_orderpriority, size, least(size, greatest(2, ceil(500.0 * size / sum(size) OVER ()) ))::BIGINT AS n FROM s""")
def allocation(t: Tables) -> DataFrame:
    return P.allocate(t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("size")), "size", 500)


@query("""WITH b AS (SELECT DISTINCT (o_custkey // 50)::BIGINT AS block FROM orders), f AS (SELECT block, CASE WHEN ('0x' || substr(md5('f' || block::VARCHAR), 1, 4))::BIGINT % 10 < 7 THEN 'train' WHEN ('0x' || substr(md5('f' || block::VARCHAR), 1, 4))::BIGINT % 10 < 9 THEN 'val' ELSE 'test' END AS split FROM b)
SELECT split, count(*) AS n, count(DISTINCT block) AS blocks FROM orders JOIN f ON o_custkey // 50 = block GROUP BY split""")
def block_split(t: Tables) -> DataFrame:
    return P.block_split(t.orders, "o_custkey", 50, "f", [("train", 7), ("val", 2), ("test", 1)]).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("block").alias("blocks"))


@query("""WITH e AS (SELECT DISTINCT o_custkey AS x FROM orders WHERE o_custkey % 101 = 0), r AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 101 <> 0)
SELECT o_orderkey, o_custkey FROM r WHERE NOT EXISTS (SELECT 1 FROM e WHERE abs(e.x - r.o_custkey) <= 7)""")
def buffer_exclusion(t: Tables) -> DataFrame:
    held = t.orders.filter("o_custkey % 101 = 0").select("o_custkey").distinct()
    return P.drop_buffered(t.orders.filter("o_custkey % 101 <> 0").select("o_orderkey", "o_custkey"), held, "o_custkey", 7)


@query("""WITH i AS (SELECT DISTINCT o_custkey FROM orders), n AS (SELECT greatest(1, round(count(*) * 0.05))::BIGINT AS k FROM i)
SELECT o_custkey FROM (SELECT o_custkey, row_number() OVER (ORDER BY sha256('salt' || o_custkey::VARCHAR), o_custkey) AS r FROM i), n WHERE r <= k""")
def hash_sample(t: Tables) -> DataFrame:
    return P.stability_sample(t.orders, "o_custkey", "salt", 0.05)


@query("SELECT o_orderpriority, coalesce(o_orderpriority, 'TOTAL') AS stratum, count(*) AS n, count(*) FILTER (o_totalprice > 100000) AS high, round(100.0 * count(*) / (SELECT count(*) FROM orders), 4)::DOUBLE AS pct FROM orders GROUP BY ROLLUP (o_orderpriority)")
def stratum_stats(t: Tables) -> DataFrame:
    r = t.orders.rollup("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_totalprice") > 100000).alias("high"))
    total = t.orders.agg(F.count(F.lit(1)).alias("_all"))  # one row
    return r.join(F.broadcast(total)).select("o_orderpriority", F.coalesce("o_orderpriority", F.lit("TOTAL")).alias("stratum"), "n", "high", F.round(F.lit(100.0) * F.col("n") / F.col("_all"), 4).alias("pct"))


@query("""SELECT shard, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS shard FROM orders WHERE o_orderkey % 3 <> 0) GROUP BY shard""")
def shard_plan(t: Tables) -> DataFrame:
    done = t.orders.filter("o_orderkey % 3 = 0").select("o_orderkey")
    return P.plan_shards(t.orders.select("o_orderkey"), done, "o_orderkey", 500).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query("SELECT p_partkey, ((row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1) % 8)::INT AS batch FROM part")
def batch_deal(t: Tables) -> DataFrame:
    return P.deal(t.part, [F.desc("p_retailprice"), F.col("p_partkey")], 8).select("p_partkey", "batch")
