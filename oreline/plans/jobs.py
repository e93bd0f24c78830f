"""Queries of queue, lease, retirement and version state: orders as jobs and runs, line items as their events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import jobs as J
from .base import Tables, query

_EVENTS = "ev AS (SELECT l_orderkey AS job, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS seq, CASE WHEN l_partkey % 9 = 0 THEN 'done' WHEN l_partkey % 4 = 0 THEN 'fail' WHEN l_partkey % 4 = 1 THEN 'renew' ELSE 'claim' END AS kind, l_shipdate AS ts FROM lineitem)"


def _events(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    k = F.col("l_partkey")
    kind = F.when(k % 9 == 0, F.lit("done")).when(k % 4 == 0, F.lit("fail")).when(k % 4 == 1, F.lit("renew")).otherwise(F.lit("claim"))
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"))
    return t.lineitem.select(F.col("l_orderkey").alias("job"), seq.alias("seq"), kind.alias("kind"), F.col("l_shipdate").alias("ts"))


_STATES = f"""{_EVENTS}, a AS (SELECT job, count(*) FILTER (kind = 'claim') AS attempts, arg_max(kind, seq) AS k, arg_max(ts, seq) + INTERVAL 30 DAY AS until FROM ev GROUP BY job),
js AS (SELECT job, CASE WHEN k = 'done' THEN 'done' WHEN k = 'fail' AND attempts >= 2 THEN 'dead' WHEN k = 'fail' THEN 'queued' WHEN until <= TIMESTAMP '1998-01-01' AND attempts >= 2 THEN 'dead' WHEN until <= TIMESTAMP '1998-01-01' THEN 'stale' ELSE 'leased' END AS state, attempts, CASE WHEN k IN ('claim', 'renew') THEN until END AS until FROM a)"""


def _states(t: Tables) -> DataFrame:
    return J.job_states(_events(t), "job", "seq", "kind", "ts", 30 * 86_400, 2, F.lit("1998-01-01"))


@query(f"WITH {_STATES} SELECT job, state, attempts, strftime(until, '%Y-%m-%d') AS lease_day FROM js")
def job_states(t: Tables) -> DataFrame:
    return _states(t).select("job", "state", "attempts", F.date_format("lease_until", "yyyy-MM-dd").alias("lease_day"))


@query(f"WITH {_STATES} SELECT state, count(*) AS n, sum(attempts)::BIGINT AS attempts FROM js GROUP BY state")
def job_histogram(t: Tables) -> DataFrame:
    return _states(t).groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum("attempts").alias("attempts"))


@query(f"WITH {_STATES} SELECT job, strftime(until, '%Y-%m-%d') AS lease_day FROM js WHERE until <= TIMESTAMP '1998-01-01' AND state IN ('stale', 'dead')")
def stale_leases(t: Tables) -> DataFrame:
    return _states(t).filter("lease_until IS NOT NULL AND state IN ('stale', 'dead')").select("job", F.date_format("lease_until", "yyyy-MM-dd").alias("lease_day"))


_JOBS = "jb AS (SELECT o_orderkey AS job_id, CASE o_orderstatus WHEN 'F' THEN 'queued' WHEN 'O' THEN 'leased' ELSE 'done' END AS state, o_custkey % 2 = 0 AS expired, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE (o_totalprice % 40)::BIGINT END AS pages, o_orderdate AS enqueued_at, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS page_start, o_orderkey % 10 = 3 AS is_book, o_orderkey % 4 AS attempts FROM orders)"


@query(f"""WITH {_JOBS}, r AS (SELECT *, row_number() OVER (ORDER BY pages NULLS LAST, enqueued_at, page_start NULLS FIRST, job_id) AS k, CASE WHEN is_book THEN 'refused' WHEN attempts >= 3 THEN 'dead' ELSE 'claimed' END AS outcome FROM jb WHERE state = 'queued' OR (state = 'leased' AND expired)),
c AS (SELECT *, sum((outcome = 'claimed')::INT) OVER (ORDER BY k) AS taken FROM r) SELECT job_id, outcome FROM c WHERE taken < 25 OR (taken = 25 AND outcome = 'claimed')""")
def claim_walk(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    state = F.when(F.col("o_orderstatus") == "F", F.lit("queued")).when(F.col("o_orderstatus") == "O", F.lit("leased")).otherwise(F.lit("done"))
    jobs = t.orders.select(k.alias("job_id"), state.alias("state"), (F.col("o_custkey") % 2 == 0).alias("expired"), F.when(k % 6 != 0, F.round(F.col("o_totalprice") % 40).cast("long")).alias("pages"), F.col("o_orderdate").alias("enqueued_at"), F.when(k % 4 != 0, F.col("o_custkey")).alias("page_start"), (k % 10 == 3).alias("is_book"), (k % 4).alias("attempts"))
    return J.claim(jobs, 25, 3)


_RUNS = """rn AS (SELECT o_orderkey AS run_id, o_custkey AS file_id, o_orderkey % 2 AS stage, CASE WHEN o_orderkey % 7 = 0 THEN 'failed' ELSE 'ok' END AS status, o_orderdate AS created_at, 'v' || (o_orderkey % 3) AS key FROM orders),
cu AS (SELECT file_id, max(run_id) FILTER (run_id % 5 <> 0) AS current_run FROM rn GROUP BY file_id), wa AS (SELECT run_id FROM rn WHERE run_id % 5 = 1), ci AS (SELECT DISTINCT l_orderkey AS run_id, l_partkey AS evidence_id FROM lineitem WHERE l_quantity = 17), re AS (SELECT run_id FROM rn WHERE run_id % 13 = 0)"""


@query(f"""WITH {_RUNS}, c AS (SELECT run_id, count(*) AS n FROM ci GROUP BY 1), j AS (SELECT rn.*, cu.current_run, wa.run_id IS NOT NULL AS was, coalesce(c.n, 0) AS evidence_rows, re.run_id IS NOT NULL AS gone,
  CASE WHEN rn.status <> 'ok' THEN NULL WHEN wa.run_id IS NOT NULL THEN (SELECT x.run_id FROM rn x WHERE x.run_id = cu.current_run AND x.run_id <> rn.run_id AND x.stage = rn.stage AND x.status = 'ok')
  ELSE (SELECT arg_max(x.run_id, (x.created_at, x.run_id)) FROM rn x WHERE x.file_id = rn.file_id AND x.stage = rn.stage AND x.status = 'ok' AND x.created_at > rn.created_at AND x.key = 'v2' AND x.key <> rn.key) END AS superseded_by
  FROM rn LEFT JOIN cu USING (file_id) LEFT JOIN wa ON wa.run_id = rn.run_id LEFT JOIN c ON c.run_id = rn.run_id LEFT JOIN re ON re.run_id = rn.run_id)
SELECT run_id, evidence_rows, superseded_by, CASE WHEN current_run = run_id THEN 'current' WHEN evidence_rows > 0 THEN 'evidence' WHEN gone THEN 'already-retired' WHEN superseded_by IS NULL THEN 'not-superseded' END AS refusal FROM j""")
def run_retirement(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    runs = t.orders.select(k.alias("run_id"), F.col("o_custkey").alias("file_id"), (k % 2).alias("stage"), F.when(k % 7 == 0, F.lit("failed")).otherwise(F.lit("ok")).alias("status"), F.col("o_orderdate").alias("created_at"), F.concat(F.lit("v"), k % 3).alias("key"))
    current = runs.groupBy("file_id").agg(F.max(F.when(F.col("run_id") % 5 != 0, F.col("run_id"))).alias("current_run"))
    cited = t.lineitem.filter("l_quantity = 17").select(F.col("l_orderkey").alias("run_id"), F.col("l_partkey").alias("evidence_id"))
    keys = runs.select("stage").distinct().withColumn("key", F.lit("v2"))
    return J.retirement(runs, current, runs.filter("run_id % 5 = 1"), cited, runs.filter("run_id % 13 = 0"), keys)


_CAS = """pr AS (SELECT o_custkey AS id, o_orderkey AS seq, CASE WHEN o_orderkey % 4 = 3 THEN 'v0' WHEN o_orderkey % 4 = 2 THEN 'w' || coalesce(lag(o_orderkey, 2) OVER w, 0) ELSE coalesce('w' || lag(o_orderkey) OVER w, 'v0') END AS base, 'w' || o_orderkey AS version FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))"""


@query(f"""WITH RECURSIVE {_CAS}, a(id, seq, head, no) AS (SELECT DISTINCT id, -1::BIGINT, 'v0', 1::BIGINT FROM pr UNION ALL
  SELECT id, seq, version, no FROM (SELECT a.id, pr.seq, pr.version, a.no + 1 AS no, row_number() OVER (PARTITION BY a.id ORDER BY pr.seq) AS k FROM a JOIN pr ON pr.id = a.id AND pr.base = a.head AND pr.seq > a.seq) WHERE k = 1)
SELECT pr.id, pr.seq, CASE WHEN a.no IS NULL THEN 'conflict' ELSE 'accepted' END AS outcome, a.no AS version_no FROM pr LEFT JOIN a USING (id, seq)""")
def write_versions(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    w, k = Window.partitionBy("o_custkey").orderBy("o_orderkey"), F.col("o_orderkey")
    named = lambda n: F.concat(F.lit("w"), F.coalesce(F.lag("o_orderkey", n).over(w).cast("string"), F.lit("0")))
    base = F.when(k % 4 == 3, F.lit("v0")).when(k % 4 == 2, named(2)).otherwise(F.coalesce(F.concat(F.lit("w"), F.lag("o_orderkey").over(w)), F.lit("v0")))
    p = t.orders.select(F.col("o_custkey").alias("id"), k.alias("seq"), base.alias("base"), F.concat(F.lit("w"), k).alias("version"))
    heads = p.select("id").distinct().select("id", F.lit("v0").alias("head"), F.lit(1).cast("long").alias("version_no"))
    return J.write_versions(heads, p)


@query("""WITH i AS (SELECT c_custkey AS id, c_custkey * 10 AS pointer FROM customer), p AS (SELECT s_suppkey * 3 AS id, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey * 30 ELSE 1 END AS base, s_suppkey * 30 + 1 AS head FROM supplier)
SELECT i.id, CASE WHEN head IS NOT NULL AND base = pointer THEN head ELSE pointer END AS pointer, CASE WHEN head IS NULL THEN 'kept' WHEN base = pointer THEN 'moved' ELSE 'conflict' END AS outcome FROM i LEFT JOIN p USING (id)""")
def promote_commit(t: Tables) -> DataFrame:
    i = t.customer.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 10).alias("pointer"))
    s = F.col("s_suppkey")
    return J.commit(i, t.supplier.select((s * 3).alias("id"), F.when(s % 2 == 0, s * 30).otherwise(1).alias("base"), (s * 30 + 1).alias("head")))


@query("""WITH c AS (SELECT o_custkey AS id, o_orderkey AS version, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) - 1 AS depth, md5('ws2/' || o_orderkey) AS n FROM orders)
SELECT id, version, n AS copy, coalesce(lag(n) OVER w, (id * 10)::VARCHAR) AS based_on, row_number() OVER w::INT AS step FROM c WHERE id IN (SELECT c_custkey FROM customer) WINDOW w AS (PARTITION BY id ORDER BY depth DESC)""")
def promote_rebase(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    depth = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderkey"))) - 1
    c = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("version"), depth.alias("depth"))
    i = t.customer.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 10).alias("pointer"))
    return J.rebase(c, i, F.md5(F.concat(F.lit("ws2/"), F.col("version").cast("string"))))


@query("""SELECT c_custkey AS k, coalesce(n.v, o.v) AS v FROM (SELECT c_custkey, c_acctbal AS v FROM customer) o FULL JOIN (SELECT s_suppkey * 4 AS c_custkey, s_acctbal AS v FROM supplier) n USING (c_custkey)""")
def upserted_state(t: Tables) -> DataFrame:
    old = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return J.upsert(old, t.supplier.select((F.col("s_suppkey") * 4).alias("k"), F.col("s_acctbal").alias("v")), ["k"])


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey)::INT AS place FROM orders WHERE o_orderstatus = 'O' QUALIFY place <= 3")
def newest_requests(t: Tables) -> DataFrame:
    return J.newest(t.orders, "o_custkey", [F.desc("o_orderdate"), F.col("o_orderkey")], 3, F.col("o_orderstatus") == "O").select("o_custkey", "o_orderkey", "place")


_EVID = """e AS (SELECT l_orderkey AS request_id, l_partkey AS block_id, (l_partkey * 3 + l_suppkey) % 4 AS run_id, CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_quantity > 10 END AS verified, ['supports', 'refutes', 'mentions'][l_linenumber % 3 + 1] AS stance FROM lineitem),
b AS (SELECT p_partkey AS block_id, p_partkey % 40 AS file_id FROM part), f AS (SELECT range AS file_id, CASE WHEN range % 6 = 0 THEN NULL ELSE range % 4 END AS current_run FROM range(40)),
st AS (SELECT e.*, coalesce(run_id = current_run, false) AS run_is_current, coalesce(verified AND run_id = current_run, false) AS promotable FROM e JOIN b USING (block_id) JOIN f USING (file_id))"""


def _status(t: Tables) -> DataFrame:
    k, s = F.col("l_partkey"), F.col("l_suppkey")
    stance = F.element_at(F.lit(["supports", "refutes", "mentions"]), (F.col("l_linenumber") % 3 + 1).cast("int"))
    e = t.lineitem.select(F.col("l_orderkey").alias("request_id"), k.alias("block_id"), ((k * 3 + s) % 4).alias("run_id"), F.when(s % 5 != 0, F.col("l_quantity") > 10).alias("verified"), stance.alias("stance"))
    b = t.part.select(F.col("p_partkey").alias("block_id"), (F.col("p_partkey") % 40).alias("file_id"))
    f = t.part.sparkSession.range(40).select(F.col("id").alias("file_id"), F.when(F.col("id") % 6 != 0, F.col("id") % 4).alias("current_run"))
    return J.evidence_status(e, b, f)


@query(f"WITH {_EVID} SELECT stance, run_is_current, promotable, count(*) AS n FROM st GROUP BY ALL")
def evidence_status(t: Tables) -> DataFrame:
    return _status(t).groupBy("stance", "run_is_current", "promotable").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_EVID}, n AS (SELECT request_id, count(*) FILTER (stance = 'supports') AS c, count(*) FILTER (stance = 'refutes') AS x FROM st WHERE promotable GROUP BY 1)
SELECT o_orderkey AS request_id, coalesce(c, 0) AS n_confirming, coalesce(x, 0) AS n_contradicting, CASE WHEN x > 0 THEN 'contradicted' WHEN c > 0 THEN 'confirmed' WHEN o_orderkey % 3 <> 0 THEN 'unconfirmed' ELSE 'open' END AS resolution_state FROM orders LEFT JOIN n ON request_id = o_orderkey""")
def request_status(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return J.request_status(t.orders.select(k.alias("request_id"), F.when(k % 3 != 0, F.col("o_custkey")).alias("work_id")), _status(t))


@query("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) UNION SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def books_of_both_views(t: Tables) -> DataFrame:
    """A union of two views without repeats."""
    main = t.customer.join(t.nation.filter("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey")
    return main.union(t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")).distinct()


@query("SELECT o_orderkey, o_custkey, o_totalprice AS claimed, c_acctbal AS held FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice < c_acctbal * 2")
def discrepancy_report(t: Tables) -> DataFrame:
    """Claims that differ from the registry's values, joined to both."""
    j = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).filter("o_totalprice < c_acctbal * 2")
    return j.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("claimed"), F.col("c_acctbal").alias("held"))


_FENCE = "ev AS (SELECT user_id AS job, event_id AS seq, CASE WHEN event_id % 23 = 0 THEN 'reopen' ELSE CASE event_type WHEN 'view' THEN 'claim' WHEN 'click' THEN 'renew' WHEN 'error' THEN 'fail' WHEN 'purchase' THEN 'done' ELSE 'refuse' END END AS kind, CASE WHEN event_id % 19 > 0 THEN greatest(0, (SELECT count(*) FROM events c WHERE c.user_id = e.user_id AND c.event_id <= e.event_id AND c.event_type = 'view' AND c.event_id % 23 > 0) - (event_id % 3 = 0)::INT) END AS token FROM events e)"


@query(f"""WITH {_FENCE}, n AS (SELECT *, count(*) FILTER (kind = 'claim') OVER (PARTITION BY job ORDER BY seq) AS lease FROM ev), x AS (SELECT *, first_value(CASE WHEN kind IN ('fail', 'done', 'refuse') AND token = lease THEN kind END IGNORE NULLS) OVER (PARTITION BY job, lease ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM n)
SELECT job, seq, kind, token, lease, CASE WHEN kind = 'claim' THEN 'accepted' WHEN kind = 'reopen' THEN CASE WHEN ended IN ('fail', 'refuse') THEN 'accepted' ELSE 'not-dead' END WHEN lease = 0 THEN 'no-lease' WHEN token IS DISTINCT FROM lease THEN 'stale-token' WHEN ended IS NOT NULL THEN 'released' ELSE 'accepted' END AS outcome FROM x""")
def fenced_events(t: Tables) -> DataFrame:
    """Events of queue jobs, a third of which present the lease before; those of another lease, or after its end, count for nothing."""
    from pyspark.sql import Window

    k = F.col("event_id")
    kind = F.when(k % 23 == 0, "reopen").when(F.col("event_type") == "view", "claim").when(F.col("event_type") == "click", "renew").when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "purchase", "done").otherwise("refuse")
    e = t.events.select(F.col("user_id").alias("job"), k.alias("seq"), kind.alias("kind"))
    so_far = F.count_if(F.col("kind") == "claim").over(Window.partitionBy("job").orderBy("seq"))
    e = e.withColumn("token", F.when(F.col("seq") % 19 > 0, F.greatest(F.lit(0), so_far - (F.col("seq") % 3 == 0).cast("int"))))
    return J.fenced(e, "job", "seq", "kind", "token")
