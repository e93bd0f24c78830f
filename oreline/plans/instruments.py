"""Queries of review labels, queue logs, liveness, caches, folds, polygons and image tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import caches as A
from ..operators import imagery as I
from ..operators import labels as L
from ..operators import logs as Q
from ..operators import polygons as O
from ..operators import sampling as P
from ..operators import stats as T
from ..operators.storage import dealt, written
from ..streaming import streams as S
from .base import Tables, query

_SILENT = 12 * 3600


@query(f"""WITH e AS (SELECT user_id, ts, lag(ts) OVER w AS p, lead(ts) OVER w AS n FROM (SELECT DISTINCT user_id, ts FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts)), m AS (SELECT max(ts) - INTERVAL 1 HOUR AS until FROM events)
SELECT user_id, 'up' AS action, ts AS at FROM e WHERE p IS NULL OR ts - p > {_SILENT} * INTERVAL 1 SECOND
UNION ALL SELECT user_id, 'silent', ts + {_SILENT} * INTERVAL 1 SECOND FROM e, m WHERE CASE WHEN n IS NULL THEN ts + {_SILENT} * INTERVAL 1 SECOND < until ELSE n - ts > {_SILENT} * INTERVAL 1 SECOND END""")
def liveness_actions(t: Tables) -> DataFrame:
    """The stream itself, run over the events that are there: timeouts of event time and not a batch join."""
    found = S.silences(t.stream("events"), "user_id", "ts", _SILENT, "1 hour")
    return S.settled(found, "liveness")


_LABELS = "CASE event_type WHEN 'view' THEN 'nochange' WHEN 'click' THEN 'gain' WHEN 'error' THEN 'loss' WHEN 'signup' THEN 'unsure' ELSE 'undo' END"


@query(f"""WITH e AS (SELECT user_id, event_id, {_LABELS} AS label FROM events), w AS (SELECT *, sum(CASE label WHEN 'undo' THEN -1 ELSE 1 END) OVER v AS s FROM e WINDOW v AS (PARTITION BY user_id ORDER BY event_id)),
d AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY user_id ORDER BY event_id)) AS d FROM w), z AS (SELECT user_id, arg_max(d, event_id) AS depth FROM d GROUP BY 1)
SELECT d.user_id, arg_max(label, event_id) AS label FROM d JOIN z ON z.user_id = d.user_id AND d.d = z.depth WHERE label <> 'undo' AND depth > 0 GROUP BY 1""")
def standing_labels(t: Tables) -> DataFrame:
    return L.standing(t.events.select("user_id", "event_id", F.expr(_LABELS).alias("label")), "user_id", "event_id", "label", restore=True)


_POINT = """point_id, CASE WHEN point_id % 10 = 7 THEN 'blur' WHEN point_id % 10 = 8 THEN 'dup' ELSE 'live' END AS kind, point_id - 3 AS dup_of, 2 + point_id % 3 AS stratum, point_id % 11 = 0 AS floor, 1 + point_id % 4 AS overlap"""
_GIVEN = "SELECT user_id * 40 + event_id % 40 AS point_id, event_id, CASE WHEN event_id % 9 = 0 THEN 'undo' ELSE CASE event_type WHEN 'view' THEN 'nochange' WHEN 'click' THEN 'gain' WHEN 'error' THEN 'loss' WHEN 'signup' THEN 'unsure' ELSE 'nochange' END END AS label FROM events"


@query(f"""WITH g AS ({_GIVEN}), f AS (SELECT point_id, arg_max(label, event_id) AS label FROM g GROUP BY 1), l AS (SELECT * FROM f WHERE label <> 'undo'),
v AS (SELECT o_orderkey AS point_id, CASE o_orderstatus WHEN 'F' THEN 'loss' ELSE 'nochange' END AS label FROM orders WHERE o_orderkey % 5 = 0),
k AS (SELECT point_id, coalesce(v.label, l.label) AS label, coalesce(v.label <> l.label, false) AS overturned FROM l FULL JOIN v USING (point_id)), pts AS (SELECT DISTINCT {_POINT} FROM g),
s AS (SELECT 1 + l_linenumber % 4 AS stratum, count(*) AS cells FROM lineitem GROUP BY 1), p AS (SELECT * FROM pts JOIN k USING (point_id)),
b AS (SELECT CASE WHEN floor THEN overlap ELSE stratum END AS stratum, avg(y) AS m, var_samp(y) AS v, count(*) AS n FROM (SELECT *, CASE label WHEN 'loss' THEN -1.0 WHEN 'gain' THEN 1.0 WHEN 'nochange' THEN 0.0 END AS y FROM p WHERE kind = 'live') WHERE y IS NOT NULL GROUP BY 1),
e AS (SELECT round(sum(cells::DOUBLE / total * m), 6) AS net, round(1.96 * sqrt(sum(CASE WHEN n > 1 THEN (cells::DOUBLE / total) ** 2 * v / n ELSE 0 END)), 6) AS half_width FROM b JOIN s USING (stratum), (SELECT sum(cells) AS total FROM s)),
c AS (SELECT count(*) FILTER (kind = 'live') AS n_live, count(*) FILTER (overturned) AS n_overturned, count(*) FILTER (kind = 'blur') AS n_blur, count(*) FILTER (kind = 'blur' AND label IN ('gain', 'loss')) AS blur_changed,
  count(*) FILTER (kind = 'live' AND floor AND overlap <> 1) AS n_outside, count(*) FILTER (kind = 'live' AND floor AND overlap <> 1 AND label IN ('gain', 'loss')) AS outside_changed, count(*) FILTER (label = 'unsure') AS n_unsure FROM p),
d AS (SELECT count(*) AS n_dup, count(*) FILTER (p.label <> k.label) AS dup_disagree FROM p JOIN k ON k.point_id = p.dup_of WHERE kind = 'dup' AND p.label <> 'unsure' AND k.label <> 'unsure')
SELECT * FROM e, c, d""")
def paired_change(t: Tables) -> DataFrame:
    t.events.createOrReplaceTempView("_review_events")
    given = t.events.sparkSession.sql(_GIVEN.replace("FROM events", "FROM _review_events"))
    verified = t.orders.filter("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("point_id"), F.when(F.col("o_orderstatus") == "F", "loss").otherwise("nochange").alias("label"))
    labels = L.overridden(L.standing(given, "point_id", "event_id", "label"), verified, "point_id", "label")
    strata = t.lineitem.groupBy((1 + F.col("l_linenumber") % 4).alias("stratum")).agg(F.count(F.lit(1)).alias("cells"))
    total = strata.agg(F.sum("cells")).first()[0]
    return L.paired_change(labels, given.select("point_id").distinct().selectExpr(*_POINT.split(", ")), strata, F.lit(total))


# The text of a queue's log, in words that Spark and DuckDB both read: each event is a line of its user's log.
_JOBNAME = "'job_' || event_id % 7 || '_20' || (10 + event_id % 9)"
_LINES = f"""SELECT user_id, event_id, CASE event_id % 16 WHEN 0 THEN '  queue  : q' || user_id % 3 || '.json' WHEN 1 THEN '  JOB ' || {_JOBNAME} || '  (year 20' || (10 + event_id % 9) || ', tag t' || event_id % 4 || ')'
WHEN 2 THEN '  $ python -u engine.py --year 20' || (10 + event_id % 9) || ' --step train --run-tag=t' || event_id % 4 WHEN 3 THEN '  $ python -u engine.py --step tile' WHEN 4 THEN '  $ ls' WHEN 5 THEN '    |  ✓ log → /content/logs/step_' || event_id || '.log'
WHEN 6 THEN '    |  run_id: 20240101T000000Z_' || event_id WHEN 7 THEN '  [' || {_JOBNAME} || '/train] exit=0  elapsed ' || event_id % 90 || '.5 min' WHEN 8 THEN '  [' || {_JOBNAME} || '/tile] exit=' || event_id % 3 || '  elapsed 3.0 min'
WHEN 9 THEN '  ! TIMEOUT: ' || {_JOBNAME} || '/train exceeded 90 min' WHEN 10 THEN '  ! ' || {_JOBNAME} || '/tile got a stray interrupt after 7.5 min' WHEN 11 THEN '  - skip ' || {_JOBNAME} || '/tile (already OK)' WHEN 12 THEN '  - ' || {_JOBNAME} || '/tile was left UNVERIFIED by the last run'
WHEN 13 THEN '  VERIFY' || CASE WHEN event_id % 2 = 0 THEN '' ELSE ':tile' END || ' ' || {_JOBNAME} || ': VERIFIED  ' || event_id || ' files,  all there' WHEN 14 THEN '  VERIFY ' || {_JOBNAME} || ': UNREADABLE — COULD NOT CHECK THIS ARTIFACT, continuing UNPROVEN.  no header'
ELSE CASE WHEN event_id % 3 = 0 THEN '  VERIFY ' || {_JOBNAME} || ': looks fine' ELSE 'epoch ' || event_id || ' loss 0.1' END END AS line FROM events"""
_SQ = {name: pattern.replace("'", "''") for name, pattern in Q.KINDS}
_LOG_STATE = f"""l AS ({_LINES}), m AS (SELECT user_id AS log, event_id AS n, line, CASE {' '.join(f"WHEN regexp_matches(line, '{p}') THEN '{k}'" for k, p in _SQ.items())} END AS k FROM l),
x AS (SELECT *, CASE WHEN k = 'queue' THEN regexp_extract(line, '{_SQ['queue']}', 1) END AS q, CASE WHEN k = 'job' THEN line END AS j, CASE WHEN k IN ('job', 'command') THEN n END AS b, CASE WHEN k = 'command' THEN regexp_extract(line, '{_SQ['command']}', 1) WHEN k = 'job' THEN '' END AS c FROM m WHERE k IS NOT NULL),
s AS (SELECT log, n, line, k, coalesce(last_value(q IGNORE NULLS) OVER w, '') AS queue, coalesce(last_value(j IGNORE NULLS) OVER w, '') AS header, last_value(b IGNORE NULLS) OVER w AS b, coalesce(last_value(c IGNORE NULLS) OVER w, '') AS c FROM x WINDOW w AS (PARTITION BY log ORDER BY n ROWS UNBOUNDED PRECEDING)),
blocks AS (SELECT log, b, any_value(c) AS c, bool_or(k IN ('exit', 'timeout', 'interrupt')) AS ended, coalesce(arg_min(regexp_extract(line, '{_SQ['run_id']}', 1), n) FILTER (k = 'run_id'), '') AS run_id, count(*) FILTER (k = 'step_log') AS n_step_logs FROM s WHERE c <> '' GROUP BY ALL),
r AS (SELECT *, regexp_extract(line, '{_SQ['verify']}', 3) AS rest FROM s),
v AS (SELECT *, k IN ('exit', 'timeout', 'interrupt') AS o, trim(CASE WHEN contains(rest, '{Q.UNPROVEN}') THEN split_part(rest, '{Q.UNPROVEN}', 1) ELSE split_part(rest, '  ', 1) END) AS head, trim(CASE WHEN contains(rest, '{Q.UNPROVEN}') THEN split_part(rest, '{Q.UNPROVEN}', 2) WHEN contains(rest, '  ') THEN substr(rest, strpos(rest, '  ') + 2) ELSE '' END) AS tail FROM r)"""
_ANY = " ".join(f"WHEN '{k}' THEN regexp_extract(line, '{_SQ[k]}', {{{k}}})" for k in ("exit", "timeout", "interrupt", "verify"))


@query(f"""WITH {_LOG_STATE}
SELECT v.log, n AS line, CASE WHEN o THEN 'step' ELSE 'verify' END AS kind, queue, CASE k {_ANY.format(exit=1, timeout=1, interrupt=1, verify=2)} END AS job, CASE WHEN o THEN regexp_extract(v.c, '--year[= ](\\S+)', 1) ELSE regexp_extract(header, '{_SQ['job']}', 2) END AS year,
CASE WHEN o THEN regexp_extract(v.c, '--run-tag[= ](\\S+)', 1) ELSE regexp_extract(header, '{_SQ['job']}', 3) END AS tag, CASE k WHEN 'verify' THEN 'VERIFY' || CASE WHEN regexp_extract(line, '{_SQ['verify']}', 1) <> '' THEN ':' || regexp_extract(line, '{_SQ['verify']}', 1) ELSE '' END ELSE CASE k {_ANY.format(exit=2, timeout=2, interrupt=2, verify=2)} END END AS step,
CASE k WHEN 'exit' THEN CASE WHEN regexp_extract(line, '{_SQ['exit']}', 3) = '0' THEN 'OK' ELSE 'FAIL' END WHEN 'timeout' THEN 'TIMEOUT' WHEN 'interrupt' THEN 'INTERRUPTED' ELSE head END AS state, CASE k WHEN 'exit' THEN regexp_extract(line, '{_SQ['exit']}', 3) WHEN 'timeout' THEN 'killed' WHEN 'interrupt' THEN 'sigint' ELSE '' END AS exit,
CASE k WHEN 'exit' THEN regexp_extract(line, '{_SQ['exit']}', 4) WHEN 'interrupt' THEN regexp_extract(line, '{_SQ['interrupt']}', 3) ELSE '' END AS minutes, CASE WHEN k = 'verify' THEN tail ELSE '' END AS verdict, x.b AS block_line, coalesce(run_id, '') AS run_id, coalesce(n_step_logs, 0) AS n_step_logs, regexp_extract(header, '{_SQ['job']}', 1) AS header_job
FROM v LEFT JOIN blocks x ON x.log = v.log AND x.b = v.b AND v.c <> '' WHERE (o AND v.c <> '') OR (k = 'verify' AND regexp_matches(head, '{Q.STATE}'))""")
def queue_log_events(t: Tables) -> DataFrame:
    return Q.queue_log(_log_lines(t), "user_id", "event_id", "line", chunk=500)[0].withColumn("n_step_logs", F.col("n_step_logs").cast("long"))


@query(f"""WITH {_LOG_STATE}, notes AS (SELECT log, n AS line, CASE WHEN k = 'skip' THEN 'resume_skip' WHEN k = 'reverify' THEN 'reverify_of_skipped_step' WHEN o AND c = '' THEN 'outcome_without_block' WHEN k = 'verify' AND NOT regexp_matches(head, '{Q.STATE}') THEN 'verify_unparseable' END AS kind,
CASE k WHEN 'skip' THEN regexp_extract(line, '{_SQ['skip']}', 1) || '/' || regexp_extract(line, '{_SQ['skip']}', 2) WHEN 'reverify' THEN regexp_extract(line, '{_SQ['reverify']}', 1) || '/' || regexp_extract(line, '{_SQ['reverify']}', 2) ELSE trim(line) END AS detail FROM v)
SELECT * FROM notes WHERE kind IS NOT NULL UNION ALL SELECT log, b, 'block_without_outcome', c FROM blocks WHERE NOT ended""")
def queue_log_notes(t: Tables) -> DataFrame:
    return Q.queue_log(_log_lines(t), "user_id", "event_id", "line", chunk=500)[1]


def _log_lines(t: Tables) -> DataFrame:
    t.events.createOrReplaceTempView("_log_events")
    return written(t.events.sparkSession.sql(_LINES.replace("FROM events", "FROM _log_events")), "log-text")


@query("""WITH e AS (SELECT o_orderkey::VARCHAR AS key, greatest(0, round(o_totalprice - 1000)::BIGINT) AS bytes, epoch(o_orderdate) AS last_use, o_custkey::DOUBLE AS ts_ready FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 13 <> 0 AND o_orderkey <> 4),
n AS (SELECT sum(round(o_totalprice))::BIGINT // 5 AS need FROM orders), x AS (SELECT *, coalesce(sum(bytes) OVER (ORDER BY last_use, ts_ready, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS freed_before FROM e),
g AS (SELECT CASE WHEN 5000 + r >= 20000 + floor(need * 1.15) THEN 20000 + floor(need * 1.15) WHEN 5000 + r >= greatest(20000, need) THEN greatest(20000, need) WHEN 5000 + r >= need THEN need END AS target FROM n, (SELECT sum(bytes) AS r FROM e))
SELECT key, bytes, freed_before FROM x, g WHERE 5000 + freed_before < target""")
def cache_eviction(t: Tables) -> DataFrame:
    entries = t.orders.select(
        F.col("o_orderkey").cast("string").alias("key"), (F.col("o_orderstatus") != "P").alias("ready"), (F.col("o_orderkey") % 13 == 0).alias("pinned"), F.round(F.col("o_totalprice") - 1000).cast("long").alias("bytes"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double").alias("last_use"), F.col("o_custkey").cast("double").alias("ts_ready"),
    )
    need = int(t.orders.agg(F.sum(F.round("o_totalprice"))).first()[0]) // 5
    return A.evicted(entries, 5000, 20000, need, keep_key="4").select("key", "bytes", "freed_before")


@query("""WITH p AS (SELECT o_custkey % 10 AS site, o_orderkey AS k, o_orderkey * 37 % 4000 AS x, round(o_totalprice)::BIGINT * 13 % 4000 AS y FROM orders), f AS (SELECT *, (row_number() OVER (PARTITION BY site ORDER BY sha256('fold' || k::VARCHAR), k) - 1) % 5 AS own FROM p)
SELECT r.fold::INT AS fold, k, CASE WHEN own = r.fold THEN 'val' ELSE 'train' END AS part FROM f, range(5) r(fold)
WHERE own = r.fold OR NOT EXISTS (SELECT 1 FROM f v WHERE v.site = f.site AND v.own = r.fold AND abs(v.x - f.x) < 64 AND abs(v.y - f.y) < 64)""")
def buffered_folds(t: Tables) -> DataFrame:
    p = t.orders.select((F.col("o_custkey") % 10).alias("site"), F.col("o_orderkey").alias("k"), (F.col("o_orderkey") * 37 % 4000).alias("x"), (F.round("o_totalprice").cast("long") * 13 % 4000).alias("y"))
    return P.buffered_folds(p, "site", "k", "x", "y", 5, 64, "fold")


@query()
def latent_class_intervals(t: Tables) -> DataFrame:
    """Four parts in ten are of one class; three sources tell it, each wrong for its own reasons."""
    truth = F.col("l_partkey") % 10 < 4
    told = lambda wrong: (truth != wrong).cast("int")
    sources = {"by_supplier": told(F.col("l_suppkey") % 5 == 0), "by_order": told(F.col("l_orderkey") % 7 == 0), "by_quantity": told(F.col("l_quantity") % 6 == 0)}
    d = t.lineitem.select((F.col("l_orderkey") % 40).cast("int").alias("block"), *(c.alias(n) for n, c in sources.items()))
    counts = d.groupBy("block", *sources).agg(F.count(F.lit(1)).alias("n"))
    blocks = t.lineitem.sparkSession.range(40).select(F.col("id").cast("int").alias("block")).join(counts, "block", "left").fillna(0)
    return T.latent_class_bootstrap(blocks, "block", 40, [*sources], "n", 100)


def crowns(t: Tables) -> DataFrame:
    """Line items as octagons, each third with a square hole, on the sheet of their part."""
    x, y, r = F.col("l_partkey") * 7 % 400 / 10.0, F.col("l_suppkey") * 11 % 300 / 10.0, 0.5 + F.col("l_quantity") / 25
    point = lambda a, b: F.array(x + r * a, y + r * b)
    ring = F.array(*(point(a, b) for a, b in ((1.0, 0.4), (0.4, 1.0), (-0.4, 1.0), (-1.0, 0.4), (-1.0, -0.4), (-0.4, -1.0), (0.4, -1.0), (1.0, -0.4))))
    hole = F.array(*(point(a, b) for a, b in ((0.3, 0.3), (-0.3, 0.3), (-0.3, -0.3), (0.3, -0.3))))
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    once = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey", "l_quantity")).alias("s")).select("l_orderkey", "l_linenumber", "s.*")
    return once.select((F.col("l_orderkey") % 50).alias("sheet"), key.alias("crown"), F.when(F.col("l_linenumber") % 3 == 0, F.array(ring, hole)).otherwise(F.array(ring)).alias("rings"))


@query()
def crown_matches(t: Tables) -> DataFrame:
    """Odd crowns matched in order to even ones of their sheet."""
    c = crowns(t)
    side = lambda odd, name: c.filter(F.col("crown") % 2 == odd).withColumnRenamed("crown", name)
    return O.ordered_overlaps(side(1, "found"), side(0, "truth"), "sheet", "found", "truth", "rings", 0.3).withColumn("iou", F.round("iou", 6))


_TILE = 48


def _suppliers(t: Tables) -> DataFrame:
    """The keys, dealt out before tiles are drawn: the file of keys is one task, its tiles are work for many."""
    return dealt(t.supplier.select("s_suppkey"), "s_suppkey", 500)


def _tile(t: Tables, value) -> DataFrame:
    """A tile a supplier: ``value(x, y)`` of each pixel, row by row."""
    at = F.sequence(F.lit(0), F.lit(_TILE * _TILE - 1))
    return F.transform(at, lambda i: value((i % _TILE).cast("int"), F.floor(i / _TILE).cast("int")).cast("double"))


@query(f"SELECT s_suppkey, (s_suppkey % 5 - 2)::INT AS dx, (s_suppkey % 7 - 3)::INT AS dy FROM supplier")
def planted_shifts(t: Tables) -> DataFrame:
    """A tile of hashed values against itself moved around: the move is found again."""
    k = F.col("s_suppkey")
    noise = lambda x, y: F.pmod(F.xxhash64(k, F.pmod(x, F.lit(_TILE)).cast("int"), F.pmod(y, F.lit(_TILE)).cast("int")), F.lit(256))
    tiles = _suppliers(t).select("s_suppkey", _tile(t, lambda x, y: noise(x - (k % 5 - 2), y - (k % 7 - 3))).alias("a"), _tile(t, noise).alias("b"))
    return I.shifts(tiles, "s_suppkey", "a", "b").select("s_suppkey", F.round("dx").cast("int").alias("dx"), F.round("dy").cast("int").alias("dy"))


@query("SELECT s_suppkey, 5 + s_suppkey % 4 * 3 AS tenths, true AS recovered FROM supplier")
def planted_edges(t: Tables) -> DataFrame:
    """A slanted logistic edge of a scale of 0.5 to 1.4 pixels: from a tenth to nine tenths are 2 ln 9 scales, found to a pixel."""
    k = F.col("s_suppkey")
    scale = (5 + k % 4 * 3) / 10.0
    angle = k % 8 * 0.2
    away = lambda x, y: (x - _TILE / 2) * F.cos(angle) + (y - _TILE / 2) * F.sin(angle)
    tiles = _suppliers(t).select("s_suppkey", _tile(t, lambda x, y: 50 + 100 / (1 + F.exp(-away(x, y) / scale))).alias("a"))
    found = I.edge_spreads(tiles, "s_suppkey", "a").join(t.supplier.select("s_suppkey", (5 + k % 4 * 3).alias("tenths")), "s_suppkey")
    return found.select("s_suppkey", "tenths", (F.abs(F.col("rise") - 4.394449 * F.col("tenths") / 10) < 1.0).alias("recovered"))
