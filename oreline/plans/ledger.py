"""Queries of ledgers: the events table as an append-only log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ledger as L
from .base import Tables, query

_EV = "ev AS (SELECT event_id, ts, user_id, event_type, round(value, 4) AS value, (props::JSON->>'k')::INT AS k FROM events)"
_COLS = ["user_id", "event_type", "ts", "value"]


def events(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts", "user_id", "event_type", F.round("value", 4).alias("value"), F.get_json_object("props", "$.k").cast("int").alias("k"))


@query(f"""WITH {_EV}, files AS (SELECT *, 'a' AS src FROM ev WHERE event_id % 3 <> 0 UNION ALL SELECT *, 'b' FROM ev WHERE event_id % 3 <> 1)
SELECT user_id, event_type, ts, value, array_to_string(list_sort(list(DISTINCT src)), '+') AS sources FROM files GROUP BY user_id, event_type, ts, value""")
def ledger_dedupe(t: Tables) -> DataFrame:
    ev = events(t)
    files = ev.filter("event_id % 3 <> 0").withColumn("src", F.lit("a")).unionByName(ev.filter("event_id % 3 <> 1").withColumn("src", F.lit("b")))
    return L.merge_rows(files, _COLS, "src").withColumn("sources", F.array_join("sources", "+"))


@query(f"WITH {_EV} SELECT user_id, event_type, ts, event_id, value FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_wins(t: Tables) -> DataFrame:
    return L.latest_struct(events(t), ["user_id", "event_type"], ["ts", "event_id"], ["value"])


@query(f"WITH {_EV} SELECT user_id, event_id, event_type, ts, lag(event_id) OVER w AS prev_event_id, lag(event_type) OVER w AS prev_event_type FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def prior_row(t: Tables) -> DataFrame:
    return L.prior_row(events(t).select("user_id", "event_id", "event_type", "ts"), ["user_id"], "event_id", ["event_id", "event_type"])


@query(f"""WITH {_EV}, d AS (SELECT *, CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'revoked' WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'purchase' THEN 'ok' END AS kind FROM ev),
l AS (SELECT * FROM d WHERE kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, ts, event_id FROM l WHERE kind = 'ok'""")
def completed_steps(t: Tables) -> DataFrame:
    err = F.col("event_type") == "error"
    return L.completed(events(t), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", err, err & (F.col("k") % 2 == 0))


@query(f"""WITH {_EV}, g AS (SELECT user_id, epoch(date_trunc('second', ts))::BIGINT - epoch(date_trunc('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts)))::BIGINT AS gap FROM ev)
SELECT user_id, count(*) AS n_gaps, median(gap)::DOUBLE AS cadence_s FROM g WHERE gap > 0 AND gap <= 86400 GROUP BY user_id""")
def sample_cadence(t: Tables) -> DataFrame:
    return L.cadence(events(t), ["user_id"], "ts", 86_400)


_SPANS = """spans AS (SELECT user_id, ts AS s, ts + INTERVAL 6 HOUR AS e, 'step' || (event_id % 4)::VARCHAR AS label FROM ev WHERE event_type = 'signup')"""


@query(f"""WITH {_EV}, {_SPANS}, h AS (SELECT p.event_id, count(DISTINCT label) AS n, min(label) AS label FROM ev p JOIN spans i ON p.user_id = i.user_id AND p.ts >= i.s AND p.ts < i.e GROUP BY 1)
SELECT p.event_id, CASE WHEN n IS NULL THEN 'between' WHEN n = 1 THEN label ELSE 'ambiguous' END AS step FROM ev p LEFT JOIN h USING (event_id)""")
def interval_attribution(t: Tables) -> DataFrame:
    ev = events(t)
    spans = ev.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("s"), (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("e"), F.concat(F.lit("step"), F.col("event_id") % 4).alias("label"))
    return L.attribute_interval(ev.select("event_id", "user_id", "ts"), spans, ["user_id"], "ts", "s", "e", "label", "event_id").select("event_id", "step")


@query(f"""WITH {_EV}, {_SPANS}, h AS (SELECT p.event_id, count(DISTINCT label) AS n, min(label) AS label FROM ev p JOIN spans i ON p.user_id = i.user_id AND p.ts >= i.s AND p.ts < i.e GROUP BY 1),
a AS (SELECT p.*, CASE WHEN n IS NULL THEN 'between' WHEN n = 1 THEN label ELSE 'ambiguous' END AS step FROM ev p LEFT JOIN h USING (event_id))
SELECT coalesce(step, 'ALL') AS step, count(*) AS samples, round(count(*) * 5 / 3600.0, 4) AS hours, round(avg(value), 4) AS mean_value, round(count(*) FILTER (value < 10)::DOUBLE / count(*), 6) AS idle_share
FROM a GROUP BY ROLLUP (step)""")
def idle_share(t: Tables) -> DataFrame:
    rows = interval_attribution(t).join(events(t), "event_id")
    out = rows.rollup("step").agg(F.count(F.lit(1)).alias("samples"), F.round(F.count(F.lit(1)) * 5 / 3600.0, 4).alias("hours"), F.round(F.avg("value"), 4).alias("mean_value"), F.round(F.count_if(F.col("value") < 10) / F.count(F.lit(1)), 6).alias("idle_share"))
    return out.withColumn("step", F.coalesce("step", F.lit("ALL")))


@query(f"""WITH {_EV}, e AS (SELECT p.event_id AS error_id, c.event_id, abs(epoch(date_trunc('second', p.ts))::BIGINT - epoch(date_trunc('second', c.ts))::BIGINT) AS gap_s, c.ts
  FROM ev p JOIN ev c ON p.user_id = c.user_id AND p.event_type = 'error' AND c.event_type = 'click')
SELECT error_id, event_id, gap_s FROM e WHERE gap_s <= 36000 QUALIFY row_number() OVER (PARTITION BY error_id ORDER BY gap_s, ts, event_id) = 1""")
def nearest_in_window(t: Tables) -> DataFrame:
    ev = events(t)
    errors = ev.filter("event_type = 'error'").select("user_id", F.col("event_id").alias("error_id"), F.col("ts").alias("error_ts"))
    clicks = ev.filter("event_type = 'click'").select("user_id", "event_id", "ts")
    return L.nearest_within(errors, clicks, ["user_id"], "error_ts", "ts", "error_id", "event_id", 36_000)


@query(f"""WITH {_EV} SELECT user_id, event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS until FROM ev""")
def attempt_bounds(t: Tables) -> DataFrame:
    return L.bounded_attempts(events(t).select("user_id", "event_id", "ts"), ["user_id"], "ts", "event_id")


@query(f"""WITH {_EV}, a AS (SELECT ts::DATE AS day, event_type, count(*) AS n FROM ev GROUP BY ALL)
SELECT day, event_type, n, round(100.0 * n / sum(n) OVER (PARTITION BY day), 4)::DOUBLE AS share FROM a""")
def apportioned_cost(t: Tables) -> DataFrame:
    daily = events(t).groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return L.apportion(daily.withColumn("total", F.lit(100.0)), "day", "n", "total").select("day", "event_type", "n", "share")


@query(f"""WITH {_EV}, s AS (SELECT user_id, ts::DATE AS day, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, min(ts) FILTER (event_type = 'click') AS first_click, max(ts) FILTER (event_type = 'purchase') AS last_purchase FROM ev GROUP BY ALL)
SELECT user_id, day, n, first_ts, last_ts, round(epoch(first_click - first_ts), 3) AS startup_s, round(epoch(last_ts - last_purchase), 3) AS idle_tail_s FROM s""")
def daily_sessions(t: Tables) -> DataFrame:
    ev = events(t)
    s = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min(F.when(F.col("event_type") == "click", F.col("ts"))).alias("c"), F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("p"))
    micro = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return s.select("user_id", "day", "n", "first_ts", "last_ts", F.round((micro("c") - micro("first_ts")) / 1e6, 3).alias("startup_s"), F.round((micro("last_ts") - micro("p")) / 1e6, 3).alias("idle_tail_s"))


@query(f"""WITH {_EV}, m AS (SELECT 'job ' || event_id || ' failed at 0x' || printf('%x', event_id) || ' in /data/run' || user_id || '/out.csv after ' || value::DECIMAL(18,4) || ' s' AS msg, ts FROM ev WHERE event_type = 'error'),
n AS (SELECT ts, substr(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(msg, '0x[0-9a-fA-F]+', '<hex>', 'g'), '\\b[0-9a-f]{{8,}}\\b', '<id>', 'g'), '(?:[A-Za-z]:)?(?:[\\\\/][\\w.\\-]+){{2,}}', '<path>', 'g'), '\\d+(?:\\.\\d+)?', '<n>', 'g'), '\\s+', ' ', 'g')), 1, 180) AS sig FROM m)
SELECT substr(sha256(sig), 1, 12) AS failure_id, sig, count(*) AS n, min(ts::DATE) AS first_day, max(ts::DATE) AS last_day FROM n GROUP BY sig""")
def failure_registry(t: Tables) -> DataFrame:
    e = events(t).filter("event_type = 'error'")
    msg = F.concat(F.lit("job "), "event_id", F.lit(" failed at 0x"), F.lower(F.hex("event_id")), F.lit(" in /data/run"), "user_id", F.lit("/out.csv after "), F.col("value").cast("decimal(18,4)"), F.lit(" s"))
    sig = e.select("ts", L.signature(msg).alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.min(F.to_date("ts")).alias("first_day"), F.max(F.to_date("ts")).alias("last_day"))
    return sig.select(F.substring(F.sha2("sig", 256), 1, 12).alias("failure_id"), "sig", "n", "first_day", "last_day")


@query(f"""WITH {_EV}, x AS (SELECT *, min((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) AS o FROM ev)
SELECT user_id, sum(o)::BIGINT AS streak, max(ts) AS last_ts, count(*) AS attempts, CASE WHEN sum(o) = 0 THEN 0 ELSE least(86400, 60 * pow(2, least(sum(o), 30) - 1)) END::BIGINT AS wait_s FROM x GROUP BY user_id""")
def backoff_replay(t: Tables) -> DataFrame:
    return L.replay_backoff(events(t), ["user_id"], "ts", "event_id", F.col("event_type") == "error", 60, 86_400)


@query(f"""WITH {_EV}, a AS (SELECT * FROM ev WHERE event_id % 5 <> 0), b AS (SELECT * FROM ev WHERE event_id % 4 <> 0)
SELECT event_id, ts, user_id, 'main' AS file FROM a UNION ALL SELECT event_id, ts, user_id, 'other' FROM b WHERE ts NOT IN (SELECT ts FROM a)""")
def merge_recordings(t: Tables) -> DataFrame:
    ev = events(t).select("event_id", "ts", "user_id")
    a, b = ev.filter("event_id % 5 <> 0"), ev.filter("event_id % 4 <> 0")
    return a.withColumn("file", F.lit("main")).unionByName(b.join(a.select("ts").distinct(), "ts", "left_anti").withColumn("file", F.lit("other")).select("event_id", "ts", "user_id", "file"))


@query(f"""WITH {_EV}, h AS (SELECT user_id, max(ts) AS ts FROM ev GROUP BY user_id), n AS (SELECT max(ts) AS now FROM ev)
SELECT user_id, ts AS last_ts, CASE WHEN epoch(now - ts) > 86400 THEN 'dead' WHEN epoch(now - ts) > 21600 THEN 'stale' ELSE 'alive' END AS state FROM h, n""")
def heartbeat_state(t: Tables) -> DataFrame:
    last = events(t).groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    now = events(t).agg(F.max("ts").alias("now"))  # one row
    micro = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    age = (micro("now") - micro("last_ts")) / 1e6
    return last.join(F.broadcast(now)).select("user_id", "last_ts", F.when(age > 86_400, F.lit("dead")).when(age > 21_600, F.lit("stale")).otherwise(F.lit("alive")).alias("state"))
