"""Queries of state series: each user's days of January 2024 as epochs, purchases as cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sequence as S
from .base import Tables, query

_DAYS = """d AS (SELECT user_id, day(ts)::INT AS epoch, round(sum(value), 2) AS cover FROM events WHERE event_type IN ('purchase', 'view') GROUP BY 1, 2),
grid AS (SELECT u.user_id, e.epoch::INT AS epoch FROM (SELECT DISTINCT user_id FROM events) u, range(1, 31) e(epoch)),
st AS (SELECT g.user_id, g.epoch, d.cover, CASE WHEN d.cover IS NULL THEN '-' WHEN d.cover >= 60 THEN 'P' WHEN d.cover <= 30 THEN 'A' ELSE 'U' END AS s FROM grid g LEFT JOIN d USING (user_id, epoch))"""


def series(t: Tables) -> DataFrame:
    d = t.events.filter(F.col("event_type").isin("purchase", "view")).groupBy("user_id", F.dayofmonth("ts").alias("epoch")).agg(F.round(F.sum("value"), 2).alias("cover"))
    grid = t.events.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("epoch"))
    full = grid.join(d, ["user_id", "epoch"], "left")
    return full.withColumn("s", S.states(F.col("cover"), 60, 30))


@query(f"WITH {_DAYS} SELECT user_id, epoch, s FROM st")
def state_series(t: Tables) -> DataFrame:
    return series(t).select("user_id", "epoch", "s")


@query(f"""WITH {_DAYS}, c AS (SELECT *, CASE WHEN s = lag(s) OVER w THEN 0 ELSE 1 END AS c FROM st WINDOW w AS (PARTITION BY user_id ORDER BY epoch)), r AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY epoch) AS run FROM c)
SELECT user_id, s, count(*) AS n, min(epoch) AS first, max(epoch) AS last FROM r GROUP BY user_id, run, s""")
def state_runs(t: Tables) -> DataFrame:
    return S.runs(series(t), ["user_id"], ["epoch"], "s")


@query(f"""WITH {_DAYS}, a AS (SELECT user_id, count(*) FILTER (s <> '-') AS seen, max(epoch) FILTER (s = 'P') AS lp, min(epoch) FILTER (s = 'P') AS fp, bool_or(s = 'U') AS u,
  regexp_replace(regexp_replace(coalesce(string_agg(s, '' ORDER BY epoch) FILTER (s IN ('P', 'A')), ''), 'P+', 'P', 'g'), 'A+', 'A', 'g') AS k FROM st GROUP BY user_id),
b AS (SELECT a.*, (SELECT max(epoch) FROM st WHERE st.user_id = a.user_id AND s = 'A' AND epoch < a.lp) AS la FROM a),
c AS (SELECT b.*, (SELECT min(epoch) FROM st WHERE st.user_id = b.user_id AND s = 'P' AND (b.la IS NULL OR epoch > b.la)) AS st0 FROM b)
SELECT user_id, CASE WHEN seen < 3 THEN 'INSUFFICIENT' WHEN k = '' THEN 'ALL_UNSURE' WHEN fp IS NULL THEN 'ABSENT_ALL' WHEN k = 'P' THEN CASE WHEN u THEN 'PRESENT_WITH_GAPS' ELSE 'STABLE_PRESENT' END WHEN k = 'AP' THEN 'ESTABLISHED' WHEN k = 'PA' THEN 'LOST' ELSE 'FLICKERING' END AS class,
  CASE WHEN seen >= 3 AND fp IS NOT NULL THEN st0 END AS valid_from, CASE WHEN seen >= 3 AND fp IS NOT NULL THEN lp END AS valid_to, fp AS first_present, lp AS last_present FROM c""")
def validity_intervals(t: Tables) -> DataFrame:
    return S.validity_intervals(series(t), "user_id", "epoch", "s")


@query(f"WITH {_DAYS}, x AS (SELECT lag(s, 2) OVER w || lag(s) OVER w || s AS triple FROM st WINDOW w AS (PARTITION BY user_id ORDER BY epoch)) SELECT triple, count(*) AS n FROM x WHERE triple IS NOT NULL GROUP BY triple")
def state_triples(t: Tables) -> DataFrame:
    return S.triples(series(t), "user_id", "epoch", "s")


@query(f"WITH {_DAYS}, x AS (SELECT lag(s) OVER w AS from_state, s AS to_state FROM st WINDOW w AS (PARTITION BY user_id ORDER BY epoch)) SELECT from_state, to_state, count(*) AS n FROM x WHERE from_state IS NOT NULL GROUP BY ALL")
def transition_counts(t: Tables) -> DataFrame:
    return S.transitions(series(t), "user_id", "epoch", "s")


_BITS = _DAYS + ", b AS (SELECT user_id, epoch, (s = 'P')::INT AS v FROM st)"


def _bits(t: Tables) -> DataFrame:
    return series(t).select("user_id", "epoch", (F.col("s") == "P").cast("int").alias("v"))


@query(f"""WITH {_BITS}, c AS (SELECT *, max(CASE WHEN v = 1 THEN epoch END) OVER (PARTITION BY user_id ORDER BY epoch) AS l, min(CASE WHEN v = 1 THEN epoch END) OVER (PARTITION BY user_id ORDER BY epoch DESC) AS r FROM b)
SELECT user_id, epoch, v, CASE WHEN v = 0 AND r - l - 1 <= 2 THEN 1 ELSE v END AS closed FROM c""")
def closing(t: Tables) -> DataFrame:
    return S.close_gaps(_bits(t), ["user_id"], "epoch", "v", 2)


@query(f"""WITH {_BITS}, g AS (SELECT * FROM b WHERE (user_id + epoch) % 4 <> 0 AND epoch NOT IN (7, 8)), c AS (SELECT *, epoch - lag(epoch) OVER w AS lg, lead(epoch) OVER w - epoch AS rg, lag(v) OVER w AS lv, lead(v) OVER w AS rv FROM g WINDOW w AS (PARTITION BY user_id ORDER BY epoch)),
t AS (SELECT *, CASE WHEN lg IS NULL OR rg IS NULL THEN NULL WHEN greatest(lg, rg) >= 3 THEN 'BLIND' WHEN epoch + rg <= 20 THEN 'HEAL' ELSE 'REVIEW' END AS tier FROM c)
SELECT user_id, epoch, v, tier, CASE WHEN v = 0 AND lv = 1 AND rv = 1 THEN CASE WHEN tier = 'HEAL' THEN 1 ELSE 255 END ELSE v END AS healed FROM t""")
def gap_healing(t: Tables) -> DataFrame:
    return S.heal(_bits(t).filter("(user_id + epoch) % 4 <> 0 AND epoch NOT IN (7, 8)"), ["user_id"], "epoch", "v", 20)


@query(f"WITH {_DAYS} SELECT user_id, epoch, cover, round(avg(cover) OVER (PARTITION BY user_id ORDER BY epoch ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smooth FROM d")
def moving_average(t: Tables) -> DataFrame:
    return S.moving_average(series(t).filter("cover IS NOT NULL").select("user_id", "epoch", "cover"), ["user_id"], "epoch", "cover", 2)


@query(f"WITH {_DAYS}, x AS (SELECT user_id, cover - lag(cover) OVER (PARTITION BY user_id ORDER BY epoch) AS s FROM d) SELECT user_id, count(s) AS n_steps, round(sum(s * s) / nullif(2 * count(s), 0), 6) AS var FROM x GROUP BY user_id")
def successive_variance(t: Tables) -> DataFrame:
    return S.successive_variance(series(t).filter("cover IS NOT NULL"), ["user_id"], "epoch", "cover")


@query(f"WITH {_DAYS}, x AS (SELECT *, min((s = 'A')::INT) OVER (PARTITION BY user_id ORDER BY epoch DESC) AS o FROM st WHERE s <> '-') SELECT user_id, min(epoch) FILTER (o = 1) AS terminal_start FROM x GROUP BY user_id")
def terminal_absence(t: Tables) -> DataFrame:
    return S.terminal_absence(series(t).filter("s <> '-'"), "user_id", "epoch", "s")


_EMIT = "(VALUES ('A', 0.8::DOUBLE, 0.3::DOUBLE, 0.1::DOUBLE), ('U', 0.15, 0.4, 0.2), ('P', 0.05, 0.3, 0.7), ('-', 1.0, 1.0, 1.0)) m(s, e0, e1, e2)"
_MOVE = "[[0.8, 0.15, 0.05], [0.3, 0.4, 0.3], [0.05, 0.15, 0.8]]::DOUBLE[][]"


@query(f"""WITH RECURSIVE {_DAYS}, o AS (SELECT user_id, epoch, [e0, e1, e2] AS e FROM st JOIN {_EMIT} USING (s)), mv AS (SELECT {_MOVE} AS m),
f(user_id, epoch, a, v, back) AS (SELECT user_id, epoch, [0.4 * e[1], 0.2 * e[2], 0.4 * e[3]]::DOUBLE[], [ln(0.4) + ln(e[1]), ln(0.2) + ln(e[2]), ln(0.4) + ln(e[3])]::DOUBLE[], [1, 1, 1]::BIGINT[] FROM o WHERE epoch = 1 UNION ALL
  SELECT o.user_id, o.epoch, [(f.a[1] * m[1][j] + f.a[2] * m[2][j] + f.a[3] * m[3][j]) * o.e[j] / (f.a[1] + f.a[2] + f.a[3]) FOR j IN [1, 2, 3]], [greatest(f.v[1] + ln(m[1][j]), f.v[2] + ln(m[2][j]), f.v[3] + ln(m[3][j])) + ln(o.e[j]) FOR j IN [1, 2, 3]],
  [list_position([f.v[1] + ln(m[1][j]), f.v[2] + ln(m[2][j]), f.v[3] + ln(m[3][j])], greatest(f.v[1] + ln(m[1][j]), f.v[2] + ln(m[2][j]), f.v[3] + ln(m[3][j])))::BIGINT FOR j IN [1, 2, 3]] FROM f JOIN o ON o.user_id = f.user_id AND o.epoch = f.epoch + 1, mv),
b(user_id, epoch, b, path) AS (SELECT f.user_id, 30, [1.0, 1.0, 1.0]::DOUBLE[], list_position(v, list_max(v))::BIGINT FROM f WHERE epoch = 30 UNION ALL
  SELECT b.user_id, b.epoch - 1, [(m[i][1] * o.e[1] * b.b[1] + m[i][2] * o.e[2] * b.b[2] + m[i][3] * o.e[3] * b.b[3]) / (b.b[1] + b.b[2] + b.b[3]) FOR i IN [1, 2, 3]], f.back[b.path] FROM b JOIN o ON o.user_id = b.user_id AND o.epoch = b.epoch JOIN f ON f.user_id = b.user_id AND f.epoch = b.epoch, mv WHERE b.epoch > 1),
p AS (SELECT f.user_id, f.epoch, path - 1 AS path, [f.a[i] * b.b[i] FOR i IN [1, 2, 3]] AS q FROM f JOIN b USING (user_id, epoch))
SELECT user_id, epoch::INT AS epoch, path, round(q[1] / list_sum(q), 6) AS p0, round(q[2] / list_sum(q), 6) AS p1, round(q[3] / list_sum(q), 6) AS p2 FROM p""")
def hmm_smoothing(t: Tables) -> DataFrame:
    """Three hidden states (absent, turning, present) under the symbols of the series; unseen epochs say nothing."""
    emit = {"A": [0.8, 0.3, 0.1], "U": [0.15, 0.4, 0.2], "P": [0.05, 0.3, 0.7]}
    return S.hmm(series(t), "user_id", "epoch", "s", [0.4, 0.2, 0.4], [[0.8, 0.15, 0.05], [0.3, 0.4, 0.3], [0.05, 0.15, 0.8]], emit)
