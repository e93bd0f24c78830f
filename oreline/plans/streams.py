"""Queries of windows and document parsers. The windowed relations are the batch form of the streaming operators: one definition serves both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import markup as M
from ..streaming import streams as S
from .base import Tables, query

_EV = "ev AS (SELECT *, ts AS t FROM events)"


@query(f"WITH {_EV} SELECT time_bucket(INTERVAL 1 HOUR, t) AS start, time_bucket(INTERVAL 1 HOUR, t) + INTERVAL 1 HOUR AS \"end\", event_type, count(*) AS n, round(sum(value), 4) AS total FROM ev GROUP BY ALL")
def tumbling_windows(t: Tables) -> DataFrame:
    return S.windowed(t.events, "ts", ["event_type"], "1 hour")


@query(f"WITH {_EV}, w AS (SELECT time_bucket(INTERVAL 1 HOUR, t) - k * INTERVAL 1 HOUR AS start, event_type, value FROM ev, range(3) r(k)) SELECT start, start + INTERVAL 3 HOUR AS \"end\", event_type, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY ALL")
def sliding_windows(t: Tables) -> DataFrame:
    return S.windowed(t.events, "ts", ["event_type"], "3 hours", "1 hour")


@query(f"WITH {_EV}, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS c FROM ev), s AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM g) SELECT min(t) AS start, max(t) + INTERVAL 2 HOUR AS \"end\", user_id, count(*) AS n FROM s GROUP BY user_id, k")
def gap_sessions(t: Tables) -> DataFrame:
    return S.sessions(t.events, "ts", ["user_id"], "2 hours")


@query()
def html_blocks(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.posexplode(M.html_blocks("html")).alias("pos", "b")).select("page_id", "pos", "b.kind", "b.level", "b.text")


@query()
def document_units(t: Tables) -> DataFrame:
    u = t.documents.select("doc_id", M.markdown_units("text").alias("u"), M.equation_density("text").alias("density"), M.repeated_tail("text").alias("tail"), F.size(M.sentences("text")).alias("n_sentences"))
    return u.select("doc_id", F.size("u").alias("n_units"), F.size(F.filter("u", lambda x: x["kind"] == "row")).alias("n_rows"), "density", "tail", "n_sentences")
