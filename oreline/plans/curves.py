"""Queries of score accuracy: labelled documents scored by their length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import curves as C
from .base import Tables, query

_SCORED = """scored AS (
  SELECT d.lang, d.source, d.n_chars, least(254, d.n_chars // 130)::INT AS score, l.quality AS truth, l.toxic
  FROM documents d JOIN labels l USING (doc_id))"""
_HIST = _SCORED + """,
hist AS (
  SELECT lang, score AS bin, count(*) FILTER (truth = 1) AS pos, count(*) FILTER (truth <> 1) AS neg
  FROM scored WHERE score BETWEEN 0 AND 254 AND truth IS NOT NULL GROUP BY ALL)"""
_CUT = _HIST + """,
cuts AS (
  SELECT g.lang, k.k::INT AS k, coalesce(sum(h.pos) FILTER (h.bin >= k.k), 0)::BIGINT AS tp, coalesce(sum(h.neg) FILTER (h.bin >= k.k), 0)::BIGINT AS fp,
    sum(h.pos)::BIGINT AS p, sum(h.neg)::BIGINT AS n
  FROM (SELECT DISTINCT lang FROM hist) g, range(1, 255) k(k), hist h WHERE h.lang = g.lang GROUP BY 1, 2)"""
_CURVE = _CUT + """,
curve AS (
  SELECT lang, k, (k * 1000000 // 254) / 1e6 AS thresh, tp, fp, p - tp AS fn,
    round(tp::DOUBLE / nullif(tp + fp, 0), 6) AS precision, round(tp::DOUBLE / nullif(p, 0), 6) AS recall,
    round(2 * tp::DOUBLE / nullif(tp + fp + p, 0), 4) AS f1
  FROM cuts)"""


def scored(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id").select("lang", "source", "n_chars", F.expr("cast(least(254, n_chars div 130) as int)").alias("score"), F.col("quality").alias("truth"), "toxic")


def _hist(t: Tables) -> DataFrame:
    return C.score_histogram(scored(t), "score", "truth", ["lang"])


@query(f"WITH {_CURVE} SELECT lang, k, thresh, tp, fp, fn, precision, recall, f1 FROM curve")
def pr_curve(t: Tables) -> DataFrame:
    return C.pr_curve(_hist(t), ["lang"])


@query(f"WITH {_CURVE} SELECT lang, k, thresh, tp, fp, fn, precision, recall, f1 FROM curve WHERE f1 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lang ORDER BY f1 DESC, k) = 1")
def policy_best_f1(t: Tables) -> DataFrame:
    return C.best_f1(C.pr_curve(_hist(t), ["lang"]), ["lang"])


@query(f"WITH {_CURVE} SELECT lang, k, thresh, tp, fp, fn, precision, recall, f1 FROM curve WHERE precision >= 0.75 QUALIFY row_number() OVER (PARTITION BY lang ORDER BY recall DESC, k) = 1")
def policy_matched_p75(t: Tables) -> DataFrame:
    return C.recall_at_precision(C.pr_curve(_hist(t), ["lang"]), ["lang"], 0.75)


@query(f"""WITH {_CURVE}, ticks AS (SELECT *, round(f1 * 10000)::INT AS t, max(round(f1 * 10000)::INT) OVER (PARTITION BY lang) AS peak, count(*) OVER (PARTITION BY lang) AS n FROM curve)
SELECT lang, k, thresh, f1, recall, precision, CASE WHEN k <= 5 OR k >= 250 THEN 'EDGE' ELSE '' END AS edge_flag
FROM ticks WHERE n = 254 AND peak - t <= 50 QUALIFY row_number() OVER (PARTITION BY lang ORDER BY k DESC) = 1""")
def policy_plateau(t: Tables) -> DataFrame:
    return C.plateau_pick(C.pr_curve(_hist(t), ["lang"]), ["lang"])


@query(f"WITH {_CUT} SELECT lang, k, tp, fp, p - tp AS fn, n - fp AS tn FROM cuts")
def cut_counts(t: Tables) -> DataFrame:
    return C.cut_counts(_hist(t), ["lang"])


@query(f"""WITH {_HIST}, b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY lang ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM hist)
SELECT lang, sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg, round(sum(pos * (2 * below + neg))::DOUBLE / nullif(sum(pos) * sum(neg) * 2, 0)::DOUBLE, 6) AS auroc FROM b GROUP BY lang""")
def auroc_ties(t: Tables) -> DataFrame:
    return C.auroc(_hist(t), ["lang"])


@query(f"""WITH {_HIST}, c AS (SELECT lang, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY lang) AS p FROM hist WINDOW w AS (PARTITION BY lang ORDER BY bin DESC ROWS UNBOUNDED PRECEDING))
SELECT lang, round(sum((pos::DOUBLE / nullif(p, 0)::DOUBLE) * (tp::DOUBLE / nullif(tp + fp, 0)::DOUBLE)), 6) AS ap FROM c GROUP BY lang""")
def average_precision(t: Tables) -> DataFrame:
    return C.average_precision(_hist(t), ["lang"])


@query(f"""WITH {_HIST}, c AS (SELECT lang, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY lang) AS p FROM hist WINDOW w AS (PARTITION BY lang ORDER BY bin DESC ROWS UNBOUNDED PRECEDING)),
pts AS (SELECT DISTINCT lang, tp::DOUBLE / p::DOUBLE AS r, tp::DOUBLE / (tp + fp)::DOUBLE AS q FROM c WHERE p > 0 AND tp + fp > 0),
s AS (SELECT lang, (r - lag(r) OVER w) * (q + lag(q) OVER w) / 2 AS a FROM pts WINDOW w AS (PARTITION BY lang ORDER BY r, q DESC))
SELECT lang, round(coalesce(sum(a), 0.0), 6) AS pr_area FROM s GROUP BY lang""")
def pr_area(t: Tables) -> DataFrame:
    return C.pr_area(_hist(t), ["lang"])


_METRICS = """SELECT {by}, tp, fp, fn, tn, round(coalesce((tp + tn)::DOUBLE / nullif(tp + fp + fn + tn, 0), 0), 4) AS accuracy, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 4) AS precision,
  round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 4) AS recall, round(coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1,
  round(coalesce(tp::DOUBLE / nullif(tp + fp + fn, 0), 0), 4) AS iou, round(coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0), 4) AS dice
FROM (SELECT {by}, count(*) FILTER (call = 1 AND truth = 1) AS tp, count(*) FILTER (call = 1 AND truth = 0) AS fp, count(*) FILTER (call = 0 AND truth = 1) AS fn, count(*) FILTER (call = 0 AND truth = 0) AS tn FROM calls GROUP BY {by})"""


@query(f"WITH {_SCORED}, calls AS (SELECT source, CASE WHEN score >= 12 THEN 1 ELSE 0 END AS call, truth FROM scored) " + _METRICS.format(by="source"))
def confusion_by_source(t: Tables) -> DataFrame:
    return C.confusion_metrics(scored(t).withColumn("call", (F.col("score") >= 12).cast("int")), "call", "truth", ["source"])


@query(f"WITH {_SCORED}, calls AS (SELECT c.cut::INT AS cut, CASE WHEN score >= c.cut THEN 1 ELSE 0 END AS call, truth FROM scored, (VALUES (4), (8), (16), (32)) c(cut)) " + _METRICS.format(by="cut"))
def threshold_sweep(t: Tables) -> DataFrame:
    cuts = scored(t).withColumn("cut", F.explode(F.array(*(F.lit(x) for x in (4, 8, 16, 32)))))
    return C.confusion_metrics(cuts.withColumn("call", (F.col("score") >= F.col("cut")).cast("int")), "call", "truth", ["cut"])


@query(f"""WITH {_SCORED}, b AS (SELECT lang, truth, CASE WHEN n_chars >= 0 AND n_chars < 500 THEN 0 WHEN n_chars >= 500 AND n_chars < 2000 THEN 1 WHEN n_chars >= 2000 AND n_chars < 8000 THEN 2 END::INT AS band FROM scored)
SELECT lang, band, count(*) FILTER (truth = 1) AS calls, count(*) AS n, round(count(*) FILTER (truth = 1)::DOUBLE / count(*), 6) AS rate FROM b WHERE band IS NOT NULL GROUP BY ALL""")
def band_rates(t: Tables) -> DataFrame:
    return C.banded_rate(scored(t), "n_chars", "truth", [0, 500, 2000, 8000], ["lang"])


@query(f"WITH {_SCORED} SELECT truth, toxic, count(*) AS n, count(*) FILTER (score >= 12) AS calls, round(count(*) FILTER (score >= 12)::DOUBLE / count(*), 6) AS rate FROM scored GROUP BY truth, toxic")
def reference_agreement(t: Tables) -> DataFrame:
    return C.agreement_cells(scored(t).withColumn("call", (F.col("score") >= 12).cast("int")), "truth", "toxic", "call")


@query("""SELECT count(*) AS n_labelled, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic_rows, count(*) FILTER (quality = 1 AND toxic = 1) AS num, count(*) FILTER (toxic = 1) AS den FROM labels""")
def conditional_counters(t: Tables) -> DataFrame:
    return t.labels.agg(F.count(F.lit(1)).alias("n_labelled"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic_rows"), F.count_if((F.col("quality") == 1) & (F.col("toxic") == 1)).alias("num"), F.count_if(F.col("toxic") == 1).alias("den"))
