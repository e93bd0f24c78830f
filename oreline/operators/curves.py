"""Accuracy of scores from 0 to 254 against a 0/1 truth, exact from histograms.

A histogram has 255 rows a group however many rows were scored, so every curve costs one partial aggregation of the data
and windows over bounded groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTS = 254


def score_histogram(scored: DataFrame, score: str, truth: str, by: list[str]) -> DataFrame:
    """(by..., bin, pos, neg). Rows whose score or truth is null, or whose score is 255 (no data), take no part."""
    live = scored.filter(F.col(score).isNotNull() & F.col(truth).isNotNull() & F.col(score).between(0, CUTS))
    return live.groupBy(*by, F.col(score).cast("int").alias("bin")).agg(F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) != 1).alias("neg"))


def ratio(a: Column | str, b: Column | str, digits: int = 6) -> Column:
    """a / b, null where b is 0."""
    col = lambda x: F.col(x) if isinstance(x, str) else x
    return F.round(F.try_divide(col(a).cast("double"), col(b).cast("double")), digits)


def cut_counts(hist: DataFrame, by: list[str], cuts: int = CUTS) -> DataFrame:
    """(by..., k, tp, fp, fn, tn) for k = 1..cuts, where a score of k or more is a call."""
    bins = hist.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(0), F.lit(cuts))).alias("bin"))
    full = bins.join(hist, [*by, "bin"], "left").fillna(0, ["pos", "neg"])
    up = Window.partitionBy(*by).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    out = full.select(*by, F.col("bin").alias("k"), F.sum("pos").over(up).alias("tp"), F.sum("neg").over(up).alias("fp"), F.sum("pos").over(whole).alias("p"), F.sum("neg").over(whole).alias("n"))
    return out.filter("k >= 1").select(*by, "k", "tp", "fp", (F.col("p") - F.col("tp")).alias("fn"), (F.col("n") - F.col("fp")).alias("tn"))


def pr_curve(hist: DataFrame, by: list[str], cuts: int = CUTS) -> DataFrame:
    """Precision, recall and F1 at each cut; blank (null) where a denominator is 0. thresh = k / cuts cut to six digits."""
    c = cut_counts(hist, by, cuts)
    return c.select(
        *by, "k", F.expr(f"(k * 1000000 div {cuts}) / 1e6").alias("thresh"), "tp", "fp", "fn",
        ratio("tp", F.col("tp") + F.col("fp")).alias("precision"), ratio("tp", F.col("tp") + F.col("fn")).alias("recall"),
        ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn"), 4).alias("f1"),
    )


def best_f1(curve: DataFrame, by: list[str]) -> DataFrame:
    """The cut of the highest F1 of each group; the lowest of equal ones."""
    w = Window.partitionBy(*by).orderBy(F.desc("f1"), "k")
    return curve.filter("f1 IS NOT NULL").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def recall_at_precision(curve: DataFrame, by: list[str], floor: float) -> DataFrame:
    """The cut of the highest recall whose precision reaches ``floor``; the lowest of equal ones."""
    w = Window.partitionBy(*by).orderBy(F.desc("recall"), "k")
    return curve.filter(F.col("precision") >= floor).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def plateau_pick(curve: DataFrame, by: list[str], ticks: int = 50, edge: int = 5, cuts: int = CUTS) -> DataFrame:
    """The highest cut whose F1 lies within ``ticks`` ten-thousandths of the peak, compared in whole ticks; groups that lack a cut are refused.

    edge_flag is EDGE within ``edge`` cuts of either end."""
    whole = Window.partitionBy(*by)
    t = curve.withColumn("_t", F.round(F.col("f1") * 10000).cast("int")).withColumn("_peak", F.max("_t").over(whole)).withColumn("_cuts", F.count(F.lit(1)).over(whole))
    near = t.filter((F.col("_cuts") == cuts) & (F.col("_peak") - F.col("_t") <= ticks))
    best = near.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("k")))).filter("_n = 1")
    flag = F.when((F.col("k") <= edge) | (F.col("k") >= cuts + 1 - edge), F.lit("EDGE")).otherwise(F.lit(""))
    return best.select(*by, "k", "thresh", "f1", "recall", "precision", flag.alias("edge_flag"))


def auroc(hist: DataFrame, by: list[str]) -> DataFrame:
    """Area under the ROC curve with tied scores counted half: pairs won by positives over all pairs. Null without both kinds."""
    below = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    won = hist.withColumn("_b", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    agg = won.groupBy(*by).agg(F.sum(F.col("pos") * (2 * F.col("_b") + F.col("neg"))).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(*by, F.col("p").alias("n_pos"), F.col("n").alias("n_neg"), ratio("w", F.col("p") * F.col("n") * 2).alias("auroc"))


def average_precision(hist: DataFrame, by: list[str]) -> DataFrame:
    """Step-wise average precision: the sum over cuts of precision times the recall gained."""
    up = Window.partitionBy(*by).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    c = hist.withColumns({"_tp": F.sum("pos").over(up), "_fp": F.sum("neg").over(up), "_p": F.sum("pos").over(Window.partitionBy(*by))})
    return c.groupBy(*by).agg(F.round(F.sum(F.try_divide(F.col("pos").cast("double"), F.col("_p").cast("double")) * F.try_divide(F.col("_tp").cast("double"), (F.col("_tp") + F.col("_fp")).cast("double"))), 6).alias("ap"))


def pr_area(hist: DataFrame, by: list[str]) -> DataFrame:
    """Trapezoid area under the distinct (recall, precision) points."""
    up = Window.partitionBy(*by).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    c = hist.withColumns({"_tp": F.sum("pos").over(up), "_fp": F.sum("neg").over(up), "_p": F.sum("pos").over(Window.partitionBy(*by))})
    pts = c.select(*by, (F.col("_tp") / F.col("_p")).alias("r"), F.try_divide(F.col("_tp").cast("double"), (F.col("_tp") + F.col("_fp")).cast("double")).alias("q")).filter("r IS NOT NULL AND q IS NOT NULL").distinct()
    w = Window.partitionBy(*by).orderBy("r", F.desc("q"))
    steps = pts.select(*by, ((F.col("r") - F.lag("r").over(w)) * (F.col("q") + F.lag("q").over(w)) / 2).alias("a"))
    return steps.groupBy(*by).agg(F.round(F.coalesce(F.sum("a"), F.lit(0.0)), 6).alias("pr_area"))


def confusion_metrics(called: DataFrame, call: str, truth: str, by: list[str]) -> DataFrame:
    """Counts and accuracy, precision, recall, F1, IoU and Dice at four digits; a zero denominator gives 0."""
    c = called.filter(F.col(call).isNotNull() & F.col(truth).isNotNull()).groupBy(*by).agg(
        F.count_if((F.col(call) == 1) & (F.col(truth) == 1)).alias("tp"), F.count_if((F.col(call) == 1) & (F.col(truth) == 0)).alias("fp"),
        F.count_if((F.col(call) == 0) & (F.col(truth) == 1)).alias("fn"), F.count_if((F.col(call) == 0) & (F.col(truth) == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    r = lambda a, b: F.coalesce(ratio(a, b, 4), F.lit(0.0))
    return c.select(*by, "tp", "fp", "fn", "tn", r(tp + tn, tp + fp + fn + tn).alias("accuracy"), r(tp, tp + fp).alias("precision"), r(tp, tp + fn).alias("recall"), r(tp * 2, tp * 2 + fp + fn).alias("f1"), r(tp, tp + fp + fn).alias("iou"), r(tp * 2, tp * 2 + fp + fn).alias("dice"))


def banded_rate(rows: DataFrame, value: str, call: str, edges: list[float], by: list[str]) -> DataFrame:
    """Calls, rows and rate in each band [edges[i], edges[i + 1])."""
    band = _case(value, edges)
    return rows.withColumn("band", band.cast("int")).filter("band IS NOT NULL").groupBy(*by, "band").agg(F.count_if(F.col(call) == 1).alias("calls"), F.count(F.lit(1)).alias("n")).withColumn("rate", ratio("calls", "n"))


def _case(value: str, edges: list[float]) -> Column:
    out = F.when(F.lit(False), F.lit(0))
    for i in range(len(edges) - 1):
        out = out.when((F.col(value) >= edges[i]) & (F.col(value) < edges[i + 1]), F.lit(i))
    return out


def agreement_cells(rows: DataFrame, a: str, b: str, call: str) -> DataFrame:
    """Cross-tabulates two references and gives the call rate in each cell."""
    return rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(call) == 1).alias("calls")).withColumn("rate", ratio("calls", "n"))
