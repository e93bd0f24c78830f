"""Label events of a review: undone ones folded away, verdicts of a second look, and the paired change estimate with its quality counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def standing(rows: DataFrame, item: str, order: str, label: str, undo: str = "undo", restore: bool = False) -> DataFrame:
    """(item, label) after all events of each item in order: an undo takes the item's label off, one of nothing does nothing.

    With ``restore`` an undo brings back the label before it, so undos nest: each takes off the last label that none has taken yet. The
    running depth (never under 0) tells which: the label that stands is the last one given at the depth of the end."""
    is_undo = F.col(label) == undo
    if not restore:
        last = rows.groupBy(item).agg(F.max_by(label, order).alias(label))
        return last.filter(F.col(label) != undo)
    w = Window.partitionBy(item).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    walked = rows.select(item, order, label).withColumn("_s", F.sum(F.when(is_undo, -1).otherwise(1)).over(w))
    depth = F.col("_s") - F.least(F.lit(0), F.min("_s").over(w))
    at_depth = walked.withColumn("_d", depth).groupBy(item, "_d").agg(F.max(order).alias("_last"), F.max(F.when(~is_undo, F.struct(order, label))).alias("_given"))
    end = at_depth.groupBy(item).agg(F.max_by(F.struct("_d", "_given"), "_last").alias("_e"))
    return end.filter("_e._d > 0").select(item, F.col(f"_e._given.{label}").alias(label))


def overridden(labels: DataFrame, verified: DataFrame, item: str, label: str) -> DataFrame:
    """Labels with those of a second look, which count where there are any; ``overturned`` where it gave another one."""
    j = labels.join(verified.select(item, F.col(label).alias("_v")), item, "full")
    return j.select(item, F.coalesce("_v", label).alias(label), F.coalesce(F.col("_v") != F.col(label), F.lit(False)).alias("overturned"))


def paired_change(labels: DataFrame, points: DataFrame, strata: DataFrame, total_cells: Column, item: str = "point_id", label: str = "label", z: float = 1.96) -> DataFrame:
    """One row: the net change in shares of the area with its half width, and the counters of the controls.

    points: item, kind (live, dup, blur), dup_of, stratum, floor (drawn from anywhere), overlap (the stratum that such a point falls
    in); strata: stratum, cells. A live point counts as loss -1, gain 1, nochange 0; unsure ones don't. Duplicates are held against
    their original, blurred controls should show no change, and floor points outside stratum 1 show what the strata miss."""
    change = F.col(label).isin("gain", "loss")
    p = points.join(labels.select(item, label, "overturned"), item)
    live = F.col("kind") == "live"
    delta = F.when(F.col(label) == "loss", -1.0).when(F.col(label) == "gain", 1.0).when(F.col(label) == "nochange", 0.0)
    judged = p.filter(live).withColumns({"stratum": F.when(F.col("floor"), F.col("overlap")).otherwise(F.col("stratum")), "_y": delta}).filter("_y IS NOT NULL")
    by = judged.groupBy("stratum").agg(F.avg("_y").alias("_m"), F.var_samp("_y").alias("_v"), F.count(F.lit(1)).alias("_n"))
    w = F.col("cells") / total_cells
    spread = F.coalesce(F.when(F.col("_n") > 1, w * w * F.col("_v") / F.col("_n")), F.lit(0.0))
    estimate = by.join(F.broadcast(strata), "stratum").agg(F.round(F.sum(w * F.col("_m")), 6).alias("net"), F.round(z * F.sqrt(F.sum(spread)), 6).alias("half_width"))
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    outside = live & F.col("floor") & (F.col("overlap") != 1)
    counts = p.agg(
        n(live).alias("n_live"), n(F.col("overturned")).alias("n_overturned"), n(F.col("kind") == "blur").alias("n_blur"), n((F.col("kind") == "blur") & change).alias("blur_changed"),
        n(outside).alias("n_outside"), n(outside & change).alias("outside_changed"), n(F.col(label) == "unsure").alias("n_unsure"),
    )
    original = labels.select(F.col(item).alias("dup_of"), F.col(label).alias("_o"))
    sure = (F.col(label) != "unsure") & (F.col("_o") != "unsure")
    twice = p.filter("kind = 'dup'").join(original, "dup_of").filter(sure).agg(F.count(F.lit(1)).alias("n_dup"), n(F.col(label) != F.col("_o")).alias("dup_disagree"))
    one = lambda d: d.withColumn("_k", F.lit(1))  # noqa: E731  a row each
    return one(estimate).join(one(counts), "_k").join(one(twice), "_k").drop("_k")
