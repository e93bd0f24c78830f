"""Plane geometry by grid cells: points in polygons, median shifts of matched points, far-apart picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def inside(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies in a ring (an array of struct(x, y), closed or not), by the parity of its edges to the right."""
    n = F.size(ring)
    crossing = lambda i: (
        lambda a, b: ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])
    )(F.element_at(ring, i), F.element_at(ring, i % n + 1))
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(False), lambda s, i: F.when(F.coalesce(crossing(i), F.lit(False)), ~s).otherwise(s))


def attach_polygon(points: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, ring: str, value: str, cell: float | None = None) -> DataFrame:
    """Each point with the polygons that hold it, collapsed to one row: the least id, their number, and least and greatest value.

    An equi-join on grid cells: a polygon is sent to the cells of its bounds, a point has one; the bounds, then the exact test decide.
    Without ``cell`` it is half the median width of the polygons. Equal outlines are one with the totals of their polygons, and a place
    is asked once, however many points lie there."""
    ends = lambda axis: (F.array_min(F.transform(ring, lambda p: p[axis])), F.array_max(F.transform(ring, lambda p: p[axis])))
    alike = polygons.groupBy(ring).agg(F.min(polygon_id).alias(polygon_id), F.count(F.lit(1)).alias("_same"), F.min(value).alias("_least"), F.max(value).alias("_most"))
    bounded = alike.select("*", *(c.alias(n) for n, c in zip(("_x1", "_x2", "_y1", "_y2"), (*ends("x"), *ends("y")))))
    if cell is None:
        width = bounded.agg(F.percentile_approx(F.greatest(F.col("_x2") - F.col("_x1"), F.col("_y2") - F.col("_y1")), 0.5)).first()[0]
        cell = max((width or 0.0) / 2, 1e-9) or 1.0
    at = lambda c: F.floor(c / cell)
    spread = bounded.withColumn("_cx", F.explode(F.sequence(at(F.col("_x1")), at(F.col("_x2"))))).withColumn("_cy", F.explode(F.sequence(at(F.col("_y1")), at(F.col("_y2")))))
    placed = points.select("x", "y").distinct().withColumns({"_cx": at(F.col("x")), "_cy": at(F.col("y"))})
    near = F.col("x").between(F.col("_x1"), F.col("_x2")) & F.col("y").between(F.col("_y1"), F.col("_y2"))
    hits = placed.join(spread, ["_cx", "_cy"]).filter(near & inside(F.col("x"), F.col("y"), F.col(ring)))
    found = hits.groupBy("x", "y").agg(F.min(polygon_id).alias(polygon_id), F.sum("_same").alias("n_matched"), F.min("_least").alias(f"{value}_min"), F.max("_most").alias(f"{value}_max"))
    return points.select(point_id, "x", "y").join(found, ["x", "y"], "left").drop("x", "y").withColumn("n_matched", F.coalesce("n_matched", F.lit(0)))


def median_shift(pairs: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Median displacement of each key's matched pairs (ax, ay, bx, by); null under ``least`` pairs."""
    enough = F.col("n") >= least
    s = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.median(F.col("bx") - F.col("ax")).alias("dx"), F.median(F.col("by") - F.col("ay")).alias("dy"))
    return s.select(*keys, "n", F.when(enough, F.col("dx")).alias("dx"), F.when(enough, F.col("dy")).alias("dy"))


def spread_pick(rows: DataFrame, key: str, x: str, y: str, n: int) -> DataFrame:
    """``n`` rows, each as far as can be from those before it (the first is the least key; ties to the least key): (place, key).

    Every pick is one pass that lowers each row's distance to the nearest pick; the picks are few and are the only thing that comes
    to the driver."""
    points = rows.select(key, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    picked: list = []
    for i in range(n):
        if not picked:
            best = points.orderBy(key).limit(1).collect()
        else:
            d = F.least(*(F.hypot(F.col("_x") - p["_x"], F.col("_y") - p["_y"]) for p in picked), *([F.lit(float("inf"))] if len(picked) == 1 else []))
            best = points.filter(~F.col(key).isin([p[key] for p in picked])).orderBy(d.desc(), key).limit(1).collect()
        if not best:
            break
        picked += best
    return rows.sparkSession.createDataFrame([(i, p[key]) for i, p in enumerate(picked)], f"place int, `{key}` {dict(rows.dtypes)[key]}")
