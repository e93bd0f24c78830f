"""Pixel algebra over tables (grid, row, col, value): neighbourhoods, components, block sums, fusion, bands.

A pixel meets its neighbours by an equi-join on shifted coordinates, so work is linear in pixels and every step is distributed
by cell; nodata (null or 255) is carried, never counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import drop, written

NODATA = 255
RING = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


def valid(v: Column) -> Column:
    return v.isNotNull() & (v != NODATA)


def _spread(px: DataFrame, value: str, offsets: list[tuple[int, int]]) -> DataFrame:
    shift = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets)))
    return px.select("grid", "row", "col", F.col(value).alias("_v"), shift.alias("_s")).select("grid", (F.col("row") + F.col("_s.i")).alias("row"), (F.col("col") + F.col("_s.j")).alias("col"), "_v")


def neighbourhood(px: DataFrame, value: str, half: int = 1) -> DataFrame:
    """Each pixel with the least, greatest and mean valid value within ``half`` cells, itself included. Only pixels that exist get a row."""
    offsets = [(i, j) for i in range(-half, half + 1) for j in range(-half, half + 1)]
    near = _spread(px.filter(valid(F.col(value))), value, offsets).groupBy("grid", "row", "col").agg(F.min("_v").alias("near_min"), F.max("_v").alias("near_max"), F.avg("_v").alias("near_mean"), F.count(F.lit(1)).alias("near_n"))
    return px.join(near, ["grid", "row", "col"], "left")


def dilate(px: DataFrame, value: str) -> DataFrame:
    """8-neighbour dilation of 1s; the grid's edge doesn't wrap."""
    return neighbourhood(px, value).select("grid", "row", "col", F.when(valid(F.col(value)), F.coalesce("near_max", F.col(value))).otherwise(F.col(value)).alias(value))


def erode(px: DataFrame, value: str) -> DataFrame:
    return neighbourhood(px, value).select("grid", "row", "col", F.when(valid(F.col(value)), F.coalesce("near_min", F.col(value))).otherwise(F.col(value)).alias(value))


def threshold_and_clean(px: DataFrame, value: str, cut: float) -> DataFrame:
    """1 at ``cut`` or more, then opening and closing; nodata stays."""
    hard = px.select("grid", "row", "col", F.when(~valid(F.col(value)), F.lit(NODATA)).otherwise((F.col(value) >= cut).cast("int")).alias("m"))
    return erode(dilate(dilate(erode(hard, "m"), "m"), "m"), "m")


def smooth(px: DataFrame, value: str, half: int = 1) -> DataFrame:
    """Mean of the valid pixels within ``half`` cells."""
    return neighbourhood(px, value, half).select("grid", "row", "col", value, F.round("near_mean", 6).alias("smooth"))


def block_sum(px: DataFrame, value: str, k: int) -> DataFrame:
    """Sum and count of valid pixels of each k by k block."""
    b = lambda c: F.floor(F.col(c) / k).cast("int")
    return px.filter(valid(F.col(value))).groupBy("grid", b("row").alias("brow"), b("col").alias("bcol")).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))


def fuse_max(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """The greater value where both are valid, else nodata."""
    j = a.select("grid", "row", "col", F.col(value).alias("_a")).join(b.select("grid", "row", "col", F.col(value).alias("_b")), ["grid", "row", "col"], "full")
    x, y = F.when(valid(F.col("_a")), F.col("_a")), F.when(valid(F.col("_b")), F.col("_b"))
    return j.select("grid", "row", "col", F.when(x.isNotNull() & y.isNotNull(), F.greatest(x, y)).otherwise(F.lit(NODATA)).alias(value))


def combine(arms: DataFrame, value: str) -> DataFrame:
    """Mean, greatest and median over arms of each pixel that every arm has a valid value for."""
    n = arms.select("arm").distinct()
    per = arms.filter(valid(F.col(value))).groupBy("grid", "row", "col").agg(F.count(F.lit(1)).alias("_n"), F.round(F.avg(value), 6).alias("mean"), F.max(value).alias("most"), F.median(value).alias("mid"))
    total = n.agg(F.count(F.lit(1)).alias("_t"))  # one row
    return per.join(F.broadcast(total)).filter("_n = _t").drop("_n", "_t")


def normalized_difference(a: Column, b: Column) -> Column:
    return F.round(F.try_divide((a - b).cast("double"), (a + b).cast("double")), 6)


def components(px: DataFrame, value: str, least: int = 1, rounds: int = 10_000) -> DataFrame:
    """8-neighbour components of 1s of at least ``least`` cells: (grid, row, col, component, cells). The component is named by its least cell.

    Least labels spread to neighbours and jump to their label's label until none changes."""
    cell = F.struct("row", "col")
    on = px.filter(F.col(value) == 1).select("grid", cell.alias("c"))
    other = on.select("grid", "c", F.explode(F.array(*(F.struct((F.col("c.row") + i).alias("row"), (F.col("c.col") + j).alias("col")) for i, j in RING if (i, j) != (0, 0)))).alias("d"))
    edges = written(other.join(on.withColumnRenamed("c", "d"), ["grid", "d"]).select("grid", "c", "d"), "cell-edges")
    label = written(on.withColumn("l", F.col("c")), "cell-labels")
    for _ in range(rounds):
        near = edges.join(label.withColumnRenamed("c", "d"), ["grid", "d"]).groupBy("grid", "c").agg(F.min("l").alias("m"))
        low = label.join(near, ["grid", "c"], "left").select("grid", "c", F.col("l").alias("was"), F.least("l", F.coalesce("m", "l")).alias("n"))
        new = written(low.join(label.select("grid", F.col("c").alias("n"), F.col("l").alias("root")), ["grid", "n"], "left").select("grid", "c", "was", F.least("n", F.coalesce("root", "n")).alias("l")), "cell-labels")
        done = not new.filter("l <> was").limit(1).count()
        drop(label)
        label = new
        if done:
            break
    else:
        raise RuntimeError(f"labels still change after {rounds} rounds")
    label = label.select("grid", "c", "l")
    drop(edges)
    size = label.groupBy("grid", "l").agg(F.count(F.lit(1)).alias("cells")).filter(F.col("cells") >= least)
    return label.join(size, ["grid", "l"]).select("grid", F.col("c.row").alias("row"), F.col("c.col").alias("col"), F.concat_ws(":", "l.row", "l.col").alias("component"), "cells")


def zonal(px: DataFrame, zones: DataFrame, value: str, zone: str) -> DataFrame:
    """Mean, spread and quartiles of the valid pixels of each zone."""
    j = zones.join(px, ["grid", "row", "col"]).filter(valid(F.col(value)))
    q = lambda p: F.round(F.percentile(value, p), 4)
    return j.groupBy(zone).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 4).alias("mean"), F.round(F.stddev_pop(value), 4).alias("sd"), q(0.25).alias("p25"), q(0.5).alias("p50"), q(0.75).alias("p75"))


def cover_matrix(px: DataFrame, entity: str, arm: str, value: str, arms: list, least: int) -> DataFrame:
    """An entity's mean over valid cells in each arm, null below ``least`` valid cells: a column an arm."""
    cell = F.when(valid(F.col(value)), F.col(value))
    return px.groupBy(entity).agg(*(F.round(F.when(F.count(F.when(F.col(arm) == a, cell)) >= least, F.avg(F.when(F.col(arm) == a, cell))), 6).alias(f"arm_{a}") for a in arms))


def persistent_loss(px: DataFrame, grids: list[int], value: str, cut: float) -> DataFrame:
    """(row, col, lost) of cells that are valid in all ``grids`` (epochs): 1 where the first is at ``cut`` or more and all later are below."""
    on = F.when(valid(F.col(value)), (F.col(value) >= cut).cast("int"))
    wide = px.filter(F.col("grid").isin(grids)).groupBy("row", "col").agg(*(F.max(F.when(F.col("grid") == g, on)).alias(f"_e{i}") for i, g in enumerate(grids)))
    cells = [F.col(f"_e{i}") for i in range(len(grids))]
    known, gone = F.lit(True), cells[0] == 1
    for i, c in enumerate(cells):
        known = known & c.isNotNull()
        gone = gone & (c == 0) if i else gone
    return wide.filter(known).select("row", "col", gone.cast("int").alias("lost"))


def with_additions(label: Column, code: Column) -> Column:
    """Codes laid over labels: 1 makes canopy, 2 unknown unless it is canopy, 3 unknown; canopy never becomes background."""
    return F.when(code == 1, 1).when((code == 2) & (label != 1), NODATA).when(code == 3, NODATA).otherwise(label)


def call_rates(px: DataFrame, certified: DataFrame, product: str, value: str, cut: float) -> DataFrame:
    """Calls at ``cut`` or more of each product on its valid cells among certified ones, where every call is false."""
    j = px.filter(valid(F.col(value))).join(certified, ["row", "col"]).groupBy(product).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(value) >= cut).alias("false_positives"))
    return j.withColumn("rate", F.round(F.col("false_positives") / F.col("n"), 6))


def change_laundering(cells: DataFrame, population: str, base: str, arm: str, floor: float) -> DataFrame:
    """Call rates of two arms on each certified population and on all cells, and whether the arm's rise where cover was gained exceeds
    its rise everywhere by more than ``floor``."""
    each = cells.select(F.explode(F.array(F.col(population), F.lit("all"))).alias("population"), base, arm).filter("population <> 'rest'")
    r = each.groupBy("population").agg(F.count(F.lit(1)).alias("n"), F.avg(base).alias("b"), F.avg(arm).alias("a"))
    rise = F.col("a") - F.col("b")
    rows = r.select("population", "n", F.round("b", 6).alias("base_rate"), F.round("a", 6).alias("arm_rate"), F.round(rise, 6).alias("rise"), F.lit("").alias("flag"))
    k = r.agg((F.max(F.when(F.col("population") == "gain", rise)) - F.max(F.when(F.col("population") == "all", rise))).alias("k")).filter("k IS NOT NULL")
    null = lambda t: F.lit(None).cast(t)
    return rows.unionByName(k.select(F.lit("gain_minus_all").alias("population"), null("long").alias("n"), null("double").alias("base_rate"), null("double").alias("arm_rate"), F.round("k", 6).alias("rise"), F.when(F.col("k") > floor, "CHANGE LAUNDERING").otherwise("PASSES").alias("flag")))


def least_cells(cell_area: Column, least_area: float) -> Column:
    """Cells of the least patch: its area over a cell's, rounded up."""
    return F.ceil(F.lit(least_area) / cell_area)
