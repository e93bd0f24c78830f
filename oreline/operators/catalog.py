"""Catalogues of stored things: manifests, content signatures, copies, windows and bounds of grids, applied schema changes, SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def manifests(rows: DataFrame, body: str, schema: str, tile_sets: DataFrame, registry: DataFrame) -> DataFrame:
    """Run manifests (JSON) as one wide row each, with what the tile-set and registry tables say; each has one row a key."""
    m = rows.select(F.from_json(body, schema).alias("m")).select("m.*")
    return m.join(tile_sets, "tile_set", "left").join(registry, "run_id", "left")


def signatures(rows: DataFrame, group: str, member: str, most: int = 12) -> DataFrame:
    """(group, n, signature): the first ``most`` hexadecimal digits of the SHA-256 of a group's sorted distinct members."""
    g = rows.groupBy(group).agg(F.array_sort(F.collect_set(F.col(member).cast("string"))).alias("_m"))
    return g.select(group, F.size("_m").alias("n"), F.substring(F.sha2(F.to_json("_m"), 256), 1, most).alias("signature"))


def to_copy(source: DataFrame, held: DataFrame, path: str, digest: str) -> DataFrame:
    """Files whose path isn't held with the same bytes: new, or changed."""
    h = held.select(path, F.col(digest).alias("_held"))
    return source.join(h, path, "left").filter(~F.col(digest).eqNullSafe(F.col("_held"))).withColumn("why", F.when(F.col("_held").isNull(), "new").otherwise("changed")).drop("_held")


def window(px: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Cells of rows [a, b) and columns [a, b); the bounds reach the scan."""
    return px.filter((F.col("row") >= rows[0]) & (F.col("row") < rows[1]) & (F.col("col") >= cols[0]) & (F.col("col") < cols[1]))


def on_lattice(px: DataFrame, value: str, k: int) -> DataFrame:
    """Each k by k block as the value of the cell nearest to its middle; of cells as near the first by row and column."""
    mid = (k - 1) / 2
    r, c = F.floor(F.col("row") / k).cast("int"), F.floor(F.col("col") / k).cast("int")
    far = F.abs(F.col("row") - r * k - mid) + F.abs(F.col("col") - c * k - mid)
    best = px.groupBy("grid", r.alias("brow"), c.alias("bcol")).agg(F.min(F.struct(far.alias("d"), "row", "col", F.col(value).alias("v"))).alias("m"))
    return best.select("grid", "brow", "bcol", F.col("m.v").alias(value))


def touching(boxes: DataFrame, bounds: tuple[float, float, float, float]) -> DataFrame:
    """Boxes (xmin, ymin, xmax, ymax) that touch the bounds."""
    x0, y0, x1, y1 = bounds
    return boxes.filter((F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0))


def schema_changes(available: DataFrame, applied: DataFrame) -> DataFrame:
    """State of each numbered change (no, checksum): applied, drifted (applied with another checksum), late (not applied though a later
    one is), pending; lost where it was applied and is no longer there."""
    j = available.select("no", F.col("checksum").alias("_a")).join(applied.select("no", F.col("checksum").alias("_b")), "no", "full")
    last = applied.agg(F.max("no").alias("_last"))  # one row
    state = F.when(F.col("_a").isNull(), "lost").when(F.col("_b").isNull() & (F.col("no") < F.coalesce("_last", F.lit(-1))), "late").when(F.col("_b").isNull(), "pending").when(F.col("_a") == F.col("_b"), "applied").otherwise("drifted")
    return j.join(F.broadcast(last)).select("no", state.alias("state"))


def parity(a: DataFrame, b: DataFrame, epoch: str, value: str) -> DataFrame:
    """Cells that differ in each epoch that both stacks have; where the cells themselves differ in any shared epoch, none is equal."""
    shared = a.select(epoch).distinct().join(b.select(epoch).distinct(), epoch)
    keys = [epoch, "row", "col"]
    j = a.join(shared, epoch, "left_semi").select(*keys, F.col(value).alias("_a"), F.lit(1).alias("_ia")).join(b.join(shared, epoch, "left_semi").select(*keys, F.col(value).alias("_b"), F.lit(1).alias("_ib")), keys, "full")
    p = j.groupBy(epoch).agg(F.count(F.lit(1)).alias("cells"), F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("n_differ"), F.count_if(F.col("_ia").isNull() | F.col("_ib").isNull()).alias("n_outside"))
    off = p.agg((F.sum("n_outside") > 0).alias("_off"))  # one row
    return p.join(F.broadcast(off)).select(epoch, "cells", "n_differ", "n_outside", ((F.col("n_differ") == 0) & ~F.col("_off")).alias("equal"))


def curve_points(rows: DataFrame, live: Column, tp: str, fp: str, fn: str, signature: list[str]) -> DataFrame:
    """Live rows with F1 computed again and the content hash that names their curve."""
    f1 = F.try_divide(2.0 * F.col(tp), 2.0 * F.col(tp) + F.col(fp) + F.col(fn))
    return rows.filter(live).withColumns({"f1": F.round(f1, 6), "curve_id": F.substring(F.sha2(F.concat_ws("|", *signature), 256), 1, 12)})


def search_text(x: Column) -> Column:
    """Text as searches see it: lost letters and soft hyphens out, hyphenated line ends joined, white space collapsed; in front of it, in
    order, every spelling that words with a control byte for a ligature could have."""
    c0 = r"\x01-\x08\x0b\x0c\x0e-\x1f"
    base = F.regexp_replace(F.regexp_replace(F.translate(F.coalesce(x, F.lit("")), "�­", ""), r"-[ \t\r\n]+", ""), r"[ \t\r\n]+", " ")
    forms = ["", "ff", "fi", "fl", "ffi", "ffl"]
    inner, first = rf"([A-Za-z]+)[{c0}]([A-Za-z]+)", rf"(^|[^A-Za-z])[{c0}]([A-Za-z]{{2,}})"
    all_of = lambda pattern, i: F.regexp_extract_all(base, F.lit(pattern), F.lit(i))
    a = F.zip_with(all_of(inner, 1), all_of(inner, 2), lambda m, n: F.array_join(F.array(*(F.concat(m, F.lit(f), n) for f in forms)), " "))
    b = F.transform(all_of(first, 2), lambda n: F.array_join(F.array(*(F.concat(F.lit(f), n) for f in forms)), " "))
    extra = F.array_join(F.array_sort(F.concat(a, b)), " ")
    return F.concat(F.when(extra != "", F.concat(extra, F.lit(" "))).otherwise(F.lit("")), base)


def register_functions(spark: SparkSession) -> None:
    """SQL functions of the session by name, native expressions all: oreline_norm_title, oreline_url_host, oreline_without_query."""
    spark.sql(r"""CREATE OR REPLACE TEMPORARY FUNCTION oreline_norm_title(x STRING) RETURNS STRING
        RETURN trim(regexp_replace(lower(regexp_replace(x, '<[^>]*>', ' ')), '[^\\p{L}\\p{N}]+', ' '))""")
    spark.sql(r"""CREATE OR REPLACE TEMPORARY FUNCTION oreline_url_host(x STRING) RETURNS STRING
        RETURN lower(regexp_extract(x, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))""")
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION oreline_without_query(x STRING) RETURNS STRING RETURN regexp_replace(x, '[?#].*$', '')")


def ranked_within(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows with their place in a total order of each group."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
