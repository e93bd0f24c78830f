"""Deterministic samples, allocations, blocked splits and shard plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written


def hashed(salt: str, key: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256)


def draw(rows: DataFrame, stratum: str, key: str, n: int, salt: str) -> DataFrame:
    """The ``n`` rows of the least hash of each stratum. Row groups are cut before the shuffle, so a large stratum sends n rows a task."""
    w = Window.partitionBy(stratum).orderBy(hashed(salt, key), key)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def allocate(strata: DataFrame, size: str, n: int, least: int = 2) -> DataFrame:
    """Shares of ``n`` in proportion to size, rounded up, ``least`` at least, a stratum's size at the most; what that frees is not dealt again."""
    total = strata.agg(F.sum(size).alias("_t"))  # one row
    share = F.ceil(F.lit(float(n)) * F.col(size) / F.col("_t"))
    return strata.join(F.broadcast(total)).withColumn("n", F.least(F.col(size), F.greatest(F.lit(least), share)).cast("long")).drop("_t")


def block_split(rows: DataFrame, x: str, width: int, salt: str, parts: list[tuple[str, int]]) -> DataFrame:
    """Whole blocks of ``width`` along x go to one part, by a hash in the proportions of ``parts``."""
    total = sum(n for _, n in parts)
    block = F.floor(F.col(x) / width)
    at = F.conv(F.substring(F.md5(F.concat(F.lit(salt), block.cast("string"))), 1, 4), 16, 10).cast("long") % total
    split, upto = None, 0
    for name, n in parts:
        upto += n
        split = F.when(at < upto, F.lit(name)) if split is None else split.when(at < upto, F.lit(name))
    return rows.withColumns({"block": block, "split": split})


def drop_buffered(rows: DataFrame, held: DataFrame, x: str, buffer: int) -> DataFrame:
    """Rows farther than ``buffer`` from every held-out x: an anti join on buckets of the buffer's width, three a held row."""
    b = lambda c: F.floor(F.col(c) / (buffer + 1))
    near = held.select(F.col(x).alias("_x"), F.explode(F.array(b(x) - 1, b(x), b(x) + 1)).alias("_b"))
    return rows.withColumn("_b", b(x)).alias("r").join(near.alias("h"), (F.col("r._b") == F.col("h._b")) & (F.abs(F.col(x) - F.col("_x")) <= buffer), "left_anti").drop("_b")


def buffered_folds(rows: DataFrame, site: str, key: str, x: str, y: str, n_folds: int, buffer: int, salt: str) -> DataFrame:
    """(fold, key, part): each site's rows dealt to ``n_folds`` folds by hash; of each fold its own rows are ``val``, and of the site's
    others those at least ``buffer`` away from all of them, in the larger of both coordinates' distances, are ``train``.

    Cells are as wide as the buffer. Of a row of cells only the least and greatest y that a fold holds in the columns nearer than the
    buffer can matter. Those columns are the own cell, the right one's up to some x and the left one's from some x, so running extremes
    over columns in order give them: a place costs its columns and not its pairs, however crowded."""
    at = lambda c: F.floor(F.col(c) / buffer)
    ranked = global_rank(rows.select(site, key, x, y, hashed(salt, key).alias("_h")), [F.col(site), F.col("_h"), F.col(key)])
    first = ranked.groupBy(site).agg(F.min("rank").alias("_first"), F.count(F.lit(1)).alias("_n"))
    placed = ranked.join(first, site).withColumn("_own", ((F.col("rank") - F.col("_first")) % n_folds).cast("int")).withColumns({"_i": at(x), "_j": at(y)})
    placed = written(placed.select(site, key, F.col(x).alias("_x"), F.col(y).alias("_y"), "_own", "_i", "_j"), "folds")
    held = placed.filter("_i IS NOT NULL AND _j IS NOT NULL").groupBy(site, F.col("_own").alias("fold"), "_i", "_j", "_x").agg(F.min("_y").alias("_low"), F.max("_y").alias("_high"))
    moved = lambda cells, by, side: held.select(site, "fold", (F.col("_i") + cells).alias("_i"), "_j", (F.col("_x") + by).alias("_at"), F.lit(side).alias("_side"), F.lit(None).cast(kind).alias("_x"), "_low", "_high")
    kind = dict(placed.dtypes)["_x"]
    own = held.groupBy(site, "fold", "_i", "_j").agg(F.min("_low").alias("_low"), F.max("_high").alias("_high")).select(site, "fold", "_i", "_j", ((F.col("_i") - 1) * buffer).cast(kind).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_x"), "_low", "_high")
    places = placed.filter("_i IS NOT NULL AND _j IS NOT NULL").select(site, "_i", "_j", "_x").distinct()
    beside = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    folds = F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1)))
    asked = places.select(site, "_i", "_x", "_j", beside.alias("_d")).select(site, "_i", "_x", (F.col("_j") + F.col("_d")).alias("_j")).distinct()
    asked = asked.select(site, folds.alias("fold"), "_i", "_j", F.col("_x").alias("_at"), F.lit(0).alias("_side"), "_x", F.lit(None).cast(dict(placed.dtypes)["_y"]).alias("_low"), F.lit(None).cast(dict(placed.dtypes)["_y"]).alias("_high"))
    merged = moved(-1, -buffer, 1).unionByName(moved(1, buffer, -1)).unionByName(own).unionByName(asked)
    cells = [site, "fold", "_i", "_j"]
    up = Window.partitionBy(*cells).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*cells).orderBy(F.desc("_at"), F.desc("_side")).rowsBetween(Window.unboundedPreceding, 0)
    of = lambda side, c: F.when(F.col("_side") == side, F.col(c))
    reach = merged.withColumns({"_l1": F.min(of(1, "_low")).over(up), "_h1": F.max(of(1, "_high")).over(up)}).withColumns({"_l2": F.min(of(-1, "_low")).over(down), "_h2": F.max(of(-1, "_high")).over(down)})
    reach = reach.filter("_side = 0").select(site, "fold", "_x", "_j", F.least("_l1", "_l2").alias("_low"), F.greatest("_h1", "_h2").alias("_high")).filter("_low IS NOT NULL")
    seen = reach.withColumn("_d", beside).withColumn("_j", F.col("_j") - F.col("_d"))
    limits = seen.groupBy(site, "_x", "_j", "fold").agg(F.max(F.col("_d") == 0).alias("_in"), F.min(F.when(F.col("_d") == 1, F.col("_low"))).alias("_above"), F.max(F.when(F.col("_d") == -1, F.col("_high"))).alias("_below"))
    limits = limits.groupBy(site, "_x", "_j").agg(F.collect_list(F.struct("fold", "_in", "_above", "_below")).alias("_limits"))
    near = lambda r: r["_in"] | F.coalesce(r["_above"] - F.col("_y") < buffer, F.lit(False)) | F.coalesce(F.col("_y") - r["_below"] < buffer, F.lit(False))
    hit = F.coalesce(F.transform(F.filter("_limits", near), lambda r: r["fold"]), F.array().cast("array<int>"))
    out = placed.join(limits, [site, "_x", "_j"], "left").select(key, "_own", hit.alias("_hit")).select(key, "_own", "_hit", folds.alias("fold"))
    out = out.filter((F.col("fold") == F.col("_own")) | ~F.array_contains("_hit", F.col("fold")))
    return out.select("fold", key, F.when(F.col("fold") == F.col("_own"), "val").otherwise("train").alias("part"))


def stability_sample(rows: DataFrame, key: str, salt: str, share: float) -> DataFrame:
    """The round(n * share) distinct keys of the least hash, one at least."""
    ids = rows.select(key).distinct()
    n = max(1, round(ids.count() * share))
    return ids.orderBy(hashed(salt, key), key).limit(n)


def global_rank(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds ``rank`` from 0 over all rows in a total order without one task for all: range partitions, their sizes, local ranks."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id() % (1 << 33))
    ranged = written(ranged, "ranked")  # range bounds come from a sample: only what is written has one set of them
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    base = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))  # a row a partition
    return ranged.join(F.broadcast(base), "_p").withColumn("rank", F.col("_b") + F.col("_i")).drop("_p", "_i", "_b")


def plan_shards(rows: DataFrame, done: DataFrame, key: str, size: int) -> DataFrame:
    """Keys that aren't done, once each, in order, in shards of ``size``."""
    todo = rows.select(key).distinct().join(done.select(key).distinct(), key, "left_anti")
    return global_rank(todo, [F.col(key)]).select(key, F.floor(F.col("rank") / size).alias("shard"))


def deal(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Deals rows in a total order to ``n`` batches in turn."""
    return global_rank(rows, order).withColumn("batch", (F.col("rank") % n).cast("int")).drop("rank")


def _filled(pool: DataFrame, key: str, bin_: str, room: Column, bins: Column, salt: str) -> DataFrame:
    """Rows of a pool up to ``room``: an equal quota a bin by least hash, then what is left over by hash.

    ``room`` and ``bins`` are columns that are the same in all rows. Quotas are cut by bin first; then each is at most ``room``."""
    h = F.md5(F.concat(F.lit(salt), F.col(key).cast("string")))
    per = F.greatest(F.lit(1), F.floor(room / F.greatest(F.lit(1), bins)))
    k = pool.withColumn("_h", h).withColumn("_k", F.row_number().over(Window.partitionBy(bin_).orderBy("_h", key))).withColumn("_q", F.col("_k") <= per)
    order = [(~F.col("_q")).asc(), F.when(F.col("_q"), F.col(bin_)).otherwise(0).asc(), F.when(F.col("_q"), F.col("_k")).otherwise(0).asc(), F.col("_h").asc(), F.col(key).asc()]
    return global_rank(k, order).filter(F.col("rank") < room).drop("_h", "_k", "_q", "rank")


def quota_sample(rows: DataFrame, key: str, bin_: str, forced: str, budget: int, salt: str) -> DataFrame:
    """(key, bin, forced): forced rows, and of the others equal quotas a bin up to the budget, filled up from what is left. All if they fit."""
    n = rows.agg(F.greatest(F.lit(0), F.lit(budget) - F.count_if(F.col(forced))).alias("_room"), F.count_distinct(F.when(~F.col(forced), F.col(bin_))).alias("_bins"), F.count(F.lit(1)).alias("_n"))  # one row
    tagged = rows.join(F.broadcast(n)).withColumn("_room", F.when(F.col("_n") <= budget, F.col("_n")).otherwise(F.col("_room")))
    chosen = _filled(tagged.filter(~F.col(forced)), key, bin_, F.col("_room"), F.col("_bins"), salt)
    return rows.filter(forced).select(key, bin_, forced).unionByName(chosen.select(key, bin_, forced))


def citywide_tiles(rows: DataFrame, key: str, bin_: str, forced: str, green: str, budget: int, salt: str, background: float = 0.22, hard: float = 0.15) -> DataFrame:
    """(key, kind): forced rows; of the room left a ``background`` share from bin 0, in it a ``hard`` share of green ones (more if plain
    ones run out); the rest from the other bins in equal quotas, filled up from what is left."""
    pool = ~F.col(forced)
    n = rows.agg(F.greatest(F.lit(0), F.lit(budget) - F.count_if(F.col(forced))).alias("_room"), F.count_if(pool & (F.col(bin_) == 0)).alias("_bg"), F.count_if(pool & (F.col(bin_) == 0) & F.col(green)).alias("_gr"), F.count_distinct(F.when(pool & (F.col(bin_) != 0), F.col(bin_))).alias("_bins"))
    n = n.withColumn("_nbg", F.least("_bg", F.round(background * F.col("_room")).cast("long"))).withColumn("_ng", F.least("_gr", F.round(hard * F.col("_nbg")).cast("long"))).withColumn("_nc", F.col("_room") - F.col("_nbg"))
    tagged = rows.filter(pool).join(F.broadcast(n)).withColumn("_h", F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))))
    ground = tagged.filter(F.col(bin_) == 0).withColumn("_g", F.row_number().over(Window.partitionBy(green).orderBy("_h", key)))
    kept = F.col(green) & (F.col("_g") <= F.col("_ng"))
    spare = F.col(green) & ~kept
    low = global_rank(ground, [spare.asc(), kept.desc(), F.col("_h").asc(), F.col(key).asc()]).filter(F.col("rank") < F.col("_nbg"))
    low = low.select(key, F.when(F.col(green), F.lit("green")).otherwise(F.lit("background")).alias("kind"))
    high = _filled(tagged.filter(F.col(bin_) != 0), key, bin_, F.col("_nc"), F.col("_bins"), salt).select(key, F.lit("canopy").alias("kind"))
    return rows.filter(forced).select(key, F.lit("forced").alias("kind")).unionByName(low).unionByName(high)
