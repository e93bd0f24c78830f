"""Eviction from a shared cache: the coldest entries go until the room is there, pinned ones never."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written


def running_total(rows: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before each in a total order: range partitions, their totals, sums inside."""
    ranged = written(rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "range-totals")
    totals = ranged.groupBy("_p").agg(F.sum(value).alias("_t"))
    base = totals.select("_p", F.coalesce(F.sum("_t").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))  # a row a partition
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(F.broadcast(base), "_p").withColumn(name, F.col("_b") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_p", "_b")


def evicted(entries: DataFrame, free: int, floor: int, need: int, margin: float = 1.15, keep_key: str | None = None) -> DataFrame:
    """Ready entries without a pin, by last use, then by the time they got ready, then by key, that go to make room for ``need`` bytes.

    entries: key, ready, pinned, bytes, last_use, ts_ready. The room wanted is the floor and the request with its margin; where all
    that may go can't reach it, the floor or the request if larger, then the bare request; where not even that, nothing goes."""
    size = F.greatest(F.lit(0), F.coalesce(F.col("bytes"), F.lit(0))).cast("long")
    may = entries.filter(F.col("ready") & ~F.col("pinned")).withColumn("bytes", size)
    if keep_key is not None:
        may = may.filter(F.col("key") != keep_key)
    reach = free + (may.agg(F.sum("bytes")).first()[0] or 0)
    want = floor + int(need * margin)
    target = next((t for t in (want, max(floor, need), need) if reach >= t), None)
    if free >= want or target is None:
        return may.limit(0).withColumn("freed_before", F.lit(0).cast("long"))
    cold = running_total(may, [F.coalesce("last_use", F.lit(0.0)), F.coalesce("ts_ready", F.lit(0.0)), F.col("key")], "bytes", "freed_before")
    return cold.filter(F.lit(free) + F.col("freed_before") < target)
