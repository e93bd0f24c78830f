"""Sharding by global byte-size prefix sums: contiguous shards of nearly equal bytes, native DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def assign_shards(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contiguous shards in the order of ``id_col``, cut at equal byte targets.

    The rows (id, size and checksum, never the text) are range-partitioned by id and written with their partition number.
    A table of one total a partition gives each partition its base in the global order; a running sum inside the partition
    adds the rest. A row belongs to the shard in whose byte range its middle byte lies, so shards follow one another in id
    order and differ from the target by less than the largest row.

    Returns id_col, size (UTF-8 bytes plus 1), text_crc32, shard (from 0) and slot (gapless from 0 in each shard).

    Null texts have size 1 and the checksum of the empty text. Null ids come first. Rows with equal ids, repeated rows
    included, each keep a row of their own, ordered by size and checksum. An empty table gives no rows. Other columns of
    ``docs`` take no part.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("text_crc32"),
    )
    key = ["doc_id", "size", "text_crc32"]
    ranged = materialize(rows.repartitionByRange(*key).withColumn("part", F.spark_partition_id()), "shard-rows")

    parts = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    bases = parts.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_rows"),
        F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*key)
    placed = ranged.join(F.broadcast(bases), "part").select(
        *key,
        (F.col("base_bytes") + F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("before"),
        (F.col("base_rows") + F.row_number().over(inside) - 1).alias("place"),
        "total",
    )
    placed = placed.select(*key, "place", F.expr(f"least({n_shards} - 1, ((2 * before + size) * {n_shards}) div (2 * total))").cast("int").alias("shard"))
    starts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # n_shards rows
    return placed.join(F.broadcast(starts), "shard").select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")
    )
