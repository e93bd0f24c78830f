"""Versioned records: current views by pointer, workstream overlays, chains of versions, promotion to a fixed point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop, written


def current(identities: DataFrame, versions: DataFrame, pointer: str, version_id: str) -> DataFrame:
    """Identities joined to the version that their pointer names (never the greatest number)."""
    return identities.join(versions, F.col(pointer) == F.col(version_id))


def overlay(identities: DataFrame, heads: DataFrame, versions: DataFrame, key: str, workstream: str, head: str, pointer: str, version_id: str) -> DataFrame:
    """A row for each workstream and identity: the workstream's head if it has one, else the main pointer."""
    streams = heads.select(workstream).distinct().withColumn("_all", F.lit(1))
    seen = identities.withColumn("_ids", F.struct(*identities.columns))  # the result has a row each: its size is what was asked for
    rows = seen.select(key, pointer).join(streams.groupBy("_all").agg(F.collect_set(workstream).alias("_w")).drop("_all")).select(key, pointer, F.explode("_w").alias(workstream))
    picked = rows.join(heads, [workstream, key], "left").withColumn("_v", F.coalesce(head, pointer))
    return picked.join(versions.withColumnRenamed(version_id, "_v"), "_v").withColumnRenamed("_v", version_id)


def chains(versions: DataFrame, heads: DataFrame, version_id: str, based_on: str, head: str) -> DataFrame:
    """(head, version, depth) from each head back to its root, however long: each round doubles the jump, so a chain of n needs
    log2(n) joins. Versions that are based on themselves through others are an error."""
    out = heads.select(F.col(head).alias("head"), F.col(head).alias("version"), F.lit(0).alias("depth"))
    jump = versions.select(F.col(version_id).alias("version"), F.col(based_on).alias("to"), F.lit(1).alias("by")).filter("to IS NOT NULL")
    steps, n = 1, versions.count()
    while True:
        more = out.join(jump, "version").select("head", F.col("to").alias("version"), (F.col("depth") + F.col("by")).alias("depth"))
        out = out.unionByName(more).distinct()
        nxt = jump.alias("a").join(jump.alias("b"), F.col("a.to") == F.col("b.version")).select(F.col("a.version").alias("version"), F.col("b.to").alias("to"), (F.col("a.by") + F.col("b.by")).alias("by"))
        before, jump, out = (jump, out), written(nxt, "chain-jumps"), written(out, "chains")
        drop(*before)
        if not jump.limit(1).count():
            return out
        steps *= 2
        if steps > n:
            raise ValueError("versions are based on one another in a circle")


def hold_fixpoint(items: DataFrame, deps: DataFrame, key: str, held: str, needs: str) -> DataFrame:
    """Marks hold on items that are held themselves or need a held item, directly or through others; the rest is prepared.

    deps: (key, needs), in any shape, circles included. Where each item needs one at the most, each round doubles the reach
    (pointer jumping); else a round walks from what it held last, so nothing is visited twice."""
    start = items.filter(F.col(held).cast("boolean")).select(F.col(key).alias("k")).distinct()
    edges = written(deps.select(F.col(key).alias("k"), F.col(needs).alias("to")).distinct(), "hold-edges")
    found = written(start, "held")
    if not edges.groupBy("k").count().filter("count > 1").limit(1).count():
        jump, reach, most = edges, 1, 2 * edges.count()
        while True:
            more = jump.join(found.withColumnRenamed("k", "to"), "to").select("k")
            before, found = found, written(found.unionByName(more).distinct(), "held")
            nxt = jump.alias("a").join(jump.alias("b"), F.col("a.to") == F.col("b.k")).select(F.col("a.k").alias("k"), F.col("b.to").alias("to"))
            old, jump = jump, written(nxt, "hold-jumps")
            drop(before, old)
            reach *= 2
            if reach > most or not jump.limit(1).count():  # a circle is walked round once
                break
    else:
        last = found
        while True:
            last = written(edges.join(last.withColumnRenamed("k", "to"), "to").select("k").distinct().join(found, "k", "left_anti"), "held-last")
            if not last.limit(1).count():
                break
            found = written(found.unionByName(last), "held")
    out = items.select(key).join(found.select(F.col("k").alias(key), F.lit(True).alias("_h")), key, "left")
    return out.select(key, F.when(F.col("_h"), F.lit("hold")).otherwise(F.lit("prepare")).alias("mark"))


def set_hash(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """SHA-256 of each group's sorted members: the same for any order of rows."""
    return rows.groupBy(*keys).agg(F.sha2(F.array_join(F.array_sort(F.collect_set(F.col(member).cast("string"))), ","), 256).alias("set_hash"))


def enqueue(queue: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows whose key isn't queued, once each."""
    return new.dropDuplicates([key]).join(queue.select(key), key, "left_anti")


def claims(current_rows: DataFrame, claimed: DataFrame, key: str, value: str) -> DataFrame:
    """Weighs claimed values against current ones: accept (none held), corroborate (equal), conflict."""
    j = claimed.join(current_rows.select(key, F.col(value).alias("_held")), key, "left")
    return j.withColumn("outcome", F.when(F.col("_held").isNull(), F.lit("accept")).when(F.col("_held") == F.col(value), F.lit("corroborate")).otherwise(F.lit("conflict"))).drop("_held")


def inventory_diff(old: DataFrame, new: DataFrame, path: str, digest: str) -> DataFrame:
    """Each path as same, changed, new, renamed (a departed path had its bytes) or missing."""
    o, n = old.select(F.col(path).alias("path"), F.col(digest).alias("_o")), new.select(F.col(path).alias("path"), F.col(digest).alias("_n"))
    both = o.join(n, "path", "full")
    gone = both.filter("_n IS NULL").groupBy(F.col("_o").alias("_n")).agg(F.min("path").alias("was"))
    out = both.join(gone, "_n", "left")
    return out.select("path", F.when(F.col("_o").isNull() & F.col("was").isNotNull(), F.lit("renamed")).when(F.col("_o").isNull(), F.lit("new")).when(F.col("_n").isNull(), F.lit("missing")).when(F.col("_o") == F.col("_n"), F.lit("same")).otherwise(F.lit("changed")).alias("state"), F.when(F.col("_o").isNull(), F.col("was")).alias("was"))


def differs(a: DataFrame, b: DataFrame, keys: list[str], columns: dict[str, float]) -> DataFrame:
    """Cells of two tables that differ by more than the column's tolerance, or stand on one side only."""
    j = a.select(*keys, *(F.col(c).alias(f"_a_{c}") for c in columns)).join(b.select(*keys, *(F.col(c).alias(f"_b_{c}") for c in columns)), keys, "full")
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"_a_{c}").cast("double").alias("a"), F.col(f"_b_{c}").cast("double").alias("b"), F.lit(float(t)).alias("t")) for c, t in columns.items())))
    d = j.select(*keys, cells.alias("x")).select(*keys, "x.column", "x.a", "x.b", "x.t")
    return d.filter(~F.col("a").eqNullSafe(F.col("b")) & (F.col("a").isNull() | F.col("b").isNull() | (F.abs(F.col("a") - F.col("b")) > F.col("t")))).drop("t")
