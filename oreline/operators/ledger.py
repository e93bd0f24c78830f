"""Append-only ledgers: merging files, the latest state of a key, folds of ordered events, and joins of instants to intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_rows(rows: DataFrame, columns: list[str], source: str) -> DataFrame:
    """One row for each distinct whole row, with the sorted set of sources that hold it."""
    return rows.groupBy(*columns).agg(F.array_sort(F.collect_set(source)).alias("sources"))


def latest(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The last row of each key in ``order`` (ascending); the order must be total."""
    down = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*down))).filter("_n = 1").drop("_n")


def latest_struct(rows: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The same by partial aggregation: the greatest (order..., values...) struct of each key, so a hot key is reduced before the shuffle."""
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("_s"))
    return best.select(*keys, *(F.col("_s")[c].alias(c) for c in (*order, *values)))


def prior_row(rows: DataFrame, keys: list[str], seq: str, columns: list[str]) -> DataFrame:
    """Each row with the columns of the row before it of the same key, in the order of ``seq``."""
    w = Window.partitionBy(*keys).orderBy(seq)
    return rows.select("*", *(F.lag(c).over(w).alias(f"prev_{c}") for c in columns))


def completed(rows: DataFrame, keys: list[str], seq: list[str], ok: Column, failed: Column, revoked: Column) -> DataFrame:
    """Keys that were ever ok and whose last decisive event (ok, failed or revoked) is ok."""
    kind = F.when(revoked, F.lit("revoked")).when(failed, F.lit("failed")).when(ok, F.lit("ok"))
    decisive = rows.withColumn("_kind", kind).filter("_kind IS NOT NULL")
    return latest_struct(decisive, keys, seq, ["_kind"]).filter("_kind = 'ok'").select(*keys, *seq)


def cadence(rows: DataFrame, keys: list[str], ts: str, most_seconds: int) -> DataFrame:
    """Median of the gaps between consecutive rows of a key, gaps of 0 and over ``most_seconds`` left out."""
    w = Window.partitionBy(*keys).orderBy(ts)
    gaps = rows.select(*keys, (F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(F.lag(F.col(ts).cast("timestamp")).over(w))).alias("gap"))
    return gaps.filter((F.col("gap") > 0) & (F.col("gap") <= most_seconds)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_gaps"), F.median("gap").alias("cadence_s"))


def attribute_interval(points: DataFrame, intervals: DataFrame, keys: list[str], ts: str, start: str, end: str, label: str, point_id: str, bucket_seconds: int = 86_400) -> DataFrame:
    """Labels of the intervals [start, end) that hold each point: none is ``between``, one is the label, several are ``ambiguous``.

    A range join as an equi-join: intervals are copied to each time bucket that they touch, points have one bucket, and the
    exact bounds are tested after. The points' own rows are never multiplied beyond the intervals that hold them."""
    second = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    spread = intervals.select(*keys, start, end, label, F.explode(F.sequence(F.floor(second(start) / bucket_seconds), F.floor((second(end)) / bucket_seconds))).alias("_bucket"))
    placed = points.withColumn("_bucket", F.floor(second(ts) / bucket_seconds))
    hits = placed.join(spread, [*keys, "_bucket"]).filter((F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end)))
    found = hits.groupBy(point_id).agg(F.countDistinct(label).alias("n_labels"), F.min(label).alias("_label"))
    out = points.join(found, point_id, "left")
    verdict = F.when(F.col("n_labels").isNull(), F.lit("between")).when(F.col("n_labels") == 1, F.col("_label")).otherwise(F.lit("ambiguous"))
    return out.withColumn("step", verdict).drop("_label", "n_labels")


def nearest_within(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, left_id: str, right_id: str, seconds: int) -> DataFrame:
    """For each left row the right row of the same key nearest in time within ``seconds``; ties go to the earlier, then the smaller id.

    Time buckets of the width of the window make it an equi-join with three buckets a left row."""
    second = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    bucket = F.floor(second(left_ts) / seconds)
    l_rows = left.withColumn("_b", F.explode(F.array(bucket - 1, bucket, bucket + 1)))
    r_rows = right.withColumn("_b", F.floor(second(right_ts) / seconds))
    near = l_rows.join(r_rows, [*keys, "_b"]).withColumn("gap_s", F.abs(second(left_ts) - second(right_ts))).filter(F.col("gap_s") <= seconds)
    best = near.groupBy(left_id).agg(F.min(F.struct("gap_s", F.col(right_ts).alias("_ts"), F.col(right_id).alias("_id"))).alias("_m"))
    return best.select(left_id, F.col("_m._id").alias(right_id), F.col("_m.gap_s").alias("gap_s"))


def bounded_attempts(rows: DataFrame, keys: list[str], ts: str, seq: str) -> DataFrame:
    """Each row as an interval [ts, next row of the key)."""
    w = Window.partitionBy(*keys).orderBy(ts, seq)
    return rows.select("*", F.lead(ts).over(w).alias("until"))


def apportion(rows: DataFrame, group: str, weight: str, total: str) -> DataFrame:
    """A group's total shared out by weight; the weights' sum comes by aggregation and an equi-join, so a hot group isn't one window."""
    sums = rows.groupBy(group).agg(F.sum(weight).alias("_w"))
    return rows.join(sums, group).withColumn("share", F.round(F.try_divide(F.col(total) * F.col(weight), F.col("_w")), 4)).drop("_w")


def signature(text: Column, most: int = 180) -> Column:
    """An error's text with hexadecimal ids, paths, quoted values and numbers masked, cut to ``most`` characters."""
    for pattern, mask in ((r"0x[0-9a-fA-F]+", "<hex>"), (r"\b[0-9a-f]{8,}\b", "<id>"), (r"(?:[A-Za-z]:)?(?:[\\/][\w.\-]+){2,}", "<path>"), (r"\d+(?:\.\d+)?", "<n>"), (r"\s+", " ")):
        text = F.regexp_replace(text, pattern, mask)
    return F.substring(F.trim(text), 1, most)


def replay_backoff(rows: DataFrame, keys: list[str], ts: str, seq: str, blocked: Column, base_seconds: int, most_seconds: int) -> DataFrame:
    """Folds the attempts of each key in time order: a blocked one doubles the wait (from ``base_seconds`` up to ``most_seconds``), any other resets it.

    The fold needs only the run of blocked attempts at the end, so it is windows and sums: the streak's length gives the wait."""
    w = Window.partitionBy(*keys).orderBy(F.desc(ts), F.desc(seq)).rowsBetween(Window.unboundedPreceding, 0)
    tail = rows.withColumn("_blocked", blocked.cast("int")).withColumn("_open", F.min("_blocked").over(w))
    agg = tail.groupBy(*keys).agg(F.sum("_open").alias("streak"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("attempts"))
    wait = F.when(F.col("streak") == 0, F.lit(0)).otherwise(F.least(F.lit(most_seconds), F.lit(base_seconds) * F.pow(F.lit(2), F.least(F.col("streak"), F.lit(30)) - 1)))
    return agg.withColumn("wait_s", wait.cast("long"))
