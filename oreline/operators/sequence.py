"""Ordered state series of entities: states, runs, validity intervals, bounded filling, hidden-Markov smoothing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def states(value: Column, present: float, absent: float) -> Column:
    """P at ``present`` or more, A at ``absent`` or less, U between, - where nothing was seen (null or NaN)."""
    return F.when(value.isNull() | F.isnan(value), F.lit("-")).when(value >= present, F.lit("P")).when(value <= absent, F.lit("A")).otherwise(F.lit("U"))


def runs(rows: DataFrame, keys: list[str], order: list[str], state: str) -> DataFrame:
    """Maximal runs of one state: keys, state, n, and the first and last of the first order column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    change = F.when(F.col(state).eqNullSafe(F.lag(state).over(w)), 0).otherwise(1)
    numbered = rows.withColumn("_c", change).withColumn("_run", F.sum("_c").over(w))
    return numbered.groupBy(*keys, "_run", state).agg(F.count(F.lit(1)).alias("n"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last")).drop("_run")


def validity_intervals(rows: DataFrame, key: str, epoch: str, state: str, least_seen: int = 3) -> DataFrame:
    """Class and interval of each entity's series (one row an epoch; - is unseen).

    The interval ends at the last P and starts at the first P after the last A before it. Too few seen epochs give
    INSUFFICIENT, no P or A ALL_UNSURE, no P ABSENT_ALL; else the runs of P and A decide: P alone STABLE_PRESENT (or
    PRESENT_WITH_GAPS if a U was seen), A P ESTABLISHED, P A LOST, more FLICKERING. An entity's epochs are few, so they are
    one array."""
    seq = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(epoch).alias("e"), F.col(state).alias("s")))).alias("q"))
    seen = F.filter("q", lambda x: x["s"] != "-")
    text = F.array_join(F.transform(F.filter("q", lambda x: x["s"].isin("P", "A")), lambda x: x["s"]), "")
    kinds = F.regexp_replace(F.regexp_replace(text, "P+", "P"), "A+", "A")
    last_p = F.array_max(F.transform(F.filter("q", lambda x: x["s"] == "P"), lambda x: x["e"]))
    first_p = F.array_min(F.transform(F.filter("q", lambda x: x["s"] == "P"), lambda x: x["e"]))
    seq = seq.withColumns({"_seen": F.size(seen), "_kinds": kinds, "_last": last_p, "_first": first_p})
    last_a = F.array_max(F.transform(F.filter("q", lambda x: (x["s"] == "A") & (x["e"] < F.col("_last"))), lambda x: x["e"]))
    seq = seq.withColumn("_a", last_a)
    start = F.array_min(F.transform(F.filter("q", lambda x: (x["s"] == "P") & (F.col("_a").isNull() | (x["e"] > F.col("_a")))), lambda x: x["e"]))
    kind = (
        F.when(F.col("_seen") < least_seen, F.lit("INSUFFICIENT")).when(F.col("_kinds") == "", F.lit("ALL_UNSURE")).when(F.col("_first").isNull(), F.lit("ABSENT_ALL"))
        .when(F.col("_kinds") == "P", F.when(F.exists("q", lambda x: x["s"] == "U"), F.lit("PRESENT_WITH_GAPS")).otherwise(F.lit("STABLE_PRESENT")))
        .when(F.col("_kinds") == "AP", F.lit("ESTABLISHED")).when(F.col("_kinds") == "PA", F.lit("LOST")).otherwise(F.lit("FLICKERING"))
    )
    ok = (F.col("_seen") >= least_seen) & F.col("_first").isNotNull()
    return seq.select(key, kind.alias("class"), F.when(ok, start).alias("valid_from"), F.when(ok, F.col("_last")).alias("valid_to"), F.col("_first").alias("first_present"), F.col("_last").alias("last_present"))


def triples(rows: DataFrame, key: str, epoch: str, state: str) -> DataFrame:
    """Census of the states of three consecutive epochs."""
    w = Window.partitionBy(key).orderBy(epoch)
    t = rows.select(F.concat(F.lag(state, 2).over(w), F.lag(state).over(w), F.col(state)).alias("triple"))
    return t.filter("triple IS NOT NULL").groupBy("triple").agg(F.count(F.lit(1)).alias("n"))


def transitions(rows: DataFrame, key: str, epoch: str, state: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(epoch)
    t = rows.select(F.lag(state).over(w).alias("from_state"), F.col(state).alias("to_state"))
    return t.filter("from_state IS NOT NULL").groupBy("from_state", "to_state").agg(F.count(F.lit(1)).alias("n"))


def close_gaps(rows: DataFrame, keys: list[str], order: str, value: str, most: int) -> DataFrame:
    """Fills runs of 0 of up to ``most`` rows that have a 1 on both sides."""
    w = Window.partitionBy(*keys).orderBy(order)
    ahead = Window.partitionBy(*keys).orderBy(F.desc(order))
    pos = rows.withColumn("_i", F.row_number().over(w))
    one = F.when(F.col(value) == 1, F.col("_i"))
    near = pos.withColumns({"_l": F.last(one, True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_r": F.last(one, True).over(ahead.rowsBetween(Window.unboundedPreceding, 0))})
    filled = F.when((F.col(value) == 0) & (F.col("_r") - F.col("_l") - 1 <= most), F.lit(1)).otherwise(F.col(value))
    return near.withColumn("closed", filled).drop("_i", "_l", "_r")


def heal_tier(before: Column, at: Column, after: Column, last_survey: int, blind: int = 3) -> Column:
    """BLIND where either flank is ``blind`` years away or more, whatever else holds; else HEAL if the bracket ends by the last survey, else REVIEW.

    Null at a series' ends, which have no bracket."""
    return F.when(before.isNull() | after.isNull(), F.lit(None)).when(F.greatest(at - before, after - at) >= blind, F.lit("BLIND")).when(after <= last_survey, F.lit("HEAL")).otherwise(F.lit("REVIEW"))


def heal(rows: DataFrame, keys: list[str], epoch: str, value: str, last_survey: int, blind: int = 3) -> DataFrame:
    """An absent epoch between two present ones: 0 becomes 1 in tier HEAL and 255 (unknown) in the others; nothing else changes."""
    w = Window.partitionBy(*keys).orderBy(epoch)
    tier = heal_tier(F.lag(epoch).over(w), F.col(epoch), F.lead(epoch).over(w), last_survey, blind)
    bracketed = (F.col(value) == 0) & (F.lag(value).over(w) == 1) & (F.lead(value).over(w) == 1)
    return rows.withColumn("tier", tier).withColumn("healed", F.when(bracketed & (F.col("tier") == "HEAL"), 1).when(bracketed, 255).otherwise(F.col(value)))


def moving_average(rows: DataFrame, keys: list[str], order: str, value: str, half: int) -> DataFrame:
    """Centred mean over ``2 * half + 1`` rows, over those that exist at the ends."""
    return rows.withColumn("smooth", F.round(F.avg(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(-half, half)), 6))


def successive_variance(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Variance from successive differences: the sum of their squares over 2 (n - 1)."""
    d = rows.select(*keys, (F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(order))).alias("_d"))
    return d.groupBy(*keys).agg(F.count("_d").alias("n_steps"), F.round(F.try_divide(F.sum(F.col("_d") * F.col("_d")), F.lit(2) * F.count("_d")), 6).alias("var"))


def terminal_absence(rows: DataFrame, key: str, epoch: str, state: str) -> DataFrame:
    """First epoch of the run of A at an entity's end; null if it doesn't end in A."""
    down = Window.partitionBy(key).orderBy(F.desc(epoch)).rowsBetween(Window.unboundedPreceding, 0)
    t = rows.withColumn("_open", F.min((F.col(state) == "A").cast("int")).over(down))
    return t.groupBy(key).agg(F.min(F.when(F.col("_open") == 1, F.col(epoch))).alias("terminal_start"))


def hmm(rows: DataFrame, key: str, epoch: str, symbol: str, start: list[float], move: list[list[float]], emit: dict[str, list[float]]) -> DataFrame:
    """Posterior of each hidden state and the most likely path of each entity's symbols; a symbol without emissions says nothing.

    Entities are grouped whole (their epochs are few) into one array each; a task smooths all entities of a batch that have the same
    number of epochs at once, in log space, ties to the lower state."""
    n = len(start)
    s, m = np.log(np.array(start)), np.log(np.array(move))
    lse = np.logaddexp.reduce

    def smooth(symbols: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(posteriors, paths) of series of one length: entity, epoch, state."""
        e = np.log(np.array([[emit.get(x, [1.0] * n) for x in row] for row in symbols]))
        k, t, _ = e.shape
        a, b, v, back = np.empty((k, t, n)), np.zeros((k, t, n)), np.empty((k, t, n)), np.zeros((k, t, n), int)
        a[:, 0] = v[:, 0] = s + e[:, 0]
        for i in range(1, t):
            a[:, i] = lse(a[:, i - 1, :, None] + m, axis=1) + e[:, i]
            step = v[:, i - 1, :, None] + m
            back[:, i] = step.argmax(axis=1)
            v[:, i] = step.max(axis=1) + e[:, i]
        for i in range(t - 2, -1, -1):
            b[:, i] = lse(m + (e[:, i + 1] + b[:, i + 1])[:, None, :], axis=2)
        post = np.exp(a + b - lse(a + b, axis=2)[:, :, None])
        path = np.empty((k, t), int)
        path[:, -1] = v[:, -1].argmax(axis=1)
        for i in range(t - 1, 0, -1):
            path[:, i - 1] = back[np.arange(k), i, path[:, i]]
        return post, path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            series = batch["q"].to_pylist()
            sizes = np.array([len(q) for q in series])
            for t in np.unique(sizes):
                at = np.flatnonzero(sizes == t)
                post, path = smooth([[x["s"] for x in series[i]] for i in at])
                entity = batch["k"].take(pa.array(np.repeat(at, t)))
                epochs = pa.array([x["e"] for i in at for x in series[i]], batch.schema.field("q").type.value_type.field("e").type)
                flat = post.reshape(-1, n).round(6)
                yield pa.RecordBatch.from_arrays([entity, epochs, pa.array(path.ravel()), *(pa.array(flat[:, j].copy()) for j in range(n))], [key, epoch, "path", *(f"p{j}" for j in range(n))])

    kinds = dict(rows.dtypes)
    schema = f"`{key}` {kinds[key]}, `{epoch}` {kinds[epoch]}, path long, " + ", ".join(f"p{k} double" for k in range(n))
    whole = rows.groupBy(F.col(key).alias("k")).agg(F.array_sort(F.collect_list(F.struct(F.col(epoch).alias("e"), F.col(symbol).alias("s")))).alias("q"))
    return whole.mapInArrow(run, schema)


def trajectories(rows: DataFrame, key: str, epoch: str, state: str) -> DataFrame:
    """NEVER_SEEN, LOST (absent after the last P), GAINED (absent before the first P), FLICKERING (absent between), else PERSISTENT; U is unknown."""
    q = rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(epoch).alias("e"), F.col(state).alias("s")))), lambda x: x["s"]).alias("h"))
    first = F.array_position("h", "P").cast("int")
    last = F.size("h") + 1 - F.array_position(F.reverse("h"), "P").cast("int")
    part = lambda a, n: F.array_contains(F.slice("h", a, F.greatest(n, F.lit(0))), "A")
    kind = F.when(first == 0, "NEVER_SEEN").when(part(last + 1, F.size("h") - last), "LOST").when(part(F.lit(1), first - 1), "GAINED").when(part(F.greatest(first, F.lit(1)), last - first), "FLICKERING").otherwise("PERSISTENT")
    return q.select(key, kind.alias("trajectory"))


def presence_intervals(rows: DataFrame, key: str, epoch: str, value: str, epochs: int, present: float = 0.5, absent: float = 0.15) -> DataFrame:
    """First and last epoch (from 0) with a posterior of ``present`` or more, and the nearest ones outside that are surely absent; -1 where
    none was ever seen, and ``epochs`` where none comes after."""
    seen, gone = F.col(value) >= present, F.col(value) <= absent
    ends = rows.groupBy(key).agg(F.min(F.when(seen, F.col(epoch))).alias("_f"), F.max(F.when(seen, F.col(epoch))).alias("_l"))
    w = rows.join(ends, key).groupBy(key, "_f", "_l").agg(F.max(F.when(gone & (F.col(epoch) < F.col("_f")), F.col(epoch))).alias("_lo"), F.min(F.when(gone & (F.col(epoch) > F.col("_l")), F.col(epoch))).alias("_hi"))
    lo, hi, ever = F.coalesce("_lo", F.lit(-1)), F.coalesce("_hi", F.lit(epochs)), F.col("_f").isNotNull()
    or_not = lambda c: F.when(ever, c).otherwise(-1)
    return w.select(key, or_not(F.col("_f")).alias("first_seen"), or_not(F.col("_l")).alias("last_seen"), or_not(lo).alias("first_lo"), or_not(hi).alias("last_hi"), or_not(F.col("_f") - lo).alias("first_width"), or_not(hi - F.col("_l")).alias("last_width"))
