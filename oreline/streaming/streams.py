"""Streaming over growing folders: windows with late data, sessions, the latest beacon of a key, keyed cool-downs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.storage import place


def read_stream(spark: SparkSession, folder: str, schema: str, name_filter: str | None = None, files_a_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    for key, value in (("pathGlobFilter", name_filter), ("maxFilesPerTrigger", files_a_batch)):
        if value is not None:
            reader = reader.option(key, value)
    return reader.parquet(folder)


def windowed(events: DataFrame, ts: str, keys: list[str], size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums of ``value`` in tumbling (or sliding) windows; rows later than ``late`` behind the newest are dropped by the watermark, which bounds the state."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    base = events.withWatermark(ts, late) if events.isStreaming else events
    out = base.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(events: DataFrame, ts: str, keys: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """Sessions that end after ``gap`` without an event."""
    base = events.withWatermark(ts, late) if events.isStreaming else events
    out = base.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def cool_downs(events: DataFrame, key: str, ts: str, kind: str, blocked: str, base_s: int, most_s: int) -> DataFrame:
    """The wait of each key after each batch: doubled by an event of kind ``blocked`` (from base_s to most_s), reset by any other.

    State is two numbers a key and stays: keys are hosts, not users."""

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        wait, seen = state.get if state.exists else (0, 0)
        for pdf in batches:
            for x in pdf.sort_values(ts)[kind]:
                wait = min(most_s, max(base_s, 2 * wait)) if x == blocked else 0
                seen += 1
        state.update((wait, seen))
        yield pd.DataFrame({key: [k[0]], "wait_s": [wait], "seen": [seen]})

    rows = events.select(key, ts, kind)
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {dict(rows.dtypes)[key]}, wait_s long, seen long", "wait_s long, seen long", "update", GroupStateTimeout.NoTimeout)


def silences(events: DataFrame, key: str, ts: str, silent_seconds: int, late: str = "10 minutes") -> DataFrame:
    """(key, action, at): ``up`` at a key's first beacon and at the first after a silence, ``silent`` once when ``silent_seconds`` of event
    time have passed without one.

    A timeout fires when the watermark, ``late`` behind the newest beacon of all keys, has passed the end of the wait; the key's
    state (its last beacon) goes with it, so only keys that are alive hold state. Beacons behind the watermark are dropped, and one
    that isn't newer than its key's last changes nothing. The batch form is ``operators.telemetry.silences``."""
    wait = silent_seconds * 1_000_000

    def rows_of(k: tuple, actions: list[str], at: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({key: pd.Series([k[0]] * len(actions)), "action": pd.Series(actions, dtype="object"), "at": pd.to_datetime(at, unit="us")})

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            yield rows_of(k, ["silent"], np.array([last + wait]))
            return
        last = state.get[0] if state.exists else None
        times = np.unique(np.concatenate([pdf[ts].to_numpy("datetime64[us]").astype(np.int64) for pdf in batches]))
        known = times[times > last] if last is not None else times
        if len(known):
            before = np.concatenate([[known[0] if last is None else last], known[:-1]])
            gone = np.flatnonzero(known - before > wait)
            at = np.column_stack([before[gone] + wait, known[gone]]).ravel()
            actions = ["silent", "up"] * len(gone)
            if last is None:
                at, actions = np.concatenate([known[:1], at]), ["up", *actions]
            last = int(known[-1])
            if actions:
                yield rows_of(k, actions, at)
        state.update((last,))
        state.setTimeoutTimestamp(max((last + wait) // 1000, state.getCurrentWatermarkMs() + 1))

    rows = events.select(key, F.col(ts).cast("timestamp").alias(ts)).withWatermark(ts, late)
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {dict(rows.dtypes)[key]}, action string, at timestamp", "last long", "append", GroupStateTimeout.EventTimeTimeout)


def settled(stream: DataFrame, name: str) -> DataFrame:
    """Runs an append stream over what is there to the end, into a table in the shared folder, each row once."""
    at = place(stream.sparkSession, name)
    q = stream.writeStream.format("parquet").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{at}/rows")


def previous_values(events: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Each beacon with the value of the one before it of its key, over batch ends: the state is a key's last value.

    Beacons of one batch are put in the order of their time; one that comes in a later batch follows what came before."""

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        pdf = pd.concat(list(batches)).sort_values(ts)
        before = [last, *pdf[value].tolist()[:-1]]
        state.update((float(pdf[value].iloc[-1]),))
        yield pd.DataFrame({key: k[0], ts: pdf[ts].tolist(), value: pdf[value].tolist(), "previous": pd.Series(before, dtype="float64")})

    rows = events.select(key, ts, F.col(value).cast("double").alias(value))
    kinds = dict(rows.dtypes)
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {kinds[key]}, {ts} timestamp, {value} double, previous double", "last double", "append", GroupStateTimeout.NoTimeout)


def paced(events: DataFrame, key: str, ts: str, kind: str, codes: str, decay: float = 1.0, times: float = 2.0, ceiling: float = 300.0) -> DataFrame:
    """The pacing delay of each key after each batch: a ``transient`` answer multiplies it, a ``success``, or any other
    answer with a code of 2xx, takes ``decay`` off; the batch form is ``operators.routing.pacing``."""

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        delay, seen = state.get if state.exists else (0.0, 0)
        answers = pd.concat(list(batches)).sort_values(ts)
        for x, fine in zip(answers[kind], answers["_fine"]):
            delay = min(ceiling, max(delay, decay) * times) if x == "transient" else max(0.0, delay - decay) if x == "success" or fine else delay
            seen += 1
        state.update((delay, seen))
        yield pd.DataFrame({key: [k[0]], "answers": [seen], "delay_s": [delay]})

    fine = F.coalesce(F.exists(codes, lambda c: c.between(200, 299)), F.lit(False))
    rows = events.select(key, ts, kind, fine.alias("_fine"))
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {dict(rows.dtypes)[key]}, answers long, delay_s double", "delay double, seen long", "update", GroupStateTimeout.NoTimeout)


def published(samples: DataFrame, session: str, ts: str, folder: str, checkpoint: str, every: str = "1 minute"):
    """A sampler's rows as they come, published to a folder a session by the minute; each row once, whatever is started again."""
    out = samples.withColumn("minute", F.date_format(F.date_trunc("minute", ts), "yyyyMMddHHmm"))
    return out.writeStream.partitionBy(session).format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(**({"processingTime": every} if every else {"availableNow": True})).start()


def changes(ledger: DataFrame, key: str, seq: str, state: str) -> DataFrame:
    """Rows of a ledger whose state differs from the one before of their key, over batch ends: what a watcher prints."""

    def fold(k: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        last = held.get[0] if held.exists else None
        pdf = pd.concat(list(batches)).sort_values(seq)
        before = pd.Series([last, *pdf[state].tolist()[:-1]], index=pdf.index, dtype="object")
        held.update((pdf[state].iloc[-1],))
        moved = pdf[pdf[state] != before]
        yield pd.DataFrame({key: k[0], seq: moved[seq].tolist(), state: moved[state].tolist()})

    rows = ledger.select(key, F.col(seq).cast("long").alias(seq), F.col(state).cast("string").alias(state))
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {dict(rows.dtypes)[key]}, {seq} long, {state} string", "last string", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, name: str, mode: str, checkpoint: str | None = None) -> DataFrame:
    """Runs a stream over what is there to the end, into the in-memory table ``name`` (for small results and tests)."""
    writer = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    q = writer.start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
