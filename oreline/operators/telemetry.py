"""Telemetry of runs: recordings merged from several files, launches attributed to sessions, step minutes, parsed logs, sampled beacons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written


def merge_recordings(rows: DataFrame, session: str, file: str, ts: str) -> DataFrame:
    """Rows of each session's recording: its longest file passes whole, its own repeats included; other files add only instants that it
    lacks, each instant once from the first file that has it. Of files as long, the name without a copy number, then the least, leads."""
    n = rows.groupBy(session, file).agg(F.count(F.lit(1)).alias("_n"))
    lead = [F.desc("_n"), F.col(file).rlike(r" \(\d+\)").asc(), F.col(file).asc()]
    place = n.withColumn("_place", F.row_number().over(Window.partitionBy(session).orderBy(*lead))).drop("_n")
    placed = rows.join(place, [session, file])
    first = placed.groupBy(session, ts).agg(F.min("_place").alias("_first"))
    kept = placed.join(first, [session, ts]).filter(F.col("_place") == F.col("_first"))
    main = kept.filter("_place = 1").drop("_place", "_first")
    return main.unionByName(kept.filter("_place > 1").dropDuplicates([session, ts]).drop("_place", "_first"))


def holding(points: DataFrame, spans: DataFrame, at: str, start: str, end: str) -> DataFrame:
    """``points`` with ``n_holding``, how many spans hold each: the starts up to it less the ends before it.

    Both are counted by day: a running total over days, and of a point's own day the few instants before it."""
    day = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / 86_400)
    marks = spans.select(F.col(start).alias("_t"), F.lit(1).alias("_c")).unionByName(spans.select(F.col(end).alias("_t"), F.lit(-1).alias("_c")))
    marks = marks.groupBy("_t", "_c").agg(F.sum("_c").alias("_n")).withColumn("_day", day("_t"))
    asked = points.select(at).distinct().withColumn("_day", day(at))
    days = marks.groupBy("_day").agg(F.sum("_n").alias("_n")).unionByName(asked.select("_day", F.lit(0).cast("long").alias("_n")).distinct()).groupBy("_day").agg(F.sum("_n").alias("_n"))
    before = days.select("_day", (F.sum("_n").over(Window.orderBy("_day")) - F.col("_n")).alias("_before"))  # a row a day
    inside = F.when((F.col("_c") > 0) & (F.col("_t") <= F.col(at)), F.col("_n")).when((F.col("_c") < 0) & (F.col("_t") < F.col(at)), F.col("_n")).otherwise(0)
    own = asked.join(marks, "_day", "left").groupBy(at, "_day").agg(F.sum(F.coalesce(inside, F.lit(0))).alias("_own"))
    return points.join(own.join(before, "_day").select(at, (F.col("_before") + F.col("_own")).alias("n_holding")), at, "left")


def attribute_launches(rows: DataFrame, printed: DataFrame, spans: DataFrame, session: str, ts: str, print_: str, bucket_days: int = 100, rows_a_task: int = 1_000_000, most_broadcast: int = 200_000) -> DataFrame:
    """Each session's launch: of the launches whose span holds its first row, the one whose printed outcomes match most of its rows (ties
    to the later start, then the greater name); none if nothing matches. With the numbers of candidates and of tied ones.

    printed: launch, fingerprint; spans: launch, start, end. Launches of one span and the same prints are one, with their number. A
    session's distinct prints meet launches by print and by a bucket of time that the span touches, so only launches that may count
    and match anything make a row. Sessions are dealt once to tasks of about ``rows_a_task`` rows and stay there: a task's memory
    doesn't grow with the table."""
    bucket = lambda c: F.floor(F.unix_seconds(c.cast("timestamp")) / (86_400 * bucket_days))
    sets = printed.groupBy("launch").agg(F.array_sort(F.collect_set("fingerprint")).alias("_prints"))
    alike = spans.join(sets, "launch").groupBy("start", "end", "_prints").agg(F.max("launch").alias("launch"), F.count(F.lit(1)).alias("_same"))
    offered = alike.select("start", "end", "launch", "_same", F.explode("_prints").alias("fingerprint")).withColumn("_b", F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("end")))))
    offered = written(offered.withColumnsRenamed({"fingerprint": "_f", "_b": "_ob"}), "offered-launches")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // rows_a_task))
    dealt = lambda d: d.repartition(tasks, session)
    w = Window.partitionBy(session)
    each = dealt(rows.select(session, F.col(print_).alias("fingerprint"), ts)).groupBy(session, "fingerprint").agg(F.min(ts).alias("_first"), F.count(F.lit(1)).alias("_n"))
    each = each.withColumns({"_first": F.min("_first").over(w), "n_rows": F.sum("_n").over(w)}).withColumn("_b", bucket(F.col("_first")))
    small = offered.count() <= most_broadcast
    meets = (F.col("fingerprint") == F.col("_f")) & (F.col("_b") == F.col("_ob")) & (F.col("_first") >= F.col("start")) & (F.col("_first") <= F.col("end")) & F.col(session).isNotNull()
    held = each.join(F.broadcast(offered) if small else offered, meets, "left")
    held = held if small else dealt(held)
    of = [session, "_first", "n_rows"]
    scored = held.groupBy(*of, "launch", "start", "_same").agg(F.sum(F.when(F.col("_same").isNotNull(), F.col("_n"))).alias("_m"))
    alike = scored.groupBy(*of, "_m").agg(F.sum("_same").alias("_tied"), F.max(F.struct("start", "launch")).alias("_l"))
    best = alike.groupBy(*of).agg(F.max(F.when(F.col("_m").isNotNull(), F.struct("_m", "_l", "_tied"))).alias("_best"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return holding(best, spans, "_first", "start", "end").select(session, "n_rows", F.col("_best._l.launch").alias("launch"), none(F.col("_best._m")).alias("matches"), none(F.col("n_holding")).alias("n_candidates"), none(F.col("_best._tied")).alias("n_tied"))


def silences(rows: DataFrame, key: str, ts: str, silent_seconds: int, until: Column) -> DataFrame:
    """(key, action, at): ``up`` at a key's first beacon and at the first after a silence, ``silent`` once when ``silent_seconds`` have
    passed without one; after a key's last beacon only if that is before ``until``. The streaming form is ``streams.silences``."""
    w = Window.partitionBy(key).orderBy(ts)
    gap = F.make_dt_interval(secs=F.lit(silent_seconds))
    b = rows.select(key, ts).distinct().withColumns({"_before": F.lag(ts).over(w), "_after": F.lead(ts).over(w)})
    up = b.filter(F.col("_before").isNull() | (F.col(ts) - F.col("_before") > gap)).select(key, F.lit("up").alias("action"), F.col(ts).alias("at"))
    end = F.col(ts) + gap
    silent = b.filter(F.when(F.col("_after").isNull(), end < until).otherwise(F.col("_after") - F.col(ts) > gap)).select(key, F.lit("silent").alias("action"), end.alias("at"))
    return up.unionByName(silent)


def step_minutes(rows: DataFrame, keys: list[str], seq: str, state: str, minutes: str, refused: DataFrame) -> DataFrame:
    """Minutes of the last OK row of each key that has minutes, or null and a note: the latest state, or that another launch's rows were
    refused. refused: keys, n."""
    ok = (F.col(state) == "OK") & F.col(minutes).isNotNull()
    a = rows.groupBy(*keys).agg(F.max(F.when(ok, F.struct(seq, minutes))).alias("_ok"), F.max(F.struct(seq, state)).alias("_last"))
    j = a.join(refused.select(*keys, F.col("n").alias("_n")), keys, "full")
    note = F.when(F.col("_ok").isNotNull(), F.lit("")).when(F.col("_last").isNotNull(), F.concat(F.lit("latest state "), F.col(f"_last.{state}"))).otherwise(F.concat(F.lit("refused "), F.col("_n").cast("string")))
    return j.select(*keys, F.col(f"_ok.{minutes}").alias("minutes"), note.alias("note"))


def log_events(lines: DataFrame, keys: list[str], order: str, text: str, starts: str, ends: str) -> DataFrame:
    """Typed events of logs: a line that ``starts`` opens a block, one that ``ends`` closes the last open one; each block with its first
    and last line, and the label that the pattern's first group names. A block that another opens before its end is cut."""
    w = Window.partitionBy(*keys).orderBy(order)
    kind = F.when(F.col(text).rlike(starts), F.lit("start")).when(F.col(text).rlike(ends), F.lit("end"))
    marks = lines.withColumn("_k", kind).filter("_k IS NOT NULL").withColumns({"_next": F.lead("_k").over(w), "_at": F.lead(order).over(w), "_line": F.lead(text).over(w)})
    closed = F.col("_next") == "end"
    return marks.filter("_k = 'start'").select(*keys, F.col(order).alias("first"), F.when(closed, F.col("_at")).alias("last"), F.regexp_extract(text, starts, 1).alias("label"), F.when(closed, F.regexp_extract("_line", ends, 1)).otherwise(F.lit("cut")).alias("outcome"))


def with_previous(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """Each beacon with the values of the one before it of the same key."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.select("*", *(F.lag(c).over(w).alias(f"prev_{c}") for c in columns))


def split_attributable(rows: DataFrame, session: str) -> tuple[DataFrame, DataFrame]:
    """Rows that name their session, and those that don't."""
    named = F.coalesce(F.trim(F.col(session)) != "", F.lit(False))
    return rows.filter(named), rows.filter(~named)


def elapsed_years(a: Column, b: Column, a_year: Column, b_year: Column) -> Column:
    """struct(years, basis): between dates where both are known, else between the years' labels."""
    dated = a.isNotNull() & b.isNotNull()
    return F.struct(F.when(dated, F.round(F.datediff(b, a) / 365.25, 6)).otherwise((b_year - a_year).cast("double")).alias("years"), F.when(dated, F.lit("acquisition_date")).otherwise(F.lit("year_label")).alias("basis"))
