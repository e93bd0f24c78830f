"""Queries of sources and sinks: tables written out as ledgers, beacons, logs and features, and read back with their defects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.storage import place
from ..sources import files as S
from .base import Tables, query

_LEDGER = T.StructType().add("key", T.LongType()).add("state", T.StringType()).add("minutes", T.DoubleType())


def _ledger(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select(k.alias("key"), F.when(k % 4 > 0, F.col("o_orderstatus")).alias("state"), F.when(k % 7 > 0, F.round("o_totalprice", 1)).alias("minutes"))


@query("SELECT o_orderkey AS key, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS state, CASE WHEN o_orderkey % 7 > 0 THEN round(o_totalprice, 1) END AS minutes FROM orders")
def csv_round_trip(t: Tables) -> DataFrame:
    """A ledger written in fixed columns and read back: a blank is null."""
    spark, at = t.orders.sparkSession, place(t.orders.sparkSession, "ledger-csv")
    S.write_csv(_ledger(t), at, _LEDGER.fieldNames())
    return S.read_csv(spark, at, _LEDGER)[0].drop("_src")


@query("""WITH l AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 10 = 3 THEN 'comment' WHEN o_orderkey % 10 = 5 THEN 'defect' ELSE 'row' END AS kind FROM orders)
SELECT kind, count(*) AS n, sum(CASE WHEN kind = 'row' THEN key END)::BIGINT AS total FROM l WHERE kind <> 'comment' GROUP BY kind""")
def ledger_defects(t: Tables) -> DataFrame:
    """Status files with comment lines and broken rows: what doesn't fit is a relation of its own."""
    spark, at = t.orders.sparkSession, place(t.orders.sparkSession, "ledger-broken")
    k = F.col("o_orderkey").cast("string")
    key = F.when(F.col("o_orderkey") % 10 == 3, F.concat(F.lit("# note "), k)).when(F.col("o_orderkey") % 10 == 5, F.concat(F.lit("key"), k)).otherwise(k)
    lines = t.orders.select(key.alias("key"), F.lit("OK").alias("state"), F.lit("2.5").alias("minutes"))
    lines.write.option("header", True).option("comment", "|").csv(at)  # else the writer would quote the comments
    rows, defects = S.read_csv(spark, at, _LEDGER)
    n = rows.agg(F.lit("row").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("key").alias("total"))
    return n.unionByName(defects.agg(F.lit("defect").alias("kind"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("total")))


@query("""SELECT o_orderkey AS key, o_orderstatus AS state, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS arm FROM orders""")
def merged_generations(t: Tables) -> DataFrame:
    """Two generations of a ledger, the later one with a further column."""
    spark, old, new = t.orders.sparkSession, place(t.orders.sparkSession, "ledger-old"), place(t.orders.sparkSession, "ledger-new")
    rows = t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("arm"))
    S.write_csv(rows.filter("key % 2 = 1"), old, ["key", "state"])
    S.write_csv(rows.filter("key % 2 = 0"), new, ["key", "state", "arm"])
    two = T.StructType().add("key", T.LongType()).add("state", T.StringType())
    first, second = S.read_csv(spark, old, two)[0], S.read_csv(spark, new, T.StructType([*two.fields, T.StructField("arm", T.StringType())]))[0]
    return S.merge_generations(first, second).select("key", "state", "arm")


@query("""SELECT user_id AS host, event_type AS kind, count(*) AS n, round(sum(CASE WHEN event_id % 3 > 0 THEN value END), 4) AS total, 0 AS broken FROM events WHERE event_id % 8 > 0 GROUP BY ALL
UNION ALL SELECT NULL, 'defect', 0, NULL, count(*)::INT FROM events WHERE event_id % 8 = 0""")
def beacon_lines(t: Tables) -> DataFrame:
    """Beacons as JSON lines; lines that were cut off are defects."""
    spark, at = t.events.sparkSession, place(t.events.sparkSession, "beacons")
    b = t.events.select("event_id", F.col("user_id").alias("host"), F.col("event_type").alias("kind"), F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("value"))
    S.write_json_lines(b.filter("event_id % 8 > 0").drop("event_id"), at)
    cut = b.filter("event_id % 8 = 0").select(F.concat(F.lit('{"host":'), F.col("host").cast("string"), F.lit(',"kind":"')).alias("value"))
    cut.write.mode("append").text(at)
    schema = T.StructType().add("host", T.LongType()).add("kind", T.StringType()).add("value", T.DoubleType())
    rows, defects = S.read_json_lines(spark, at, schema)
    good = rows.groupBy("host", "kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.lit(0).alias("broken"))
    return good.unionByName(defects.agg(F.lit(None).cast("long").alias("host"), F.lit("defect").alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("total"), F.count(F.lit(1)).cast("int").alias("broken")))


@query("SELECT 'step' || (event_id % 6) AS step, round(sum((event_id % 50) / 10.0), 1) AS minutes, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1")
def log_steps(t: Tables) -> DataFrame:
    """A log's step lines among others."""
    spark, at = t.events.sparkSession, place(t.events.sparkSession, "log")
    k = F.col("event_id")
    line = F.when(F.col("event_type") == "click", F.concat(F.lit("[step"), k % 6, F.lit("] done in "), (k % 50 / 10.0).cast("string"), F.lit(" min"))).otherwise(F.concat(F.lit("loss "), k))
    t.events.select(line.alias("value")).write.text(at)
    steps = S.read_log_lines(spark, at, r"^\[(\w+)\] done in ([\d.]+) min$", ["step", "minutes"])
    return steps.groupBy("step").agg(F.round(F.sum(F.col("minutes").cast("double")), 1).alias("minutes"), F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey AS k, o_orderstatus AS s, false AS smaller_taken, true AS larger_taken, 'refused' AS other_columns FROM orders")
def guarded_appends(t: Tables) -> DataFrame:
    """A table appended to under its columns; it is replaced only by one that has grown."""
    spark = t.orders.sparkSession
    at, staging = place(spark, "appended"), place(spark, "staging")
    rows = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    S.append_rows(rows.filter("k % 3 = 0"), at)
    S.append_rows(rows.filter("k % 3 = 1"), at)
    try:
        S.append_rows(rows.select("k"), at)
        other = "taken"
    except ValueError:
        other = "refused"
    smaller = S.replace_if_grown(rows.filter("k % 3 = 0"), at, staging)
    larger = S.replace_if_grown(rows, at, staging)
    return spark.read.parquet(at).select("k", "s", F.lit(smaller).alias("smaller_taken"), F.lit(larger).alias("larger_taken"), F.lit(other).alias("other_columns"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey % 300 AS page, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS flag FROM lineitem), k AS (SELECT *, sha256('{"page":' || page || CASE WHEN flag IS NULL THEN '' ELSE ',"flag":"' || flag || '"' END || '}') AS key FROM r)
SELECT key, count(*) AS n, CASE WHEN any_value(page) % 3 > 0 AND any_value(flag) IS NOT NULL THEN 'page ' || any_value(page) || any_value(flag) END AS answer FROM k GROUP BY key""")
def replayed_requests(t: Tables) -> DataFrame:
    """Requests answered from what was recorded, by the hash of their fields."""
    asked = t.lineitem.select((F.col("l_partkey") % 300).alias("page"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag")).alias("flag"))
    answered = asked.filter("page % 3 > 0 AND flag IS NOT NULL").distinct()
    recorded = answered.select(S.request_key("page", "flag").alias("key"), F.concat(F.lit("page "), "page", "flag").alias("answer"))
    return S.replay(asked, recorded, ["page", "flag"]).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("answer").alias("answer"))


@query("SELECT s_suppkey::VARCHAR AS id, 'Point' AS kind, s_nationkey AS nation, s_name AS name FROM supplier")
def geojson_round_trip(t: Tables) -> DataFrame:
    """Features of a map, one collection a file."""
    spark, at = t.supplier.sparkSession, place(t.supplier.sparkSession, "features")
    k = F.col("s_suppkey")
    geometry = F.struct(F.lit("Point").alias("type"), F.array((k % 90).cast("double"), (k % 45).cast("double")).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), k.cast("string").alias("id"), geometry.alias("geometry"), F.struct(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")).alias("properties"))
    files = t.supplier.select((k % 8).alias("f"), feature.alias("feature")).groupBy("f").agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list("feature").alias("features"))).alias("value"))  # as many as a file holds
    files.write.partitionBy("f").text(at)
    return S.geojson_features(spark, at, "nation bigint, name string").select("id", F.col("geometry.type").alias("kind"), "nation", "name")
