"""A search index that stays: postings in files by scope and bucket of token, appended to and pruned at the scan; searches that explain themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from .search import any_term_leg, passage_leg, query_terms, ranked

BUCKETS = 64


def _bucket(token: str):
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def add(docs: DataFrame, folder: str, scope: str, doc_id: str, text: str, generation: int) -> None:
    """Appends documents to the index in ``folder``; what is there isn't read or written again.

    A document that comes again with a later ``generation`` takes the place of its earlier text. Tokens are dealt out by bucket, so an
    append writes a file a bucket; a token of any number of documents is only rows in one."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    each = rows.select("doc", F.explode(tokens("text")).alias("token")).groupBy("token", "doc").agg(F.count(F.lit(1)).alias("tf"))
    placed = each.withColumns({"generation": F.lit(generation), "scope": F.lit(scope), "bucket": _bucket("token")})
    placed.repartition(BUCKETS, "bucket").sortWithinPartitions("bucket", "token").write.mode("append").partitionBy("scope", "bucket").parquet(f"{folder}/postings")
    rows.withColumns({"generation": F.lit(generation), "scope": F.lit(scope)}).write.mode("append").partitionBy("scope").parquet(f"{folder}/texts")


def texts(spark: SparkSession, folder: str, scope: str) -> DataFrame:
    """(doc, text) of each document's latest generation."""
    rows = spark.read.parquet(f"{folder}/texts").filter(F.col("scope") == scope)
    latest = rows.groupBy("doc").agg(F.max("generation").alias("generation"))
    return rows.join(latest, ["doc", "generation"]).select("doc", "text")


def postings(spark: SparkSession, folder: str, scope: str, terms: DataFrame, most_broadcast: int = 200_000) -> DataFrame:
    """(token, doc, tf) of the tokens in ``terms``: only their buckets' files are opened, and of those only the tokens' row groups."""
    wanted = terms.select("token").distinct()
    buckets = [r["bucket"] for r in wanted.select(_bucket("token").alias("bucket")).distinct().collect()]  # at most BUCKETS
    rows = spark.read.parquet(f"{folder}/postings").filter((F.col("scope") == scope) & F.col("bucket").isin(buckets or [-1]))
    small = wanted.limit(most_broadcast + 1).count() <= most_broadcast
    hits = rows.join(F.broadcast(wanted) if small else wanted, "token", "left_semi")
    latest = spark.read.parquet(f"{folder}/texts").filter(F.col("scope") == scope).groupBy("doc").agg(F.max("generation").alias("generation"))
    return hits.join(latest, ["doc", "generation"], "left_semi").select("token", "doc", "tf")


def search(queries: DataFrame, query_id: str, text: str, folder: str, scope: str, limit: int = 20, depth: int = 50, k: int = 60, floor: float = 0.2) -> DataFrame:
    """(query, scope, doc, score, rank_all, rank_any, rank_trigram): the ``limit`` best of a scope by reciprocal-rank fusion of its three
    legs, with the place that each leg gave (null where it didn't find the document)."""
    spark = queries.sparkSession
    index = postings(spark, folder, scope, query_terms(queries, query_id, text))
    bodies = texts(spark, folder, scope).withColumnRenamed("text", text)
    legs = {
        "all": any_term_leg(queries, index, query_id, "doc", text, all_terms=True), "any": any_term_leg(queries, index, query_id, "doc", text),
        "trigram": passage_leg(queries, bodies, query_id, "doc", text, floor),
    }
    found = None
    for name, leg in legs.items():
        rows = ranked(leg, query_id, "doc", depth).select(query_id, "doc", F.lit(name).alias("leg"), "rank")
        found = rows if found is None else found.unionByName(rows)
    places = [F.max(F.when(F.col("leg") == name, F.col("rank"))).alias(f"rank_{name}") for name in legs]
    fused = found.groupBy(query_id, "doc").agg(F.round(F.sum(1 / (k + F.col("rank"))), 8).alias("score"), *places)
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), "doc")
    return fused.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= limit).select(query_id, F.lit(scope).alias("scope"), "doc", "score", *(f"rank_{n}" for n in legs))
