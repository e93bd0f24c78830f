"""The corpus pipeline: language ID, near-duplicate removal, repeated-passage removal, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the columns of
``documents``. No stage is expressible in SQL (a trained model, MinHash buckets with exact components, sentence hashes, a
linear program), so ``ORACLE_SQL`` is None and the tests compare each stage with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm.common import discard, materialize
from oreline.llm.langid import fit, identify_languages
from oreline.llm.neardup import near_duplicates
from oreline.llm.packing import pack_documents
from oreline.llm.spans import dedup_spans


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have a language; those without a letter are rejected, and only those where no row has a label to learn from.

    Null and empty texts have no letter and go. Repeated rows and null ids are judged by their text like any other; an empty
    table gives no rows; further columns come along."""
    model = fit(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    named = identify_languages(docs, model, whole_rows=True)
    return named.filter("lang_pred <> 'und'").select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each group of near duplicates, once; documents without an id stay.

    Rows of one id with different texts are different documents, each judged by its own text: both stay if neither is near
    another kept one. Rows that agree in id and shingles are one document, of which the row with the least text hash stays.
    Texts without words are near nothing: of rows that agree in id and text one stays. An empty table gives no rows; further
    columns come along."""
    keyed = docs.select(F.struct("*").alias("doc"), F.col("doc_id"), F.col("text"), F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()).alias("row_key"))
    judged = near_duplicates(keyed, carry=["row_key"]).filter("kept AND doc_id IS NOT NULL")
    blank = F.col("n_shingles") == 0
    group = [F.when(blank, F.col("row_key")).otherwise(F.col("set_lo")).alias("set_lo"), F.when(blank, 0).otherwise(F.col("set_hi")).alias("set_hi")]
    stays = judged.groupBy("doc_id", *group).agg(F.min("row_key").alias("row_key")).select("doc_id", "row_key")
    once = keyed.drop("text").join(stays, ["doc_id", "row_key"], "left_semi").dropDuplicates(["doc_id", "row_key"])
    return once.select("doc.*").unionByName(docs.filter("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts; a document that has nothing but white space left goes with them.

    Null and empty texts, and rows without an id, stay as they are. Rows of one id are one document in several rows: they aren't
    repeats of each other. ``n_chars`` follows a text that changed. An empty table gives no rows; further columns come along."""
    cut = dedup_spans(docs, whole_rows=True).filter(F.expr(r"n_removed = 0 OR text RLIKE '\\S'"))
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("text")).otherwise(F.col("doc.text")), "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("doc.n_chars"))}
    return cut.select(*(new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col("doc")[c].alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all that is left: a row a piece. Null and empty texts have the end id alone, repeated rows and null ids keep their
    pieces, an empty table gives no rows."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row; each one's table is deleted when the next is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
            discard(before)
    return docs
