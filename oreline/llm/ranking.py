"""Ranked lexical search of items over all documents: thresholds from stored term impacts, terms pruned by suffix bounds, exact scores.

Each term keeps its ``k`` highest impacts. An item's k-th score is at least the k-th impact of any of its terms, as ``k`` documents have
that from this term alone. An item's terms are ordered by their highest impact; the terms from some place on cannot reach the
threshold even all together, so only documents with a term before it are candidates, and only those whose impacts so far plus the
bound of the rest reach the threshold are scored in full. Tasks raise their thresholds by the k-th score that they hold themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, discard, materialize

_TERM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if c in _TERM else 32 for c in range(256))  # A-Z to a-z, all that ends a term to a space
CELLS = 1 << 22  # of the impact matrix of one block of documents


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of bytes from 128, with A-Z lower-cased."""
    return (text or b"").translate(TERMS).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            terms = [sorted(set(terms_of(t))) for t in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "item_id long, terms array<binary>").withColumn("item_row", F.monotonically_increasing_id())


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """A row a document that has a term: its length in terms, and its terms of the vocabulary with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, get = max(1, len(vocabulary)), vocabulary.get
        for batch in blocks(batches, "text"):
            cut = [terms_of(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
            n = np.array([len(t) for t in cut], np.int64)
            known = np.fromiter((get(w, -1) for t in cut for w in t), np.int64, int(n.sum()))
            code = (np.repeat(np.arange(len(n)), n) * size + known)[known >= 0]
            code, tf = np.unique(code, return_counts=True)
            held = np.bincount(code // size, minlength=len(n))
            offsets = pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (code % size, tf)]
            out = pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>")


def _impact_blocks(batches: Iterator[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int) -> Iterator[tuple[list, np.ndarray]]:
    """(doc ids, impacts as a matrix of terms by documents) for some documents at a time."""
    most = max(16, CELLS // max(1, len(weights)))
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            held = part["terms"].value_lengths().to_numpy(zero_copy_only=False)
            term, tf = (part[c].flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "tfs"))
            doc = np.repeat(np.arange(part.num_rows), held)
            m = np.array([50 + 50 * n * n_docs // n_terms for n in part["n"].to_pylist()], np.int64)  # the product may pass 64 bits
            impacts = np.zeros((len(weights), part.num_rows), np.int64)
            impacts[term, doc] = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
            yield part["doc_id"].to_pylist(), impacts


def _search_block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """(item_row, doc_id, score, rank) of some items against all documents."""
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in items for t in r["terms"]}))}
    size = len(vocabulary)
    postings = materialize(_postings(docs, vocabulary), "ranking-postings")
    totals = postings.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = totals["docs"], totals["terms"]
    weights = np.zeros(size, np.int64)
    for r in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():  # a row a term of this block of items
        weights[r["term"]] = term_weight(n_docs, r["df"])

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((size, 0), np.int64)
        for _, impacts in _impact_blocks(batches, weights, n_docs, n_terms):
            best = np.concatenate([best, impacts], axis=1)
            if best.shape[1] > k:
                best = np.partition(best, best.shape[1] - k, axis=1)[:, -k:]
        term, place = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(best[term, place])], ["term", "impact"])

    order = Window.partitionBy("term").orderBy(F.desc("impact"))
    stored = postings.mapInArrow(highest, "term long, impact long").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    most, kth = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in stored.groupBy("term").agg(F.max("impact").alias("most"), F.min(F.when(F.col("place") == k, F.col("impact"))).alias("kth")).collect():
        most[r["term"]], kth[r["term"]] = r["most"], r["kth"] or 0

    plans = []
    for r in items:
        terms = np.array([vocabulary[bytes(t)] for t in r["terms"]], np.int64)
        terms = terms[np.argsort(-most[terms], kind="stable")]
        suffix = np.concatenate([np.cumsum(most[terms][::-1])[::-1], [0]])  # what the terms from each place on can add at the most
        plans.append((r["item_row"], terms, suffix, max(1, int(kth[terms].max(initial=0)))))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, list]] = [(np.zeros(0, np.int64), [])] * len(plans)
        least = [p[3] for p in plans]
        for ids, impacts in _impact_blocks(batches, weights, n_docs, n_terms):
            for i, (_, terms, suffix, _) in enumerate(plans):
                first = int(np.searchsorted(-suffix, -least[i], side="right"))  # terms from here on don't reach the threshold
                score = impacts[terms[:first]].sum(axis=0)
                some = np.flatnonzero((score > 0) & (score + suffix[first] >= least[i]))
                if not len(some):
                    continue
                score = score[some] + impacts[np.ix_(terms[first:], some)].sum(axis=0)
                some, score = some[score >= least[i]], score[score >= least[i]]
                both, own = np.concatenate([held[i][0], score]), held[i][1] + [ids[j] for j in some]
                if len(both) > k:
                    keep = sorted(range(len(both)), key=lambda j: (-both[j], own[j] is None, own[j] or 0))[:k]
                    both, own = both[keep], [own[j] for j in keep]
                    least[i] = max(least[i], int(both[-1]))
                held[i] = both, own
        for (row, *_), (score, ids) in zip(plans, held):
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(ids), pa.int64()), pa.array(ids, pa.int64()), pa.array(score)], ["item_row", "doc_id", "score"])

    order = Window.partitionBy("item_row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = postings.mapInArrow(candidates, "item_row long, doc_id long, score long")
    found = materialize(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "ranking-found")
    discard(postings)
    return found


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, pairs_at_once: int = 50_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` documents of highest score for each item: item_col, rank (from 1), id_col, score.

    Terms are runs of ASCII letters and digits and of other characters than ASCII, only A-Z lower-cased. A term weighs
    floor(1000 ln((2 N + 2) / (2 df + 1))) over the N documents with a term; its impact grows with its count in the document and falls
    with the document's length against the mean. Scores are whole numbers and exact; those of 0 are left out.

    Items are asked in blocks of about ``pairs_at_once`` pairs of item and term, dealt by hash, so that a task and the driver hold the
    terms of one block; each block reads the documents once and its own postings twice.

    Null and empty texts have no terms: such documents count nowhere and such items give no rows. Rows with one item id, repeated rows
    included, are ranked apart under that id. Documents of one id, null ids too (last among equal scores), are documents of
    their own. An empty table gives no rows; other columns take no part.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = materialize(_item_terms(items, item_col, item_text), "ranking-items")
    pairs = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = -(-pairs // pairs_at_once)
    out = spark.createDataFrame([], "item_row long, doc_id long, score long, rank int")
    for b in range(n):
        block = asked.filter((F.pmod(F.xxhash64("item_row"), F.lit(n)) == b) & (F.size("terms") > 0)).collect()
        if block:
            out = out.unionByName(_search_block(texts, block, k))
    out = out.join(asked.select("item_row", "item_id"), "item_row")
    return out.select(F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc_id").alias(id_col), "score")
