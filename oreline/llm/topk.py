"""Exact top-k inner products by columnar branch-and-bound.

Candidates lie in vertical layout, a row a dimension. Scores are summed block of dimensions by block; after each block a
candidate stays only while its partial score plus the most that the remaining dimensions can add (the product of the
remaining norms) reaches the k-th best lower bound. The survivors are compacted before the next block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

EXACT = 2**53


def integer_vectors(column: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that take part and their vectors floor(scale * x): not null, not empty, all components finite.

    Components of 2**62 or more are an error: their products would not be whole numbers of 64 bits."""
    values = pc.list_flatten(column) if len(column) else pa.array([], pa.float64())
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    flat = np.floor(scale * flat)
    good, ends, rows, out = np.isfinite(flat), np.cumsum(sizes), [], []
    for i in np.flatnonzero(sizes > 0):
        at = slice(ends[i] - sizes[i], ends[i])
        if good[at].all():
            if np.abs(flat[at]).max() >= 2.0**62:
                raise OverflowError("a scaled component does not fit in 64 bits")
            rows.append(i)
            out.append(flat[at].astype(np.int64))
    return np.array(rows, np.int64), out


def _tail_norms(vertical: np.ndarray, cuts: list[int]) -> list[np.ndarray]:
    """Upper bounds of the norms of what follows each cut."""
    squares = vertical.astype(float) ** 2
    return [np.sqrt(squares[c:].sum(axis=0)) * (1 + 1e-9) for c in cuts]


def best_of_chunk(q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vertical: np.ndarray, k: int, block: int) -> tuple[list, list, list]:
    """(query, vector, score) of the k best of a chunk for each query, all ties of the k-th included before the cut by id.

    queries: a row each; vertical: a row a dimension, a column a candidate. All arithmetic is in whole numbers: in doubles
    where no sum can pass 2**53, else in 64-bit integers; scores that could pass those are an error."""
    dims = vertical.shape[0]
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vertical).max(initial=0)) * dims
    if most >= 2.0**62:
        raise OverflowError("scores may not fit in 64 bits")
    kind = np.float64 if most < EXACT else np.int64
    q, v = queries.astype(kind), vertical.astype(kind)
    cuts = [*range(block, dims, block), dims]
    tail_v, tail_q = _tail_norms(v, cuts), _tail_norms(q.T, cuts)
    first = q[:, : cuts[0]] @ v[: cuts[0]]  # the first block for all queries at once
    out_q, out_v, out_s = [], [], []
    for i in range(len(q)):
        alive, partial = np.arange(len(ids)), first[i]
        if (own := np.flatnonzero(ids == q_ids[i])).size:
            alive = np.delete(alive, own)
            partial = np.delete(partial, own)
        for j, cut in enumerate(cuts):
            if j:
                partial = partial + q[i, cuts[j - 1] : cut] @ v[cuts[j - 1] : cut, alive]
            if cut < dims and len(alive) > k:
                room = tail_q[j][i] * tail_v[j][alive] + 1
                floor = np.partition(partial - room, len(alive) - k)[len(alive) - k]
                stay = partial + room >= floor
                alive, partial = alive[stay], partial[stay]
        top = np.lexsort((ids[alive], -partial))[:k]
        out_q += [q_ids[i]] * len(top)
        out_v += ids[alive[top]].tolist()
        out_s += partial[top].astype(np.int64).tolist()
    return out_q, out_v, out_s


def search(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, block: int = 16, queries_at_once: int = 4096, chunk: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows of the highest integer inner product for each query (rows whose id is divisible by ``every``), its own row left out.

    Components are floor(scale * x). Queries go out in blocks of ``queries_at_once``, the only thing that is broadcast; each
    block is one pass over the candidates, which never move: a task cuts its rows to vertical chunks and sends on k rows a
    query and chunk at the most, and a window keeps the k best. Where there are several blocks they run one after another, each
    writes its k rows a query and frees its broadcast, so the driver holds one block and the plan doesn't grow with their number.
    Ties go to the smaller id.

    Returns query_id, rank (from 1), vec_id, score. Vectors that are null, empty or hold null or non-finite components take
    no part, nor do rows with null ids. Vectors of different lengths don't meet. Rows of equal ids are candidates each; for a
    query they are its own row. Of queries with equal ids one asks, the one with the least vector. An empty table gives no rows; other columns
    take no part.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_blocks = max(1, -(-asked.count() // queries_at_once))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)))
    if n_blocks > 1:
        asked = materialize(asked, "topk-queries", partition_by="block")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    done = []
    for b in range(n_blocks):
        got = asked.filter(F.col("block") == b).select("vec_id", "v").toArrow().combine_chunks()  # about queries_at_once rows
        if not got.num_rows:
            continue
        kept, vecs = integer_vectors(got["v"].combine_chunks() if isinstance(got["v"], pa.ChunkedArray) else got["v"], scale)
        q_ids = got["vec_id"].to_numpy()[kept] if len(kept) else np.array([], np.int64)
        by_dim = {}
        for q_id, vec in zip(q_ids.tolist(), vecs):
            by_dim.setdefault(len(vec), ([], []))
            by_dim[len(vec)][0].append(q_id)
            by_dim[len(vec)][1].append(vec)
        shared = spark.sparkContext.broadcast({d: (np.array(i), np.stack(v)) for d, (i, v) in by_dim.items()})

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, chunk):
                    part = batch.slice(at, chunk)
                    some, vecs = integer_vectors(part["v"], scale)
                    ids = part["vec_id"].to_numpy(zero_copy_only=False)[some] if len(some) else np.array([], np.int64)
                    sizes = np.array([len(v) for v in vecs])
                    for d, (q_ids, queries) in shared.value.items():
                        if (mine := np.flatnonzero(sizes == d)).size:
                            cols = best_of_chunk(q_ids, queries, ids[mine], np.ascontiguousarray(np.stack([vecs[i] for i in mine]).T), k, block)
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

        one = best(rows.mapInArrow(run, "query_id long, vec_id long, score long"))
        if n_blocks == 1:
            return one
        done.append(materialize(one, "topk-block")._oreline_path)
        shared.destroy()
    discard(asked)
    schema = "query_id long, rank int, vec_id long, score long"
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)
