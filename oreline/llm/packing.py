"""Packing by cutting-stock column generation.

The corpus is reduced to a histogram of piece lengths, which has at most ``capacity / grain`` classes however many documents
there are. The driver solves the cutting-stock linear program over that histogram: a simplex basis of patterns (how many
pieces of each class share a sequence), improved by patterns that a knapsack dynamic program prices. Rounded patterns are
then handed out to the pieces by their rank in their class, as joins and window sums.
"""

from __future__ import annotations

import logging
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .common import blocks, materialize

LOG = logging.getLogger(__name__)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value of a multiset of items that fits in ``capacity``, and how often each item is in it (unbounded knapsack)."""
    order = np.argsort(sizes, kind="stable")
    s, v = sizes[order], values[order]
    upto = np.searchsorted(s, np.arange(capacity + 1), side="right")
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := upto[c]:
            gains = best[c - s[:n]] + v[:n]
            j = int(gains.argmax())
            if gains[j] > best[c] + 1e-12:
                best[c], pick[c] = gains[j], j
    counts, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[order[pick[c]]] += 1
            c -= s[pick[c]]
    return float(best[capacity]), counts


def inverted(a: np.ndarray) -> np.ndarray:
    """Inverse by Gauss-Jordan elimination with row pivots, in element-wise steps only.

    A threaded LAPACK call can stall in a driver that also runs a JVM; ``capacity / grain`` rows take a fraction of a second here."""
    m = len(a)
    work = np.hstack([a.astype(float), np.eye(m)])
    for i in range(m):
        pivot = i + int(np.abs(work[i:, i]).argmax())
        if pivot != i:
            work[[i, pivot]] = work[[pivot, i]]
        work[i] /= work[i, i]
        rows = np.flatnonzero(work[:, i])
        rows = rows[rows != i]
        work[rows] -= work[rows, i, None] * work[i]
    return work[:, m:]


def fullest(left: dict[int, float], units: int) -> dict[int, int]:
    """A pattern around the largest class that is left, filled with the largest that fits, each at most as often as it is left."""
    content, room = {}, units
    for c in sorted(left, reverse=True):
        if left[c] > 0 and c <= room:
            content[c] = int(min(room // c, max(1, left[c])))
            room -= c * content[c]
            if not room:
                break
    return content


def solve_cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 5e-4, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a row each, counts by class) and their amounts in the linear program's optimum, up to ``gap``.

    Revised simplex over an explicit inverse basis. The first basis is greedy: the fullest pattern, as often as it takes to use
    up one class, so it is triangular. Each round prices a pattern with the duals by dynamic programming and stops where
    Farley's bound shows the objective within ``gap`` of the optimum. ``rounds`` bounds the driver's work; where it ends the
    search the amounts are still a solution, only one that is not proven to be so near.
    """
    m, at = len(sizes), {int(c): i for i, c in enumerate(sizes)}
    left, patterns, amounts, order = dict(zip(map(int, sizes), map(float, demand))), np.zeros((m, m)), np.zeros(m), []
    for k in range(m):
        content = fullest(left, capacity)
        gone = min(content, key=lambda c: left[c] / content[c])
        amounts[k] = left[gone] / content[gone]
        for c, n in content.items():
            patterns[k, at[c]] = n
            left[c] = max(left[c] - n * amounts[k], 1e-9)
        del left[gone]
        order.append(at[gone])
    assert (patterns[range(m), order] > 0).all() and not np.tril(patterns[:, order], -1).any()
    inverse = inverted(patterns.T)  # of the basis whose columns are the patterns
    value, k = np.inf, -1
    for k in range(rounds):
        duals = inverse.sum(axis=0)  # every pattern costs one sequence
        value, counts = knapsack(sizes, np.maximum(duals, 0), capacity)
        if value <= 1 + 1e-9 or 1 - 1 / value <= gap:
            break
        column = np.einsum("ij,j->i", inverse, counts.astype(float))  # no threaded product either
        usable = np.flatnonzero(column > 1e-5)
        ratios = amounts[usable] / column[usable]
        tied = usable[ratios <= ratios.min() + 1e-7 * (1 + ratios.min())]
        leave = tied[int(column[tied].argmax())]  # of tied rows the largest pivot keeps the inverse exact
        step = amounts[leave] / column[leave]
        amounts = np.maximum(amounts - step * column, 0)
        amounts[leave] = step
        patterns[leave] = counts
        row = inverse[leave] / column[leave]
        inverse -= np.outer(column, row)
        inverse[leave] = row
        if k % 64 == 63:  # rounding errors don't build up
            inverse = inverted(patterns.T)
            amounts = np.maximum(np.einsum("ij,j->i", inverse, demand), 0)
    shown = max(0.0, 1 - 1 / value)
    LOG.info("%s after %d rounds: within %.5f of the optimum", "proven" if shown <= gap else "rounds spent", k + 1, shown)
    return patterns.astype(np.int64), np.maximum(amounts, 0)


def plan_patterns(histogram: dict[int, int], capacity: int, grain: int) -> list[tuple[dict[int, int], int]]:
    """(pieces by class, sequences) that hold every piece of the histogram (class: pieces of up to class * grain ids)."""
    plan: dict[tuple, int] = {}
    units = capacity // grain

    def add(content: dict[int, int], n: int) -> None:
        key = tuple(sorted(content.items(), reverse=True))
        plan[key] = plan.get(key, 0) + n
        for c, k in content.items():
            left[c] -= n * k

    left = dict(histogram)
    if whole := left.get(units):
        add({units: 1}, whole)
    if any(left.values()):
        sizes = np.array(sorted(c for c in left if left[c]), np.int64)
        patterns, amounts = solve_cutting_stock(sizes, np.array([left[c] for c in sizes], float), units)
        for k in np.argsort(-amounts, kind="stable"):
            content = {int(c): int(n) for c, n in zip(sizes, patterns[k]) if n}
            if (n := min([int(amounts[k] + 1e-9), *(left[c] // x for c, x in content.items())])) > 0:
                add(content, n)
        while any(left.values()):  # what rounding leaves: less than a sequence a pattern
            content = fullest(left, units)
            add(content, min(left[c] // k for c, k in content.items()))
    return [(dict(content), n) for content, n in plan.items()]


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """A row a piece. A document is cut only every ``capacity`` ids, so checksums need one pass and ids are never stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.uint32(end_id).tobytes()
        for batch in blocks(batches, "text", 4 << 20):  # the more, the more words repeat
            rows = []
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), enc.encode(batch["text"])):
                raw += end
                n = len(raw) // 4
                for start in range(0, n, capacity):
                    piece = raw[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, grain: int = 4, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", rows_a_bucket: int = 100_000) -> DataFrame:
    """Packs token ids of all documents into sequences of at most ``capacity`` ids.

    Documents longer than a sequence are cut every ``capacity`` ids; whole cuts fill sequences of their own, and the
    remainders are packed by cutting-stock column generation over length classes of ``grain`` ids. ``grain`` bounds the
    driver's program at capacity / grain rows and the padding that a piece can cause at grain - 1 ids.

    Returns a row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts have the end id alone. Repeated rows are documents of their own; null ids are kept. Ties in a class
    are ranked by bucket, id, start and checksum. An empty table gives no rows; other columns take no part. A class may hold
    any share of the pieces: ranks come from counts by (bucket of ids, class), never from one sort of a class.
    """
    spark = docs.sparkSession
    units = capacity // grain
    pieces = materialize(
        tokenized_pieces(docs, tokenizer, capacity, end_id, id_col, text_col).withColumn("class", F.expr(f"cast((length + {grain - 1}) div {grain} as int)")), "pack-pieces"
    )
    histogram = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `units` rows
    buckets = max(1, -(-sum(histogram.values()) // rows_a_bucket))

    slots, given, sequence = [], dict.fromkeys(histogram, 0), 0
    for content, n in plan_patterns(histogram, capacity, grain):
        place = 0
        for c, k in content.items():
            slots.append((c, given[c], k, sequence, place))
            given[c] += n * k
            place += k
        sequence += n
    assert given == histogram
    slots = spark.createDataFrame(slots, "class int, first long, k int, sequence long, place int")  # some classes for each of at most `units` patterns, rounding included

    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    bases = keyed.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n")).select("bucket", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bucket", "class").orderBy("doc_id", "start", "ids_crc32")
    ranked = keyed.withColumn("rank", F.row_number().over(inside) - 1).join(bases, ["bucket", "class"]).withColumn("rank", F.col("rank") + F.col("base"))

    upto = slots.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("first", "k", "sequence", "place"))).alias("slots"))  # at most `units` rows
    slot = F.element_at("slots", F.greatest(F.lit(1), _last_at_most(F.col("slots"), F.col("rank"))))
    placed = ranked.join(F.broadcast(upto), "class").withColumn("slot", slot).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.expr("slot.sequence + (rank - slot.first) div slot.k").alias("sequence_id"),
        F.expr("slot.place + (rank - slot.first) % slot.k").alias("place"),
    )
    into = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(into), F.lit(0))).drop("place")


def _last_at_most(slots, rank):
    """1-based place of the last slot whose first rank is at most ``rank``."""
    return F.size(F.filter(slots, lambda s: s["first"] <= rank))
