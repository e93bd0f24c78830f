"""Order MinHash fingerprints: minimal occurrence-numbered k-mers in text order, sensitive to edit distance."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(31))


def _multipliers(n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * _A) | np.uint64(1)


def _mers(codes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` codes, put together from runs of powers of two."""
    n, done, out, run, size = len(codes) - k + 1, 0, None, codes, 1
    while True:
        if k & size:
            part = run[done : done + n]
            out = part if out is None else _mix(out * _A + part)
            done += size
        if size * 2 > k:
            return _mix(out * _A + np.uint64(k))
        run = _mix(run[:-size] * _A + run[size:])
        size *= 2


def fingerprint(text: str, k: int = 8, width: int = 2, sketches: int = 32) -> np.ndarray:
    """``sketches`` hashes. Each: of all (k-mer, how often it stood before) take the ``width`` least under the sketch's own hash, put
    them in text order, hash the tuple of their k-mers. Texts of fewer than ``k`` characters are one k-mer; the empty text has
    the fingerprint of zeros."""
    if not text:
        return np.zeros(sketches, np.uint32)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    mers = _mers(codes, min(k, len(codes)))
    n, bits = len(mers), np.uint64(max(1, len(mers).bit_length()))
    # Equal k-mers side by side and in text order: the place takes the low bits of the sorted key.
    order = np.sort((mers >> bits << bits) | np.arange(n, dtype=np.uint64))
    place, kind = (order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), order >> bits
    new = np.empty(n, bool)
    new[0], new[1:] = True, kind[1:] != kind[:-1]
    numbered, at = np.empty(n, np.uint64), np.arange(n)
    numbered[place] = _mix(mers[place] + (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64) * _A)
    width, a = min(width, n), _multipliers(sketches)
    at_once, found = max(1, (1 << 20) // n), []
    for i in range(0, sketches, at_once):
        h = numbered * a[i : i + at_once, None]
        rows, picks = np.arange(len(h)), []
        for _ in range(width):
            picks.append(h.argmin(axis=1))
            h[rows, picks[-1]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        found.append(np.sort(np.stack(picks, axis=1), axis=1))
    out = a
    for column in np.concatenate(found).T:
        out = _mix((out ^ mers[column]) * _A)
    return (out >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal sketches: estimates a similarity that falls with edit distance, order included."""
    return float(np.mean(a == b))


def _hex(x: np.ndarray) -> str:
    return x.astype(">u4").tobytes().hex()


def edited(text: str, following: str, share: int = 4) -> str:
    """``text`` with its last floor(n / share) code points replaced by the first as many (or all) of ``following``."""
    n = len(text) // share
    return text[: len(text) - n] + following[:n]


def _range_of(x: Column, cuts: list[int]) -> tuple[Column, Column]:
    """(how many cuts are at most ``x``, whether ``x`` is a cut): looked up in two steps of about the root of their number."""
    if not cuts:
        return F.lit(0), F.lit(False)
    step = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    at_most = lambda c: F.size(F.filter(c, lambda y: y <= x))
    group = at_most(F.lit([g[0] for g in groups]).cast("array<bigint>"))
    inside = F.element_at(F.array(*(F.lit(g).cast("array<bigint>") for g in groups)), F.greatest(group, F.lit(1)))
    own = F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + at_most(inside))
    return own.cast("int"), F.array_contains(inside, x)


def neighbour_fingerprints(docs: DataFrame, k: int = 8, width: int = 2, sketches: int = 32, bytes_a_range: int = 24 << 20, most_ranges: int = 16_384, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints every whole text, and the text edited with the start of its next document, in ascending id order.

    The rows are cut at sampled id quantiles to ranges of about ``bytes_a_range`` bytes of text, at most ``most_ranges``: beyond that
    ranges grow, and as a range is sorted on disk and read as a stream, no memory grows with it. Each range's first id is also
    sent to the range before it (the least id to the last range), so one pass over each sorted range sees every pair of
    neighbours. Ranges follow from ids and sizes alone, so a lost task is recomputed alike. What goes through the driver is
    ``most_ranges`` ids.

    Returns id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint (hexadecimal), near_edited, near_next.

    Null texts are empty. Of two empty texts the likeness is 1, of an empty and another 0 but by chance. Rows with null ids
    have no place in the order and are their own next document; equal ids and repeated rows keep a row each, ordered by text.
    The last row's next document is the first, its own if it is alone. An empty table gives no rows; other columns take no part.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("doc_id").alias("least"), F.count("doc_id").alias("ids")).first()
    ranges = min(most_ranges, max(1, -(-(known["bytes"] or 0) // bytes_a_range)))
    cuts = []
    if ranges > 1 and known["ids"]:
        cuts = sorted(set(rows.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]) - {known["least"]})
    own, starts = _range_of(F.col("doc_id"), cuts)
    guest = F.when(F.col("doc_id") == F.lit(known["least"]), F.lit(len(cuts))).when(starts, own - 1)
    to = F.array(F.struct(own.alias("range"), F.lit(0).alias("guest")), F.struct(guest.cast("int").alias("range"), F.lit(1).alias("guest")))
    alone = F.array(F.struct(F.pmod(F.xxhash64("text"), F.lit(len(cuts) + 1)).cast("int").alias("range"), F.lit(2).alias("guest")))
    sent = rows.withColumn("to", F.when(F.col("doc_id").isNull(), alone).otherwise(F.filter(to, lambda s: s["range"].isNotNull())))
    sent = sent.select("doc_id", "text", F.explode("to").alias("to")).select("to.range", "to.guest", "doc_id", "text")

    def compared(doc_id: int | None, text: str, own_f: np.ndarray, following: str, f: np.ndarray) -> tuple:
        e = edited(text, following)
        ef = own_f if e == text else fingerprint(e, k, width, sketches)
        return doc_id, len(text), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), _hex(own_f), _hex(ef), likeness(own_f, ef), likeness(own_f, f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (range, id, text, fingerprint) of a row whose next document is still to come
        for batch in blocks(batches, "text"):
            out = []
            for r, g, doc_id, text in zip(*(batch[c].to_pylist() for c in ("range", "guest", "doc_id", "text"))):
                if held and (held[0] != r or held[4]):
                    held = None if held[0] != r else held
                if held and held[4] and g < 2:
                    continue  # a range needs one guest only
                f = fingerprint(text, k, width, sketches)
                if g == 2:
                    out.append(compared(doc_id, text, f, text, f))
                    continue
                if held:
                    out.append(compared(*held[1:4], text, f))
                held = (r, doc_id, text, f, g)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], NAMES)

    n = len(cuts) + 1
    dealt = sent.repartitionByRange(n, "range") if n > 1 else sent.repartition(1)
    out = dealt.sortWithinPartitions("range", "guest", F.col("doc_id").asc_nulls_first(), "text").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("doc_id", id_col)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
