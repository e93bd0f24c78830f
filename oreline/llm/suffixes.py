"""Suffix-array deduplication by the difference-cover algorithm, dealt out over anchors.

Two equal strings of ``length`` bytes hold the same anchor: the k-byte string of least hash in them (the last, if several are
least). So all strings of one anchor are sorted in one place, and strings of different anchors never match. A pass over the
texts counts anchors; only anchors that occur twice in different texts or one text send on their neighbourhood, the bytes
of all strings that they own. A task then sorts the suffixes of its neighbourhoods by the difference-cover algorithm modulo 3
(sort the triples at sampled places, recurse on their names, merge in the remaining suffixes), compares adjacent prefixes
of ``length`` bytes, and of each run of equal ones keeps the earliest. Equal texts are settled before: every later copy is
covered whole.

An anchor with many neighbourhoods is dealt out to several tasks by document. Each sorts its part and keeps the earliest of each
string; what the parts keep is merged by the strings' 128-bit names, whose least place is found by partial aggregation. So no
task holds more than ``hot_pieces`` neighbourhoods of an anchor, however many documents share it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from .common import blocks, discard, materialize, release

K = 32
SORTED = ["doc_id", "row_key", "start", "end", "lo", "hi"]
ROW = ["doc_id", "row_key"]
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_LOW = np.uint64(0xFFFFFFFF)


def _pack(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """One sortable number for each triple of whole numbers from 0."""
    a, b, c = (x.astype(np.int64) for x in (a, b, c))
    bits = [int(x.max(initial=0)).bit_length() for x in (a, b, c)]
    if sum(bits) <= 63:
        return (a << (bits[1] + bits[2])) | (b << bits[2]) | c
    pair = np.unique((a << bits[1]) | b, return_inverse=True)[1].astype(np.int64)
    return (pair << bits[2]) | c


def _sorted(key: np.ndarray) -> np.ndarray:
    """Places of ``key`` (whole numbers from 0) in its order. Where number and place fit 64 bits they are sorted as one, which is faster."""
    bits = len(key).bit_length()
    if int(key.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(key)
    both = (key << bits) | np.arange(len(key))
    both.sort()
    return both & ((1 << bits) - 1)


def suffix_order(s: np.ndarray, reach: int) -> np.ndarray:
    """Suffixes of ``s`` (whole numbers from 1) in the order of at least their first ``reach`` symbols.

    Suffixes that agree so far stand side by side in any order."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s, [0, 0, 0]]).astype(np.int32)  # half the memory to look places up in
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # a sample at n itself keeps both parts apart
    sample = np.concatenate([ones, twos])
    triple = _pack(t[sample], t[sample + 1], t[sample + 2])
    order = _sorted(triple)
    ranked = triple[order]
    names = np.empty(len(sample), np.int64)
    names[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])]) + 1
    if reach > 3 and names.max() < len(sample):
        order = suffix_order(names, -(-reach // 3) + 1)
    rank = np.zeros(n + 3, np.int32)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    by_rank = sample[order]
    by_rank = by_rank[by_rank < n]

    bits = len(sample).bit_length()
    key = (t[0:n:3].astype(np.int64) << bits) | rank[1 : n + 1 : 3]  # of the suffixes at 0, 3, 6, ...
    order = _sorted(key)
    zeros, key = order * 3, key[order]
    one, two = by_rank[by_rank % 3 == 1], by_rank[by_rank % 3 == 2]
    before = np.searchsorted((t[one].astype(np.int64) << bits) | rank[one + 1], key)
    both = np.concatenate([zeros, two])
    key = _pack(t[both], t[both + 1], rank[both + 2])
    before = before + np.searchsorted(key[len(zeros) :], key[: len(zeros)])
    out = np.empty(n, np.int64)
    at = np.maximum.accumulate(before) + np.arange(len(zeros))
    rest = np.ones(n, bool)
    rest[at] = False
    out[at], out[rest] = zeros, by_rank
    return out


def later_strings(data: bytes, starts: np.ndarray, piece: np.ndarray, doc: np.ndarray, row: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Of the strings of ``length`` bytes at ``starts``: which have an equal one in a smaller doc, or at a smaller ``place`` of their own row.

    ``piece`` tells which piece each string is from, ``doc`` and ``row`` (numbers from 0) the document and the row of each piece; a
    document may have several rows, none of which is earlier than another."""
    flat = np.frombuffer(data, np.uint8)
    order = suffix_order(flat.astype(np.int64) + 1, length)
    index = np.full(len(flat), -1, np.int32)
    index[starts] = np.arange(len(starts), dtype=np.int32)
    order = index[order]
    order = order[order >= 0]
    out = np.zeros(len(starts), bool)
    if not len(order):
        return out
    windows = np.lib.stride_tricks.sliding_window_view(flat, length)
    same = np.zeros(len(order), bool)
    for i in range(1, len(order), 1 << 16):
        a, b = starts[order[i - 1 : i - 1 + (1 << 16)]], starts[order[i : i + (1 << 16)]]
        same[i : i + len(b)] = (windows[a[: len(b)]] == windows[b]).all(axis=1)
    heads = np.flatnonzero(~same)
    size = np.diff(np.concatenate([heads, [len(order)]]))
    docs = doc[piece[order]]
    later = docs != np.repeat(np.minimum.reduceat(docs, heads), size)
    rest = np.flatnonzero(~later & np.repeat(size > 1, size))  # several of the least document: the first of each row stays
    if len(rest):
        key = (np.searchsorted(heads, rest, side="right") * (int(row.max()) + 1)) + row[piece[order[rest]]]
        at = place[order[rest]]
        by = np.lexsort((at, key))
        key, at = key[by], at[by]
        runs = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        later[rest[by]] = at != np.repeat(at[runs], np.diff(np.concatenate([runs, [len(at)]])))
    out[order] = later
    return out


def owners(flat: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the k bytes at each place, place of the anchor of the string of ``length`` bytes at each place)."""
    h, size, power = flat.astype(np.uint64) + np.uint64(1), 1, int(_A)
    while size < K:
        h = h[:-size] * np.uint64(power) + h[size:]
        power = power * power % (1 << 64)
        size *= 2
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _A
    h ^= h >> np.uint64(31)
    least = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
    width, have = length - K + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return h, (_LOW - (least & _LOW)).astype(np.int64)


def anchored(texts: list[bytes], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, anchor hashes, first and last starts of the strings that each owns), for the texts of at least ``length`` bytes."""
    for i, text in enumerate(texts):
        if len(text) >= length:
            h, own = owners(np.frombuffer(text, np.uint8), length)
            cut = np.flatnonzero(own[1:] != own[:-1])
            first = np.concatenate([[0], cut + 1])
            yield i, h[own[first]].view(np.int64), first, np.concatenate([cut, [len(own) - 1]])


def dedup_bytes(docs: DataFrame, length: int = 100, block: int = 1 << 20, hot_pieces: int = 20_000, keep_bytes: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removes each byte that lies in a string of ``length`` bytes which also starts earlier: in a smaller id, or before in its own text.

    Strings are judged on the input. Returns id_col, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and with
    ``keep_bytes`` the kept bytes (which may cut a character).

    Null texts are empty; texts shorter than ``length`` lose nothing. Rows with null ids are compared with nothing. Of several rows
    of one id none is earlier than another: each is judged against smaller ids and itself. An empty table gives no rows; other
    columns take no part.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(data).alias("row_key"), data.alias("data"))  # id and key name a row; equal rows fare alike

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "data"):
            texts = batch["data"].to_pylist()
            digest = np.frombuffer(b"".join(map(xxh3_128_digest, texts)), np.int64).reshape(-1, 2)
            found, twice = [np.zeros(0, np.int64)] * len(texts), [np.zeros(0, np.int64)] * len(texts)
            for i, h, _, _ in anchored(texts, length):
                found[i], n = np.unique(h, return_counts=True)
                twice[i] = found[i][n > 1]
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in xs])]), pa.int32()), pa.array(np.concatenate(xs), pa.int64())) for xs in (found, twice)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row_key"], pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), pa.array([len(t) for t in texts], pa.int64()), *lists], [*ROW, "lo", "hi", "n", "anchors", "twice"])

    scanned = materialize(rows.filter("doc_id IS NOT NULL").mapInArrow(scan, "doc_id long, row_key long, lo long, hi long, n long, anchors array<long>, twice array<long>"), "suffix-anchors")
    first = scanned.groupBy("lo", "hi").agg(F.min("doc_id").alias("first"))
    texts = materialize(scanned.select(*ROW, "lo", "hi").join(first, ["lo", "hi"]).select(*ROW, (F.col("doc_id") > F.col("first")).alias("copy")).distinct(), "suffix-copies")

    # Anchors of two different texts; copies of one text count as one.
    each = scanned.select(*ROW, "lo", F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.min("lo").alias("a"), F.max("lo").alias("b"), F.count(F.lit(1)).alias("n")).filter("a <> b")
    shared = shared.select("anchor", F.ceil(F.col("n") / hot_pieces).cast("int").alias("parts"))
    live = each.select(*ROW, "anchor").join(shared, "anchor").unionByName(scanned.select(*ROW, F.explode("twice").alias("anchor"), F.lit(1).alias("parts")))
    live = live.groupBy(*ROW).agg(F.collect_set(F.struct("anchor", "parts")).alias("anchors"))  # at most a text's own
    live = materialize(live.join(texts.filter("NOT copy"), ROW, "left_semi"), "suffix-live")

    def neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], tuple[int, int, int]] = {}
        for batch in blocks(batches, "data"):
            out = []
            ids, keys, data, flagged = (batch[c].to_pylist() for c in (*ROW, "data", "anchors"))
            for i, h, a, b in anchored(data, length):
                parts: dict[int, int] = {}
                for x in flagged[i]:
                    parts[x["anchor"]] = max(x["parts"], parts.get(x["anchor"], 1))
                want, text, doc_id, row_key = np.array(list(parts), np.int64), data[i], ids[i], keys[i]
                for j in np.flatnonzero(np.isin(h, want)).tolist():
                    start, end = int(a[j]), int(b[j]) + length
                    piece, anchor = text[start:end], int(h[j])
                    known = seen.get(key := (anchor, xxh3_64_intdigest(piece)))
                    if known is not None and (known[0] < doc_id or known[:2] == (doc_id, row_key) and known[2] < start):
                        out.append((None, None, doc_id, row_key, start, end, None))  # an equal one stands earlier: covered whole, and it need not be sent
                    else:
                        if len(seen) > 400_000:
                            seen.clear()
                        if known is None or doc_id < known[0] or known[:2] == (doc_id, row_key):
                            seen[key] = (doc_id, row_key, start)
                        n = parts[anchor]  # 0 stands for an anchor in one place, parts count from 1
                        out.append((anchor, 0 if n == 1 else 1 + xxh3_64_intdigest(str(doc_id)) % n, doc_id, row_key, start, end, piece))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["anchor", "part", *ROW, "start", "end", "piece"])

    shipped = rows.join(live, ROW).sortWithinPartitions("doc_id")
    shipped = materialize(shipped.mapInArrow(neighbourhoods, "anchor long, part int, doc_id long, row_key long, start long, end long, piece binary"), "suffix-pieces")

    def sort_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            n = np.array([len(x[5]) for x in held], np.int64)
            base = np.cumsum(n) - n
            counts = n - length + 1
            piece = np.repeat(np.arange(len(held), dtype=np.int32), counts)
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            docs, keys, starts = (np.array([x[i] for x in held], np.int64) for i in (2, 3, 4))
            at = starts[piece] + inside
            order = np.lexsort((keys, docs))
            new = np.concatenate([[False], np.diff(docs[order]) != 0]), np.concatenate([[False], (np.diff(docs[order]) != 0) | (np.diff(keys[order]) != 0)])
            doc, row = np.empty((2, len(held)), np.int32)
            doc[order], row[order] = np.cumsum(new[0]), np.cumsum(new[1])
            later = later_strings(b"".join(x[5] for x in held), base[piece] + inside, piece, doc, row, at, length)
            gone = np.flatnonzero(later)
            none = lambda k: pa.nulls(k, pa.int64())
            if len(gone):
                new = np.concatenate([[True], (np.diff(gone) != 1) | (np.diff(piece[gone]) != 0)])
                lo, hi = gone[new], gone[np.concatenate([new[1:], [True]])]
                yield pa.RecordBatch.from_arrays([pa.array(docs[piece[lo]]), pa.array(keys[piece[lo]]), pa.array(at[lo]), pa.array(at[hi] + length), none(len(lo)), none(len(lo))], SORTED)
            kept = np.flatnonzero(~later & (np.array([x[1] for x in held]) > 0)[piece])
            for i in range(0, len(kept), 1 << 16):
                some = kept[i : i + (1 << 16)]
                names = np.frombuffer(b"".join(xxh3_128_digest(held[p][5][j : j + length]) for p, j in zip(piece[some].tolist(), inside[some].tolist())), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(docs[piece[some]]), pa.array(keys[piece[some]]), pa.array(at[some]), none(len(some)), pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy())], SORTED)

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("anchor", "part", *ROW, "start", "piece"))):
                if size >= block and row[:2] != held[-1][:2]:
                    yield from settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield from settle(held)
        held.clear()
        release()

    sent = shipped.filter("anchor IS NOT NULL").select("anchor", "part", *ROW, "start", "piece")
    sent = sent.repartition("anchor", "part").sortWithinPartitions("anchor", "part", *ROW, "start")
    done = materialize(sent.mapInArrow(sort_pieces, "doc_id long, row_key long, start long, end long, lo long, hi long"), "suffix-sorted")
    removed = done.filter("end IS NOT NULL").select(*ROW, "start", "end").unionByName(shipped.filter("anchor IS NULL").select(*ROW, "start", "end"))
    kept = done.filter("end IS NULL")  # the strings that the parts of hot anchors keep; a document's are all in one part
    if kept.limit(1).count():
        first = kept.groupBy("lo", "hi").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("lo", "hi", "first")
        removed = removed.unionByName(kept.join(first, ["lo", "hi"]).filter("doc_id > first").select(*ROW, "start", (F.col("start") + length).alias("end")))
    removed = removed.groupBy(*ROW).agg(F.collect_set(F.struct("start", "end")).alias("removed"))  # of one text
    removed = materialize(removed.join(texts.filter("copy"), ROW, "full"), "suffix-removed")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "data"):
            out = []
            for doc_id, data, gone, copy in zip(*(batch[c].to_pylist() for c in ("doc_id", "data", "removed", "copy"))):
                n, kept, cut, spans, at = len(data), [], 0, 0, 0
                if copy and n >= length:
                    gone = [{"start": 0, "end": n}]
                for x in sorted(gone or [], key=lambda x: x["start"]):
                    start, end = x["start"], min(x["end"], n)
                    if start > at or not spans:
                        kept.append(data[at:start])
                        spans, cut, at = spans + 1, cut + end - start, end
                    elif end > at:
                        cut, at = cut + end - at, end
                kept = b"".join([*kept, data[at:]])
                out.append((doc_id, n, cut, spans, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))][: 5 + keep_bytes], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + keep_bytes])

    alone = rows.filter("doc_id IS NULL").select("*", *(F.lit(None).cast(removed.schema[c].dataType).alias(c) for c in ("removed", "copy")))
    joined = rows.filter("doc_id IS NOT NULL").join(removed, ROW, "left").unionByName(alone)  # rows without an id never meet in one task
    out = joined.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes)
    discard(scanned, live, shipped, texts, done)
    return out.withColumnRenamed("doc_id", id_col)
