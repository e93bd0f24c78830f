"""Substring deduplication over sliding sentence spans."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import blocks, materialize, with_text

#: A sentence ends with its full stops and the white space after them, or with a line; the full stops of Han text need no space.
BOUNDARY = re.compile(r"[.!?]+\s+|[。！？｡]+\s*|\n\s*")
#: Letters of scripts that put no spaces between words: Thai, Lao, Burmese, Khmer, Han, kana.
_JOINED = "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
JOINED = re.compile(f"[{_JOINED}]")
WORDS = re.compile(r"\S+\s*")
#: Words of texts with such letters; each of them is one.
PARTS = re.compile(rf"[{_JOINED}]\s*|[^\s{_JOINED}]+\s*")
WINDOW = 8
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _hash(words: list[str]) -> int:
    return xxh3_64_intdigest(" ".join(words).lower().encode("utf-8", "surrogatepass"))


def cut_points(hashes: list[int], window: int = WINDOW) -> list[int]:
    """The places of the least hash, the last of equal ones, of each ``window`` hashes side by side.

    They are at most ``window`` apart, and what lies ``window`` or more from the ends of a repeated stretch is cut alike wherever
    the stretch stands."""
    out, at = [], -1
    for i in range(len(hashes) - window + 1):
        if at < i:
            part = hashes[i : i + window]
            at = i + window - 1 - part[::-1].index(min(part))
            out.append(at)
        elif hashes[i + window - 1] <= hashes[at]:
            at = i + window - 1
            out.append(at)
    return out


def units(text: str, most_words: int = 16) -> tuple[list[int], list[int], list[int]]:
    """Ends, hashes and words of the sentences that have a word. Sentences of more than ``most_words`` words count as several, cut
    at the words of least hash in their surroundings, so that a passage is cut alike wherever it stands in a sentence.

    Case and white space don't matter to the hash. Letters of scripts without spaces are cut as words are, and two count as a word.
    Each unit reaches to the start of the next, so the units cover the text."""
    ends, hashes, words = [], [], []
    start = 0
    joined = not text.isascii() and JOINED.search(text) is not None
    for end in [m.end() for m in BOUNDARY.finditer(text)] + [len(text)]:
        found = [m.group().rstrip() for m in PARTS.finditer(text, start, end)] if joined else text[start:end].split()
        if not found:
            continue
        if len(found) <= most_words:
            bounds, stops = [0, len(found)], None
        else:
            bounds = [0, *(x for x in cut_points([_hash([w]) for w in found]) if x), len(found)]
            stops = [m.end() for m in (PARTS if joined else WORDS).finditer(text, start, end)]
        for a, b in zip(bounds, bounds[1:]):
            ends.append(stops[b - 1] if stops else end)
            hashes.append(_hash(found[a:b]))
            letters = sum(JOINED.match(w) is not None for w in found[a:b]) if joined else 0
            words.append(b - a - letters // 2)
        start = end
    if ends:
        ends[-1] = len(text)
    return ends, hashes, words


def runs(hashes: list[int], words: list[int], sentences: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each sentence from which a run of at least ``sentences`` sentences and ``min_words`` words can start: where the
    shortest one ends, and 64 and 32 bits of hash."""
    n = len(hashes)
    cum = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)
    ends = np.maximum(np.arange(n) + sentences, np.searchsorted(cum, cum[:-1] + min_words))
    ends = ends[: int(np.searchsorted(ends, n, side="right"))]
    k, u = len(ends), np.array(hashes, np.uint64)
    h, c = (ends - np.arange(k)).astype(np.uint64), np.full(k, 7, np.uint64)
    longest = int((ends - np.arange(k)).max()) if k else 0
    for j in range(longest):
        live = np.flatnonzero(np.arange(k) + j < ends)
        x = u[live + j]
        h[live] = (h[live] ^ x) * _P
        h[live] ^= h[live] >> np.uint64(32)
        c[live] = (c[live] + x) * _Q
        c[live] ^= c[live] >> np.uint64(29)
    return ends, h.view(np.int64), (c >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _firsts(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Which runs of a document are the first of their kind in it."""
    out = np.zeros(len(h), bool)
    key = np.empty(len(h), [("h", np.int64), ("c", np.int32)])
    key["h"], key["c"] = h, c
    out[np.unique(key, return_index=True)[1]] = True
    return out


def remove(text: str, flagged: set[int], sentences: int, min_words: int) -> tuple[str, int, int, list[tuple[int, int]]]:
    """Kept text, sentences, removed sentences, removed character spans (maximal)."""
    ends, hashes, words = units(text)
    stop, h, c = runs(hashes, words, sentences, min_words)
    bad = ~_firsts(h, c)
    if flagged:
        bad |= np.fromiter((x in flagged for x in h.tolist()), bool, len(h))
    change = np.zeros(len(ends) + 1, np.int64)
    at = np.flatnonzero(bad)
    np.add.at(change, at, 1)
    np.add.at(change, stop[at], -1)
    gone = np.cumsum(change[:-1]) > 0
    starts = [0, *ends[:-1]]
    spans, kept = [], []
    for i, g in enumerate(gone.tolist()):
        if not g:
            kept.append(text[starts[i] : ends[i]])
        elif spans and spans[-1][1] == starts[i]:
            spans[-1] = (spans[-1][0], ends[i])
        else:
            spans.append((starts[i], ends[i]))
    return ("".join(kept) if spans else text), len(ends), int(gone.sum()), spans


SPAN = "array<struct<start:int,end:int>>"


def dedup_spans(docs: DataFrame, sentences: int = 3, min_words: int = 12, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """Removes sentences that lie in a repeated run of consecutive sentences other than its first occurrence.

    A run starts at every sentence and takes ``sentences`` sentences, and more until it has ``min_words`` words; sentences of over
    16 words count as several, cut where their words say and not where they start, so a passage of one or two long sentences, or
    of a text without full stops or spaces, has runs wherever it stands; up to 16 words at either end of it can stay. Runs are equal if 96 bits of their hashes are.
    The first occurrence is the one of the least id, in it the first place. Each document sends each run once; the runs are
    reduced to the least and greatest id by partial aggregation, and only runs with two ids are joined back, so a run that a
    third of the documents share costs each a row and no pairs.

    Returns id_col, text (kept), n_sentences, n_removed, spans (removed, [start, end) in characters of the input text). With
    ``whole_rows`` the input's row comes along as the struct ``doc``.

    Null texts stay null, with no sentences; empty ones stay empty. Rows with null ids are returned as they are and compared
    with nothing. Rows with equal ids are one document that stands in several rows: they aren't repeats of each other, and
    each loses what repeats a smaller id or itself. An empty table gives no rows; other columns take no part.
    """
    rows = docs.select((F.struct("*") if whole_rows else F.struct(F.col(id_col), F.col(text_col))).alias("doc"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            hs, cs, local, ns = [], [], [], []
            for text in batch["text"].to_pylist():
                _, hashes, words = units(text or "")
                _, h, c = runs(hashes, words, sentences, min_words)
                first = _firsts(h, c)
                hs.append(h[first])
                cs.append(c[first])
                local.append(not first.all())
                ns.append(len(hashes))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(h) for h in hs])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ns, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(hs), pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(cs), pa.int32())), pa.array(local)],
                ["doc_id", "n", "h", "c", "local"],
            )

    found = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text").mapInArrow(hashed, f"doc_id {id_type}, n long, h array<long>, c array<int>, local boolean")
    found = materialize(found, "span-hashes")
    each = found.select("doc_id", F.explode(F.arrays_zip("h", "c")).alias("x")).select("doc_id", "x.h", "x.c")
    repeated = each.groupBy("h", "c").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("greatest")).filter("least < greatest").select("h", "c", "least")
    later = each.join(repeated, ["h", "c"]).filter("doc_id > least").select("doc_id", "h", F.lit(None).cast("long").alias("n"), F.lit(True).alias("marked"))
    marks = later.unionByName(found.select("doc_id", F.lit(None).cast("long").alias("h"), "n", F.col("local").alias("marked")))
    known = marks.groupBy("doc_id").agg(F.collect_set("h").alias("flagged"), F.max("marked").alias("marked"), F.min("n").alias("n"), F.max("n").alias("most"))  # at most a document's own runs
    known = known.select("doc_id", F.when(F.col("marked"), F.col("flagged")).alias("flagged"), F.when(F.col("n") == F.col("most"), F.col("n")).alias("n"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(with_text(batches, "doc", text_col), "text"):
            out = []
            for text, bad, n in zip(*(batch[c].to_pylist() for c in ("text", "flagged", "n"))):
                if text is None:
                    out.append((None, 0, 0, []))
                elif bad is None:
                    out.append((text, len(units(text)[0]) if n is None else n, 0, []))
                else:
                    out.append(remove(text, set(bad), sentences, min_words))
            kept, n, gone, spans = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch["doc"] if whole_rows else pa.StructArray.from_arrays([pc.struct_field(batch["doc"], id_col)], [id_col]), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["doc", "text", "n_sentences", "n_removed", "spans"],
            )

    moved = rows.select("doc", "doc_id")  # the text is in the row: it is shuffled and sent to Python once
    joined = moved.filter("doc_id IS NOT NULL").join(known, "doc_id", "left").select("doc", "flagged", "n")
    alone = moved.filter("doc_id IS NULL").select("doc", F.lit(None).cast("array<long>").alias("flagged"), F.lit(None).cast("long").alias("n"))
    joined = joined.unionByName(alone)  # rows without an id never meet in one task
    kept = joined.select("doc") if whole_rows else joined.select(F.struct(F.col("doc")[id_col].alias(id_col)).alias("doc"))
    schema = kept.schema.add("text", "string").add("n_sentences", "long").add("n_removed", "long")
    out = joined.mapInArrow(cut, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", spans {SPAN}")
    return out if whole_rows else out.select(F.col("doc")[id_col].alias(id_col), "text", "n_sentences", "n_removed", "spans")
