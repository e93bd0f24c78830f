"""Near-duplicate documents: MinHash bands propose candidates, odd sketches sift them, full shingle sets confirm them.

An odd sketch folds a document's MinHash samples into a bitmap of parities: each sample flips the bit that it hashes to. The
XOR of two sketches has a bit for each place that differs, and its population count estimates how many samples differ,
most precisely where few do. A second bitmap holds the parities of the shingles themselves: its XOR never has more bits than the
sets have different shingles, so it rules pairs out without an error, which tells apart short texts just below the threshold.
Documents of equal shingle sets are one node from the start. In a bucket each node first meets the bucket's least and greatest
node only; ``linking`` does the rest. Its last join sees the pairs of different components in a bucket; a bucket's components that are not linked agree in ``rows`` MinHash values by accident, which two documents of similarity s
do with a probability of s ** rows, so there are few of them: at a similarity of 0.1 one in a million.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from .common import blocks, discard, materialize
from .linking import bucket_components

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z to a-z


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(29))


class Words(dict):
    """Hashes of words; restarts when it is full (about ``most`` bytes)."""

    def __init__(self, most: int = 24 << 20):
        self.most = self.room = most

    def __missing__(self, word: bytes) -> int:
        self.room -= 170 + len(word)
        if self.room < 0:
            self.clear()
            self.room = self.most
        h = self[word] = xxh3_64_intdigest(word)
        return h


def shingle_sets(texts: list[bytes | None], k: int, words: Words) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``k``-word shingles of each text; of fewer words, one of the whole sequence."""
    hashes = [np.fromiter(map(words.__getitem__, found), np.uint64, len(found)) for found in ((t or b"").translate(LOWER).split() for t in texts)]
    flat = np.concatenate([*hashes, np.zeros(k, np.uint64)])
    n = len(flat) - k + 1
    x = np.full(n, k, np.uint64)
    for j in range(k):
        x = _mix(x * _A + flat[j : j + n])
    out, at = [], 0
    for h in hashes:
        if len(h) >= k:
            out.append(np.unique(x[at : at + len(h) - k + 1]))
        elif len(h):
            y = np.uint64(len(h) + 1_000_003)
            one = np.full(1, y)
            for w in h:
                one = _mix(one * _A + w)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
        at += len(h)
    return out


def signatures(sets: list[np.ndarray], bands: int, rows: int, samples: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (a row a set) of bands * rows MinHash samples, odd sketches (64-bit words) of the first ``samples``; no set is empty."""
    flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    n, total = len(sets), max(samples, bands * rows)
    least = np.empty((n, total), np.uint64)
    multipliers = _mix(np.arange(1, total + 1, dtype=np.uint64) * _A) | np.uint64(1)
    for i, a in enumerate(multipliers):
        least[:, i] = np.minimum.reduceat(flat * a, starts)
    keys = np.empty((n, bands), np.uint64)
    for b in range(bands):
        key = np.full(n, b + 1, np.uint64)
        for r in range(rows):
            key = _mix(key * _A + least[:, b * rows + r])
        keys[:, b] = key
    place = (_mix(_mix(least[:, :samples] + np.arange(samples, dtype=np.uint64) * _B) * _A) >> np.uint64(64 - int(math.log2(bits)))).astype(np.int64)
    parity = np.bincount((np.arange(n)[:, None] * bits + place).ravel(), minlength=n * bits).reshape(n, bits) & 1
    return keys, np.packbits(parity.astype(np.uint8), axis=1).view(np.uint64)


def set_parities(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Parity bitmaps (64-bit words, a row a set) of the sets' shingles."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    place = (_mix(np.concatenate(sets) * _B) >> np.uint64(64 - int(math.log2(bits)))).astype(np.int64)
    parity = np.bincount(row * bits + place, minlength=len(sets) * bits).reshape(-1, bits) & 1
    return np.packbits(parity.astype(np.uint8), axis=1).view(np.uint64)


def most_different_bits(threshold: float, samples: int, bits: int) -> int:
    """Population counts up to this pass: at the threshold a pair exceeds it with a probability under 1e-8."""
    lowest = threshold - 6 * math.sqrt(threshold * (1 - threshold) / samples)
    share = (1 - math.exp(-4 * samples * (1 - lowest) / bits)) / 2
    return math.ceil(bits * share + 2 * math.sqrt(bits * share * (1 - share)))


def _apart(a: str, b: str, kind: str, words: int) -> Column:
    """Bits in which the bitmaps of a and b differ."""
    return sum((F.bit_count(F.col(f"{a}.{kind}{i}").bitwiseXOR(F.col(f"{b}.{kind}{i}"))) for i in range(words)), F.lit(0))


def _close(a: str, b: str, percent: int, limit: int, words: int) -> Column:
    """Sizes, sketches and set parities of a and b allow a link.

    percent * union <= 100 * intersection means (100 + percent) * different <= (100 - percent) * (size of a + size of b).
    """
    sizes = F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent
    different = _apart(a, b, "par", words) * (100 + percent) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent)
    return sizes & (_apart(a, b, "odd", words) <= limit) & different


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, bands: int = 56, rows: int = 6, samples: int = 256, bits: int = 1024, rounds: int = 4, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Links documents whose shingle sets have 100 * intersection >= percent * union, and names each document's component.

    Texts are lower-cased in A-Z and split at ASCII white space; a shingle is ``shingle_words`` words in a row, of shorter texts the
    whole. Candidates agree in one of ``bands`` bands of ``rows`` MinHash values: at a similarity of 0.8 all bands miss a pair
    with a probability of 5e-8. A link counts only if the full sets confirm it.

    Returns id_col, n_shingles, component_id (least id reachable), kept (the id is its component's). With ``carry`` (long
    columns of ``docs``) these columns and set_lo, set_hi, the 128 bits that name the row's shingle set, follow.

    Null texts and texts without words have no shingles and are linked with nothing. Rows with null ids have a null
    component, are kept and link nothing. Repeated rows are linked and share an id, so all of them have the same kept; rows
    of equal ids and different texts each follow their own text. An empty table gives no rows; other columns take no part.
    """
    extra = {f"extra{i}": c for i, c in enumerate(carry or [])}
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *(F.col(c).cast("long").alias(x) for x, c in extra.items()))
    sketch = bits // 64
    odds = [f"{kind}{i}" for kind in ("odd", "par") for i in range(sketch)]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in blocks(batches, "text", 2 << 20):
            sets = shingle_sets(batch["text"].cast(pa.binary()).to_pylist(), shingle_words, words)
            n = len(sets)
            size = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(size)
            keys, maps = np.zeros((n, bands), np.uint64), np.zeros((n, 2 * sketch), np.uint64)
            digest = np.zeros((n, 2), np.int64)
            if len(some):
                full = [sets[i] for i in some]
                keys[some], maps[some, :sketch] = signatures(full, bands, rows, samples, bits)
                maps[some, sketch:] = set_parities(full, bits)
                digest[some] = np.frombuffer(b"".join(xxh3_128_digest(sets[i].tobytes()) for i in some), np.int64).reshape(-1, 2)
            offsets = pa.array(np.arange(n + 1) * bands, pa.int32())
            cols = [batch["doc_id"], *(batch[x] for x in extra), pa.array(size), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel().view(np.int64)))]
            cols += [pa.array(np.ascontiguousarray(maps[:, i]).view(np.int64)) for i in range(2 * sketch)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *extra, "n", "lo", "hi", "keys", *odds])

    signed_schema = ", ".join(f"{x} long" for x in ("doc_id", *extra, "n", "lo", "hi")) + ", keys array<long>, " + ", ".join(f"{x} long" for x in odds)
    all_rows = materialize(source.mapInArrow(signed, signed_schema), "neardup-signed")

    # A node is a shingle set. Its number is fixed by being written; ids come in again at the end, as one id may have several sets.
    classes = all_rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("lo", "hi").agg(F.min("doc_id").alias("least_id"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "neardup-classes")
    chosen = classes.withColumnRenamed("least_id", "doc_id")
    nodes = all_rows.filter("n > 0").join(chosen, ["lo", "hi", "doc_id"]).dropDuplicates(["lo", "hi", "doc_id"])
    nodes = materialize(nodes.select("node", "lo", "hi", "doc_id", "n", "keys", *odds), "neardup-nodes")
    buckets = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    shared = buckets.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("greatest")).filter("least < greatest")
    members = materialize(buckets.join(shared, "key"), "neardup-members")

    limit, info = most_different_bits(percent / 100, samples, bits), nodes.select("node", "n", *odds)
    stars = members.select(F.col("node").alias("x"), F.explode(F.array("least", "greatest")).alias("y")).filter("x <> y").distinct()

    # Full sets of the nodes that any candidate pair can hold, made again from their texts: of one row a node, found by its own digest.
    involved = members.select("node").distinct().join(nodes.select("node", "doc_id", "lo"), "node").groupBy("doc_id").agg(F.collect_set(F.struct("lo", "node")).alias("wanted"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in blocks(batches, "text", 2 << 20):
            found, nodes_of = [], []
            for s, wanted in zip(shingle_sets(batch["text"].cast(pa.binary()).to_pylist(), shingle_words, words), batch["wanted"].to_pylist()):
                lo = int(np.frombuffer(xxh3_128_digest(s.tobytes()), np.int64)[0])
                if own := [w["node"] for w in wanted if w["lo"] == lo]:
                    found.append(s.view(np.int64))
                    nodes_of.append(own[0])
            if found:
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in found])]), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(nodes_of, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))], ["node", "shingles"])

    texts = source.filter("text IS NOT NULL").join(involved, "doc_id").select("text", "wanted")
    full = materialize(texts.mapInArrow(sets, "node long, shingles array<long>"), "neardup-sets")
    if full.count() > full.select("node").distinct().count():  # rows repeat: one of each set is enough
        repeated, full = full, materialize(full.dropDuplicates(["node"]), "neardup-sets")
        discard(repeated)

    def confirmed(pairs: DataFrame) -> DataFrame:
        a, b = full.select(F.col("node").alias("x"), F.col("shingles").alias("s")), full.select(F.col("node").alias("y"), F.col("shingles").alias("t"))
        both = F.size(F.array_intersect("s", "t"))
        held = pairs.select("x", "y").join(a, "x").join(b, "y").withColumn("both", both)
        return held.filter(F.col("both") * 100 >= (F.size("s") + F.size("t") - F.col("both")) * percent).select(F.col("x").alias("a"), F.col("y").alias("b"))

    component = bucket_components(
        members, stars, info, lambda a, b: _close(a, b, percent, limit, sketch), lambda a, b: _apart(a, b, "odd", sketch), confirmed, rounds, "neardup"
    )

    # A component is named by the least id of its documents.
    placed = classes.select("node", "least_id").join(component, "node")
    names = placed.groupBy("component").agg(F.min("least_id").alias("name"))
    named = component.join(names, "component").select("node", "name")
    named = materialize(classes.join(named, "node", "left").select("lo", "hi", F.coalesce("name", "least_id").alias("component_id")), "neardup-names")
    discard(full, members, nodes, classes, component)
    out = all_rows.select("doc_id", *extra, "n", "lo", "hi").join(named, ["lo", "hi"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).cast("long")
    out = out.select("doc_id", *extra, F.col("n").alias("n_shingles"), own.alias("component_id"), "lo", "hi")
    out = out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    followed = [*(F.col(x).alias(c) for x, c in extra.items()), F.col("lo").alias("set_lo"), F.col("hi").alias("set_hi")] if extra else []
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", "kept", *followed)
