"""N-gram Jaccard join by PartEnum: sets of one size band that are similar enough share a signature, without an exception.

A scheme serves the sets of one band of sizes and those just below it that can link into it. Two linked sets of a scheme differ in at
most ``apart`` features. The feature domain is cut into parts by hash range; in one of more than ``apart // 2`` parts two linked sets
differ in at most one feature, so of its three cells two are equal: each choice of two cells of a part is a signature. In large
bands, parts of one cell do: one of more than ``apart`` parts is equal. Some spare parts are added, so that a pair agrees in
more of them than a set has empty ones; then the signatures of empty cells, which unrelated sets would share, needn't be given. A
set with too many empty ones gives all of its signatures.

Signatures are sorted by Spark, and each task streams through its own: signatures of one set alone are most and go no
further. The rest are buckets whose members ``linking`` connects; links count only if the full sets confirm them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .common import blocks, discard, materialize, release
from .linking import bucket_components
from .neardup import _A, _B, _apart, _mix, Words, set_parities, shingle_sets

ENUMERATED = 12  # schemes of sets that differ in at most so many features enumerate cells


class Scheme(NamedTuple):
    number: int
    least: int  # sizes of the sets that it serves
    most: int
    parts: int
    cells: int  # of a part: 3, of which each two are a signature, or 1
    spare: int  # parts that may be empty


def scheme_of(number: int, start: int, end: int, percent: int) -> Scheme:
    """The scheme of the sizes from ``start`` to ``end``."""
    apart = (100 - percent) * 2 * end // (100 + percent)
    least = -(-percent * start // 100)
    if apart <= ENUMERATED:
        needed = apart // 2 + 1
        spare = int(needed >= 4)
        return Scheme(number, least, end, needed + spare, 3, spare)
    spare = math.ceil(3 + 0.08 * apart)
    return Scheme(number, least, end, apart + 1 + spare, 1, spare)


def schemes(percent: int, largest: int, ratio: float = 1.4) -> list[Scheme]:
    """Schemes for sets of up to ``largest`` features. Sets so small that linked ones are equal need none."""
    start, out = 1, []
    while (100 - percent) * (2 * start + 1) < 100 + percent:  # sets of start and start + 1 features can't link
        start += 1
    while start <= largest:
        end = max(start + 5, int(start * ratio))
        out.append(scheme_of(len(out) + 1, start, end, percent))
        start = end + 1
    return out


def scheme_signatures(sets: list[np.ndarray], scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, how many each set has) of sorted sets of hashes."""
    n, cells = len(sets), scheme.parts * scheme.cells
    flat = np.concatenate(sets)
    cell = ((flat >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
    cell += np.repeat(np.arange(n) * cells, [len(s) for s in sets])
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    total, held = np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.int64)
    total[cell[starts]] = np.add.reduceat(_mix(flat * _B), starts)
    held[cell[starts]] = np.diff(np.concatenate([starts, [len(cell)]]))
    if scheme.cells == 1:
        total, held = total.reshape(n, cells), held.reshape(n, cells)
        empty_parts = (held == 0).sum(axis=1)
    else:
        total, held = total.reshape(n, scheme.parts, 3), held.reshape(n, scheme.parts, 3)
        total, held = total.sum(axis=2, keepdims=True) - total, held.sum(axis=2, keepdims=True) - held
        empty_parts = (held == 0).any(axis=2).sum(axis=1)
        total, held = total.reshape(n, cells), held.reshape(n, cells)
    given = (held > 0) | (empty_parts > scheme.spare)[:, None]
    salt = _mix((np.arange(cells, dtype=np.uint64) + np.uint64(scheme.number << 40)) * _A)
    return _mix((total ^ salt) * _A)[given], given.sum(axis=1)


def signatures(sets: list[np.ndarray], found: list[Scheme]) -> list[np.ndarray]:
    """Signatures of each set under the schemes that serve its size."""
    out, sizes = [[] for _ in sets], np.array([len(s) for s in sets])
    for scheme in found:
        own = np.flatnonzero((sizes >= scheme.least) & (sizes <= scheme.most))
        if len(own):
            keys, n = scheme_signatures([sets[i] for i in own], scheme)
            for i, part in zip(own.tolist(), np.split(keys, np.cumsum(n)[:-1])):
                out[i].append(part)
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, node) in order: those whose key several nodes have, with the key's least node and the one before."""
    last_key, last_node, least, single = None, None, None, False  # of the rows so far; single: the last row isn't given out yet
    for batch in batches:
        key, node = (batch[c].to_numpy() for c in ("key", "node"))
        if not len(key):
            continue
        if last_key is not None:
            key, node = np.concatenate([[last_key], key]), np.concatenate([[last_node], node])
        keep = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])  # copies of a set
        key, node = key[keep], node[keep]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        first = node[starts].copy()
        if last_key is not None and not single:
            first[0] = least  # the run goes on from an earlier batch
        before = np.concatenate([[first[0]], node[:-1]])
        before[new] = node[new]
        several = np.bincount(run)[run] > 1
        if last_key is not None:
            several[0] = single and several[0]  # given out already, or with its first companion
        out = np.flatnonzero(several)
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (key, node, first[run], before)], ["key", "node", "least", "before"])
        last = run == run[-1]
        continued = last_key is not None and run[-1] == 0 and not single
        last_key, last_node, least = key[-1], node[-1], first[-1]
        single = int(last.sum()) == 1 and not continued


def jaccard_components(docs: DataFrame, shingle_words: int = 4, percent: int = 85, bits: int = 1024, rounds: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Links documents whose shingle sets have 100 * intersection >= percent * union, and names each document's component.

    Texts are lower-cased in A-Z and split at ASCII white space; a shingle is ``shingle_words`` words in a row, of shorter texts the
    whole. No link is missed: linked sets share a signature, whatever their sizes.

    Returns id_col, n_shingles, component_id (least id reachable, the own included).

    Null texts and texts without words have no shingles and are linked with nothing. Rows with null ids have a null component
    and link nothing. Repeated rows share an id; rows of equal ids and different texts each follow their own text. An empty
    table gives no rows; other columns take no part.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words64 = bits // 64
    pars = [f"par{i}" for i in range(words64)]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, known = Words(), set(), []
        for batch in blocks(batches, "text"):
            ids = batch["doc_id"]
            sets = shingle_sets(batch["text"].cast(pa.binary()).to_pylist(), shingle_words, words)
            size = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(size)
            maps, digest, keys = np.zeros((len(sets), words64), np.uint64), np.zeros((len(sets), 2), np.int64), [np.zeros(0, np.uint64)] * len(sets)
            if len(some):
                full = [sets[i] for i in some]
                maps[some] = set_parities(full, bits)
                digest[some] = np.frombuffer(b"".join(xxh3_128_digest(s.tobytes()) for s in full), np.int64).reshape(-1, 2)
                if not known or known[-1].most < size.max():
                    known = schemes(percent, int(size.max()))
                if len(seen) > 500_000:
                    seen = set()
                fresh = []
                for i in some.tolist():
                    name = (digest[i, 0].item(), digest[i, 1].item())
                    if name not in seen and ids[i].is_valid:  # a copy's signatures are its original's
                        seen.add(name)
                        fresh.append(i)
                for i, k in zip(fresh, signatures([sets[i] for i in fresh], known)):
                    keys[i] = k
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]), pa.int32())
            cols = [ids, pa.array(size), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys).view(np.int64)))]
            cols += [pa.array(np.ascontiguousarray(maps[:, i]).view(np.int64)) for i in range(words64)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "lo", "hi", "keys", *pars])
        del words, seen
        release()

    all_rows = materialize(source.mapInArrow(signed, "doc_id long, n long, lo long, hi long, keys array<long>, " + ", ".join(f"{p} long" for p in pars)), "partenum-signed")

    # A node is a shingle set, named by the first half of its digest; where two sets agree in it, by a hash of the whole.
    own = all_rows.filter("n > 0 AND doc_id IS NOT NULL")
    classes = materialize(own.groupBy("lo", "hi").agg(F.min("doc_id").alias("least_id"), F.first("n").alias("n"), *(F.first(p).alias(p) for p in pars)), "partenum-classes")
    twice = [r["lo"] for r in classes.groupBy("lo").agg(F.min("hi").alias("a"), F.max("hi").alias("b")).filter("a < b").select("lo").limit(100_001).collect()]
    if len(twice) > 100_000:  # expected: the square of the number of sets over 2 ** 65
        raise RuntimeError("too many sets agree in 64 bits of their digests")
    node = F.when(F.col("lo").isin(twice), F.xxhash64("lo", "hi")).otherwise(F.col("lo")) if twice else F.col("lo")
    nodes = classes.withColumn("node", node)

    rows = own.select(F.explode("keys").alias("key"), node.alias("node")).repartition("key").sortWithinPartitions("key", "node")
    members = materialize(rows.mapInArrow(_shared, "key long, node long, least long, before long").withColumn("band", F.pmod("key", F.lit(8))), "partenum-members")
    stars = members.select(F.col("node").alias("x"), F.explode(F.array("least", "before")).alias("y")).filter("x <> y").distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in blocks(batches, "text"):
            found, nodes_of = [], []
            for s, wanted in zip(shingle_sets(batch["text"].cast(pa.binary()).to_pylist(), shingle_words, words), batch["wanted"].to_pylist()):
                lo, hi = np.frombuffer(xxh3_128_digest(s.tobytes()), np.int64).tolist()
                if named := [w["node"] for w in wanted if (w["lo"], w["hi"]) == (lo, hi)]:
                    found.append(s.view(np.int64))
                    nodes_of.append(named[0])
            if found:
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in found])]), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(nodes_of, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))], ["node", "shingles"])
        del words
        release()

    written: list[DataFrame] = []

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Compares full sets, made again from the texts of the nodes of these pairs alone."""
        discard(*written)
        written.clear()
        pairs = materialize(pairs.select("x", "y"), "partenum-pairs")
        asked = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct().join(nodes.select("node", "lo", "hi", "least_id"), "node")
        asked = asked.groupBy(F.col("least_id").alias("doc_id")).agg(F.collect_list(F.struct("node", "lo", "hi")).alias("wanted"))  # the texts of one id
        texts = source.filter("text IS NOT NULL").join(asked, "doc_id").select("text", "wanted")
        full = materialize(texts.mapInArrow(sets, "node long, shingles array<long>"), "partenum-sets")
        written.extend([pairs, full])
        if full.count() > full.select("node").distinct().count():  # rows repeat: one of each set is enough
            written.append(full := materialize(full.dropDuplicates(["node"]), "partenum-sets"))
        a, b = full.select(F.col("node").alias("x"), F.col("shingles").alias("s")), full.select(F.col("node").alias("y"), F.col("shingles").alias("t"))
        held = pairs.join(a, "x").join(b, "y").withColumn("both", F.size(F.array_intersect("s", "t")))
        return held.filter(F.col("both") * 100 >= (F.size("s") + F.size("t") - F.col("both")) * percent).select(F.col("x").alias("a"), F.col("y").alias("b"))

    def close(a: str, b: str) -> Column:
        """percent * union <= 100 * intersection means (100 + percent) * different <= (100 - percent) * (size of a + size of b)."""
        sizes = F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent
        return sizes & (_apart(a, b, "par", words64) * (100 + percent) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent))

    info = nodes.select("node", "n", *pars)
    component = bucket_components(members, stars, info, close, lambda a, b: _apart(a, b, "par", words64), confirmed, rounds, "partenum", pairs_a_row=500)
    placed = nodes.select("node", "lo", "hi", "least_id").join(component, "node")
    names = placed.groupBy("component").agg(F.min("least_id").alias("name"))
    named = placed.join(names, "component").select("lo", "hi", F.col("name").alias("component_id"))
    named = materialize(classes.select("lo", "hi", "least_id").join(named, ["lo", "hi"], "left").select("lo", "hi", F.coalesce("component_id", "least_id").alias("component_id")), "partenum-names")
    discard(members, classes, component, *written)
    out = all_rows.select("doc_id", "n", "lo", "hi").join(named, ["lo", "hi"], "left")
    found = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).cast("long")
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), found.alias("component_id"))
