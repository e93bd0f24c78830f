"""Merkle manifest of a dataset: aligned blocks of leaves become numpy matrices of hex digests, hashed level by level.

A leaf's rank in its group comes from counts of range partitions, so no group is sorted in one task. ``fanout ** levels`` ranks
in a row make a block, whose leaves stand in one matrix of 64 hex digits a row. Reshaped by the fanout its rows are the inputs
of the next level, and a node's run and siblings follow from its index. A block's root is a leaf of the next tree of blocks, so a
group of any size takes a few rounds of small blocks: one for each factor of ``fanout ** levels``. Proofs come down the same
way: a block gets the path of its root and completes it for each of its nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

HEX = 64
STEPS = "array<struct<before:string,after:string>>"
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def row_digest(*fields: str | Column) -> Column:
    """sha256 of a row: of each field its UTF-8 byte count, a colon and its value, or ``-`` for null."""
    text = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text)), 256)


def ascii_lowered(text: str) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def height(n: int, fanout: int) -> int:
    """Levels that turn ``n`` nodes into one."""
    h = 0
    while n > 1:
        n, h = -(-n // fanout), h + 1
    return h


def matrix(digests: list[str]) -> np.ndarray:
    return np.frombuffer("".join(digests).encode(), np.uint8).reshape(-1, HEX)


def levels_of(leaves: np.ndarray, steps: int, fanout: int) -> list[np.ndarray]:
    """Digest matrices of ``steps`` further levels: each row is the hash of up to ``fanout`` rows below, the last run's may be fewer."""
    out = [leaves]
    for _ in range(steps):
        below = out[-1]
        whole = len(below) // fanout
        runs = [row.tobytes() for row in below[: whole * fanout].reshape(whole, fanout * HEX)]
        if rest := below[whole * fanout :].tobytes():
            runs.append(rest)
        out.append(matrix([sha256(run).hexdigest() for run in runs]))
    return out


def siblings(levels: list[np.ndarray], fanout: int) -> list[list[tuple[bytes, bytes]]]:
    """For each node of each level but the last: its run's digests before and after it."""
    out = []
    for level in levels[:-1]:
        data, at = level.tobytes(), np.arange(len(level))
        first = at // fanout * fanout
        last = np.minimum(first + fanout, len(level))
        cuts = (np.stack([first, at, at + 1, last], axis=1) * HEX).tolist()
        out.append([(data[a:b], data[c:d]) for a, b, c, d in cuts])
    return out


def path(i: int, own: list[list[tuple[str, str]]], upper: list[tuple[str, str]], fanout: int) -> Iterator[tuple[str, str]]:
    """Siblings before and after the ``i``-th node of a block and each of its ancestors, up to the top."""
    for level in own:
        yield level[i]
        i //= fanout
    yield from upper


def _as_steps(path: Iterator[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"before": b, "after": a} for b, a in path]


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their rank (from 0) in the group ``key`` and the group's size; ranks come from counts of range partitions."""
    ranged = materialize(rows.repartitionByRange("key", *order).withColumn("part", F.spark_partition_id()), f"{name}-ranged")
    counts = ranged.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))  # about a row a partition and group
    group = Window.partitionBy("key")
    bases = counts.select("key", "part", (F.sum("n").over(group.orderBy("part")) - F.col("n")).alias("base"), F.sum("n").over(group).alias("total"))
    inside = Window.partitionBy("key", "part").orderBy(*order)
    out = ranged.withColumn("place", F.row_number().over(inside) - 1).join(bases, ["key", "part"])
    out = materialize(out.select(*rows.columns, (F.col("base") + F.col("place")).alias("rank"), "total"), name)
    discard(ranged)
    return out


class Forest:
    """A tree for each ``key`` of ``leaves`` (key, rank, total, digest): its root, and a path from each leaf to it."""

    def __init__(self, leaves: DataFrame, fanout: int, levels: int, name: str):
        self.fanout, self.span, self.layers = fanout, fanout**levels, [leaves]
        self.levels, self.name = levels, name
        while (self.layers[-1].agg(F.max("total")).first()[0] or 0) > 1:  # one round for each ``levels`` levels of the highest tree
            self.layers.append(materialize(self._up(self.layers[-1]), f"{name}-layer"))

    def _up(self, layer: DataFrame) -> DataFrame:
        fanout, levels, span = self.fanout, self.levels, self.span

        def climb(group: tuple, rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("rank")
            total = rows["total"][0].as_py()
            top = levels_of(matrix(rows["digest"].to_pylist()), min(levels, height(total, fanout)), fanout)[-1]
            return pa.table({"key": [group[0].as_py()], "rank": [group[1].as_py()], "total": [-(-total // span)], "digest": [top.tobytes().decode()]})

        blocks = layer.select("key", "rank", "total", "digest", F.expr(f"rank div {span}").alias("block"))
        return blocks.groupBy("key", "block").applyInArrow(climb, "key string, rank long, total long, digest string")

    def roots(self) -> DataFrame:
        return self.layers[-1].select("key", "digest")

    def down(self, paths: DataFrame, finish, columns: list[str], schema: str) -> DataFrame:
        """``finish(rows, path of the i-th row)`` for each block of leaves; ``paths`` (key, steps) lead from each root to the top."""
        fanout, most = self.fanout, self.levels

        def pieces(i: int) -> DataFrame:
            return self.layers[i].withColumn("block", F.expr(f"rank div {self.span}"))

        def along(give):
            def walk(group: tuple, rows: pa.Table, above: pa.Table) -> pa.Table:
                rows = rows.sort_by("rank")
                upper = above["steps"][0].as_py()
                levels = levels_of(matrix(rows["digest"].to_pylist()), min(most, height(rows["total"][0].as_py(), fanout)), fanout)
                own = [[(b.decode(), a.decode()) for b, a in level] for level in siblings(levels, fanout)]
                upper = [(s["before"], s["after"]) for s in upper]
                return give(rows, lambda i: path(i, own, upper, fanout))

            return walk

        def paths_of(rows: pa.Table, to_top) -> pa.Table:
            return pa.table({"key": rows["key"], "block": rows["rank"], "steps": pa.array([_as_steps(to_top(i)) for i in range(rows.num_rows)], _STEPS)})

        paths, written = paths.select("key", F.lit(0).cast("long").alias("block"), "steps"), []
        for i in range(len(self.layers) - 2, 0, -1):
            paths = pieces(i).groupBy("key", "block").cogroup(paths.groupBy("key", "block")).applyInArrow(along(paths_of), f"key string, block long, steps {STEPS}")
            written.append(paths := materialize(paths, f"{self.name}-paths"))
        own = pieces(0).select("key", "block", "rank", "total", "digest", *columns)
        return own.groupBy("key", "block").cogroup(paths.groupBy("key", "block")).applyInArrow(along(finish), schema)

    def discard(self) -> None:
        discard(*self.layers[1:])


def dataset_manifest(
    docs: DataFrame, fields: list[str], group_col: str = "lang", id_col: str = "doc_id", tampered: Column | None = None, fanout: int = 8, levels: int = 4, keep_proof: bool = False
) -> DataFrame:
    """A leaf, its group's root, the whole root and the proof of each row, and whether the row as it is now still folds to the root.

    A leaf is ``row_digest`` of ``fields``. In a group leaves ascend by id; while there are several nodes, ``fanout`` in a row become
    the hash of their hex digests. The groups' roots, null first and then by the bytes of their names, become one root likewise.
    ``tampered`` is the digest of the row as it is found now; where it is null the original leaf counts.

    Returns id_col, leaf, subroot, root, proof_sha256 (of all siblings in order), folded_root, verified; with ``keep_proof`` also
    proof, the siblings before and after at each level.

    Null ids come first. Rows of equal ids are ordered by their leaf, repeated rows are leaves of their own. A null group is one
    of its own, apart from the empty name. An empty table gives no rows; other columns take no part. Rows equal in everything
    stand in one range.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(group_col)), F.lit(""))  # null is first, and no name
    leaves = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("doc_id"), row_digest(*fields).alias("digest"), (F.lit(None).cast("string") if tampered is None else tampered).alias("changed"))
    hashed = materialize(leaves, "merkle-leaves")  # texts are read once
    leaves = _ranked(hashed, ["doc_id", "digest", "changed"], "merkle-ranked")
    trees = Forest(leaves, fanout, levels, "merkle")
    groups = _ranked(trees.roots().select(F.lit("").alias("key"), F.col("key").alias("name"), "digest"), ["name"], "merkle-groups")
    top = Forest(groups, fanout, levels, "merkle-top")
    root = (top.roots().first() or [None, None])[1]  # one row

    def group_paths(rows: pa.Table, to_top) -> pa.Table:
        return pa.table({"key": rows["name"], "steps": pa.array([_as_steps(to_top(i)) for i in range(rows.num_rows)], _STEPS)})

    none = top.roots().select("key", F.array().cast(STEPS).alias("steps"))
    paths = materialize(top.down(none, group_paths, ["name"], f"key string, steps {STEPS}"), "merkle-group-paths")

    def proofs(rows: pa.Table, to_top) -> pa.Table:
        out = {"proof_sha256": [], "folded_root": []}
        kept = []
        for i, (leaf, changed) in enumerate(zip(rows["digest"].to_pylist(), rows["changed"].to_pylist())):
            steps, seen, node = list(to_top(i)), sha256(), changed or leaf
            for before, after in steps:
                seen.update((before + after).encode())
                node = sha256((before + node + after).encode()).hexdigest()
            out["proof_sha256"].append(seen.hexdigest())
            out["folded_root"].append(node)
            if keep_proof:
                kept.append(_as_steps(steps))
        proof = {"proof": pa.array(kept, _STEPS)} if keep_proof else {}
        return pa.table({"doc_id": rows["doc_id"], "key": rows["key"], "leaf": rows["digest"]} | out | proof)

    proven = trees.down(paths, proofs, ["doc_id", "changed"], "doc_id long, key string, leaf string, proof_sha256 string, folded_root string" + f", proof {STEPS}" * keep_proof)
    out = proven.join(trees.roots().select("key", F.col("digest").alias("subroot")), "key").withColumn("root", F.lit(root))
    discard(hashed)
    return out.select(F.col("doc_id").alias(id_col), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), *["proof"] * keep_proof)
