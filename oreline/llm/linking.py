"""Links of buckets: which nodes that share a bucket are connected, without comparing all pairs of a bucket that is settled.

Each node first meets a few of its buckets' nodes; these links are joined to components. A few more rounds take a random pivot of
each bucket that still holds several components; a bucket whose members are of one component is done and drops out for good.
What is left in the end, pairs of one bucket in different components, is compared in full, each pair in the first of its common
buckets: groups of copies cost a few rows a node, and no link between different components is passed over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize
from .graph import connected_components

Pairs = Callable[[DataFrame], DataFrame]
Compared = Callable[[str, str], Column]
HELD = 64  # keys that a row of an open bucket knows of its node


def bucket_pairs(rows: DataFrame, info: DataFrame, close: Compared, name: str) -> tuple[DataFrame, DataFrame]:
    """(written table to discard, pairs (x, y) of different components that share a bucket and are close).

    A row carries those of its node's ``HELD`` least keys that come before its own, and two rows that have one of them in common met
    there. So a pair is given once, unless its first common key isn't among the least of both: such a pair can come several times.
    """
    held = rows.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("key")), 1, HELD).alias("held"))
    left = rows.select("node", "key", "component").join(info, "node").join(held, "node")
    left = materialize(left.withColumn("earlier", F.filter("held", lambda k: k < F.col("key"))).drop("held"), f"{name}-left")
    mates = (F.col("a.key") == F.col("b.key")) & (F.col("a.component") < F.col("b.component"))
    cross = left.alias("a").join(left.alias("b"), mates & close("a", "b") & ~F.arrays_overlap("a.earlier", "b.earlier"))
    return left, cross.select(F.col("a.node").alias("x"), F.col("b.node").alias("y"))


def bucket_components(members: DataFrame, stars: DataFrame, info: DataFrame, close: Compared, differ: Compared, confirmed: Pairs, rounds: int, name: str, pairs_a_row: int = 0) -> DataFrame:
    """(node, component) of the nodes that have a link; the component is its least node.

    ``members`` (node, key, band) are the buckets, of which a round takes those of an eighth of the bands. ``stars`` (x, y) are the
    first pairs to look at. ``info`` holds what ``close(a, b)``, a condition that every link meets, and ``differ(a, b)``, an order of
    likely links, read of each node as fields of a and b. ``confirmed`` turns pairs (x, y) into links (a, b). Rounds of pivots end
    early where the full comparison of what is open needs at most ``pairs_a_row`` pairs for each of its rows, so in proportion to it.
    """
    side = lambda x: info.select(F.col("node").alias(x), F.struct(*(c for c in info.columns if c != "node")).alias(f"{x}_info"))

    def sifted(pairs: DataFrame) -> DataFrame:
        near = pairs.join(side("x"), "x").join(side("y"), "y").filter(close("x_info", "y_info"))
        return near.select("x", "y", differ("x_info", "y_info").alias("differ"))

    def linked(pairs: DataFrame) -> DataFrame:
        return materialize(confirmed(pairs.groupBy("x").agg(F.min_by("y", "differ").alias("y"))), f"{name}-links")

    first = materialize(sifted(stars), f"{name}-stars")
    written = [linked(first)]
    links = written[0]
    component = connected_components(links)

    # Where a node's likeliest link left it apart from others that it met, all of these are looked at.
    of = lambda x: component.select(F.col("node").alias(x), F.col("component").alias(f"{x}_component"))
    apart = first.join(of("x"), "x", "left").join(of("y"), "y", "left").filter(F.coalesce("x_component", "x") != F.coalesce("y_component", "y"))
    apart = materialize(apart.select("x", "y"), f"{name}-apart")
    written.append(apart)
    if apart.limit(1).count():
        written.append(materialize(confirmed(apart), f"{name}-links"))
        links = links.unionByName(written[-1])
        discard(component)
        component = connected_components(links)

    def still_open(rows_left: DataFrame) -> DataFrame:
        placed = rows_left.select("node", "key", "band").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
        split = placed.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c < d").select("key")
        return materialize(placed.join(split, "key"), f"{name}-open")

    open_rows = still_open(members)
    unsettled = lambda: open_rows.limit(1).count() > 0

    def dear() -> bool:
        sizes = open_rows.groupBy("key").count().agg(F.sum(F.col("count") * F.col("count")).alias("pairs"), F.sum("count").alias("rows")).first()
        return (sizes["pairs"] or 0) > pairs_a_row * (sizes["rows"] or 0)

    for r in range(rounds if unsettled() else 0):
        if pairs_a_row and not dear():
            break
        some = open_rows.filter(F.col("band") % 8 == r % 8)  # an eighth of the bands a round: a few pivots a node
        pivots = some.withColumn("h", F.xxhash64("node", "key", F.lit(r))).groupBy("key").agg(F.min_by("node", "h").alias("y"), F.min_by("component", "h").alias("other"))
        pairs = some.join(pivots, "key").filter("component <> other").select(F.col("node").alias("x"), "y").distinct()
        more = linked(sifted(pairs))
        written.append(more)
        if not more.limit(1).count():
            break
        links = links.unionByName(more)
        discard(component)
        component = connected_components(links)
        before, open_rows = open_rows, still_open(open_rows)
        discard(before)
        if not unsettled():
            break

    if unsettled():
        left, cross = bucket_pairs(open_rows, info, close, name)
        rest = materialize(cross.distinct(), f"{name}-rest")
        written += [left, rest, materialize(confirmed(rest), f"{name}-links")]
        discard(component)
        component = connected_components(links.unionByName(written[-1]))
    discard(first, open_rows, *written)
    return component
