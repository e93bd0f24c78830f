"""Citation graph and admission: references paired with candidates, typed relations with their inverses, identifier gates, reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..functions.names import citation_tokens
from ..functions.text import canonical_newlines, norm_title
from .storage import drop, written


def doi_index(works: DataFrame, work: str, value: str) -> DataFrame:
    """(doi, work): the least work of each normalised DOI; values that are no DOI have no row."""
    return works.select(I.doi(value).alias("doi"), work).filter("doi <> ''").groupBy("doi").agg(F.min(work).alias(work))


def resolve(references: DataFrame, index: DataFrame, doi: str, title: str, held_title: str) -> DataFrame:
    """References looked up by their own DOI: resolved where the held title agrees (equal when normalised), mismatch where it doesn't,
    unknown where the DOI isn't held, no-doi without one."""
    r = references.withColumn("doi", I.doi(doi)).join(index, "doi", "left")
    state = F.when(F.col("doi") == "", F.lit("no-doi")).when(F.col(held_title).isNull(), F.lit("unknown")).when(norm_title(title) == norm_title(held_title), F.lit("resolved")).otherwise(F.lit("mismatch"))
    return r.withColumn("state", state)


def pair_candidates(references: DataFrame, edges: DataFrame, candidates: DataFrame, paper: str, most: int = 2000) -> DataFrame:
    """References without an edge and candidates of each paper, paired by position: ok where the title and the first ``most`` characters
    of the text agree, mismatch where not, and count where the paper has not as many of one as of the other.

    references: paper, pos, ref_key, raw, title; edges: paper, ref_key; candidates: paper, pos, raw (cut already), title."""
    w = Window.partitionBy(paper).orderBy("pos")
    open_refs = references.join(edges.select(paper, "ref_key"), [paper, "ref_key"], "left_anti").withColumn("_k", F.row_number().over(w))
    cands = candidates.select(paper, F.col("raw").alias("_raw"), F.col("title").alias("_title"), F.row_number().over(w).alias("_k"))
    both = open_refs.groupBy(paper).agg(F.count(F.lit(1)).alias("_n")).join(cands.groupBy(paper).agg(F.count(F.lit(1)).alias("_m")), paper, "full")
    j = open_refs.join(cands, [paper, "_k"], "left").join(both, paper)
    state = F.when(~F.col("_n").eqNullSafe(F.col("_m")), F.lit("count")).when(F.substring(F.coalesce("raw", F.lit("")), 1, most).eqNullSafe(F.col("_raw")) & F.col("title").eqNullSafe(F.col("_title")), F.lit("ok")).otherwise(F.lit("mismatch"))
    return j.select(paper, "ref_key", "_k", state.alias("state")).withColumnRenamed("_k", "place")


def copy_identifiers(own: DataFrame, relations: DataFrame, work: str) -> DataFrame:
    """Identifiers by which a copy of a work may be reached: its own, then its relations' targets, each once, the first way first.

    own: work, scheme, value; relations: work, scheme, value, relation, seq."""
    rows = own.select(work, "scheme", "value", F.lit("own").alias("via"), F.lit(-1).cast("long").alias("_s")).unionByName(relations.select(work, "scheme", "value", F.col("relation").alias("via"), F.col("seq").cast("long").alias("_s")))
    first = rows.groupBy(work, "scheme", "value").agg(F.min(F.struct("_s", "via")).alias("_f"))
    return first.select(work, "scheme", "value", F.col("_f.via").alias("via"))


def with_inverses(edges: DataFrame, inverse: dict[str, str]) -> DataFrame:
    """Typed edges (source, relation, target) and their inverses, each once; a relation without an inverse stands alone."""
    names = F.create_map(*(F.lit(x) for pair in inverse.items() for x in pair))
    back = edges.select(F.col("target").alias("source"), names[F.col("relation")].alias("relation"), F.col("source").alias("target")).filter("relation IS NOT NULL")
    return edges.select("source", "relation", "target").unionByName(back).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """(node, cites, cited) of a citation graph's edges (citing, cited)."""
    each = edges.select(F.col("citing").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("cited").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return each.groupBy("node").agg(F.sum("o").alias("cites"), F.sum("i").alias("cited"))


def admission(claims: DataFrame, identifiers: DataFrame, similar: DataFrame, claim: str) -> DataFrame:
    """What to do with each claimed work: duplicate of the holder of its identifier, else similar to the most similar title, else admit.

    claims: claim, value; identifiers: value, work; similar: claim, work, score."""
    held = identifiers.groupBy("value").agg(F.min("work").alias("_exact"))
    best = similar.groupBy(claim).agg(F.max_by("work", F.struct("score", -F.col("work"))).alias("_near"))
    j = claims.join(held, "value", "left").join(best, claim, "left")
    return j.select(claim, F.when(F.col("_exact").isNotNull(), F.lit("duplicate")).when(F.col("_near").isNotNull(), F.lit("similar")).otherwise(F.lit("admit")).alias("decision"), F.coalesce("_exact", "_near").alias("work"))


def order_violations(snippets: DataFrame, keys: list[str], order: str, found: str) -> DataFrame:
    """Snippets that weren't found, or were found before the furthest place that one before them had reached."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return snippets.withColumn("_far", F.coalesce(F.max(found).over(w), F.lit(-1))).filter(F.col(found).isNull() | (F.col(found) < F.col("_far"))).drop("_far")


def review_findings(reviews: DataFrame, blocks: DataFrame, review: str, text: str) -> DataFrame:
    """(review, pos, finding) of each citation of a review that breaks a rule: no such block, another page, another work; rules in this order.

    blocks: block_id, work_key, page."""
    cited = reviews.select(review, F.posexplode(citation_tokens(text)).alias("pos", "c")).select(review, "pos", "c.*")
    held = blocks.select("block_id", F.col("work_key").alias("_work"), F.col("page").alias("_page"))
    finding = F.when(F.col("_work").isNull(), F.lit("no-such-block")).when(F.col("_work") != F.col("work_key"), F.lit("another-work")).when(F.col("_page") != F.col("page"), F.lit("another-page"))
    return cited.join(held, "block_id", "left").select(review, "pos", finding.alias("finding")).filter("finding IS NOT NULL")


def ranked_rules(items: DataFrame, rules: DataFrame, item: str, host: Column, most: int) -> DataFrame:
    """Candidates that rules make of items: a rule serves the hosts that end with its suffix (whole labels); each item's distinct urls by
    score, ``most`` of them. rules (a small table that people write): suffix, template with {id}, score."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = items.withColumn("suffix", F.explode(suffixes)).join(rules, "suffix")
    urls = met.withColumn("url", F.replace(F.col("template"), F.lit("{id}"), F.col(item).cast("string"))).groupBy(item, "url").agg(F.max("score").alias("score"))
    return urls.withColumn("rank", F.row_number().over(Window.partitionBy(item).orderBy(F.desc("score"), "url"))).filter(F.col("rank") <= most)


#: Which end of a relation is the child, and which of its parents the other end is.
PARENTS = {
    "is_part_of": ("part_of", "source"), "has_part": ("part_of", "target"), "is_preprint_of": ("version_of", "source"),
    "is_version_of": ("version_of", "source"), "has_preprint": ("version_of", "target"), "has_version": ("version_of", "target"),
}


def parent_fills(held: DataFrame, edges: DataFrame) -> DataFrame:
    """(seq, work, kind, parent, outcome) of the edges that name a parent: ``filled`` by the first where none is held, ``held`` where it is
    the one that stands, else ``kept-existing``.

    held: work, kind, parent; edges: seq, source, relation, target. An edge to itself or without an end names none."""
    pick = lambda i: F.create_map(*(F.lit(x) for name, of in PARENTS.items() for x in (name, of[i])))[F.col("relation")]
    named = edges.withColumns({"kind": pick(0), "_child": pick(1)}).filter("kind IS NOT NULL AND source <> target")
    of_source = F.col("_child") == "source"
    named = named.select("seq", F.when(of_source, F.col("source")).otherwise(F.col("target")).alias("work"), "kind", F.when(of_source, F.col("target")).otherwise(F.col("source")).alias("parent"))
    first = named.groupBy("work", "kind").agg(F.min(F.struct("seq", "parent")).alias("_f"))
    j = named.join(first, ["work", "kind"]).join(held.select("work", "kind", F.col("parent").alias("_held")), ["work", "kind"], "left")
    outcome = F.when(F.col("_held").isNull() & (F.col("seq") == F.col("_f.seq")), "filled").when(F.col("parent") == F.coalesce("_held", F.col("_f.parent")), "held").otherwise("kept-existing")
    return j.select("seq", "work", "kind", "parent", outcome.alias("outcome"))


def ancestors(parents: DataFrame) -> DataFrame:
    """(node, top, depth) of each node with a parent: the last of its chain of parents and how many steps away; null on a circle or above one.

    parents: node, parent (one each). Each round doubles the steps that every node has made. Where a round ends no further chain only
    circles are left: any other chain, however long, has nodes on it that would have ended."""
    state = written(parents.select("node", F.col("parent").alias("at"), F.lit(1).cast("long").alias("depth")), "ancestors")
    left = None
    while True:
        on = state.select(F.col("node").alias("_n"), F.col("at").alias("_at"), F.col("depth").alias("_d"))
        step = state.select("node", "at", "depth").join(on, F.col("at") == F.col("_n"), "left")
        after = written(step.select("node", F.coalesce("_at", "at").alias("at"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"), F.col("_n").isNotNull().alias("on")), "ancestors")
        n = after.filter("on").count()
        drop(state)
        state = after
        if n in (0, left):
            return state.select("node", F.when(~F.col("on"), F.col("at")).alias("top"), F.when(~F.col("on"), F.col("depth")).alias("depth"))
        left = n


def mention_totals(mentions: DataFrame, keys: list[str]) -> DataFrame:
    """The numbers that a count of mentions can mean: rows of boxes, elements, elements without a target, and those that can be verified."""
    first = F.col("box_index") == 0
    bare = first & (F.coalesce(F.col("target"), F.lit("")) == "")
    n = lambda c: F.count_if(c)
    return mentions.groupBy(*keys).agg(F.count(F.lit(1)).alias("box_rows"), n(first).alias("elements"), n(bare).alias("without_target"), (n(first) - n(bare)).alias("verifiable"))


def verified_lines(evidence: DataFrame, quote: str, location: list[str]) -> tuple[DataFrame, DataFrame]:
    """(lines, defects): promotable quotes with their line ends made one; a quote that lacks part of its location is a defect, named by
    what is missing."""
    missing = F.array_compact(F.array(*(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(c)) for c in location)))
    lines = evidence.filter(F.coalesce(F.col("promotable"), F.lit(False))).withColumns({quote: canonical_newlines(quote), "_missing": missing})
    return lines.filter(F.size("_missing") == 0).drop("_missing"), lines.filter(F.size("_missing") > 0).select(*[c for c in evidence.columns if c != quote], F.array_join("_missing", ",").alias("missing"))
