"""Retrieval over inverted indexes: token and trigram legs, reciprocal-rank fusion, containment of passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_newlines, norm_title, tokens, trigrams
from .storage import dealt, written


#: What kinds of blocks a search looks into unless asked otherwise, and all there are.
DEFAULT_KINDS = ["title", "author", "affiliation", "abstract", "heading", "paragraph", "list_item", "footnote", "caption", "table", "figure", "equation", "sidebar"]
ALL_KINDS = [*DEFAULT_KINDS, "reference", "page_header", "page_footer", "page_number", "other"]


def stem(w: Column) -> Column:
    """A word without its inflection: plural s, then ed or ing where a vowel is left, then y as i. Suffixes only, no word list."""
    w = F.regexp_replace(F.regexp_replace(w, "(ss|i)es$", "$1"), "([^su])s$", "$1")
    bare = F.regexp_replace(w, "(ed|ing)$", "")
    w = F.when(w.rlike("(ed|ing)$") & bare.rlike("[aeiouy]"), bare).otherwise(w)
    return F.regexp_replace(w, "([^aeiou])y$", "$1i")


def kinds_of(spec: str) -> list[str]:
    """Block kinds that a search looks into: the default ones for an empty spec, every one for ``all``, else the named ones; an unknown
    name is an error, never a silently smaller search."""
    spec = spec.strip().lower()
    asked = DEFAULT_KINDS if not spec else ALL_KINDS if spec == "all" else [k.strip() for k in spec.split(",") if k.strip()]
    if bad := sorted(set(asked) - set(ALL_KINDS)):
        raise ValueError(f"not a block kind: {', '.join(bad)}")
    return list(asked)


def visible(blocks: DataFrame, files: DataFrame, file: str, run: str, current: str, kind: str | None = None, spec: str = "", workstreams: list[str] | None = None, workstream: str | None = None) -> DataFrame:
    """Blocks that a search may see: of each file's current run, of the kinds asked for, and of no workstream or one of those named."""
    out = blocks.join(files.select(file, current), file).filter(F.col(run) == F.col(current)).drop(current)
    if kind:
        out = out.filter(F.col(kind).isin(kinds_of(spec)))
    return out if workstream is None else out.filter(F.col(workstream).isNull() | F.col(workstream).isin(workstreams or []))


def query_terms(queries: DataFrame, query_id: str, text: str, stemmed: bool = False) -> DataFrame:
    """(query, token): the distinct tokens of each query."""
    words = F.transform(tokens(text), stem) if stemmed else tokens(text)
    return queries.select(query_id, F.explode(F.array_distinct(words)).alias("token"))


def token_index(docs: DataFrame, doc_id: str, text: str, terms: DataFrame | None = None, stemmed: bool = False, most_broadcast: int = 200_000, rows_a_task: int = 1000) -> DataFrame:
    """(token, doc_id, tf): the postings of every document; with ``terms`` only those of its tokens.

    Documents are dealt to tasks of about ``rows_a_task``, as they may come in few files. Up to ``most_broadcast`` distinct terms are
    broadcast, so other tokens never leave those tasks; more are joined."""
    words = F.transform(tokens(text), stem) if stemmed else tokens(text)
    each = dealt(docs.select(doc_id, text), doc_id, rows_a_task).select(doc_id, F.explode(words).alias("token"))
    if terms is not None:
        wanted = terms.select("token").distinct()
        small = wanted.limit(most_broadcast + 1).count() <= most_broadcast
        each = each.join(F.broadcast(wanted) if small else wanted, "token", "left_semi")
    return each.groupBy("token", doc_id).agg(F.count(F.lit(1)).alias("tf"))


def any_term_leg(queries: DataFrame, index: DataFrame, query_id: str, doc_id: str, text: str, all_terms: bool = False, stemmed: bool = False) -> DataFrame:
    """(query, doc, score): documents that hold any (or all) of a query's distinct tokens, scored by the sum over them of
    1 - 1 / (1 + tf). Postings meet queries in an equi-join on the token."""
    terms = query_terms(queries, query_id, text, stemmed)
    hits = terms.join(index, "token").groupBy(query_id, doc_id).agg(F.round(F.sum(1 - 1 / (1 + F.col("tf"))), 6).alias("score"), F.count(F.lit(1)).alias("_n"))
    if all_terms:
        hits = hits.join(terms.groupBy(query_id).agg(F.count(F.lit(1)).alias("_all")), query_id).filter("_n = _all")
    return hits.select(query_id, doc_id, "score")


def trigram_leg(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, text: str, floor: float = 0.3) -> DataFrame:
    """(query, doc, score): documents whose trigram set is similar to the query's by ``floor`` or more.

    The trigram index gives the size of the intersection by counting; the sizes of both sets give the Jaccard index."""
    left = queries.select(query_id, trigrams(text).alias("g")).select(query_id, F.size("g").alias("_a"), F.explode("g").alias("gram"))
    right = docs.select(doc_id, trigrams(text).alias("g")).select(doc_id, F.size("g").alias("_b"), F.explode("g").alias("gram"))
    both = left.join(right, "gram").groupBy(query_id, doc_id).agg(F.count(F.lit(1)).alias("_n"), F.min("_a").alias("_a"), F.min("_b").alias("_b"))
    return both.select(query_id, doc_id, F.round(F.col("_n") / (F.col("_a") + F.col("_b") - F.col("_n")), 6).alias("score")).filter(F.col("score") >= floor)


def _distinct_grams(passages: list[str]) -> tuple[np.ndarray, np.ndarray, int] | None:
    """The different trigrams of normalised passages, each word padded with two blanks before and one behind: sorted whole numbers of the
    passage and the places of three characters among those that occur, these, and the bits of a place; none where 63 bits don't suffice."""
    padded = [f"{p.replace(' ', '   ')}   " for p in passages]
    c = np.frombuffer(("  " + "".join(padded)).encode("utf-32-le"), np.uint32)
    there = np.zeros(int(c.max(initial=32)) + 1, bool)
    there[c] = there[32] = True
    characters = np.flatnonzero(there)
    bits = max(1, int(len(characters) - 1).bit_length())
    if 3 * bits + len(passages).bit_length() > 63:
        return None
    kind = np.int32 if 3 * bits + len(passages).bit_length() < 32 else np.int64
    place = (np.cumsum(there, dtype=kind) - kind(1))[c]
    blank = c == 32
    keep = ~(blank[1:-1] & blank[2:])  # none from word to word, nor over a passage's end, where three blanks stand
    owner = np.repeat(np.arange(len(passages), dtype=kind) << kind(3 * bits), [len(p) for p in padded])
    grams = (owner | place[:-2] << kind(2 * bits) | place[1:-1] << kind(bits) | place[2:])[keep]
    grams.sort()
    return grams[np.concatenate([[True], grams[1:] != grams[:-1]])] if len(grams) else grams, characters, bits


def _close_passages(asked: list[tuple], floor: float, step: int, at_once: int = 1 << 19):
    """A function of batches (doc, _n, pieces, whole) that gives (query, doc, score) of passages close enough to a query (number, size, trigrams).

    ``pieces`` are ``step`` characters of the text each, normalised, ``_n`` is the length of the text; a passage is as many pieces as
    fill its size. Where they are null, ``whole`` has the passages of each size. Passages meet only queries of their size. Their
    trigrams become whole numbers and are sorted, so that each counts once; a trigram that queries hold counts for those."""
    by_size = {}
    for size in {a[1] for a in asked}:
        mine = [a for a in asked if a[1] == size]
        kinds, which = np.unique([g for a in mine for g in a[2]], return_inverse=True)
        holder = np.repeat(np.arange(len(mine)), [len(a[2]) for a in mine])[np.argsort(which, kind="stable")]  # the queries of each trigram
        spelt = np.array([[ord(x) for x in g] for g in kinds.tolist()], np.int64)
        by_size[size] = (np.array([a[0] for a in mine], np.int64), np.array([len(a[2]) for a in mine], np.int64), spelt, np.bincount(which), holder)

    def compare(docs: pa.Array, size: int, norm: list[str]) -> Iterator[pa.RecordBatch]:
        made, n = _distinct_grams(norm), len(norm)
        if made is None and n > 1:
            yield from compare(docs.slice(0, n // 2), size, norm[: n // 2])
            yield from compare(docs.slice(n // 2), size, norm[n // 2 :])
            return
        (grams, characters, bits), (numbers, lengths, spelt, held, holder) = made, by_size[size]
        owner, gram = grams >> 3 * bits, grams & ((1 << 3 * bits) - 1)
        total = np.bincount(owner, minlength=n)
        place = np.minimum(np.searchsorted(characters, spelt), len(characters) - 1)
        seen = np.flatnonzero((characters[place] == spelt).all(axis=1))
        if not len(seen):
            return
        wanted = (place[seen, 0] << 2 * bits) + (place[seen, 1] << bits) + place[seen, 2]
        if bits <= 7:
            table = np.full(1 << 3 * bits, -1, np.int32)
            table[wanted] = seen
            at = table[gram]
        else:
            order = np.argsort(wanted)
            near = np.minimum(np.searchsorted(wanted[order], gram), len(order) - 1)
            at = np.where(wanted[order][near] == gram, seen[order][near], -1)
        hits = np.flatnonzero(at >= 0)
        owner, at = owner[hits], at[hits]
        count, first = held[at], np.cumsum(held) - held
        query = holder[np.repeat(first[at] - np.cumsum(count) + count, count) + np.arange(count.sum())]
        shared = np.bincount(np.repeat(owner, count) * len(numbers) + query, minlength=n * len(numbers)).reshape(n, -1)
        union = lengths[None, :] + total[:, None] - shared
        passage, of = np.nonzero((shared > 0) & (shared >= (floor - 1e-6) * union))
        yield pa.RecordBatch.from_arrays([pa.array(numbers[of]), docs.take(pa.array(passage)), pa.array(shared[passage, of] / union[passage, of])], ["_query", "_doc", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["_n"].to_numpy()
            for which, size in enumerate(sorted(by_size)):
                half, most = size // 2, max(1, at_once // size)
                ends = np.cumsum(np.maximum(-(-length // half) - 2, 0) + 1)
                first = 0
                while first < len(length):  # whole documents, a long one in several parts
                    last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, side="right")))
                    norm, rows = [], []
                    for row, pieces, whole in zip(range(first, last), *(batch[c].slice(first, last - first).to_pylist() for c in ("pieces", "whole"))):
                        n, k = int(ends[row] - (ends[row - 1] if row else 0)), half // step
                        for i in range(0, n, most):
                            norm += whole[which][i : i + most] if whole else ["".join(pieces[j * k : j * k + 2 * k]) for j in range(i, min(n, i + most))]
                            rows += [row] * (len(norm) - len(rows))
                            if n > most:
                                yield from compare(batch["_doc"].take(pa.array(rows)), size, norm)
                                norm, rows = [], []
                    if norm:
                        yield from compare(batch["_doc"].take(pa.array(rows)), size, norm)
                    first = last

    return run


def passage_leg(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, text: str, floor: float = 0.3, least: int = 200, pairs_at_once: int = 200_000, rows_a_task: int = 1000) -> DataFrame:
    """(query, doc, score): documents with a passage whose trigram set is similar to the query's by ``floor`` or more; the best counts.

    Documents are cut to passages of the query's length, ``least`` characters doubled as often as need be, that overlap by half
    and cover the document; only the lengths that queries have are cut. A text is normalised once, in pieces of half of ``least`` that
    passages of any length are made of; where a letter's small form or a tag could reach over a piece's end, passage by passage. Queries
    are asked in blocks of about ``pairs_at_once`` pairs of query and trigram: a block's trigrams go to the tasks, which compare passages
    as they read them, so only passages that are close enough leave them. Documents are dealt to tasks of about ``rows_a_task``, as they
    may come in few files."""
    if least < 2 or least % 2:
        raise ValueError("passages are of an even number of characters")
    n = F.length(text)
    size = (F.lit(least) * F.pow(F.lit(2), F.ceil(F.log2(F.greatest(n, F.lit(least)) / F.lit(least))))).cast("int")
    left = written(queries.select(query_id, size.alias("_size"), trigrams(text).alias("g")).filter(F.size("g") > 0).withColumn("_query", F.monotonically_increasing_id()), "passage-queries")
    blocks = -(-(left.agg(F.sum(F.size("g"))).first()[0] or 0) // pairs_at_once)
    kinds = dict(docs.dtypes)
    docs, schema = dealt(docs.select(doc_id, text), doc_id, rows_a_task), f"_query long, _doc {kinds[doc_id]}, score double"
    out = None
    for b in range(blocks):
        asked = [(r["_query"], r["_size"], r["g"]) for r in left.filter(F.pmod(F.xxhash64("_query"), F.lit(blocks)) == b).collect()]
        if not asked:
            continue
        bare = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")
        pieces = F.transform(F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{least // 2}}}"), F.lit(0)), bare)
        cut = lambda s: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / (s // 2)).cast("int") - 2)), lambda i: norm_title(F.col(text).substr(i * (s // 2) + 1, F.lit(s))))
        sizes, reaching = sorted({a[1] for a in asked}), F.col(text).rlike("[<\u03a3]")
        given = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).alias("_doc"), n.alias("_n"), F.when(~reaching, pieces).alias("pieces"), F.when(reaching, F.array(*map(cut, sizes))).alias("whole"))
        found = given.mapInArrow(_close_passages(asked, floor, least // 2), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return queries.select(query_id, F.lit(None).cast(kinds[doc_id]).alias(doc_id), F.lit(0.0).alias("score")).limit(0)
    best = out.groupBy("_query", "_doc").agg(F.round(F.max("score"), 6).alias("score")).filter(F.col("score") >= floor)
    best = best.join(left.select("_query", query_id), "_query").withColumnRenamed("_doc", doc_id)
    return best.groupBy(query_id, doc_id).agg(F.max("score").alias("score"))


def ranked(leg: DataFrame, query_id: str, doc_id: str, limit: int) -> DataFrame:
    """The first ``limit`` documents of each query with their rank."""
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), doc_id)
    return leg.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def fuse(legs: list[DataFrame], query_id: str, doc_id: str, k: int = 60) -> DataFrame:
    """Reciprocal-rank fusion: the sum over legs of 1 / (k + rank)."""
    rows = legs[0].select(query_id, doc_id, "rank")
    for leg in legs[1:]:
        rows = rows.unionByName(leg.select(query_id, doc_id, "rank"))
    return rows.groupBy(query_id, doc_id).agg(F.round(F.sum(1 / (k + F.col("rank"))), 8).alias("score"), F.count(F.lit(1)).alias("n_legs"))


def containing(passages: DataFrame, docs: DataFrame, passage_id: str, doc_id: str, text: str, words: int = 5, most_broadcast: int = 200_000) -> DataFrame:
    """(passage, doc, start, stop) of each passage that a document holds, at its first place, in characters from 0.

    A passage of ``words`` + 2 words or more is looked up by the ``words`` words from its second on, which any document that holds
    it has side by side; a shorter one of three words or more by its second word. Only what is left (two words at the most, whose own
    words may be parts of others) is tested against every document, as one broadcast table whose size is checked.

    Keys of up to ``most_broadcast`` passages are broadcast, so other word runs never leave the scan; more are joined."""
    split = lambda c: F.split(c, r"[ \t\n\r]+")
    p = passages.select(passage_id, F.col(text).alias("_p")).withColumn("_w", split(F.col("_p")))
    keyed = p.filter(F.size("_w") >= words + 2).withColumn("_key", F.xxhash64(F.slice("_w", 2, words)))
    grams = docs.select(doc_id, split(F.col(text)).alias("_w")).filter(F.size("_w") >= words)
    grams = grams.select(doc_id, F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("_w") - words + 1), lambda i: F.xxhash64(F.slice("_w", i, F.lit(words)))))).alias("_key"))
    some = p.filter((F.size("_w") < words + 2) & (F.size("_w") >= 3)).withColumn("_key", F.xxhash64(F.col("_w")[1]))
    single = docs.select(doc_id, F.explode(F.array_distinct(F.transform(split(F.col(text)), lambda w: F.xxhash64(w)))).alias("_key"))

    def met(asked: DataFrame, held: DataFrame) -> DataFrame:
        keys = asked.select("_key").distinct()
        small = keys.limit(most_broadcast + 1).count() <= most_broadcast
        held = held.join(F.broadcast(keys) if small else keys, "_key", "left_semi")
        return asked.select(passage_id, "_p", "_key").join(held, "_key").select(passage_id, "_p", doc_id).distinct()

    body = docs.select(doc_id, F.col(text).alias("_d"))
    pairs = met(keyed, grams)
    if some.limit(1).count():
        pairs = pairs.unionByName(met(some, single))
    long_hits = pairs.join(body, doc_id)
    tiny = p.filter(F.size("_w") < 3).select(passage_id, "_p")
    few = tiny.limit(most_broadcast + 1).count()
    if few > most_broadcast:
        raise ValueError(f"more than {most_broadcast} passages of one or two words")
    short_hits = (F.broadcast(tiny) if few else tiny.limit(0)).join(body, F.col("_d").contains(F.col("_p")))
    hits = long_hits.select(passage_id, doc_id, "_p", "_d").unionByName(short_hits.select(passage_id, doc_id, "_p", "_d")).withColumn("_at", F.expr("instr(_d, _p)")).filter("_at > 0")
    return hits.select(passage_id, doc_id, (F.col("_at") - 1).cast("long").alias("start"), (F.col("_at") - 1 + F.length("_p")).cast("long").alias("stop"))


def verify_quotes(body: str, quote: str, start: Column | str, stop: Column | str) -> Column:
    """The text from start to stop is the quote, both with canonical line ends, and the quote has no line end at its own ends."""
    col = lambda x: F.col(x) if isinstance(x, str) else x
    part = F.substring(F.col(body), col(start).cast("int") + 1, (col(stop) - col(start)).cast("int"))
    q = canonical_newlines(quote)
    return (canonical_newlines(part) == q) & ~q.startswith("\n") & ~q.endswith("\n")


def cosine_leg(vectors: DataFrame, every: int, k: int, vec_id: str, vector: str, queries_at_once: int = 4096, chunk: int = 4096) -> DataFrame:
    """(query_id, vec_id, score): candidates of the ``k`` highest cosines, to 6 places, of each query: rows whose id is divisible by ``every``.

    Queries go out in blocks of about ``queries_at_once``, the only thing that is broadcast; the rows never move, and each chunk of
    them sends on ``k`` rows a query at the most, ties to the smaller id. Vectors that are null, empty, zero or not finite take no
    part, nor do null ids; vectors of different lengths don't meet."""
    spark = vectors.sparkSession
    e = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter("vec_id IS NOT NULL AND size(v) > 0")
    asked = e.filter(F.col("vec_id") % every == 0)
    n_blocks = max(1, -(-asked.count() // queries_at_once))

    def by_length(ids: list, vecs: list) -> dict:
        out = {}
        for i, v in zip(ids, vecs):
            x = np.array(v, float)
            if np.isfinite(x).all() and (norm := np.sqrt((x * x).sum())) > 0:
                held = out.setdefault(len(x), ([], [], []))
                held[0].append(i)
                held[1].append(x)
                held[2].append(norm)
        return {d: (np.array(i), np.stack(v), np.array(m)) for d, (i, v, m) in out.items()}

    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    for b in range(n_blocks):
        got = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).toArrow()  # about queries_at_once rows
        shared = spark.sparkContext.broadcast(by_length(got["vec_id"].to_pylist(), got["v"].to_pylist()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, chunk):
                    part = batch.slice(at, chunk)
                    mine = by_length(part["vec_id"].to_pylist(), part["v"].to_pylist())
                    for d in mine.keys() & shared.value.keys():
                        (q_ids, q, q_norm), (ids, v, norm) = shared.value[d], mine[d]
                        rows = ([], [], [])
                        for i, row in enumerate(q):
                            other = np.flatnonzero(ids != q_ids[i])
                            score = np.round((v[other] @ row) / (norm[other] * q_norm[i]), 6)
                            top = np.lexsort((ids[other], -score))[:k]
                            rows[0].extend([q_ids[i]] * len(top))
                            rows[1].extend(ids[other][top])
                            rows[2].extend(score[top])
                        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.float64())], ["query_id", "vec_id", "score"])

        found = found.unionByName(e.mapInArrow(run, "query_id long, vec_id long, score double"))
    return found
