"""The n-gram Jaccard join: its guarantee, its stream of signatures, and whole results against brute force."""

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from oreline.llm import linking, partenum, queries
from oreline.llm.neardup import Words, shingle_sets

DOCS = "doc_id long, text string, key string, n int, node long, lo string"  # with columns that operators use as names


def test_schemes_serve_every_pair_that_can_link():
    for percent in (85, 80, 60):
        found = partenum.schemes(percent, 3000)
        for a in [*range(1, 130), 400, 1000, 2999]:
            for b in (a, a + 1, 100 * a // percent):
                apart = (100 - percent) * (a + b) // (100 + percent)
                if b > 3000 or apart < b - a or apart == 0:
                    continue
                both = [s for s in found if s.least <= a and b <= s.most]
                assert both
                for s in both:
                    needed = apart // (2 if s.cells == 3 else 1) + 1
                    assert s.parts >= needed + s.spare


@pytest.mark.parametrize("size", [7, 9, 13, 20, 33, 60, 100, 400, 1500])
def test_linked_sets_share_a_signature(size):
    """Also where the differences are chosen to fall in as many parts as they can, and where parts are empty."""
    rng = np.random.default_rng(size)
    found = partenum.schemes(85, 4000)
    for trial in range(20):
        narrow = np.uint64(1 << 63) if trial % 4 == 3 else np.uint64(0)  # all features in one half of the domain
        pool = np.unique(rng.integers(0, 1 << 63, 3 * size, dtype=np.uint64) * np.uint64(1 if narrow else 2) | narrow)
        a = np.sort(rng.choice(pool, size, replace=False))
        gone = 15 * 2 * size // 185 // 2
        places = np.linspace(0, size - 1, gone).astype(int) if trial % 2 else rng.choice(size, gone, replace=False)
        rest = np.setdiff1d(pool, a)
        b = np.sort(np.concatenate([np.delete(a, places), rest[np.linspace(0, len(rest) - 1, gone).astype(int)]]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            x, y = partenum.signatures([a, b], found)
            assert len(np.intersect1d(x, y)) or not gone


def test_shared_signatures_of_a_stream():
    rng = np.random.default_rng(2)
    for most in (1, 2, 5, 50):
        pairs = sorted({(int(k), int(n)) for k, n in zip(rng.integers(0, 30, 90), rng.integers(0, 40, 90))} | {(99, i) for i in range(20)})
        pairs = sorted(pairs + pairs[5:9])  # a copy's rows
        batches = [pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*pairs[i : i + most])], ["key", "node"]) for i in range(0, len(pairs), most)]
        got = [tuple(r.values()) for b in partenum._shared(iter(batches)) for r in b.to_pylist()]
        by_key = {k: sorted({n for x, n in pairs if x == k}) for k, _ in pairs}
        want = {(k, n) for k, ns in by_key.items() if len(ns) > 1 for n in ns[1:]}
        assert len(got) == len(set(got)) and {(k, n) for k, n, *_ in got} >= want
        assert all(len(by_key[k]) > 1 for k, *_ in got)
        for k, n, least, before in got:
            i = by_key[k].index(n)
            assert least == by_key[k][0] and before == by_key[k][max(0, i - 1)]
        firsts = {(k, ns[0]) for k, ns in by_key.items() if len(ns) > 1}
        assert firsts <= {(k, n) for k, n, *_ in got}


def met(spark, of_node, n_links, monkeypatch, stars=None):
    """(component of each node, pairs (x, y) in the order confirmed, rows of each table written) where ids under ``n_links`` link."""
    members = spark.createDataFrame([(n, k, k % 8) for n, keys in of_node.items() for k in keys], "node long, key long, band int")
    info, written, asked = spark.createDataFrame([(n, n) for n in of_node], "node long, n long"), {}, []

    def materialize(df, name, *args, real=linking.materialize):
        if name == "t-rest":  # what the join gives, before repeats are dropped
            cross = [p for p in made if p.columns == ["x", "y"]][-1]
            written["met"] = sorted(map(tuple, cross.collect()))
        out = real(df, name, *args)
        written[name] = out.count()
        return out

    def bucket_pairs(*args, real=getattr(linking, "bucket_pairs", None)):
        made.extend(found := real(*args))
        return found

    def confirmed(pairs):
        asked.append(sorted((r["x"], r["y"]) for r in pairs.collect()))
        return pairs.select(F.col("x").alias("a"), F.col("y").alias("b")).filter(f"a < {n_links} AND b < {n_links}")

    made = []
    monkeypatch.setattr(linking, "materialize", materialize)
    monkeypatch.setattr(linking, "bucket_pairs", bucket_pairs)
    stars = spark.createDataFrame(stars or [], "x long, y long")
    out = linking.bucket_components(members, stars, info, lambda a, b: F.lit(True), lambda a, b: F.col(f"{a}.n") - F.col(f"{b}.n"), confirmed, 4, "t", pairs_a_row=10**6)
    return {r["node"]: r["component"] for r in out.collect()}, asked, written


def test_a_pair_is_met_in_one_bucket(spark, monkeypatch):
    """Ten near copies share 60 buckets but two of them alone share the last one; two others meet after more keys than a row knows."""
    of_node = {n: [*range(60), 1000 + n] for n in range(10)} | {20: [70, *range(2000, 2100), 5000], 21: [70, 5000, 5001], 30: [*range(3000, 3100), 6000], 31: [*range(4000, 4100), 6000]}
    of_node[8] += [9000]
    of_node[9] += [9000]
    component, _, written = met(spark, of_node, 5, monkeypatch)
    assert component == {n: 0 for n in range(5)}
    near = [(a, b) for b in range(10) for a in range(b)]
    assert written["met"] == sorted([*near, (20, 21), (30, 31)])  # each once, and none is missed


def test_first_pairs_that_stay_apart_are_all_looked_at(spark, monkeypatch):
    """Node 2 is likelier to link with 1 than with 0; when it has done so, 0 joins them without buckets being compared in full."""
    component, asked, written = met(spark, {0: [1], 1: [2], 2: [1, 2]}, 3, monkeypatch, [(2, 0), (2, 1)])
    assert component == {0: 0, 1: 0, 2: 0}
    assert [len(x) for x in asked] == [1, 1] and "t-rest" not in written


def brute(docs, k, percent):
    words = Words()
    rows = [(d, {int(x) for x in s}) for (d, _), s in zip(docs, shingle_sets([t and t.encode() for _, t in docs], k, words))]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, (a, s) in enumerate(rows):
        for j, (b, t) in enumerate(rows[:i]):
            if s and t and a is not None and b is not None and 100 * len(s & t) >= percent * len(s | t):
                part[root(i)] = root(j)
    least = {}
    for i, (d, s) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), None if d is None else least[root(i)] if s else d) for i, (d, s) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("k,percent", [(4, 85), (1, 70)])
def test_components_by_brute_force(spark, k, percent):
    rng = np.random.default_rng(k)
    word = lambda n, vocabulary=4000: [f"w{int(x)}" for x in rng.integers(0, vocabulary, n)]
    texts = []
    for n in (1, 2, 3, 4, 6, 8, 10, 11, 14, 20, 30, 45, 70, 120, 300, 900):
        base = word(n)
        texts.append(base)
        for share in (0.005, 0.01, 0.02, 0.05):
            copy = list(base)
            for i in rng.choice(n, max(1, int(share * n)), replace=False):
                copy[i] = f"new{int(rng.integers(0, 9))}"
            texts += [copy, base[: max(1, int(n * (1 - share)))], base + word(max(1, int(n * share * 3)))]
    for start in range(0, 60, 2):  # a chain
        texts.append([f"c{j}" for j in range(start, start + 60)])
    passage = word(40)
    texts += [passage + word(int(n)) for n in rng.integers(1, 30, 20)] + [word(5, 6) for _ in range(40)]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs += [(900, None), (901, ""), (902, " \t\n"), (None, docs[30][1]), (None, None), (3, "one more text of this id here"), (903, "One MORE text of this id here"), (3, docs[40][1]), (904, docs[60][1]), (904, docs[60][1]), (905, "é É é É ß a b c"), (906, "x " * 50_000)]
    df = spark.createDataFrame([(d, t, "k", 1, 2, "lo") for d, t in docs], DOCS).repartition(5)
    got = sorted((tuple(r) for r in partenum.jaccard_components(df, shingle_words=k, percent=percent).collect()), key=repr)
    assert got == brute(docs, k, percent)
    assert partenum.jaccard_components(df.limit(0)).count() == 0


def test_contract(spark, sf_dir):
    out = queries.op11_partenum(spark, sf_dir)
    assert out.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(docs, 4, 85)
