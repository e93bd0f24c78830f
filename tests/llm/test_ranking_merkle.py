"""Ranked search and the Merkle manifest against brute force, with the edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.llm import merkle, queries, ranking

DOCS = "doc_id long, text string, term string, key string, rank int, n int"  # with columns that operators use as names
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_ranking(docs, items, k):
    cut = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    cut = [(d, c) for d, c in cut if c]
    n_docs, n_terms = len(cut), sum(sum(c.values()) for _, c in cut)
    df = Counter(t for _, c in cut for t in c)
    out = []
    for i, text in items:
        scored = []
        for d, c in cut:
            n, m = sum(c.values()), 0
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(ranking.term_weight(n_docs, df[t]) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(TERM.findall((text or "").translate(LOWER))) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def listed(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("pairs,cells", [(50_000, 1 << 22), (9, 1)])
def test_ranking_by_brute_force(spark, monkeypatch, pairs, cells):
    monkeypatch.setattr(ranking, "CELLS", cells)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)] + ["Été", "été", "ab_c", "x-y", "漢字", "W1", "ß"]
    p = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(rng.choice(words, n, p=p / p.sum()))
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "-- !!"), (None, text(20)), (None, text(20)), (7, text(9)), (203, docs[3][1]), (203, docs[3][1]), (204, "w1 " * 20_000), (205, "\x00\x7f\x85 w3 w4")]
    items = [(i, text(int(rng.integers(1, 25)))) for i in range(12)] + [(20, None), (21, ""), (22, "nowhere"), (None, "w2 w9"), (3, "w5"), (23, "w1 w1 W1"), (24, text(400))]
    items += [(24, items[-1][1])]
    rows = spark.createDataFrame([(d, t, "t", "k", 1, 2) for d, t in docs], DOCS).repartition(5)
    asked = spark.createDataFrame([(i, t, "s", 7) for i, t in items], "item_id long, text string, score string, item_row int")
    assert listed(ranking.rank_documents(rows, asked, k=7, pairs_at_once=pairs)) == brute_ranking(docs, items, 7)
    assert ranking.rank_documents(rows.limit(0), asked).count() == 0 == ranking.rank_documents(rows, asked.limit(0)).count()
    named = ranking.rank_documents(rows.withColumnRenamed("doc_id", "a"), asked.withColumnRenamed("item_id", "b"), id_col="a", item_col="b")
    assert named.columns == ["b", "rank", "a", "score"]


def test_thresholds_prune_and_lose_nothing(spark):
    """A term of very many documents can't make a candidate once rarer ones fill the list; ties at the threshold stay."""
    docs = [(i, "common " + ("rare " if i % 40 == 0 else "") + "filler " * (i % 3)) for i in range(400)]
    got = listed(ranking.rank_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "rare common")], "item_id long, text string"), k=5))
    assert got == brute_ranking(docs, [(1, "rare common")], 5) and {r[2] % 40 for r in got} == {0}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows, fanout=8):
    """rows: (doc_id, source, lang, n_chars, text)"""

    def leaf(row):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
        return levels

    def path(levels, i):
        for level in levels[:-1]:
            s = i // fanout * fanout
            yield level[s:i], level[i + 1 : s + fanout]
            i //= fanout

    groups = defaultdict(list)
    for row in rows:
        lowered = (*row[:4], row[4] and row[4].translate(LOWER))
        changed = leaf(lowered) if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 else None
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), changed or "", row[0]))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {name: climb([x[2] for x in sorted(groups[name])]) for name in names}
    top = climb([trees[n][-1][0] for n in names])
    out = []
    for g, name in enumerate(names):
        for i, (_, _, own, changed, doc_id) in enumerate(sorted(groups[name])):
            steps, node = [*path(trees[name], i), *path(top, g)], changed or own
            for before, after in steps:
                node = digest(*before, node, *after)
            out.append((doc_id, own, trees[name][-1][0], top[-1][0], digest(*(x for b, a in steps for x in [*b, *a])), node, node == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels,fanout", [(4, 8), (1, 8), (2, 3)])
def test_manifest_by_brute_force(spark, levels, fanout):
    rows = [(i, f"s{i % 3}", ["en", "de", None, "", "é", "z"][min(5, i % 23 // 4)], i * 3, f"Text {i} Ä" * (i % 4)) for i in range(170)]
    rows += [(500, None, "solo", None, None), (None, "s", "en", 1, "A"), (None, "s", "en", 1, "B"), (3, "s", "en", 9, "Twice"), (3, "s", "en", 9, "Twice"), (4, "", "", 0, ""), (501, "x", "en", 1, "Z" * 100_000)]
    fields = ["doc_id", "source", "lang", "n_chars"]
    df = spark.createDataFrame([(*r, "k", "b", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, key string, block string, rank int").repartition(7)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.row_digest(*fields, merkle.ascii_lowered("text")))
    out = merkle.dataset_manifest(df, [*fields, "text"], tampered=tampered, levels=levels, fanout=fanout, keep_proof=True)
    got = out.collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == brute_manifest(rows, fanout)
    for r in got:
        assert digest(*(s["before"] + s["after"] for s in r["proof"])) == r["proof_sha256"]
    assert merkle.dataset_manifest(df.limit(0), fields).count() == 0
    one = merkle.dataset_manifest(df.filter("doc_id = 500"), fields).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["verified"] and one["proof_sha256"] == digest()


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_merkle_manifest"])
def test_contract_columns(spark, sf_dir, name):
    want = {"op12_ranked_search": "item_id bigint, rank int, doc_id bigint, score bigint", "op13_merkle_manifest": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"}
    assert ", ".join(f"{c} {t}" for c, t in queries.QUERIES[name](spark, sf_dir).dtypes) == want[name]
