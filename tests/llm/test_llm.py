"""The training-data operators against brute force, exact round trips, held-out accuracy and their edge cases."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oreline.llm import langid, neardup, ordermin, packing, queries, sentencepiece_backend, sharding, spans, suffixes, topk
from oreline.llm.preference import format_preferences

DOCS = "doc_id long, text string, part string, size int, n long, component string"  # with columns that operators use as names
EDGES = [(1, "a", "x", 1, 2, "c"), (1, "a", "x", 1, 2, "c"), (None, "zz top", None, None, None, None), (2, None, "y", 0, 0, ""), (5, "", "", 1, 1, ""), (7, "A", "", 1, 1, ""), (9, "123 !!", "", 1, 1, "")]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return sorted((r["doc_id"], r["text"]) for r in docs.collect())


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_forward_backward_is_exact_over_segments():
    rng = np.random.default_rng(1)
    sizes = np.array([300, 1, 0, 5, 129, 128])
    scores, trans = rng.normal(size=(sizes.sum(), 3)), rng.normal(size=(3, 3))
    got, at = langid.forward_backward(scores.copy(), sizes, trans), 0
    for n in sizes:
        e = scores[at : at + n]
        a, b = np.zeros((n, 3)), np.zeros((n, 3))
        cur = np.full(3, -np.log(3))
        for t in range(n):
            cur = np.logaddexp.reduce(cur[:, None] + trans, axis=0) + e[t]
            a[t] = cur
        cur = np.zeros(3)
        for t in range(n - 1, -1, -1):
            b[t] = cur
            cur = np.logaddexp.reduce(trans + (e[t] + cur)[None, :], axis=1)
        if n:
            p = np.exp(a + b - (a + b).max(axis=1, keepdims=True))
            assert np.allclose(p / p.sum(axis=1, keepdims=True), got[at : at + n])
        at += n


def test_language_id(spark, docs, edges):
    model = langid.fit(docs)
    got = langid.identify_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out")
    assert held.filter("lang_pred = lang").count() >= 0.9 * held.count() > 0
    tagger = langid.Tagger(model)
    mixed = tagger.label_words("and the thing with that und die nicht der keit")
    assert {"en", "de"} <= {label for _, label, _ in mixed}
    found = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify_languages(edges, model).collect()]
    assert len(found) == len(EDGES) and {(2, "und", 0.0), (5, "und", 0.0), (9, "und", 0.0)} <= set(found)
    assert langid.identify_languages(edges.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in langid.identify_languages(edges, None).collect()} == {"und"}
    assert langid.fit(docs.limit(0)) is None
    assert langid.WORD.findall("हिन्दी, q7 ไม่ใช่!") == ["हिन्दी", "q", "ไม่ใช่"]
    with pytest.raises(ValueError, match="labels"):
        langid.fit(docs, most_docs=1)


def check_packing(out, texts, capacity):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in texts:
        ids = np.asarray([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(pieces[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert zlib.crc32(ids[at : at + p["length"]].tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == len(ids)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(r["length"] for r in out), len(seqs)


def test_packing(spark, docs, rows, edges):
    tokens, n = check_packing(packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), rows_a_bucket=20).collect(), rows, 2048)
    assert tokens / (n * 2048) > 0.95
    unique = edges.dropDuplicates(["doc_id"])
    check_packing(packing.pack_documents(unique, public_tokenizers.path("byte_bpe_50k.json")).collect(), [(r["doc_id"], r["text"]) for r in unique.collect()], 2048)
    twice = spark.createDataFrame([(1, "some words here"), (1, "other words"), (1, "some words here"), (None, "null id")], "doc_id long, text string")
    out = packing.pack_documents(twice, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted((r["doc_id"] or 0, r["start"], r["length"]) for r in out) == [(0, 0, 3), (1, 0, 3), (1, 0, 4), (1, 0, 4)]
    assert packing.pack_documents(edges, public_tokenizers.path("byte_bpe_50k.json")).count() == len(EDGES)
    assert packing.pack_documents(edges.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_cutting_stock_covers_the_histogram():
    rng = np.random.default_rng(0)
    histogram = {int(c): int(n) for c, n in zip(rng.choice(np.arange(1, 129), 60, replace=False), rng.integers(1, 400, 60))}
    plan = packing.plan_patterns(histogram, 128, 1)
    used = defaultdict(int)
    for content, n in plan:
        assert sum(c * k for c, k in content.items()) <= 128
        for c, k in content.items():
            used[c] += n * k
    assert used == histogram
    sizes = np.array(sorted(histogram))
    patterns, amounts = packing.solve_cutting_stock(sizes, np.array([histogram[c] for c in sizes], float), 128)
    assert np.allclose(patterns.T @ amounts, [histogram[c] for c in sizes]) and sum(n for _, n in plan) <= amounts.sum() + len(sizes)
    perfect = {100: 50, 28: 50, 64: 100, 40: 30, 88: 30}
    assert sum(n for _, n in packing.plan_patterns(perfect, 128, 1)) == 130
    value, counts = packing.knapsack(np.array([3, 4, 5]), np.array([3.0, 4.5, 5.1]), 11)
    assert value == pytest.approx(12.0) and counts.tolist() == [1, 2, 0]


def test_cutting_stock_of_many_classes_inside_a_session(spark):
    """A basis of 512 rows: the driver, which also runs a JVM, must not stall."""
    rng = np.random.default_rng(4)
    demand = rng.integers(1, 40, 512).astype(float)
    patterns, amounts = packing.solve_cutting_stock(np.arange(1, 513), demand, 512)
    assert (patterns @ np.arange(1, 513) <= 512).all() and np.allclose(amounts @ patterns, demand, atol=1e-5)
    assert amounts.sum() <= 1.01 * max(demand @ np.arange(1, 513) / 512, demand[256:].sum())
    a = rng.normal(size=(60, 60))
    assert np.allclose(packing.inverted(a) @ a, np.eye(60))


def test_chunk_encoder_parity():
    import random

    from oreline.llm.bpe import ChunkEncoder

    random.seed(2)
    enc = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), most=10_000)
    parts = [" ", "  ", "\n", "\t", "a", "b!", "é", "1", "\x1c", "\x85", "\xa0", " ", "'s", "<|endoftext|>", "²", "日", "\r", "😀", " x", "\x00"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(3000)]
    assert [x for i in range(0, 3000, 100) for x in enc.encode(texts[i : i + 100])] == enc._raw(texts)


def test_chunk_encoder_joins_white_space():
    """White space that a single space separates is one word of the tokenizer's pattern; columns are cut like lists, nulls are empty."""
    from oreline.llm.bpe import ChunkEncoder

    enc = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    white = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [f"a{s}{x} {y}{e}" for s in ("", " ", "  ") for x in white for y in white for e in ("", " ", "b", " b", "\n")]
    texts += ["", " ", " a", "a ", " a ", "a b a b", "b a", "a" * 300 + " " + "a" * 300, "a\n", "a \n", "é é", "a\nb c\td"]
    assert enc.encode(texts) == enc._raw(texts)
    column = pa.array([None, *texts[-9:], None, "b c"])
    assert enc.encode(column) == enc._raw([t or "" for t in column.to_pylist()]) == enc.encode(column.cast(pa.large_string()))
    assert enc.encode(column[3:7]) == enc._raw(column[3:7].to_pylist()) and enc.encode(column[:0]) == []


def brute_spans(rows, k, words):
    seen, out = {}, {}
    for d, t in rows:
        ends, h, w = spans.units(t)
        gone = [False] * len(h)
        for i in range(len(h)):
            j = i
            while j < len(h) and (j - i < k or sum(w[i:j]) < words):
                j += 1
            if j - i >= k and sum(w[i:j]) >= words:
                if seen.setdefault(tuple(h[i:j]), (d, i)) != (d, i):
                    gone[i:j] = [True] * (j - i)
        out[d] = "".join(t[a:b] for a, b, g in zip([0, *ends[:-1]], ends, gone) if not g) if any(gone) else t
    return out


def test_spans(docs, rows, edges):
    got = by_id(spans.dedup_spans(docs))
    assert {d: r["text"] for d, r in got.items()} == brute_spans(rows, 3, 12)
    out = spans.dedup_spans(edges).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out) == sorted((e[0] or 0, e[1] or "") for e in EDGES)
    assert spans.dedup_spans(edges.limit(0)).count() == 0


def test_spans_keep_the_first_occurrence(spark):
    passage = "One small step was made there. Another step came after that one! Did the third step follow it? It did so indeed."
    df = spark.createDataFrame([(3, f"Intro here. {passage}"), (1, f"{passage} Tail."), (2, passage), (4, "One small step was made there. Clean.")], "doc_id long, text string")
    got = {d: r["text"] for d, r in by_id(spans.dedup_spans(df)).items()}
    assert got == {1: f"{passage} Tail.", 2: "", 3: "Intro here. ", 4: "One small step was made there. Clean."}


def windows(words, n):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


@pytest.mark.parametrize("kind", ["long sentences", "no full stops", "no spaces"])
def test_spans_find_passages_inside_sentences(spark, kind):
    """Against word windows, without units(): no repeated passage of 51 words stays, and all that goes is repeated."""
    rng = np.random.default_rng(5)
    glue, vocabulary = ("", [chr(0x4E00 + i) for i in range(3000)]) if kind == "no spaces" else (" ", [f"w{i}x" for i in range(3000)])
    some = lambda n: rng.choice(vocabulary, n).tolist()
    passages, docs = [some(n) for n in rng.integers(51, 82, 80)], {}
    heads, tails = [], []
    for i, p in enumerate(passages):
        if kind == "long sentences" and i % 2:
            p[len(p) // 2] += "."
        docs[2 * i] = [*some(rng.integers(0, 40)), *p, *some(rng.integers(0, 40))]
        heads.append(some(rng.integers(0, 40)))
        tails.append(some(rng.integers(0, 40)))
        docs[2 * i + 1] = [*heads[i], *p, *tails[i]]
    got = by_id(spans.dedup_spans(spark.createDataFrame([(d, glue.join(w)) for d, w in docs.items()], "doc_id long, text string")))
    for i, p in enumerate(passages):
        first, later = docs[2 * i], docs[2 * i + 1]
        assert got[2 * i]["text"] == glue.join(first)
        r = got[2 * i + 1]
        kept = list(r["text"]) if not glue else r["text"].split()
        assert 0 <= len(kept) - len(heads[i]) - len(tails[i]) <= 32
        assert kept[: len(heads[i])] == heads[i] and kept[len(kept) - len(tails[i]) :] == tails[i]
        assert not windows(first, 33) & windows(kept, 33)
        for a, b in r["spans"]:
            gone = glue.join(later)[a:b]
            assert windows(list(gone) if not glue else gone.split(), 12) <= windows(first, 12)


def test_preferences(spark):
    turn = "pair_id long, turn long, role string, text string, c string"
    common = [(1, 0, "system", "s", ""), (1, 1, "user", "hi", "")]
    chosen = spark.createDataFrame([*common, (1, 2, "assistant", "yes", ""), (2, 0, None, None, ""), (None, 0, "user", "x", "")], turn)
    rejected = spark.createDataFrame([*common, (1, 2, "assistant", "no", ""), (1, 3, "user", "why", ""), (3, 0, "user", "q", "")], turn)
    got = {r["pair_id"]: r for r in format_preferences(chosen, rejected).collect()}
    r = got[1]
    assert r["n_common"] == 2 and r["prompt"] == "<|system|>\ns<|end|>\n<|user|>\nhi<|end|>\n"
    (start, end), = r["chosen_spans"]
    assert r["chosen"][start:end] == "yes<|end|>\n" and len(r["rejected_spans"]) == 1
    assert got[2]["n_common"] == 0 and got[2]["rejected"] == "" and got[3]["chosen"] == "" and set(got) == {1, 2, 3}
    assert format_preferences(chosen.limit(0), rejected.limit(0)).count() == 0


def brute_components(rows, k, percent=80):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, rows, k):
    got = by_id(neardup.near_duplicates(docs, shingle_words=k))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == brute_components(rows, k)


def test_set_parities_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 3000, np.uint64)
    sets = [np.unique(np.concatenate([base[i : i + n], rng.integers(0, 1 << 63, extra, np.uint64)])) for n in (1, 40, 150, 2000) for i in (0, 5, 30) for extra in (0, 3, 30)]
    maps = neardup.set_parities(sets, 1024)
    for a, x in zip(sets, maps, strict=True):
        for b, y in zip(sets, maps, strict=True):
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_near_duplicates_in_a_chain(spark, edges):
    base = [f"w{i}" for i in range(100)]
    chain = [" ".join([*(f"x{j}_{i}" for j in range(3 * i)), *base[3 * i :]]) for i in range(12)]  # neighbours are near, the ends are far
    df = spark.createDataFrame([(i, t) for i, t in enumerate(chain)], "doc_id long, text string")
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in by_id(neardup.near_duplicates(df, shingle_words=1)).items()} == brute_components(list(enumerate(chain)), 1)
    out = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in neardup.near_duplicates(edges).collect())
    assert out == [(0, None, True), (1, 1, True), (1, 1, True), (2, 2, True), (5, 5, True), (7, 1, False), (9, 9, True)]
    assert neardup.near_duplicates(edges.limit(0)).count() == 0


def test_near_duplicates_of_one_id_and_two_texts(spark):
    a, b = "a b c d e f g h i j", "q r s t u v w x y z"
    rows = [(5, a), (5, b), (3, b + " tail"), (9, a + " tail"), (9, a + " tail")]
    out = sorted(tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect())
    assert out == [(3, 10, 3, True), (5, 9, 3, False), (5, 9, 5, True), (9, 10, 5, False), (9, 10, 5, False)]
    out = neardup.near_duplicates(spark.createDataFrame([(5, a), (5, b), (3, b)], "doc_id long, text string"), shingle_words=2).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in out) == [(3, 3, True), (5, 3, False), (5, 5, True)]


def test_topk_refuses_what_64_bits_cannot_hold(spark):
    for rows in ([(50, [1e19, 1.0]), (51, [1.0, 1.0])], [(50, [1e8, 1e8]), (51, [1e8, 1e8])]):
        with pytest.raises(Exception, match="64 bits"):
            topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()


def test_topk(spark):
    rng = np.random.default_rng(3)
    vecs = [(int(i), rng.normal(size=8).round(2).tolist()) for i in range(300)]
    vecs += [(500, None), (550, [1.0, None] * 4), (600, [float("nan")] * 8), (650, []), (700, vecs[0][1]), (701, vecs[0][1]), (None, vecs[1][1])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    ok = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in vecs if i is not None and i not in (500, 550, 600, 650)]
    want = set()
    for q, v in ok:
        if q % 50 == 0:
            best = sorted(((-int(v @ w), i) for i, w in ok if i != q))[:5]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    for chunk, at_once in ((64, 4096), (4096, 3)):
        assert {tuple(r) for r in topk.search(df, chunk=chunk, queries_at_once=at_once, block=3).collect()} == want
    assert topk.search(df.limit(0)).count() == 0


def brute_fingerprint(text, k=8, width=2, sketches=32):
    """By whole numbers of Python, a loop a sketch: the least (k-mer, occurrence) pairs, put in text order, hashed."""
    m = (1 << 64) - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * int(ordermin._B)) & m
        return x ^ (x >> 31)

    if not text:
        return [0] * sketches
    k = min(k, len(text))
    strings = [text[i : i + k] for i in range(len(text) - k + 1)]
    mers = [int(x) for x in ordermin._mers(np.array([ord(c) for c in text], np.uint64), k)]
    assert len(set(zip(strings, mers))) == len(set(strings)) == len(set(mers))
    seen, numbered = defaultdict(int), []
    for x in mers:
        numbered.append(mix((x + seen[x] * int(ordermin._A)) & m))
        seen[x] += 1
    out = []
    for i in range(1, sketches + 1):
        a = mix(i * int(ordermin._A) & m) | 1
        least = sorted(range(len(mers)), key=lambda j: (numbered[j] * a & m, j))[:width]
        h = a
        for j in sorted(least):
            h = mix((h ^ mers[j]) * int(ordermin._A) & m)
        out.append(h >> 32 | 1)
    return out


def test_order_minhash_fingerprints_by_brute_force(rows):
    rng = np.random.default_rng(4)
    texts = ["", "a", "abcdefg", "aaaaaaaaaaaaaaaaaaaa", "abcabcabcabcabcabcabcabc", "日本語のテキストです。😀", *("".join(rng.choice(list("ab"), n)) for n in (8, 9, 40, 300)), *(t[:3000] for _, t in rows[:20])]
    for t in texts:
        assert ordermin.fingerprint(t).tolist() == brute_fingerprint(t)


def test_order_minhash_looks_ranges_up(spark):
    cuts = sorted({int(x) for x in np.random.default_rng(8).integers(-500, 500, 90)})
    for some in ([], cuts[:1], cuts[:4], cuts):
        own, starts = ordermin._range_of(F.col("id") - 600, some)
        for r in spark.range(1200).select((F.col("id") - 600).alias("x"), own.alias("own"), starts.alias("starts")).collect():
            assert r["own"] == sum(c <= r["x"] for c in some) and bool(r["starts"]) == (r["x"] in some)


def test_order_minhash(spark, docs, rows, edges):
    got = by_id(ordermin.neighbour_fingerprints(docs, bytes_a_range=50_000))
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        n = len(t) // 4
        e = t[: len(t) - n] + nxt[:n]
        r, f, ef = got[d], ordermin.fingerprint(t), ordermin.fingerprint(e)
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(np.mean(f == ef)) and r["near_next"] == pytest.approx(np.mean(f == ordermin.fingerprint(nxt)))
    a = "the quick brown fox jumps over the lazy dog " * 3 + "and then it sleeps under a tall tree by the river"
    swapped = a[len(a) // 2 :] + a[: len(a) // 2]
    assert ordermin.likeness(ordermin.fingerprint(a), ordermin.fingerprint(a + "x")) > ordermin.likeness(ordermin.fingerprint(a), ordermin.fingerprint(swapped))
    out = ordermin.neighbour_fingerprints(edges, bytes_a_range=3).collect()
    want = [(1, "a", "a"), (1, "a", ""), (2, "", ""), (5, "", "A"), (7, "A", "123 !!"), (9, "123 !!", "a"), (None, "zz top", "zz top")]
    assert sorted((r["doc_id"] or 0, r["n_chars"], r["edited_sha256"], round(r["near_next"] * 32)) for r in out) == sorted(
        (d or 0, len(t), hashlib.sha256(ordermin.edited(t, n).encode()).hexdigest(), sum(a == b for a, b in zip(brute_fingerprint(t), brute_fingerprint(n)))) for d, t, n in want)
    assert ordermin.neighbour_fingerprints(edges.limit(0)).count() == 0


def brute_bytes(rows, n):
    first, out = {}, {}
    for d, t in sorted(rows):
        for i in range(len(t) - n + 1):
            first.setdefault(t[i : i + n], (d, i))
    for d, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if first[t[i : i + n]] < (d, i):
                gone[i : i + n] = b"\x01" * n
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[d] = (len(t), sum(gone), sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(t))), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_order():
    rng = np.random.default_rng(0)
    for n in (*range(1, 30), 400):
        s = rng.integers(1, 4, n)
        assert suffixes.suffix_order(s, 10**6).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())
        prefixes = [s[i : i + 5].tolist() for i in suffixes.suffix_order(s, 5)]
        assert prefixes == sorted(prefixes)


def test_suffix_dedup(spark, docs, rows, edges):
    got = {d: tuple(r)[1:] for d, r in by_id(suffixes.dedup_bytes(docs)).items()}
    assert got == brute_bytes([(d, t.encode()) for d, t in rows], 100)
    rng = np.random.default_rng(5)
    hard = [(i, "".join(rng.choice(["a", "b", "é"], rng.integers(0, 400), p=[0.85, 0.1, 0.05]))) for i in range(40)] + [(100, "ab" * 300), (101, "ab" * 200), (102, None), (103, "")]
    got = {d: tuple(r)[1:] for d, r in by_id(suffixes.dedup_bytes(spark.createDataFrame(hard, "doc_id long, text string"), block=2000)).items()}
    assert got == {d: tuple(r)[1:] for d, r in by_id(suffixes.dedup_bytes(spark.createDataFrame(hard, "doc_id long, text string"), block=500, hot_pieces=2)).items()}
    assert got == brute_bytes([(d, (t or "").encode()) for d, t in hard], 100)
    out = suffixes.dedup_bytes(edges).collect()
    assert len(out) == len(EDGES) and all(r["n_removed"] == 0 for r in out)
    assert suffixes.dedup_bytes(edges.limit(0)).count() == 0


def brute_rows(rows, length):
    """(n_removed of each row), of several rows an id: a string is later if a smaller id, or an earlier place of its row, has it."""
    first = {}
    for d, t in rows:
        for i in range(len(t) - length + 1):
            first[t[i : i + length]] = min(first.get(t[i : i + length], d), d)
    out = []
    for d, t in rows:
        seen, gone = set(), np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            if first[s] < d or s in seen:
                gone[i : i + length] = True
            seen.add(s)
        out.append((d, len(t), int(gone.sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block,hot", [(1 << 20, 20_000), (300, 2)])
def test_suffix_dedup_of_ids_with_several_texts(spark, block, hot):
    rng = np.random.default_rng(8)
    word = lambda n: "".join(rng.choice(list("abcdefghij"), n))
    a, b, s, o = (word(300) for _ in range(4))
    cases = [(3, a), (5, a), (5, b), (9, b + "tail"), (13, s), (15, word(50) + s), (15, o), (25, "Q" * 50 + s), (25, s), (27, o), (27, o), (30, b), (30, b + b), (31, "ab" * 90), (31, "ab" * 150)]
    cases += [(int(rng.integers(40, 50)), "".join(rng.choice(["ab", "b"], rng.integers(0, 200), p=[0.9, 0.1]))) for _ in range(40)]
    got = suffixes.dedup_bytes(spark.createDataFrame(cases, "doc_id long, text string").repartition(3), block=block, hot_pieces=hot).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in got) == brute_rows([(d, t.encode()) for d, t in cases], 100)


def test_sharding(spark, edges):
    df = spark.createDataFrame([(int(i), "x" * int(n)) for i, n in enumerate(np.random.default_rng(1).integers(0, 50, 500))], "doc_id long, text string")
    out = sorted(tuple(r) for r in sharding.assign_shards(df).collect())
    total, before, slots = sum(r[1] for r in out), 0, defaultdict(int)
    for _, size, _, shard, slot in out:
        assert shard == min(7, (2 * before + size) * 8 // (2 * total)) and slot == slots[shard]
        slots[shard] += 1
        before += size
    assert len(sharding.assign_shards(edges).collect()) == len(EDGES) and sharding.assign_shards(edges.limit(0)).count() == 0


def proto(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + np.float32(value).tobytes()
    return varint(number << 3 | 2) + varint(len(value)) + value


def test_sentencepiece_unigram_and_bpe(spark, docs, edges):
    import sentencepiece

    words = {"▁": -3.0, "▁the": -2.0, "the": -3.5, "▁th": -4.0, "e": -3.0, "t": -3.2, "h": -3.3, "a": -3.1, "▁a": -2.5, "n": -3.4, "d": -3.6, "▁and": -2.2, "an": -3.7}
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{i:02X}>", 0.0, 6) for i in range(256)), *((w, s, 1) for w, s in words.items())]
    data = b"".join(proto(1, proto(1, p.encode()) + proto(2, float(s)) + proto(3, k)) for p, s, k in pieces) + proto(2, proto(3, 1) + proto(35, 1)) + proto(3, proto(1, b"identity") + proto(3, 1) + proto(4, 0) + proto(5, 1))
    theirs = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["the and a", "", "athen  thé", " dan 日", "tttt the  "]
    ours = sentencepiece_backend.Backend(data)
    assert [ours.encode([t])[0] for t in texts] == theirs.encode(texts)
    path = public_tokenizers.path("piece_bpe_32k.model")
    some = [r["text"] for r in docs.limit(60).collect()]
    own, other = sentencepiece_backend.backend(path)
    assert own.encode(some) == other.encode(some) and own.decode(own.encode(some)) == some
    out = sentencepiece_backend.encode_documents(docs, path, keep_ids=True)
    assert out.filter("NOT parity OR NOT round_trip").count() == 0
    back = sentencepiece_backend.decode_documents(out, path)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {r["doc_id"]: r["text"] for r in docs.collect()}
    e = sentencepiece_backend.encode_documents(edges, path).collect()
    assert len(e) == len(EDGES) and [r["n_ids"] for r in e if r["doc_id"] == 2] == [None] and [r["n_ids"] for r in e if r["doc_id"] == 5] == [0]


def long_texts():
    """A text of 150,000 words without a full stop, its near copy, one word of 400,000 letters, and a short one."""
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in rng.integers(0, 50_000, 150_000)]
    return [(0, " ".join(words)), (20, " ".join([*words[:75_000], "changed", *words[75_001:]])), (40, "x" * 400_000), (60, "Some short text. It ends here.")]


def test_very_long_texts(spark):
    """Whole texts in every operator on documents: what stands at the end of a long one counts."""
    rows = long_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path, piece = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    model = langid.train(["the and of it was is", "und der die nicht ein ist"], ["en", "de"])
    assert by_id(langid.identify_languages(df, model))[0]["n_words"] == 150_000
    check_packing(packing.pack_documents(df, path).collect(), rows, 2048)
    got = by_id(spans.dedup_spans(df))
    assert {d: r["text"] for d, r in got.items()} == brute_spans(rows, 3, 12) and len(got[20]["text"].split()) < 60
    assert [by_id(neardup.near_duplicates(df))[d]["component_id"] for d in (0, 20, 40, 60)] == [0, 0, 40, 60]
    got = by_id(ordermin.neighbour_fingerprints(df, sketches=4))
    assert [got[d]["n_chars"] for d in (0, 20, 40, 60)] == [len(t) for _, t in rows] and got[0]["near_next"] > 0
    got = by_id(suffixes.dedup_bytes(df))
    assert got[20]["n_bytes"] - got[20]["n_removed"] <= 220 and (got[40]["n_removed"], got[60]["n_removed"]) == (399_999, 0)
    assert [by_id(sharding.assign_shards(df))[d]["size"] for d in (0, 40)] == [len(rows[0][1]) + 1, 400_001]
    got = by_id(sentencepiece_backend.encode_documents(df, piece))
    assert all(r["parity"] and r["round_trip"] for r in got.values())
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", rows[0][1])], "pair_id long, turn long, role string, text string")
    other = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", rows[1][1])], "pair_id long, turn long, role string, text string")
    r = format_preferences(turns, other).collect()[0]
    assert r["n_common"] == 1 and rows[0][1] in r["chosen"] and rows[1][1] in r["rejected"]
    wide = spark.createDataFrame([(i, [float(i)] * 50_000) for i in (0, 1, 2)], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in sorted(topk.search(wide).collect(), key=lambda r: r["rank"])] == [1, 2]


def test_pipeline_stages_by_brute_force(spark, sf_dir, docs):
    """Each stage's rows, on the rows that its predecessor kept."""
    import corpus_pipeline

    extra = [(1_000_001, "The same words stand in this row of the one id, and they are many enough.", "en", "s", 10), (1_000_001, "Quite another text has the very same id, which must not hurt it at all.", "en", "s", 10), (None, "No id here but words.", None, None, None), (1_000_002, "!!! 123", "en", "s", 7)]
    given = docs.unionByName(spark.createDataFrame(extra + extra[:1], docs.schema))
    kept = corpus_pipeline.language_id(spark, given, sf_dir)
    rows = given.collect()
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in rows if re.search(r"[^\W\d_]", r["text"] or ""))

    rows = kept.collect()
    left = corpus_pipeline.near_dedup(spark, kept, sf_dir)
    texts = {(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None}
    number = {x: i for i, x in enumerate(sorted(texts))}  # by id, then text: one number a text
    comp = brute_components([(i, t) for (_, t), i in number.items()], 5)
    least = {}
    for (d, _), i in number.items():
        least[comp[i][1]] = min(d, least.get(comp[i][1], d))
    want = [(d, t) for (d, t), i in number.items() if d == least[comp[i][1]]]
    assert sorted((r["doc_id"], r["text"]) for r in left.filter("doc_id IS NOT NULL").collect()) == sorted(want)
    assert left.filter("doc_id IS NULL").count() == 1

    rows = sorted((r["doc_id"], r["text"]) for r in left.filter("doc_id IS NOT NULL").collect())
    one = [x for x in rows if x[0] != 1_000_001]
    cut = corpus_pipeline.substring_dedup(spark, left.filter("doc_id <> 1000001"), sf_dir).collect()
    brute = brute_spans(one, 3, 12)
    assert sorted((r["doc_id"], r["text"]) for r in cut) == sorted((d, brute[d]) for d, t in one if brute[d] == t or re.search(r"\S", brute[d], re.A))
    assert all(r["n_chars"] == len(r["text"]) for r in cut if brute[r["doc_id"]] != dict(one)[r["doc_id"]])

    done = spark.createDataFrame(cut, docs.schema)
    check_packing(corpus_pipeline.packing(spark, done, sf_dir).collect(), [(r["doc_id"], r["text"]) for r in cut], 2048)


def test_pipeline(spark, sf_dir, edges, docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "packing"]
    out = corpus_pipeline.run(spark, sf_dir)
    ids = {r["doc_id"] for r in out.collect()}
    comp = brute_components(sorted((r["doc_id"], r["text"]) for r in docs.filter(F.col("text").rlike(r"\p{L}")).collect()), 5)
    heads = {d for d, (_, c) in comp.items() if d == c}
    assert ids <= heads and len(ids) >= 0.7 * len(heads)
    full = edges.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (full, full.limit(0)):
            assert stage(spark, table, sf_dir).columns == full.columns


@pytest.mark.parametrize("lang", [None, "und"])
def test_pipeline_keeps_texts_without_labels(spark, sf_dir, edges, lang):
    import corpus_pipeline

    full = edges.withColumns({"lang": F.lit(lang).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    out = corpus_pipeline.language_id(spark, full, sf_dir)
    assert out.columns == full.columns
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == sorted(e[0] or 0 for e in EDGES if re.search("[A-Za-z]", e[1] or ""))


def test_queries_match_their_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in ("benchmark", "documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name, sql in queries.ORACLE.items():
        df, other = queries.QUERIES[name](spark, sf_dir), con.sql(sql)
        at = [other.columns.index(c) for c in df.columns]
        assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, (tuple(r[i] for i in at) for r in other.fetchall()))), name
