"""Literal cases: rows typed by hand, and what must change when the rule is broken."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions import identifiers as I
from oreline.functions import markup as M
from oreline.functions import names as N
from oreline.functions import text as X
from oreline.operators import citations, curves, inference, ledger, linkage, raster, routing, sampling, search, sequence, stats, verdicts, versioning
from oreline.plans import registry
from oreline.sources import files
from oreline.streaming import streams


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def one(spark, expr, **cols):
    row = spark.createDataFrame([tuple(cols.values())], list(cols)) if cols else spark.range(1)
    return row.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("scheme", "value", "canon"), [
    ("doi", "https://doi.org/10.1000/ABC.", "10.1000/abc"), ("doi", "10.5/x​;", "10.5/x"), ("doi", "none", ""), ("arxiv", "arXiv:2101.00001v3", "2101.00001"),
    ("isbn", "ISBN-10: 0-306-40615-2", "9780306406157"), ("isbn", "0-306-40615-3", "0306406153"), ("isbn", "0000000000", "0000000000"), ("issn", "0317847 1", "0317-8471"),
    ("pmcid", "pmc 123", "PMC123"), ("handle", "hdl: 1721.1/7", "1721.1/7"), ("wikidata", "https://www.wikidata.org/wiki/q42/", "Q42"), ("other", " A ", "A"),
])
def test_canonical_identifiers(spark, scheme, value, canon):
    assert one(spark, I.canonical("s", "v"), s=scheme, v=value) == canon


def test_identifier_conversions(spark):
    assert one(spark, I.to_isbn10(F.lit("9780306406157"))) == "0306406152"
    assert one(spark, I.isbn13_valid(F.lit("9780306406158"))) is False
    assert one(spark, I.isbn10_check(F.lit("080442957"))) == "X"
    assert one(spark, I.valid(F.lit("issn"), F.lit("0317-8471"))) is True and one(spark, I.valid(F.lit("issn"), F.lit("0317-8472"))) is False
    assert one(spark, I.find_doi("t"), t="see (doi:10.1000/a(b)c), and") == "10.1000/a(b)c"
    assert one(spark, I.find_doi("t"), t="nothing") is None
    assert one(spark, I.doi_to_arxiv(I.arxiv_to_doi(F.lit("2101.00001")))) == "2101.00001"
    assert one(spark, I.schemes_of(F.lit("10.1000/abc"))) == ["doi"]


def test_text_functions(spark):
    assert one(spark, X.norm_title("t"), t="<i>Été</i>: a  Study!") == "été a study"
    assert one(spark, X.canonical_newlines("t"), t="a\r\nb\rc\n\nd") == "a\nb\nc\n\nd"
    assert one(spark, X.strip_invisible("t"), t="a​b­c d\u00a0e\tf\u3000g\U00013430") == "abcdefg"
    assert one(spark, I.doi("t"), t="doi: 10.1000/ab c.") == "10.1000/abc"
    assert one(spark, X.url_host("t"), t="HTTPS://u@Example.org:80/x?y") == "example.org"
    assert one(spark, X.family_name("t"), t="Ada  Lovelace") == "lovelace" and one(spark, X.family_name("t"), t="Lovelace, Ada") == "lovelace"
    for name, want in (("Efron, B.", "efron"), ("Bradley Efron", "efron"), ("Efron, B.; Tibshirani, R.", "efron"), ("J.O'Neil-Dunne and X", "oneildunne"), ("Mu\u0308ller", "muller"), ("", "")):
        assert one(spark, X.family_name("t"), t=name) == want
    assert one(spark, X.family_matches("a", "b"), a="Van Den Hout", b="vandenhout") is True and one(spark, X.family_matches("a", "b"), a="Hwang", b="Wang") is False
    assert len(X.MARKED) == len(X.PLAIN)
    assert sorted(one(spark, X.trigrams("t"), t="Cat")) == ["  c", " ca", "at ", "cat"]
    assert one(spark, X.trigram_similarity(X.trigrams("a"), X.trigrams("b")), a="word", b="words") == pytest.approx(4 / 7)
    assert one(spark, X.sniff("t"), t="%PDF-1.7") == "pdf" and one(spark, X.sniff("t"), t="<!DOCTYPE html>") == "html"
    assert tuple(one(spark, X.page_range("t"), t="pp. 12-19")) == (12, 19) and one(spark, X.page_range("t"), t="x") is None
    assert one(spark, X.html_to_text("t"), t="<p>a<script>x</script> b</p>") == "a b"


def test_markup():
    html = "<html><head><title>t</title></head><nav>menu</nav><h2>Head</h2><p>One<br>two</p><p>One two</p><div class='side-menu'><p>no</p></div><p>End"
    assert M.blocks_of(html) == [("heading", "Head", 2), ("paragraph", "One two", 0), ("paragraph", "End", 0)]
    assert M.units_of("# A\ntext\nmore\n\n- b\n```\n# no\n```\n| x | y |\n|--|--|\n") == [("A", "paragraph", "text more"), ("A", "bullet", "b"), ("A", "row", "x | y")]
    assert M.sentences_of('He said "Go. Now." Then [see p. 3. x] left. End') == ['He said "Go. Now." Then [see p. 3. x] left.', "End"]
    assert M.density_of("plain words here that go on and on for a while\nx = y (1)") > 0 and M.density_of("") == 0.0
    assert M.repeated_tail_of("start ab ab ab ab") == (4, 3, " ab") and M.repeated_tail_of("abc") is None
    assert M.repeated_tail_of("x" + "ab" * 5000) == (5000, 2, "ab") and M.repeated_tail_of("aaaa") == (4, 1, "a")
    unit = "".join(map(chr, range(48, 108)))
    assert M.repeated_tail_of("tail " + unit[:59] * 4) == (4, 59, unit[:59]) and M.repeated_tail_of("q" * 3) is None
    tei = "<TEI xmlns='http://www.tei-c.org/ns/1.0'><biblStruct><title>T</title><idno type='DOI'>10.1/X</idno><date when='2001-05'/><surname>Doe</surname></biblStruct></TEI>"
    assert M.references_of(tei) == [{"title": "T", "doi": "10.1/x", "year": 2001, "families": ["Doe"]}] and M.references_of("<") == []


def test_curve_counts_and_ties(spark):
    rows = spark.createDataFrame([("a", 10, 1), ("a", 10, 0), ("a", 200, 1), ("a", None, 1), ("a", 255, 1)], "g string, s int, t int")
    hist = curves.score_histogram(rows, "s", "t", ["g"])
    cut = {r["k"]: (r["tp"], r["fp"], r["fn"]) for r in curves.cut_counts(hist, ["g"]).collect()}
    assert len(cut) == 254 and cut[10] == (2, 1, 0) and cut[11] == (1, 0, 1) and cut[201] == (0, 0, 2)
    assert curves.auroc(hist, ["g"]).first()["auroc"] == 0.75
    curve = curves.pr_curve(hist, ["g"])
    assert curve.filter("k = 254").first()["precision"] is None
    assert curves.best_f1(curve, ["g"]).first()["k"] == 1
    pick = curves.plateau_pick(curve, ["g"]).first()
    assert pick["k"] == 10 and pick["edge_flag"] == ""
    assert curves.plateau_pick(curve.filter("k <> 7"), ["g"]).count() == 0  # a curve that lacks a cut is refused


def test_zero_denominators(spark):
    rows = spark.createDataFrame([("a", 0, 0)], "g string, c int, t int")
    assert curves.confusion_metrics(rows, "c", "t", ["g"]).first()["precision"] == 0.0


def test_interval_attribution_zero_one_many(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    points = spark.createDataFrame([(1, "u", t(1)), (2, "u", t(3)), (3, "u", t(5)), (4, "v", t(1)), (5, "u", t(4))], "id int, u string, ts timestamp")
    spans = spark.createDataFrame([("u", t(0), t(4), "a"), ("u", t(3), t(4), "b"), ("u", t(5), t(6), "c"), ("u", t(5), t(7), "c")], "u string, s timestamp, e timestamp, l string")
    got = ledger.attribute_interval(points, spans, ["u"], "ts", "s", "e", "l", "id", bucket_seconds=3600)
    assert values(got, "id", "step") == [(1, "a"), (2, "ambiguous"), (3, "c"), (4, "between"), (5, "between")]


def test_completed_needs_a_last_ok(spark):
    rows = spark.createDataFrame([("a", 1, "OK"), ("b", 1, "OK"), ("b", 2, "FAIL"), ("c", 1, "FAIL"), ("c", 2, "OK"), ("c", 3, "NOTE")], "k string, seq int, s string")
    got = ledger.completed(rows, ["k"], ["seq"], F.col("s") == "OK", F.col("s") == "FAIL", F.lit(False))
    assert values(got, "k", "seq") == [("a", 1), ("c", 2)]


def test_backoff(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "bad"), ("a", 3, "bad"), ("b", 1, "bad"), ("b", 2, "x")], "k string, ts int, s string").withColumn("seq", F.col("ts"))
    got = ledger.replay_backoff(rows, ["k"], "ts", "seq", F.col("s") == "bad", 60, 100)
    assert values(got, "k", "streak", "wait_s") == [("a", 2, 100), ("b", 0, 0)]


def test_signature(spark):
    a, b = "Job 17 at 0xAF failed in /data/x/y.csv after 3.5 s", "Job 4 at 0x1 failed in /tmp/z/q.csv after 12 s"
    assert one(spark, ledger.signature(F.lit(a))) == one(spark, ledger.signature(F.lit(b)))


@pytest.mark.parametrize(("states", "kind", "start", "end"), [
    ("PPP", "STABLE_PRESENT", 1, 3), ("PUP", "PRESENT_WITH_GAPS", 1, 3), ("AAP", "ESTABLISHED", 3, 3), ("PPA", "LOST", 1, 2), ("PAP", "FLICKERING", 3, 3),
    ("P-P", "INSUFFICIENT", None, None), ("UUU", "ALL_UNSURE", None, None), ("AAA", "ABSENT_ALL", None, None), ("P-PP", "STABLE_PRESENT", 1, 4),
])
def test_validity(spark, states, kind, start, end):
    rows = spark.createDataFrame([("e", i + 1, s) for i, s in enumerate(states)], "e string, t int, s string")
    r = sequence.validity_intervals(rows, "e", "t", "s").first()
    assert (r["class"], r["valid_from"], r["valid_to"]) == (kind, start, end)


def test_closing_and_healing(spark):
    rows = spark.createDataFrame([("e", i, v) for i, v in enumerate([0, 1, 0, 0, 1, 0, 0, 0, 1, 0])], "e string, t int, v int")
    assert [r["closed"] for r in sequence.close_gaps(rows, ["e"], "t", "v", 2).orderBy("t").collect()] == [0, 1, 1, 1, 1, 0, 0, 0, 1, 0]
    gaps = spark.createDataFrame([("a", 1, 1), ("a", 2, 0), ("a", 3, 1), ("b", 1, 1), ("b", 4, 0), ("b", 5, 1)], "e string, t int, v int")
    assert values(sequence.heal(gaps, ["e"], "t", "v", 3).filter("v = 0"), "e", "tier", "healed") == [("a", "HEAL", 1), ("b", "BLIND", 255)]
    assert values(sequence.heal(gaps, ["e"], "t", "v", 2).filter("v = 0"), "e", "tier", "healed") == [("a", "REVIEW", 255), ("b", "BLIND", 255)]


def test_chains_of_any_length_and_circles(spark):
    n = 1300
    versions = spark.createDataFrame([(i, i - 1 if i else None) for i in range(n)], "v long, base long")
    heads = spark.createDataFrame([(n - 1,)], "head long")
    out = versioning.chains(versions, heads, "v", "base", "head")
    assert out.count() == n and out.agg(F.max("depth")).first()[0] == n - 1
    with pytest.raises(ValueError, match="circle"):
        versioning.chains(spark.createDataFrame([(0, 1), (1, 0)], "v long, base long"), spark.createDataFrame([(0,)], "head long"), "v", "base", "head")


def test_hold_reaches_through_trees_and_circles(spark):
    items = spark.createDataFrame([(i, i == 0) for i in range(40)], "k long, held boolean")
    for pairs in ([(i + 1, i) for i in range(30)], [(i + 1, i) for i in range(30)] + [(5, 33), (33, 34)], [(1, 0), (2, 1), (10, 11), (11, 10)], [(i, i // 2) for i in range(1, 40)]):
        held = {0}
        for _ in range(40):
            held |= {a for a, b in pairs if b in held}
        out = versioning.hold_fixpoint(items, spark.createDataFrame(pairs, "k long, needs long"), "k", "held", "needs")
        assert {r["k"] for r in out.filter("mark = 'hold'").collect()} == held and out.count() == 40


def test_nearest_dim_of_any_size(spark):
    import random

    random.seed(3)
    dims = [random.randrange(-1000, 1000) for _ in range(300)]
    facts = [*range(-1100, 1100, 7), None]
    out = linkage.nearest_dim(spark.createDataFrame([(v,) for v in facts], "v long"), spark.createDataFrame([(d,) for d in dims], "d long").repartition(7), "v", "d").collect()
    assert len(out) == len(facts) and all(r["d"] == (None if r["v"] is None else min(dims, key=lambda d: (abs(d - r["v"]), d))) for r in out)
    assert {r["d"] for r in linkage.nearest_dim(spark.createDataFrame([(1,)], "v long"), spark.createDataFrame([], "d long"), "v", "d").collect()} == {None}


def test_greedy_match_against_a_loop(spark):
    import random

    random.seed(5)
    rows = [(g, a, b, random.randrange(1, 12) / 10) for g in range(6) for a in range(7) for b in range(7) if random.random() < 0.6]
    want = []
    for g in range(6):
        left, right = set(), set()
        for _, a, b, s in sorted((r for r in rows if r[0] == g and r[3] >= 0.3), key=lambda r: (-r[3], r[1], r[2])):
            if a not in left and b not in right:
                left.add(a), right.add(b)
                want.append((g, a, b))
    got = linkage.greedy_match(spark.createDataFrame(rows, "p long, a long, b long, s double"), "p", "a", "b", "s", 0.3)
    assert values(got, "p", "a", "b") == sorted(want)


def test_identifier_shapes(spark):
    for ref, want in (("10.1000/abc", "doi"), ("doi:10.1000/abc", "doi"), ("https://doi.org/10.1000/x", "doi"), ("https://doi.org/x", None), ("https://example.org/a", "url"), ("http://", None), ("arXiv:2101.00001v2", "arxiv"), ("A title of 10 words", None), ("", None)):
        assert one(spark, I.reference_kind("t"), t=ref) == want, ref
    assert one(spark, I.isbn_to_doi("t"), t="978-3-16-148410-0") == "10.978.316/1484100" and one(spark, I.isbn_to_doi("t"), t="9783161484100") is None
    found = '{"responseCode": 1, "values": [{"type": "URL", "data": {"value": "x"}}, {"type": "HS_ALIAS", "data": {"value": "10.1000/ABC"}}]}'
    assert one(spark, I.short_doi_alias("t"), t=found) == "10.1000/abc" and one(spark, I.short_doi_alias("t"), t=found.replace("1,", "100,", 1)) is None


def test_hmm_against_enumeration(spark):
    import itertools

    import numpy as np

    start, move, emit = [0.6, 0.4], [[0.7, 0.3], [0.2, 0.8]], {"x": [0.9, 0.2], "y": [0.1, 0.8]}
    word = "xyyxy"
    rows = spark.createDataFrame([("e", i, c) for i, c in enumerate(word)], "e string, t int, s string")
    got = sequence.hmm(rows, "e", "t", "s", start, move, emit).orderBy("t").collect()
    p = {}
    for path in itertools.product((0, 1), repeat=len(word)):
        p[path] = start[path[0]] * emit[word[0]][path[0]] * np.prod([move[path[i - 1]][path[i]] * emit[word[i]][path[i]] for i in range(1, len(word))])
    assert tuple(r["path"] for r in got) == max(p, key=p.get)
    for i, r in enumerate(got):
        assert r["p1"] == pytest.approx(sum(v for k, v in p.items() if k[i] == 1) / sum(p.values()), abs=1e-5)


def test_bounds_and_classes(spark):
    df = spark.createDataFrame([(0, 59), (5, 5), (2, 40)], "k int, n int").withColumn("u", stats.clopper_pearson_upper("k", "n"))
    u = [r["u"] for r in df.collect()]
    assert u[0] == pytest.approx(1 - 0.05 ** (1 / 59), abs=1e-5) and u[1] == 1.0
    assert sum(math.comb(40, i) * u[2] ** i * (1 - u[2]) ** (40 - i) for i in range(3)) == pytest.approx(0.05, abs=1e-4)
    counts = [(a, b, c, int(10_000 * sum(w * (s if a else 1 - s) * (s if b else 1 - s) * (s if c else 1 - s) for w, s in ((0.4, 0.9), (0.6, 0.1))))) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    got = stats.latent_classes(spark.createDataFrame(counts, "a int, b int, c int, n long"), ["a", "b", "c"]).first()
    assert got["prevalence"] == pytest.approx(0.4, abs=0.02) and got["sensitivity"] == pytest.approx(0.9, abs=0.02)


def test_linkage(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, 20.0, 0.0)], "a int, x double, y double")
    b = spark.createDataFrame([(7, 1.0, 0.0), (8, 20.0, 3.0), (9, 20.0, -3.5)], "b int, x double, y double")
    got = linkage.mutual_nearest(a.withColumn("g", F.lit(1)), b.withColumn("g", F.lit(1)), ["g"], "x", "y", "a", "b", 8.0, 1.5)
    assert values(got, "a", "b") == [(1, 7)]  # the runner-up of 2 is too near
    pairs = spark.createDataFrame([(1, 1, 1, 0.9), (1, 1, 2, 0.8), (1, 2, 1, 0.85), (1, 2, 2, 0.5)], "p int, a int, b int, s double")
    assert values(linkage.greedy_match(pairs, "p", "a", "b", "s", 0.1), "a", "b") == [(1, 1), (2, 2)]
    assert one(spark, linkage.iou(F.array(*map(F.lit, (0.0, 0.0, 2.0, 2.0))), F.array(*map(F.lit, (1.0, 0.0, 3.0, 2.0))))) == pytest.approx(1 / 3)
    v = linkage.judge(F.lit(0.9), F.lit(True), F.lit(2000), F.lit(None).cast("int"))
    assert tuple(one(spark, v)) == (False, "year unknown")


def test_versions(spark):
    ver = spark.createDataFrame([(1, None), (2, 1), (3, 2), (9, None)], "v int, base int")
    assert values(versioning.chains(ver, spark.createDataFrame([(3,), (9,)], "h int"), "v", "base", "h"), "head", "version", "depth") == [(3, 1, 2), (3, 2, 1), (3, 3, 0), (9, 9, 0)]
    items = spark.createDataFrame([(1, True), (2, False), (3, False), (4, False)], "k int, held boolean")
    deps = spark.createDataFrame([(2, 1), (3, 2)], "k int, needs int")
    assert values(versioning.hold_fixpoint(items, deps, "k", "held", "needs"), "k", "mark") == [(1, "hold"), (2, "hold"), (3, "hold"), (4, "prepare")]


def test_raster(spark):
    px = spark.createDataFrame([(0, 0, 0, 1), (0, 0, 1, 0), (0, 1, 1, 1), (0, 5, 5, 1), (0, 0, 2, 255)], "grid int, row int, col int, v int")
    assert values(raster.components(px, "v", 2), "row", "col", "component", "cells") == [(0, 0, "0:0", 2), (1, 1, "0:0", 2)]
    assert values(raster.dilate(px, "v"), "row", "col", "v") == [(0, 0, 1), (0, 1, 1), (0, 2, 255), (1, 1, 1), (5, 5, 1)]


def test_rules(spark):
    assert one(spark, verdicts.first_rule([(F.lit(None).cast("boolean"), "a"), (F.lit(True), "b"), (F.lit(True), "c")], "d")) == "b"
    assert one(spark, verdicts.replacement(F.lit(1), F.lit(0), F.lit(False))) == "REPLACE" and one(spark, verdicts.replacement(F.lit(3), F.lit(1), F.lit(False))) == "COMPLEMENT"
    assert tuple(one(spark, verdicts.steps_verdict([("a", F.lit(True)), ("b", F.lit(None).cast("boolean"))]))) == ("refuse", "b")


def test_sampling(spark):
    ids = spark.range(1000).withColumnRenamed("id", "k")
    a, b = sampling.stability_sample(ids, "k", "s", 0.1), sampling.stability_sample(ids.repartition(7), "k", "s", 0.1)
    assert values(a, "k") == values(b, "k") and a.count() == 100
    ranks = sampling.global_rank(ids.repartition(5), [F.desc("k")])
    assert values(ranks.filter("k + rank <> 999"), "k") == [] and ranks.count() == 1000


def test_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "q_20260131_235959.csv").write_text("# note\na,b\n1,x\ntorn\n2,\n")
    (tmp_path / "in" / "skip.txt").write_text("no")
    rows, defects = files.read_csv(spark, str(tmp_path / "in"), T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())]), name_filter="*.csv")
    assert values(rows, "a", "b")[0] == (1, "x") and rows.filter("a = 2 AND b IS NULL").count() == 1
    assert values(defects, "line") == [("torn",)]
    stem = rows.select(*files.launch_of()).first()
    assert stem["stem"] == "q" and stem["launched"] == dt.datetime(2026, 1, 31, 23, 59, 59)
    out = str(tmp_path / "t")
    files.append_rows(rows.select("a"), out)
    files.append_rows(rows.select("a"), out)
    assert spark.read.parquet(out).count() == 4
    with pytest.raises(ValueError, match="fit"):
        files.append_rows(rows.select("b"), out)
    assert not files.replace_if_grown(rows.select("a"), out, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="protected"):
        files.guard_path("/lake/x", ["/lake"])
    assert one(spark, files.request_key("a", "b"), a="1", b="2") == one(spark, files.request_key("a", "b"), a="1", b="2")


def test_streams(spark, tmp_path):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = spark.createDataFrame([("a", t(1), "bad", 1.0), ("a", t(2), "bad", 2.0), ("b", t(2), "ok", 3.0), ("b", t(40), "bad", 4.0)], "k string, ts timestamp, kind string, value double")
    rows.write.parquet(str(tmp_path / "ev"))
    stream = streams.read_stream(spark, str(tmp_path / "ev"), "k string, ts timestamp, kind string, value double")
    win = streams.drain(streams.windowed(stream, "ts", ["k"], "10 minutes"), "win", "complete")
    assert values(win, "k", "n", "total") == values(streams.windowed(rows, "ts", ["k"], "10 minutes"), "k", "n", "total") == [("a", 2, 3.0), ("b", 1, 3.0), ("b", 1, 4.0)]
    cool = streams.drain(streams.cool_downs(stream, "k", "ts", "kind", "bad", 60, 300), "cool", "update")
    assert values(cool, "k", "wait_s", "seen") == [("a", 120, 2), ("b", 60, 2)]


def test_streams_keep_state_over_batches(spark, tmp_path):
    import datetime as dt

    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    batches = [[("a", at(1), "transient", 1.0), ("a", at(0), "transient", 0.5), ("b", at(0), "success", 7.0)], [("a", at(2), "success", 2.0), ("b", at(3), "neutral", 8.0), ("a", at(3), "success", 2.5)]]
    folder = str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, "k string, ts timestamp, kind string, value double").coalesce(1).write.mode("append").parquet(folder)
    stream = lambda: streams.read_stream(spark, folder, "k string, ts timestamp, kind string, value double", files_a_batch=1)
    prev = streams.drain(streams.previous_values(stream(), "k", "ts", "value"), "prev", "append").collect()
    assert len(prev) == 6 and {(r["k"], r["value"]) for r in prev if r["previous"] is None or r["previous"] != r["previous"]} <= {("a", 0.5), ("a", 2.0), ("b", 7.0), ("b", 8.0)}
    assert {(r["value"], r["previous"]) for r in prev if r["k"] == "a"} >= {(1.0, 0.5), (2.5, 2.0)}
    got = [tuple(r) for r in streams.drain(streams.paced(stream().withColumn("codes", F.array(F.when(F.col("kind") == "neutral", 200).otherwise(404))), "k", "ts", "kind", "codes"), "paced", "update").collect()]
    assert ("b", 2, 0.0) in got and ("a", 4, 2.0) in got and max(n for k, n, _ in got if k == "a") == 4
    moved = streams.drain(streams.changes(stream().withColumn("n", F.unix_seconds("ts")), "k", "n", "kind"), "moved", "append").collect()
    assert 3 <= len(moved) <= 4 and {r["kind"] for r in moved} == {"transient", "success", "neutral"}
    q = streams.published(stream(), "k", "ts", str(tmp_path / "out"), str(tmp_path / "cp"), every="")
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 6 and set(out.columns) == {"k", "ts", "kind", "value", "minute"}


def test_names(spark):
    assert one(spark, N.fold_tokens("t"), t="Wang1,2 and O'Neil-Dunne, K\ufffdpcke <b>É</b>") == ["wang", "and", "oneildunne", "kpcke", "e"]
    for page, family, want in (("by De La Cruz", "De la Cruz", True), ("by DelaCruz", "De la Cruz", True), ("Hwang", "Wang", False), ("Hansena", "Hansen", True), ("", "X", False)):
        assert one(spark, N.tokens_contain(N.fold_tokens("a"), N.fold_tokens("b")), a=page, b=family) is want, page
    key = lambda a, y, t: one(spark, N.citation_key("a", F.col("y"), "t"), a=a, y=y, t=t)
    assert key("PAGE", 1999, "The state of the art in a field") == "Page_1999_state-art-field" and key("van der Berg", 2001, "On") == "VanDerBerg_2001_on-work"
    assert key("Müller", 7, "Ein Titel") == "Muller_0007_ein-titel" and key("A" + "b" * 20, 2000, "internationalization considerations regarding something") == "A" + "b" * 20 + "_2000_internationaliza-considerations"
    r = one(spark, N.best_window("a", "b"), a="A long title here", b="noise\nA long\ntitle here\nmore")
    assert r["ratio"] == 1.0 and r["window"] == "A long title here"
    assert one(spark, N.decoded("d", "c"), d="é".encode("latin-1"), c="text/html; charset=ISO-8859-1") == "é" and one(spark, N.decoded("d", "c"), d="é".encode(), c="") == "é"
    blocks = F.array(F.struct(F.lit("heading").alias("kind"), F.lit("H").alias("text"), F.lit(2).alias("level")), F.struct(F.lit("paragraph").alias("kind"), F.lit("p").alias("text"), F.lit(0).alias("level")))
    assert one(spark, N.rendered(blocks)) == "## H\n\np"
    tail = F.struct(F.lit(None).cast("int").alias("repeats"))
    assert one(spark, N.degeneracy(F.lit("x"), tail, F.lit(9), 9)) == "cut" and one(spark, N.degeneracy(F.lit(" "), tail, F.lit(1), 9)) == "empty" and one(spark, N.degeneracy(F.lit("x"), tail, F.lit(1), 9)) is None


def test_kinds_and_stems(spark):
    assert search.kinds_of("") == search.DEFAULT_KINDS and search.kinds_of("all") == search.ALL_KINDS and search.kinds_of("table, other") == ["table", "other"]
    with pytest.raises(ValueError, match="page-header"):
        search.kinds_of("page-header")
    for word, want in (("classes", "class"), ("studies", "studi"), ("study", "studi"), ("walked", "walk"), ("walking", "walk"), ("sing", "sing"), ("trees", "tree"), ("glass", "glass")):
        assert one(spark, search.stem(F.col("t")), t=word) == want, word


def test_clusters_and_quotas(spark):
    assert inference.complete_linkage({(0, 1): 1.0, (0, 2): 9.0, (1, 2): 8.0, (0, 3): 9.5, (1, 3): 9.0, (2, 3): 2.0}, 4, 2) == [[0, 1], [2, 3]]
    rows = spark.createDataFrame([(i, i % 4, i % 25 == 0) for i in range(200)], "k long, b int, f boolean")
    got = sampling.quota_sample(rows, "k", "b", "f", 60, "s").collect()
    assert len(got) == 60 and {r["k"] for r in got if r["f"]} == {i for i in range(0, 200, 25)} and all(12 <= sum(r["b"] == b and not r["f"] for r in got) <= 14 for b in range(4))
    assert sampling.quota_sample(rows, "k", "b", "f", 500, "s").count() == 200


def test_passage_leg_sees_whole_documents(spark):
    passage = " ".join(f"word{i}q" for i in range(40))
    filler = " ".join(chr(97 + i % 26) * 3 for i in range(300))
    docs = spark.createDataFrame([(1, f"{filler} {passage} {filler}"), (2, filler), (3, None), (4, passage), (5, "")], "d long, t string")
    asked = spark.createDataFrame([(7, passage), (8, "word1q word2q word3q"), (9, None)], "q long, t string")
    got = values(search.passage_leg(asked, docs, "q", "d", "t", 0.2), "q", "d")
    assert {(7, 1), (7, 4)} <= set(got) and not {d for _, d in got} & {2, 3, 5}


def test_pacing_takes_any_2xx_for_an_answer(spark):
    rows = [("a", 1, "transient", [503]), ("a", 2, "transient", [429]), ("a", 3, "no-copy", [404, 200]), ("a", 4, "no-copy", [404]), ("a", 5, "no-copy", None), ("b", 1, "transient", [200]), ("c", 1, "success", [])]
    df = spark.createDataFrame(rows, "k string, n int, kind string, codes array<int>")
    assert {tuple(r) for r in routing.pacing(df, "k", ["n"], "kind", "codes").collect()} == {("a", 5, 3.0), ("b", 1, 2.0), ("c", 1, 0.0)}


def test_keys_are_built_to_fit_or_refused(spark):
    key = lambda a, y, t: one(spark, N.citation_key("a", F.col("y"), "t"), a=a, y=y, t=t)
    assert key("Smith", 2020, "Using its own maps via towards the sea") == "Smith_2020_own-maps-sea"
    assert key("Land Product Validation Subgroup (Working Group on Calibration and Validation", 2025, "A b c") == "LPVSWGCV_2025_b-c"
    assert key("x" * 30 + " " + "y" * 30, 1999, "one two") == "XY_1999_one-two" and key("Z" + "z" * 80, 1999, "a") == "Z" + "z" * 48 + "_1999_a-w"
    assert key("Smith", 12019, "one two") is None


def test_ancestors_of_long_chains_and_circles(spark):
    parent = {i: i + 1 for i in range(37)} | {100: 101, 101: 102, 102: 100, 103: 100, 104: 103, 200: 200, 300: 36} | {i: 7 for i in range(400, 405)}
    got = {r["node"]: (r["top"], r["depth"]) for r in citations.ancestors(spark.createDataFrame(list(parent.items()), "node long, parent long")).collect()}
    for node in parent:
        at, steps = node, 0
        while at in parent and steps <= len(parent):
            at, steps = parent[at], steps + 1
        assert got[node] == ((None, None) if at in parent else (at, steps))


def test_searches_ask_every_twentieth_text(spark, sf_dir, tmp_path):
    tail = "the whole text counts here to the very last term omega"
    spark.createDataFrame([(i, tail if i % 20 == 0 else "alpha") for i in range(45)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "filler " * 100 + tail), (2, "the whole text counts here to"), (3, "alpha")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: registry.QUERIES[name](spark, str(tmp_path))
    assert values(run("search_all"), "item_id", "doc_id") == [(i, 1) for i in (0, 20, 40)]
    assert values(run("search_any"), "item_id", "doc_id") == [(i, d) for i in (0, 20, 40) for d in (1, 2)]
    got = {(r["item_id"], r["doc_id"]): r["n_legs"] for r in run("search_rrf").collect()}
    assert {i for i, _ in got} == {0, 20, 40} and all(got[i, 1] == 3 for i in (0, 20, 40))


def test_boxes_of_every_order_take_part(spark, tmp_path):
    rows = [(o, n, 3, 4, 5.0) for o in range(1, 12) for n in (1, 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("box_overlap", "box_match"):
        assert values(registry.QUERIES[name](spark, str(tmp_path)), "page", "a_box", "b_box") == [(o, 2, 1) for o in range(1, 12)]


def test_cosines_of_every_twentieth_vector(spark):
    rows = [(i, [float(i % 7 + 1), float(i % 5), 1.0]) for i in range(61)] + [(100, [0.0, 0.0, 0.0]), (120, None), (None, [1.0, 1.0, 1.0]), (140, [1.0]), (160, [1.0, float("nan"), 0.0])]
    vectors = spark.createDataFrame(rows, "i long, v array<double>")
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b)), 6)
    want = [(q, i) for q in (0, 20, 40, 60) for _, i in sorted((-cos(rows[q][1], rows[i][1]), i) for i in range(61) if i != q)[:3]]
    leg = search.cosine_leg(vectors, 20, 3, "i", "v", queries_at_once=2, chunk=9)
    assert values(search.ranked(leg, "query_id", "vec_id", 3), "query_id", "vec_id") == sorted(want)


def test_mentions_of_a_tei_body():
    xml = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div><s coords="3,1,2,3,4;4,0,0,1,1">One <ref type="bibr" target="#b1" coords="3,10,20,5,6;bad;4,1,1,2,2"> A  2020 </ref> more.</s>
    <ref type="bibr">[2]</ref><ref type="figure" target="#f">x</ref></div></body><back><ref type="bibr" target="#b9"/></back></text></TEI>"""
    got = M.mentions_of(xml)
    assert [(m["target"], m["marker"], m["page"], m["box"], m["box_index"], m["sentence_page"]) for m in got] == [("b1", "A 2020", 3, [10.0, 20.0, 15.0, 26.0], 0, 3), ("b1", "A 2020", 4, [1.0, 1.0, 3.0, 3.0], 1, 3), ("", "[2]", None, None, 0, None)]
    assert got[0]["sentence"] == "One A 2020 more." and got[2]["sentence"] == "" and M.mentions_of("<broken") == []
