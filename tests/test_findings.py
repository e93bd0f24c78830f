"""Tables typed by hand for single queries: results against the query's SQL, and plans whose size must stay bounded."""

import datetime as dt
from collections import Counter

import duckdb
import pytest
from test_queries import plain

from oreline.plans import registry


def against_sql(spark, folder, name, **tables):
    """The query's rows, after comparing them with its SQL on the given tables: each a schema and rows."""
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df = registry.QUERIES[name](spark, str(folder))
    cols, got = sorted(df.columns), df.collect()
    other = con.sql(registry.ORACLE[name])
    at = [other.columns.index(c) for c in cols]
    assert Counter(tuple(plain(r[c]) for c in cols) for r in got) == Counter(tuple(plain(r[i]) for i in at) for r in other.fetchall())
    return got


@pytest.mark.parametrize("title", ["a" * 60 + " b", "a " + "b" * 60, "b " + "c" * 60, "a" * 40 + " " + "b" * 40, "a" * 41 + " " + "b" * 40, "a" * 30 + " " + "b" * 60, "x" * 70])
def test_citation_keys_that_lose_letters(title, spark, tmp_path):
    """A key that is too long with two words loses letters of the longer one, by the SQL too."""
    rows = [(i, title) for i in (1, 2, 3, 4, 6, 7, 90)]
    got = against_sql(spark, tmp_path, "citation_keys", documents=("doc_id long, text string", rows))
    assert all((r["key"] is None) == (r["doc_id"] == 90) for r in got) and any(len(r["key"] or "") == 58 for r in got)


def test_part_ancestors_of_repeated_edges(spark, tmp_path):
    """Two lines of one order and line number name one parent, the least; a line that comes twice names it once."""
    lines = [(10, 7, 20, 1), (10, 7, 20, 2), (11, 7, 30, 2), (11, 7, 30, 2), (12, 4, 5, 0), (12, 4, 40, 0), (13, 4, 6, 0), (13, 4, 6, 0)]
    got = against_sql(spark, tmp_path, "part_ancestors", part=("p_partkey long", [(i,) for i in range(50)]), lineitem=("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long", lines))
    nodes = [r["node"] for r in got]
    assert {20, 30} <= set(nodes) and len(nodes) == len(set(nodes))


def test_approximate_distinct_keeps_one_sketch(spark, sf_dir):
    """No aggregation by a key carries a sketch: each distinct value would hold one."""
    plan = registry.QUERIES["approximate_distinct"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "approx_count_distinct" in plan
    assert not [x for x in plan.split("\n") if "approx_count_distinct" in x and "keys=[]" not in x]


def test_equal_polygons_and_places_meet_once(spark):
    """A place is asked once of each outline, and every point and polygon still counts."""
    from pyspark.sql import functions as F

    from oreline.operators import spatial

    ring = "array(struct(0D x, 0D y), struct(4D x, 0D y), struct(0D x, 4D y))"
    polygons = spark.range(5, 3005).selectExpr("id pid", f"{ring} ring", "id % 7 v").union(spark.range(1).selectExpr("id", f"transform({ring}, p -> struct(p.x + 9 AS x, p.y AS y))", "99L"))
    points = spark.range(3000).selectExpr("id k", "if(id % 2 = 0, 1D, 9.5D) x", "if(id % 3 = 0, null, 1D) y")
    out = spatial.attach_polygon(points, polygons, "k", "pid", "ring", "v")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [ring#" in plan and "Aggregate [x#" in plan
    got = {tuple(r) for r in out.groupBy(F.col("k") % 2, F.col("k") % 3 == 0, "pid", "n_matched", "v_min", "v_max").count().collect()}
    assert got == {(0, False, 5, 3000, 0, 6, 1000), (1, False, 0, 1, 99, 99, 1000), (0, True, None, 0, None, None, 500), (1, True, None, 0, None, None, 500)}


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_launches_are_dealt_by_size(spark):
    """Sessions are dealt to as many tasks as their rows ask for; neither that nor how launches are sent changes a row."""
    from oreline.operators import telemetry

    day = "timestamp'2020-01-01' + make_dt_interval(cast({} as int))"
    rows = spark.range(400).selectExpr("if(id % 50 = 7, null, id div 4) session", f"{day.format('id % 90')} ts", "if(id % 11 = 3, null, id % 12) fp")
    spans = spark.range(30).selectExpr("concat('L', id) launch", f"{day.format('id % 5 * 15')} start", f"{day.format('id % 5 * 15 + 30')} end")
    printed = spark.range(30).selectExpr("concat('L', id) launch", "explode(array(id % 6, id % 12)) fingerprint")
    out = [telemetry.attribute_launches(rows, printed, spans, "session", "ts", "fp", rows_a_task=20, most_broadcast=m) for m in (0, 1000)]
    assert all("RepartitionByExpression [session#" in optimized(d) and "], 20" in optimized(d) for d in out)
    one, two = (sorted(map(repr, d.collect())) for d in out)
    assert one == two == sorted(map(repr, telemetry.attribute_launches(rows, printed, spans, "session", "ts", "fp").collect())) and len(one) == 101


@pytest.mark.parametrize(("name", "of", "most"), [("surname_on_page", "regexp_replace", 8), ("title_containments", "regexp_replace", 5)])
def test_texts_are_folded_once_a_row(name, of, most, spark, sf_dir):
    """What is costly stands in the plan once, not in each of the places that use it."""
    assert 0 < optimized(registry.QUERIES[name](spark, sf_dir)).count(of) <= most


def test_identifiers_are_dealt_by_size(spark, sf_dir):
    """Works are told apart on their own keys before they are counted; no task's share grows with the table."""
    plan = optimized(registry.QUERIES["identifier_collisions"](spark, sf_dir))
    assert "distinct" not in plan and plan.count("RepartitionByExpression") == 2


def test_ordered_match_settles_chains_by_blocks(spark):
    """A chain in which every choice waits for the one before, in one block and in many; the same as by a loop."""
    from oreline.operators import linkage

    rows = [(g, i, j, s) for g in (1, 2) for i in range(60) for j, s in ((i, 0.9), (i + 1, 0.9 + g / 100), ((i * 7) % 60, 0.5), (i + 2, 0.1))] + [(None, 1, 1, 0.9), (1, 99, None, 0.9)]
    want, gone = [], set()
    for g in (1, 2):
        for i in range(60):
            free = [(-s, j) for h, k, j, s in rows if (h, k) == (g, i) and s >= 0.3 and (g, j) not in gone]
            if free:
                gone.add((g, min(free)[1]))
                want.append((g, i, min(free)[1], -min(free)[0]))
    pairs = spark.createDataFrame(rows, "g int, a int, b int, s double")
    for size in (7, 1_000_000):
        assert sorted(map(tuple, linkage.ordered_match(pairs, "g", "a", "b", "s", 0.3, rows_a_task=size).collect())) == sorted(want)


def test_overlaps_that_cannot_reach_the_floor_are_left_out(spark):
    """With a floor the same pairs of that floor come out, and the shared areas of holed and crossing outlines stay."""
    from oreline.operators import polygons

    box = lambda x, y, w, h: [[x, y], [x + w, y], [x + w, y + h], [x, y + h]]
    shapes = [[box(i * 0.7, i % 3 + 0.0, 3.0, 2.0 + i % 2)] + ([box(i * 0.7 + 1, i % 3 + 0.5, 1.0, 1.0)] if i % 4 == 0 else []) for i in range(24)] + [[[[0.0, 0.0], [4.0, 3.0], [4.0, 0.0], [0.0, 3.0]]]]
    side = lambda name: spark.createDataFrame([(1, i, s) for i, s in enumerate(shapes)], f"g int, {name} int, rings array<array<array<double>>>")
    found = [{(r["a"], r["b"]): (r["shared"], r["iou"]) for r in polygons.overlaps(side("a"), side("b"), "g", "a", "b", "rings", 2.0, *floor).collect()} for floor in ((), (0.4,))]
    assert found[1] == {k: v for k, v in found[0].items() if v[1] >= 0.4} and 25 < len(found[1]) < len(found[0])
    assert abs(found[0][24, 24][0] - 6.0) < 1e-9 and abs(found[0][0, 0][0] - 5.0) < 1e-9


def test_ordered_overlaps_are_those_of_all_pairs(spark):
    """Holed, crossing and repeated outlines, both ways round: what each takes is as by all pairs in order; rows without area take none."""
    import random

    from pyspark.sql import functions as F

    from oreline.operators import linkage, polygons

    rng = random.Random(5)

    def shape(k):
        x, y, s = rng.randint(0, 12) / 3, rng.randint(0, 9) / 3, rng.choice([1.0, 1.2, 2.0])
        ring = [[x + s * a, y + s * b] for a, b in ([(0, 0), (1, 0), (1, 1), (0, 1)], [(0, 0), (1, 1), (1, 0), (0, 1)], [(0.2, 0), (1, 0.3), (0.6, 1), (0.1, 0.8)], [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0.5), (1, 0.5), (1, 1.5), (-1, 1.5)])[k % 4]]
        hole = [[x + s * a, y + s * b] for a, b in ((0.3, 0.3), (0.7, 0.3), (0.7, 0.7), (0.3, 0.7))]
        return [ring[:: rng.choice([1, -1])]] + ([hole[:: rng.choice([1, -1])]] if k % 3 == 0 else [])

    schema = "g string, {} string, rings array<array<array<double>>>"
    rows = lambda n: [(rng.choice("PQ"), f"k{i:03}", shape(rng.randint(0, 11))) for i in range(n)]
    left, right = rows(160), rows(150)
    odd = [(None, "z", left[0][2]), ("P", None, left[0][2]), ("P", "y", None), ("P", "w", [[[0.0, 0.0], [1.0, 1.0]]])]
    a, b = spark.createDataFrame(left + odd, schema.format("a")), spark.createDataFrame(right + odd, schema.format("b"))
    pairs = polygons.overlaps(a, b, "g", "a", "b", "rings", 1.0).withColumn("iou", F.round("iou", 9))
    for floor in (0.3, 0.05):
        want = sorted(map(tuple, linkage.ordered_match(pairs, "g", "a", "b", "iou", floor).collect()))
        broken = spark.createDataFrame([("P", "a0", [[[0.0, 0.0], [float("nan"), 1.0], [1.0, 0.0]]]), ("Q", "a1", [[[0.0, 0.0], [1.0, None], [1.0, 0.0]]]), ("Q", "a2", [])], schema.format("a"))
        got = polygons.ordered_overlaps(a.unionByName(broken), b, "g", "a", "b", "rings", floor)
        assert got.columns == ["g", "a", "b", "iou"] and sorted(map(tuple, got.collect())) == want and len(want) > 60


def test_crowded_crowns_are_not_paired_with_all(monkeypatch):
    """Of a sheet's overlapping pairs, whose number grows with its square, few are measured; short lists give the same as long ones."""
    import numpy as np
    import pyarrow as pa

    from oreline.operators import polygons

    rng = np.random.default_rng(3)
    x, y, s = rng.random(3000) * 9, rng.random(3000) * 9, 1 + rng.integers(0, 9, 3000) / 4
    x[2000:2400], y[2000:2400], s[2000:2400] = x[1000:1400], y[1000:1400], s[1000:1400]
    squares = pa.array([[[[u, v], [u + w, v], [u + w, v + w], [u, v + w]]] for u, v, w in zip(x, y, s)], pa.list_(pa.list_(pa.list_(pa.float64()))))
    measured, plain = [0], polygons.signed_overlaps
    monkeypatch.setattr(polygons, "signed_overlaps", lambda a, *more: (measured.__setitem__(0, measured[0] + len(a)), plain(a, *more))[1])
    over = lambda i, j: np.maximum(0, np.minimum(x[i] + s[i], x[j] + s[j]) - np.maximum(x[i], x[j])) * np.maximum(0, np.minimum(y[i] + s[i], y[j] + s[j]) - np.maximum(y[i], y[j]))
    pairs, want, free, every = 0, [], np.ones(2000, bool), 1000 + np.arange(2000)
    for i in range(1000):
        shared = over(i, every)
        pairs += int((shared > 0).sum())
        iou = np.where(free & (shared > 0), np.round(shared / (s[i] ** 2 + s[every] ** 2 - shared), 9), -1)
        if iou.max() >= 0.3:
            want.append((i, int(iou.argmax())))
            free[iou.argmax()] = False
    for most in (2, 32):
        shapes = polygons._Shapes()
        number, box = shapes.add(squares)
        turns = polygons._Turns(polygons._Free(shapes, number[1000:], box[:, 1000:], np.arange(2000)), 0.3, most)
        measured[0] = 0
        got = turns.settle(np.arange(1000), (box[0, :1000], box[1, :1000], (box[2] - box[0])[:1000], (box[3] - box[1])[:1000], number[:1000]))
        assert [(a, b) for a, b, _ in got] == want
    assert measured[0] * 4 < pairs


@pytest.mark.parametrize("name", ["planted_shifts", "planted_edges"])
def test_tiles_are_dealt_before_they_are_drawn(name, spark, sf_dir):
    """The keys come in one file, so one task, and would draw and measure all tiles there."""
    plan = optimized(registry.QUERIES[name](spark, sf_dir))
    assert "RepartitionByExpression [s_suppkey" in plan[plan.index("MapInArrow") :]


def test_nearest_of_crowded_places(spark):
    """Places meet and not their rows; pairs are those of all rows, ties and crowds among them."""
    from oreline.operators import linkage

    a = [(g, i, float(i * 7 % 23), float(i * 5 % 19 // (1 + g))) for g in (0, 1) for i in range(30 * g, 40 + 30 * g)]
    b = [(g, i, float(i * 3 % 23), float(i * 11 % 19)) for g in (0, 1) for i in range(25 * g, 60 + 25 * g)]
    near = [(g, i, j, (x - u) ** 2 + (y - v) ** 2) for g, i, x, y in a for h, j, u, v in b if g == h and (x - u) ** 2 + (y - v) ** 2 <= 16]

    def nearest(mine, other):
        out = {}
        for key in {(p[0], p[mine]) for p in near}:
            c = sorted((p[3], p[other]) for p in near if (p[0], p[mine]) == key)
            if len(c) == 1 or c[1][0] >= c[0][0] * 2.25:
                out[key] = c[0][1]
        return out

    of_a, of_b = nearest(1, 2), nearest(2, 1)
    want = {(g, i, j) for (g, i), j in of_a.items() if of_b.get((g, j)) == i}
    found = linkage.mutual_nearest(spark.createDataFrame(a, "g int, i int, x double, y double"), spark.createDataFrame(b, "g int, j int, x double, y double"), ["g"], "x", "y", "i", "j", 4.0, 1.5)
    assert {(r["g"], r["i"], r["j"]) for r in found.collect()} == want and want
    assert optimized(found).count("Aggregate [g#") == 2


def test_buffered_folds_in_columns(spark):
    """Folds against all pairs: crowded and lonely places, negative and broken coordinates, neighbours just at the buffer, a row without a place."""
    from oreline.operators import sampling

    rows = [(s, s * 1000 + i, (i * 37 % 160 - 80) / q, (i * 53 % 140 - 70) / q) for s, q, n in ((1, 1, 60), (2, 2, 150), (3, 0.25, 40)) for i in range(n)]
    rows += [(4, 4000 + i, float(i % 3 * 8), float(i // 3 * 8)) for i in range(12)] + [(4, 4100, None, 1.0)]
    got = {(r["fold"], r["k"]): r["part"] for r in sampling.buffered_folds(spark.createDataFrame(rows, "s int, k int, x double, y double"), "s", "k", "x", "y", 3, 8, "fold").collect()}
    own = {k: f for (f, k), part in got.items() if part == "val"}
    assert set(own) == {r[1] for r in rows}
    want = {}
    for s, k, x, y in rows:
        for f in range(3):
            hit = x is not None and any(own[m] == f and u is not None and abs(x - u) < 8 and abs(y - v) < 8 for t, m, u, v in rows if t == s)
            if own[k] == f or not hit:
                want[f, k] = "val" if own[k] == f else "train"
    assert got == want and {"train", "val"} == set(want.values())


@pytest.mark.parametrize("name", ["search_stemmed", "search_rrf"])
def test_searched_documents_are_dealt(name, spark, sf_dir):
    """Documents come in few files; cutting and comparing them is work for all cores, in tasks that don't grow."""
    assert optimized(registry.QUERIES[name](spark, sf_dir)).count("RepartitionByExpression [doc_id") == (1 if name == "search_stemmed" else 3)


def test_passages_of_pieces_are_those_of_the_text(spark):
    """A text is normalised once, in pieces, and passages are put together in the tasks; the same as passage by passage, also where letters
    and tags reach over a piece's end, with characters beyond 16 bits and texts of one passage."""
    import random
    import re

    from oreline.operators import search

    rng = random.Random(6)
    words = ["ten", "tenor", "nor", "the", "Ärger", "ÉTÉ", "été", "\u0130x", "42", "a", "\U0001d504b", "--", "\u6f22\u5b57", "ΑΣ", "x<b", "y>c", "\n", "  ,  "]
    text = lambda n, k: " ".join(rng.choice(words[:k]) for _ in range(n))
    rows = [(i, text(rng.choice([0, 1, 5, 40, 400]), rng.choice([5, 13, 18]))) for i in range(60)] + [(60, None), (61, ""), (62, "x" * 50), (63, "\U0001d504" * 45)]
    asked = [(i, rows[i][1][:n]) for i, n in ((1, 20), (4, 30), (7, 33), (9, 75), (12, 160), (62, 20), (63, 19))] + [(99, None), (98, "--")]

    def grams(t):
        low = re.sub("<[^>]*>", " ", t).lower()
        return {g for w in "".join(c if c.isalnum() else " " for c in low).split() for g in (f"  {w} "[j : j + 3] for j in range(len(w) + 1))}

    want = {}
    for q, t in asked:
        if t and (a := grams(t)):
            size = 20
            while size < len(t):
                size *= 2
            for d, text in rows:
                for i in range(max(0, -(-len(text or "") // (size // 2)) - 2) + 1):
                    b = grams((text or "")[i * size // 2 : i * size // 2 + size])
                    if a & b and round(len(a & b) / len(a | b), 6) >= 0.3:
                        want[q, d] = max(want.get((q, d), 0), round(len(a & b) / len(a | b), 6))
    q, d = spark.createDataFrame(asked, "q long, t string"), spark.createDataFrame(rows, "d long, t string")
    for more in ({}, {"pairs_at_once": 30}):
        got = search.passage_leg(q, d, "q", "d", "t", 0.3, least=20, **more)
        assert {(r["q"], r["d"]): r["score"] for r in got.collect()} == want and len(want) > 50
        assert "Generate" not in optimized(got)


def test_parsers_hold_objects_of_a_slice_only():
    """Of a batch only a slice's results are Python objects at a time; the rest are Arrow arrays."""
    import pyarrow as pa
    from pyspark.sql import types as T

    from oreline.functions import markup

    live, most = [0], [0]

    class Row(dict):
        def __init__(self, **of):
            super().__init__(of)
            live[0] += 1
            most[0] = max(most[0], live[0])

        def __del__(self):
            live[0] -= 1

    kind = T.ArrayType(T.StructType([T.StructField("n", T.IntegerType())]))
    parse = markup._parser(kind, lambda t: [] if t is None else [Row(n=len(t))], at_once=100).func
    assert parse(pa.array(["x" * 10] * 1000 + [None, ""])).to_pylist() == [[{"n": 10}]] * 1000 + [[], [{"n": 0}]]
    assert 0 < most[0] <= 25 and parse(pa.array([], pa.string())).to_pylist() == []


def test_titles_of_repeated_rows_and_ids(spark, tmp_path):
    """A row that comes twice has its own gram set, not twice as many; of several titles of an id each is asked."""
    rows = [(i, f"the old house of the river {'ab' * (i % 5)}\nrest {i}") for i in range(1, 40)]
    rows += rows[:9] + [(3, "nothing like it"), (60, "nothing like that"), (61, "nothing like it"), (62, None), (63, "--"), (None, "nothing like it"), (64, "zzz")]
    got = against_sql(spark, tmp_path, "trigram_pairs", documents=("doc_id long, text string", [r for r in rows if r[0] is not None]))
    assert {r["doc_id"]: r["other"] for r in got}[61] == 3 and not {62, 63, 64} & {r["doc_id"] for r in got}


def test_titles_meet_in_blocks(spark):
    """Blocks of few titles, in tasks of their own, against every pair; ids that are texts."""
    import random

    from pyspark.sql import functions as F

    from oreline.operators import linkage

    rng = random.Random(4)
    said = [" ".join(rng.choice(["ten", "tenor", "nor", "north", "or", "ore"]) for _ in range(rng.randint(1, 6))) for _ in range(150)]
    d = spark.createDataFrame([(f"k{i:03}", s, 2000 + i % 4) for i, s in enumerate(said)], "k string, t string, y int").filter("k <> 'k007'")
    grams = {f"k{i:03}": ({g for w in s.split() for g in (f"  {w} "[j : j + 3] for j in range(len(w) + 1))}, i % 4) for i, s in enumerate(said) if i != 7}
    out = linkage.similar_titles(d, d.withColumnRenamed("k", "o"), "k", "o", "t", "y", rows_a_block=4)
    want = {}
    for a, (x, y) in grams.items():
        found = [(-round(len(x & v) / len(x | v), 6), b) for b, (v, w) in grams.items() if a != b and abs(y - w) <= 1 and len(x & v) / len(x | v) >= 0.7]
        if found:
            want[a] = min(found)
    assert {r["k"]: (-r["score"], r["o"]) for r in out.collect()} == want and len(want) > 50
    assert linkage.similar_titles(d.filter(F.lit(False)), None, "k", "o", "t", "y").count() == 0


def test_titles_do_not_move_to_their_blocks(spark):
    """Blocks go to the rights: no right is dealt to the blocks it could match, however many they are. Long titles in blocks of few grams."""
    import random

    from oreline.operators import linkage

    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([30, 60, 300]))) for _ in range(12)]
    said = [(i, "".join(c for c in base[i % 12] if rng.random() > 0.02), 2000 + i % 3) for i in range(90)] + [(90 + i, "".join(chr(0x4E00 + j) for j in range(i * 40, 21_000)), 2000) for i in range(3)]
    d = spark.createDataFrame(said, "k long, t string, y int")
    grams = {k: {g for w in t.split() for g in (f"  {w} "[j : j + 3] for j in range(len(w) + 1))} for k, t, _ in said}
    want = {}
    for a, _, y in said:
        found = [(-round(len(grams[a] & grams[b]) / len(grams[a] | grams[b]), 6), b) for b, _, z in said if a != b and abs(y - z) <= 1 and len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.7]
        if found:
            want[a] = min(found)
    out = linkage.similar_titles(d, None, "k", "o", "t", "y", grams_a_block=400)
    assert {r["k"]: (-r["score"], r["o"]) for r in out.collect()} == want and len(want) > 60 and {90, 91, 92} <= set(want)
    plan = optimized(out)
    assert "RepartitionByExpression" not in plan and "g#" not in plan


def test_ratios_take_pairs_that_did_not_move(spark, sf_dir, monkeypatch):
    """The pairs whose ratios are taken come from titles that were compared as they were read, not from copies in every block."""
    from oreline.plans import records

    plans, plain_written = [], records.written
    monkeypatch.setattr(records, "written", lambda df, name: (plans.append(optimized(df)), plain_written(df, name))[1])
    registry.QUERIES["title_ratio"](spark, sf_dir)
    assert len(plans) == 1 and "MapInArrow" not in plans[0] and "block#" not in plans[0]


def test_index_searches_put_passages_together_in_the_tasks(spark, sf_dir):
    """Neither scope's texts are exploded to rows of passages that each carry the text."""
    assert "posexplode" not in optimized(registry.QUERIES["search_everything"](spark, sf_dir))


def test_matching_ratio_is_that_of_difflib():
    """Random, periodic and edited texts; a long one must not cost the square of its length."""
    import random
    import time
    from difflib import SequenceMatcher

    from oreline.functions.text import matching_ratio

    rng = random.Random(8)
    for trial in range(600):
        a = "".join(rng.choice("abc "[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 60)))
        b = "".join(x for x in a * rng.randint(1, 2) if rng.random() > 0.1) if trial % 2 else "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60)))
        assert matching_ratio(a, b) == SequenceMatcher(None, a, b, autojunk=False).ratio()
    for word, n in (("der ", 500), ("a", 900), ("et le ", 300)):
        a, b = word * n, "x".join((word * (n // 2), word * (n // 3), "et"))
        assert matching_ratio(a, b) == SequenceMatcher(None, a, b, autojunk=False).ratio()
    a = "".join(rng.choice("abcdefghij ") for _ in range(20_000))
    b = "".join(x for x in a if rng.random() > 0.01)
    start = time.process_time()
    assert matching_ratio(a, b) > 0.98 and time.process_time() - start < 5  # difflib takes more than ten times as long


def test_suffix_ranks_are_sorted_as_numbers():
    """Numbers that fit 64 bits with their places are sorted as one, others by their places: the same order."""
    import numpy as np

    from oreline.llm.suffixes import _sorted

    rng = np.random.default_rng(3)
    for top in (1, 5, 1 << 40, 1 << 61):
        for n in (0, 1, 2, 700):
            key = rng.integers(0, top, n)
            order = _sorted(key)
            assert sorted(order.tolist()) == list(range(n)) and (np.diff(key[order]) >= 0).all()
