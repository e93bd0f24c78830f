"""Labels, logs, liveness, eviction, folds, latent classes, polygons and tiles against loops that do the same one by one."""

import datetime as dt
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.operators import caches, imagery, labels, linkage, logs, polygons, sampling, stats, telemetry
from oreline.streaming import streams


def test_standing_labels_follow_each_undo(spark):
    rng = random.Random(1)
    rows = [(i, n, rng.choice(["a", "b", "c", "undo", "undo"])) for i in range(40) for n in range(rng.randrange(0, 14))] + [(99, 1, "undo"), (98, 1, "undo"), (98, 2, "a"), (98, 3, "b"), (98, 4, "undo"), (98, 5, "undo"), (98, 6, "undo"), (98, 7, "c")]
    stacks, last = {}, {}
    for i, _, x in sorted(rows):
        s = stacks.setdefault(i, [])
        if x != "undo":
            s.append(x)
        elif s:
            s.pop()
        last[i] = x
    df = spark.createDataFrame(rows, "i int, n int, label string").repartition(3)
    assert {tuple(r) for r in labels.standing(df, "i", "n", "label", restore=True).collect()} == {(i, s[-1]) for i, s in stacks.items() if s}
    assert {tuple(r) for r in labels.standing(df, "i", "n", "label").collect()} == {(i, x) for i, x in last.items() if x != "undo"}


def test_overrides_and_paired_change(spark):
    given = spark.createDataFrame([(1, "gain"), (2, "loss"), (3, "unsure"), (4, "gain"), (5, "nochange"), (6, "gain"), (7, "nochange")], "point_id int, label string")
    second = spark.createDataFrame([(2, "nochange"), (1, "gain"), (8, "loss")], "point_id int, label string")
    held = labels.overridden(given, second, "point_id", "label")
    assert {(r["point_id"], r["label"], r["overturned"]) for r in held.collect()} >= {(2, "nochange", True), (1, "gain", False), (8, "loss", False), (3, "unsure", False)}
    points = [(1, "live", None, 2, False, None), (2, "live", None, 2, False, None), (3, "live", None, 3, False, None), (4, "dup", 1, 2, False, None), (5, "dup", 1, 2, False, None), (6, "blur", None, 2, False, None), (7, "live", None, 9, True, 3), (8, "live", None, 9, True, 3)]
    p = spark.createDataFrame(points, "point_id int, kind string, dup_of int, stratum int, floor boolean, overlap int")
    strata = spark.createDataFrame([(2, 60), (3, 40)], "stratum int, cells int")
    r = labels.paired_change(held, p, strata, F.lit(100)).first()
    spread = 0.36 * 0.5 / 2 + 0.16 * 0.5 / 2  # (1, 0) in stratum 2, (0, -1) in stratum 3
    assert (r["net"], r["half_width"]) == (round(0.6 * 0.5 - 0.4 * 0.5, 6), round(1.96 * math.sqrt(spread), 6))
    assert (r["n_live"], r["n_overturned"], r["n_blur"], r["blur_changed"], r["n_outside"], r["outside_changed"], r["n_unsure"], r["n_dup"], r["dup_disagree"]) == (5, 1, 1, 1, 2, 1, 1, 2, 1)


def sequential_log(lines):
    """(events, notes): the same machine, line by line."""
    queue, job, block, events, notes = "", ("", "", ""), None, [], []
    flag = lambda c, f: (re.search(rf"--{f}[= ](\S+)", c) or ["", ""])[1]

    def shut():
        if block and not block["ended"]:
            notes.append((block["n"], "block_without_outcome", block["c"]))

    for n, line in lines:
        hit = {k: m for k, p in logs.KINDS if (m := re.match(p, line))}
        if m := hit.get("queue"):
            queue = m[1]
        elif m := hit.get("job"):
            shut()
            job, block = m.groups(), None
        elif m := hit.get("command"):
            shut()
            block = {"n": n, "c": m[1], "ended": False, "logs": 0, "run": ""}
        elif (m := hit.get("step_log")) and block:
            block["logs"] += 1
        elif (m := hit.get("run_id")) and block:
            block["run"] = block["run"] or m[1]
        elif m := hit.get("skip") or hit.get("reverify"):
            notes.append((n, "resume_skip" if "skip" in hit else "reverify_of_skipped_step", f"{m[1]}/{m[2]}"))
        elif kind := next((k for k in ("exit", "timeout", "interrupt") if k in hit), None):
            if not block:
                notes.append((n, "outcome_without_block", line.strip()))
                continue
            block["ended"] = True
            m = hit[kind]
            state = {"exit": "OK" if kind == "exit" and m[3] == "0" else "FAIL", "timeout": "TIMEOUT", "interrupt": "INTERRUPTED"}[kind]
            events.append((n, "step", queue, m[1], m[2], state, flag(block["c"], "year"), flag(block["c"], "run-tag"), "", block, job[0]))
        elif m := hit.get("verify"):
            head, _, tail = m[3].partition(logs.UNPROVEN if logs.UNPROVEN in m[3] else "  ")
            if re.match(logs.STATE, head.strip()):
                events.append((n, "verify", queue, m[2], "VERIFY" + (f":{m[1]}" if m[1] else ""), head.strip(), job[1], job[2], tail.strip(), block, job[0]))
            else:
                notes.append((n, "verify_unparseable", line.strip()))
    shut()
    return sorted((*e[:9], e[9] and e[9]["n"], e[9]["run"] if e[9] else "", e[9]["logs"] if e[9] else 0, e[10]) for e in events), sorted(notes)


@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_queue_log_equals_the_sequential_machine(spark, chunk):
    rng = random.Random(5)
    kinds = [
        "  queue  : q{r}.json", "  JOB j{r}_2015  (year 2015, tag t{r})", "  $ python -u e.py --year 20{r} --step train --run-tag=t{r}", "  $ ls -l", "    |  ✓ log → /content/logs/a{r}.log", "    |  run_id: 2024{r}", "  [j{r}/train] exit=0  elapsed {r}.5 min",
        "  [j/x/tile] exit={r}  elapsed 3 min  ", "  ! TIMEOUT: j/train exceeded 90 min", "  ! j/t got a stray interrupt after 2.5 min", "  - skip j/t (already OK)", "  - j/t was left UNVERIFIED, again", "  VERIFY j: VERIFIED  {r} files,  all", "  VERIFY:tile j: UNREADABLE" + logs.UNPROVEN + "  no header",
        "  VERIFY j: odd words", "  VERIFY j: ALONE", "noise {r}", "", "  JOB without year", "  ! TIMEOUT: broken",
    ]
    rows = [(log, n, rng.choice(kinds).format(r=rng.randrange(3))) for log, size in (("a", 60), ("b", 1), ("c", 23), ("d", 200)) for n in range(1, size + 1)]
    events, notes = logs.queue_log(spark.createDataFrame(rows, "file string, no int, said string").repartition(4), "file", "no", "said", chunk)
    got_events, got_notes = events.collect(), notes.collect()
    for log in "abcd":
        want_events, want_notes = sequential_log([(n, x) for f, n, x in rows if f == log])
        mine = sorted((r["line"], r["kind"], r["queue"], r["job"], r["step"], r["state"], r["year"], r["tag"], r["verdict"], r["block_line"], r["run_id"], r["n_step_logs"], r["header_job"]) for r in got_events if r["log"] == log)
        assert mine == want_events and sorted((r["line"], r["kind"], r["detail"]) for r in got_notes if r["log"] == log) == want_notes


def test_silences_stream_and_batch_agree(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    at = lambda minutes: start + dt.timedelta(minutes=minutes)
    beats = {"a": [0, 5, 9, 60, 61], "b": [1, 100, 220], "c": [2], "clock": list(range(0, 400, 10)), "late": [3, 8, 8, 150]}
    for batch, (low, high) in enumerate([(0, 50), (50, 130), (130, 400)]):
        rows = [(k, at(m), 1.0) for k, ms in beats.items() for m in ms if low <= m < high]
        spark.createDataFrame(rows, "host string, ts timestamp, v double").coalesce(1).write.parquet(f"{tmp_path}/in/b{batch}")
    stream = streams.read_stream(spark, f"{tmp_path}/in/*", "host string, ts timestamp, v double", files_a_batch=1)
    got = streams.settled(streams.silences(stream, "host", "ts", 20 * 60, "5 minutes"), "silences")
    everything = spark.read.parquet(f"{tmp_path}/in/*")
    batch = telemetry.silences(everything, "host", "ts", 20 * 60, F.lit(at(390 - 5)))
    rows = lambda d: sorted((r["host"], r["action"], r["at"]) for r in d.collect())
    assert rows(got) == rows(batch)
    mine = [(a, t) for h, a, t in rows(got) if h == "a"]
    assert sorted(mine, key=lambda x: x[1]) == [("up", at(0)), ("silent", at(29)), ("up", at(60)), ("silent", at(81))]  # once each, and revived
    assert [a for h, a, _ in rows(got) if h == "clock"] == ["up"]


def test_eviction_takes_what_the_loop_would(spark):
    rng = random.Random(2)
    rows = [(f"k{i}", rng.random() < 0.8, rng.random() < 0.2, rng.choice([None, -5, 0, 10, 50, 400]), rng.choice([None, 1.0, 2.0, 3.0]), rng.choice([None, 1.0, 7.0])) for i in range(120)]
    df = spark.createDataFrame(rows, "key string, ready boolean, pinned boolean, bytes long, last_use double, ts_ready double").repartition(5)
    for free, floor, need in ((0, 100, 1000), (5000, 100, 10), (50, 2000, 10_000), (0, 9000, 6000), (0, 10, 10**9), (100, 0, 0)):
        cold = sorted((u or 0, t or 0, k, max(0, b or 0)) for k, ready, pinned, b, u, t in rows if ready and not pinned and k != "k7")
        reach = free + sum(x[3] for x in cold)
        target = next((t for t in (floor + int(need * 1.15), max(floor, need), need) if reach >= t), None)
        want, room = [], free
        if target is not None and free < floor + int(need * 1.15):
            for _, _, k, b in cold:
                if room >= target:
                    break
                want.append(k)
                room += b
        assert sorted(r["key"] for r in caches.evicted(df, free, floor, need, keep_key="k7").collect()) == sorted(want)


def test_buffered_folds_by_all_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.choice("AAAB"), i, rng.randrange(-40, 300), rng.randrange(-40, 300)) for i in range(250)] + [("C", 900, 5, 5), ("A", 901, 10, 10), ("A", 902, 10, 10)]
    df = spark.createDataFrame(rows, "site string, id int, x int, y int").repartition(4)
    got = {(r["fold"], r["id"]): r["part"] for r in sampling.buffered_folds(df, "site", "id", "x", "y", 4, 32, "s").collect()}
    own = {i: f for (f, i), part in got.items() if part == "val"}
    assert len(own) == len(rows)
    for site in "ABC":
        sizes = [sum(own[i] == f for s, i, _, _ in rows if s == site) for f in range(4)]
        assert max(sizes) - min(sizes) <= 1
    for f in range(4):
        for s, i, x, y in rows:
            near = any(s == t and own[j] == f and max(abs(x - v), abs(y - w)) < 32 for t, j, v, w in rows)
            assert got.get((f, i)) == ("val" if own[i] == f else None if near else "train")


def test_replicates_are_fitted_as_if_alone(spark):
    rng = np.random.default_rng(4)
    x = np.array([[(i >> (2 - j)) & 1 for j in range(3)] for i in range(8)], float)
    w = rng.integers(5, 400, (6, 8)).astype(float)
    starts = lambda n: [(np.full(n, 0.35), np.tile([[0.2] * 3, [0.8] * 3], (n, 1, 1)).astype(float)), (np.full(n, 0.6), np.tile([[0.3] * 3, [0.9] * 3], (n, 1, 1)).astype(float))]
    together = stats._fitted(x, w, starts(6), 400, 1e-10)
    for i in range(6):
        for a, b in zip(together, stats._fitted(x, w[i : i + 1], starts(1), 400, 1e-10)):
            assert np.allclose(a[i], b[0], atol=1e-12)
    rows = []
    for block in range(30):
        for _ in range(60):
            truth = rng.random() < 0.3
            rows.append((block, *(int(truth != (rng.random() < e)) for e in (0.1, 0.2, 0.15)), 1))
    df = spark.createDataFrame(rows, "b int, u int, v int, w int, n long")
    got = {r["measure"]: r for r in stats.latent_class_bootstrap(df, "b", 30, ["u", "v", "w"], "n", 60).collect()}
    assert all(r["low"] <= r["estimate"] <= r["high"] and r["replicates"] >= 50 for r in got.values())
    assert abs(got["prevalence"]["estimate"] - 0.3) < 0.06 and abs(got["sensitivity_u"]["estimate"] - 0.9) < 0.08
    # the same replicates, a fit each
    wide = df.groupBy("b").agg(*(F.sum(F.when(F.col("u") * 4 + F.col("v") * 2 + F.col("w") == i, 1).otherwise(0)).cast("double").alias(f"p{i}") for i in range(8)))
    drawn = stats.block_bootstrap(wide, "b", 30, [f"p{i}" for i in range(8)], 60).collect()
    alone = []
    for r in drawn:
        counts = spark.createDataFrame([(*map(int, x[i]), int(r[f"p{i}"])) for i in range(8)], "u int, v int, w int, n long") if len(alone) < 3 else None
        if counts is not None:
            alone.append((r, {q["source"]: q for q in stats.latent_classes(counts, ["u", "v", "w"], rounds=1500).collect()}))
    for r, one in alone:
        pi, se, sp = stats._fitted(x, np.array([[r[f"p{i}"] for i in range(8)]]), starts(1), 3000, 1e-11)
        assert abs(pi[0] - one["u"]["prevalence"]) < 2e-3 and abs(se[0, 0] - one["u"]["sensitivity"]) < 2e-3 and abs(sp[0, 2] - one["w"]["specificity"]) < 2e-3


def clipped_area(a, b):
    """Area shared by two convex outlines: a clipped by each side of b."""
    area2 = lambda p: sum(p[i - 1][0] * p[i][1] - p[i][0] * p[i - 1][1] for i in range(len(p)))
    a, b = (list(map(tuple, p if area2(p) > 0 else p[::-1])) for p in (a, b))
    for i in range(len(b)):
        (x1, y1), (x2, y2) = b[i - 1], b[i]
        side = lambda p: (x2 - x1) * (p[1] - y1) - (y2 - y1) * (p[0] - x1)  # noqa: B023, E731
        out = []
        for j in range(len(a)):
            p, q = a[j - 1], a[j]
            s, t = side(p), side(q)
            if (s < 0) != (t < 0):
                u = s / (s - t)
                out.append((p[0] + u * (q[0] - p[0]), p[1] + u * (q[1] - p[1])))
            if t >= 0:
                out.append(q)
        a = out
        if len(a) < 3:
            return 0.0
    return abs(area2(a)) / 2


def holed_area(a, b):
    hole = lambda p, q: clipped_area(p[0], q) - sum(clipped_area(h, q) for h in p[1:])
    return hole(a, b[0]) - sum(hole(a, h) for h in b[1:])


def test_overlap_areas():
    rng = random.Random(6)
    for _ in range(60):
        def polygon():
            n, x, y, r = rng.randrange(3, 9), rng.uniform(0, 4), rng.uniform(0, 4), rng.uniform(0.5, 3)
            angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
            ring = [[x + r * math.cos(t), y + r * math.sin(t)] for t in angles]
            return [ring]
        a, b = polygon(), polygon()
        assert abs(polygons.overlap_area(a, b) - clipped_area(a[0], b[0])) < 1e-9
    square = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s]]
    frame, other = [square(0, 0, 10), square(2, 2, 3)], [square(1, 1, 6), square(3, 3, 1)]
    assert abs(polygons.overlap_area(frame, frame) - 91) < 1e-9 and abs(polygons.overlap_area(frame, other) - (36 - 9)) < 1e-9
    star = [[[math.cos(math.pi * k / 5) * (1 if k % 2 else 3) + 5, math.sin(math.pi * k / 5) * (1 if k % 2 else 3) + 5] for k in range(10)]]
    inside = lambda ring, x, y: sum((ring[i - 1][1] > y) != (ring[i][1] > y) and x < (ring[i][0] - ring[i - 1][0]) * (y - ring[i - 1][1]) / (ring[i][1] - ring[i - 1][1]) + ring[i - 1][0] for i in range(len(ring))) % 2
    step = 0.02
    grid = sum(inside(star[0], x, y) and inside(frame[0], x, y) and not inside(frame[1], x, y) for x in np.arange(step / 2, 10, step) for y in np.arange(step / 2, 10, step)) * step * step
    assert abs(polygons.overlap_area(star, frame) - grid) < 0.05
    assert polygons.overlap_area([], frame) == polygons.overlap_area([square(20, 20, 1)], frame) == polygons.overlap_area([[[1, 1], [1, 5]]], frame) == 0.0


def test_polygon_pairs_and_ordered_matches(spark):
    rng = random.Random(7)
    square = lambda x, y, s: [[[x, y], [x + s, y], [x + s, y + s], [x, y + s]]]
    make = lambda n: [(rng.choice("PQ"), i, square(rng.uniform(-9, 9), rng.uniform(-9, 9), rng.uniform(1, 4))) for i in range(n)]
    left, right = make(60), make(50)
    schema = "page string, {} int, rings array<array<array<double>>>"
    a, b = spark.createDataFrame([*left, ("P", 990, None)], schema.format("p")), spark.createDataFrame(right, schema.format("q"))
    got = {(r["p"], r["q"]): r["iou"] for r in polygons.overlaps(a, b, "page", "p", "q", "rings", 2.5).collect()}
    want = {}
    for g, i, x in left:
        for h, j, y in right:
            shared = clipped_area(x[0], y[0])
            if g == h and shared > 0:
                want[i, j] = shared / (clipped_area(x[0], x[0]) + clipped_area(y[0], y[0]) - shared)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    matches = linkage.ordered_match(polygons.overlaps(a, b, "page", "p", "q", "rings", 2.5), "page", "p", "q", "iou", 0.1)
    taken, serial = set(), set()
    for i in sorted(i for _, i, _ in left):
        free = sorted((-want[i, j], j) for k, j in want if k == i and j not in taken and want[i, j] >= 0.1)
        if free:
            taken.add(free[0][1])
            serial.add((i, free[0][1]))
    assert {(r["p"], r["q"]) for r in matches.collect()} == serial


def test_phase_correlation_finds_planted_shifts():
    rng = np.random.default_rng(8)
    field = rng.normal(size=(200, 200))
    spectrum = np.fft.fft2(field) / (1 + np.hypot(*np.meshgrid(np.fft.fftfreq(200), np.fft.fftfreq(200))) * 20)
    for dx, dy in ((0, 0), (3, -5), (-7, 2), (2.5, 0.0), (0.0, -1.5)):
        moved = np.real(np.fft.ifft2(spectrum * np.exp(-2j * np.pi * (np.fft.fftfreq(200)[None, :] * dx + np.fft.fftfreq(200)[:, None] * dy))))
        still = np.real(np.fft.ifft2(spectrum))
        got = imagery.shift_between(moved[50:114, 50:114], still[50:114, 50:114])
        assert abs(got[0] - dx) < 0.4 and abs(got[1] - dy) < 0.4 and got[2] > 3


def test_edge_spread_recovers_planted_blur():
    y, x = np.mgrid[0:96, 0:96]
    widths = []
    for angle in (0.0, 0.5, 1.2, 2.0):
        for scale in (0.7, 1.0, 1.3):
            edge = 60 + 120 / (1 + np.exp(-((x - 47) * math.cos(angle) + (y - 47) * math.sin(angle)) / scale))
            rise = imagery.rise_distance(*imagery.edge_profile(edge))
            assert abs(rise - 2 * math.log(9) * scale) < 1.0  # profiles are read at whole pixels
            widths.append(rise)
    assert imagery.edge_profile(np.full((64, 64), 7.0)) is None and imagery.edge_profile(np.zeros((10, 10))) is None
    assert imagery.rise_distance(np.arange(-6, 6.25, 0.25), np.zeros(49)) is None
