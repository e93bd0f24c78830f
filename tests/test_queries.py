"""Every registered query outside the training-data subpackage against its SQL on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from oreline.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def check_html_blocks(rows, tables):
    """Every block's words stand in the page in that order, without tags; no block is empty or repeats the one before."""
    import re
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in tables("pages")}
    seen = {}
    for r in sorted(rows, key=lambda r: (r["page_id"], r["pos"])):
        flat = " ".join(unescape(re.sub(r"<[^>]*>", " ", pages[r["page_id"]])).split())
        assert r["text"] and all(w in flat for w in r["text"].split()) and r["text"] != seen.get(r["page_id"])
        assert (r["kind"] == "heading") == (r["level"] > 0)
        seen[r["page_id"]] = r["text"]
    assert set(seen) == set(pages)
    held = {}
    for r in rows:
        held.setdefault(r["page_id"], []).append(" ".join(r["text"].split()))
    for page, html in pages.items():  # paragraphs of the text itself, outside of navigation and the like, are all there
        body = re.sub(r"(?s)<(script|style|nav|header|footer|aside|form|table|ul|ol)\b.*?</\1>", " ", html)
        for p in re.findall(r"(?s)<p\b[^>]*>(.*?)</p>", body):
            words = " ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split())
            assert len(words) < 40 or any(words[:30] in t or t[:30] in words for t in held[page]), (page, words)


def check_document_units(rows, tables):
    """Rows of tables and repeated tails, counted line by line and letter by letter."""
    texts = {r["doc_id"]: r["text"] for r in tables("documents")}
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        tail = next(((n, t[-n:]) for n in range(1, 61) if len(t) >= 4 * n and t.endswith(t[-n:] * 4)), None)
        assert (r["tail"]["unit"] if r["tail"] else None) == (tail[1] if tail else None)
        assert r["n_units"] >= r["n_rows"] >= 0 and 0 <= r["density"] <= 1 and (r["n_sentences"] > 0) == bool(t.strip())


def check_title_ratio(rows, tables):
    """Titles are first lines; a pair's ratio is that of the matching blocks of their normalised forms, and decides with the years."""
    import re
    from difflib import SequenceMatcher

    titles = {r["doc_id"]: " ".join(re.sub(r"[\W_]+", " ", r["text"].split("\n")[0].lower()).split()) for r in tables("documents")}
    for r in rows:
        want = SequenceMatcher(None, titles[r["doc_id"]], titles[r["other"]], autojunk=False).ratio()
        assert abs(r["ratio"] - want) < 1e-6 and (r["note"] == "title") == (r["ratio"] < 0.85) and r["accepted"] == (r["note"] == "accepted")


def check_latent_class(rows, tables):
    """A stationary point of the likelihood reproduces the observed share of each indicator; the second class is the one that they find."""
    docs = {r["doc_id"]: r["n_chars"] for r in tables("documents")}
    seen = [(int(docs[r["doc_id"]] > 1500), r["quality"], 1 - r["toxic"]) for r in tables("labels") if r["doc_id"] in docs]
    by = {r["source"]: r for r in rows}
    assert len(rows) == 3 and sum(r["youden"] for r in rows) >= 0
    for i, name in enumerate(("long", "good", "clean")):
        r = by[name]
        assert abs(r["prevalence"] * r["sensitivity"] + (1 - r["prevalence"]) * (1 - r["specificity"]) - sum(x[i] for x in seen) / len(seen)) < 1e-3


def check_latent_class_intervals(rows, tables):
    """The point estimate is that of the planted sources' errors, inside its interval."""
    lines = [(r["l_partkey"] % 10 < 4, r["l_suppkey"] % 5 == 0, r["l_orderkey"] % 7 == 0, r["l_quantity"] % 6 == 0) for r in tables("lineitem")]
    by = {r["measure"]: r for r in rows}
    assert len(rows) == 7 and all(r["replicates"] >= 90 and r["low"] <= r["estimate"] <= r["high"] for r in rows)
    assert abs(by["prevalence"]["estimate"] - sum(x[0] for x in lines) / len(lines)) < 0.05
    for i, name in enumerate(("by_supplier", "by_order", "by_quantity"), 1):
        inside, outside = [x for x in lines if x[0]], [x for x in lines if not x[0]]
        assert abs(by[f"sensitivity_{name}"]["estimate"] - sum(not x[i] for x in inside) / len(inside)) < 0.05
        assert abs(by[f"specificity_{name}"]["estimate"] - sum(not x[i] for x in outside) / len(outside)) < 0.05


def check_crown_matches(rows, tables):
    """Every odd crown in its turn takes the free even one that it shares most with; areas by clipping convex outlines."""
    from test_instruments import holed_area

    shapes = {}
    for r in sorted(tables("lineitem"), key=lambda r: (r["l_partkey"], r["l_suppkey"], r["l_quantity"]), reverse=True):  # of equal keys the least
        key, radius = r["l_orderkey"] * 10 + r["l_linenumber"], 0.5 + r["l_quantity"] / 25
        x, y = r["l_partkey"] * 7 % 400 / 10, r["l_suppkey"] * 11 % 300 / 10
        ring = [[x + radius * a, y + radius * b] for a, b in ((1.0, 0.4), (0.4, 1.0), (-0.4, 1.0), (-1.0, 0.4), (-1.0, -0.4), (-0.4, -1.0), (0.4, -1.0), (1.0, -0.4))]
        hole = [[x + radius * a, y + radius * b] for a, b in ((0.3, 0.3), (-0.3, 0.3), (-0.3, -0.3), (0.3, -0.3))]
        shapes[key] = (r["l_orderkey"] % 50, x, y, radius, [ring, hole] if r["l_linenumber"] % 3 == 0 else [ring])
    want = {}
    for sheet in range(50):
        here = sorted(k for k, v in shapes.items() if v[0] == sheet)
        free = {k for k in here if k % 2 == 0}
        for k in (k for k in here if k % 2):
            _, x, y, r, p = shapes[k]
            best = (0.0, 0)
            for j in sorted(free):
                _, u, v, s, q = shapes[j]
                if abs(x - u) < r + s and abs(y - v) < r + s:
                    shared = holed_area(p, q)
                    iou = shared / (holed_area(p, p) + holed_area(q, q) - shared)
                    iou = round(iou, 9)
                    if iou > best[0]:
                        best = (iou, j)
            if best[0] >= 0.3:
                want[k] = best[1]
                free.remove(best[1])
    assert {r["found"]: r["truth"] for r in rows} == want


def check_loss_hotspots(rows, tables):
    """Components of lost cells by a walk over neighbours."""
    from collections import defaultdict

    total = defaultdict(int)
    for r in tables("lineitem"):
        total[r["l_orderkey"] % 3750] += r["l_partkey"]
    value = {(o % 6, o // 6 % 25, o // 150): 255 if v % 11 == 0 else v % 100 for o, v in total.items()}
    at = lambda g, c: value.get((g, *c), 255)
    cells = {(i, j) for _, i, j in value}
    lost = {c for c in cells if all(at(g, c) != 255 for g in (0, 1, 2)) and at(0, c) >= 50 and at(1, c) < 50 and at(2, c) < 50}
    sizes = []
    while lost:
        todo, n = [lost.pop()], 0
        while todo:
            i, j = todo.pop()
            n += 1
            near = {(i + a, j + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & lost
            lost -= near
            todo += near
        sizes.append(n)
    assert sorted(r["cells"] for r in rows) == sorted(n for n in sizes if n > 1)
    assert [r["cells"] for r in sorted(rows, key=lambda r: r["place"])] == sorted((r["cells"] for r in rows), reverse=True)


def check_nation_clusters(rows, tables):
    """No merge that was made joins clusters farther apart than one that was left."""
    by = {}
    for r in tables("customer"):
        by.setdefault(r["c_nationkey"], []).append(r["c_acctbal"])
    points = {k: (sum(v) / len(v), float(len(v))) for k, v in by.items()}
    n = len(points)
    mean = [sum(p[i] for p in points.values()) / n for i in (0, 1)]
    sd = [(sum((p[i] - mean[i]) ** 2 for p in points.values()) / n) ** 0.5 or 1.0 for i in (0, 1)]
    z = {k: [(p[i] - mean[i]) / sd[i] for i in (0, 1)] for k, p in points.items()}
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(z[a], z[b])) ** 0.5
    groups = {}
    for r in rows:
        groups.setdefault(r["cluster"], []).append(r["c_nationkey"])
    assert len(groups) == 4 and sorted(k for g in groups.values() for k in g) == sorted(points)
    widest = max(d(a, b) for g in groups.values() for a in g for b in g)
    apart = min(max(d(a, b) for a in g for b in h) for i, g in groups.items() for j, h in groups.items() if i < j)
    assert widest <= apart + 1e-9


#: What tests the queries that SQL can't express: each is named here, or the test below fails.
BRUTE = {f.__name__.removeprefix("check_"): f for f in (check_html_blocks, check_document_units, check_title_ratio, check_latent_class, check_latent_class_intervals, check_crown_matches, check_loss_hotspots, check_nation_clusters)}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, sf_dir, con):
    df = registry.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = df.collect()
    if name not in registry.ORACLE:
        BRUTE[name](got, lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet").collect())
        return
    rows = Counter(tuple(plain(r[c]) for c in cols) for r in got)
    other = con.sql(registry.ORACLE[name])
    assert sorted(other.columns) == cols
    at = [other.columns.index(c) for c in cols]
    assert rows == Counter(tuple(plain(r[i]) for i in at) for r in other.fetchall())
