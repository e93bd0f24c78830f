"""Polygons with holes: exact areas of overlap, the pairs that overlap at all by an equi-join on cells of their bounds, and ordered matches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rings = list[list[list[float]]]  # the outline and its holes, each a list of (x, y)


def edges(rings: Rings) -> np.ndarray:
    """(x1, y1, x2, y2) with x1 < x2 of all sides; upright ones bound no area between two x."""
    out = [np.hstack([r, np.roll(r, -1, axis=0)]) for r in (np.asarray(ring, float) for ring in rings) if len(r) > 2]
    e = np.concatenate(out) if out else np.zeros((0, 4))
    e = e[e[:, 0] != e[:, 2]]
    return np.where((e[:, 0] > e[:, 2])[:, None], e[:, [2, 3, 0, 1]], e)


def _stacked(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sides of many polygons, one behind the other, as (polygon, side, 4); where a polygon has fewer than most NaN stands."""
    out = np.full((len(sizes), max(1, int(sizes.max(initial=0))), 4), np.nan)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _spans(e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """(polygon, line, span, 2): where upright lines at ``x`` are inside, by parity; spans that aren't there are infinite."""
    x1, y1, x2, y2 = (e[:, None, :, i] for i in range(4))
    at = x[:, :, None]
    y = np.sort(np.where((x1 < at) & (at < x2), y1 + (at - x1) * ((y2 - y1) / (x2 - x1)), np.inf), axis=2)
    most = int(np.isfinite(y).sum(axis=2).max(initial=0))
    return y[:, :, : most - most % 2].reshape(*x.shape, -1, 2)


def overlap_areas(ea: np.ndarray, eb: np.ndarray) -> np.ndarray:
    """Area that lies in both polygons of each pair, holes left out; sides as ``_stacked`` gives them.

    Between two neighbouring corners or crossings the shared length of an upright line is linear, so its middle value times the width is
    exact."""
    out = np.zeros(len(ea))
    with np.errstate(all="ignore"):
        ends = [np.fmin.reduce(e[:, :, 0], axis=1, initial=np.inf) for e in (ea, eb)], [np.fmax.reduce(e[:, :, 2], axis=1, initial=-np.inf) for e in (ea, eb)]
        low, high = np.maximum(*ends[0]), np.minimum(*ends[1])
        meet = np.flatnonzero(low < high)
        if not len(meet):
            return out
        ea, eb, low, high = ea[meet], eb[meet], low[meet, None], high[meet, None]
        both = np.concatenate([ea, eb], axis=1)
        slope = (both[:, :, 3] - both[:, :, 1]) / (both[:, :, 2] - both[:, :, 0])
        shift = both[:, :, 1] - slope * both[:, :, 0]
        i, j = np.triu_indices(both.shape[1], 1)
        cross = (shift[:, j] - shift[:, i]) / (slope[:, i] - slope[:, j])
        on = (cross > np.maximum(both[:, i, 0], both[:, j, 0])) & (cross < np.minimum(both[:, i, 2], both[:, j, 2]))
        x = np.concatenate([both[:, :, 0], both[:, :, 2], np.where(on, cross, np.nan)], axis=1)
        x = np.sort(np.where((x >= low) & (x <= high), x, np.inf), axis=1)
        x = x[:, : int(np.isfinite(x).sum(axis=1).max())]
        width = np.diff(x, axis=1)
        width[~np.isfinite(width)] = 0.0
        middle = np.where(width > 0, (x[:, 1:] + x[:, :-1]) / 2, np.nan)
        a, b = _spans(ea, middle), _spans(eb, middle)
        length = np.zeros(middle.shape)
        for k in range(a.shape[2]):
            for m in range(b.shape[2]):
                shared = np.minimum(a[:, :, k, 1], b[:, :, m, 1]) - np.maximum(a[:, :, k, 0], b[:, :, m, 0])
                length += np.where(shared > 0, shared, 0.0)
        out[meet] = (length * width).sum(axis=1)
    return out


def overlap_area(a: Rings, b: Rings) -> float:
    """Area that lies in both polygons, holes left out."""
    return float(overlap_areas(edges(a)[None], edges(b)[None])[0])


def bounds(rings: Column) -> Column:
    """struct(x1, y1, x2, y2) of the outline."""
    of = lambda f, i: f(F.transform(rings[0], lambda p: p[i]))
    return F.struct(of(F.array_min, 0).alias("x1"), of(F.array_min, 1).alias("y1"), of(F.array_max, 0).alias("x2"), of(F.array_max, 1).alias("y2"))


def _sides(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sides of all polygons of a column of flat lists, and how many each has."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4), np.diff(column.offsets.to_numpy()) // 4


def _flat(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The sides of a column of rings as flat lists, and the areas."""
    sides = [edges(r) for r in column.to_pylist()]
    sizes = np.array([len(e) for e in sides], np.int64)
    flat = np.concatenate([*sides, np.zeros((0, 4))])
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes * 4)]).astype(np.int32))
    stacked = _stacked(flat, sizes)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.ravel())), overlap_areas(stacked, stacked)


def overlaps(a: DataFrame, b: DataFrame, group: str, a_id: str, b_id: str, rings: str, cell: float, floor: float = 0.0, at_once: int = 2000) -> DataFrame:
    """(group, a_id, b_id, shared, iou) of the polygons of a and b of one group that share some area, and ``floor`` of their union.

    Candidates share a cell of their bounds; of the cells that a pair shares only the lowest left one counts, so none comes twice.
    Sides and areas are worked out once a polygon; the shared area is at most that of the bounds and of the smaller polygon, so pairs
    that can't reach ``floor`` aren't measured, and those that are go ``at_once`` through whole arrays. Rows with a null group, id or
    outline match nothing."""

    def flattened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, at_once):
                part = batch.slice(i, at_once)
                sides, area = _flat(part["_rings"])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], sides, pa.array(area)], [*part.schema.names[:-1], "s", "area"])

    def celled(d: DataFrame, key: str, x: str) -> DataFrame:
        at = lambda c: F.floor(F.col(f"{x}_{c}") / cell)
        d = d.filter(F.col(rings).isNotNull() & F.col(key).isNotNull()).withColumn("_box", bounds(F.col(rings)))
        d = d.select(group, key, *(F.col(f"_box.{c}").alias(c) for c in ("x1", "y1", "x2", "y2")), F.col(rings).alias("_rings"))
        kinds = dict(d.dtypes)
        d = d.mapInArrow(flattened, f"`{group}` {kinds[group]}, `{key}` {kinds[key]}, x1 double, y1 double, x2 double, y2 double, s array<double>, area double")
        d = d.withColumnsRenamed({c: f"{x}_{c}" for c in ("x1", "y1", "x2", "y2", "s", "area")})
        return d.withColumn("_i", F.explode(F.sequence(at("x1"), at("x2")))).withColumn("_j", F.explode(F.sequence(at("y1"), at("y2"))))

    low, high = (lambda c: F.greatest(f"a_{c}", f"b_{c}")), (lambda c: F.least(f"a_{c}", f"b_{c}"))
    wide, tall = high("x2") - low("x1"), high("y2") - low("y1")
    first = (F.col("_i") == F.floor(low("x1") / cell)) & (F.col("_j") == F.floor(low("y1") / cell))
    most = F.least(wide * tall, F.col("a_area"), F.col("b_area")) * (1 + 1e-9)
    reaches = most * (1 + floor) >= floor * (F.col("a_area") + F.col("b_area"))
    tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), a.sparkSession.sparkContext.defaultParallelism)  # small rows, long work: none are joined up
    dealt = lambda d: d.repartition(tasks, group, "_i", "_j")
    pairs = dealt(celled(a, a_id, "a")).join(dealt(celled(b, b_id, "b")), [group, "_i", "_j"]).filter((wide > 0) & (tall > 0) & first & reaches)
    pairs = pairs.select(group, a_id, b_id, "a_s", "a_area", "b_s", "b_area")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, at_once):
                part = batch.slice(i, at_once)
                shared = overlap_areas(_stacked(*_sides(part["a_s"])), _stacked(*_sides(part["b_s"])))
                whole = part["a_area"].to_numpy() + part["b_area"].to_numpy() - shared
                iou = np.divide(shared, whole, out=np.zeros(len(shared)), where=whole > 0)
                out = pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(shared), pa.array(iou)], [group, a_id, b_id, "shared", "iou"])
                yield out.filter(pa.array((shared > 0) & (iou >= floor * (1 - 1e-9))))

    kinds = dict(pairs.dtypes)
    return pairs.mapInArrow(measured, ", ".join(f"`{c}` {kinds[c]}" for c in (group, a_id, b_id)) + ", shared double, iou double")


def signed_overlaps(ea: np.ndarray, eb: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """Shared area of each pair of polygons by signed sides (x1, y1, x2, y2, sign), the second moved by (dx, dy); sides of no width count nothing.

    Over each x the signs of a polygon's sides add up to 0, so the shared length is minus half the sum, over pairs of sides, of the
    product of their signs and their distance."""
    total = np.zeros(len(ea))
    bx1, by1, bx2, by2 = eb[:, :, 0] + dx[:, None], eb[:, :, 1] + dy[:, None], eb[:, :, 2] + dx[:, None], eb[:, :, 3] + dy[:, None]
    with np.errstate(all="ignore"):
        bm = np.where(bx2 > bx1, (by2 - by1) / (bx2 - bx1), 0.0)
        am = np.where(ea[:, :, 2] > ea[:, :, 0], (ea[:, :, 3] - ea[:, :, 1]) / (ea[:, :, 2] - ea[:, :, 0]), 0.0)
        for i in range(ea.shape[1]):
            x1, y1, x2, sign, m = (c[:, None] for c in (ea[:, i, 0], ea[:, i, 1], ea[:, i, 2], ea[:, i, 4], am[:, i]))
            low, high = np.maximum(bx1, x1), np.minimum(bx2, x2)
            p = y1 - by1 + (low - x1) * m - (low - bx1) * bm
            q = y1 - by1 + (high - x1) * m - (high - bx1) * bm
            twice = np.where(p * q < 0, (p * p + q * q) / (np.abs(p) + np.abs(q)), np.abs(p + q))
            total += (np.where(high > low, (high - low) * twice, 0.0) * eb[:, :, 4] * sign).sum(axis=1)
    return total / -4


def _signed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signed sides of a column of rings, one polygon behind the other, from the corner of its bounds; how many each has; the bounds of
    the outlines (4, polygon); the areas by signs. What isn't finite has NaN for its area.

    Below a side of sign 1 is inside, above it outside, of an outline; of a hole the other way round. Upright sides are left out."""
    n_rings = pc.list_value_length(column).fill_null(0).to_numpy().astype(np.int64)
    rings = column.flatten()
    size = pc.list_value_length(rings).fill_null(0).to_numpy().astype(np.int64)
    points = rings.flatten()
    p = np.stack([pc.list_element(points, i).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
    n, start = len(column), np.cumsum(size) - size
    of, ring = np.repeat(np.arange(n), n_rings), np.repeat(np.arange(len(size)), size)
    outer = np.zeros(len(of), bool)
    outer[(np.cumsum(n_rings) - n_rings)[n_rings > 0]] = True
    box, some = np.full((4, n), np.nan), np.flatnonzero(size > 0)
    if len(some):
        for k, f in enumerate((np.minimum, np.minimum, np.maximum, np.maximum)):
            box[k, of[some][outer[some]]] = f.reduceat(p[:, k % 2], start[some])[outer[some]]
    p = p - box[:2, of[ring]].T
    after = np.arange(1, len(p) + 1)
    after[(start + size - 1)[some]] = start[some]
    side = np.hstack([p, p[after]])
    turn = np.bincount(ring, side[:, 0] * side[:, 3] - side[:, 2] * side[:, 1], minlength=len(size)) / 2
    area = np.bincount(of, np.where(size > 2, np.abs(turn) * np.where(outer, 1, -1), 0.0), minlength=n)
    area[~np.isfinite(box).all(axis=0) | ~np.isfinite(np.bincount(of[ring], p.sum(axis=1), minlength=n))] = np.nan
    keep = np.flatnonzero((size[ring] > 2) & (side[:, 0] != side[:, 2]))
    sign = (np.where(outer, 1.0, -1.0) * np.where(turn < 0, -1.0, 1.0))[ring[keep]]
    side = side[keep]
    back = side[:, 0] > side[:, 2]
    side = np.hstack([np.where(back[:, None], side[:, [2, 3, 0, 1]], side), np.where(back, sign, -sign)[:, None]])
    return side, np.bincount(of[ring[keep]], minlength=n), box, area


class _Shapes:
    """Polygons from the corner of their bounds; what differs by no more than the rounding of its coordinates is held once."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.used, self.flat = 0, np.zeros((1024, 5))
        self.n, self.start, self.area, self.plain = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool)

    def forget(self, keep: int) -> None:
        """Drops all but the first ``keep`` shapes."""
        while len(self.known) > keep:
            self.known.popitem()
        self.n, self.start, self.area, self.plain = self.n[:keep], self.start[:keep], self.area[:keep], self.plain[:keep]
        self.used = int(self.n.sum())

    def add(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of each polygon's shape, -1 where it has no area, and its bounds."""
        side, n, box, area = _signed(column)
        number, start = np.full(len(column), -1, np.int64), np.cumsum(n) - n
        with np.errstate(all="ignore"):
            unit = np.exp2(np.ceil(np.log2(np.abs(box).max(axis=0))) - 45)
        unit[~(np.isfinite(unit) & (unit > 0))] = 1.0
        for size in np.unique(n[(n > 0) & np.isfinite(area)]).tolist():
            rows = np.flatnonzero((n == size) & np.isfinite(area))
            s = side[start[rows][:, None] + np.arange(size)]
            key = np.rint(s[:, :, :4] / unit[rows][:, None, None]).reshape(len(rows), -1)
            key = np.ascontiguousarray(np.hstack([key, s[:, :, 4], unit[rows][:, None]]) + 0.0)  # one zero of two
            _, first, same = np.unique(key.view(np.dtype((np.void, key.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
            found, fresh, before = [], [], len(self.known)
            for i in first.tolist():
                at = self.known.setdefault(hashlib.blake2b(key[i].tobytes(), digest_size=16).digest(), len(self.known))
                found.append(at)
                if at == before + len(fresh):
                    fresh.append(i)
            if fresh:
                self._hold(s[fresh], area[rows[fresh]])
            number[rows] = np.array(found)[same.ravel()]
        number[number >= 0] = np.where(self.area[number[number >= 0]] > 0, number[number >= 0], -1)
        return number, box

    def _hold(self, s: np.ndarray, area: np.ndarray) -> None:
        n, size = s.shape[:2]
        twice, step, none = np.empty(n), max(1, (1 << 15) // size**2), np.zeros(n)
        for i in range(0, n, step):
            twice[i : i + step] = signed_overlaps(s[i : i + step], s[i : i + step], none[i : i + step], none[i : i + step])
        plain = np.abs(twice - area) <= 1e-12 * np.maximum(twice, np.abs(area))  # no place counts but 0 or 1, so signs say what parity says
        for i in np.flatnonzero(~plain):
            area[i] = overlap_areas(s[i][None, :, :4], s[i][None, :, :4])[0]
        while self.used + n * size > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + n * size] = s.reshape(-1, 5)
        self.n, self.start = np.append(self.n, np.full(n, size)), np.append(self.start, self.used + np.arange(n) * size)
        self.area, self.plain, self.used = np.append(self.area, area), np.append(self.plain, plain), self.used + n * size

    def _sides(self, shapes: np.ndarray, blank: float) -> np.ndarray:
        at = np.arange(int(self.n[shapes].max()))
        here = at < self.n[shapes][:, None]
        out = self.flat[np.where(here, self.start[shapes][:, None] + at, 0)]
        if not here.all():
            out[~here] = blank
        return out

    def shared(self, a: np.ndarray, b: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
        """Shared area of each pair of shapes, the second moved by (dx, dy)."""
        out, work, plain = np.empty(len(a)), self.n[a] * self.n[b], self.plain[a] & self.plain[b]
        for signed in (True, False):
            order = np.flatnonzero(plain == signed)
            order = order[np.argsort(work[order], kind="stable")]
            while len(order):
                most = max(1, (1 << (15 if signed else 18)) // int(work[order[0]]))
                most = max(1, min(most, int(np.searchsorted(work[order], 2 * work[order[0]], side="right"))))
                rows, order = order[:most], order[most:]
                ea, eb = self._sides(a[rows], 0.0 if signed else np.nan), self._sides(b[rows], 0.0 if signed else np.nan)
                if signed:
                    out[rows] = signed_overlaps(ea, eb, dx[rows], dy[rows])
                else:
                    move = np.stack([dx[rows], dy[rows]] * 2, axis=1)[:, None]
                    out[rows] = overlap_areas(ea[:, :, :4], eb[:, :, :4] + move)
        return out


class _Free:
    """A group's polygons that nobody has taken yet. Those of one shape and place stand as one site, in the order of their ids.

    Sites are looked up by level of area and cell of their middle; the index is made anew when half of it is taken."""

    def __init__(self, shapes: _Shapes, number: np.ndarray, box: np.ndarray, code: np.ndarray):
        rows = np.flatnonzero(number >= 0)
        rows = rows[np.lexsort((rows, box[1, rows], box[0, rows], number[rows]))]
        x, y, shape = box[0, rows], box[1, rows], number[rows]
        new = np.flatnonzero(np.concatenate([[True], (shape[1:] != shape[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])) if len(rows) else np.zeros(0, np.int64)
        self.shapes, self.rows, self.code, self.taken = shapes, rows, code, bytearray(len(code))
        self.at, self.end = new.copy(), np.append(new[1:], len(rows)) if len(new) else new.copy()
        self.x, self.y, self.shape = x[new], y[new], shape[new]
        self.wide, self.tall, self.area = (box[2] - box[0])[rows[new]], (box[3] - box[1])[rows[new]], shapes.area[self.shape]
        self.open = np.ones(len(new), bool)
        self._index()

    def _index(self) -> None:
        self.live = int(self.open.sum())
        self.indexed, self.levels = self.live, []
        sites = np.flatnonzero(self.open)
        level = np.floor(np.log(self.area[sites]) / np.log(1.25))
        for v in np.unique(level):
            s = sites[level == v]
            x, y = self.x[s] + self.wide[s] / 2, self.y[s] + self.tall[s] / 2
            wide, tall = float(self.wide[s].max()), float(self.tall[s].max())
            cell = max(wide / 8, tall / 8, np.ptp(x) / (1 << 20), np.ptp(y) / (1 << 20))
            col, row = np.floor((x - x.min()) / cell).astype(np.int64), np.floor((y - y.min()) / cell).astype(np.int64)
            columns = int(col.max()) + 1
            key = row * columns + col
            order = np.argsort(key, kind="stable")
            self.levels.append((float(self.area[s].min()), float(self.area[s].max()), wide, tall, float(x.min()), float(y.min()), cell, columns, int(row.max()), key[order], s[order]))

    def head(self, site: int) -> int:
        """The place in the order of the site's first that is free; -1 if none is."""
        at, end, first = int(self.at[site]), int(self.end[site]), int(self.at[site])
        while at < end and self.taken[self.code[self.rows[at]]]:
            at += 1
        if at > first:
            self.at[site] = at
        if at == end:
            if self.open[site]:
                self.open[site] = False
                self.live -= 1
            return -1
        return int(self.code[self.rows[at]])

    def near(self, x: np.ndarray, y: np.ndarray, wide: np.ndarray, tall: np.ndarray, shape: np.ndarray, least: float, at_once: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(asker, site, iou to 9 places) of the free sites whose iou is ``least`` or more, in parts."""
        if self.live * 2 < self.indexed:
            self._index()
        area, reach = self.shapes.area[shape], max(least - 1e-9, 1e-12)
        for low, high, w, h, x0, y0, cell, columns, last, key, sites in self.levels:
            need = reach / (1 + reach) * (area + np.maximum(low, area * reach)) * (1 - 1e-9)
            right, up = (wide + w) / 2 - need / np.minimum(tall, h), (tall + h) / 2 - need / np.minimum(wide, w)
            who = np.flatnonzero((area * reach <= high * (1 + 1e-9)) & (area >= low * reach * (1 - 1e-9)) & (right >= 0) & (up >= 0))
            mx, my = x[who] + wide[who] / 2 - x0, y[who] + tall[who] / 2 - y0
            cells = [np.floor(v / cell) for v in (mx - right[who], mx + right[who], my - up[who], my + up[who])]
            left, right, down, up = (np.clip(c, -1, m).astype(np.int64) for c, m in zip(cells, (columns, columns - 1, last + 1, last)))
            left, down = np.maximum(left, 0), np.maximum(down, 0)
            some = np.flatnonzero((left <= right) & (down <= up))
            count = up[some] - down[some] + 1
            who = np.repeat(who[some], count)
            row = np.repeat(down[some] - np.cumsum(count) + count, count) + np.arange(count.sum())
            start = np.searchsorted(key, row * columns + np.repeat(left[some], count))
            n = np.searchsorted(key, row * columns + np.repeat(right[some], count), side="right") - start
            held = np.flatnonzero(n)
            who, start, n = who[held], start[held], n[held]
            sums = np.cumsum(n)
            i = 0
            while i < len(n):
                j = max(i + 1, int(np.searchsorted(sums, (sums[i - 1] if i else 0) + at_once, side="right")))
                c = n[i:j]
                asker, site = np.repeat(who[i:j], c), sites[np.repeat(start[i:j] - np.cumsum(c) + c, c) + np.arange(c.sum())]
                i = j
                keep = self.open[site]
                asker, site = asker[keep], site[keep]
                dx, dy, a, b = self.x[site] - x[asker], self.y[site] - y[asker], area[asker], self.area[site]
                over = np.minimum(dx + self.wide[site], wide[asker]) - np.maximum(dx, 0)
                above = np.minimum(dy + self.tall[site], tall[asker]) - np.maximum(dy, 0)
                keep = np.flatnonzero((over > 0) & (above > 0) & (np.minimum(np.minimum(a, b), over * above) * (1 + reach) >= reach * (a + b) * (1 - 1e-9)))
                if len(keep):
                    asker, site, a, b = asker[keep], site[keep], a[keep], b[keep]
                    shared = self.shapes.shared(shape[asker], self.shape[site], dx[keep], dy[keep])
                    iou = np.round(shared / (a + b - shared), 9)
                    good = np.flatnonzero((iou >= least) & (shared > 0))
                    yield asker[good], site[good], iou[good]


class _Turns:
    """Askers of a group in their turn take the free polygon of the best iou, ties to the smaller id.

    A block of askers is looked up at once, at a high iou first and lower only where nothing is left there; then each has its turn.
    Of an asker's sites only the best ``most`` are kept, with the bound below which others may stand."""

    STEPS = (0.99, 0.97, 0.92, 0.8, 0.6, 0.2)

    def __init__(self, free: _Free, floor: float, most: int = 32):
        self.free, self.most, self.first = free, most, 1
        self.steps = [s for s in self.STEPS if s > floor] + [floor]

    def block(self) -> int:
        """How many askers to look up at once: where few polygons are free they get in each other's way."""
        return min(2000, max(500, self.free.live // 4))

    def _start(self) -> int:
        return min(self.first, len(self.steps) - 1)

    def _look(self, owner: np.ndarray, where: tuple[np.ndarray, ...], asked: list[int], step: int, lists: dict) -> None:
        rows = np.flatnonzero(np.isin(owner, asked))
        who, site, iou, head = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        cut: dict[int, tuple[float, int]] = {}
        for a, s, v in self.free.near(*(c[rows] for c in where), self.steps[step]):
            who, site, iou = np.concatenate([who, owner[rows[a]]]), np.concatenate([site, s]), np.concatenate([iou, v])
            head = np.concatenate([head, self.free.code[self.free.rows[self.free.at[s]]]])
            order = np.lexsort((head, -iou, who))
            who, site, iou, head = who[order], site[order], iou[order], head[order]
            if len(who):
                new = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
                rank = np.arange(len(who)) - np.repeat(new, np.diff(np.append(new, len(who))))
                for i in np.flatnonzero(rank == self.most):
                    cut[int(who[i])] = (float(iou[i - 1]), int(head[i - 1]))
                keep = rank < self.most
                who, site, iou, head = who[keep], site[keep], iou[keep], head[keep]
        ends = np.searchsorted(who, asked).tolist(), np.searchsorted(who, asked, side="right").tolist()
        site, iou = site.tolist(), iou.tolist()
        for k, a, z in zip(asked, *ends):
            lists[k] = (step, iou[a:z], site[a:z], cut.get(k))

    def _best(self, entry: tuple) -> tuple[float, int] | None:
        """(iou, place) of the best in a list that is free, if none outside of the list can be better."""
        _, ious, sites, cut = entry
        i = 0
        while i < len(ious):
            value, least = ious[i], -1
            while i < len(ious) and ious[i] == value:
                head = self.free.head(sites[i])
                if head >= 0 and (least < 0 or head < least):
                    least = head
                i += 1
            if least >= 0:
                return None if cut and (value < cut[0] or (value == cut[0] and least > cut[1])) else (value, least)
        return None

    def settle(self, owner: np.ndarray, where: tuple[np.ndarray, ...]) -> list[tuple[int, int, float]]:
        """(asker, place, iou) of what is taken by askers 0, 1, ... ; ``owner`` names the asker of each row of x, y, width, height and shape."""
        n, last, out, lists, i = int(owner.max(initial=-1)) + 1, len(self.steps) - 1, [], {}, 0
        rowed = np.unique(owner).tolist()
        asked, step = rowed, self._start()
        first = True
        while asked and self.free.live:
            waiting: dict[int, list[int]] = {}
            for k in asked:
                entry = lists.get(k)
                waiting.setdefault(step if entry is None else entry[0] if entry[3] else entry[0] + 1, []).append(k)
            for at in range(min(waiting), last + 1):
                if todo := sorted(waiting.get(at, ())):
                    self._look(owner, where, todo, at, lists)
                    if first:
                        some = sum(bool(lists[k][1]) for k in todo) / len(todo)
                        self.first = max(0, at - 1) if some > 0.75 else min(last, at + 1) if some < 0.3 else at
                        first = False
                    if at < last:
                        waiting.setdefault(at + 1, []).extend(k for k in todo if not lists[k][1])
            asked = []
            while i < n:
                entry = lists.get(i)
                if entry is not None and (entry[1] or entry[0] < last):
                    best = self._best(entry)
                    if best:
                        out.append((i, best[1], best[0]))
                        self.free.taken[best[1]] = 1
                    elif entry[3] or entry[0] < last:
                        asked = [k for k in range(i, n) if (e := lists.get(k)) is not None and (e[3] or e[0] < last) and not self._best(e)]
                        break
                i += 1
        return out


def ordered_overlaps(a: DataFrame, b: DataFrame, group: str, a_id: str, b_id: str, rings: str, floor: float, at_once: int = 2000) -> DataFrame:
    """(group, a_id, b_id, iou): in the order of ``a_id`` each polygon of a takes the free polygon of b in its group of the highest iou,
    to 9 places, of ``floor`` or more; of equal ones the smaller ``b_id``.

    A group's order is one task's work, but its overlapping pairs, whose number grows with the square of the group, are never all made: an
    a looks among the b's that are still free, at a high iou first. A task holds the places and shapes of a group's b's, equal shapes
    once, and a block of a's. Rows with a null group, id or outline, without an area or with a coordinate that isn't finite match nothing;
    rows of one id count as one."""

    def side(d: DataFrame, key: str, name: str) -> DataFrame:
        kept = d.filter(F.col(group).isNotNull() & F.col(key).isNotNull() & F.col(rings).isNotNull())
        other = b.schema[b_id] if name == "a" else a.schema[a_id]
        return kept.select(F.col(group), F.lit(name == "a").alias("_asks"), *(F.col(key).alias(c) if c == f"_{name}" else F.lit(None).cast(other.dataType).alias(c) for c in ("_a", "_b")), F.col(rings).alias("_rings"))

    kinds = dict(a.dtypes)
    both = side(a, a_id, "a").unionByName(side(b, b_id, "b"))
    spark = a.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)  # few groups of long work don't meet in one
    sorted_ = both.repartition(tasks, group).sortWithinPartitions(group, "_asks", "_a", "_b")

    def changes(c: pa.Array) -> np.ndarray:
        """Where a value other than the one before begins."""
        return np.concatenate([[0], 1 + np.flatnonzero(pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False))]).astype(np.int64)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, here = _Shapes(), None
        held: list[tuple] = []  # of the b's of the group: ids, shapes, bounds
        turns = names = waiting = None
        kept = 0

        def serve(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            i = 0
            starts = changes(part["_a"])
            while i < len(starts) and turns.free.live:
                j = min(len(starts), i + turns.block())
                rows = part.slice(starts[i], (starts[j] if j < len(starts) else part.num_rows) - starts[i])
                owner = np.repeat(np.arange(j - i), np.diff(np.append(starts[i:j], starts[i] + rows.num_rows)))
                if len(shapes.known) > kept + 100_000:
                    shapes.forget(kept)
                number, box = shapes.add(rows["_rings"])
                ok = number >= 0
                found = turns.settle(owner[ok], (box[0, ok], box[1, ok], (box[2] - box[0])[ok], (box[3] - box[1])[ok], number[ok]))
                if found:
                    who, place, iou = zip(*found)
                    at = pa.array(np.searchsorted(owner, np.array(who)))
                    yield pa.RecordBatch.from_arrays([rows[group].take(at), rows["_a"].take(at), names.take(pa.array(place)), pa.array(iou, pa.float64())], [group, a_id, b_id, "iou"])
                i = j

        for batch in batches:
            starts = changes(batch[group])
            for s, e in zip(starts, np.append(starts[1:], batch.num_rows)):
                part = batch.slice(s, e - s)
                if not part.num_rows:
                    continue
                if part[group][0] != here:
                    if waiting is not None:
                        yield from serve(waiting)
                    here, held, turns, names, waiting = part[group][0], [], None, None, None
                    if len(shapes.known) > 100_000:
                        shapes = _Shapes()
                asks = part["_asks"].to_numpy(zero_copy_only=False)
                n_b = int((~asks).sum())
                for i in range(0, n_b, at_once):
                    some = part.slice(i, min(at_once, n_b - i))
                    held.append((some["_b"], *shapes.add(some["_rings"])))
                asking = part.slice(n_b)
                if not asking.num_rows or not held:
                    continue
                if turns is None:
                    names = pa.concat_arrays([h[0] for h in held])
                    first = changes(names)
                    code = np.repeat(first, np.diff(np.append(first, len(names))))
                    turns = _Turns(_Free(shapes, np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held], axis=1), code), floor)
                    held, kept = [()], len(shapes.known)
                if waiting is not None:
                    asking = pa.concat_batches([waiting, asking])
                last = int(changes(asking["_a"])[-1])  # rows of one id stay together
                if last:
                    yield from serve(asking.slice(0, last))
                waiting = asking.slice(last)
        if waiting is not None:
            yield from serve(waiting)

    schema = f"`{group}` {kinds[group]}, `{a_id}` {kinds[a_id]}, `{b_id}` {dict(b.dtypes)[b_id]}, iou double"
    return sorted_.mapInArrow(matched, schema)
