"""Measures of image tiles, a tile a row: the shift between two tiles by phase correlation, and how far an edge is spread."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# An edge's profile reaches so many pixels to both sides, in quarter steps; the strongest three in a hundred pixels count.
REACH, STEPS, STRONGEST = 6, 4, 97.0
LEAST_EDGES, MOST_EDGES, LEAST_PROFILES, LEAST_RISE = 40, 900, 20, 6


def _peak(before: float, at: float, after: float) -> float:
    """Where between two neighbours the top of a parabola through three values lies."""
    return float(np.clip((before - after) / (2 * (before - 2 * at + after) + 1e-12), -0.5, 0.5))


def shift_between(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """(dx, dy, quality): the place of the peak of the phase correlation of two square tiles under a Hann window, to parts of a pixel."""
    n = len(a)
    window = np.outer(np.hanning(n), np.hanning(n))
    cross = np.fft.fft2(a * window) * np.conj(np.fft.fft2(b * window))
    size = np.abs(cross)
    surface = np.abs(np.fft.ifft2(cross / np.where(size == 0, 1e-9, size)))
    y, x = np.unravel_index(int(surface.argmax()), surface.shape)
    top = surface[y, x]
    dy = y + _peak(surface[y - 1, x], top, surface[(y + 1) % n, x])
    dx = x + _peak(surface[y, x - 1], top, surface[y, (x + 1) % n])
    return dx - n * (dx > n / 2), dy - n * (dy > n / 2), float(top / (surface.mean() + 1e-12))


def edge_profile(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(distances, median brightness from 0 to 1) across the strongest edges of a tile; None where there are too few."""
    down, right = np.gradient(a)
    strength = np.hypot(right, down)
    margin = REACH + 1
    ys, xs = np.nonzero(strength >= np.percentile(strength, STRONGEST))
    inner = (ys > margin) & (ys < a.shape[0] - margin) & (xs > margin) & (xs < a.shape[1] - margin)
    ys, xs = ys[inner], xs[inner]
    if len(ys) < LEAST_EDGES:
        return None
    if len(ys) > MOST_EDGES:
        some = np.linspace(0, len(ys) - 1, MOST_EDGES).astype(int)
        ys, xs = ys[some], xs[some]
    ys, xs = ys[strength[ys, xs] >= 1e-6], xs[strength[ys, xs] >= 1e-6]
    away = np.arange(-REACH, REACH + 1 / STEPS, 1 / STEPS)
    along = lambda at, unit, most: np.round(np.clip(at[:, None] + away * unit[:, None], 0, most)).astype(int)
    size = strength[ys, xs]
    seen = a[along(ys, down[ys, xs] / size, a.shape[0] - 1), along(xs, right[ys, xs] / size, a.shape[1] - 1)].astype(np.float32)
    low, high = seen[:, :3].mean(axis=1), seen[:, -3:].mean(axis=1)
    steep = high - low >= LEAST_RISE
    if steep.sum() < LEAST_PROFILES:
        return None
    return away, np.median((seen[steep] - low[steep, None]) / (high - low)[steep, None], axis=0)


def rise_distance(away: np.ndarray, profile: np.ndarray) -> float | None:
    """Pixels from a tenth to nine tenths of the rise, between the crossings nearest to the middle; None where there is none."""
    e = np.asarray(profile, float)
    low, high = np.median(e[:4]), np.median(e[-4:])
    if high - low < 0.5:
        return None
    e = (e - low) / (high - low)
    middle = int(np.abs(away).argmin())

    def crossing(level: float, places: range, step: int) -> float | None:
        for i in places:
            here, there = e[i], e[i + step]
            if (here - level) * (there - level) <= 0 and abs(there - here) > 1e-9:
                return away[i] + (level - here) / (there - here) * (away[i + step] - away[i])
        return None

    top, bottom = crossing(0.9, range(middle, len(e) - 1), 1), crossing(0.1, range(middle, 0, -1), -1)
    if top is None or bottom is None:
        return None
    return float(top - bottom) if 0 < top - bottom < 2 * REACH - 0.2 else None


def _squares(column: pa.Array) -> Iterator[np.ndarray]:
    """The square tiles of a column, one after another."""
    pixels, ends = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(np.nan_to_num(pc.list_value_length(column).to_numpy(zero_copy_only=False)))]).astype(np.int64)
    for start, stop in zip(ends[:-1], ends[1:]):
        n = round((stop - start) ** 0.5)
        yield pixels[start:stop].astype(float).reshape(n, n)


def shifts(tiles: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, dx, dy, quality) of two square tiles a row, each an array of its pixels row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shift_between(x, y) for x, y in zip(_squares(batch[a]), _squares(batch[b]))]
            yield pa.RecordBatch.from_arrays([batch[key], *(pa.array([f[i] for f in found], pa.float64()) for i in range(3))], [key, "dx", "dy", "quality"])

    return tiles.select(key, a, b).mapInArrow(run, f"{key} {dict(tiles.dtypes)[key]}, dx double, dy double, quality double")


def edge_spreads(tiles: DataFrame, key: str, a: str) -> DataFrame:
    """(key, rise): pixels from a tenth to nine tenths of the brightness across the edges of a square tile; null where it has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [edge_profile(x) for x in _squares(batch[a])]
            yield pa.RecordBatch.from_arrays([batch[key], pa.array([f and rise_distance(*f) for f in found], pa.float64())], [key, "rise"])

    return tiles.select(key, a).mapInArrow(run, f"{key} {dict(tiles.dtypes)[key]}, rise double")
