"""Estimators: stratified totals, ratio variances, trends, rank correlation, bootstrap, exact bounds, latent classes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stratified_mean(sample: DataFrame, strata: DataFrame, stratum: str, value: str, size: str) -> DataFrame:
    """Weighted mean over strata and its standard error: the sums of W * mean and W * W * s * s / n. Strata without sample rows drop out of the weights."""
    s = sample.groupBy(stratum).agg(F.avg(value).alias("m"), F.coalesce(F.var_samp(value), F.lit(0.0)).alias("v"), F.count(value).alias("n"))
    total = strata.join(s, stratum).agg(F.sum(size).alias("total"))  # one row
    j = strata.join(s, stratum).join(F.broadcast(total)).withColumn("w", F.col(size) / F.col("total"))
    return j.agg(F.sum("n").alias("n"), F.round(F.sum(F.col("w") * F.col("m")), 6).alias("mean"), F.round(F.sqrt(F.sum(F.col("w") * F.col("w") * F.col("v") / F.col("n"))), 6).alias("se"))


def stratified_ratio(sample: DataFrame, strata: DataFrame, stratum: str, y: str, x: str, size: str) -> DataFrame:
    """The ratio of two stratified totals and its standard error by linearisation with the covariance inside strata."""
    s = sample.groupBy(stratum).agg(F.avg(y).alias("my"), F.avg(x).alias("mx"), F.coalesce(F.var_samp(y), F.lit(0.0)).alias("vy"), F.coalesce(F.var_samp(x), F.lit(0.0)).alias("vx"), F.coalesce(F.covar_samp(y, x), F.lit(0.0)).alias("c"), F.count(F.lit(1)).alias("n"))
    j = strata.join(s, stratum)
    t = j.agg(F.sum(F.col(size) * F.col("my")).alias("ty"), F.sum(F.col(size) * F.col("mx")).alias("tx"))  # one row
    r = F.col("ty") / F.col("tx")
    var = F.sum(F.col(size) * F.col(size) / F.col("n") * (F.col("vy") + F.col("r") * F.col("r") * F.col("vx") - 2 * F.col("r") * F.col("c")))
    k = j.join(F.broadcast(t)).withColumn("r", r)
    return k.groupBy("r", "tx").agg(var.alias("var")).select(F.round("r", 6).alias("ratio"), F.round(F.sqrt("var") / F.abs("tx"), 6).alias("se"))


def theil_sen(rows: DataFrame, keys: list[str], x: str, y: str, least_dx: float = 0.0) -> DataFrame:
    """Median of the slopes between points of a group more than ``least_dx`` apart, and the median intercept. Groups are short series."""
    a, b = rows.select(*keys, F.col(x).alias("x1"), F.col(y).alias("y1")), rows.select(*keys, F.col(x).alias("x2"), F.col(y).alias("y2"))
    slopes = a.join(b, keys).filter(F.col("x2") - F.col("x1") > least_dx).select(*keys, ((F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))).alias("s"))
    slope = slopes.groupBy(*keys).agg(F.median("s").alias("slope"))
    rest = rows.join(slope, keys).select(*keys, "slope", (F.col(y) - F.col("slope") * F.col(x)).alias("i"))
    return rest.groupBy(*keys, "slope").agg(F.median("i").alias("intercept")).select(*keys, F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


def ols(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 4).alias("intercept"), F.round(F.corr(y, x), 6).alias("r"))


def average_rank(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Ranks with ties at their mean, by counting rows of each distinct value first."""
    c = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    below = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    r = c.withColumn(name, F.coalesce(F.sum("_n").over(below), F.lit(0)) + (F.col("_n") + 1) / 2).select(*keys, value, name)
    return rows.join(r, [*keys, value])


def spearman(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    both = average_rank(average_rank(rows, keys, x, "_rx"), keys, y, "_ry")
    return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.corr("_rx", "_ry"), 6).alias("rho"))


def block_bootstrap(blocks: DataFrame, block: str, n_blocks: int, columns: list[str], replicates: int) -> DataFrame:
    """Sums of block totals over resampled blocks, a row a replicate; draws are a fixed arithmetic of (replicate, place), so any engine repeats them.

    ``blocks`` has one row for each of the ``n_blocks`` block numbers from 0."""
    draws = blocks.sparkSession.range(replicates).select(F.col("id").cast("int").alias("rep"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("place"))
    mixed = ((F.col("rep") * 7919 + F.col("place") + 1).cast("long") * 2654435761) % 4294967296
    drawn = draws.withColumn(block, (F.floor(mixed / 65536) % n_blocks).cast("int"))
    return drawn.join(blocks, block).groupBy("rep").agg(*(F.sum(c).alias(c) for c in columns))


@F.pandas_udf(T.DoubleType())
def clopper_pearson_upper(k: pd.Series, n: pd.Series) -> pd.Series:
    """Exact 95 % upper bound of a binomial share, by bisection on its distribution function."""

    def cdf(k: int, n: int, p: float) -> float:
        if p in (0.0, 1.0):
            return 1.0 if p == 0.0 or k >= n else 0.0
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        return math.fsum(map(math.exp, logs))

    def one(k: int, n: int) -> float | None:
        if n <= 0:
            return None
        if k >= n:
            return 1.0
        lo, hi = k / n, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if cdf(k, n, mid) > 0.05 else (lo, mid)
        return round(hi, 6)

    return pd.Series([one(int(a), int(b)) for a, b in zip(k, n)])


def zero_failure_bound(n: Column, level: float = 0.95) -> Column:
    """Upper bound of a share with no hit in n trials."""
    return F.round(1 - F.pow(F.lit(1 - level), 1 / n), 6)


def annual_rate(rate: Column, years: Column) -> Column:
    return F.round(1 - F.pow(1 - rate, 1 / years), 6)


def false_positive_rate(precision: Column, recall: Column, prevalence: Column) -> Column:
    """From precision, recall and prevalence, kept to [0, 1]."""
    raw = F.try_divide(recall * prevalence * (1 - precision), precision * (1 - prevalence))
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)), 6)


def _em(x: np.ndarray, w: np.ndarray, pi: np.ndarray, p: np.ndarray, rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two latent classes by expectation-maximisation, all replicates at once: (share of class 1, rates by class, log-likelihood).

    x: patterns by indicators; w: replicates by patterns; pi: a share a replicate; p: replicates by two classes by indicators. A
    replicate that has converged stays as it is."""
    pi, p, moving = pi.copy(), np.clip(p, 1e-6, 1 - 1e-6), np.ones(len(pi), bool)

    def likelihood(pi: np.ndarray, p: np.ndarray) -> np.ndarray:
        like = np.where(x[None, None] > 0, p[:, :, None], 1 - p[:, :, None]).prod(axis=3)  # replicates, classes, patterns
        return like * np.stack([1 - pi, pi], axis=1)[:, :, None]

    for _ in range(rounds):
        if not moving.any():
            break
        like = likelihood(pi[moving], p[moving])
        held = w[moving][:, None] * like / np.maximum(like.sum(axis=1, keepdims=True), 1e-300)
        size = held.sum(axis=2)
        new_p = np.clip((held[..., None] * x).sum(axis=2) / np.maximum(size, 1e-12)[..., None], 1e-6, 1 - 1e-6)
        new_pi = np.clip(size[:, 1] / w[moving].sum(axis=1), 1e-9, 1 - 1e-9)
        change = np.maximum(np.abs(new_pi - pi[moving]), np.abs(new_p - p[moving]).max(axis=(1, 2)))
        pi[moving], p[moving] = new_pi, new_p
        moving[np.flatnonzero(moving)[change < tolerance]] = False
    return pi, p, (w * np.log(np.maximum(likelihood(pi, p).sum(axis=1), 1e-300))).sum(axis=1)


def _fitted(x: np.ndarray, w: np.ndarray, starts: list[tuple[np.ndarray, np.ndarray]], rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(share, sensitivity, specificity) of the best of several starts a replicate; the second class is the one that the indicators find."""
    best = None
    for pi0, p0 in starts:
        pi, p, score = _em(x, w, pi0, p0, rounds, tolerance)
        if best is None:
            best = pi, p, score
        else:
            better = score > best[2] + 1e-9
            best = np.where(better, pi, best[0]), np.where(better[:, None, None], p, best[1]), np.where(better, score, best[2])
    pi, p, _ = best
    switched = p[:, 1].mean(axis=1) < p[:, 0].mean(axis=1)
    return np.where(switched, 1 - pi, pi), np.where(switched[:, None], p[:, 0], p[:, 1]), 1 - np.where(switched[:, None], p[:, 1], p[:, 0])


def latent_class_bootstrap(blocks: DataFrame, block: str, n_blocks: int, indicators: list[str], count: str = "n", replicates: int = 200, least: int = 10, rounds: int = 1500, tolerance: float = 1e-9) -> DataFrame:
    """Share, sensitivities and specificities of two latent classes with percentile intervals from resampled whole blocks.

    blocks: block (from 0), indicators (0 or 1), count. Spark sums the patterns of each block and each replicate, which leaves at most
    ``replicates`` rows of 2 ** indicators counts; all replicates are then fitted at once, from the estimate over all blocks and from
    two fixed starts. A fit at the boundary takes no part; with fewer than ``least`` others the interval is null."""
    k = len(indicators)
    patterns = [[(i >> (k - 1 - j)) & 1 for j in range(k)] for i in range(2**k)]
    number = sum((F.col(c).cast("int") * 2 ** (k - 1 - j) for j, c in enumerate(indicators)), F.lit(0))
    columns = [f"p{i}" for i in range(2**k)]
    wide = blocks.groupBy(block).agg(*(F.coalesce(F.sum(F.when(number == i, F.col(count))), F.lit(0)).cast("double").alias(c) for i, c in enumerate(columns)))
    every = wide.agg(*(F.sum(c).alias(c) for c in columns)).first()
    drawn = block_bootstrap(wide, block, n_blocks, columns, replicates).orderBy("rep").collect()  # `replicates` rows
    x, w = np.array(patterns, float), np.array([[r[c] for c in columns] for r in drawn], float)
    start = lambda n, pi, low, high: (np.full(n, pi), np.tile(np.array([[low] * k, [high] * k], float), (n, 1, 1)))
    pi, se, sp = _fitted(x, np.array([[every[c] for c in columns]], float), [start(1, a, 0.2, 0.8) for a in (0.2, 0.35, 0.5)], 4000, 1e-11)
    point = (np.repeat(pi, len(w)), np.repeat(np.stack([1 - sp, se], axis=1), len(w), axis=0))
    pis, ses, sps = _fitted(x, w, [point, start(len(w), 0.3, 0.15, 0.75), start(len(w), 0.6, 0.3, 0.9)], rounds, tolerance)
    rates = np.concatenate([ses, sps], axis=1)
    inner = ((rates <= 1 - 1e-4) & (rates >= 1e-4)).all(axis=1) & (pis >= 1e-4) & (pis <= 1 - 1e-4)
    fits, names = np.column_stack([pis, rates])[inner], ["prevalence", *(f"sensitivity_{i}" for i in indicators), *(f"specificity_{i}" for i in indicators)]
    low, high = (np.percentile(fits, q, axis=0) if len(fits) >= least else [None] * len(names) for q in (2.5, 97.5))
    r = lambda v: None if v is None else round(float(v), 4)
    out = [(n, r(v), r(a), r(b), len(fits)) for n, v, a, b in zip(names, np.concatenate([pi, se[0], sp[0]]), low, high)]
    return blocks.sparkSession.createDataFrame(out, "measure string, estimate double, low double, high double, replicates int")


def latent_classes(patterns: DataFrame, indicators: list[str], count: str = "n", rounds: int = 500) -> DataFrame:
    """Two latent classes under conditional independence by expectation-maximisation over the counts of 0/1 patterns.

    The data come as at most 2 ** indicators rows. The class of higher mean rates is the second (labels don't switch)."""
    rows = patterns.groupBy(*indicators).agg(F.sum(count).alias("_n")).collect()  # 2 ** len(indicators) at most
    x, w = np.array([[r[i] for i in indicators] for r in rows], float), np.array([r["_n"] for r in rows], float)
    best = None
    for start in (0.2, 0.35, 0.5):
        pi, p = start, np.array([[0.2] * len(indicators), [0.8] * len(indicators)]) + (start - 0.35) * 0.1
        for _ in range(rounds):
            like = np.stack([(p[c] ** x * (1 - p[c]) ** (1 - x)).prod(axis=1) for c in (0, 1)], axis=1) * [1 - pi, pi]
            post = like / like.sum(axis=1, keepdims=True)
            pi = float((w * post[:, 1]).sum() / w.sum())
            p = np.clip((post * w[:, None]).T @ x / (post * w[:, None]).sum(axis=0)[:, None], 1e-6, 1 - 1e-6)
        score = float((w * np.log(like.sum(axis=1))).sum())
        if best is None or score > best[0]:
            best = (score, pi, p)
    _, pi, p = best
    if p[1].mean() < p[0].mean():
        pi, p = 1 - pi, p[::-1]
    out = [(i, round(pi, 4), round(float(p[1, k]), 4), round(float(1 - p[0, k]), 4), round(float(p[1, k] - p[0, k]), 4)) for k, i in enumerate(indicators)]
    return patterns.sparkSession.createDataFrame(out, "source string, prevalence double, sensitivity double, specificity double, youden double")
