"""Inference: stratified estimates with full covariance, exact and shuffled permutation tests, simulated power, odds, clustering, verdicts."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = ("tp", "fp", "fn", "tn")


def stratified_accuracy(counts: DataFrame, weights: DataFrame, stratum: str, weight: str, z: float = 1.96) -> DataFrame:
    """One row: estimated share of the class and its recall with half widths of their intervals.

    counts: stratum and one column a confusion cell. In a stratum the four cells are one multinomial draw, so all their covariances
    count; recall is a ratio, whose variance takes those of both sides and their covariance."""
    n = sum((F.col(c) for c in CELLS), F.lit(0))
    j = counts.withColumn("_n", n).filter("_n > 0").join(weights, stratum)
    p = {c: F.col(c) / F.col("_n") for c in CELLS}
    w = F.col(weight)

    def cov(a: str, b: str) -> Column:
        term = p[a] * (1 - p[a]) if a == b else -p[a] * p[b]
        return F.sum(F.when(F.col("_n") > 1, w * w * term / (F.col("_n") - 1)).otherwise(0.0))

    s = j.agg(*(F.sum(w * p[c]).alias(c) for c in ("tp", "fn")), cov("tp", "tp").alias("vx"), cov("fn", "fn").alias("vf"), cov("tp", "fn").alias("c"))
    y, vy, cxy = F.col("tp") + F.col("fn"), F.col("vx") + F.col("vf") + 2 * F.col("c"), F.col("vx") + F.col("c")
    recall = F.try_divide(F.col("tp"), y)
    vr = F.try_divide(F.col("vx") + recall * recall * vy - 2 * recall * cxy, y * y)
    half = lambda v: F.round(z * F.sqrt(F.greatest(v, F.lit(0.0))), 6)
    return s.select(F.round(y, 6).alias("area"), half(vy).alias("area_hw"), F.round(recall, 6).alias("recall"), half(vr).alias("recall_hw"))


def exact_permutation(rows: DataFrame, group: str, order: str, x: str, y: str, n: int) -> DataFrame:
    """Two-sided p of each group of ``n`` pairs: the share of orders of y whose absolute correlation reaches the observed one.

    All n! orders are one small table that is broadcast, so ``n`` is limited to 8; groups of another size have no row."""
    if n > 8:
        raise ValueError("n! orders of more than 8 values are not enumerated")
    spark = rows.sparkSession
    orders = spark.createDataFrame([(list(p),) for p in permutations(range(1, n + 1))], "o array<int>")
    g = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, x, y))).alias("q")).filter(F.size("q") == n)
    g = g.select(group, F.transform("q", lambda r: r[x].cast("double")).alias("x"), F.transform("q", lambda r: r[y].cast("double")).alias("y"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    centred = lambda a: F.transform(a, lambda v: v - total(a) / n)
    g = g.select(group, centred(F.col("x")).alias("x"), centred(F.col("y")).alias("y"))
    dot = lambda a, b: total(F.zip_with(a, b, lambda u, v: u * v))
    # the spreads of x and y are the same in every order: the products decide
    g = g.withColumn("seen", F.abs(dot(F.col("x"), F.col("y")))).withColumn("scale", F.sqrt(dot(F.col("x"), F.col("x")) * dot(F.col("y"), F.col("y"))))
    each = g.join(F.broadcast(orders)).withColumn("r", F.abs(dot(F.col("x"), F.transform("o", lambda i: F.element_at("y", i)))))
    hit = F.col("r") >= F.col("seen") - F.lit(1e-12) * F.col("scale")
    return each.filter("scale > 0").groupBy(group).agg(F.count(F.lit(1)).alias("total"), F.round(F.avg(hit.cast("double")), 6).alias("p"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone: 32 bits of their MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8), 16, 10).cast("double") / 4294967296.0


def shuffled_p(rows: DataFrame, group: str, key: str, x: str, y: str, times: int, salt: str) -> DataFrame:
    """Spearman's correlation of each group and the share of ``times`` shuffles of y that reach it in absolute value.

    Ranks are averages over ties; a shuffle deals the y ranks out in the order of hashes of (salt, shuffle, key)."""
    def rank(c: str) -> Column:
        w = Window.partitionBy(group).orderBy(c)
        return F.rank().over(w) + (F.count(F.lit(1)).over(Window.partitionBy(group, c)) - 1) / 2.0

    ranked = rows.select(group, key, rank(x).alias("rx"), rank(y).alias("ry"))
    seen = ranked.groupBy(group).agg(F.corr("rx", "ry").alias("rho"))
    at = ranked.withColumn("i", F.row_number().over(Window.partitionBy(group).orderBy(key)))
    dealt = at.select(group, key, "ry", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("rep"))
    dealt = dealt.withColumn("i", F.row_number().over(Window.partitionBy(group, "rep").orderBy(F.md5(F.concat_ws("/", F.lit(salt), "rep", key)), key)))
    r = at.select(group, "i", "rx").join(dealt.select(group, "i", "rep", "ry"), [group, "i"]).groupBy(group, "rep").agg(F.corr("rx", "ry").alias("r"))
    hits = r.join(seen, group).groupBy(group).agg(F.round(F.first("rho"), 6).alias("rho"), F.round(F.avg((F.abs("r") >= F.abs("rho") - 1e-12).cast("double")), 6).alias("p"))
    return hits


def simulated_power(cases: DataFrame, case: str, gain: str, loss: str, n: str, reps: int, salt: str, z: float = 1.96) -> DataFrame:
    """Share of simulated surveys in which a net change is found: each of ``n`` pairs is a gain or a loss by its probability, and
    |gains - losses| is held against z times the root of its variance."""
    draws = cases.select(case, gain, loss, n, F.explode(F.sequence(F.lit(1), F.lit(reps))).alias("rep")).select(case, gain, loss, n, "rep", F.explode(F.sequence(F.lit(1), F.col(n))).alias("i"))
    u = uniform(F.lit(salt), F.col(case), F.col("rep"), F.col("i"))
    d = draws.withColumn("d", F.when(u < F.col(gain), 1).when(u < F.col(gain) + F.col(loss), -1).otherwise(0))
    s = d.groupBy(case, "rep").agg(F.sum("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("q"), F.count(F.lit(1)).alias("n"))
    found = F.col("s") * F.col("s") > z * z * (F.col("q") - F.col("s") * F.col("s") / F.col("n"))
    return s.groupBy(case).agg(F.round(F.avg(found.cast("double")), 6).alias("power"), F.round(F.avg(F.col("s") / F.col("n")), 6).alias("mean_net"))


def simulated_coverage(strata: DataFrame, stratum: str, weight: str, truth: str, n: str, reps: int, salt: str, z: float = 1.96) -> DataFrame:
    """One row: in what share of simulated stratified samples the interval holds the true share, and its mean half width."""
    draws = strata.select(stratum, weight, truth, n, F.explode(F.sequence(F.lit(1), F.lit(reps))).alias("rep")).select(stratum, weight, truth, n, "rep", F.explode(F.sequence(F.lit(1), F.col(n))).alias("i"))
    hit = (uniform(F.lit(salt), F.col(stratum), F.col("rep"), F.col("i")) < F.col(truth)).cast("double")
    p = draws.groupBy("rep", stratum, weight, truth, n).agg(F.avg(hit).alias("_p"))
    w = F.col(weight)
    e = p.groupBy("rep").agg(F.sum(w * F.col("_p")).alias("e"), F.sum(w * F.col(truth)).alias("t"), F.sum(w * w * F.col("_p") * (1 - F.col("_p")) / (F.col(n) - 1)).alias("v"))
    half = z * F.sqrt("v")
    return e.agg(F.round(F.avg((F.abs(F.col("e") - F.col("t")) <= half).cast("double")), 6).alias("coverage"), F.round(F.avg(half), 6).alias("half_width"))


def fill_odds(k: Column, misses: Column, losses: Column, regain: Column) -> Column:
    """Odds that a gap of ``k`` epochs is a run of misses and not a loss and a regain: the misses' product times the chances of no loss
    in any interval, over the first interval's loss and a regain after k - 1 without one. Null where an input is missing or odd."""
    kept = F.aggregate(losses, F.lit(1.0), lambda a, e: a * (1 - e))
    below = F.element_at(losses, 1) * regain * F.pow(1 - regain, k - 1)
    ok = (F.size(losses) > 0) & ~F.exists(losses, lambda e: e.isNull()) & (regain > 0) & (regain < 1)
    return F.when(ok & misses.isNotNull() & (below > 0), misses * kept / below)


def normalized(value: Column, gain: Column, offset: Column, low: float = 0.0, high: float = 255.0) -> Column:
    """Gain and offset applied, clipped; values without a correction stay as they are."""
    return F.least(F.lit(high), F.greatest(F.lit(low), value * F.coalesce(gain, F.lit(1.0)) + F.coalesce(offset, F.lit(0.0))))


def gap_verdict(gap: Column, replicate_at: float, refute_at: float) -> Column:
    """REPLICATED at the upper bound or more, DOES NOT STAND at the lower one or less, UNRESOLVED between them."""
    if refute_at >= replicate_at:
        raise ValueError("the bounds leave no band between them")
    return F.when(gap >= replicate_at, F.lit("REPLICATED")).when(gap <= refute_at, F.lit("DOES NOT STAND")).otherwise(F.lit("UNRESOLVED"))


def verify_claims(claims: DataFrame, evidence: DataFrame, key: str, value: str, tolerance: str) -> DataFrame:
    """Claimed numbers looked up again: ok, drifted, unresolved (no evidence) or error (no number where a tolerance asks for one)."""
    e = evidence.select(key, F.col(value).alias("_got"))
    got, want = F.col("_got").try_cast("double"), F.col(value).try_cast("double")
    near = F.when(got.isNull() | want.isNull(), F.lit("error")).when(F.abs(got - want) <= F.col(tolerance), F.lit("ok")).otherwise(F.lit("drifted"))
    state = F.when(F.col("_got").isNull(), F.lit("unresolved")).when(F.col(tolerance).isNotNull(), near).when(F.trim("_got") == F.trim(value), F.lit("ok")).otherwise(F.lit("drifted"))
    return claims.join(e, key, "left").withColumn("state", state).drop("_got")


def complete_linkage(distances: dict[tuple[int, int], float], n: int, k: int) -> list[list[int]]:
    """Clusters of ``n`` items (a table that fits a report): the two whose farthest members are nearest are merged until ``k`` are left,
    ties to the first."""
    clusters = [[i] for i in range(n)]
    far = lambda a, b: max(distances[min(i, j), max(i, j)] for i in a for j in b)
    while len(clusters) > k:
        _, i, j = min((far(clusters[i], clusters[j]), i, j) for i in range(len(clusters)) for j in range(i + 1, len(clusters)))
        clusters[i] += clusters.pop(j)
    return clusters


def cluster_profiles(rows: DataFrame, key: str, features: list[str], k: int, most: int = 200) -> DataFrame:
    """(key, cluster) of up to ``most`` rows of a report by complete linkage over standardised features; more rows are an error."""
    scale = rows.agg(*(F.struct(F.avg(f).alias("m"), F.stddev_pop(f).alias("s")).alias(f) for f in features)).first()
    got = rows.select(key, *features).orderBy(key).limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} rows to cluster")
    z = [[(r[f] - scale[f]["m"]) / (scale[f]["s"] or 1.0) for f in features] for r in got]
    d = {(i, j): sum((a - b) ** 2 for a, b in zip(z[i], z[j])) ** 0.5 for i in range(len(z)) for j in range(i + 1, len(z))}
    clusters = sorted(sorted(c) for c in complete_linkage(d, len(z), min(k, len(z))))
    return rows.sparkSession.createDataFrame([(got[i][key], c) for c, members in enumerate(clusters) for i in members], f"`{key}` {dict(rows.dtypes)[key]}, cluster int")
