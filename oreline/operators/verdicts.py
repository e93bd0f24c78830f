"""Ordered rules: the first rule that answers decides; rule tables as expressions, flags and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rule(rules: list[tuple[Column, str]], default: str) -> Column:
    out = None
    for test, verdict in rules:
        test = F.coalesce(test, F.lit(False))
        out = F.when(test, F.lit(verdict)) if out is None else out.when(test, F.lit(verdict))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def flags(rules: list[tuple[Column, str]]) -> Column:
    """Names of all rules that hold, in order; a rule on unknown values doesn't hold."""
    return F.array_compact(F.array(*(F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for test, name in rules)))


def severity(found: Column, levels: dict[str, int]) -> Column:
    """The greatest level of the flags found, 0 without any."""
    level = F.create_map(*(F.lit(x) for pair in levels.items() for x in pair))
    return F.coalesce(F.array_max(F.transform(found, lambda f: level[f])), F.lit(0))


def steps_verdict(steps: list[tuple[str, Column]]) -> Column:
    """struct(verdict, failed): the first step that fails, in order; a step on unknown values fails."""
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in steps)))
    return F.struct(F.when(F.size(failed) == 0, F.lit("accept")).otherwise(F.lit("refuse")).alias("verdict"), F.try_element_at(failed, F.lit(1)).alias("failed"))


def replacement(wins: Column, losses: Column, hard: Column) -> Column:
    """REJECT on a hard failure; REPLACE with a strict win and no loss; else COMPLEMENT."""
    return F.when(F.coalesce(hard, F.lit(False)), F.lit("REJECT")).when((wins >= 1) & (losses == 0), F.lit("REPLACE")).otherwise(F.lit("COMPLEMENT"))


def rollup_class(rows: DataFrame, group: str, label: str) -> DataFrame:
    """One class a group: the single one, ``mixed`` if members differ, null if a member has none."""
    a = rows.groupBy(group).agg(F.countDistinct(label).alias("_d"), F.count_if(F.col(label).isNull()).alias("_null"), F.min(label).alias("_c"), F.count(F.lit(1)).alias("members"))
    return a.select(group, "members", F.when(F.col("_null") > 0, F.lit(None)).when(F.col("_d") == 1, F.col("_c")).otherwise(F.lit("mixed")).alias("class"))


def queue_verdict(jobs: DataFrame, file: str, key: str, at: str, state: str, precedence: list[str]) -> DataFrame:
    """Per file, of the jobs at its most recently enqueued key, the state that comes first in ``precedence``."""
    last = jobs.groupBy(file).agg(F.max(F.struct(at, key)).alias("_m")).select(file, F.col(f"_m.{key}").alias(key))
    rank = F.array_position(F.array(*(F.lit(p) for p in precedence)), F.col(state))
    best = jobs.join(last, [file, key]).filter(rank > 0).groupBy(file).agg(F.min(rank).alias("_r"))
    return best.select(file, F.element_at(F.array(*(F.lit(p) for p in precedence)), F.col("_r").cast("int")).alias("verdict"))
