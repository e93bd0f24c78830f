"""Logs of job queues, read as a state machine whose state is carried over chunks of lines: no log is one task, however long."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

# The line formats of the queue's logs.
JOB = r"^  JOB (\S+)  \(year (\S+), tag (\S+)\)$"
COMMAND = r"^  \$ (.*)$"
EXIT = r"^  \[(.+)/([a-z]+)\] exit=(\S+)  elapsed ([\d.]+) min\s*$"
TIMEOUT = r"^  ! TIMEOUT: (.+)/(\S+) exceeded (\d+) min"
INTERRUPT = r"^  ! (\S+)/(\S+) got a stray interrupt after ([\d.]+) min"
SKIP = r"^  - skip (.+)/(\S+) \(already OK\)\s*$"
REVERIFY = r"^  - (\S+)/(\S+) was left UNVERIFIED"
VERIFY = r"^  VERIFY(?::(\S+))? (\S+): (.*)$"
QUEUE = r"^  queue  : (\S+)\s*$"
STEP_LOG = r"^    \|\s+✓ log → (\S+)\s*$"
RUN_ID = r"^    \|\s+run_id: (\S+)"
UNPROVEN = " — COULD NOT CHECK THIS ARTIFACT, continuing UNPROVEN."
STATE = "^[A-Z][A-Z0-9_]*$"
KINDS = [("queue", QUEUE), ("job", JOB), ("command", COMMAND), ("step_log", STEP_LOG), ("run_id", RUN_ID), ("skip", SKIP), ("reverify", REVERIFY), ("exit", EXIT), ("timeout", TIMEOUT), ("interrupt", INTERRUPT), ("verify", VERIFY)]

GROUPS = {name: re.compile(p).groups for name, p in KINDS}


def carried(rows: DataFrame, key: str, order: str, columns: list[str], chunk: int = 100_000) -> DataFrame:
    """``columns`` with the last value of their key at or before each row.

    "The last value, if there is one" composes, so each chunk of ``chunk`` places is reduced to one row; these are carried over
    chunks, and each chunk starts from what came before it."""
    cut = rows.withColumn("_c", F.floor(F.col(order) / chunk))
    ends = cut.groupBy(key, "_c").agg(*(F.max(F.when(F.col(c).isNotNull(), F.struct(order, c)))[c].alias(c) for c in columns))
    before = Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)  # a row a chunk
    starts = ends.select(key, "_c", *(F.last(c, ignorenulls=True).over(before).alias(f"_from_{c}") for c in columns))
    inside = Window.partitionBy(key, "_c").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = cut.join(starts, [key, "_c"]).withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"_from_{c}")) for c in columns})
    return out.drop("_c", *(f"_from_{c}" for c in columns))


def _flag(command: Column, flag: str) -> Column:
    return F.regexp_extract(command, rf"--{flag}[= ](\S+)", 1)


def queue_log(lines: DataFrame, log: str, line: str, text: str, chunk: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """(events, notes) of logs: outcomes of commands and verdicts with what the log says about them, and what can't become an event.

    A command opens a block, the next command or job ends it; an outcome outside a block, a block without an outcome and a verdict
    without a state are notes, as are skipped steps."""
    is_ = lambda *k: F.col("kind").isin(*k)
    kind = F.coalesce(*(F.when(F.col("said").rlike(p), F.lit(name)) for name, p in KINDS))
    marked = lines.select(F.col(log).alias("log"), F.col(line).alias("line"), F.regexp_replace(text, r"[\r\n]+$", "").alias("said")).withColumn("kind", kind).filter("kind IS NOT NULL")
    part = lambda i: F.coalesce(*(F.when(is_(name), F.regexp_extract("said", p, i)) for name, p in KINDS if i <= GROUPS[name]))
    marked = marked.select("log", "line", "kind", F.trim("said").alias("said"), *(part(i).alias(f"g{i}") for i in range(1, 5)))
    marked = written(marked, "log-lines")  # patterns run once a line
    marked = marked.withColumns({
        "queue": F.when(is_("queue"), F.col("g1")), "header": F.when(is_("job"), F.struct(F.col("g1").alias("job"), F.col("g2").alias("year"), F.col("g3").alias("tag"))),
        "block": F.when(is_("job", "command"), F.struct(F.col("line"), F.when(is_("command"), F.col("g1")).alias("command"))),
    })
    state = carried(marked, "log", "line", ["queue", "header", "block"], chunk)
    inside, outcome = F.col("block.command").isNotNull(), is_("exit", "timeout", "interrupt")
    inside = F.coalesce(inside, F.lit(False))

    blocks = state.filter(inside).groupBy("log", F.col("block.line").alias("block_line")).agg(
        F.any_value("block.command").alias("command"), F.max(outcome).alias("ended"), F.min(F.when(is_("run_id"), F.struct("line", F.col("g1").alias("v"))))["v"].alias("run_id"),
        F.transform(F.array_sort(F.collect_list(F.when(is_("step_log"), F.struct("line", F.substring_index("g1", "/", -1).alias("v"))))), lambda s: s["v"]).alias("step_logs"),
    )

    rest = F.when(is_("verify"), F.col("g3"))
    cut = F.split(rest, F.when(F.instr(rest, UNPROVEN) > 0, F.lit(rf"\Q{UNPROVEN}\E")).otherwise(F.lit("  ")), 2)
    read = state.withColumns({"inside": inside, "cut": cut}).withColumns({"head": F.trim(F.col("cut")[0]), "tail": F.trim(F.coalesce(F.get("cut", F.lit(1)), F.lit("")))})
    told = F.col("head").rlike(STATE)
    verdict = is_("verify") & told
    pick = lambda e, t, i, v=None: F.when(is_("exit"), e).when(is_("timeout"), t).when(is_("interrupt"), i).otherwise(F.lit("") if v is None else v)
    head_of = lambda c: F.coalesce(F.col(f"header.{c}"), F.lit(""))
    events = read.filter((outcome & F.col("inside")) | verdict).join(blocks, (blocks["log"] == read["log"]) & (blocks["block_line"] == F.when(F.col("inside"), F.col("block.line"))), "left").select(
        read["log"], "line", F.when(outcome, "step").otherwise("verify").alias("kind"), F.coalesce("queue", F.lit("")).alias("queue"),
        F.when(outcome, F.col("g1")).otherwise(F.col("g2")).alias("job"),
        F.when(outcome, _flag(F.col("block.command"), "year")).otherwise(head_of("year")).alias("year"), F.when(outcome, _flag(F.col("block.command"), "run-tag")).otherwise(head_of("tag")).alias("tag"),
        F.when(outcome, F.col("g2")).when(F.col("g1") != "", F.concat(F.lit("VERIFY:"), "g1")).otherwise("VERIFY").alias("step"),
        pick(F.when(F.col("g3") == "0", "OK").otherwise("FAIL"), F.lit("TIMEOUT"), F.lit("INTERRUPTED"), F.col("head")).alias("state"),
        pick(F.col("g3"), F.lit("killed"), F.lit("sigint")).alias("exit"), pick(F.col("g4"), F.lit(""), F.col("g3")).alias("minutes"),
        F.when(verdict, F.col("tail")).otherwise("").alias("verdict"), "block_line", F.coalesce("run_id", F.lit("")).alias("run_id"), F.coalesce(F.size("step_logs"), F.lit(0)).alias("n_step_logs"), head_of("job").alias("header_job"),
    )

    note = F.when(is_("skip"), "resume_skip").when(is_("reverify"), "reverify_of_skipped_step").when(outcome & ~F.col("inside"), "outcome_without_block").when(is_("verify") & ~told, "verify_unparseable")
    detail = F.when(is_("skip", "reverify"), F.concat("g1", F.lit("/"), "g2")).otherwise(F.col("said"))
    notes = read.select("log", "line", note.alias("kind"), detail.alias("detail")).filter("kind IS NOT NULL")
    open_blocks = blocks.filter("NOT ended").select("log", F.col("block_line").alias("line"), F.lit("block_without_outcome").alias("kind"), F.col("command").alias("detail"))
    return events, notes.unionByName(open_blocks)
