"""Queue and promotion state as folds of event tables: claims, leases, retirement, versions written with compare-and-set, commits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import drop, written


def job_states(events: DataFrame, job: str, seq: str, kind: str, ts: str, lease_seconds: int, most_attempts: int, now: Column) -> DataFrame:
    """State of each job after its events in order of ``seq`` (claim, renew, fail, done): queued, leased, stale (its lease has passed),
    dead (failed, or stale, on its last attempt) or done, with attempts and the lease's end.

    Only the last event and the number of claims decide, so it is one partial aggregation."""
    a = events.groupBy(job).agg(F.count_if(F.col(kind) == "claim").alias("attempts"), F.max(F.struct(seq, kind, ts)).alias("_l"))
    until = F.timestamp_seconds(F.unix_seconds(F.col(f"_l.{ts}").cast("timestamp")) + lease_seconds)
    last, spent = F.col(f"_l.{kind}"), F.col("attempts") >= most_attempts
    late = until <= now.cast("timestamp")
    state = F.when(last == "done", F.lit("done")).when((last == "fail") & spent, F.lit("dead")).when(last == "fail", F.lit("queued")).when(late & spent, F.lit("dead")).when(late, F.lit("stale")).otherwise(F.lit("leased"))
    return a.select(job, state.alias("state"), "attempts", F.when(last.isin("claim", "renew"), until).alias("lease_until"))


def fenced(events: DataFrame, job: str, seq: str, kind: str, token: str) -> DataFrame:
    """Events with ``lease``, the number of the claim in force, and ``outcome``: accepted, stale-token (it presents another lease), released
    (its lease has ended: failed, done or refused before), not-dead (a reopening of a job that isn't), or no-lease.

    Kinds: claim, renew, fail, done, refuse, reopen. A claim starts a lease; a reopening needs none but a job that was refused, or that
    failed on the lease in force. The lease in force is the number of claims so far, so one ordered pass over a job decides."""
    w = Window.partitionBy(job).orderBy(seq)
    numbered = events.withColumn("lease", F.count_if(F.col(kind) == "claim").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ends = F.col(kind).isin("fail", "done", "refuse") & (F.col(token) == F.col("lease"))
    before = Window.partitionBy(job, "lease").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    first = F.first(F.when(ends, F.col(kind)), ignorenulls=True).over(before)
    j = numbered.withColumn("_end", first)
    outcome = (
        F.when(F.col(kind) == "claim", "accepted").when(F.col(kind) == "reopen", F.when(F.col("_end").isin("fail", "refuse"), "accepted").otherwise("not-dead")).when(F.col("lease") == 0, "no-lease")
        .when(~F.coalesce(F.col(token) == F.col("lease"), F.lit(False)), "stale-token").when(F.col("_end").isNotNull(), "released").otherwise("accepted")
    )
    return j.withColumn("outcome", outcome).drop("_end")


def claim(jobs: DataFrame, n: int, most_attempts: int, job: str = "job_id") -> DataFrame:
    """What a claim of ``n`` jobs does, in the queue's order: fewest pages first (unknown last), then enqueued, then first page (null
    first), then id. Books on the way are refused, jobs without an attempt left are dead; neither counts.

    jobs: job_id, state, expired, pages, enqueued_at, page_start, is_book, attempts. The n first are a distributed top-n; the
    rest of the walk is what stands before the last of them."""
    place = F.struct(F.col("pages").isNull().alias("a"), F.col("pages").alias("b"), F.col("enqueued_at").alias("c"), F.col("page_start").isNotNull().alias("d"), F.col("page_start").alias("e"), F.col(job).alias("f"))
    outcome = F.when(F.col("is_book"), F.lit("refused")).when(F.col("attempts") >= most_attempts, F.lit("dead")).otherwise(F.lit("claimed"))
    ready = jobs.filter((F.col("state") == "queued") | ((F.col("state") == "leased") & F.col("expired"))).select(job, outcome.alias("outcome"), place.alias("_p"))
    first = ready.filter("outcome = 'claimed'").orderBy("_p").limit(n)
    end = first.agg(F.max("_p").alias("_end"), F.count(F.lit(1)).alias("_n"))  # one row
    others = ready.filter("outcome <> 'claimed'").join(F.broadcast(end)).filter((F.col("_n") < n) | (F.col("_p") <= F.col("_end")))
    return first.select(job, "outcome").unionByName(others.select(job, "outcome"))


def retirement(runs: DataFrame, current: DataFrame, ever_current: DataFrame, cited: DataFrame, retired: DataFrame, keys: DataFrame) -> DataFrame:
    """What stands against retiring each run: current, evidence, already-retired, not-superseded, or null; and what supersedes it.

    runs: run_id, file_id, stage, status, created_at, key; current: file_id, current_run; ever_current, cited, retired: run_id; keys:
    stage, key, the versions in force. A run that was current is superseded by its file's current run of its stage; any other by the
    newest later run of its file and stage at the key in force, if its own key is another."""
    flag = lambda d, name: d.select("run_id").distinct().withColumn(name, F.lit(True))
    n_cited = cited.select("run_id", "evidence_id").distinct().groupBy("run_id").agg(F.count(F.lit(1)).alias("evidence_rows"))
    r = runs.join(current, "file_id", "left").join(flag(ever_current, "_was"), "run_id", "left").join(n_cited, "run_id", "left").join(flag(retired, "_gone"), "run_id", "left")
    now = runs.filter("status = 'ok'").select(F.col("run_id").alias("current_run"), F.col("stage").alias("_stage"))
    r = r.join(now, "current_run", "left")
    newer = runs.filter("status = 'ok'").join(keys, ["stage", "key"], "left_semi").select("file_id", "stage", F.col("run_id").alias("_new"), F.col("created_at").alias("_at"), F.col("key").alias("_key"))
    newest = newer.groupBy("file_id", "stage", "_key").agg(F.max(F.struct("_at", "_new")).alias("_t"))  # of each key; of another key than a run's own it is the first or the second
    two = newest.groupBy("file_id", "stage").agg(F.max(F.struct("_t", "_key")).alias("_first")).join(newest, ["file_id", "stage"], "left").filter("_key <> _first._key OR _t = _first._t")
    two = two.groupBy("file_id", "stage").agg(F.any_value("_first").alias("_first"), F.max(F.when(F.col("_key") != F.col("_first._key"), F.col("_t"))).alias("_second"))
    best = F.when(F.col("_first._key") != F.col("key"), F.col("_first._t")).otherwise(F.col("_second"))
    r = r.join(two, ["file_id", "stage"], "left").withColumn("_b", F.when(best["_at"] > F.col("created_at"), best))
    by_current = F.when((F.col("current_run") != F.col("run_id")) & (F.col("_stage") == F.col("stage")), F.col("current_run"))
    superseded = F.when(F.col("status") != "ok", F.lit(None)).when(F.col("_was"), by_current).otherwise(F.col("_b._new"))
    refusal = F.when(F.col("current_run") == F.col("run_id"), F.lit("current")).when(F.col("evidence_rows") > 0, F.lit("evidence")).when(F.col("_gone"), F.lit("already-retired")).when(superseded.isNull(), F.lit("not-superseded"))
    return r.select("run_id", F.coalesce("evidence_rows", F.lit(0)).cast("long").alias("evidence_rows"), superseded.alias("superseded_by"), refusal.alias("refusal"))


def write_versions(heads: DataFrame, proposals: DataFrame) -> DataFrame:
    """Outcome of each proposal: accepted if its base was the head when its turn came, with the number it got; else conflict.

    heads: id, head, version_no; proposals: id, seq, base, version; (id, seq) is unique. After an accepted version the next one is
    the first later proposal that is based on it, whatever comes between: one edge a proposal. What is reached from the head is found
    by doubling those edges, so an identity of a million versions takes twenty rounds."""
    offers = proposals.select("id", F.col("base").alias("_key"), "seq", F.lit(1).alias("_offer"))
    asks = proposals.select("id", F.col("version").alias("_key"), "seq", F.lit(0).alias("_offer"))
    starts = heads.select("id", F.col("head").alias("_key"), F.lit(None).cast("long").alias("seq"), F.lit(0).alias("_offer"))
    later = Window.partitionBy("id", "_key").orderBy(F.asc_nulls_first("seq"), F.desc("_offer")).rowsBetween(1, Window.unboundedFollowing)
    edges = asks.unionByName(starts).unionByName(offers).withColumn("_next", F.first(F.when(F.col("_offer") == 1, F.col("seq")), ignorenulls=True).over(later)).filter("_offer = 0 AND _next IS NOT NULL")
    edges = written(edges.select("id", "seq", F.col("_next").alias("next")), "version-edges")
    jump = written(edges.filter("seq IS NOT NULL"), "version-jumps")
    reached = written(edges.filter("seq IS NULL").select("id", F.col("next").alias("seq"), F.lit(1).cast("long").alias("depth")), "version-reached")
    step = 1
    while True:
        more = written(reached.join(jump, ["id", "seq"]).select("id", F.col("next").alias("seq"), (F.col("depth") + step).alias("depth")), "version-more")
        if not more.limit(1).count():
            break
        before, reached = reached, written(reached.unionByName(more), "version-reached")
        further = jump.alias("a").join(jump.alias("b"), (F.col("a.id") == F.col("b.id")) & (F.col("a.next") == F.col("b.seq"))).select("a.id", "a.seq", F.col("b.next").alias("next"))
        old, jump = jump, written(further, "version-jumps")
        drop(before, more, old)
        step *= 2
    drop(edges, jump, more)
    got = reached.join(heads.select("id", "version_no"), "id").select("id", "seq", (F.col("version_no") + F.col("depth")).alias("version_no"))
    return proposals.join(got, ["id", "seq"], "left").select("id", "seq", F.when(F.col("version_no").isNull(), F.lit("conflict")).otherwise(F.lit("accepted")).alias("outcome"), "version_no")


def commit(identities: DataFrame, prepared: DataFrame) -> DataFrame:
    """Pointers after prepared chains are applied: a chain moves the pointer if its base is still the pointer; else it conflicts.

    identities: id, pointer; prepared: id, base, head (one a row)."""
    j = identities.join(prepared, "id", "left")
    ok = F.col("base").eqNullSafe(F.col("pointer"))
    return j.select("id", F.when(F.col("head").isNotNull() & ok, F.col("head")).otherwise(F.col("pointer")).alias("pointer"), F.when(F.col("head").isNull(), F.lit("kept")).when(ok, F.lit("moved")).otherwise(F.lit("conflict")).alias("outcome"))


def rebase(chain: DataFrame, identities: DataFrame, key: Column) -> DataFrame:
    """Held chains copied onto the identities' present pointers: new version ids from ``key``, each based on the copy before it, the first
    on the pointer. chain: id, version, depth (0 is the head)."""
    w = Window.partitionBy("id").orderBy(F.desc("depth"))
    c = chain.withColumn("_new", key).withColumns({"_before": F.lag("_new").over(w), "step": F.row_number().over(w)})
    return c.join(identities.select("id", "pointer"), "id").select("id", "version", F.col("_new").alias("copy"), F.coalesce("_before", F.col("pointer").cast("string")).alias("based_on"), "step")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows without those that new ones replace, and the new ones."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*old.columns))


def newest(rows: DataFrame, group: str, order: list[Column], limit: int, state: Column | None = None) -> DataFrame:
    """A page of each group: its ``limit`` first rows in ``order``, of one state if asked."""
    rows = rows if state is None else rows.filter(state)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("place") <= limit)


def evidence_status(evidence: DataFrame, blocks: DataFrame, files: DataFrame) -> DataFrame:
    """Evidence with run_is_current and promotable: verified, and anchored in its file's current run; unknown counts as no."""
    j = evidence.join(blocks, "block_id").join(files, "file_id")
    here = F.col("run_id") == F.col("current_run")
    return j.withColumns({"run_is_current": F.coalesce(here, F.lit(False)), "promotable": F.coalesce(F.col("verified") & here, F.lit(False))})


def request_status(requests: DataFrame, status: DataFrame) -> DataFrame:
    """Requests as contradicted, confirmed, unconfirmed (a work is known) or open, by the promotable evidence of their uses.

    requests: request_id, work_id; status: request_id, stance, promotable."""
    n = status.filter("promotable").groupBy("request_id").agg(F.count_if(F.col("stance") == "supports").alias("n_confirming"), F.count_if(F.col("stance") == "refutes").alias("n_contradicting"))
    j = requests.join(n, "request_id", "left").na.fill(0, ["n_confirming", "n_contradicting"])
    state = F.when(F.col("n_contradicting") > 0, F.lit("contradicted")).when(F.col("n_confirming") > 0, F.lit("confirmed")).when(F.col("work_id").isNotNull(), F.lit("unconfirmed")).otherwise(F.lit("open"))
    return j.select("request_id", "n_confirming", "n_contradicting", state.alias("resolution_state"))
