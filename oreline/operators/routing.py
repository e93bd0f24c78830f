"""Routing rules: classes of pages and files, outcomes of attempts, fused verdicts, ownership of stored files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Codes that may pass by waiting, codes by which a host refuses, statuses of success.
TRANSIENT, REFUSING, SUCCESS = [0, 408, 429], [202, 403, 429, 503], ["ok", "measured", "duplicate-held"]


def page_class(chars: Column, image_share: Column, cover: float = 0.25, trace: int = 100, body: int = 400) -> Column:
    """A page whose raster covers it is image-only, partial or text by its characters; any other is empty or text."""
    covered = F.when(chars < trace, F.lit("image-only")).when(chars < body, F.lit("partial")).otherwise(F.lit("text"))
    return F.when(image_share >= cover, covered).when(chars == 0, F.lit("empty")).otherwise(F.lit("text"))


def file_routes(pages: DataFrame, files: DataFrame, file: str, kind: str, cover_sheet: str, unreadable: str, scan_share: float = 0.5) -> DataFrame:
    """Route of each file: unreadable (or without pages), scan where the share of pages that need recognition reaches ``scan_share``,
    mixed where any does, cover-sheet, native; is_scan tells whether image pages outnumber text pages."""
    needs = F.col(kind).isin("image-only", "partial")
    n = pages.groupBy(file).agg(F.count(F.lit(1)).alias("_n"), F.count_if(needs).alias("_ocr"), F.count_if(F.col(kind) == "image-only").alias("_images"), F.count_if(F.col(kind) == "text").alias("_text"))
    j = files.join(n, file, "left")
    route = (
        F.when(F.col(unreadable) | F.col("_n").isNull(), F.lit("unreadable")).when((F.col("_ocr") > 0) & (F.col("_ocr") / F.col("_n") >= scan_share), F.lit("scan"))
        .when(F.col("_ocr") > 0, F.lit("mixed")).when(F.col(cover_sheet), F.lit("cover-sheet")).otherwise(F.lit("native"))
    )
    return j.select(file, route.alias("route"), F.coalesce(F.col("_images") > F.col("_text"), F.lit(False)).alias("is_scan"))


def attempt_class(status: Column, codes: Column) -> Column:
    """success, refusal, transient or neutral: a blocked attempt is never transient, else the last code decides about waiting."""
    last = F.try_element_at(codes, F.lit(-1))
    waits = last.isin(TRANSIENT) | ((last >= 500) & (last <= 599))
    refused = F.arrays_overlap(codes, F.lit(REFUSING))
    return F.when(status.isin(SUCCESS), F.lit("success")).when(status == "blocked", F.lit("refusal")).when(waits, F.lit("transient")).when(refused, F.lit("refusal")).otherwise(F.lit("neutral"))


def blocked_type(codes: Column, body: Column, challenged: Column, tried: Column, route: Column) -> Column:
    """struct(sub_status, basis) of a blocked attempt, strongest evidence first: a challenge in the bytes, the route's own rule, the
    last code, kept bytes, the route's word, any code; nulls where nothing tells."""
    last = F.try_element_at(codes, F.lit(-1))
    seen = F.when(body, F.lit("bytes")).otherwise(F.lit("detail"))
    kind = lambda name, basis: F.struct(F.lit(name).alias("sub_status"), (F.lit(basis) if isinstance(basis, str) else basis).alias("basis"))
    has = lambda code: F.array_contains(codes, code)
    return (
        F.when(challenged, kind("challenge_or_bot_check", "bytes")).when(route == "open_access", kind("challenge_or_bot_check", "inferred"))
        .when(last == 401, kind("identity_required", seen)).when(last.isin(404, 410), kind("not_found", seen))
        .when(body & (last == 403), kind("identity_required", "bytes")).when(body, kind("html_or_reader", "bytes"))
        .when(F.exists(tried, lambda t: t.endswith("=blocked")), kind("challenge_or_bot_check", "inferred"))
        .when(has(200), kind("html_or_reader", "inferred")).when(has(403), kind("challenge_or_bot_check", "inferred"))
        .otherwise(F.struct(F.lit(None).cast("string").alias("sub_status"), F.lit(None).cast("string").alias("basis")))
    )


def pacing(rows: DataFrame, key: str, order: list[str], kind: str, codes: str, decay: float = 1.0, times: float = 2.0, ceiling: float = 300.0) -> DataFrame:
    """Delay of each key after its last answer: a transient one multiplies it (from ``decay`` up to ``ceiling``), a success, or any
    other answer with a code of 2xx, takes ``decay`` off, down to 0. The fold runs over a key's answers in order."""
    fine = F.exists(F.coalesce(F.col(codes), F.array().cast("array<int>")), lambda c: c.between(200, 299))
    step_of = F.when(F.col(kind) == "transient", F.col(kind)).when((F.col(kind) == "success") | F.coalesce(fine, F.lit(False)), F.lit("success")).otherwise(F.col(kind))
    answers = rows.withColumn("_step", step_of).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, "_step"))), lambda x: x["_step"]).alias("_q"))
    step = lambda d, k: F.when(k == "transient", F.least(F.lit(ceiling), F.greatest(d, F.lit(decay)) * times)).when(k == "success", F.greatest(F.lit(0.0), d - decay)).otherwise(d)
    return answers.select(key, F.size("_q").alias("answers"), F.aggregate("_q", F.lit(0.0), step).alias("delay_s"))


def record_verdict(built: Column, year: Column) -> Column:
    """What a record alone says about a structure in a year: present, build_year, pre_build; unknown without a date."""
    return F.when(built.isNull(), F.lit("unknown")).when(built <= year - 1, F.lit("present")).when(built == year, F.lit("build_year")).otherwise(F.lit("pre_build"))


def fused_verdict(record: Column, probe: Column) -> Column:
    """struct(final, rule, disagreement) of a record's verdict and a probe's (present, absent, uncertain or unavailable)."""
    say = lambda final, rule, dis="": F.struct(*(x.alias(n) for x, n in zip((F.lit(x) if isinstance(x, str) else x for x in (final, rule, dis)), ("final", "rule", "disagreement"))))
    window = record.isin("build_year", "pre_build")
    early = F.when(record == "pre_build", F.lit("disagree_probe_present")).otherwise(F.lit(""))
    return (
        F.when((record == "present") & (probe == "absent"), say("uncertain", "disagree", "disagree_probe_absent")).when(record == "present", say("present", "assessor_backbone"))
        .when(window & (probe == "present"), say("present", "probe", early)).when(window & (probe == "absent"), say("absent", "probe_confirms_record"))
        .when(record == "pre_build", say("absent", "assessor_prebuild_weak")).when(window, say("uncertain", "build_year_undecided"))
        .when(probe.isin("present", "absent"), say(probe, "probe_only")).otherwise(say("uncertain", "no_evidence"))
    )


def ownership(files: DataFrame, digests: DataFrame, paths: DataFrame, digest: str, path: str, locked: str, age_hours: str, least_hours: float) -> DataFrame:
    """Each file as owned (by its digest, else by its path), young (held open or under the age), or orphan."""
    d = digests.select(digest).distinct().withColumn("_d", F.lit(True))
    p = paths.select(path).distinct().withColumn("_p", F.lit(True))
    rule = F.when(F.col("_d"), F.lit("digest")).when(F.col("_p"), F.lit("path")).when(F.col(locked), F.lit("lock")).when(F.col(age_hours) < least_hours, F.lit("age")).otherwise(F.lit("none"))
    verdict = F.when(rule.isin("digest", "path"), F.lit("owned")).when(rule.isin("lock", "age"), F.lit("young")).otherwise(F.lit("orphan"))
    return files.join(d, digest, "left").join(p, path, "left").withColumns({"rule": rule, "verdict": verdict}).drop("_d", "_p")


def link_payloads(payloads: DataFrame, attempts: DataFrame, files: DataFrame) -> DataFrame:
    """Each payload (path, digest) with the attempt that names its path, else the only attempt of its digest, and the only file of its
    digest; several candidates link nothing and are listed.

    attempts: attempt_id, digest, path; files: file_id, digest."""
    by_digest = attempts.groupBy("digest").agg(F.array_sort(F.collect_set("attempt_id")).alias("_all"))
    exact = attempts.groupBy("digest", "path").agg(F.min("attempt_id").alias("_exact"))
    held = files.groupBy("digest").agg(F.array_sort(F.collect_set("file_id")).alias("_files"))
    j = payloads.join(by_digest, "digest", "left").join(exact, ["digest", "path"], "left").join(held, "digest", "left")
    pick = F.coalesce("_exact", F.when(F.size("_all") == 1, F.col("_all")[0]))
    return j.select("path", "digest", pick.alias("attempt_id"), F.when(pick.isNull(), F.size("_all")).otherwise(0).alias("n_attempts"), F.when(F.size("_files") == 1, F.col("_files")[0]).alias("file_id")).withColumn("n_attempts", F.greatest(F.col("n_attempts"), F.lit(0)))


def without(rows: DataFrame, key: list[str], *others: DataFrame) -> DataFrame:
    """Rows whose key is in none of the other tables: chained anti joins."""
    for other in others:
        rows = rows.join(other.select(*key).distinct(), key, "left_anti")
    return rows
