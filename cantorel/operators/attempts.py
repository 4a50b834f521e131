"""The attempt log: latest states, numbering, history checks, selection and blockers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantorel.functions import rules

# Download statuses, those that end a source, and the detail codes of each.
STATUSES = (
    "not_started", "retryable", "human_verification_required", "membership_wait_pending", "copyright_restricted", "region_restricted",
    "membership_required", "login_required", "commercial_only", "deleted", "manual_review", "downloaded_verified", "source_override_verified",
)
TERMINAL = (
    "downloaded_verified", "source_override_verified", "login_required", "copyright_restricted", "region_restricted", "membership_required",
    "commercial_only", "deleted",
)
DETAILS = {
    "retryable": ("transport_retryable", "http_retryable", "stream_interrupted", "disk_full", "permission_denied", "target_unavailable", "process_interrupted", "retry_exhausted"),
    "manual_review": (
        "unapproved_source", "unapproved_redirect", "not_a_pdf", "http_unexpected", "size_mismatch", "sha1_mismatch", "sha256_mismatch", "pdf_invalid",
        "source_metadata_conflict", "source_override_invalid",
    ),
    "downloaded_verified": ("verified", "source_hash_review_pending", "source_hash_review_resolved"),
}
WAITING, BREAKER, RETRY = "membership_wait_pending", "human_verification_required", "retryable"


def allowed_detail(status: Column, detail: Column) -> Column:
    """Whether a detail code belongs to a status; statuses without a list of their own have their name as the only one."""
    out = detail == status
    for name, codes in DETAILS.items():
        out = F.when(status == name, detail.isin(*codes)).otherwise(out)
    return out

def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key, by a hash aggregate instead of a sort."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(whole, F.struct(*order)).alias("r")).select("r.*")


def after_terminal(rows: DataFrame, key: str, order: list[str], terminal: Column) -> DataFrame:
    """``rows`` with a flag: whether a terminal row of the key came before."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("__end", terminal).withColumn("after_terminal", F.coalesce(F.max("__end").over(w), F.lit(False))).drop("__end")


def next_numbers(log: DataFrame) -> DataFrame:
    return log.groupBy("source_id").agg((F.max("attempt_number") + 1).alias("next_number"))


def violations(log: DataFrame) -> DataFrame:
    """What is wrong in a log (source_id, attempt_number, started_at, completed_at, status, retry_after)."""
    w = Window.partitionBy("source_id").orderBy("attempt_number")
    rows = after_terminal(log, "source_id", ["attempt_number"], F.col("status").isin(*TERMINAL))
    rows = rows.select(
        "source_id", "attempt_number", "started_at", "completed_at", "status", "after_terminal",
        F.coalesce(F.lag("attempt_number").over(w), F.lit(0)).alias("before"), F.lag("completed_at").over(w).alias("ended"),
        F.lag("status").over(w).alias("was"), F.lag("retry_after").over(w).alias("wait"),
    )
    key, n = F.col("source_id"), F.col("attempt_number")
    waited = (F.col("was") == WAITING) & (F.col("started_at") < F.col("ended") + F.make_dt_interval(secs=F.col("wait")))
    return rules.report([
        rules.violation(rows.filter("attempt_number <> before + 1"), "number_not_contiguous", key, n),
        rules.violation(rows.filter("started_at < ended"), "started_before_previous_end", key, n),
        rules.violation(rows.filter("completed_at < started_at"), "ended_before_start", key, n),
        rules.violation(rows.filter("after_terminal"), "attempt_after_terminal", key, n),
        rules.violation(rows.filter(waited), "wait_not_respected", key, n),
        rules.violation(rows.filter(~F.col("status").isin(*STATUSES)), "unknown_status", key, F.col("status")),
    ])


def targets(rows: DataFrame) -> DataFrame:
    """One row a source from (source_id, category_name, membership_id): each is fetched once for all its memberships."""
    return rows.groupBy("source_id").agg(F.array_sort(F.collect_set(F.struct("category_name", "membership_id"))).alias("associations"))


def restored(groups: DataFrame, log: DataFrame) -> DataFrame:
    """Targets with the associations that their last attempt (category_names, membership_ids) had, beside those asked for."""
    pairs = F.zip_with("category_names", "membership_ids", lambda c, m: F.struct(c.alias("category_name"), m.alias("membership_id")))
    had = latest(log, "source_id", ["attempt_number"]).select("source_id", pairs.alias("__had"))
    both = F.array_sort(F.array_union("associations", F.coalesce("__had", F.array().cast("array<struct<category_name:string,membership_id:string>>"))))
    return groups.join(had, "source_id", "left").withColumn("associations", both).drop("__had")


def selected(groups: DataFrame, log: DataFrame, now: Column, categories: list[str] | None = None, statuses: list[str] | None = None, sources: list[str] | None = None, max_attempts: int = 3, limit: int | None = None) -> DataFrame:
    """The sources a batch starts, in order: neither ended nor waiting nor exhausted; the limit counts only these."""
    last = latest(log, "source_id", ["attempt_number"])
    rows = groups.join(last.select("source_id", "attempt_number", "status", "completed_at", "retry_after"), "source_id", "left")
    rows = rows.withColumn("status", F.coalesce("status", F.lit("not_started")))
    if categories is not None:
        rows = rows.filter(F.exists("associations", lambda a: a["category_name"].isin(categories)))
    if sources is not None:
        rows = rows.filter(F.col("source_id").isin(sources))
    if statuses is not None:
        rows = rows.filter(F.col("status").isin(statuses))
    waits = (F.col("status") == WAITING) & (now < F.col("completed_at") + F.make_dt_interval(secs=F.col("retry_after")))
    rows = rows.filter(~F.col("status").isin(*TERMINAL, "manual_review") & ~F.coalesce(waits, F.lit(False)) & (F.coalesce("attempt_number", F.lit(0)) < max_attempts))
    rows = rows.orderBy("source_id")
    return rows.limit(limit) if limit is not None else rows


def outcome(status: Column, attempts_made: Column, max_attempts: int) -> Column:
    """The detail code an attempt leaves: a retryable one is the last at the limit."""
    return F.when((status == RETRY) & (attempts_made >= max_attempts), "retry_exhausted").otherwise(status)


def recovered(log: DataFrame) -> DataFrame:
    """After a crash, attempts that never ended count as retryable."""
    open_ = F.col("completed_at").isNull()
    return log.withColumn("status", F.when(open_, RETRY).otherwise(F.col("status"))).withColumn("completed_at", F.coalesce("completed_at", "started_at"))


def breaker(rows: DataFrame, batch: str, order: list[str]) -> DataFrame:
    """``rows`` with ``skipped``: whether a human-verification answer earlier in the batch stopped it."""
    return after_terminal(rows, batch, order, F.col("status") == BREAKER).withColumnRenamed("after_terminal", "skipped")


def blockers(log: DataFrame, now: Column) -> DataFrame:
    """Distinct reasons why a run isn't complete, sorted, as one row's array.

    Of each source in the log (source_id, attempt_number, phase, status, completed_at, retry_after
    in seconds, review_status) the last attempt counts; sources without an attempt don't.
    """
    over = F.col("retry_after").isNotNull() & (now >= F.col("completed_at") + F.make_dt_interval(secs=F.col("retry_after")))
    pending = F.coalesce(F.col("review_status") == "pending", F.lit(False))
    reason = rules.first_match([
        (F.coalesce(F.col("phase") != "finished", F.lit(True)), "download_incomplete"),
        ((F.col("status") == WAITING) & F.coalesce(over, F.lit(False)), "membership_wait_elapsed_unretried"), (F.col("status") == WAITING, "membership_wait_pending"),
        ((F.col("status") == "downloaded_verified") & pending, "source_hash_review_pending"), ((F.col("status") == "manual_review") & pending, "manual_review_pending"),
    ])
    return latest(log, "source_id", ["attempt_number"]).agg(F.array_sort(F.collect_set(reason)).alias("blockers"))


def resolve_reviews(log: DataFrame, reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A log with reviewed sources' last rows set to the reviewed status, and reviews that match no open source."""
    last = latest(log, "source_id", ["attempt_number"]).filter("status = 'manual_review'").select("source_id", "attempt_number")
    ok = reviews.join(last, "source_id").select("source_id", "attempt_number", F.col("status").alias("__status"))
    out = log.join(ok, ["source_id", "attempt_number"], "left").withColumn("status", F.coalesce("__status", "status")).drop("__status")
    return out, reviews.join(last, "source_id", "left_anti")


# Phrases of access pages by the status they mean, in the order in which they are tried.
ACCESS_PAGES = (
    ("human_verification_required", "verify you are human|captcha|bot check"),
    ("login_required", "please log in|login required"),
    ("membership_wait_pending", "(?:continue|download).*?[0-9]+\\s*seconds"),
    ("membership_required", "members only|membership required"),
    ("copyright_restricted", "copyright restricted|not public domain"),
    ("region_restricted", "not available in your country|regional restriction"),
    ("commercial_only", "available for purchase|commercial edition"),
    ("deleted", "file has been deleted"),
)


def access_status(body: Column) -> Column:
    """(status, detail, wait_seconds) of an access page; a page of no known kind goes to manual review."""
    low = F.lower(body)
    status = rules.first_match([(low.rlike(f"(?s){p}"), s) for s, p in ACCESS_PAGES], "manual_review")
    seconds = F.regexp_extract(low, r"(?s)(?:continue|download).*?([0-9]+)\s*seconds", 1)
    return F.struct(
        status.alias("status"), F.when(status == "manual_review", "not_a_pdf").otherwise(status).alias("detail"),
        F.when(status == WAITING, seconds.cast("int")).alias("wait_seconds"),
    )
