"""Task-status counts by run and the run-status decisions built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tribuna.functions import scalars as S
from tribuna.session import coalesce_empty

BUCKETS = ("queued", "running", "success", "failed", "poison", "pending", "stale")


def status_counts(state: DataFrame, *keys: str) -> DataFrame:
    """Eight status buckets plus record and page sums of the SUCCESS rows.

    A row counts for its current and for its last run, once when they are the
    same.  One shuffle with map-side partial sums.
    """
    runs = F.array_distinct(F.array_compact(F.array("current_pipeline_run_id", "last_pipeline_run_id")))
    status = F.upper(coalesce_empty(F.col("status")))
    rows = state.select(
        *keys, status.alias("status"), "record_count", "last_successful_page",
        F.explode(F.filter(runs, lambda r: r != "")).alias("pipeline_run_id"),
    )
    done = F.col("status") == "SUCCESS"

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(done, S.int_or_zero(F.col(name)))), F.lit(0))

    return rows.groupBy(*keys, "pipeline_run_id").agg(
        *[F.count_if(F.col("status") == b.upper()).alias(b) for b in BUCKETS],
        F.count_if(~F.col("status").isin(*[b.upper() for b in BUCKETS])).alias("other"),
        total("record_count").alias("record_count_sum"),
        total("last_successful_page").alias("pages_written_sum"),
    )


def total_seen() -> Column:
    out = F.col("other")
    for b in BUCKETS:
        out = out + F.col(b)
    return out


def _none(*names: str) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & (F.col(n) == 0)
    return cond


def expected_tasks_ceap(enqueue_done: Column, registry: Column, queued: Column, universe: Column) -> Column:
    """Bucket sum once enqueueing is over; before that the largest known estimate."""
    return F.when(enqueue_done, total_seen()).otherwise(F.greatest(queued, registry, universe))


def expected_tasks_domain(fanout_target: Column) -> Column:
    return F.greatest(fanout_target, total_seen())


def expected_from_registry(enqueue_done: Column, registry: Column) -> Column:
    return F.when(enqueue_done, total_seen()).otherwise(S.int_or_zero(registry.cast("string")))


def strict_completed(enqueue_done: Column, expected: Column) -> Column:
    """Everything expected succeeded and no other bucket holds a row."""
    return (
        enqueue_done & (expected > 0) & (F.col("success") == expected)
        & _none("failed", "pending", "poison", "running", "queued", "stale", "other")
    )


def run_status_ceap(enqueue_done: Column, expected: Column, queued_so_far: Column) -> Column:
    finished = _none("running", "queued", "pending", "stale", "other")
    clean = _none("failed", "poison", "running", "queued", "pending")
    bad = (F.col("failed") > 0) | (F.col("poison") > 0)
    return (
        F.when(enqueue_done & (expected > 0) & (F.col("success") == expected) & clean, F.lit("COMPLETED"))
        .when(enqueue_done & (expected == 0) & (queued_so_far == 0), F.lit("COMPLETED"))
        .when(enqueue_done & finished & bad & (F.col("success") > 0), F.lit("PARTIAL"))
        .when(enqueue_done & finished & bad, F.lit("FAILED"))
        .when(F.col("running") > 0, F.lit("RUNNING"))
        .when(enqueue_done, F.lit("QUEUED"))
        .otherwise(F.lit("QUEUING"))
    )


def enqueue_phase_complete(listing_done: Column, hit_cap: Column) -> Column:
    """A fixpoint: only a tick that sent nothing and found nothing in flight closes the phase.

    Reads ``n_fanout``, ``enqueued``, ``skipped_queued``, ``skipped_same_hash``.
    """
    decided = F.col("enqueued") + F.col("skipped_queued") + F.col("skipped_same_hash")
    quiet = (F.col("enqueued") == 0) & (F.col("skipped_queued") == 0)
    return F.when(F.col("n_fanout") == 0, listing_done).otherwise(
        listing_done & ~hit_cap & (decided >= F.col("n_fanout")) & quiet
    )


def run_status_domain(phase_done: Column, expected: Column) -> Column:
    """Hash-aware domains; an all-unchanged tick completes without running a task."""
    clean = _none("failed", "poison", "running", "queued", "pending")
    unchanged = phase_done & (F.col("n_fanout") > 0) & (F.col("skipped_same_hash") >= F.col("n_fanout"))
    return (
        F.when((phase_done & (expected == 0) & clean) | unchanged, F.lit("COMPLETED"))
        .when(phase_done & (expected > 0) & (F.col("success") >= expected) & clean, F.lit("COMPLETED"))
        .when((F.col("running") + F.col("queued") > 0) | (F.col("enqueued") > 0), F.lit("RUNNING"))
        .otherwise(F.lit("QUEUING"))
    )


def run_status_institucional(pages: Column, fanout_target: Column) -> Column:
    expected = expected_tasks_domain(fanout_target)
    phase = (
        (pages > 0) & (F.col("enqueued") == 0) & (F.col("skipped_queued") == 0) & (total_seen() >= fanout_target)
    )
    clean = _none("failed", "poison", "running", "queued", "pending")
    return (
        F.when(phase & (expected > 0) & (F.col("success") >= expected) & clean, F.lit("COMPLETED"))
        .when((F.col("running") + F.col("queued") > 0) | (F.col("enqueued") > 0), F.lit("RUNNING"))
        .otherwise(F.lit("QUEUING"))
    )


def run_status_reference(n_endpoints: int) -> Column:
    clean = _none("failed", "poison", "running", "queued", "pending")
    return (
        F.when((total_seen() >= n_endpoints) & (F.col("success") == n_endpoints) & clean, F.lit("COMPLETED"))
        .when(F.col("running") + F.col("queued") > 0, F.lit("RUNNING"))
        .otherwise(F.lit("QUEUING"))
    )


def merge_counters(runs: DataFrame, outcomes: DataFrame, now: Column, keys: list[str]) -> DataFrame:
    """Adds success / failed deltas of finished tasks to their runs and re-derives the status.

    ``outcomes`` has the keys and ``ok`` (boolean).  Deltas are summed before
    the join, so a run with most of the outcomes costs one row in it.
    """
    deltas = outcomes.groupBy(*keys).agg(
        F.count_if("ok").alias("d_ok"), F.count_if(~F.col("ok")).alias("d_bad")
    )
    joined = runs.join(deltas, keys)
    expected = S.int_or_zero(F.col("total_tasks_expected").cast("string"))
    target = F.when(expected > 0, expected).otherwise(S.int_or_zero(F.col("total_tasks_queued").cast("string")))
    ok = S.int_or_zero(F.col("total_tasks_success").cast("string")) + F.col("d_ok")
    bad = S.int_or_zero(F.col("total_tasks_failed").cast("string")) + F.col("d_bad")
    all_in = (target > 0) & (ok + bad >= target)
    new_status = (
        F.when(all_in & (bad == 0), F.lit("COMPLETED"))
        .when(all_in, F.lit("PARTIAL"))
        .when(ok + bad > 0, F.lit("RUNNING"))
        .otherwise(F.coalesce("status", F.lit("QUEUED")))
    )
    marked = (coalesce_empty(F.col("failed_at")) != "") | (F.trim(coalesce_empty(F.col("last_error"))) != "")
    recovered = (new_status == "COMPLETED") & (
        marked | F.upper(coalesce_empty(F.col("status"))).isin("FAILED", "PARTIAL")
    )
    kept = lambda n: F.when(new_status == "COMPLETED", F.lit("")).otherwise(F.col(n))
    return joined.select(
        *keys,
        ok.alias("total_tasks_success"), bad.alias("total_tasks_failed"), new_status.alias("status"),
        F.when(all_in, now).otherwise(F.col("completed_at")).alias("completed_at"),
        F.when(recovered, now).otherwise(F.col("last_recovered_at")).alias("last_recovered_at"),
        kept("failed_at").alias("failed_at"), kept("last_error").alias("last_error"),
    )


def reconcile_runs(state: DataFrame, runs: DataFrame, now: Column, keys: list[str]) -> DataFrame:
    """Runs re-derived from task state; recovery clears the failure marks.

    ``keys`` ends with ``pipeline_run_id``.  Runs without any state row keep
    zero counts.
    """
    counts = status_counts(state, *keys[:-1])
    names = [*BUCKETS, "other", "record_count_sum", "pages_written_sum"]
    joined = runs.join(counts, keys, "left").withColumns(
        {n: F.coalesce(F.col(n), F.lit(0).cast("bigint")) for n in names}
    )
    done = F.coalesce("enqueue_phase_complete", F.lit(False))
    joined = joined.withColumn("expected", expected_from_registry(done, F.col("total_tasks_expected")))
    joined = joined.withColumn("strict", strict_completed(done, F.col("expected")))
    old = F.upper(coalesce_empty(F.col("status")))
    recovering = F.col("strict") & (old != "COMPLETED")
    marked = (coalesce_empty(F.col("failed_at")) != "") | (coalesce_empty(F.col("last_error")) != "")
    status = F.when(F.col("strict"), F.lit("COMPLETED")).otherwise(
        F.when(old == "", F.lit("UNKNOWN")).otherwise(old)
    )
    bad = status.isin("FAILED", "PARTIAL", "PARTIALLY_COMPLETED")
    text = lambda n: F.when(coalesce_empty(F.col(n)) != "", F.col(n))
    finish = F.when(status == "COMPLETED", F.coalesce(text("completed_at"), F.when(F.col("strict"), now)))
    return joined.select(
        *keys, status.alias("status"), F.col("expected").alias("total_tasks_expected"), *names,
        finish.alias("completed_at"),
        F.when(bad, text("failed_at")).alias("failed_at"),
        F.when(recovering & (marked | old.isin("FAILED", "PARTIAL")), now).alias("last_recovered_at"),
        F.col("strict").alias("write_marker"),
    )
