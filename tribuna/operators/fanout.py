"""Fan-out plans: which (id, endpoint) pairs are dispatched in this tick.

Ids are paired with their endpoints by exploding a literal array, and the
state lookup is one left equi-join on the row key: both sides are unique on
it, so the join cannot multiply and adaptive execution picks its form by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tribuna import catalog
from tribuna.functions import scalars as S
from tribuna.functions import windows as W
from tribuna.session import coalesce_empty

IN_FLIGHT = ("QUEUED", "RUNNING")


def pair_with_endpoints(ids: DataFrame, endpoints) -> DataFrame:
    """Every id with every endpoint, ``seq`` keeping the endpoints' order."""
    names = F.array(*[F.lit(e) for e in endpoints])
    return ids.select("*", F.posexplode(names).alias("seq", "endpoint"))


def _state_columns(state: DataFrame, wanted: list[str]) -> DataFrame:
    have = [c for c in wanted if c in state.columns]
    return state.select("row_key", *[F.col(c).alias(f"s_{c}") for c in have], F.lit(True).alias("s_known"))


def with_state(pairs: DataFrame, state: DataFrame, columns: list[str]) -> DataFrame:
    return pairs.join(_state_columns(state, columns), "row_key", "left")


def _status() -> Column:
    return F.upper(coalesce_empty(F.col("s_status")))


def _same_run(run_id: Column) -> Column:
    return coalesce_empty(F.col("s_current_pipeline_run_id")) == run_id


def plan_hash_aware(ids: DataFrame, endpoints, state: DataFrame, run_id: str, force: bool = False) -> DataFrame:
    """Plan of the daily and reconciliation lists.

    ``skip_queued`` when this run already has the pair in flight,
    ``skip_same_hash`` when it succeeded on the same list item, else
    ``enqueue``.  ``ids`` has ``id`` and ``hash``.
    """
    run = F.lit(run_id)
    pairs = pair_with_endpoints(ids, endpoints).withColumn("row_key", S.state_key(F.col("endpoint"), F.col("id")))
    joined = with_state(pairs, state, ["status", "current_pipeline_run_id", "last_list_item_hash", "attempt_count"])
    item_hash = coalesce_empty(F.col("hash"))
    same_hash = (
        (_status() == "SUCCESS") & (item_hash != "")
        & (coalesce_empty(F.col("s_last_list_item_hash")) == item_hash)
    )
    action = F.when(_same_run(run) & _status().isin(*IN_FLIGHT), F.lit("skip_queued"))
    if not force:
        action = action.when(same_hash, F.lit("skip_same_hash"))
    return joined.withColumn("action", action.otherwise(F.lit("enqueue")))


def plan_votacoes(fingerprints: DataFrame, state: DataFrame, run_id: str) -> DataFrame:
    """Votes plan: unchanged needs both the uid and the hash to match."""
    run = F.lit(run_id)
    pairs = pair_with_endpoints(fingerprints, ("votacao_votos",)).withColumn(
        "row_key", S.state_key(F.col("endpoint"), F.col("id"))
    )
    joined = with_state(
        pairs, state,
        ["status", "current_pipeline_run_id", "last_list_item_uid", "last_list_item_hash", "attempt_count"],
    )
    same = (
        (_status() == "SUCCESS")
        & (coalesce_empty(F.col("s_last_list_item_uid")) == coalesce_empty(F.col("uid")))
        & (coalesce_empty(F.col("s_last_list_item_hash")) == coalesce_empty(F.col("hash")))
    )
    return joined.withColumn(
        "action",
        F.when(_same_run(run) & _status().isin(*IN_FLIGHT), F.lit("skip_queued"))
        .when(same, F.lit("skip_same_hash"))
        .otherwise(F.lit("enqueue")),
    )


def _same_run_plan(pairs: DataFrame, state: DataFrame, run_id: Column) -> DataFrame:
    joined = with_state(pairs, state, ["status", "current_pipeline_run_id", "attempt_count"])
    return joined.withColumn(
        "action",
        F.when(_same_run(run_id) & (_status() == "SUCCESS"), F.lit("skip_success"))
        .when(_same_run(run_id) & _status().isin(*IN_FLIGHT), F.lit("skip_queued"))
        .otherwise(F.lit("enqueue")),
    )


def plan_institucional(parents: DataFrame, state: DataFrame, run_id: str) -> DataFrame:
    """Parents of four kinds fan out to their kind's endpoints; only this run's state counts."""
    kinds = [k for k in catalog.SUB_ENDPOINTS if k.endswith("_parent")]
    targets = F.create_map(*[
        x for k in kinds for x in (F.lit(k), F.array(*[F.lit(e) for e in catalog.SUB_ENDPOINTS[k]]))
    ])
    pairs = parents.select("*", F.posexplode(F.element_at(targets, F.col("kind"))).alias("seq", "endpoint"))
    pairs = pairs.withColumn("row_key", S.state_key(F.col("endpoint"), F.col("id")))
    return _same_run_plan(pairs, state, F.lit(run_id))


def plan_reference(dates: DataFrame, state: DataFrame) -> DataFrame:
    """Reference lists of each date; the run id follows from the date."""
    names = [e.name for e in catalog.domain_endpoints("reference")]
    pairs = pair_with_endpoints(dates, names).withColumns({
        "row_key": S.state_key(F.col("endpoint"), F.col("reference_date")),
        "pipeline_run_id": F.concat(F.lit("reference_snapshot_"), F.replace("reference_date", F.lit("-"), F.lit(""))),
    })
    return _same_run_plan(pairs, state, F.col("pipeline_run_id"))


def ceap_action(run_id: Column, now: Column, stale_minutes: int) -> Column:
    """One of seven outcomes for an expense partition."""
    status = _status()
    stale_queue = S.is_stale(F.col("s_last_dispatched_at"), now, stale_minutes)
    stale_run = S.is_stale(F.col("s_last_started_at"), now, stale_minutes)
    return (
        F.when(F.col("s_known").isNull(), F.lit("enqueue_new"))
        .when(status.isin("PENDING", "FAILED", "POISON", "STALE"), F.lit("enqueue_reprocess"))
        .when(_same_run(run_id) & (status == "SUCCESS"), F.lit("skip_success_same_run"))
        .when((status == "QUEUED") & stale_queue, F.lit("enqueue_stale_queued"))
        .when(status == "QUEUED", F.lit("skip_queued"))
        .when((status == "RUNNING") & stale_run, F.lit("enqueue_stale_running"))
        .when(status == "RUNNING", F.lit("skip_running"))
        .otherwise(F.lit("enqueue_reprocess"))
    )


def plan_ceap(
    deputies: DataFrame, months: Column, target_year: Column, state: DataFrame, run_id: str, now: Column,
    stale_minutes: int = catalog.STALE_AFTER_MINUTES,
) -> DataFrame:
    """Deputies × months against expense state; months after the last dispatchable one are dropped.

    ``months`` is an array column in dispatch order.  Deputies whose id is not
    an integer take no part.
    """
    top = W.max_dispatch_month(target_year, now)
    pairs = (
        deputies.withColumn("id_deputado", F.col("id").cast("string").try_cast("bigint"))
        .where(F.col("id_deputado").isNotNull())
        .select("*", F.posexplode(months).alias("month_idx", "mes"))
        .where(F.col("mes") <= top)
        .withColumn("ano", target_year.cast("int"))
        .withColumn("row_key", S.state_key(F.lit("despesas"), F.col("id_deputado"), F.col("ano"), F.col("mes")))
    )
    joined = with_state(pairs, state, [
        "status", "current_pipeline_run_id", "last_dispatched_at", "last_started_at", "attempt_count",
        "stale_requeue_count", "reprocess_count",
    ])
    return joined.withColumn("action", ceap_action(F.lit(run_id), now, stale_minutes))


def dispatch_patch(plan: DataFrame, run_id: str, now: Column, mode: str | None = None) -> DataFrame:
    """State rows of the enqueued pairs, ready for the key-value merge.

    Expense plans also carry the stale counters and leave the last error alone.
    """
    enq = plan.where(F.col("action").startswith("enqueue"))
    patch = {
        "row_key": F.col("row_key"),
        "endpoint": F.col("endpoint") if "endpoint" in plan.columns else F.lit("ceap"),
        "status": F.lit("QUEUED"),
        "current_pipeline_run_id": F.lit(run_id),
        "last_pipeline_run_id": coalesce_empty(F.col("s_current_pipeline_run_id")),
        "last_dispatched_at": now,
        "attempt_count": F.coalesce("s_attempt_count", F.lit(0)),
    }
    if mode:
        patch["last_mode"] = F.lit(mode)
    if "s_stale_requeue_count" not in plan.columns:
        patch["last_error"] = F.lit("")
    if "s_stale_requeue_count" in plan.columns:
        # A stale hit raises the stale counter, or the reprocess counter on
        # rows that only have that one.
        stale = F.col("action").startswith("enqueue_stale")
        only_reprocess = F.col("s_stale_requeue_count").isNull() & F.col("s_reprocess_count").isNotNull()
        patch["stale_requeue_count"] = F.coalesce("s_stale_requeue_count", F.lit(0)) + F.when(
            stale & ~only_reprocess, F.lit(1)
        ).otherwise(F.lit(0))
        patch["reprocess_count"] = F.coalesce("s_reprocess_count", F.lit(0)) + F.when(
            stale & only_reprocess, F.lit(1)
        ).otherwise(F.lit(0))
    if "uid" in plan.columns:
        patch["last_list_item_uid"] = F.col("uid")
        patch["last_list_item_hash"] = F.col("hash")
    return enq.select(*[c.alias(n) for n, c in patch.items()])


def worker_skips(run_id: Column, hash_aware: bool = True, force: Column | None = None) -> Column:
    """Why a worker drops a message (null = it runs): unchanged item, or done in this run.

    ``force`` lifts the unchanged-item rule.
    """
    same_run = F.when(_same_run(run_id) & (_status() == "SUCCESS"), F.lit("already_success_in_run"))
    if not hash_aware:
        return same_run
    item_hash = coalesce_empty(F.col("hash"))
    unchanged = (
        (_status() == "SUCCESS") & (item_hash != "")
        & (coalesce_empty(F.col("s_last_list_item_hash")) == item_hash)
    )
    if force is not None:
        unchanged = unchanged & ~F.coalesce(force, F.lit(False))
    return F.coalesce(F.when(unchanged, F.lit("unchanged_list_item")), same_run)


def after_cursor(df: DataFrame, cursor: Column, id_col: str = "id") -> DataFrame:
    """Drops numeric ids at or below the cursor; ids with other characters always pass."""
    num = S.numeric_id(F.col(id_col))
    return df.where(num.isNull() | (num > cursor))


def advance_cursor(outcomes: DataFrame, old: int = 0, id_col: str = "id") -> DataFrame:
    """Largest numeric id of the successful microbatch tasks, never moving back."""
    done = outcomes.where((F.upper("status") == "SUCCESS") & F.col("run_type").isin("microbatch"))
    top = F.max(S.numeric_id(F.col(id_col)))
    return done.agg(F.greatest(F.coalesce(top, F.lit(0)), F.lit(old)).cast("bigint").alias("cursor"))
