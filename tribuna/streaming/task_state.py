"""Task state machine: QUEUED → RUNNING → SUCCESS / FAILED / POISON.

The fold of an event history into one row per task is written as aggregates,
not as a per-key loop: every part is a ``max_by`` or a count, so it combines
on the map side and a task with a third of all events is no special case.  The
stream folds each micro-batch the same way and merges it into the state table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tribuna.functions import scalars as S
from tribuna.sources.keyed import BUCKETS, FULL, KeyedTable
from tribuna.streaming import table_log

DISPATCHED = ("QUEUED", "RUNNING")


def _order() -> Column:
    return F.struct("ts", "seq")


def _latest(value: str, cond: Column | None = None) -> Column:
    return F.max_by(value, F.when(cond, _order()) if cond is not None else _order())


def fold(events: DataFrame, keys: list[str]) -> DataFrame:
    """State after a history of events (``ts, seq, status, run_id, record_count, hash``).

    * status and current run: the last event's;
    * last run: the run before the last event that (re)dispatched the task;
    * attempts: RUNNING events; reprocess count: POISON events;
    * record count, list hash and success time: of the last SUCCESS.
    """
    ok = F.col("status") == "SUCCESS"
    base = events.groupBy(*keys).agg(
        _latest("status").alias("status"),
        _latest("run_id").alias("current_pipeline_run_id"),
        F.max(_order()).alias("last_event"),
        F.max(F.when(F.col("status").isin(*DISPATCHED), _order())).alias("_dispatch"),
        F.count_if(F.col("status") == "RUNNING").alias("attempt_count"),
        F.count_if(F.col("status") == "POISON").alias("reprocess_count"),
        _latest("record_count", ok).alias("record_count"),
        _latest("hash", ok).alias("last_list_item_hash"),
        F.max(F.when(ok, F.col("ts"))).alias("last_success_at"),
        F.max(F.when(F.col("status") == "QUEUED", F.col("ts"))).alias("last_dispatched_at"),
        F.max(F.when(F.col("status") == "RUNNING", F.col("ts"))).alias("last_started_at"),
    )
    # Run in force when the last dispatch happened: the newest event before it.
    dispatch = base.where(F.col("_dispatch").isNotNull()).select(*keys, "_dispatch")
    previous = (
        events.select(*keys, "run_id", "ts", "seq").join(dispatch, keys)
        .where(_order() < F.col("_dispatch"))
        .groupBy(*keys).agg(_latest("run_id").alias("last_pipeline_run_id"))
    )
    return base.join(previous, keys, "left").drop("_dispatch")


def partial(events: DataFrame, keys: list[str], batch_id: int) -> DataFrame:
    """One micro-batch's contribution per task, mergeable with the other batches'.

    Positions are ``(batch, ts, seq)``: transitions apply in the order they
    arrive.  ``before`` is the newest event ahead of the batch's own last
    dispatch.
    """
    ok = F.col("status") == "SUCCESS"
    at = F.struct(F.lit(batch_id).cast("bigint").alias("batch"), "ts", "seq")
    base = events.groupBy(*keys).agg(
        F.max(at).alias("last_at"), F.max_by(F.struct("status", "run_id"), _order()).alias("last"),
        F.max(F.when(F.col("status").isin(*DISPATCHED), at)).alias("dispatch_at"),
        F.count_if(F.col("status") == "RUNNING").alias("attempt_count"),
        F.count_if(F.col("status") == "POISON").alias("reprocess_count"),
        F.max(F.when(ok, at)).alias("success_at"),
        F.max_by(F.struct("ts", "record_count", "hash"), F.when(ok, _order())).alias("success"),
    )
    dispatch = base.where(F.col("dispatch_at").isNotNull()).select(*keys, "dispatch_at")
    before = (
        events.join(dispatch, keys).where(at < F.col("dispatch_at"))
        .groupBy(*keys).agg(F.max(at).alias("before_at"), F.max_by("run_id", _order()).alias("before_run"))
    )
    return base.join(before, keys, "left")


def merge_partials(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Partials of each task as one partial: the same answer as from all of them.

    The newest event before the last dispatch is either some batch's ``before``
    or the last event of an earlier batch.
    """
    state = partials.groupBy(*keys).agg(
        F.max("last_at").alias("last_at"), F.max_by("last", "last_at").alias("last"),
        F.max("dispatch_at").alias("dispatch_at"),
        F.sum("attempt_count").alias("attempt_count"),
        F.sum("reprocess_count").alias("reprocess_count"),
        F.max("success_at").alias("success_at"), F.max_by("success", "success_at").alias("success"),
    )
    dispatch = state.where(F.col("dispatch_at").isNotNull()).select(*keys, F.col("dispatch_at").alias("_dispatch"))
    seen = F.inline(F.array(
        F.struct(F.col("last_at").alias("at"), F.col("last.run_id").alias("run")),
        F.struct(F.col("before_at").alias("at"), F.col("before_run").alias("run")),
    ))
    previous = (
        partials.select(*keys, seen).join(dispatch, keys).where(F.col("at") < F.col("_dispatch"))
        .groupBy(*keys).agg(F.max("at").alias("before_at"), F.max_by("run", "at").alias("before_run"))
    )
    return state.join(previous, keys, "left")


def combine(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Current state of every task from its partials."""
    return merge_partials(partials, keys).select(
        *keys, F.col("last.status").alias("status"), F.col("last.run_id").alias("current_pipeline_run_id"),
        F.col("before_run").alias("last_pipeline_run_id"), "attempt_count", "reprocess_count", F.col("success.record_count").alias("record_count"),
        F.col("success.hash").alias("last_list_item_hash"), F.col("success.ts").alias("last_success_at"),
    )


def state_table(spark: SparkSession, path: str, keys: list[str], partial_schema: T.StructType | None = None, buckets: int = BUCKETS) -> KeyedTable:
    """Partials by task: a base and what later batches added."""
    if partial_schema is None:
        partial_schema = spark.read.parquet(f"{path}/schema").schema
    return KeyedTable(spark, path, partial_schema, keys, buckets)


def stream_states(events: DataFrame, keys: list[str], path: str, checkpoint: str, full: int = FULL) -> None:
    """Adds one partial per task and micro-batch; read it back with :func:`current`.

    A micro-batch costs what its own events cost.  Buckets that ``full`` batches
    have added to are folded into one base, so a reader meets at most that many
    partials of a task, however long the stream has run.  A batch has the numbers
    ``2 * batch_id`` for its partials and the next one for the folding.
    """
    schema = partial(events, keys, 0).schema

    def tick(df: DataFrame, batch_id: int) -> None:
        table = state_table(df.sparkSession, path, keys, schema)
        if batch_id == 0:
            df.sparkSession.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/schema")
        table.append(partial(df, keys, batch_id), 2 * batch_id)
        table.compact(lambda rows: merge_partials(rows, keys), full, 2 * batch_id + 1)

    table_log.run_available(events, tick, checkpoint)


def current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    return combine(state_table(spark, path, keys).rows().drop("seq", "bucket"), keys)


def requeue_stale(state: DataFrame, run_id: Column | None, now: Column, minutes: int) -> DataFrame:
    """QUEUED tasks dispatched ``minutes`` ago or earlier go out again, counter + 1.

    Rows that are not stale come back unchanged; ``requeued`` tells them apart.
    """
    mine = F.lit(True) if run_id is None else (F.col("current_pipeline_run_id") == run_id)
    stale = (
        (F.col("status") == "QUEUED") & mine & F.lit(minutes > 0)
        & S.is_stale(F.col("last_dispatched_at"), now, minutes, inclusive=True)
    )
    return state.withColumn("requeued", F.coalesce(stale, F.lit(False))).withColumns({
        "last_dispatched_at": F.when(F.col("requeued"), now).otherwise(F.col("last_dispatched_at")),
        "stale_requeue_count": F.coalesce("stale_requeue_count", F.lit(0)) + F.col("requeued").cast("int"),
    })


def resume_page(run_id: Column) -> Column:
    """Page a worker starts at: after its last good page in the same RUNNING run, else the first."""
    same = (F.col("current_pipeline_run_id") == run_id) & (F.upper("status") == "RUNNING") & (run_id != "")
    done = S.int_or_zero(F.col("last_successful_page").cast("string"))
    return F.when(F.coalesce(same, F.lit(False)) & (done > 0), done + 1).otherwise(F.lit(1)).cast("bigint")
