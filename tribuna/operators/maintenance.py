"""Replay and purge of runs as table operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tribuna.functions import scalars as S
from tribuna.functions import windows as W
from tribuna.operators.merges import upsert_merge
from tribuna.session import coalesce_empty
from tribuna.sources import tables


def select_for_replay(
    state: DataFrame, statuses=("FAILED", "POISON"), endpoint: str | None = None, parent_id: str | None = None,
    run_id: str | None = None, id_deputado: int | None = None, ano: int | None = None, mes: int | None = None,
    default_endpoint: str = "",
) -> DataFrame:
    """Task rows in the wanted statuses, with any of the optional filters.

    ``default_endpoint`` stands in for rows that do not name theirs (``ceap`` in expense state).
    """
    wanted = [s.strip().upper() for s in statuses if s.strip()]
    out = state.where(F.upper(coalesce_empty(F.col("status"))).isin(*wanted))
    if endpoint is not None:
        out = out.where(F.lower(F.coalesce("endpoint", F.lit(default_endpoint))) == endpoint.lower())
    if run_id is not None:
        out = tables.tied_to_run(out, run_id)
    for name, value in (("parent_id", parent_id), ("id_deputado", id_deputado), ("ano", ano), ("mes", mes)):
        if value is not None:
            out = out.where(F.col(name) == value)
    return out


def mark_future(selected: DataFrame, now: Column) -> DataFrame:
    """``future`` = the row's month cannot be dispatched yet; such rows are skipped and counted."""
    return selected.withColumn("future", F.col("mes") > W.max_dispatch_month(F.col("ano"), now))


def replay(state: DataFrame, selected: DataFrame, run_id: str, now: Column, full: bool = False,
           keep_last_run: bool = True) -> DataFrame:
    """State with the selected rows queued again under a new run id.

    ``full`` restarts from the first page.  ``keep_last_run`` records the run
    each row belonged to (expense replays leave that column as it is).
    """
    patch = {
        "row_key": F.col("row_key"), "status": F.lit("QUEUED"), "current_pipeline_run_id": F.lit(run_id),
        "last_dispatched_at": now, "last_error": F.lit(""),
    }
    if keep_last_run:
        patch["last_pipeline_run_id"] = coalesce_empty(F.col("current_pipeline_run_id"))
    if full:
        patch["last_successful_page"] = F.lit(0)
    return upsert_merge(state, selected.select(*[c.alias(n) for n, c in patch.items()]), ["row_key"])


def purge_counts(run_id: str, runs: DataFrame, state: DataFrame, messages: DataFrame, poison: DataFrame,
                 paths: DataFrame, locks: DataFrame) -> DataFrame:
    """What a purge of one run would delete, one row per artifact class (the dry run)."""
    def n(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("artifact"), "n")

    p = F.replace(F.col("path"), F.lit("\\"), F.lit("/"))
    tagged = path_of_run(F.col("path"), run_id)
    snapshot = p.contains("/deputados/api/list/")
    manifest = p.contains("_metadata/runs/")
    # The file listing is the large input: its three classes are counted in one pass.
    files = paths.where(tagged).agg(
        F.count_if(~snapshot & ~p.contains("_metadata/")).alias("raw_files"),
        F.count_if(manifest).alias("metadata_files"), F.count_if(snapshot).alias("deputies_snapshot_files"),
    ).unpivot([], ["raw_files", "metadata_files", "deputies_snapshot_files"], "artifact", "n")
    parts = [
        n(runs.where(F.col("pipeline_run_id") == run_id), "control_run_records"),
        n(tables.tied_to_run(state, run_id), "state_records"),
        n(tables.messages_for_run(messages, run_id), "queue_messages"),
        n(tables.messages_for_run(poison, run_id), "poison_messages"),
        n(locks.where(F.col("pipeline_run_id") == run_id), "locks"),
    ]
    out = files
    for part in parts:
        out = out.unionByName(part)
    return out


def path_of_run(path: Column, run_id: str) -> Column:
    """Whether a path belongs to the run, its id written as it is or in its path-safe form."""
    safe = re.sub(S.SAFE_SEGMENT, "_", run_id)
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    hit = F.lit(False)
    for form in sorted({run_id, safe}):  # the id ends where its segment ends
        hit = hit | p.contains(f"pipeline_run_id={form}/") | p.endswith(f"pipeline_run_id={form}")
    return hit


def purge_state(state: DataFrame, run_id: str) -> DataFrame:
    """State rows that survive a purge: those not tied to the run."""
    hit = (coalesce_empty(F.col("current_pipeline_run_id")) == run_id) | (
        coalesce_empty(F.col("last_pipeline_run_id")) == run_id
    )
    return state.where(~hit)


def purge_runs(rows: DataFrame, run_id: str) -> DataFrame:
    """Control rows, and locks, that survive."""
    return rows.where(coalesce_empty(F.col("pipeline_run_id")) != run_id)


def purge_messages(messages: DataFrame, run_id: str, body: str = "body") -> DataFrame:
    """Messages that survive; one that cannot be read stays."""
    of = F.trim(F.get_json_object(tables.message_text(F.col(body)), "$.pipeline_run_id"))
    return messages.where(coalesce_empty(of) != run_id.strip())


def purge_files(paths: DataFrame, run_id: str, snapshots: bool = True) -> DataFrame:
    """Files that survive: pages and manifests of the run go, and with ``snapshots`` its deputies lists."""
    gone = path_of_run(F.col("path"), run_id)
    return paths.where(~gone if snapshots else ~gone | F.col("path").contains("/deputados/api/list/"))
