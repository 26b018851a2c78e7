"""Queries over task state and run rows: counts, statuses, merges, maintenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tribuna.operators import batches as B
from tribuna.operators import maintenance as M
from tribuna.operators import merges as G
from tribuna.operators import status as ST_
from tribuna.plans import stand_ins as ST
from tribuna.plans.stand_ins import twin
from tribuna.session import cut_lineage, read_table, work_path
from tribuna.sources import tables
from tribuna.sources.keyed import KeyedTable
from tribuna.streaming import task_state as TS

_KEYS = ["domain", "pipeline_run_id"]


def _counts(spark, sf):
    return ST_.status_counts(ST.run_state(spark, sf), "domain")


def status_counts_by_run(spark, sf):
    """Eight buckets, expected tasks, strict completion and sums per domain and run."""
    j = _counts(spark, sf).join(ST.registry(spark, sf).select(*_KEYS, "total_tasks_expected", "enqueue_phase_complete"), _KEYS, "left")
    done = F.coalesce("enqueue_phase_complete", F.lit(False))
    exp = ST_.expected_from_registry(done, F.col("total_tasks_expected"))
    return j.withColumn("expected", exp).withColumn("strict", ST_.strict_completed(done, F.col("expected"))).drop(
        "total_tasks_expected", "enqueue_phase_complete")


def run_status_ceap(spark, sf):
    j = ST.registry(spark, sf).join(_counts(spark, sf), _KEYS)
    done = F.col("enqueue_phase_complete")
    exp = ST_.expected_tasks_ceap(done, F.col("total_tasks_expected"), F.col("total_tasks_queued"), F.lit(2).cast("bigint"))
    j = j.withColumn("expected", exp)
    return j.select(*_KEYS, "expected", ST_.run_status_ceap(done, F.col("expected"), F.col("total_tasks_queued")).alias("status"))


def run_status_domain(spark, sf):
    """Hash-aware, institutional and reference decisions on the same runs.

    A run's tick is read off its counts: pending rows are what it enqueued,
    failed ones what it found queued, the rest unchanged.
    """
    c = _counts(spark, sf).withColumns({
        "n_fanout": ST_.total_seen(), "enqueued": F.col("pending"), "skipped_queued": F.col("failed"),
        "skipped_same_hash": F.col("success") + F.col("queued") + F.col("running"),
    })
    c = c.withColumn("phase", ST_.enqueue_phase_complete(F.lit(True), F.col("enqueued") >= 3))
    exp = ST_.expected_tasks_domain(F.col("n_fanout"))
    return c.select(
        *_KEYS, F.col("phase").alias("phase_complete"), ST_.run_status_domain(F.col("phase"), exp).alias("hash_aware"),
        ST_.run_status_institucional(F.lit(1), F.col("n_fanout")).alias("institucional"),
        ST_.run_status_reference(2).alias("reference"),
    )


def _outcomes(spark, sf):
    s = ST.run_state(spark, sf).where(F.col("status").isin("SUCCESS", "FAILED"))
    return s.select("domain", F.col("current_pipeline_run_id").alias("pipeline_run_id"), (F.col("status") == "SUCCESS").alias("ok"))


def merge_counters(spark, sf):
    runs = ST.registry(spark, sf)
    out = ST_.merge_counters(runs, _outcomes(spark, sf), F.lit("2024-02-02"), _KEYS)
    return out.select(*_KEYS, "total_tasks_success", "total_tasks_failed", "status", "completed_at", "last_recovered_at", "failed_at")


def _patch(spark, sf):
    out = _outcomes(spark, sf).groupBy(*_KEYS).agg(F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_bad"))
    return out.select(
        *_KEYS, F.when(F.col("n_bad") > 0, F.lit("PARTIAL")).alias("status"),
        F.when(F.col("n_ok") > 0, F.lit("ok")).alias("last_error"), F.col("n_ok").cast("string").alias("total_tasks_success"),
    )


def upsert_merge(spark, sf):
    """Null keeps the old value."""
    base = ST.registry(spark, sf).select(*_KEYS, "status", "last_error")
    return G.upsert_merge(base, _patch(spark, sf), _KEYS)


def upsert_copy_on_write(spark, sf):
    """The registry as a keyed table; two deltas, each of which rewrites the buckets it hits and no other."""
    table = KeyedTable(spark, work_path(spark, "registry"), "domain string, pipeline_run_id string, status string, last_error string, total_tasks_success string", _KEYS, 32)
    table.rewrite(ST.registry(spark, sf).select(*_KEYS, "status", "last_error", F.lit(None).cast("string").alias("total_tasks_success")))
    merge = lambda old, delta: G.upsert_merge(old, delta, _KEYS)
    patch = cut_lineage(_patch(spark, sf))
    one = F.col("domain") == "d1"
    table.upsert(patch.where(one), merge)
    table.upsert(patch.where(~one), merge)
    return table.newest()


def upsert_replace(spark, sf):
    """Listed columns are removed, others merge."""
    base = ST.registry(spark, sf).select(*_KEYS, "status", "last_error")
    delta = _patch(spark, sf).withColumn(
        "cleared", F.when(F.col("total_tasks_success") == "0", F.array(F.lit("last_error"), F.lit("total_tasks_success"))))
    return G.upsert_replace(base, delta, _KEYS)


def reconcile_runs(spark, sf):
    out = ST_.reconcile_runs(ST.run_state(spark, sf), ST.registry(spark, sf), F.lit("2024-02-02"), _KEYS)
    return out.select(*_KEYS, "status", "total_tasks_expected", "success", "record_count_sum", "pages_written_sum",
                      "completed_at", "failed_at", "last_recovered_at", "write_marker")


def state_scan(spark, sf):
    """State rows of one run, by current or last run id."""
    return tables.tied_to_run(ST.run_state(spark, sf), ST.CEAP_RUN).select("domain", "row_key", "status")


def runs_scan(spark, sf):
    return tables.by_status(ST.registry(spark, sf), "failed", "PARTIAL").select(*_KEYS, "status", "total_tasks_expected")


def replay_selection(spark, sf):
    """Rows chosen for replay and whether their month is still ahead."""
    sel = M.select_for_replay(ST.run_state(spark, sf), ("FAILED", "pending"), endpoint="CEAP", run_id=ST.CEAP_RUN)
    shifted = sel.withColumn("mes", (F.col("mes") + F.col("event_id") % 2).cast("int"))
    return M.mark_future(shifted, ST.now()).select("row_key", "status", "mes", "future")


def replay_state(spark, sf):
    """State after the replay: selected rows queued under the replay run."""
    state = ST.run_state(spark, sf).withColumn("last_error", F.lit("e")).drop("event_id", "user_id")
    sel = M.select_for_replay(state, ("FAILED",), run_id=ST.CEAP_RUN)
    state = state.withColumn("last_dispatched_at", F.lit(None).cast("timestamp_ntz"))
    sel = sel.withColumn("last_dispatched_at", F.lit(None).cast("timestamp_ntz"))
    out = M.replay(state, sel, "ceap_replay_20240120", ST.now())
    return out.select("row_key", "status", "current_pipeline_run_id", "last_pipeline_run_id", "last_error")


def _artifacts(spark, sf):
    e = read_table(spark, sf, "events")
    run = F.concat(F.lit("ceap_daily_"), ST.compact(F.col("ts")))
    kind = F.col("event_id") % 3
    i = F.col("event_id").cast("string")
    path = (
        F.when(kind == 0, F.concat(F.lit("raw/camara/ceap/api/despesas/reference_year=2024/pipeline_run_id="), run, F.lit("/page_"), i))
        .when(kind == 1, F.concat(F.lit("raw/camara/ceap/api/despesas/_metadata/runs/pipeline_run_id="), run, F.lit("/"), i))
        .otherwise(F.concat(F.lit("raw/camara/deputados/api/list/reference_date=2024-01-01/pipeline_run_id="), run, F.lit("/"), i))
    )
    body = F.concat(F.lit('{"pipeline_run_id": "'), run, F.lit('"}'))
    return e.select("event_id", "event_type", path.alias("path"), body.alias("body"), run.alias("pipeline_run_id"))


def purge_counts(spark, sf):
    """What purging one run would delete, per artifact class."""
    a = _artifacts(spark, sf)
    runs = ST.registry(spark, sf)
    return M.purge_counts(
        ST.CEAP_RUN, runs, ST.run_state(spark, sf), a.where(F.col("event_type") == "view"),
        a.where(F.col("event_type") == "error"), a, runs.where(F.col("domain") == "d1"),
    )


def purge_survivors(spark, sf):
    kept = M.purge_state(ST.run_state(spark, sf), ST.CEAP_RUN)
    return kept.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


def purge_all_survivors(spark, sf):
    """What every artifact class keeps after the purge of one run; half of the paths carry an id that is not path-safe."""
    a = _artifacts(spark, sf)
    odd = F.replace(F.col("path"), F.lit("pipeline_run_id=ceap_daily_20240115"), F.lit("pipeline_run_id=ceap daily_20240115"))
    paths = a.withColumn("path", F.when(F.col("event_id") % 2 == 0, odd).otherwise(F.col("path")))
    runs = ST.registry(spark, sf)
    kept = {
        "runs": M.purge_runs(runs, ST.CEAP_RUN), "state": M.purge_state(ST.run_state(spark, sf), ST.CEAP_RUN),
        "messages": M.purge_messages(a, ST.CEAP_RUN), "files": M.purge_files(paths, "ceap daily_20240115"),
        "files_but_snapshots": M.purge_files(paths, "ceap daily_20240115", snapshots=False),
    }
    out = [df.agg(F.count(F.lit(1)).alias("kept")).select(F.lit(name).alias("artifact"), "kept") for name, df in kept.items()]
    return reduce(lambda x, y: x.unionByName(y), out)


def raw_files_for_run(spark, sf):
    return tables.raw_files_for_run(_artifacts(spark, sf), ST.CEAP_RUN).select("path")


def _batches(spark, sf):
    """Batches: one per event type (control) and hour."""
    e = read_table(spark, sf, "events")
    return e.groupBy(F.col("event_type").alias("control_id"), ST.day_text(F.col("ts")).alias("dia"),
                     F.date_format("ts", "yyyy-MM-dd HH").alias("hora")).agg(
        F.count(F.lit(1)).alias("records_seen"), F.count_if(ST.k_value() % 2 == 0).alias("messages_enqueued"),
        F.count_if(ST.k_value() % 2 == 1).alias("records_skipped_same_hash"))


def batch_totals(spark, sf):
    out = B.batch_totals(_batches(spark, sf), ["control_id"], "dia", ["hora"])
    return out.select("control_id", "hora", "batch_index", "records_seen_total", "messages_enqueued_total", "skipped_same_hash_total")


def idle_streak(spark, sf):
    """Ticks per event type and hour; a tick is idle when nothing had an even key."""
    ticks = _batches(spark, sf).select("control_id", "hora", F.col("messages_enqueued").alias("queued"))
    return B.idle_streak(ticks, ["control_id"], "hora")


def parents_detected(spark, sf):
    """Parents per kind and day and the tasks they stand for."""
    e = read_table(spark, sf, "events")
    kinds = F.array(*[F.lit(k) for k in ("orgaos_parent", "partidos_parent", "frentes_parent", "legislaturas_parent")])
    p = e.select(ST.day_text(F.col("ts")).alias("dia"), F.element_at(kinds, (F.col("event_id") % 4 + 1).cast("int")).alias("kind"), F.col("user_id").alias("id"))
    return B.parents_detected(p, "dia")


def task_state_fold(spark, sf):
    """Task rows after their whole event history, with last run and resume page."""
    ev = ST.task_events(read_table(spark, sf, "events"))
    out = TS.fold(ev, ["row_key"])
    return out.select("row_key", "status", "current_pipeline_run_id", "last_pipeline_run_id", "attempt_count",
                      "record_count", "last_list_item_hash", F.date_format("last_success_at", "yyyy-MM-dd HH:mm:ss").alias("last_success_at"))


def requeue_stale(spark, sf):
    s = ST.run_state(spark, sf).select("row_key", "status", "current_pipeline_run_id", F.col("ts").alias("last_dispatched_at"),
                                       F.when(F.col("event_id") % 2 == 0, F.lit(2)).alias("stale_requeue_count"))
    out = TS.requeue_stale(s, None, ST.now(), 60)
    return out.select("row_key", "status", "requeued", "stale_requeue_count")


def resume_page(spark, sf):
    s = ST.run_state(spark, sf)
    return s.select("row_key", TS.resume_page(F.lit(ST.CEAP_RUN)).alias("page"))


_OUT = "SELECT domain, cur AS run, status = 'SUCCESS' AS ok FROM run_state WHERE status IN ('SUCCESS', 'FAILED')"
_DELTA = f", d AS (SELECT domain, run, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS bad FROM ({_OUT}) GROUP BY 1, 2)"
_PATCH = ", pat AS (SELECT domain, run AS pipeline_run_id, CASE WHEN bad > 0 THEN 'PARTIAL' END AS status, CASE WHEN ok > 0 THEN 'ok' END AS last_error, CAST(ok AS VARCHAR) AS total_tasks_success FROM d), base AS (SELECT * FROM registry)"
_CLEAN = "failed = 0 AND poison = 0 AND running = 0 AND queued = 0 AND pending = 0"
_ART = """WITH a AS (SELECT *, 'ceap_daily_' || strftime(ts, '%Y%m%d') AS run, CASE event_id % 3 WHEN 0 THEN 'raw/camara/ceap/api/despesas/reference_year=2024/pipeline_run_id=' || 'ceap_daily_' || strftime(ts, '%Y%m%d') || '/page_' || event_id
  WHEN 1 THEN 'raw/camara/ceap/api/despesas/_metadata/runs/pipeline_run_id=' || 'ceap_daily_' || strftime(ts, '%Y%m%d') || '/' || event_id
  ELSE 'raw/camara/deputados/api/list/reference_date=2024-01-01/pipeline_run_id=' || 'ceap_daily_' || strftime(ts, '%Y%m%d') || '/' || event_id END AS path FROM events)"""
_BATCH = """WITH b AS (SELECT event_type AS control_id, strftime(ts, '%Y-%m-%d %H') AS hora, count(*) AS seen, count(*) FILTER (CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0) AS enq,
  count(*) FILTER (CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 1) AS skip FROM events GROUP BY 1, 2)"""


QUERIES = {
    "status_counts_by_run": (status_counts_by_run, twin("""SELECT c.* EXCLUDE (seen), CASE WHEN r.enq THEN seen ELSE coalesce(r.total_tasks_expected, 0) END AS expected,
  coalesce(r.enq, false) AND seen > 0 AND success = seen AS strict FROM counts c LEFT JOIN registry r USING (domain, pipeline_run_id)""", "counts", "registry")),
    "run_status_ceap": (run_status_ceap, twin(f"""SELECT domain, pipeline_run_id, expected, CASE WHEN enq AND expected > 0 AND success = expected AND {_CLEAN} THEN 'COMPLETED'
  WHEN enq AND expected = 0 AND n = 0 THEN 'COMPLETED' WHEN enq AND fin AND bad AND success > 0 THEN 'PARTIAL' WHEN enq AND fin AND bad THEN 'FAILED'
  WHEN running > 0 THEN 'RUNNING' WHEN enq THEN 'QUEUED' ELSE 'QUEUING' END AS status FROM (SELECT c.*, r.enq, r.n, CASE WHEN r.enq THEN seen ELSE greatest(r.n, r.total_tasks_expected, 2) END AS expected,
  running = 0 AND queued = 0 AND pending = 0 AND stale = 0 AND other = 0 AS fin, failed > 0 OR poison > 0 AS bad FROM registry r JOIN counts c USING (domain, pipeline_run_id))""", "counts", "registry")),
    "run_status_domain": (run_status_domain, twin(f"""SELECT domain, pipeline_run_id, phase AS phase_complete,
  CASE WHEN (phase AND seen = 0 AND {_CLEAN}) OR (phase AND seen > 0 AND success + queued + running >= seen) THEN 'COMPLETED' WHEN phase AND seen > 0 AND success >= seen AND {_CLEAN} THEN 'COMPLETED'
  WHEN running + queued > 0 OR pending > 0 THEN 'RUNNING' ELSE 'QUEUING' END AS hash_aware,
  CASE WHEN pending = 0 AND failed = 0 AND seen > 0 AND success >= seen AND {_CLEAN} THEN 'COMPLETED' WHEN running + queued > 0 OR pending > 0 THEN 'RUNNING' ELSE 'QUEUING' END AS institucional,
  CASE WHEN seen >= 2 AND success = 2 AND {_CLEAN} THEN 'COMPLETED' WHEN running + queued > 0 THEN 'RUNNING' ELSE 'QUEUING' END AS reference
  FROM (SELECT *, NOT pending >= 3 AND pending + failed + success + queued + running >= seen AND pending = 0 AND failed = 0 AS phase FROM counts)""", "counts")),
    "merge_counters": (merge_counters, twin("", "run_state", "registry").rstrip() + _DELTA + """
  , m AS (SELECT r.*, d.ok, d.bad, CASE WHEN total_tasks_expected > 0 THEN total_tasks_expected ELSE total_tasks_queued END AS t FROM registry r JOIN d ON r.domain = d.domain AND r.pipeline_run_id = d.run),
  s AS (SELECT *, t > 0 AND ok + bad >= t AS fin, CASE WHEN t > 0 AND ok + bad >= t THEN CASE WHEN bad = 0 THEN 'COMPLETED' ELSE 'PARTIAL' END WHEN ok + bad > 0 THEN 'RUNNING' ELSE status END AS ns FROM m)
  SELECT domain, pipeline_run_id, ok AS total_tasks_success, bad AS total_tasks_failed, ns AS status, CASE WHEN fin THEN '2024-02-02' END AS completed_at,
  CASE WHEN ns = 'COMPLETED' AND (failed_at <> '' OR status IN ('FAILED', 'PARTIAL')) THEN '2024-02-02' END AS last_recovered_at, CASE WHEN ns = 'COMPLETED' THEN '' ELSE failed_at END AS failed_at FROM s"""),
    "upsert_merge": (upsert_merge, twin("", "run_state", "registry").rstrip() + _DELTA + _PATCH + """ SELECT coalesce(p.domain, b.domain) AS domain, coalesce(p.pipeline_run_id, b.pipeline_run_id) AS pipeline_run_id,
  coalesce(p.status, b.status) AS status, coalesce(p.last_error, b.last_error) AS last_error, p.total_tasks_success FROM base b FULL JOIN pat p ON b.domain = p.domain AND b.pipeline_run_id = p.pipeline_run_id"""),
    "upsert_copy_on_write": (upsert_copy_on_write, twin("", "run_state", "registry").rstrip() + _DELTA + _PATCH + """ SELECT coalesce(p.domain, b.domain) AS domain, coalesce(p.pipeline_run_id, b.pipeline_run_id) AS pipeline_run_id,
  coalesce(p.status, b.status) AS status, coalesce(p.last_error, b.last_error) AS last_error, p.total_tasks_success FROM base b FULL JOIN pat p ON b.domain = p.domain AND b.pipeline_run_id = p.pipeline_run_id"""),
    "upsert_replace": (upsert_replace, twin("", "run_state", "registry").rstrip() + _DELTA + _PATCH + """ SELECT coalesce(p.domain, b.domain) AS domain, coalesce(p.pipeline_run_id, b.pipeline_run_id) AS pipeline_run_id,
  coalesce(p.status, b.status) AS status, CASE WHEN p.total_tasks_success = '0' THEN NULL ELSE coalesce(p.last_error, b.last_error) END AS last_error,
  CASE WHEN p.total_tasks_success = '0' THEN NULL ELSE p.total_tasks_success END AS total_tasks_success FROM base b FULL JOIN pat p ON b.domain = p.domain AND b.pipeline_run_id = p.pipeline_run_id"""),
    "reconcile_runs": (reconcile_runs, twin("""SELECT domain, pipeline_run_id, CASE WHEN strict THEN 'COMPLETED' ELSE status END AS status, e AS total_tasks_expected, coalesce(success, 0) AS success,
  coalesce(record_count_sum, 0) AS record_count_sum, coalesce(pages_written_sum, 0) AS pages_written_sum, CASE WHEN strict THEN '2024-02-02' END AS completed_at,
  CASE WHEN NOT strict AND status IN ('FAILED', 'PARTIAL') AND failed_at <> '' THEN failed_at END AS failed_at,
  CASE WHEN strict AND (failed_at <> '' OR status IN ('FAILED', 'PARTIAL')) THEN '2024-02-02' END AS last_recovered_at, strict AS write_marker
  FROM (SELECT r.*, c.success, c.record_count_sum, c.pages_written_sum, CASE WHEN r.enq THEN coalesce(c.seen, 0) ELSE r.total_tasks_expected END AS e, r.enq AND coalesce(c.seen, 0) > 0 AND c.success = c.seen AS strict
  FROM registry r LEFT JOIN counts c USING (domain, pipeline_run_id))""", "counts", "registry")),
    "state_scan": (state_scan, twin("SELECT domain, row_key, status FROM run_state WHERE cur = 'ceap_daily_20240115' OR lst = 'ceap_daily_20240115'", "run_state")),
    "runs_scan": (runs_scan, twin("SELECT domain, pipeline_run_id, status, total_tasks_expected FROM registry WHERE status IN ('FAILED', 'PARTIAL')", "registry")),
    "replay_selection": (replay_selection, twin("""SELECT row_key, status, CAST(mes + event_id % 2 AS INTEGER) AS mes, mes + event_id % 2 > 1 AS future FROM run_state
  WHERE status IN ('FAILED', 'PENDING') AND (cur = 'ceap_daily_20240115' OR lst = 'ceap_daily_20240115')""", "run_state")),
    "replay_state": (replay_state, twin("""SELECT row_key, CASE WHEN s THEN 'QUEUED' ELSE status END AS status, CASE WHEN s THEN 'ceap_replay_20240120' ELSE cur END AS current_pipeline_run_id,
  CASE WHEN s THEN cur ELSE lst END AS last_pipeline_run_id, CASE WHEN s THEN '' ELSE 'e' END AS last_error
  FROM (SELECT *, status = 'FAILED' AND (cur = 'ceap_daily_20240115' OR coalesce(lst, '') = 'ceap_daily_20240115') AS s FROM run_state)""", "run_state")),
    "purge_counts": (purge_counts, _ART + twin(f""", r AS (SELECT 'd' || user_id AS domain FROM a WHERE run = 'ceap_daily_20240115' GROUP BY 1)
  SELECT 'control_run_records' AS artifact, count(*) AS n FROM r UNION ALL
  SELECT 'state_records', count(*) FROM (SELECT run, CASE event_id % 3 WHEN 0 THEN 'ceap_daily_' || strftime(ts - INTERVAL 1 DAY, '%Y%m%d') WHEN 1 THEN run END AS lst FROM a) WHERE run = 'ceap_daily_20240115' OR lst = 'ceap_daily_20240115' UNION ALL
  SELECT 'queue_messages', count(*) FROM a WHERE run = 'ceap_daily_20240115' AND event_type = 'view' UNION ALL
  SELECT 'poison_messages', count(*) FROM a WHERE run = 'ceap_daily_20240115' AND event_type = 'error' UNION ALL
  SELECT 'raw_files', count(*) FROM a WHERE run = 'ceap_daily_20240115' AND event_id % 3 = 0 UNION ALL
  SELECT 'metadata_files', count(*) FROM a WHERE run = 'ceap_daily_20240115' AND event_id % 3 = 1 UNION ALL
  SELECT 'locks', count(*) FROM r WHERE domain = 'd1' UNION ALL
  SELECT 'deputies_snapshot_files', count(*) FROM a WHERE run = 'ceap_daily_20240115' AND event_id % 3 = 2""")),
    "purge_survivors": (purge_survivors, twin("SELECT status, count(*) AS rows FROM run_state WHERE cur <> 'ceap_daily_20240115' AND coalesce(lst, '') <> 'ceap_daily_20240115' GROUP BY 1", "run_state")),
    "purge_all_survivors": (purge_all_survivors, twin("", "run_state", "registry").rstrip() + _ART.replace("WITH", ",", 1) + """
  SELECT 'runs' AS artifact, count(*) AS kept FROM registry WHERE pipeline_run_id <> 'ceap_daily_20240115' UNION ALL
  SELECT 'state', count(*) FROM run_state WHERE cur <> 'ceap_daily_20240115' AND coalesce(lst, '') <> 'ceap_daily_20240115' UNION ALL
  SELECT 'messages', count(*) FROM a WHERE run <> 'ceap_daily_20240115' UNION ALL
  SELECT 'files', count(*) FROM a WHERE run <> 'ceap_daily_20240115' UNION ALL
  SELECT 'files_but_snapshots', count(*) FROM a WHERE run <> 'ceap_daily_20240115' OR event_id % 3 = 2"""),
    "raw_files_for_run": (raw_files_for_run, _ART + " SELECT path FROM a WHERE run = 'ceap_daily_20240115' AND event_id % 3 <> 1"),
    "batch_totals": (batch_totals, _BATCH + """ SELECT control_id, hora, row_number() OVER w AS batch_index, CAST(sum(seen) OVER w AS BIGINT) AS records_seen_total, CAST(sum(enq) OVER w AS BIGINT) AS messages_enqueued_total,
  CAST(sum(skip) OVER w AS BIGINT) AS skipped_same_hash_total FROM b WINDOW w AS (PARTITION BY control_id ORDER BY hora)"""),
    "idle_streak": (idle_streak, _BATCH + """, g AS (SELECT *, sum(CASE WHEN enq > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY control_id ORDER BY hora) AS isl FROM b),
  s AS (SELECT control_id, hora, enq AS queued, CAST(sum(CASE WHEN enq = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY control_id, isl ORDER BY hora) AS BIGINT) AS idle_ticks FROM g)
  SELECT *, idle_ticks >= 3 AS enqueue_phase_complete FROM s"""),
    "parents_detected": (parents_detected, """SELECT dia, kind, parents, parents * CASE kind WHEN 'legislaturas_parent' THEN 2 ELSE 1 END AS expected_tasks FROM (
  SELECT strftime(ts, '%Y-%m-%d') AS dia, ['orgaos_parent','partidos_parent','frentes_parent','legislaturas_parent'][event_id % 4 + 1] AS kind, count(DISTINCT user_id) AS parents FROM events GROUP BY 1, 2)"""),
    "task_state_fold": (task_state_fold, twin("""SELECT row_key, status, current_pipeline_run_id, (SELECT arg_max(run_id, (ts, seq)) FROM task_events p WHERE p.row_key = b.row_key AND (p.ts, p.seq) < (b.dts, b.dseq)) AS last_pipeline_run_id,
  attempt_count, record_count, last_list_item_hash, last_success_at FROM (SELECT row_key, arg_max(status, (ts, seq)) AS status, arg_max(run_id, (ts, seq)) AS current_pipeline_run_id,
  max(ts) FILTER (status IN ('QUEUED', 'RUNNING')) AS dts, arg_max(seq, (ts, seq)) FILTER (status IN ('QUEUED', 'RUNNING')) AS dseq, count(*) FILTER (status = 'RUNNING') AS attempt_count,
  arg_max(record_count, (ts, seq)) FILTER (status = 'SUCCESS') AS record_count, arg_max(hash, (ts, seq)) FILTER (status = 'SUCCESS') AS last_list_item_hash,
  strftime(max(ts) FILTER (status = 'SUCCESS'), '%Y-%m-%d %H:%M:%S') AS last_success_at FROM task_events GROUP BY 1) b""", "task_events")),
    "requeue_stale": (requeue_stale, twin("""SELECT row_key, status, q AS requeued, CAST(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 0 END + CASE WHEN q THEN 1 ELSE 0 END AS INTEGER) AS stale_requeue_count
  FROM (SELECT *, status = 'QUEUED' AND ts <= TIMESTAMP '2024-01-20 11:00:00' AS q FROM run_state)""", "run_state")),
    "resume_page": (resume_page, twin("SELECT row_key, CAST(CASE WHEN cur = 'ceap_daily_20240115' AND status = 'RUNNING' AND page > 0 THEN page + 1 ELSE 1 END AS BIGINT) AS page FROM run_state", "run_state")),
}
