"""Queries over fan-out plans: five domains, budgets, resumable scans, cursors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tribuna import catalog
from tribuna.functions import hashing as H
from tribuna.functions import windows as W
from tribuna.operators import budget as B
from tribuna.operators import fanout as P
from tribuna.plans import stand_ins as ST
from tribuna.plans.stand_ins import twin
from tribuna.session import read_table
from tribuna.sources.sinks import changed_records as changed_op
from tribuna.streaming import task_state as TS

_SUBS = catalog.SUB_ENDPOINTS["proposicoes"]


def _items(spark, sf):
    rows = H.list_item_fingerprint(ST.list_items(spark, sf), "item", "proposicoes")
    return rows.select(F.col("id").cast("string").alias("id"), F.col("id").alias("num"), "uid", "hash")


def _prop_state(spark, sf):
    return ST.pair_state(spark, sf, _SUBS, "proposicoes", "proposicoes_daily_")


def _plan(spark, sf, force=False):
    return P.plan_hash_aware(_items(spark, sf), _SUBS, _prop_state(spark, sf), ST.PLAN_RUN, force)


def fanout_plan(spark, sf):
    return _plan(spark, sf).select("id", "endpoint", "row_key", "action")


def fanout_tallies(spark, sf):
    return B.tallies(_plan(spark, sf), "endpoint")


def votacoes_plan(spark, sf):
    items = H.list_item_fingerprint(ST.list_items(spark, sf), "item", "votacoes")
    items = items.select(F.col("id").cast("string").alias("id"), "uid", "hash")
    state = ST.pair_state(spark, sf, ("votacao_votos",), "votacoes", "votacoes_reconciliation_")
    return P.plan_votacoes(items, state, "votacoes_reconciliation_20240115").select("id", "row_key", "action")


_KINDS = ("orgaos_parent", "partidos_parent", "frentes_parent", "legislaturas_parent")
_MEMBERS = ("orgao_membros", "partido_membros", "frente_membros", "legislatura_lideres")


def institucional_plan(spark, sf):
    """Customers as parents; their kind follows from the key."""
    c = read_table(spark, sf, "customer")
    kinds = F.array(*[F.lit(k) for k in _KINDS])
    parents = c.select(F.col("c_custkey").cast("string").alias("id"), F.element_at(kinds, (F.col("c_custkey") % 4 + 1).cast("int")).alias("kind"))
    state = ST.pair_state(spark, sf, _MEMBERS, "institucional", "institucional_daily_")
    return P.plan_institucional(parents, state, "institucional_daily_20240115").select("kind", "id", "endpoint", "action")


def reference_plan(spark, sf):
    """Order dates as snapshot dates; every third already has state from its own run."""
    o = read_table(spark, sf, "orders")
    dates = o.select(ST.day_text(F.col("o_orderdate")).alias("reference_date"))
    names = F.array(*[F.lit(e.name) for e in catalog.domain_endpoints("reference")])
    per_date = o.groupBy(ST.day_text(F.col("o_orderdate")).alias("d")).agg(F.max("o_orderkey").alias("k"), F.max_by("o_orderstatus", "o_orderkey").alias("s"))
    state = per_date.where(F.col("k") % 3 != 0).select(
        F.concat(F.element_at(names, (F.col("k") % 5 + 1).cast("int")), F.lit("|"), F.col("d")).alias("row_key"),
        ST.pick(F.col("s"), {"F": "SUCCESS", "O": "QUEUED", "P": "FAILED"}).alias("status"),
        F.when(F.col("k") % 2 == 0, F.concat(F.lit("reference_snapshot_"), F.replace(F.col("d"), F.lit("-"), F.lit("")))).otherwise(F.lit("other")).alias("current_pipeline_run_id"),
        F.lit(0).alias("attempt_count"),
    )
    return P.plan_reference(dates.distinct(), state).select("reference_date", "endpoint", "pipeline_run_id", "action")


def _ceap_state(spark, sf):
    ev = ST.task_events(read_table(spark, sf, "events"))
    return TS.fold(ev, ["row_key"]).withColumns({
        "stale_requeue_count": F.when(F.col("attempt_count") % 2 == 0, F.lit(1)),
        "reprocess_count": F.when(F.col("attempt_count") % 3 == 0, F.lit(5)),
    })


def _ceap(spark, sf):
    now = ST.now()
    months = W.dispatch_order(F.lit(2024), F.lit("2024-03-05").cast("date"))
    return P.plan_ceap(read_table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), months, F.lit(2024),
                       _ceap_state(spark, sf), ST.CEAP_RUN, now, 60)


def ceap_plan(spark, sf):
    """Deputies × months; the months after the clock's are dropped."""
    return _ceap(spark, sf).select("id_deputado", "mes", "action")


def ceap_patch(spark, sf):
    """State rows the expense plan writes, with the stale counters."""
    out = P.dispatch_patch(_ceap(spark, sf), ST.CEAP_RUN, F.lit(ST.NOW))
    return out.select("row_key", "status", "last_pipeline_run_id", F.col("attempt_count").cast("bigint").alias("attempt_count"),
                      F.col("stale_requeue_count").cast("int").alias("stale_requeue_count"), F.col("reprocess_count").cast("int").alias("reprocess_count"))


def plan_budget(spark, sf):
    """The first 1000 messages of the plan in id order; what follows is deferred."""
    out = B.apply_budget(_plan(spark, sf), ["num", "seq"], 1000)
    return out.select("id", "endpoint", "outcome")


def plan_budget_large(spark, sf):
    """Two large budgets at once: 20 000 and 120 000 messages."""
    plan = _plan(spark, sf).select("id", "endpoint", "num", "seq", "action")
    small = B.apply_budget(plan, ["num", "seq"], 20_000).withColumnRenamed("outcome", "outcome_20k")
    return B.apply_budget(small, ["num", "seq"], 120_000).select("id", "endpoint", "outcome_20k", F.col("outcome").alias("outcome_120k"))


def backfill_plan(spark, sf):
    """Counts of a dry-run backfill limited to 2500 messages."""
    return B.backfill_summary(_plan(spark, sf), ["num", "seq"], ["num"], 2500, dry_run=True)


def backfill_force(spark, sf):
    """Counts of a forced backfill whose budget covers everything."""
    return B.backfill_summary(_plan(spark, sf, force=True), ["num", "seq"], ["num"], None, dry_run=False).select(
        "records_seen", "messages_enqueued", "records_skipped_same_run", F.lit(True).alias("forced"))


def resume_plan(spark, sf):
    """Positions of deputies × two months and the cursor each stands for, from a saved cursor on."""
    c = read_table(spark, sf, "customer")
    pairs = c.select(F.col("c_custkey").alias("id"), F.posexplode(F.array(F.lit(2), F.lit(1))).alias("month_idx", "mes"))
    placed = B.with_ordinal(pairs, ["id", "month_idx"])
    cur = B.resume_cursor(F.col("ordinal"), 2)
    return B.resume_at(placed, 1, 30, 1, 2).select("id", "mes", "ordinal", cur["next_pagina"].alias("pagina"), cur["next_idx"].alias("idx"), cur["next_month_idx"].alias("month_idx"))


def page_slice(spark, sf):
    """Three pages from each conversation's own next page, and the checkpoint after them."""
    c = read_table(spark, sf, "conversations").select(
        "conv_id", (F.col("turn") + 1).alias("page"), (F.col("role") == "assistant").alias("is_last"))
    cut = B.page_slice(c, F.col("conv_id") % 2 + 1, 3)
    return B.slice_checkpoint(cut, "conv_id")


def changed_records(spark, sf):
    return changed_op(_plan(spark, sf))


def worker_skips(spark, sf):
    """What a worker drops when it re-reads state: unchanged items unless forced, finished pairs."""
    plan = _plan(spark, sf)
    why = P.worker_skips(F.lit(ST.PLAN_RUN), force=(F.col("num") % 10 == 0))
    return plan.select("id", "endpoint", why.alias("reason")).where(F.col("reason").isNotNull())


def cursor_filter(spark, sf):
    """Ids after the cursor of the successful microbatch tasks of all events; text ids always pass.

    Every second event is a task of the reconciliation, whose successes never move the cursor.
    """
    e = read_table(spark, sf, "events")
    done = e.select(
        F.col("user_id").cast("string").alias("id"), ST.pick(F.col("event_type"), ST.STATUS).alias("status"),
        F.when(F.col("event_id") % 2 == 0, F.lit("microbatch")).otherwise(F.lit("reconciliation")).alias("run_type"))
    cursor = P.advance_cursor(done, old=7)
    p = read_table(spark, sf, "pages")
    pid = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("55-"), F.col("page_id").cast("string"))).otherwise(F.col("page_id").cast("string"))
    return P.after_cursor(p.select(pid.alias("id")), cursor.scalar())


_PLAN = """, plan AS (SELECT CAST(i.id AS VARCHAR) AS id, i.id AS num, i.hash, i.uid, p.seq, p.endpoint, s.status, 'proposicoes_daily_' || s.ymd AS run, s.hash AS shash, s.k,
  CASE WHEN s.ymd = '20240115' AND s.status IN ('QUEUED', 'RUNNING') THEN 'skip_queued' WHEN s.status = 'SUCCESS' AND s.hash = i.hash THEN 'skip_same_hash' ELSE 'enqueue' END AS action
  FROM items i CROSS JOIN (VALUES (0, 'proposicao_autores'), (1, 'proposicao_tramitacoes')) p(seq, endpoint) LEFT JOIN stored s ON s.event_id = i.id AND s.event_id % 2 = p.seq)
"""


def _plan_twin(select: str) -> str:
    return twin("", "items", "stored").rstrip() + _PLAN + select


_CEAP = """, st AS (SELECT row_key, status, current_pipeline_run_id AS cur, attempt_count, dts, sts FROM (SELECT row_key, arg_max(status, (ts, seq)) AS status, arg_max(run_id, (ts, seq)) AS current_pipeline_run_id,
  count(*) FILTER (status = 'RUNNING') AS attempt_count, max(ts) FILTER (status = 'QUEUED') AS dts, max(ts) FILTER (status = 'RUNNING') AS sts FROM task_events GROUP BY 1)),
  pl AS (SELECT c_custkey AS id_deputado, 1 AS mes, 'despesas|' || c_custkey || '|2024|1' AS rk FROM customer),
  plan AS (SELECT pl.*, st.*, CASE WHEN st.row_key IS NULL THEN 'enqueue_new' WHEN status IN ('PENDING', 'FAILED', 'POISON', 'STALE') THEN 'enqueue_reprocess'
  WHEN cur = 'ceap_daily_20240115' AND status = 'SUCCESS' THEN 'skip_success_same_run' WHEN status = 'QUEUED' AND dts < TIMESTAMP '2024-01-20 11:00:00' THEN 'enqueue_stale_queued' WHEN status = 'QUEUED' THEN 'skip_queued'
  WHEN status = 'RUNNING' AND sts < TIMESTAMP '2024-01-20 11:00:00' THEN 'enqueue_stale_running' WHEN status = 'RUNNING' THEN 'skip_running' ELSE 'enqueue_reprocess' END AS action FROM pl LEFT JOIN st ON st.row_key = pl.rk)
"""


def _ceap_twin(select: str) -> str:
    return twin("", "task_events").rstrip() + _CEAP + select


_VOT = """WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'votacao_votos|' || o_orderkey AS row_key, CASE WHEN strftime(ts, '%Y%m%d') = '20240115' AND event_type IN ('view', 'click') THEN 'skip_queued'
 WHEN event_type = 'purchase' AND substr('FOP', k % 3 + 1, 1) = o_orderstatus THEN 'skip_same_hash' ELSE 'enqueue' END AS action FROM orders LEFT JOIN e ON event_id = o_orderkey"""

QUERIES = {
    "fanout_plan": (fanout_plan, _plan_twin("SELECT id, endpoint, endpoint || '|' || id AS row_key, action FROM plan")),
    "fanout_tallies": (fanout_tallies, _plan_twin("""SELECT endpoint, count(*) AS pairs_seen, count(*) FILTER (action = 'enqueue') AS enqueued, count(*) FILTER (action = 'skip_same_hash') AS skipped_same_hash,
  count(*) FILTER (action = 'skip_queued') AS skipped_queued, CAST(0 AS BIGINT) AS skipped_success FROM plan GROUP BY 1""")),
    "votacoes_plan": (votacoes_plan, _VOT),
    "institucional_plan": (institucional_plan, """WITH p AS (SELECT c_custkey, ['orgaos_parent','partidos_parent','frentes_parent','legislaturas_parent'][c_custkey % 4 + 1] AS kind FROM customer),
  x AS (SELECT kind, c_custkey, unnest(CASE c_custkey % 4 WHEN 0 THEN ['orgao_membros'] WHEN 1 THEN ['partido_membros'] WHEN 2 THEN ['frente_membros'] ELSE ['legislatura_lideres', 'legislatura_mesa'] END) AS endpoint FROM p),
  s AS (SELECT *, ['orgao_membros','partido_membros','frente_membros','legislatura_lideres'][event_id % 4 + 1] AS ep FROM events)
  SELECT kind, CAST(c_custkey AS VARCHAR) AS id, endpoint, CASE WHEN strftime(ts, '%Y%m%d') = '20240115' AND event_type = 'purchase' THEN 'skip_success'
  WHEN strftime(ts, '%Y%m%d') = '20240115' AND event_type IN ('view', 'click') THEN 'skip_queued' ELSE 'enqueue' END AS action FROM x LEFT JOIN s ON s.event_id = c_custkey AND s.ep = x.endpoint"""),
    "reference_plan": (reference_plan, """WITH d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS d, max(o_orderkey) AS k, arg_max(o_orderstatus, o_orderkey) AS s FROM orders GROUP BY 1),
  st AS (SELECT d, s, ['partidos','legislaturas','deputados','frentes','orgaos'][k % 5 + 1] AS ep, k % 2 = 0 AS mine FROM d WHERE k % 3 <> 0)
  SELECT d.d AS reference_date, e.endpoint, 'reference_snapshot_' || replace(d.d, '-', '') AS pipeline_run_id, CASE WHEN mine AND st.s = 'F' THEN 'skip_success' WHEN mine AND st.s = 'O' THEN 'skip_queued' ELSE 'enqueue' END AS action
  FROM d CROSS JOIN (SELECT unnest(['partidos','legislaturas','deputados','frentes','orgaos']) AS endpoint) e LEFT JOIN st ON st.d = d.d AND st.ep = e.endpoint"""),
    "ceap_plan": (ceap_plan, _ceap_twin("SELECT id_deputado, CAST(mes AS INTEGER) AS mes, action FROM plan")),
    "ceap_patch": (ceap_patch, _ceap_twin("""SELECT rk AS row_key, 'QUEUED' AS status, coalesce(cur, '') AS last_pipeline_run_id, coalesce(attempt_count, 0) AS attempt_count,
  CAST(CASE WHEN attempt_count % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN action LIKE 'enqueue_stale%' AND NOT (attempt_count % 2 <> 0 AND attempt_count % 3 = 0) THEN 1 ELSE 0 END AS INTEGER) AS stale_requeue_count,
  CAST(CASE WHEN attempt_count % 3 = 0 THEN 5 ELSE 0 END + CASE WHEN action LIKE 'enqueue_stale%' AND attempt_count % 2 <> 0 AND attempt_count % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS reprocess_count
  FROM plan WHERE action LIKE 'enqueue%'""")),
    "plan_budget": (plan_budget, _plan_twin("""SELECT id, endpoint, CASE WHEN before >= 1000 THEN 'deferred' WHEN action = 'enqueue' THEN 'dispatch' ELSE 'skip' END AS outcome FROM (
  SELECT *, coalesce(count(*) FILTER (action = 'enqueue') OVER (ORDER BY num, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM plan)""")),
    "backfill_plan": (backfill_plan, _plan_twin("""SELECT count(DISTINCT num) FILTER (num <= coalesce(stop, num)) AS records_seen, CAST(0 AS BIGINT) AS messages_enqueued, count(*) FILTER (before < 2500 AND action = 'enqueue') AS would_enqueue,
  count(*) FILTER (before < 2500 AND action = 'skip_same_hash') AS records_skipped_same_hash, count(*) FILTER (before < 2500 AND action = 'skip_queued') AS records_skipped_same_run,
  count(*) FILTER (before >= 2500) > 0 AS limit_reached, 'DRY_RUN' AS status FROM (SELECT *, min(num) FILTER (before >= 2500) OVER () AS stop FROM (
  SELECT *, coalesce(count(*) FILTER (action = 'enqueue') OVER (ORDER BY num, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM plan))""")),
    "backfill_force": (backfill_force, _plan_twin("""SELECT count(DISTINCT num) AS records_seen, count(*) FILTER (action <> 'skip_queued') AS messages_enqueued,
  count(*) FILTER (action = 'skip_queued') AS records_skipped_same_run, true AS forced FROM plan""")),
    "plan_budget_large": (plan_budget_large, _plan_twin("""SELECT id, endpoint, CASE WHEN before >= 20000 THEN 'deferred' WHEN action = 'enqueue' THEN 'dispatch' ELSE 'skip' END AS outcome_20k,
  CASE WHEN before >= 120000 THEN 'deferred' WHEN action = 'enqueue' THEN 'dispatch' ELSE 'skip' END AS outcome_120k FROM (
  SELECT *, coalesce(count(*) FILTER (action = 'enqueue') OVER (ORDER BY num, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM plan)""")),
    "resume_plan": (resume_plan, """WITH p AS (SELECT c_custkey AS id, m AS month_idx, 2 - m AS mes, row_number() OVER (ORDER BY c_custkey, m) - 1 AS ordinal FROM customer, range(0, 2) r(m))
  SELECT id, CAST(mes AS INTEGER) AS mes, ordinal, CAST((ordinal // 2) // 100 + 1 AS INTEGER) AS pagina, CAST((ordinal // 2) % 100 AS INTEGER) AS idx, CAST(ordinal % 2 AS INTEGER) AS month_idx FROM p WHERE ordinal >= 61"""),
    "page_slice": (page_slice, """SELECT conv_id, bool_or(role = 'assistant') AS listing_complete, CASE WHEN bool_or(role = 'assistant') THEN 1 ELSE max(turn + 1) + 1 END AS list_next_page
  FROM conversations WHERE turn + 1 BETWEEN conv_id % 2 + 1 AND conv_id % 2 + 3 GROUP BY 1"""),
    "changed_records": (changed_records, _plan_twin("SELECT id, hash AS list_item_hash, endpoint, 'enqueue' AS reason FROM plan WHERE action = 'enqueue'")),
    "worker_skips": (worker_skips, _plan_twin("""SELECT id, endpoint, CASE WHEN status = 'SUCCESS' AND shash = hash AND num % 10 <> 0 THEN 'unchanged_list_item' WHEN status = 'SUCCESS' AND run = 'proposicoes_daily_20240115' THEN 'already_success_in_run' END AS reason
  FROM plan WHERE (status = 'SUCCESS' AND shash = hash AND num % 10 <> 0) OR (status = 'SUCCESS' AND run = 'proposicoes_daily_20240115')""")),
    "cursor_filter": (cursor_filter, """WITH c AS (SELECT greatest(coalesce(max(user_id), 0), 7) AS c FROM events WHERE event_type = 'purchase' AND event_id % 2 = 0)
  SELECT CASE WHEN page_id % 5 = 0 THEN '55-' || page_id ELSE CAST(page_id AS VARCHAR) END AS id FROM pages, c WHERE page_id % 5 = 0 OR page_id > c.c"""),
}
