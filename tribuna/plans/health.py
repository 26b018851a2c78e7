"""Queries over manifests and daily health: validation, inspection, rollups, documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tribuna.operators import layers as L
from tribuna.operators import manifests as MF
from tribuna.operators import summary as SU
from tribuna.operators import validation as V
from tribuna.plans import records
from tribuna.plans import stand_ins as ST
from tribuna.plans.stand_ins import twin
from tribuna.session import read_table, spread

NAMES = ("ceap", "reference_snapshot", "votacoes", "proposicoes", "eventos", "institucional", "discursos", "mystery")


def manifest_validate(spark, sf):
    """First failing rule under the snapshot and the fan-out profile; markers checked last."""
    done = V.validate_completed(ST.run_manifests(spark, sf), ST.run_markers(spark, sf), V.FANOUT_RUN)
    snapshot = F.coalesce(V.invalid_reason(V.DIMENSION_SNAPSHOT, F.lit(True)), F.lit(""))
    return done.select("pipeline_run_id", snapshot.alias("snapshot_reason"), F.col("reason").alias("fanout_reason"), "ok")


def _inspected(spark, sf):
    return SU.inspect_runs(ST.expected_runs(spark, sf), ST.run_manifests(spark, sf), ST.run_markers(spark, sf), ST.run_controls(spark, sf))


def inspect_runs(spark, sf):
    i = _inspected(spark, sf)
    kinds = F.transform("warnings", lambda w: w["warning_type"])
    return i.select("reference_date", "domain", "pipeline_run_id", "status", F.array_join(kinds, ",").alias("warnings"))


def collect_warnings(spark, sf):
    """Warnings of all runs and of the placeholders of expected domains without runs."""
    i = _inspected(spark, sf)
    out = SU.collect_warnings(i, "reference_date", placeholders=SU.placeholder_warnings(_days(spark, sf), i, NAMES))
    return out.select("reference_date", "domain", "pipeline_run_id", "warning_type", "message")


def marker_join(spark, sf):
    """COMPLETED without marker, marker without COMPLETED."""
    j = SU.join_markers(ST.run_manifests(spark, sf), ST.run_markers(spark, sf))
    done = F.upper(F.trim("status")) == "COMPLETED"
    return j.groupBy(done.alias("completed"), "has_marker").agg(F.count(F.lit(1)).alias("runs"))


def _days(spark, sf):
    return ST.expected_runs(spark, sf).select("reference_date").distinct()


def _domains(spark, sf):
    return SU.rollup_expected(_days(spark, sf), _inspected(spark, sf).select("reference_date", "domain", "status"), NAMES)


def rollup_domain(spark, sf):
    return _domains(spark, sf).drop("placeholder")


def expected_vs_found(spark, sf):
    i = _inspected(spark, sf).select("reference_date", "domain", "pipeline_run_id", "status")
    return SU.expected_vs_found(_days(spark, sf), i, NAMES).select("reference_date", "expected", "pipeline_run_id", "status", "placeholder")


def rollup_daily(spark, sf):
    return SU.rollup_daily(_domains(spark, sf), "reference_date")


def summary_counts(spark, sf):
    return SU.summary_counts(_domains(spark, sf), "reference_date")


def _documents(spark, sf):
    return SU.daily_documents(_days(spark, sf), _inspected(spark, sf), NAMES)


def daily_documents(spark, sf):
    """Summary documents, flattened, with the gate of the daily marker."""
    from tribuna.sources.sinks import is_green

    return _documents(spark, sf).select(
        "reference_date", "status", F.col("summary.total_domains_failed").alias("failed"), F.col("domain_status.ceap").alias("ceap"),
        "warnings_count", F.array_join("warning_types", ",").alias("warning_types"),
        is_green(F.col("status"), F.col("warning_types")).alias("green"),
    )


def collect_runs(spark, sf):
    """Union of two collections with different columns, first row per run wins."""
    m = ST.run_manifests(spark, sf).select("domain", "pipeline_run_id", "status", F.lit(0).alias("ordinal"))
    c = ST.run_controls(spark, sf).select("domain", "pipeline_run_id", F.lit("control").alias("note"), F.lit(1).alias("ordinal"))
    return SU.dedup_runs(SU.collect_runs(m, c), ["domain", "pipeline_run_id"]).select("domain", "pipeline_run_id", "status", "note")


def _snapshots(spark, sf):
    o = read_table(spark, sf, "orders")
    s = ST.pick(F.col("o_orderstatus"), {"F": "COMPLETED", "O": "RUNNING", "P": "PARTIAL"})
    per_day = o.groupBy(ST.day_text(F.col("o_orderdate")).alias("reference_date")).agg(
        F.max_by(F.struct(F.col("o_orderkey").alias("k"), s.alias("s"), F.col("o_custkey").alias("c")), "o_orderkey").alias("v"))
    k, c = F.col("v.k"), F.col("v.c")
    return per_day.select(
        "reference_date", F.col("v.s").alias("status"), F.concat(F.lit("r"), k.cast("string")).alias("pipeline_run_id"),
        (c % 6).alias("record_count"), (c % 3 + 1).alias("total_pages"), F.when(k % 5 == 0, 9).otherwise(c % 3 + 1).alias("files_written"),
        (k % 7 != 0).alias("has_marker"))


def snapshot_valid_latest(spark, sf):
    """Snapshot used on each date: today's, an older one (reconciliation), or a new one."""
    base = V.latest_before_each(_snapshots(spark, sf))
    base = base.withColumn("created_records", F.substring("reference_date", 10, 1).cast("int") % 3)
    mode = F.when(F.substring("reference_date", 9, 2).cast("int") % 2 == 0, F.lit("reconciliation")).otherwise(F.lit("daily"))
    out = V.choose_snapshot(base, mode)
    return out.select("reference_date", "fallback_date", "fallback_run", "snapshot_source", "snapshot_date")


def latest_snapshot(spark, sf):
    return V.latest_snapshot(_snapshots(spark, sf), F.lit("1999-06-15"))


def snapshot_scan(spark, sf):
    return V.valid_snapshots(_snapshots(spark, sf)).select("reference_date", "pipeline_run_id")


def validate_requests(spark, sf):
    """Backfill requests with all kinds of mistakes and their error codes."""
    o = spread(read_table(spark, sf, "orders"))
    k = F.col("o_orderkey")
    req = o.select(
        "o_orderkey",
        F.when(k % 9 == 0, F.lit("")).when(k % 9 == 1, F.lit("abc")).otherwise((F.lit(1997) + k % 3).cast("string")).alias("year"),
        F.when(k % 4 == 0, ST.day_text(F.col("o_orderdate"))).when(k % 23 == 0, F.lit("1998-02-30")).otherwise(F.lit("")).alias("start_date"),
        F.when(k % 5 == 0, F.lit("1998-03-01")).otherwise(F.lit(None)).alias("end_date"),
        F.when(k % 6 == 0, F.lit("")).when(k % 6 == 1, F.lit("ceap, Mars,moon")).otherwise(F.lit("votacoes,eventos")).alias("domains"),
        F.when(k % 2 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("force"),
        F.when(k % 8 == 0, F.lit("0")).when(k % 8 == 1, F.lit("200000")).when(k % 8 == 2, F.lit("6000")).when(k % 8 == 3, F.lit("many")).alias("max_tasks"),
        F.when(k % 3 == 0, F.lit("true")).otherwise(F.lit(None)).alias("confirm_max_tasks"),
    )
    now = F.lit("1998-06-15 00:00:00").cast("timestamp_ntz")
    return V.validate_requests(req, now).select("o_orderkey", F.array_join("errors", ",").alias("errors"))


def validate_windows(spark, sf):
    o = spread(read_table(spark, sf, "orders"))
    k = F.col("o_orderkey")
    s = F.when(k % 7 == 0, F.lit("not-a-date")).otherwise(ST.day_text(F.col("o_orderdate")))
    out = V.window_errors(s, F.lit("1998-06-30"), F.lit(1998), k % 5 == 0)
    return o.select("o_orderkey", F.array_join(out, ",").alias("errors"))


def _run_rows(spark, sf):
    o = spread(read_table(spark, sf, "orders"))
    k = F.col("o_orderkey")
    day = ST.day_text(F.col("o_orderdate"))
    return o.select(
        F.concat(F.lit("ceap_daily_"), F.replace(day, F.lit("-"), F.lit("")), F.lit("_"), k.cast("string")).alias("pipeline_run_id"),
        F.when(k % 3 == 0, F.lit("reconciliation")).when(k % 3 == 1, F.lit("microbatch")).otherwise(F.lit("backfill")).alias("mode"),
        F.lower(ST.pick(F.col("o_orderstatus"), {"F": "COMPLETED", "O": "QUEUING", "P": "failed"})).alias("status"),
        day.alias("started_at"), F.when(F.col("o_orderstatus") == "F", day).alias("completed_at"),
        F.lit("2001-08-01").alias("created_at"), F.when(F.col("o_orderstatus") == "P", day).alias("failed_at"),
        F.when(F.col("o_orderstatus") == "P", F.lit("boom")).otherwise(F.lit("")).alias("error_message"),
        F.when(k % 4 == 0, F.lit("[5, 4]")).when(k % 4 == 1, F.lit('["3","x",2]')).otherwise(F.lit("?")).alias("months_to_process"),
        F.year("o_orderdate").alias("target_year"), (k % 10).alias("total_tasks_expected"), (k % 10).alias("total_tasks_success"),
        (k % 2 == 0).alias("enqueue_phase_complete"), (F.col("o_custkey") % 50).alias("detected"),
        F.when(k % 5 != 0, F.concat(F.lit("raw/x/"), day)).otherwise(F.lit("")).alias("deputies_snapshot_path"),
        F.when(k % 6 == 0, F.lit(77)).alias("total_records_collected"), day.alias("window_start_utc"),
        F.when(k % 5 == 0, F.lit("OSError")).alias("error_type"),
    )


def manifest_docs(spark, sf):
    """Manifest text of expense runs, read back field by field: present, null and absent."""
    doc = MF.build_ceap_manifest(_run_rows(spark, sf)).select("pipeline_run_id", "manifest")
    names = {"status": "status", "run_type": "run_type", "months": "reference_months", "marker": "success_marker_path",
             "expected": "total_tasks_expected", "done": "enqueue_phase_complete", "parent_path": "parent_snapshot_path",
             "error": "error_message", "records": "total_records_collected", "completed_at": "completed_at"}
    keys = {"has_parent": "parent_entity", "has_error": "error_message", "has_pages": "total_pages", "has_error_type": "error_type"}
    fields = F.json_tuple("manifest", *names.values())
    m = doc.select("pipeline_run_id", F.json_object_keys("manifest").alias("_keys"), fields.alias(*names))
    return m.select("pipeline_run_id", *names, *[F.array_contains("_keys", k).alias(n) for n, k in keys.items()])


def manifest_docs_domain(spark, sf):
    """Aggregate manifests of the fan-out domains."""
    rows = _run_rows(spark, sf)
    out = None
    names = {"domain": "domain", "run_type": "run_type", "status": "status", "fanout_from": "fanout_from",
             "parents": "parent_record_count", "watermark": "watermark_field", "marker": "success_marker_path",
             "audit": "audit_fields_applied", "records": "total_records_collected"}
    for domain in MF.FANOUT_MANIFESTS:
        m = MF.build_domain_manifest(rows, domain)
        part = m.select("pipeline_run_id", F.json_tuple("manifest", *names.values()).alias(*names))
        out = part if out is None else out.unionByName(part)
    return out


def manifest_docs_snapshot(spark, sf):
    """Deputies-snapshot manifests; unknown statuses fold to RUNNING."""
    s = _snapshots(spark, sf).withColumns({
        "execution_id": F.lit("x"), "started_at": F.col("reference_date"), "completed_at": F.lit(None).cast("string"),
        "created_at": F.col("reference_date"), "error_message": F.lit(""), "reference_timezone": F.lit("America/Sao_Paulo"),
        "status": F.when(F.col("status") == "PARTIAL", F.lit("weird")).otherwise(F.col("status")),
    })
    m = MF.build_snapshot_manifest(s)
    get = lambda p: F.get_json_object("manifest", f"$.{p}")
    return m.select("reference_date", get("status").alias("status"), get("snapshot_status").alias("snapshot_status"),
                    get("files_written").alias("files"), get("raw_path").alias("raw_path"), get("_loaded_at").alias("loaded_at"))


def manifest_docs_detail(spark, sf):
    """Manifests of the sub-resource snapshots, one per conversation, and of a reference list per source."""
    names = {"endpoint": "endpoint", "status": "status", "raw_path": "raw_path", "marker": "success_marker_path", "pages": "total_pages",
             "records": "record_count", "completed_at": "completed_at", "failed_at": "failed_at_utc", "items_per_page": "items_per_page",
             "snapshot_type": "snapshot_type", "parent": "votacao_id"}
    times = {"pipeline_run_id": F.lit("r1"), "execution_id": F.lit("x"), "started_at": F.lit("s"), "finished_at": F.lit("f"), "error_message": F.lit("")}
    votes = records.snapshot_pages(spark, sf).withColumns({**times, "parent_id": F.col("parent_id").cast("string")})
    lists = ST.text_pages(spark, sf).groupBy("parent_id").agg(
        F.count(F.lit(1)).alias("pages_written"), F.sum(F.size("dados")).cast("bigint").alias("record_count"))
    lists = lists.withColumns({**times, "final_status": F.lit("COMPLETED"), "reference_date": F.col("parent_id"), "reference_timezone": F.lit("tz")})
    docs = MF.build_detail_manifest(votes, "votacao_votos").select("manifest").unionByName(MF.build_detail_manifest(lists, "partidos").select("manifest"))
    return docs.select(F.json_tuple("manifest", *names.values()).alias(*names))


def batch_manifests(spark, sf):
    """Reconciliation-batch manifests of the hourly batches, and their operation manifests."""
    e = read_table(spark, sf, "events")
    b = e.groupBy("event_type", ST.day_text(F.col("ts")).alias("dia"), F.hour("ts").alias("batch_index")).agg(
        F.count(F.lit(1)).alias("records_seen"), F.count_if(ST.k_value() > 50).alias("messages_enqueued"),
        F.count_if(ST.k_value() <= 50).alias("records_skipped_same_hash"), F.max("event_id").alias("top"))
    rows = b.withColumns({
        "control_id": F.concat(F.lit("c-"), F.col("dia")), "pipeline_run_id": F.lit("proposicoes_recoctl_1"), "domain": F.upper("event_type"),
        "window_start": F.col("dia"), "window_end": F.col("dia"), "started_at": F.col("dia"), "finished_at": F.col("dia"),
        "checkpoint_before": F.struct(F.col("batch_index").alias("list_next_page")), "checkpoint_after": F.struct((F.col("batch_index") + 1).alias("list_next_page")),
        "error": F.when(F.col("top") % 10 == 0, F.lit("boom")),
    })
    return MF.batch_manifest(rows).select("manifest_path", "kind", "status", "records_failed", "records_seen", "messages_enqueued",
                                          F.col("checkpoint_after.list_next_page").alias("next_page"))


def operation_manifests(spark, sf):
    """One list-operation manifest per event day."""
    e = read_table(spark, sf, "events")
    day = ST.day_text(F.col("ts"))
    c = e.groupBy(day.alias("window_start")).agg(
        F.countDistinct("user_id").alias("records_seen"), F.count_if(F.col("event_type") == "view").alias("enqueued"),
        F.count_if(F.col("event_type") == "purchase").alias("skipped_same_hash"), F.count_if(F.col("event_type") == "nothing").alias("failed"))
    c = c.withColumns({
        "endpoint": F.lit("/proposicoes"), "pipeline_name": F.lit("proposicoes_daily"), "window_end": F.col("window_start"),
        "pipeline_run_id": F.concat(F.lit("proposicoes_daily_"), F.replace("window_start", F.lit("-"), F.lit(""))),
        "started_at": F.col("window_start"), "finished_at": F.col("window_start")})
    out = MF.operation_manifest(c, MF.list_run_dir(F.col("window_start").cast("date"), F.col("pipeline_run_id")))
    return out.select("run_id", "raw_path", "records_seen", "records_written", "records_skipped_same_hash", "records_failed", "status")


def microbatch_sla(spark, sf):
    """Ten-minute windows of the event feed: missing runs and completion delay per day."""
    e = read_table(spark, sf, "events")
    slot = F.window(F.col("ts").cast("timestamp"), "10 minutes")["start"]
    runs = e.where(F.col("event_type") == "purchase").groupBy(slot.alias("window_start")).agg(
        F.max(F.col("ts").cast("timestamp") + F.make_dt_interval(mins=ST.k_value())).alias("completed_at"))
    bounds = e.agg(F.min(slot).alias("lo"), F.max(slot).alias("hi"))
    return L.microbatch_sla(L.schedule(bounds, 10), runs, 10)


_SNAP = """WITH v AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS reference_date, max(o_orderkey) AS k, arg_max(o_orderstatus, o_orderkey) AS s, arg_max(o_custkey, o_orderkey) AS c FROM orders GROUP BY 1),
  ok AS (SELECT *, 'r' || k AS run, s = 'F' AND c % 6 > 0 AND (k % 5 <> 0 OR c % 3 + 1 = 9) AND k % 7 <> 0 AS valid FROM v)"""
_RR = """WITH r AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d, 'ceap_daily_' || strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey AS pipeline_run_id FROM orders)"""

QUERIES = {
    "manifest_validate": (manifest_validate, twin("""SELECT pipeline_run_id, CASE WHEN upper(status) <> 'COMPLETED' THEN 'status=' || status WHEN record_count <= 0 THEN 'record_count<=0' WHEN total_pages <= 0 THEN 'total_pages<=0'
  WHEN files_written IS NOT NULL AND files_written <> total_pages THEN 'files_written!=total_pages' ELSE '' END AS snapshot_reason, f AS fanout_reason, f = '' AS ok FROM (SELECT *,
  CASE WHEN upper(status) <> 'COMPLETED' THEN 'status=' || status WHEN t_exp < 0 THEN 'total_tasks_expected<0' WHEN t_exp = 0 AND t_ok <> 0 THEN 'total_tasks_success!=0 when total_tasks_expected=0'
  WHEN t_exp = 0 AND t_bad <> 0 THEN 'total_tasks_failed!=0 when total_tasks_expected=0' WHEN t_exp = 0 AND t_poison <> 0 THEN 'total_tasks_poison!=0 when total_tasks_expected=0' WHEN t_exp = 0 AND t_running <> 0 THEN 'total_tasks_running!=0 when total_tasks_expected=0'
  WHEN t_exp > 0 AND t_ok <> t_exp THEN 'success!=expected' WHEN t_exp > 0 AND t_bad <> 0 THEN 'total_tasks_failed!=0' WHEN t_exp > 0 AND t_poison <> 0 THEN 'total_tasks_poison!=0' WHEN t_exp > 0 AND t_running <> 0 THEN 'total_tasks_running!=0'
  WHEN NOT has_marker THEN 'success_marker_missing' ELSE '' END AS f FROM manifests WHERE found)""", "manifests")),
    "inspect_runs": (inspect_runs, twin("""SELECT reference_date, domain, pipeline_run_id, derived AS status, concat_ws(',', CASE WHEN NOT found THEN 'metadata_not_found' END, CASE WHEN found AND st = 'COMPLETED' AND NOT has_marker THEN 'success_marker_missing' END,
  CASE WHEN found AND has_marker AND st NOT IN ('COMPLETED', 'NO_DATA') THEN 'success_marker_exists_but_status_not_completed' END, CASE WHEN found AND t_exp > 0 AND t_ok <> t_exp AND st = 'COMPLETED' THEN 'task_counts_inconsistent' END,
  CASE WHEN found AND bad AND st IN ('COMPLETED', 'NO_DATA') THEN 'task_counts_inconsistent' END, CASE WHEN found AND control <> '' AND control <> derived AND derived NOT IN ('NOT_FOUND', 'INVALID_METADATA') THEN 'ingestion_control_differs_from_raw_metadata' END) AS warnings FROM insp""", "insp")),
    "collect_warnings": (collect_warnings, twin("""SELECT reference_date, domain, pipeline_run_id, w AS warning_type, CASE
  WHEN w = 'domain_not_implemented' THEN 'No collector wired for domain ' || chr(39) || domain || chr(39) || '.'
  WHEN w = 'metadata_not_found' AND pipeline_run_id = '' THEN 'No pipeline_run_id directories matched this reference_date.'
  WHEN w = 'metadata_not_found' THEN 'metadata.json missing' WHEN w = 'success_marker_missing' THEN 'metadata.status is COMPLETED but _SUCCESS was not found'
  WHEN w = 'success_marker_exists_but_status_not_completed' THEN '_SUCCESS exists but metadata.status is ' || st
  WHEN w = 'task_counts_inconsistent' AND why = 4 THEN 'status COMPLETED but total_tasks_success != total_tasks_expected'
  WHEN w = 'task_counts_inconsistent' THEN 'failed/poison counters > 0 but status is terminal-success-like'
  ELSE 'control status ' || control || ' vs metadata-derived ' || derived END AS message FROM warns""", "warns")),
    "marker_join": (marker_join, twin("SELECT upper(trim(status)) = 'COMPLETED' AS completed, has_marker, count(*) AS runs FROM manifests WHERE found GROUP BY 1, 2", "manifests")),
    "expected_vs_found": (expected_vs_found, twin("""SELECT reference_date, expected, pipeline_run_id, status, pipeline_run_id IS NULL AND domain NOT IN ('ceap', 'reference', 'votacoes', 'institucional') AS placeholder FROM evf""", "evf")),
    "rollup_domain": (rollup_domain, twin("SELECT * FROM droll", "droll")),
    "rollup_daily": (rollup_daily, twin("SELECT * FROM dayroll", "dayroll")),
    "summary_counts": (summary_counts, twin("""SELECT reference_date, count(*) AS total_domains_expected, count(*) FILTER (domain_status = 'COMPLETED') AS total_domains_completed, count(*) FILTER (domain_status = 'RUNNING') AS total_domains_running,
  count(*) FILTER (domain_status = 'FAILED') AS total_domains_failed, count(*) FILTER (domain_status = 'NO_DATA') AS total_domains_no_data, count(*) FILTER (domain_status = 'NOT_FOUND') AS total_domains_not_found,
  count(*) FILTER (domain_status = 'PARTIAL') AS total_domains_partial, count(*) FILTER (domain_status = 'NOT_IMPLEMENTED') AS total_domains_not_implemented FROM droll GROUP BY 1""", "droll")),
    "daily_documents": (daily_documents, twin("""SELECT d.reference_date, d.status, f.failed, f.ceap, coalesce(w.n, 0) AS warnings_count, coalesce(w.kinds, '') AS warning_types, d.status = 'COMPLETED' AND coalesce(w.crit, 0) = 0 AS green
  FROM dayroll d JOIN (SELECT reference_date, count(*) FILTER (domain_status = 'FAILED') AS failed, max(domain_status) FILTER (expected = 'ceap') AS ceap FROM droll GROUP BY 1) f USING (reference_date)
  LEFT JOIN (SELECT reference_date, count(*) AS n, string_agg(DISTINCT w, ',' ORDER BY w) AS kinds, count(*) FILTER (w IN ('success_marker_missing', 'task_counts_inconsistent', 'success_marker_exists_but_status_not_completed')) AS crit FROM warns GROUP BY 1) w USING (reference_date)""", "dayroll", "warns")),
    "collect_runs": (collect_runs, twin("""SELECT domain, pipeline_run_id, CASE WHEN found THEN status END AS status, CASE WHEN NOT found THEN 'control' END AS note FROM manifests WHERE found OR control <> ''""", "manifests")),
    "snapshot_valid_latest": (snapshot_valid_latest, _SNAP + """, l AS (SELECT *, max(CASE WHEN valid THEN reference_date END) OVER (ORDER BY reference_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fd FROM ok),
  m AS (SELECT l.*, p.run AS fr, CAST(substr(l.reference_date, 9, 2) AS INTEGER) % 2 = 0 AS rec, CAST(substr(l.reference_date, 10, 1) AS INTEGER) % 3 AS created FROM l LEFT JOIN ok p ON p.reference_date = l.fd)
  SELECT reference_date, fd AS fallback_date, fr AS fallback_run, CASE WHEN valid THEN 'reused_today' WHEN rec AND fr IS NOT NULL THEN 'reused_fallback' WHEN created > 0 THEN 'created_today' ELSE 'none' END AS snapshot_source,
  CASE WHEN NOT valid AND rec AND fr IS NOT NULL THEN fd ELSE reference_date END AS snapshot_date FROM m"""),
    "latest_snapshot": (latest_snapshot, _SNAP + " SELECT max(reference_date) AS reference_date, arg_max(run, reference_date) AS pipeline_run_id FROM ok WHERE valid AND reference_date < '1999-06-15'"),
    "snapshot_scan": (snapshot_scan, _SNAP + " SELECT reference_date, run AS pipeline_run_id FROM ok WHERE valid"),
    "validate_requests": (validate_requests, """WITH q AS (SELECT o_orderkey, o_orderkey AS k, CASE WHEN o_orderkey % 9 IN (0, 1) THEN 1998 ELSE 1997 + o_orderkey % 3 END AS y, o_orderkey % 9 = 1 AS bady, o_orderkey % 2 = 0 AS f,
  NOT o_orderkey % 4 = 0 AND o_orderkey % 23 = 0 AS badd, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) END AS sd, CASE WHEN o_orderkey % 5 = 0 THEN DATE '1998-03-01' ELSE DATE '1998-06-15' END AS ed,
  CASE o_orderkey % 8 WHEN 0 THEN 0 WHEN 1 THEN 200000 WHEN 2 THEN 6000 ELSE 1000 END AS mt FROM orders), z AS (SELECT *, coalesce(sd, make_date(y, 1, 1)) AS s FROM q)
  SELECT o_orderkey, concat_ws(',', CASE WHEN bady THEN 'year_must_be_integer' END, CASE WHEN y > 1998 THEN 'year_cannot_exceed_current_calendar_year' END, CASE WHEN y < 1998 AND NOT f THEN 'past_year_requires_force_true' END,
  CASE WHEN badd THEN 'invalid_start_or_end_date_iso' END, CASE WHEN NOT badd AND s > ed THEN 'date_start_after_date_end' END, CASE WHEN NOT badd AND (year(s) < y OR year(ed) > y) AND NOT f THEN 'window_outside_year_requires_force_true' END,
  CASE WHEN NOT badd AND k % 6 = 0 THEN 'domains_required' END, CASE WHEN NOT badd AND k % 6 = 1 THEN 'unknown_domains:mars,moon' END, CASE WHEN NOT badd AND k % 8 = 3 THEN 'max_tasks_must_be_integer' END,
  CASE WHEN NOT badd AND mt < 1 THEN 'max_tasks_must_be_at_least_1' END, CASE WHEN NOT badd AND mt > 100000 THEN 'max_tasks_cannot_exceed_100000' END, CASE WHEN NOT badd AND mt > 5000 AND k % 3 <> 0 THEN 'max_tasks_above_5000_requires_confirm_max_tasks_true' END) AS errors FROM z"""),
    "validate_windows": (validate_windows, """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'invalid_iso_date' WHEN CAST(o_orderdate AS DATE) > DATE '1998-06-30' THEN 'date_start_after_date_end'
  WHEN year(o_orderdate) <> 1998 AND o_orderkey % 5 <> 0 THEN 'dates_must_match_target_year_or_allow_year_mismatch' ELSE '' END AS errors FROM orders"""),
    "manifest_docs": (manifest_docs, _RR + """ SELECT pipeline_run_id, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'QUEUING' ELSE 'FAILED' END AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'reconciliation' ELSE 'daily' END AS run_type,
  CASE o_orderkey % 4 WHEN 0 THEN '[5,4]' WHEN 1 THEN '[3,2]' ELSE '[]' END AS months, 'raw/camara/ceap/api/despesas/_metadata/runs/pipeline_run_id=' || pipeline_run_id || '/_SUCCESS' AS marker, CAST(o_orderkey % 10 AS VARCHAR) AS expected,
  CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS done, CASE WHEN o_orderkey % 5 <> 0 THEN 'raw/x/' || d END AS parent_path, o_orderkey % 5 <> 0 AS has_parent, true AS has_error, CASE WHEN o_orderstatus = 'P' THEN 'boom' END AS error,
  false AS has_pages, CASE WHEN o_orderkey % 6 = 0 THEN '77' END AS records, o_orderkey % 5 = 0 AS has_error_type, CASE WHEN o_orderstatus = 'F' THEN d END AS completed_at FROM r"""),
    "manifest_docs_domain": (manifest_docs_domain, _RR + """ SELECT pipeline_run_id, f.domain, CASE WHEN o_orderkey % 3 = 0 THEN 'reconciliation' WHEN o_orderkey % 3 = 2 THEN 'backfill' WHEN f.domain = 'proposicoes' THEN 'microbatch' ELSE 'daily' END AS run_type,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'QUEUING' ELSE 'FAILED' END AS status, f.fanout_from, CAST(o_custkey % 50 AS VARCHAR) AS parents, f.watermark,
  'raw/camara/' || f.domain || '/api/_metadata/runs/pipeline_run_id=' || pipeline_run_id || '/_SUCCESS' AS marker, '["_audit","_payload_hash","_record_uid","_record_hash"]' AS audit, CASE WHEN o_orderkey % 6 = 0 THEN '77' END AS records
  FROM r CROSS JOIN (VALUES ('votacoes', '/votacoes', 'dataHoraRegistro'), ('proposicoes', '/proposicoes', 'ultimaTramitacao_dataHora'), ('eventos', '/eventos', 'dataHoraInicio'),
  ('institucional', '/orgaos + /partidos + /frentes + /legislaturas', NULL), ('discursos', 'deputies_snapshot', 'dataHoraInicio')) f(domain, fanout_from, watermark)"""),
    "manifest_docs_snapshot": (manifest_docs_snapshot, _SNAP + """ SELECT reference_date, CASE s WHEN 'F' THEN 'COMPLETED' ELSE 'RUNNING' END AS status, CASE s WHEN 'F' THEN 'COMPLETED' ELSE 'RUNNING' END AS snapshot_status,
  CAST(c % 3 + 1 AS VARCHAR) AS files, 'raw/camara/deputados/api/list/reference_date=' || reference_date AS raw_path, reference_date AS loaded_at FROM v"""),
    "manifest_docs_detail": (manifest_docs_detail, "WITH v AS (" + records.QUERIES["snapshot_pages"][1] + """), l AS (SELECT source AS s, count(*) AS p, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n FROM documents GROUP BY 1)
  SELECT 'votacao_votos' AS endpoint, final_status AS status, 'raw/camara/votacoes/api/votos/votacao_id=' || parent_id || '/pipeline_run_id=r1' AS raw_path,
  'raw/camara/votacoes/api/votos/votacao_id=' || parent_id || '/_metadata/runs/pipeline_run_id=r1/_SUCCESS' AS marker, CAST(pages_written AS VARCHAR) AS pages, CAST(record_count AS VARCHAR) AS records,
  CASE final_status WHEN 'COMPLETED' THEN 'f' END AS completed_at, CASE final_status WHEN 'FAILED' THEN 'f' END AS failed_at, '200' AS items_per_page, 'votacao_votos' AS snapshot_type, CAST(parent_id AS VARCHAR) AS parent FROM v
  UNION ALL SELECT 'partidos', 'COMPLETED', 'raw/camara/partidos/api/list/reference_date=' || s || '/pipeline_run_id=r1', 'raw/camara/partidos/api/list/reference_date=' || s || '/_metadata/runs/pipeline_run_id=r1/_SUCCESS',
  CAST(p AS VARCHAR), CAST(n AS VARCHAR), 'f', NULL, '100', 'dimension', NULL FROM l"""),
    "batch_manifests": (batch_manifests, """WITH b AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS d, hour(ts) AS h, count(*) AS n, count(*) FILTER (CAST(json_extract_string(props, '$.k') AS INTEGER) > 50) AS enq, max(event_id) AS top FROM events GROUP BY 1, 2, 3)
  SELECT 'raw/camara/_reconciliation_batches/domain=' || event_type || '/control_id=c-' || d || '/batch_' || lpad(CAST(h AS VARCHAR), 5, '0') || '.json' AS manifest_path, 'reconciliation_batch' AS kind,
  CASE WHEN top % 10 = 0 THEN 'FAILED' ELSE 'PARTIAL_SUCCESS' END AS status, CAST(CASE WHEN top % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS records_failed, n AS records_seen, enq AS messages_enqueued, CAST(h + 1 AS INTEGER) AS next_page FROM b"""),
    "operation_manifests": (operation_manifests, """SELECT 'proposicoes_daily_' || strftime(CAST(ts AS DATE), '%Y%m%d') AS run_id, 'raw/camara/proposicoes/api/list/year=' || strftime(CAST(ts AS DATE), '%Y') || '/month=' || strftime(CAST(ts AS DATE), '%m') || '/day=' || strftime(CAST(ts AS DATE), '%d')
  || '/run_id=proposicoes_daily_' || strftime(CAST(ts AS DATE), '%Y%m%d') AS raw_path, count(DISTINCT user_id) AS records_seen, count(*) FILTER (event_type = 'view') AS records_written, count(*) FILTER (event_type = 'purchase') AS records_skipped_same_hash,
  CAST(0 AS BIGINT) AS records_failed, 'success' AS status FROM events GROUP BY CAST(ts AS DATE)"""),
    "microbatch_sla": (microbatch_sla, """WITH e AS (SELECT *, time_bucket(INTERVAL 10 MINUTE, ts) AS w, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events), r AS (SELECT w, max(ts + to_minutes(k)) AS c FROM e WHERE event_type = 'purchase' GROUP BY 1),
  s AS (SELECT unnest(generate_series((SELECT min(w) FROM e), (SELECT max(w) FROM e), INTERVAL 10 MINUTE)) AS w),
  j AS (SELECT s.w, r.c, CASE WHEN r.c IS NULL THEN 0 ELSE greatest(CAST(floor((epoch_us(r.c) - epoch_us(s.w) - 600000000) / 1000000) AS BIGINT), 0) END AS delay FROM s LEFT JOIN r USING (w))
  SELECT strftime(w, '%Y-%m-%d') AS dia, count(*) AS janelas, count(*) FILTER (c IS NULL) AS janelas_perdidas, CAST(max(delay) AS BIGINT) AS atraso_max_s, CAST(sum(delay) AS BIGINT) AS atraso_total_s FROM j GROUP BY 1"""),
}
