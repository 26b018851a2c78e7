"""Manifest contract, validation order, inspection and rollup truth tables."""

import json

from pyspark.sql import functions as F

from tribuna.operators import manifests as MF
from tribuna.operators import summary as SU
from tribuna.operators import validation as V
from tribuna.sources import sinks

TASKS = ("expected", "success", "failed", "pending", "poison", "running", "queued")


def manifest_rows(spark, rows):
    fields = ["status", "record_count", "total_pages", "files_written", *[f"total_tasks_{t}" for t in TASKS]]
    ddl = "status string, " + ", ".join(f"{f} string" for f in fields[1:])
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], ddl)


def reasons(spark, profile, *rows):
    df = manifest_rows(spark, [{k: (v if k == "status" or v is None else str(v)) for k, v in r.items()} for r in rows])
    return [r.reason for r in V.validate_manifests(df, profile).collect()]


def test_snapshot_profile(spark):
    ok = {"status": "completed", "record_count": 3, "total_pages": 1, "files_written": 1}
    assert reasons(spark, V.DIMENSION_SNAPSHOT, ok, {**ok, "status": "RUNNING"}, {**ok, "status": None}, {**ok, "record_count": 0},
                   {**ok, "total_pages": "x"}, {**ok, "files_written": 2}, {**ok, "files_written": None}) == [
        "", "status=RUNNING", "status=None", "record_count<=0", "total_pages<=0", "files_written!=total_pages", ""]


def test_fanout_profile_reports_the_first_failing_rule(spark):
    def run(**t):
        return {"status": "COMPLETED", **{f"total_tasks_{k}": v for k, v in t.items()}}

    assert reasons(spark, V.FANOUT_RUN, run(expected=10, success=10), run(expected=10, success=9, failed=1), run(), run(queued=1), run(success=1, failed=2),
                   run(expected=-1), run(expected=2, success=2, poison=1), run(expected=2, success=2, queued=1)) == [
        "", "success!=expected", "", "total_tasks_queued!=0 when total_tasks_expected=0", "total_tasks_success!=0 when total_tasks_expected=0",
        "total_tasks_expected<0", "total_tasks_poison!=0", "total_tasks_queued!=0"]


def test_missing_manifest_and_missing_marker(spark):
    df = manifest_rows(spark, [{"status": "COMPLETED"}]).withColumn("success_marker_path", F.lit("p"))
    assert V.validate_manifests(df, V.FANOUT_RUN, F.lit(False)).first().reason == "metadata_missing"
    none = spark.createDataFrame([], "success_marker_path string, pipeline_run_id string")
    assert V.validate_completed(df, none, V.FANOUT_RUN).first().reason == "success_marker_missing"
    some = spark.createDataFrame([("p", "r"), ("p", "r")], "success_marker_path string, pipeline_run_id string")
    assert [r.ok for r in V.validate_completed(df, some, V.FANOUT_RUN).collect()] == [True]


def ceap_run(spark, **over):
    row = {"pipeline_run_id": "ceap_daily_20260512", "mode": "daily", "status": "running", "started_at": "s", "completed_at": None, "created_at": "c",
           "failed_at": None, "error_message": "", "months_to_process": "[5, 4]", "target_year": "2026", "total_tasks_expected": "10",
           "total_tasks_success": "9", "enqueue_phase_complete": None, "deputies_snapshot_path": "", **over}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    return df.withColumns({"enqueue_phase_complete": F.col("enqueue_phase_complete").cast("boolean"), "target_year": F.col("target_year").cast("int")})


def test_expense_manifest(spark):
    doc = json.loads(MF.build_ceap_manifest(ceap_run(spark)).first().manifest)
    assert doc["months_to_process"] == doc["reference_months"] == [5, 4]
    assert not {"total_pages", "items_per_page", "files_written", "record_count"} & set(doc)
    assert not {"total_records_collected", "max_tasks_per_dispatch", "error_type", "parent_entity", "date_start"} & set(doc)
    assert doc["completed_at"] is None and doc["error_message"] is None and doc["execution_id"] is None
    assert (doc["status"], doc["run_type"], doc["total_tasks_expected"], doc["enqueue_phase_complete"], doc["target_year"]) == ("RUNNING", "daily", 10, False, 2026)
    assert doc["finished_at_utc"] is None and doc["failed_at_utc"] is None and doc["started_at_utc"] == "s"
    full = json.loads(MF.build_ceap_manifest(ceap_run(spark, mode="reconciliation", deputies_snapshot_path="p", deputies_snapshot_pipeline_run_id="r",
                                                      total_records_collected="7", error_type="E", error_message="boom")).first().manifest)
    assert (full["parent_entity"], full["parent_snapshot_path"], full["parent_pipeline_run_id"]) == ("deputados_list", "p", "r")
    assert (full["total_records_collected"], full["error_type"], full["error_message"], full["run_type"]) == (7, "E", "boom", "reconciliation")


def test_blocks_are_filtered_and_extras_never_override(spark):
    df = spark.range(1)
    m = MF.build_manifest(df, {"status": F.lit("COMPLETED"), "parent_id": F.lit("x"), "reference_date": F.lit(None).cast("string"), "target_year": F.lit(2026)},
                          {"status": F.lit("HACKED"), "target_year": F.lit(1), "reference_date": F.lit("2026-01-01"), "mine": F.lit(3)}).first()
    doc = json.loads(m.manifest)
    assert "parent_id" not in doc
    assert (doc["status"], doc["target_year"], doc["reference_date"], doc["mine"], doc["total_pages"]) == ("COMPLETED", 2026, "2026-01-01", 3, 0)
    assert list(doc)[:3] == ["metadata_version", "source", "domain"]


def test_manifest_text_with_braces_stays_valid(spark):
    doc = json.loads(MF.build_manifest(spark.range(1), {"error_message": F.lit('a "}" \\ }'), "hash_strategy": F.lit("v1")}).first().manifest)
    assert (doc["error_message"], doc["hash_strategy"]) == ('a "}" \\ }', "v1")


def test_snapshot_and_detail_manifests(spark):
    s = spark.createDataFrame([("r", "x", "weird", "s", None, "c", "", "2026-05-12", "tz", 2, 5)],
                              "pipeline_run_id string, execution_id string, status string, started_at string, completed_at string, created_at string, error_message string, reference_date string, reference_timezone string, total_pages int, record_count int")
    doc = json.loads(MF.build_snapshot_manifest(s).first().manifest)
    assert (doc["status"], doc["files_written"], doc["snapshot_record_count"], doc["_loaded_at"]) == ("RUNNING", 2, 5, "c")
    d = spark.createDataFrame([("55-1", "r", "x", "FAILED", "s", "f", 3, 40, "err")],
                              "parent_id string, pipeline_run_id string, execution_id string, final_status string, started_at string, finished_at string, pages_written bigint, record_count bigint, error_message string")
    doc = json.loads(MF.build_detail_manifest(d, "votacao_votos").first().manifest)
    assert doc["raw_path"] == "raw/camara/votacoes/api/votos/votacao_id=55-1/pipeline_run_id=r"
    assert (doc["status"], doc["completed_at"], doc["failed_at_utc"], doc["total_pages"], doc["items_per_page"], doc["votacao_id"], doc["api_path"]) == (
        "FAILED", None, "f", 3, 200, "55-1", "/votacoes/55-1/votos")
    assert doc["finished_at_utc"] is None and "snapshot_id" not in doc and "sub_endpoint" not in doc
    doc = json.loads(MF.build_detail_manifest(d, "orgao_membros").first().manifest)
    assert (doc["snapshot_type"], doc["sub_endpoint"], doc["parent_label"], doc["parent_id"]) == ("institucional_sub", "orgao_membros", "orgao", "55-1")
    doc = json.loads(MF.build_detail_manifest(d.withColumn("window_start_utc", F.lit("w")), "deputado_discursos").first().manifest)
    assert (doc["watermark_field"], doc["watermark_start"], doc["watermark_end"], doc["deputado_id"]) == ("dataHoraInicio", "w", "", "55-1")
    r = d.withColumns({"reference_date": F.lit("2026-05-12"), "reference_timezone": F.lit("tz"), "final_status": F.lit("COMPLETED")})
    doc = json.loads(MF.build_detail_manifest(r, "partidos").first().manifest)
    assert doc["success_marker_path"] == "raw/camara/partidos/api/list/reference_date=2026-05-12/_metadata/runs/pipeline_run_id=r/_SUCCESS"
    assert (doc["completed_at"], doc["snapshot_type"], doc["reference_timezone"]) == ("f", "dimension", "tz")


def test_domain_manifest(spark):
    runs = ceap_run(spark, mode="backfill").withColumns({"detected": F.lit(4), "window_start_utc": F.lit("w")})
    doc = json.loads(MF.build_domain_manifest(runs, "eventos").first().manifest)
    assert (doc["run_type"], doc["total_eventos_detected"], doc["parent_record_count"], doc["window_start_utc"], doc["window_end_utc"]) == ("backfill", 4, 4, "w", None)
    assert doc["sub_endpoints"] == ["evento_deputados", "evento_orgaos", "evento_pauta", "evento_votacoes"] and doc["watermark_end"] == ""
    doc = json.loads(MF.build_domain_manifest(runs, "institucional").first().manifest)
    assert "watermark_field" not in doc and "window_start_utc" not in doc and doc["total_parents_detected"] == 4
    assert "sub_endpoints" not in json.loads(MF.build_domain_manifest(runs, "votacoes").first().manifest)


def rolled(spark, *statuses):
    df = spark.createDataFrame([("d", s) for s in statuses], "k string, status string")
    return SU.rollup_domain(df, "k").first().domain_status


def test_domain_rollup(spark):
    assert rolled(spark, "COMPLETED", "NO_DATA") == "COMPLETED"
    assert rolled(spark, "COMPLETED", "FAILED", "RUNNING") == "FAILED"
    assert rolled(spark, "QUEUED", "PARTIAL") == "RUNNING"
    assert rolled(spark, "PARTIAL", "INVALID_METADATA") == "PARTIAL"
    assert rolled(spark, "COMPLETED", "INVALID_METADATA") == "FAILED"
    assert rolled(spark, "NOT_FOUND", "NOT_FOUND") == "NOT_FOUND"
    assert rolled(spark, "NO_DATA") == "NO_DATA"
    assert rolled(spark, "COMPLETED", "NOT_FOUND") == "PARTIAL"
    assert rolled(spark, "MYSTERY") == "PARTIAL"
    assert rolled(spark, "NOT_IMPLEMENTED") == "PARTIAL"


def daily(spark, *statuses):
    df = spark.createDataFrame([("d", s) for s in statuses], "k string, domain_status string")
    return SU.rollup_daily(df, "k").first().status


def test_daily_rollup(spark):
    assert daily(spark, "COMPLETED", "NOT_IMPLEMENTED") == "COMPLETED"
    assert daily(spark, "COMPLETED", "NOT_FOUND") == "PARTIAL"
    assert daily(spark, "NOT_IMPLEMENTED") == "PARTIAL"
    assert daily(spark, "COMPLETED", "NO_DATA") == "COMPLETED"
    assert daily(spark, "RUNNING", "FAILED") == "FAILED"
    assert daily(spark, "QUEUING", "PARTIAL") == "RUNNING"
    assert daily(spark, "SOMETHING") == "PARTIAL"


def test_empty_domains_roll_up_without_placeholder(spark):
    days = spark.createDataFrame([("2026-05-12",)], "reference_date string")
    runs = spark.createDataFrame([("2026-05-12", "reference", "r", "COMPLETED")], "reference_date string, domain string, pipeline_run_id string, status string")
    got = {r.expected: (r.status, r.placeholder) for r in SU.expected_vs_found(days, runs, (*SU.catalog.DEFAULT_EXPECTED_DOMAINS, "zzz")).collect()}
    assert got["reference_snapshot"] == ("COMPLETED", False)
    assert got["ceap"] == ("NOT_FOUND", False) and got["eventos"] == ("NOT_FOUND", True) and got["zzz"] == ("NOT_IMPLEMENTED", True)


def test_marker_gate(spark):
    df = spark.createDataFrame([("COMPLETED", []), ("COMPLETED", ["task_counts_inconsistent"]), ("COMPLETED", ["metadata_not_found"]), ("PARTIAL", [])],
                               "s string, w array<string>")
    assert [r[0] for r in df.select(sinks.is_green(F.col("s"), F.col("w"))).collect()] == [True, False, True, False]


def test_candidates(spark):
    days = spark.createDataFrame([("2026-05-10", "2026-05-11"), ("2026-05-12", "2026-05-12")], "reference_date string, utc string").select(
        F.col("reference_date").cast("date"), F.col("utc").cast("date"))
    got = {}
    for r in SU.ceap_candidates(days, F.col("utc")).collect():
        got.setdefault(str(r.reference_date), []).append((r.ordinal, r.pipeline_run_id))
    assert [p for _, p in sorted(got["2026-05-10"])] == ["ceap_daily_20260510", "ceap_reconciliation_20260510", "ceap_daily_20260511", "ceap_reconciliation_20260511"]
    assert [p for _, p in sorted(got["2026-05-12"])] == ["ceap_daily_20260512"]


def test_latest_snapshot_per_date_equals_a_scan(spark):
    rows = [(f"20{y}-0{m}-01", "COMPLETED" if (y * m) % 3 else "FAILED", f"r{y}{m}", (y + m) % 4, 1, 1, m != 5) for y in (20, 21, 23) for m in range(1, 8)]
    df = spark.createDataFrame(rows, "reference_date string, status string, pipeline_run_id string, record_count int, total_pages int, files_written int, has_marker boolean")
    valid = [(r[0], r[2]) for r in rows if r[1] == "COMPLETED" and r[3] > 0 and r[6]]
    for r in V.latest_before_each(df).collect():
        before = [v for v in valid if v[0] < r.reference_date]
        assert (r.fallback_date, r.fallback_run) == (max(before) if before else (None, None))
        assert r.today_run == dict(valid).get(r.reference_date)
