"""Run manifests: base fields always, optional blocks only where they have a value.

A manifest is a set of columns plus ``manifest`` (JSON text).  The text is two
``to_json`` calls: the base keeps its nulls, the blocks drop theirs, which is
the contract's own rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tribuna import catalog
from tribuna.functions import scalars as S
from tribuna.operators.envelope import RAW_ROOT

# Manifest contract, version 1.0.
BASE_FIELDS = (
    "metadata_version", "source", "domain", "entity", "endpoint", "api_base_url", "api_path", "pipeline_run_id",
    "execution_id", "run_type", "status", "started_at", "completed_at", "created_at", "raw_path",
    "success_marker_path", "total_pages", "items_per_page", "files_written", "record_count", "error_message",
)
PARTITION_FIELDS = (
    "reference_date", "reference_timezone", "reference_year", "reference_month", "reference_months", "target_year",
    "date_start", "date_end", "watermark_field", "watermark_start", "watermark_end",
)
TASK_FIELDS = (
    "total_tasks_expected", "total_tasks_queued", "total_tasks_success", "total_tasks_failed",
    "total_tasks_pending", "total_tasks_poison", "total_tasks_running", "enqueue_phase_complete",
)
FANOUT_FIELDS = (
    "fanout_from", "parent_entity", "parent_id_field", "parent_record_count", "parent_snapshot_path",
    "parent_pipeline_run_id",
)
SNAPSHOT_FIELDS = ("snapshot_type", "snapshot_date", "snapshot_status", "snapshot_record_count")
PAGE_COUNTERS = ("total_pages", "items_per_page", "files_written", "record_count")
RUN_STATUSES = ("STARTED", "RUNNING", "COMPLETED", "PARTIAL", "FAILED", "PARTIALLY_COMPLETED")
FANOUT_STATUSES = RUN_STATUSES + ("QUEUING", "NO_DATA")

# domain: entity, endpoint, api path, watermark field, fan-out source, parent entity, detected-count field
FANOUT_MANIFESTS = {
    "votacoes": ("votacoes", "votacoes_fanout", "/votacoes + /votacoes/{id}/votos", "dataHoraRegistro",
                 "/votacoes", "votacao", "total_votacoes_detected"),
    "proposicoes": ("proposicoes", "proposicoes_fanout", "/proposicoes + /proposicoes/{id}/{autores|tramitacoes}",
                    "ultimaTramitacao_dataHora", "/proposicoes", "proposicao", "total_proposicoes_detected"),
    "eventos": ("eventos", "eventos_fanout", "/eventos + /eventos/{id}/{deputados|orgaos|pauta|votacoes}",
                "dataHoraInicio", "/eventos", "evento", "total_eventos_detected"),
    "institucional": ("institucional", "institucional_fanout",
                      "/orgaos + /partidos + /frentes + /legislaturas + /{kind}/{id}/{membros|lideres|mesa}",
                      None, "/orgaos + /partidos + /frentes + /legislaturas", "institucional_parent_set",
                      "total_parents_detected"),
    "discursos": ("deputado_discursos", "deputado_discursos", "/deputados/{id}/discursos", "dataHoraInicio",
                  "deputies_snapshot", "deputado", "total_deputados_detected"),
}
# domain: snapshot type of a per-parent manifest
DETAIL_TYPES = {
    "votacoes": "votacao_votos", "proposicoes": "proposicao_sub", "eventos": "evento_sub",
    "institucional": "institucional_sub", "discursos": "deputado_discursos",
}
# End of fixed values.

CEAP_PREFIX = f"{RAW_ROOT}/ceap/api/despesas"
BLOCK_FIELDS = PARTITION_FIELDS + TASK_FIELDS + FANOUT_FIELDS + SNAPSHOT_FIELDS


def manifest_prefix(domain: str) -> str:
    root = CEAP_PREFIX if domain == "ceap" else f"{RAW_ROOT}/{domain}/api"
    return f"{root}/_metadata/runs/pipeline_run_id="


def _count(name: str, columns: list[str]) -> Column:
    return S.int_or_zero(F.col(name).cast("string")) if name in columns else F.lit(0).cast("bigint")


def build_manifest(df: DataFrame, fields: dict[str, Column], extras: dict[str, Column] | None = None,
                   drop: tuple[str, ...] = (), always: dict[str, Column] | None = None) -> DataFrame:
    """Manifest columns and JSON text from named expressions.

    Names outside the contract are ignored in ``fields``.  Extras come last
    and only fill what is still empty.  ``drop`` removes base fields that do
    not apply to a manifest variant; ``always`` adds fields of the variant
    that are written even when null.
    """
    base = {n: fields.get(n, F.lit(None).cast("string")) for n in BASE_FIELDS if n not in drop}
    base["metadata_version"] = F.lit(catalog.METADATA_VERSION)
    error = base["error_message"]
    base["error_message"] = F.when(error != "", error)
    for name in set(PAGE_COUNTERS) - set(drop):
        base[name] = S.int_or_zero(fields.get(name, F.lit(0)).cast("string")).cast("int")
    base |= always or {}
    known = BLOCK_FIELDS + ("dependencies", "hash_strategy", "audit_fields_applied")
    blocks = {n: fields[n] for n in known if n in fields}
    for name, value in (extras or {}).items():
        if name in base:
            continue
        blocks[name] = F.coalesce(blocks[name], value) if name in blocks else value

    columns = {**base, **blocks}
    out = df.select("*", *[c.alias(f"_m_{n}") for n, c in columns.items()])
    named = lambda names: F.struct(*[F.col(f"_m_{n}").alias(n) for n in names])
    # Columns of their own, so that each text is written once and the last brace is cut by position.
    out = out.select(*[F.col(f"_m_{n}").alias(n) for n in columns], F.to_json(named(base), {"ignoreNullFields": "false"}).alias("_head"),
                     (F.to_json(named(blocks)) if blocks else F.lit("{}")).alias("_tail"))
    text = F.when(F.col("_tail") == "{}", F.col("_head")).otherwise(
        F.concat(F.substring("_head", F.lit(1), F.length("_head") - 1), F.lit(","), F.substring("_tail", 2, 2**31 - 1)))
    return out.select(*columns, text.alias("manifest"))


def _fold_status(status: Column, allowed: tuple[str, ...]) -> Column:
    up = F.upper(status)
    return F.when(up.isin(*allowed), up).otherwise(F.lit("RUNNING"))


def _tasks(columns: list[str]) -> dict[str, Column]:
    out = {n: _count(n, columns) for n in TASK_FIELDS[:-1]}
    out["enqueue_phase_complete"] = F.coalesce("enqueue_phase_complete", F.lit(False))
    return out


def _text(name: str, columns: list[str]) -> Column:
    return F.coalesce(F.col(name), F.lit("")) if name in columns else F.lit("")


def build_ceap_manifest(runs: DataFrame) -> DataFrame:
    """Expense-run manifest.

    Months come as JSON text and become integers; the four page counters do
    not apply; the raw-file and record totals, the dispatch limit and the error
    type appear only when the run has them.
    """
    c = runs.columns
    months = S.months_list(F.col("months_to_process"))
    prefix = F.concat(F.lit(manifest_prefix("ceap")), F.col("pipeline_run_id"))
    parent = (_text("deputies_snapshot_path", c) != "") | (_text("deputies_snapshot_pipeline_run_id", c) != "")
    parent_run = _text("deputies_snapshot_pipeline_run_id", c)
    fields = {
        "source": F.lit("camara"), "domain": F.lit("ceap"), "entity": F.lit("deputado_despesas"),
        "endpoint": F.lit("deputado_despesas"), "api_base_url": F.lit(catalog.API_BASE_URL),
        "api_path": F.lit("/deputados/{id}/despesas"), "pipeline_run_id": F.col("pipeline_run_id"),
        "run_type": F.when(F.col("mode") == "reconciliation", F.lit("reconciliation")).otherwise(F.lit("daily")),
        "status": F.upper("status"), "started_at": F.col("started_at"), "completed_at": F.col("completed_at"),
        "created_at": F.col("created_at"), "raw_path": F.lit(f"{CEAP_PREFIX}/"),
        "success_marker_path": F.concat(prefix, F.lit("/_SUCCESS")), "error_message": F.col("error_message"),
        "target_year": F.col("target_year"), **_tasks(c),
        "parent_entity": F.when(parent, F.lit("deputados_list")),
        "parent_snapshot_path": F.when(parent, _text("deputies_snapshot_path", c)),
        "parent_pipeline_run_id": F.when(parent & (parent_run != ""), parent_run),
    }
    extras = {"months_to_process": months, "reference_months": months}
    for name in ("max_tasks_per_dispatch", "total_raw_files_written", "total_records_collected"):
        if name in c:
            extras[name] = F.col(name).cast("bigint")
    extras |= {
        "deputies_snapshot_date": _text("deputies_snapshot_date", c),
        "deputies_snapshot_record_count": _count("deputies_snapshot_record_count", c),
        "deputies_snapshot_status": _text("deputies_snapshot_status", c),
        "deputies_snapshot_path": _text("deputies_snapshot_path", c),
        "deputies_snapshot_pipeline_run_id": parent_run,
    }
    if "error_type" in c:
        extras["error_type"] = F.when(F.col("error_type") != "", F.col("error_type"))
    return build_manifest(runs, fields, extras, PAGE_COUNTERS, _times())


def _times() -> dict[str, Column]:
    return {"started_at_utc": F.col("started_at"), "finished_at_utc": F.col("completed_at"), "failed_at_utc": F.col("failed_at")}


def build_snapshot_manifest(snapshots: DataFrame) -> DataFrame:
    """Deputies-snapshot manifest; a status outside the known set becomes RUNNING."""
    status = _fold_status(F.col("status"), RUN_STATUSES)
    root = F.concat(F.lit(f"{RAW_ROOT}/deputados/api/list/reference_date="), F.col("reference_date"))
    fields = {
        "source": F.lit(catalog.SOURCE_SYSTEM), "domain": F.lit("deputados"), "entity": F.lit("deputado"),
        "endpoint": F.lit("deputado"), "api_base_url": F.lit(catalog.API_BASE_URL), "api_path": F.lit("/deputados"),
        "pipeline_run_id": F.col("pipeline_run_id"), "execution_id": F.col("execution_id"),
        "run_type": F.lit("snapshot"), "status": status, "started_at": F.col("started_at"),
        "completed_at": F.col("completed_at"), "created_at": F.col("created_at"), "raw_path": root,
        "success_marker_path": F.concat(root, F.lit("/_SUCCESS")), "total_pages": F.col("total_pages"),
        "files_written": F.col("total_pages"), "record_count": F.col("record_count"),
        "error_message": F.col("error_message"), "reference_date": F.col("reference_date"),
        "reference_timezone": F.col("reference_timezone"), "snapshot_type": F.lit("dimension"),
        "snapshot_date": F.col("reference_date"), "snapshot_status": status,
        "snapshot_record_count": S.int_or_zero(F.col("record_count").cast("string")),
    }
    lineage = {
        "_pipeline_run_id": F.col("pipeline_run_id"), "_execution_id": F.col("execution_id"),
        "_source_system": F.lit(catalog.SOURCE_SYSTEM), "_source_endpoint": F.lit("deputado"),
        "_reference_date": F.col("reference_date"), "_ingested_at_utc": F.col("created_at"),
        "_loaded_at": F.col("created_at"),
    }
    return build_manifest(snapshots, fields, lineage)


def build_domain_manifest(runs: DataFrame, domain: str) -> DataFrame:
    """Aggregate manifest of a fan-out domain's run; ``detected`` is the parent count."""
    entity, endpoint, api_path, watermark, source, parent, detected = FANOUT_MANIFESTS[domain]
    c = runs.columns
    modes = ("reconciliation", "backfill") + (("microbatch",) if domain == "proposicoes" else ())
    raw = f"{RAW_ROOT}/{domain}/api"
    raw_path = (
        F.concat(F.lit(f"{raw}/list/pipeline_run_id="), F.col("pipeline_run_id"))
        if domain == "votacoes" else F.lit(raw)
    )
    fields = {
        "source": F.lit(catalog.SOURCE_SYSTEM), "domain": F.lit(domain), "entity": F.lit(entity),
        "endpoint": F.lit(endpoint), "api_base_url": F.lit(catalog.API_BASE_URL), "api_path": F.lit(api_path),
        "pipeline_run_id": F.col("pipeline_run_id"), "execution_id": F.col("pipeline_run_id"),
        "run_type": F.when(F.col("mode").isin(*modes), F.col("mode")).otherwise(F.lit("daily")),
        "status": F.upper("status"), "started_at": F.col("started_at"), "completed_at": F.col("completed_at"),
        "created_at": F.col("created_at"), "raw_path": raw_path,
        "success_marker_path": F.concat(F.lit(manifest_prefix(domain)), F.col("pipeline_run_id"), F.lit("/_SUCCESS")),
        "error_message": F.col("error_message"), **_tasks(c),
        "fanout_from": F.lit(source), "parent_entity": F.lit(parent), "parent_id_field": F.lit("id"),
        "parent_record_count": S.int_or_zero(F.col("detected").cast("string")),
        "hash_strategy": F.lit(catalog.HASH_STRATEGY),
        "audit_fields_applied": F.array(*[F.lit(a) for a in catalog.AUDIT_FIELDS]),
    }
    if watermark:
        fields |= {
            "watermark_field": F.lit(watermark), "watermark_start": _text("window_start_utc", c),
            "watermark_end": _text("window_end_utc", c),
        }
    always = _times()
    if watermark:
        always |= {n: F.col(n) if n in c else F.lit(None).cast("string") for n in ("window_start_utc", "window_end_utc")}
    extras = {"mode": F.col("mode"), detected: S.int_or_zero(F.col("detected").cast("string"))}
    subs = [e.name for e in catalog.domain_endpoints(domain) if e.per_parent]
    if domain in ("proposicoes", "eventos", "institucional"):
        extras["sub_endpoints"] = F.array(*[F.lit(e) for e in subs])
    for name in ("date_start", "date_end", "target_year", "parents_detected", "total_raw_files_written",
                 "total_records_collected", "error_type", "skipped_unchanged_hash"):
        if name in c:
            extras[name] = F.col(name)
    return build_manifest(runs, fields, extras, PAGE_COUNTERS, always)


def build_detail_manifest(results: DataFrame, endpoint: str) -> DataFrame:
    """Manifest of one parent's sub-resource snapshot, or of one reference list.

    Input: a :func:`snapshot_results` row with run, execution and times.
    """
    spec = catalog.endpoint(endpoint)
    status = _fold_status(F.col("final_status"), RUN_STATUSES)
    if spec.per_parent:
        part, label = catalog.PARENT_PARTITION[endpoint]
        root = F.concat(F.lit(f"{RAW_ROOT}/{spec.raw_prefix}/{part}="), F.col("parent_id"))
        scope = {"snapshot_type": F.lit(DETAIL_TYPES[spec.domain])}
        extras = {part: F.col("parent_id")}
        if spec.domain in ("proposicoes", "eventos", "institucional"):
            extras["sub_endpoint"] = F.lit(endpoint)
        if spec.domain == "institucional":
            extras["parent_label"] = F.lit(label)
        if spec.domain == "discursos":
            scope |= {
                "watermark_field": F.lit("dataHoraInicio"), "watermark_start": _text("window_start_utc", results.columns),
                "watermark_end": _text("window_end_utc", results.columns),
            }
        api_path = F.replace(F.lit(spec.path), F.lit("{id}"), F.col("parent_id"))
    else:
        root = F.concat(F.lit(f"{RAW_ROOT}/{spec.raw_prefix}/reference_date="), F.col("reference_date"))
        scope = {
            "snapshot_type": F.lit("dimension"), "snapshot_date": F.col("reference_date"),
            "reference_date": F.col("reference_date"), "reference_timezone": F.col("reference_timezone"),
        }
        extras = {}
        api_path = F.lit(spec.path)
    run = F.concat(F.lit("/pipeline_run_id="), F.col("pipeline_run_id"))
    fields = {
        "source": F.lit(catalog.SOURCE_SYSTEM), "domain": F.lit(spec.domain), "entity": F.lit(endpoint),
        "endpoint": F.lit(endpoint), "api_base_url": F.lit(catalog.API_BASE_URL), "api_path": api_path,
        "pipeline_run_id": F.col("pipeline_run_id"), "execution_id": F.col("execution_id"),
        "run_type": F.lit("snapshot"), "status": F.upper("final_status"), "started_at": F.col("started_at"),
        "completed_at": F.when(status == "COMPLETED", F.col("finished_at")), "created_at": F.col("finished_at"),
        "raw_path": F.concat(root, run),
        "success_marker_path": F.concat(root, F.lit("/_metadata/runs"), run, F.lit("/_SUCCESS")),
        "total_pages": F.col("pages_written"), "items_per_page": F.lit(spec.page_size),
        "files_written": F.col("pages_written"), "record_count": F.col("record_count"),
        "error_message": F.substring("error_message", 1, 1024), "snapshot_status": status,
        "snapshot_record_count": F.col("record_count"),
        "hash_strategy": F.lit(catalog.HASH_STRATEGY),
        "audit_fields_applied": F.array(*[F.lit(a) for a in catalog.AUDIT_FIELDS]), **scope,
    }
    if "error_type" in results.columns:
        extras["error_type"] = F.when(F.col("error_type") != "", F.col("error_type"))
    always = {
        "started_at_utc": F.col("started_at"),
        "finished_at_utc": F.when(status == "COMPLETED", F.col("finished_at")),
        "failed_at_utc": F.when(status == "FAILED", F.col("finished_at")),
    }
    return build_manifest(results, fields, extras, always=always)


def operation_manifest(counts: DataFrame, run_dir: Column) -> DataFrame:
    """List-operation manifests: seen, written, skipped and failed counts of each run."""
    return counts.select(
        F.lit(catalog.SOURCE_SYSTEM).alias("source"), "endpoint", "pipeline_name",
        F.col("pipeline_run_id").alias("run_id"), "window_start", "window_end",
        F.col("records_seen").cast("bigint").alias("records_seen"),
        F.col("enqueued").cast("bigint").alias("records_written"),
        F.col("skipped_same_hash").cast("bigint").alias("records_skipped_same_hash"),
        F.col("failed").cast("bigint").alias("records_failed"),
        F.when(F.col("failed") > 0, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        run_dir.alias("raw_path"), "started_at", "finished_at",
    )


def list_run_dir(anchor: Column, run_id: Column) -> Column:
    return F.concat(
        F.lit(f"{RAW_ROOT}/proposicoes/api/list/year="), F.date_format(anchor, "yyyy"),
        F.lit("/month="), F.date_format(anchor, "MM"), F.lit("/day="), F.date_format(anchor, "dd"),
        F.lit("/run_id="), run_id,
    )


def batch_manifest(batches: DataFrame) -> DataFrame:
    """Reconciliation-batch manifests with the checkpoint before and after."""
    return batches.select(
        F.lit("reconciliation_batch").alias("kind"), "control_id", "pipeline_run_id", "domain",
        "window_start", "window_end", "checkpoint_before", "checkpoint_after",
        F.col("records_seen").cast("bigint").alias("records_seen"),
        F.col("messages_enqueued").cast("bigint").alias("messages_enqueued"),
        F.col("records_skipped_same_hash").cast("bigint").alias("records_skipped_same_hash"),
        F.when(F.col("error").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("records_failed"),
        F.when(F.col("error").isNotNull(), F.lit("FAILED")).otherwise(F.lit("PARTIAL_SUCCESS")).alias("status"),
        "started_at", "finished_at",
        F.format_string(
            f"{RAW_ROOT}/_reconciliation_batches/domain=%s/control_id=%s/batch_%05d.json",
            F.lower(F.trim("domain")), F.trim("control_id"), F.col("batch_index"),
        ).alias("manifest_path"),
    )
