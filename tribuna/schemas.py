"""Explicit record schemas per endpoint (DDL) and the fixed envelope types."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the public API's records.
RECORD_DDL = {
    "deputado_despesas": "codDocumento bigint, numDocumento string, dataDocumento string, tipoDespesa string, "
                         "urlDocumento string, parcela int, numRessarcimento string, cnpjCpfFornecedor string, "
                         "valorDocumento string",
    "votacao_votos": "tipoVoto string, deputado_ struct<id:bigint,nome:string>",
    "proposicao_autores": "uri string, nome string, proponente string",
    "proposicao_tramitacoes": "sequencia int, dataHora string, descricaoSituacao string",
    "evento_orgaos": "id bigint, sigla string",
    "evento_pauta": "ordem int, proposicao_ struct<id:bigint,siglaTipo:string>, regime string",
    "evento_votacoes": "id string, descricao string",
    "orgao_membros": "id bigint, nome string, dataInicio string",
    "legislatura_lideres": "parlamentar struct<id:bigint,uri:string>, titulo string, dataInicio string",
    "legislatura_mesa": "id bigint, titulo string, dataInicio string",
    "deputado_discursos": "dataHoraInicio string, faseEvento struct<titulo:string>, tipoDiscurso string, "
                          "transcricao string",
}
NAMED_LIST_DDL = "id bigint, nome string"
LINKS_DDL = "array<struct<rel:string,href:string>>"
MESSAGE_DDL = (
    "domain string, endpoint string, pipeline_run_id string, run_type string, payload map<string,string>, "
    "execution_id string, dispatched_at string"
)
MANIFEST_DDL = (
    "metadata_version string, source string, domain string, entity string, endpoint string, api_base_url string, "
    "api_path string, pipeline_run_id string, execution_id string, run_type string, status string, "
    "started_at string, completed_at string, created_at string, raw_path string, success_marker_path string, "
    "total_pages int, items_per_page int, files_written int, record_count int, error_message string, "
    "reference_date string, reference_timezone string, reference_year int, reference_month int, "
    "reference_months array<int>, target_year int, date_start string, date_end string, watermark_field string, "
    "watermark_start string, watermark_end string, total_tasks_expected int, total_tasks_queued int, "
    "total_tasks_success int, total_tasks_failed int, total_tasks_pending int, total_tasks_poison int, "
    "total_tasks_running int, enqueue_phase_complete boolean, fanout_from string, parent_entity string, "
    "parent_id_field string, parent_record_count int, parent_snapshot_path string, parent_pipeline_run_id string, "
    "snapshot_type string, snapshot_date string, snapshot_status string, snapshot_record_count int, "
    "dependencies array<struct<entity:string,pipeline_run_id:string,path:string,status:string,record_count:int,"
    "reference_date:string>>, hash_strategy string, audit_fields_applied array<string>"
)
# End of fixed values.


def record_ddl(endpoint: str) -> str:
    return RECORD_DDL.get(endpoint, NAMED_LIST_DDL)


def page_schema(record: str | T.StructType) -> str:
    """Page envelope around a record type; corrupt pages keep their text."""
    inner = record if isinstance(record, str) else record.simpleString()[len("struct<"):-1]
    if isinstance(record, str):
        inner = T.StructType.fromDDL(record).simpleString()[len("struct<"):-1]
    return f"dados array<struct<{inner}>>, links {LINKS_DDL}, _corrupt_record string"
