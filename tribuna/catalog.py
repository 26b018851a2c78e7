"""Domain and endpoint catalog, and everything derived from run-id prefixes.

Seven domains, 26 endpoints.  The catalog is configuration, so it lives in
code and enters plans as literals (``CASE`` chains, exploded literal arrays):
no join is spent on it and nothing that grows is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# They enter hashes, paths and run ids, so they must be exact.
SOURCE_SYSTEM = "camara_dadosabertos"
API_BASE_URL = "https://dadosabertos.camara.leg.br/api/v2"
HASH_STRATEGY = "payload_and_record_hash_v1"
AUDIT_FIELDS = ("_audit", "_payload_hash", "_record_uid", "_record_hash")
METADATA_VERSION = "1.0"
STALE_AFTER_MINUTES = 60

CEAP_UID_FIELDS = (
    "codDocumento", "numDocumento", "dataDocumento", "tipoDespesa", "urlDocumento",
    "parcela", "numRessarcimento", "cnpjCpfFornecedor", "valorDocumento",
)

# domain: run-id prefixes
RUN_PREFIXES = {
    "ceap": ("ceap_daily_", "ceap_reconciliation_"),
    "reference": ("reference_snapshot_",),
    "votacoes": ("votacoes_microbatch_", "votacoes_reconciliation_"),
    "proposicoes": ("proposicoes_microbatch_", "proposicoes_daily_", "proposicoes_reconciliation_",
                    "proposicoes_recoctl_", "current_year_backfill_"),
    "eventos": ("eventos_daily_", "eventos_microbatch_", "eventos_reconciliation_"),
    "institucional": ("institucional_daily_", "institucional_reconciliation_"),
    "discursos": ("discursos_daily_", "discursos_reconciliation_", "discursos_microbatch_"),
}

# domain, endpoint, path, page size, business keys, raw prefix
_ROWS = (
    ("ceap", "deputado_despesas", "/deputados/{id}/despesas", 100, CEAP_UID_FIELDS, "ceap/api/despesas"),
    ("reference", "partidos", "/partidos", 100, ("id",), "partidos/api/list"),
    ("reference", "legislaturas", "/legislaturas", 100, ("id",), "legislaturas/api/list"),
    ("reference", "deputados", "/deputados", 100, ("id",), "deputados/api/list"),
    ("reference", "frentes", "/frentes", 100, ("id",), "frentes/api/list"),
    ("reference", "orgaos", "/orgaos", 100, ("id",), "orgaos/api/list"),
    ("votacoes", "votacoes", "/votacoes", 200, ("id",), "votacoes/api/list"),
    ("votacoes", "votacao_votos", "/votacoes/{id}/votos", 200, ("deputado_.id", "tipoVoto"), "votacoes/api/votos"),
    ("proposicoes", "proposicoes", "/proposicoes", 100, ("id",), "proposicoes/api/list"),
    ("proposicoes", "proposicao_autores", "/proposicoes/{id}/autores", 100, ("uri",), "proposicoes/api/autores"),
    ("proposicoes", "proposicao_tramitacoes", "/proposicoes/{id}/tramitacoes", 100, ("sequencia", "dataHora"),
     "proposicoes/api/tramitacoes"),
    ("eventos", "eventos", "/eventos", 100, ("id",), "eventos/api/list"),
    ("eventos", "evento_deputados", "/eventos/{id}/deputados", 100, ("id",), "eventos/api/deputados"),
    ("eventos", "evento_orgaos", "/eventos/{id}/orgaos", 100, ("id",), "eventos/api/orgaos"),
    ("eventos", "evento_pauta", "/eventos/{id}/pauta", 100, ("ordem", "proposicao_.id"), "eventos/api/pauta"),
    ("eventos", "evento_votacoes", "/eventos/{id}/votacoes", 100, ("id",), "eventos/api/votacoes"),
    ("institucional", "orgaos_parent", "/orgaos", 100, ("id",), "institucional/api/parents/orgaos"),
    ("institucional", "partidos_parent", "/partidos", 100, ("id",), "institucional/api/parents/partidos"),
    ("institucional", "frentes_parent", "/frentes", 100, ("id",), "institucional/api/parents/frentes"),
    ("institucional", "legislaturas_parent", "/legislaturas", 100, ("id",), "institucional/api/parents/legislaturas"),
    ("institucional", "orgao_membros", "/orgaos/{id}/membros", 100, ("id", "dataInicio"),
     "institucional/api/orgaos/membros"),
    ("institucional", "partido_membros", "/partidos/{id}/membros", 100, ("id",), "institucional/api/partidos/membros"),
    ("institucional", "frente_membros", "/frentes/{id}/membros", 100, ("id",), "institucional/api/frentes/membros"),
    ("institucional", "legislatura_lideres", "/legislaturas/{id}/lideres", 100,
     ("parlamentar.id", "titulo", "dataInicio"), "institucional/api/legislaturas/lideres"),
    ("institucional", "legislatura_mesa", "/legislaturas/{id}/mesa", 100, ("id", "titulo", "dataInicio"),
     "institucional/api/legislaturas/mesa"),
    ("discursos", "deputado_discursos", "/deputados/{id}/discursos", 100,
     ("dataHoraInicio", "faseEvento.titulo", "tipoDiscurso"), "discursos/api/discursos"),
)

# Fan-out targets: list endpoint -> endpoints fetched per listed id.
SUB_ENDPOINTS = {
    "proposicoes": ("proposicao_autores", "proposicao_tramitacoes"),
    "eventos": ("evento_deputados", "evento_orgaos", "evento_pauta", "evento_votacoes"),
    "votacoes": ("votacao_votos",),
    "discursos": ("deputado_discursos",),
    "orgaos_parent": ("orgao_membros",),
    "partidos_parent": ("partido_membros",),
    "frentes_parent": ("frente_membros",),
    "legislaturas_parent": ("legislatura_lideres", "legislatura_mesa"),
}

# Per-id data folder: endpoint -> (partition name, parent entity tag or None).
PARENT_PARTITION = {
    "votacao_votos": ("votacao_id", None),
    "proposicao_autores": ("proposicao_id", "proposicao"),
    "proposicao_tramitacoes": ("proposicao_id", "proposicao"),
    "evento_deputados": ("evento_id", "evento"),
    "evento_orgaos": ("evento_id", "evento"),
    "evento_pauta": ("evento_id", "evento"),
    "evento_votacoes": ("evento_id", "evento"),
    "orgao_membros": ("parent_id", "orgao"),
    "partido_membros": ("parent_id", "partido"),
    "frente_membros": ("parent_id", "frente"),
    "legislatura_lideres": ("parent_id", "legislatura"),
    "legislatura_mesa": ("parent_id", "legislatura"),
    "deputado_discursos": ("deputado_id", "deputado"),
}
# End of fixed values.

DOMAIN_ALIASES = {"reference_snapshot": "reference"}
DEFAULT_EXPECTED_DOMAINS = (
    "ceap", "reference_snapshot", "votacoes", "proposicoes", "eventos", "institucional", "discursos",
)


@dataclass(frozen=True)
class Endpoint:
    domain: str
    name: str
    path: str
    page_size: int
    business_keys: tuple[str, ...]
    raw_prefix: str

    @property
    def per_parent(self) -> bool:
        return "{id}" in self.path


ENDPOINTS = {row[1]: Endpoint(*row) for row in _ROWS}
DOMAINS = tuple(RUN_PREFIXES)


def endpoint(name: str) -> Endpoint:
    return ENDPOINTS[name]


def domain_endpoints(domain: str) -> list[Endpoint]:
    if domain not in RUN_PREFIXES:
        raise KeyError(f"unknown domain {domain!r}; known: {', '.join(sorted(DOMAINS))}")
    return [e for e in ENDPOINTS.values() if e.domain == domain]


def endpoints_df(spark: SparkSession) -> DataFrame:
    """The catalog as 26 rows, for joins against tables that carry endpoint names."""
    return spark.createDataFrame(
        [(e.domain, e.name, e.path, e.page_size, list(e.business_keys), e.raw_prefix) for e in ENDPOINTS.values()],
        "domain string, endpoint string, path string, page_size int, business_keys array<string>, raw_prefix string",
    )


def lookup(name_col: Column, attribute: str) -> Column:
    """Catalog attribute for an endpoint-name column, as a literal map lookup."""
    pairs = [F.lit(x) for e in ENDPOINTS.values() for x in (e.name, getattr(e, attribute))]
    return F.element_at(F.create_map(*pairs), name_col)


def owner_domain(run_id: Column) -> Column:
    """Domain that owns a run id by prefix, null when none does (prefixes are disjoint)."""
    rid = F.coalesce(run_id, F.lit(""))
    return F.coalesce(*[
        F.when(rid.startswith(prefix), F.lit(domain))
        for domain, prefixes in RUN_PREFIXES.items()
        for prefix in prefixes
    ])


def canonical_domain(name: Column) -> Column:
    out = F.trim(name)
    for alias, target in DOMAIN_ALIASES.items():
        out = F.when(F.trim(name) == alias, F.lit(target)).otherwise(out)
    return out


def is_well_formed_run_id(run_id: Column) -> Column:
    return F.trim(F.coalesce(run_id, F.lit(""))).rlike(
        r"^[a-z0-9_]{1,80}_(?:[0-9]{8}|[0-9]{12}|[0-9]{14}|[a-f0-9]{16})$"
    )


def run_type(run_id: Column) -> Column:
    rid = F.coalesce(run_id, F.lit(""))
    return (
        F.when(rid.contains("_reconciliation_"), F.lit("reconciliation"))
        .when(rid.contains("_daily_"), F.lit("daily"))
        .when(rid.contains("_microbatch_"), F.lit("microbatch"))
        .otherwise(F.lit("manual_replay"))
    )


def daily_run_id(prefix: str, day: Column) -> Column:
    return F.concat(F.lit(prefix), F.date_format(day, "yyyyMMdd"))


def minute_run_id(prefix: str, ts: Column) -> Column:
    return F.concat(F.lit(prefix), F.date_format(ts, "yyyyMMddHHmm"))


def updates_ceap_registry(run_id: Column) -> Column:
    """Only automated expense runs move registry counters; manual replays do not."""
    rid = F.trim(F.coalesce(run_id, F.lit("")))
    return rid.startswith("ceap_daily_") | rid.startswith("ceap_reconciliation_")
