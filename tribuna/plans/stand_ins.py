"""The model's tables derived from the given TPC-H-like tables.

Each builder reads whole tables and stays row-wise where it can, so the work
of every query grows with its input.  ``SQL`` holds the same derivations for
the DuckDB twin of each query; :func:`twin` strings the needed ones together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tribuna import catalog
from tribuna.operators import layers as L
from tribuna.session import read_table, spread

MONEY = "decimal(18,2)"
NOW = "2024-01-20 12:00:00"
# Window of a plan: the run that is being dispatched in the fan-out queries.
PLAN_RUN = "proposicoes_daily_20240115"
CEAP_RUN = "ceap_daily_20240115"


def now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def day_text(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def compact(ts: Column) -> Column:
    return F.replace(day_text(ts), F.lit("-"), F.lit(""))


def pick(col: Column, mapping: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), col)


# -- expenses -------------------------------------------------------------

def expenses(spark: SparkSession, sf: str) -> DataFrame:
    line = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    line, orders = spread(line), read_table(spark, sf, "orders")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = line.join(o, line.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("o_custkey").alias("id_deputado"),
        F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
        F.col("l_orderkey").alias("codDocumento"),
        F.when(F.col("l_orderkey") % 3 != 0, F.concat(F.lit("N"), F.col("l_orderkey").cast("string"))).alias("numDocumento"),
        day_text(F.col("o_orderdate")).alias("dataDocumento"),
        F.concat("l_returnflag", "l_linestatus").alias("tipoDespesa"),
        F.concat(F.lit("doc/"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string")).alias("urlDocumento"),
        F.col("l_linenumber").alias("parcela"),
        F.when(F.col("l_discount") != 0, F.round(F.col("l_discount") * 100).cast("int").cast("string")).alias("numRessarcimento"),
        F.lpad(F.col("l_suppkey").cast("string"), 14, "0").alias("cnpjCpfFornecedor"),
        F.col("l_extendedprice").cast(MONEY).cast("string").alias("valorDocumento"),
        day_text(F.col("l_shipdate")).alias("_loaded_at"),
        "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
    )


def newest_first() -> list[Column]:
    """Load time first, then every other column: the given keys repeat."""
    return [L.newest(F.col("_loaded_at")), *[F.col(c) for c in (
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "tipoDespesa")]]


def deputies(spark: SparkSession, sf: str) -> DataFrame:
    c, n = read_table(spark, sf, "customer"), read_table(spark, sf, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 20 == 0, F.concat(F.lit("LID."), F.col("c_name"))).otherwise(F.col("c_name")).alias("nome"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey")).alias("ide_cadastro"),
        F.col("c_mktsegment").alias("partido"), F.col("n_name").alias("uf"),
    )


# -- task history and state ----------------------------------------------

STATUS = {"view": "QUEUED", "click": "RUNNING", "purchase": "SUCCESS", "error": "FAILED", "signup": "PENDING"}
RUN_STATUS = {"view": "QUEUING", "click": "RUNNING", "purchase": "PARTIAL", "error": "FAILED", "signup": "QUEUED"}


def k_value() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def task_events(events: DataFrame) -> DataFrame:
    ts = F.col("ts")
    return events.select(
        F.concat_ws("|", F.lit("despesas"), F.col("user_id").cast("string"), F.year(ts).cast("string"), F.month(ts).cast("string")).alias("row_key"),
        F.col("user_id").alias("id_deputado"), F.year(ts).alias("ano"), F.month(ts).alias("mes"),
        "ts", F.col("event_id").alias("seq"),
        pick(F.col("event_type"), STATUS).alias("status"),
        F.concat(F.lit("ceap_daily_"), compact(ts)).alias("run_id"),
        F.col("value").cast("int").alias("record_count"),
        F.sha2("props", 256).alias("hash"),
    )


def run_state(spark: SparkSession, sf: str) -> DataFrame:
    """One state row per event; its last run is the day before, the same day or missing."""
    e = spread(read_table(spark, sf, "events"))
    ts = F.col("ts")
    run = F.concat(F.lit("ceap_daily_"), compact(ts))
    prev = F.concat(F.lit("ceap_daily_"), F.replace(F.date_sub(F.to_date(ts), 1).cast("string"), F.lit("-"), F.lit("")))
    return e.select(
        F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("domain"),
        F.concat(F.lit("t|"), F.col("event_id").cast("string")).alias("row_key"),
        F.lit("ceap").alias("endpoint"), "event_id", "user_id", "ts",
        pick(F.col("event_type"), STATUS).alias("status"),
        run.alias("current_pipeline_run_id"),
        F.when(F.col("event_id") % 3 == 0, prev).when(F.col("event_id") % 3 == 1, run).alias("last_pipeline_run_id"),
        F.col("value").cast("int").cast("string").alias("record_count"),
        F.when(k_value() % 10 == 9, F.lit("bad")).otherwise((k_value() % 10).cast("string")).alias("last_successful_page"),
        F.year(ts).alias("ano"), F.month(ts).alias("mes"),
    )


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """Run rows: one per user and day, derived from that day's events."""
    e = read_table(spark, sf, "events")
    return (
        e.groupBy(F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("domain"),
                  F.concat(F.lit("ceap_daily_"), compact(F.col("ts"))).alias("pipeline_run_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"),
             F.max_by("event_type", "event_id").alias("last_type"))
        .select(
            "domain", "pipeline_run_id", pick(F.col("last_type"), RUN_STATUS).alias("status"),
            (F.col("n") + F.col("last_id") % 2).alias("total_tasks_expected"),
            F.col("n").alias("total_tasks_queued"),
            F.lit(0).cast("bigint").alias("total_tasks_success"), F.lit(0).cast("bigint").alias("total_tasks_failed"),
            (F.col("last_id") % 3 != 0).alias("enqueue_phase_complete"),
            F.when(F.col("last_type") == "error", F.lit("2024-02-01")).otherwise(F.lit("")).alias("failed_at"),
            F.when(F.col("last_type") == "error", F.lit("boom")).otherwise(F.lit("")).alias("last_error"),
            F.lit(None).cast("string").alias("completed_at"), F.lit(None).cast("string").alias("last_recovered_at"),
        )
    )


# -- list items and pair state -------------------------------------------

def list_items(spark: SparkSession, sf: str) -> DataFrame:
    """List rows: id and situation, plus a lineage field that must not count."""
    o = spread(read_table(spark, sf, "orders"))
    return o.select(
        F.struct(
            F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("situacao"),
            F.col("o_orderpriority").alias("_origem"),
        ).alias("item"),
        F.col("o_orderkey").alias("id"), "o_orderdate",
    )


def stored_item_hash(event_id: Column, entity: str = "proposicoes") -> dict[str, Column]:
    """Fingerprint an earlier tick stored: situation taken from ``k``, so a third still match."""
    from tribuna.functions import hashing as H

    situation = F.substring(F.lit("FOP"), (k_value() % 3 + 1), F.lit(1))
    keys = H.canonical_struct({"id": event_id})
    return {
        "uid": H.sha256(F.concat(F.lit(f"{catalog.SOURCE_SYSTEM}|{entity}|"), keys)),
        "hash": H.sha256(H.canonical_struct({"id": event_id, "situacao": situation})),
    }


def pair_state(spark: SparkSession, sf: str, endpoints: tuple[str, ...], entity: str, prefix: str) -> DataFrame:
    """State of (endpoint, id) pairs: event ``i`` describes id ``i`` at one of the endpoints."""
    e = spread(read_table(spark, sf, "events"))
    names = F.array(*[F.lit(n) for n in endpoints])
    endpoint = F.element_at(names, (F.col("event_id") % len(endpoints) + 1).cast("int"))
    fp = stored_item_hash(F.col("event_id"), entity)
    return e.select(
        F.concat(endpoint, F.lit("|"), F.col("event_id").cast("string")).alias("row_key"),
        endpoint.alias("endpoint"),
        pick(F.col("event_type"), STATUS).alias("status"),
        F.concat(F.lit(prefix), compact(F.col("ts"))).alias("current_pipeline_run_id"),
        fp["uid"].alias("last_list_item_uid"), fp["hash"].alias("last_list_item_hash"),
        (k_value() % 4).alias("attempt_count"),
    )


# -- run manifests of a day ----------------------------------------------

SUMMARY_DOMAINS = ("ceap", "reference", "votacoes", "proposicoes", "eventos", "institucional", "discursos", "mystery")


def _summary_key(o: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(n) for n in SUMMARY_DOMAINS])
    domain = F.element_at(names, (F.col("o_orderkey") % 8 + 1).cast("int"))
    run = F.concat(domain, F.lit("_daily_"), compact(F.col("o_orderdate")), F.lit("_"), F.col("o_orderkey").cast("string"))
    return o.select(
        "*", domain.alias("domain"), run.alias("pipeline_run_id"), day_text(F.col("o_orderdate")).alias("reference_date"),
        F.substring("o_orderpriority", 1, 1).alias("p"),
    )


def expected_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _summary_key(read_table(spark, sf, "orders")).select("reference_date", "domain", "pipeline_run_id")


def run_manifests(spark: SparkSession, sf: str) -> DataFrame:
    o = _summary_key(read_table(spark, sf, "orders"))
    p, st, key, cust = F.col("p"), F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_custkey")
    status = (
        F.when(p == "1", F.lit("COMPLETED")).when((p == "2") & (st == "F"), F.lit("COMPLETED"))
        .when(p == "2", F.lit(" completed ")).when((p == "3") & (st == "F"), F.lit("QUEUING"))
        .when((p == "3") & (st == "O"), F.lit("FAILED")).when(p == "3", F.lit("MYSTERY"))
        .when(p == "4", F.lit("PARTIALLY_COMPLETED")).when(st == "P", F.lit("")).otherwise(F.lit("NO_DATA"))
    )
    exp = cust % 5
    return o.where(key % 11 != 0).select(
        "domain", "pipeline_run_id",
        F.concat(F.lit("raw/"), F.col("pipeline_run_id"), F.lit("/_SUCCESS")).alias("success_marker_path"),
        status.alias("status"), exp.alias("total_tasks_expected"),
        F.when(key % 7 == 0, exp - 1).otherwise(exp).alias("total_tasks_success"),
        F.when((key % 7 == 0) & (cust % 3 == 0), 1).otherwise(0).alias("total_tasks_failed"),
        F.when(key % 31 == 0, 1).otherwise(0).alias("total_tasks_poison"),
        F.when(key % 29 == 0, 1).otherwise(0).alias("total_tasks_running"),
        F.lit(0).alias("total_tasks_pending"), F.lit(0).alias("total_tasks_queued"),
        (cust % 4).alias("record_count"), (cust % 3).alias("total_pages"),
        F.when(key % 5 != 0, F.when(key % 4 != 0, cust % 3).otherwise(cust % 3 + 1)).alias("files_written"),
    )


def run_markers(spark: SparkSession, sf: str) -> DataFrame:
    o = _summary_key(read_table(spark, sf, "orders"))
    key = F.col("o_orderkey")
    return o.where(((key % 5 != 0) & F.col("p").isin("1", "2")) | (key % 13 == 0)).select(
        F.concat(F.lit("raw/"), F.col("pipeline_run_id"), F.lit("/_SUCCESS")).alias("success_marker_path"),
        "pipeline_run_id",
    )


def run_controls(spark: SparkSession, sf: str) -> DataFrame:
    o = _summary_key(read_table(spark, sf, "orders"))
    return o.where(F.col("o_orderkey") % 3 == 0).select(
        "domain", "pipeline_run_id",
        pick(F.col("o_orderstatus"), {"F": "COMPLETED", "O": "RUNNING", "P": "partial"}).alias("status"),
    )


# -- pages ----------------------------------------------------------------

def text_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A document is a page and its lines are the records; the source is the parent."""
    d = spread(read_table(spark, sf, "documents").select("doc_id", "source", "lang", "text"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.cast("bigint").alias("id"), x.alias("nome")))
    nxt = F.struct(F.lit("next").alias("rel"), F.lit("?pagina=2").alias("href"))
    last = F.struct(
        F.lit("last").alias("rel"),
        F.concat(F.lit("https://x/y?pagina="), (F.col("doc_id") % 7 + 1).cast("string"), F.lit("&itens=100")).alias("href"),
    )
    return d.select(
        F.col("doc_id").alias("page"), F.col("source").alias("parent_id"), "lang", lines.alias("dados"),
        F.when(F.col("doc_id") % 4 != 3, F.array(nxt, last)).otherwise(F.array(last)).alias("links"),
    )


SQL = {
    "expenses": """SELECT o_custkey AS id_deputado, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
  l_orderkey AS codDocumento, CASE WHEN l_orderkey % 3 <> 0 THEN 'N' || l_orderkey END AS numDocumento,
  strftime(o_orderdate, '%Y-%m-%d') AS dataDocumento, l_returnflag || l_linestatus AS tipoDespesa,
  'doc/' || l_orderkey || '/' || l_linenumber AS urlDocumento, l_linenumber AS parcela,
  CASE WHEN l_discount <> 0 THEN CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) END AS numRessarcimento,
  lpad(CAST(l_suppkey AS VARCHAR), 14, '0') AS cnpjCpfFornecedor,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS valorDocumento,
  strftime(l_shipdate, '%Y-%m-%d') AS _loaded_at, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "latest": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY id_deputado, ano, mes, codDocumento, dataDocumento, urlDocumento, coalesce(numDocumento, '')
  ORDER BY _loaded_at DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, tipoDespesa) AS rn FROM expenses) WHERE rn = 1""",
    "deputies": """SELECT c_custkey AS id, CASE WHEN c_custkey % 20 = 0 THEN 'LID.' || c_name ELSE c_name END AS nome,
  CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS ide_cadastro, c_mktsegment AS partido, n_name AS uf
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "facts": """SELECT e.*, CAST(valorDocumento AS DECIMAL(18,2)) AS valor, d.nome, d.partido, d.uf,
  CASE WHEN d.ide_cadastro IS NOT NULL THEN 'DEPUTADO' WHEN d.nome LIKE 'LID.%' THEN 'LIDERANCA' ELSE 'OUTROS' END AS beneficiario
  FROM latest e LEFT JOIN deputies d ON e.id_deputado = d.id""",
    "ev": """SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, strftime(ts, '%Y%m%d') AS ymd,
  CASE event_type WHEN 'view' THEN 'QUEUED' WHEN 'click' THEN 'RUNNING' WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' END AS status,
  CASE event_type WHEN 'view' THEN 'QUEUING' WHEN 'click' THEN 'RUNNING' WHEN 'purchase' THEN 'PARTIAL' WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'QUEUED' END AS run_status,
  CAST(trunc(value) AS INTEGER) AS vint FROM events""",
    "task_events": """SELECT 'despesas|' || user_id || '|' || year(ts) || '|' || month(ts) AS row_key, user_id AS id_deputado,
  CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes, ts, event_id AS seq, status,
  'ceap_daily_' || ymd AS run_id, vint AS record_count, sha256(props) AS hash FROM ev""",
    "run_state": """SELECT 'd' || user_id AS domain, 't|' || event_id AS row_key, event_id, user_id, ts, status,
  'ceap_daily_' || ymd AS cur, CASE event_id % 3 WHEN 0 THEN 'ceap_daily_' || strftime(ts - INTERVAL 1 DAY, '%Y%m%d') WHEN 1 THEN 'ceap_daily_' || ymd END AS lst,
  vint AS record_count, CASE WHEN k % 10 = 9 THEN 0 ELSE k % 10 END AS page, CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes FROM ev""",
    "counts": """SELECT domain, run AS pipeline_run_id,
  count(*) FILTER (status = 'QUEUED') AS queued, count(*) FILTER (status = 'RUNNING') AS running,
  count(*) FILTER (status = 'SUCCESS') AS success, count(*) FILTER (status = 'FAILED') AS failed,
  count(*) FILTER (status = 'POISON') AS poison, count(*) FILTER (status = 'PENDING') AS pending,
  count(*) FILTER (status = 'STALE') AS stale, CAST(0 AS BIGINT) AS other,
  CAST(coalesce(sum(record_count) FILTER (status = 'SUCCESS'), 0) AS BIGINT) AS record_count_sum,
  CAST(coalesce(sum(page) FILTER (status = 'SUCCESS'), 0) AS BIGINT) AS pages_written_sum, count(*) AS seen
  FROM (SELECT *, cur AS run FROM run_state UNION ALL SELECT *, lst AS run FROM run_state WHERE lst IS NOT NULL AND lst <> cur) GROUP BY 1, 2""",
    "registry": """SELECT domain, pipeline_run_id, run_status AS status, n + last_id % 2 AS total_tasks_expected, n AS total_tasks_queued,
  last_id % 3 <> 0 AS enq, CASE WHEN run_status = 'FAILED' THEN '2024-02-01' ELSE '' END AS failed_at,
  CASE WHEN run_status = 'FAILED' THEN 'boom' ELSE '' END AS last_error, n, last_id FROM (
  SELECT 'd' || user_id AS domain, 'ceap_daily_' || ymd AS pipeline_run_id, count(*) AS n, max(event_id) AS last_id,
  arg_max(run_status, event_id) AS run_status FROM ev GROUP BY 1, 2)""",
    "items": """SELECT o_orderkey AS id, o_orderdate, o_orderpriority,
  sha256('camara_dadosabertos|proposicoes|{"id":' || o_orderkey || '}') AS uid,
  sha256('{"id":' || o_orderkey || ',"situacao":"' || o_orderstatus || '"}') AS hash FROM orders""",
    "stored": """SELECT event_id, user_id, ts, k, ymd, status,
  sha256('camara_dadosabertos|proposicoes|{"id":' || event_id || '}') AS uid,
  sha256('{"id":' || event_id || ',"situacao":"' || substr('FOP', k % 3 + 1, 1) || '"}') AS hash FROM ev""",
    "runs_key": """SELECT *, ['ceap','reference','votacoes','proposicoes','eventos','institucional','discursos','mystery'][o_orderkey % 8 + 1] AS domain,
  strftime(o_orderdate, '%Y-%m-%d') AS reference_date, substr(o_orderpriority, 1, 1) AS p FROM orders""",
    "runs_id": """SELECT *, domain || '_daily_' || strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey AS pipeline_run_id FROM runs_key""",
    "manifests": """SELECT *, CASE WHEN p = '1' THEN 'COMPLETED' WHEN p = '2' AND o_orderstatus = 'F' THEN 'COMPLETED' WHEN p = '2' THEN ' completed '
  WHEN p = '3' AND o_orderstatus = 'F' THEN 'QUEUING' WHEN p = '3' AND o_orderstatus = 'O' THEN 'FAILED' WHEN p = '3' THEN 'MYSTERY'
  WHEN p = '4' THEN 'PARTIALLY_COMPLETED' WHEN o_orderstatus = 'P' THEN '' ELSE 'NO_DATA' END AS status,
  o_custkey % 5 AS t_exp, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey % 5 - 1 ELSE o_custkey % 5 END AS t_ok,
  CASE WHEN o_orderkey % 7 = 0 AND o_custkey % 3 = 0 THEN 1 ELSE 0 END AS t_bad, CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS t_poison,
  CASE WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END AS t_running, o_custkey % 4 AS record_count, o_custkey % 3 AS total_pages,
  CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey % 3 ELSE o_custkey % 3 + 1 END END AS files_written,
  (o_orderkey % 5 <> 0 AND p IN ('1', '2')) OR o_orderkey % 13 = 0 AS has_marker, o_orderkey % 11 <> 0 AS found,
  CASE WHEN o_orderkey % 3 = 0 THEN CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING' ELSE 'PARTIAL' END ELSE '' END AS control
  FROM runs_id""",
    "insp1": """SELECT *, CASE WHEN upper(trim(status)) = 'PARTIALLY_COMPLETED' THEN 'PARTIAL' ELSE upper(trim(status)) END AS st, t_bad > 0 OR t_poison > 0 AS bad FROM manifests""",
    "insp": """SELECT *, CASE WHEN NOT found THEN 'NOT_FOUND' WHEN st = 'FAILED' OR bad THEN 'FAILED' WHEN st = '' THEN 'INVALID_METADATA' ELSE st END AS derived FROM insp1""",
    "warns": """SELECT reference_date, domain, pipeline_run_id, st, control, derived, w.why AS why, w.w AS w FROM (SELECT *, unnest([
  {'why': 1, 'w': CASE WHEN NOT found THEN 'metadata_not_found' END},
  {'why': 2, 'w': CASE WHEN found AND st = 'COMPLETED' AND NOT has_marker THEN 'success_marker_missing' END},
  {'why': 3, 'w': CASE WHEN found AND has_marker AND st NOT IN ('COMPLETED', 'NO_DATA') THEN 'success_marker_exists_but_status_not_completed' END},
  {'why': 4, 'w': CASE WHEN found AND t_exp > 0 AND t_ok <> t_exp AND st = 'COMPLETED' THEN 'task_counts_inconsistent' END},
  {'why': 5, 'w': CASE WHEN found AND bad AND st IN ('COMPLETED', 'NO_DATA') THEN 'task_counts_inconsistent' END},
  {'why': 6, 'w': CASE WHEN found AND control <> '' AND control <> derived AND derived NOT IN ('NOT_FOUND', 'INVALID_METADATA') THEN 'ingestion_control_differs_from_raw_metadata' END}
  ]) AS w FROM insp) WHERE w.w IS NOT NULL
  UNION ALL SELECT reference_date, expected, '', '', '', '', 0, CASE WHEN domain = 'mystery' THEN 'domain_not_implemented' ELSE 'metadata_not_found' END
  FROM evf WHERE pipeline_run_id IS NULL AND domain NOT IN ('ceap', 'reference', 'votacoes', 'institucional')""",
    "days": "SELECT DISTINCT reference_date FROM runs_key",
    "expd": """SELECT reference_date, expected, CASE expected WHEN 'reference_snapshot' THEN 'reference' ELSE expected END AS domain FROM days,
  (SELECT unnest(['ceap','reference_snapshot','votacoes','proposicoes','eventos','institucional','discursos','mystery']) AS expected)""",
    "evf": """SELECT x.reference_date, x.expected, x.domain, i.pipeline_run_id,
  CASE WHEN x.domain = 'mystery' THEN 'NOT_IMPLEMENTED' WHEN i.pipeline_run_id IS NULL THEN 'NOT_FOUND' ELSE i.derived END AS status
  FROM expd x LEFT JOIN insp i ON i.reference_date = x.reference_date AND i.domain = x.domain""",
    "droll": """SELECT reference_date, expected, count(*) FILTER (pipeline_run_id IS NOT NULL OR domain NOT IN ('ceap', 'reference', 'votacoes', 'institucional')) AS runs, CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED'
  WHEN bool_or(status IN ('RUNNING', 'QUEUED', 'QUEUING')) THEN 'RUNNING' WHEN bool_or(status = 'PARTIAL') THEN 'PARTIAL'
  WHEN bool_or(status = 'INVALID_METADATA') THEN 'FAILED' WHEN bool_and(status = 'NOT_FOUND') THEN 'NOT_FOUND'
  WHEN bool_and(status = 'NO_DATA') THEN 'NO_DATA' WHEN bool_and(status IN ('COMPLETED', 'NO_DATA')) THEN 'COMPLETED' ELSE 'PARTIAL' END AS domain_status
  FROM evf GROUP BY 1, 2""",
    "dayroll": """SELECT reference_date, CASE WHEN count(*) FILTER (domain_status <> 'NOT_IMPLEMENTED') = 0 THEN 'PARTIAL'
  WHEN bool_or(domain_status = 'FAILED') THEN 'FAILED' WHEN bool_or(domain_status IN ('RUNNING', 'QUEUED', 'QUEUING')) THEN 'RUNNING'
  WHEN bool_or(domain_status IN ('PARTIAL', 'NOT_FOUND')) THEN 'PARTIAL' ELSE 'COMPLETED' END AS status FROM droll GROUP BY 1""",
    "lines": """SELECT doc_id AS page, source AS parent_id, lang, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents""",
    "recs": """SELECT *, sha256('{"id":' || pos || ',"nome":' || to_json(line)::VARCHAR || '}') AS record_hash,
  sha256('camara_dadosabertos|evento_deputados|{"id":' || pos || '}') AS record_uid FROM lines""",
}

_NEEDS = {
    "latest": ["expenses"], "facts": ["latest", "deputies"], "task_events": ["ev"], "run_state": ["ev"],
    "counts": ["run_state"], "registry": ["ev"], "stored": ["ev"], "runs_id": ["runs_key"], "manifests": ["runs_id"],
    "insp1": ["manifests"], "insp": ["insp1"], "warns": ["insp", "evf"], "days": ["runs_key"], "expd": ["days"],
    "evf": ["expd", "insp"], "droll": ["evf"], "dayroll": ["droll"], "recs": ["lines"],
}


def twin(select: str, *names: str) -> str:
    """The SQL twin: the named derivations (with what they need), then ``select``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        add(n)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in ordered) + "\n" + select
