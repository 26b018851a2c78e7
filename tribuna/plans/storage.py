"""Round trips through the sinks and sources: written below the shared folder, read back.

Every call writes to a fresh folder, so nothing has to be cleared.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tribuna.functions import scalars as S
from tribuna.operators import budget as B
from tribuna.operators import envelope as E
from tribuna.operators import fingerprints as FP
from tribuna.operators import layers as L
from tribuna.operators import manifests as MF
from tribuna.operators import summary as SU
from tribuna.plans import dispatch, health, records
from tribuna.plans import stand_ins as ST
from tribuna.plans.stand_ins import twin
from tribuna.session import read_table, work_path
from tribuna.sources import pages as PG
from tribuna.sources import sinks, tables

_RECORD = "id bigint, nome string"


def _audited(spark, sf):
    pages = ST.text_pages(spark, sf).withColumns({
        "pipeline_run_id": F.concat(F.lit("eventos_daily_"), F.col("lang")), "execution_id": F.lit("e"),
        "ingested_at": F.lit("2024-01-20T12:00:00+00:00")})
    return E.enrich_pages(pages, "evento_deputados")


def pages_roundtrip(spark, sf):
    """Audited pages under run partitions; a rerun of one run replaces only its own partition."""
    root = work_path(spark, "pages")
    pages = _audited(spark, sf).withColumn("run", F.col("pipeline_run_id")).select("_audit", "dados", "links", "page", "run")
    sinks.write_pages(pages, root, ("run",))
    sinks.write_pages(pages.where(F.col("run") == "eventos_daily_en"), root, ("run",))
    parsed = PG.read_pages(spark, root, _RECORD + ", _record_hash string", ["run"], page_files=False)
    page = F.get_json_object("raw", "$._audit._page").cast("int")
    return parsed.select("run", page.alias("page"), F.posexplode("dados").alias("pos", "item")).select(
        "run", "page", "pos", F.col("item._record_hash").alias("record_hash"))


def jsonl_roundtrip(spark, sf):
    """List snapshot as JSON lines, one page per line: every record and every link of it."""
    path = work_path(spark, "jsonl")
    doc = ST.text_pages(spark, sf).select(F.to_json(F.struct("dados", "links")).alias("doc"))
    sinks.write_jsonl(doc, path, "doc")
    back = PG.read_pages_jsonl(spark, path, _RECORD)
    return back.select(
        F.size("dados").alias("records"),
        F.sha2(F.array_join(F.transform("dados", lambda x: F.coalesce(x["nome"], F.lit(""))), "\n"), 256).alias("names"),
        F.size("links").alias("n_links"))


def manifest_roundtrip(spark, sf):
    """Manifests and markers of two writes: all runs as COMPLETED, then a replay of those that are not."""
    mpath, kpath = work_path(spark, "manifests"), work_path(spark, "markers")
    rows = health._run_rows(spark, sf)
    sinks.write_manifests(MF.build_ceap_manifest(rows.withColumn("status", F.lit("COMPLETED"))), mpath, kpath, "manifest")
    doc = MF.build_ceap_manifest(rows)
    sinks.write_manifests(doc.where(~sinks.completed()), mpath, kpath, "manifest")
    back = SU.join_markers(tables.read_manifests(spark, mpath), tables.read_markers(spark, kpath))
    return back.select("pipeline_run_id", "status", "run_type", F.array_join(F.transform("reference_months", lambda m: m.cast("string")), ",").alias("months"),
                       "total_tasks_expected", "enqueue_phase_complete", "parent_snapshot_path", "has_marker")


def fingerprint_map_roundtrip(spark, sf):
    """Fingerprint documents of each event day, written as maps and exploded again."""
    path = work_path(spark, "fingerprints")
    rows = records._list_rows(spark, sf)
    fp = FP.last_wins(rows, ["ts", "event_id"])
    sinks.write_jsonl(FP.to_documents(fp.withColumn("run", F.lit("r")), "run"), path, "raw")
    docs = spark.read.text(path).withColumnRenamed("value", "raw")
    return tables.explode_fingerprints(docs)


def layers_roundtrip(spark, sf):
    """Silver expenses as partitioned Parquet, totals from the files."""
    path = work_path(spark, "silver")
    silver = L.silver_cast(ST.expenses(spark, sf)).select("ano", "mes", "tipoDespesa", "valor")
    sinks.write_layer(silver, path, ("ano",))
    back = spark.read.parquet(path)
    return back.groupBy("ano", "tipoDespesa").agg(F.sum("valor").cast("double").alias("total"), F.count(F.lit(1)).alias("documentos"))


def state_roundtrip(spark, sf):
    """Two versions of the state table; the newest is read, one domain and run only."""
    path = work_path(spark, "state")
    state = ST.run_state(spark, sf).select("domain", "row_key", "status", "current_pipeline_run_id", "last_pipeline_run_id")
    tables.write_version(state, path, 1)
    tables.write_version(state.withColumn("status", F.when(F.col("status") == "FAILED", F.lit("QUEUED")).otherwise(F.col("status"))), path, 2)
    return tables.read_state(spark, path, run_id=ST.CEAP_RUN).select("domain", "row_key", "status")


def state_by_domain(spark, sf):
    """Two versions of the state table in folders by the hash of the domain; one domain of the newest is read, its run only."""
    path = work_path(spark, "state")
    state = ST.run_state(spark, sf).select("domain", "row_key", "status", "current_pipeline_run_id", "last_pipeline_run_id")
    tables.write_version(state.withColumn("status", F.lit("OLD")), path, 1, ("domain",))
    tables.write_version(state, path, 2, ("domain",))
    return tables.read_state(spark, path, "d1", ST.CEAP_RUN).select("domain", "row_key", "status")


def changed_file(spark, sf):
    """The changed-records file of a plan, written and read back."""
    path = work_path(spark, "changed")
    sinks.write_changed(dispatch._plan(spark, sf), path)
    return spark.read.schema("id string, list_item_hash string, endpoint string, reason string").json(path)


def ids_in_order(spark, sf):
    """Vote ids in the listing's order, numbers first, with their place: sorted as one table over many files."""
    e = read_table(spark, sf, "events")
    ids = e.select(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("55-"), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string")).alias("id"))
    keys = S.id_order(F.col("id"))
    names = [f"k{i}" for i in range(len(keys))]
    placed = B.with_ordinal(ids.select("id", *[k.alias(n) for k, n in zip(keys, names)]), names)
    return placed.select((F.col("ordinal") + 1).cast("bigint").alias("place"), "id")


def daily_summary_roundtrip(spark, sf):
    """Summary documents and day markers of two writes: all days as green, then the true documents of those that are not COMPLETED or have warnings."""
    path, kpath = work_path(spark, "summary"), work_path(spark, "summary-markers")
    out = health._documents(spark, sf).select("reference_date", "status", "warnings_count", "warning_types")
    sinks.write_daily_summary(out.withColumns({"status": F.when(F.col("warnings_count") >= 0, F.lit("COMPLETED")), "warning_types": F.slice("warning_types", 1, 0)}), path, kpath)
    sinks.write_daily_summary(out.where((F.col("status") != "COMPLETED") | (F.col("warnings_count") > 0)), path, kpath)
    days = tables.read_daily_summaries(spark, path, "status string, warnings_count bigint, warning_types array<string>")
    marked = tables.read_day_markers(spark, kpath).withColumn("has_marker", F.lit(True))
    return days.join(marked, "reference_date", "left").select(
        F.col("reference_date").alias("day"), "status", "warnings_count", F.coalesce("has_marker", F.lit(False)).alias("has_marker"))


def csv_history(spark, sf):
    """Annual expense files: written as CSV, read with an explicit schema."""
    path = work_path(spark, "csv")
    e = ST.expenses(spark, sf)
    out = e.select(F.col("id_deputado").alias("nuDeputadoId"), F.when(F.col("id_deputado") % 10 != 0, F.col("id_deputado")).alias("ideCadastro"),
                   F.concat(F.when(F.col("id_deputado") % 20 == 0, F.lit('LID."')).otherwise(F.lit('Dep. "')), F.col("tipoDespesa"), F.lit('"; x')).alias("txNomeParlamentar"), F.col("ano").alias("numAno"),
                   F.col("mes").alias("numMes"), F.col("dataDocumento").alias("datEmissao"), F.col("valorDocumento").alias("vlrDocumento"))
    out.write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    schema = "nuDeputadoId bigint, ideCadastro bigint, txNomeParlamentar string, numAno int, numMes int, datEmissao string, vlrDocumento string"
    back = L.silver_from_csv(PG.read_ceap_csv(spark, path, schema))
    return back.groupBy("numAno", "numMes", "txNomeParlamentar", "beneficiario").agg(
        F.count(F.lit(1)).alias("linhas"), F.min("competencia").cast("string").alias("competencia"),
        F.sum(F.col("vlrDocumento").cast("decimal(18,2)")).cast("double").alias("total"), F.max("data_emissao").cast("string").alias("ultima"))


def first_page_copy(spark, sf):
    """Executions that rewrote the same page: the smallest path is kept."""
    c = read_table(spark, sf, "conversations")
    pages = c.select("role", F.col("turn").alias("page"), F.concat(F.lit("run/execution_id="), F.lpad(F.col("conv_id").cast("string"), 6, "0"), F.lit("/page_"), F.col("turn").cast("string"), F.lit(".json")).alias("raw_path"))
    return PG.first_page_copy(pages, ["role"])


QUERIES = {
    "pages_roundtrip": (pages_roundtrip, twin("SELECT 'eventos_daily_' || lang AS run, CAST(page AS INTEGER) AS page, CAST(pos AS INTEGER) AS pos, record_hash FROM recs", "recs")),
    "jsonl_roundtrip": (jsonl_roundtrip, "SELECT CAST(len(string_split(text, chr(10))) AS INTEGER) AS records, sha256(text) AS names, CASE WHEN doc_id % 4 <> 3 THEN 2 ELSE 1 END AS n_links FROM documents"),
    "manifest_roundtrip": (manifest_roundtrip, health._RR + """ SELECT pipeline_run_id, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'QUEUING' ELSE 'FAILED' END AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'reconciliation' ELSE 'daily' END AS run_type,
  CASE o_orderkey % 4 WHEN 0 THEN '5,4' WHEN 1 THEN '3,2' ELSE '' END AS months, CAST(o_orderkey % 10 AS INTEGER) AS total_tasks_expected, o_orderkey % 2 = 0 AS enqueue_phase_complete,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'raw/x/' || d END AS parent_snapshot_path, o_orderstatus = 'F' AS has_marker FROM r"""),
    "fingerprint_map_roundtrip": (fingerprint_map_roundtrip, twin("""SELECT CAST(user_id AS VARCHAR) AS id, arg_max(sha256('camara_dadosabertos|proposicoes|{"id":' || user_id || '}'), (ts, event_id)) AS uid,
  arg_max(sha256('{"id":' || user_id || ',"situacao":"' || substr('FOP', k % 3 + 1, 1) || '"}'), (ts, event_id)) AS hash FROM ev GROUP BY 1""", "ev")),
    "layers_roundtrip": (layers_roundtrip, twin("SELECT ano, tipoDespesa, CAST(sum(CAST(valorDocumento AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS documentos FROM expenses GROUP BY 1, 2", "expenses")),
    "state_roundtrip": (state_roundtrip, twin("SELECT domain, row_key, CASE status WHEN 'FAILED' THEN 'QUEUED' ELSE status END AS status FROM run_state WHERE cur = 'ceap_daily_20240115' OR lst = 'ceap_daily_20240115'", "run_state")),
    "state_by_domain": (state_by_domain, twin("SELECT domain, row_key, status FROM run_state WHERE domain = 'd1' AND (cur = 'ceap_daily_20240115' OR lst = 'ceap_daily_20240115')", "run_state")),
    "changed_file": (changed_file, dispatch.QUERIES["changed_records"][1]),
    "ids_in_order": (ids_in_order, """WITH i AS (SELECT event_id, event_id % 7 = 0 AS txt, CASE WHEN event_id % 7 = 0 THEN '55-' || event_id ELSE CAST(event_id AS VARCHAR) END AS id FROM events)
  SELECT row_number() OVER (ORDER BY txt, CASE WHEN NOT txt THEN event_id END, id) AS place, id FROM i"""),
    "daily_summary_roundtrip": (daily_summary_roundtrip, twin("""SELECT d.reference_date AS day, d.status, coalesce(w.n, 0) AS warnings_count, d.status = 'COMPLETED' AND coalesce(w.crit, 0) = 0 AS has_marker FROM dayroll d LEFT JOIN (SELECT reference_date, count(*) AS n,
  count(*) FILTER (w IN ('success_marker_missing', 'task_counts_inconsistent', 'success_marker_exists_but_status_not_completed')) AS crit FROM warns GROUP BY 1) w USING (reference_date)""", "dayroll", "warns")),
    "csv_history": (csv_history, twin("""SELECT ano AS numAno, mes AS numMes, CASE WHEN id_deputado % 20 = 0 THEN 'LID."' ELSE 'Dep. "' END || tipoDespesa || '"; x' AS txNomeParlamentar,
  CASE WHEN id_deputado % 10 <> 0 THEN 'DEPUTADO' WHEN id_deputado % 20 = 0 THEN 'LIDERANCA' ELSE 'OUTROS' END AS beneficiario, count(*) AS linhas, ano || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') || '-01' AS competencia,
  CAST(sum(CAST(valorDocumento AS DECIMAL(18,2))) AS DOUBLE) AS total, max(dataDocumento) AS ultima FROM expenses GROUP BY ALL""", "expenses")),
    "first_page_copy": (first_page_copy, "SELECT role, turn AS page, 'run/execution_id=' || lpad(CAST(min(conv_id) AS VARCHAR), 6, '0') || '/page_' || turn || '.json' AS raw_path FROM conversations GROUP BY role, turn"),
}
