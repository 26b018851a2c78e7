"""Queries over records and pages: identifiers, hashes, envelopes, fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tribuna import catalog
from tribuna.functions import hashing as H
from tribuna.functions import scalars as S
from tribuna.operators import envelope as E
from tribuna.operators import fingerprints as FP
from tribuna.operators import layers as L
from tribuna.operators.batches import count_window as count_window_op
from tribuna.plans import stand_ins as ST
from tribuna.plans.stand_ins import twin
from tribuna.session import read_table, spread
from tribuna.sources import tables

_DOC_FIELDS = list(catalog.CEAP_UID_FIELDS)


def ceap_record_uid(spark, sf):
    e = ST.expenses(spark, sf)
    item = F.struct(*_DOC_FIELDS)
    return e.select(
        "urlDocumento", H.ceap_record_uid(item, F.col("id_deputado"), F.col("ano"), F.col("mes")).alias("record_uid"),
        S.state_key(F.lit("despesas"), F.col("id_deputado"), F.col("ano"), F.col("mes")).alias("state_key"),
        S.legacy_key(F.col("ano"), F.col("mes"), F.col("id_deputado")).alias("legacy_key"),
    )


def ceap_uid_numeric(spark, sf):
    """Expenses whose amount is a number, up to many millions."""
    e = ST.expenses(spark, sf).withColumn("valorDocumento", F.floor(F.col("valorDocumento").cast("double") * 1000).cast("double") + 0.5)
    item = F.struct(*_DOC_FIELDS)
    return e.select("urlDocumento", H.ceap_record_uid(item, F.col("id_deputado"), F.col("ano"), F.col("mes"), T.DoubleType()).alias("record_uid"))


def record_hash_raw_pages(spark, sf):
    """Every record of raw pages by its text: undeclared keys, floats, and null keys that some records lack."""
    e = read_table(spark, sf, "events")
    note = F.when(F.col("event_id") % 3 == 0, F.lit('"nota":null,')).otherwise(F.lit(""))
    record = F.concat(F.lit('{"v":'), F.col("value").cast("string"), F.lit(', "id":'), F.col("event_id").cast("string"), F.lit(","), note, F.lit('"extra":'), "props", F.lit("}"))
    two = F.concat(F.lit('{"dados":['), record, F.lit(',{"id":null}],"links":[]}'))
    return H.explode_raw(e.select("event_id", two.alias("raw")), "raw", "event_id").select("event_id", "pos", "record_hash")


def fingerprint_raw(spark, sf):
    """List items by their text: an undeclared key counts, keys with an underscore do not."""
    e = read_table(spark, sf, "events")
    opt = F.when(F.col("event_id") % 2 == 0, F.lit('"opt":null,')).otherwise(F.lit(""))
    raw = F.concat(F.lit('{"_seen":1,'), opt, F.lit('"props":'), "props", F.lit(',"id":'), F.col("user_id").cast("string"), F.lit("}"))
    return H.fingerprint_raw(e.select("event_id", raw.alias("raw")), "raw", "proposicoes").select("event_id", "uid", "hash")


def deputy_uid_nullable(spark, sf):
    c = read_table(spark, sf, "customer")
    k = F.col("c_custkey")
    raw = F.when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, F.lit("not-int")).otherwise(k.cast("string"))
    return c.select("c_custkey", H.deputy_record_uid(raw).alias("deputy_uid")).where(F.col("deputy_uid").isNotNull())


def record_hash_diff(spark, sf):
    """New list items against the fingerprints an earlier tick stored."""
    new = H.list_item_fingerprint(ST.list_items(spark, sf), "item", "proposicoes")
    new = new.select(F.col("id").cast("string").alias("id"), "uid", "hash")
    fp = ST.stored_item_hash(F.col("event_id"))
    old = read_table(spark, sf, "events").select(F.col("event_id").cast("string").alias("id"), fp["uid"].alias("uid"), fp["hash"].alias("hash"))
    return FP.diff(old, new)


def payload_hash_documents(spark, sf):
    """Payload hash of one-record pages made of whole texts."""
    d = spread(read_table(spark, sf, "documents"))
    page = H.canonical_struct({"dados": F.array(F.struct(F.col("text").alias("texto"))), "links": F.array().cast("array<string>")})
    return d.select("doc_id", H.sha256(page).alias("payload_hash"))


def canonical_hash_exact(spark, sf):
    """Hash over raw JSON text, keys as received."""
    e = spread(read_table(spark, sf, "events"))
    raw = F.concat(F.lit('{"tipo": "'), F.col("event_type"), F.lit('", "_record_hash": "x", "props": '), F.col("props"), F.lit(', "id": '), F.col("event_id").cast("string"), F.lit("}"))
    return e.select("event_id", H.record_hash_raw(raw).alias("record_hash"))


def explode_pages(spark, sf):
    """Records of every page with position, parent and record hash."""
    pages = ST.text_pages(spark, sf)
    rec = E.explode_records(pages, "page", "parent_id")
    dtype = rec.schema["item"].dataType
    return rec.select("page", "parent_id", "pos", H.record_hash(F.col("item"), dtype).alias("record_hash"))


def page_totals(spark, sf):
    """Pages, records, pages with a next link and promised totals per parent."""
    pages = ST.text_pages(spark, sf)
    n = F.size("dados")
    flagged = pages.select("parent_id", "dados", S.has_next(F.col("links")).alias("nxt"), S.total_hint(F.col("links"), n).alias("hint"))
    totals = E.page_totals(flagged, "parent_id")
    links = flagged.groupBy("parent_id").agg(
        F.count_if("nxt").alias("with_next"), F.sum("hint").cast("bigint").alias("total_hint"))
    return totals.join(links, "parent_id")


def dotted_path(spark, sf):
    """Values by dotted path; messages (plain or base64) that belong to one run."""
    e = read_table(spark, sf, "events")
    return e.select(
        "event_id", H.resolve_path(F.col("props"), "k").alias("k"), H.resolve_path(F.col("props"), "k.x").alias("k_x"),
        H.resolve_path(F.col("props"), "a.b").alias("a_b"),
    )


def _messages(spark, sf):
    e = spread(read_table(spark, sf, "events"))
    body = F.concat(
        F.lit('{"domain": " ceap", "endpoint": "ceap", "pipeline_run_id": "ceap_daily_'), ST.compact(F.col("ts")),
        F.lit('", "payload": '), F.col("props"), F.lit("}"),
    )
    coded = F.when(F.col("event_id") % 5 == 0, F.lit("garbage!")).when(
        F.col("event_id") % 2 == 1, F.base64(body.cast("binary"))).otherwise(body)
    return e.select("event_id", coded.alias("body"))


def message_scan(spark, sf):
    m = tables.parse_messages(_messages(spark, sf))
    return m.select("event_id", "domain", "pipeline_run_id", F.col("payload")["k"].alias("k"),
                    F.when(F.col("pipeline_run_id").isNotNull(), F.col("run_type")).alias("run_type"))


def messages_for_run(spark, sf):
    return tables.messages_for_run(_messages(spark, sf), ST.CEAP_RUN).select("event_id")


def _list_rows(spark, sf):
    e = spread(read_table(spark, sf, "events"))
    fp = ST.stored_item_hash(F.col("user_id"))
    return e.select(F.col("user_id").alias("id"), fp["uid"].alias("uid"), fp["hash"].alias("hash"), "ts", "event_id")


def list_fingerprints_lastwins(spark, sf):
    """Last record per id of this tick over the map saved before (first half of the month)."""
    rows = _list_rows(spark, sf)
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    saved = FP.last_wins(rows.where(F.col("ts") < cut), ["ts", "event_id"])
    tick = FP.last_wins(rows.where(F.col("ts") >= cut), ["ts", "event_id"])
    return FP.merge_fingerprints(saved, tick)


def distinct_ids(spark, sf):
    return FP.distinct_ids(_list_rows(spark, sf))


def enrich_pages(spark, sf):
    """Audit columns and record identifiers of the text pages, flattened."""
    pages = ST.text_pages(spark, sf).withColumns({
        "pipeline_run_id": F.concat(F.lit("eventos daily/"), F.col("lang")), "execution_id": F.lit("exec 1"),
        "ingested_at": F.lit("2024-01-20T12:00:00+00:00"),
    })
    out = E.enrich_pages(pages, "evento_deputados", extra={"_window_start_utc": F.lit("w0"), "_domain": F.lit("never")})
    a = "_audit."
    return out.select(
        F.col(a + "_page").alias("page"), F.col(a + "_domain").alias("domain"), F.col(a + "_api_path").alias("api_path"),
        F.col(a + "_raw_path").alias("raw_path"), F.col(a + "_parent_id").alias("parent_id"), F.col(a + "_parent_entity").alias("parent_entity"),
        F.col(a + "_window_start_utc").alias("window_start"), F.col(a + "_pipeline_run_id").alias("run"),
        F.size("dados").alias("records"), F.col("dados")[0]["_record_uid"].alias("first_uid"),
        F.element_at("dados", -1)["_record_hash"].alias("last_hash"),
    )


def _received_pages(spark, sf):
    """Text pages as the API sent them: keys in another order, and a field that no schema declares."""
    pages = ST.text_pages(spark, sf).withColumns({
        "pipeline_run_id": F.concat(F.lit("eventos_daily_"), F.col("lang")), "execution_id": F.lit("e"),
        "ingested_at": F.lit("2024-01-20T12:00:00+00:00"),
    })
    sent = F.transform("dados", lambda x: F.struct(F.lit("S").alias("situacao"), x["nome"].alias("nome"), x["id"].alias("id")))
    return pages.withColumn("received", F.to_json(F.struct("links", sent.alias("dados"))))


def enrich_pages_received(spark, sf):
    """Every record's hash over the text as received, undeclared fields included."""
    out = E.enrich_pages(_received_pages(spark, sf), "evento_deputados", raw="received")
    return E.each_item(out, F.col("dados"), F.col("_audit._page").alias("page")).select(
        "page", "pos", F.col("item._record_uid").alias("record_uid"), F.col("item._record_hash").alias("record_hash"))


def bronze_received(spark, sf):
    """Bronze records beside their text as received."""
    out = L.bronze(E.enrich_pages(_received_pages(spark, sf), "evento_deputados", raw="received"), raw="received")
    return out.select("_source_file", "pos", "_record_hash", F.get_json_object("_received", "$.situacao").alias("situacao"),
                      F.sha2(F.get_json_object("_received", "$.nome"), 256).alias("nome_sha256"))


def deputies_envelope(spark, sf):
    """Deputies form of the envelope: list pages of 50, audited twice over, so the second pass strips the first's lineage."""
    c = read_table(spark, sf, "customer")
    item = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"))
    pages = c.groupBy((F.floor(F.col("c_custkey") / 50) + 1).cast("int").alias("page")).agg(F.sort_array(F.collect_list(item)).alias("dados"))
    pages = pages.withColumns({
        "reference_date": F.lit("2024-01-15"), "pipeline_run_id": F.lit("reference_snapshot_20240115"), "execution_id": F.lit("e"),
        "ingested_at": F.lit("2024-01-15T12:00:00+00:00"), "links": F.array().cast("array<struct<rel:string,href:string>>"),
    })
    once = E.enrich_pages(pages, "deputados", layout="dated")
    out = E.enrich_pages(once.drop("raw_path", "_payload_hash"), "deputados", layout="dated")
    return out.select("_audit", F.explode("dados").alias("item")).select(
        F.col("_audit._page").alias("page"), F.col("_audit._entity").alias("entity"), F.col("_audit._reference_date").alias("reference_date"),
        F.col("_audit._payload_hash").alias("payload_hash"), F.col("item.id").alias("id"),
        F.col("item._record_uid").alias("record_uid"), F.col("item._record_hash").alias("record_hash"))


def ceap_envelope(spark, sf):
    """Expense form of the envelope on one-record pages."""
    e = ST.expenses(spark, sf)
    pages = e.select(
        "id_deputado", "ano", "mes", F.array(F.struct(*_DOC_FIELDS)).alias("dados"), F.col("parcela").alias("page"),
        F.concat(F.lit("ceap_daily_"), F.replace("_loaded_at", F.lit("-"), F.lit(""))).alias("pipeline_run_id"),
        F.lit("x1").alias("execution_id"), F.col("_loaded_at").alias("ingested_at"),
    )
    out = E.enrich_pages(pages, "deputado_despesas", layout="ceap")
    return out.select(
        F.col("_audit._raw_path").alias("raw_path"), F.col("_audit._reference_month").alias("reference_month"),
        F.col("dados")[0]["_record_uid"].alias("record_uid"), F.col("_audit._payload_hash").alias("payload_hash"),
    )


def bronze_records(spark, sf):
    """Bronze rows of the valid runs."""
    pages = ST.text_pages(spark, sf).withColumns({
        "pipeline_run_id": F.concat(F.lit("eventos_daily_"), F.col("lang")), "execution_id": F.lit("e"),
        "ingested_at": F.lit("2024-01-20T12:00:00+00:00"),
    })
    audited = E.enrich_pages(pages, "evento_deputados")
    valid = read_table(spark, sf, "documents").where(F.col("lang") != "de").select(F.concat(F.lit("eventos_daily_"), F.col("lang")).alias("pipeline_run_id")).distinct()
    return L.bronze(audited, valid).select(
        "_source_file", "_source_endpoint", "_ingestion_date", "_pipeline_run_id", "_record_hash", "pos")


def snapshot_pages(spark, sf):
    """Sub-resource snapshots: conversations are parents, turns pages, assistant turns end with ``next``.

    A very long text stands for a failed fetch.
    """
    c = spread(read_table(spark, sf, "conversations"))
    nxt = F.array(F.struct(F.lit("next").alias("rel"), F.lit("h").alias("href")))
    pages = c.select(
        F.col("conv_id").alias("parent_id"), (F.col("turn") + 1).alias("page"),
        F.split("text", r"\. ").alias("dados"), (F.length("text") > 600).alias("failed"),
        F.when(F.col("turn") % 3 != 2, nxt).alias("links"),
    )
    return E.snapshot_results(pages, ["parent_id"]).select("parent_id", "pages_written", "record_count", "final_status")


def count_window(spark, sf):
    """Distinct ids of a listing with a page per day, per year, over all pages, with the warning of long listings."""
    o = read_table(spark, sf, "orders")
    items = o.select(F.year("o_orderdate").alias("ano"), (F.dayofyear("o_orderdate")).alias("page"), F.col("o_custkey").alias("id"))
    return count_window_op(items, ["ano"], 300).select("ano", "distinct_ids", "pages_fetched", "warning")


def parent_context(spark, sf):
    """Votes carry no parent id; it comes from the path."""
    e = read_table(spark, sf, "events")
    rec = e.select("event_id", F.concat(F.lit("raw/camara/votacoes/api/votos/votacao_id="), F.col("user_id").cast("string"),
                                        F.lit("/pipeline_run_id=r/page_1.json")).alias("path"))
    out = E.attach_parent(rec, "path", "votacao_id")
    return out.select("event_id", "parent_id", S.path_value(F.col("path"), "pipeline_run_id").alias("run"),
                      S.path_value(F.col("path"), "execution_id").alias("execution"))


_UID = """sha256('camara_dadosabertos|deputado_despesas|{"ano":' || ano || ',"cnpjCpfFornecedor":"' || cnpjCpfFornecedor || '","codDocumento":' || codDocumento
 || ',"dataDocumento":"' || dataDocumento || '","id_deputado":' || id_deputado || ',"mes":' || mes || ',"numDocumento":' || coalesce('"' || numDocumento || '"', 'null')
 || ',"numRessarcimento":' || coalesce('"' || numRessarcimento || '"', 'null') || ',"parcela":' || parcela || ',"tipoDespesa":"' || tipoDespesa
 || '","urlDocumento":"' || urlDocumento || '","valorDocumento":"' || valorDocumento || '"}')"""
_PAYLOAD = """sha256('{"dados":[{"cnpjCpfFornecedor":"' || cnpjCpfFornecedor || '","codDocumento":' || codDocumento
 || ',"dataDocumento":"' || dataDocumento || '","numDocumento":' || coalesce('"' || numDocumento || '"', 'null')
 || ',"numRessarcimento":' || coalesce('"' || numRessarcimento || '"', 'null') || ',"parcela":' || parcela || ',"tipoDespesa":"' || tipoDespesa
 || '","urlDocumento":"' || urlDocumento || '","valorDocumento":"' || valorDocumento || '"}]}')"""
_MSG = "event_id % 5 <> 0"

QUERIES = {
    "ceap_record_uid": (ceap_record_uid, twin(f"""SELECT urlDocumento, {_UID} AS record_uid, 'despesas|' || id_deputado || '|' || ano || '|' || mes AS state_key,
  ano || '_' || lpad(CAST(mes AS VARCHAR), 2, '0') || '_' || id_deputado AS legacy_key FROM expenses""", "expenses")),
    "ceap_uid_numeric": (ceap_uid_numeric, twin("""SELECT urlDocumento, """ + _UID + """ AS record_uid
  FROM (SELECT * REPLACE (CAST(floor(CAST(valorDocumento AS DOUBLE) * 1000) + 0.5 AS VARCHAR) AS valorDocumento) FROM expenses)""", "expenses")),
    "record_hash_raw_pages": (record_hash_raw_pages, """SELECT event_id, CAST(pos AS INTEGER) AS pos, CASE pos WHEN 1 THEN sha256('{"id":null}') ELSE
  sha256('{"extra":{"k":' || json_extract_string(props, '$.k') || '},"id":' || event_id || CASE WHEN event_id % 3 = 0 THEN ',"nota":null' ELSE '' END || ',"v":"' || value || '"}') END AS record_hash
  FROM events, (SELECT unnest([0, 1]) AS pos)"""),
    "fingerprint_raw": (fingerprint_raw, """SELECT event_id, sha256('camara_dadosabertos|proposicoes|{"id":' || user_id || '}') AS uid,
  sha256('{"id":' || user_id || CASE WHEN event_id % 2 = 0 THEN ',"opt":null' ELSE '' END || ',"props":{"k":' || json_extract_string(props, '$.k') || '}}') AS hash FROM events"""),
    "deputy_uid_nullable": (deputy_uid_nullable, """SELECT c_custkey, sha256('camara_dadosabertos|deputado|{"id":' || c_custkey || '}') AS deputy_uid FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 7 <> 0"""),
    "record_hash_diff": (record_hash_diff, twin("""SELECT CAST(coalesce(i.id, s.event_id) AS VARCHAR) AS id, CASE WHEN s.event_id IS NULL THEN 'new' WHEN i.id IS NULL THEN 'absent'
  WHEN i.uid = s.uid AND i.hash = s.hash THEN 'unchanged' ELSE 'changed' END AS change FROM items i FULL JOIN stored s ON i.id = s.event_id""", "items", "stored")),
    "payload_hash_documents": (payload_hash_documents, """SELECT doc_id, sha256('{"dados":[{"texto":' || to_json(text)::VARCHAR || '}],"links":[]}') AS payload_hash FROM documents"""),
    "canonical_hash_exact": (canonical_hash_exact, twin("""SELECT event_id, sha256('{"id":' || event_id || ',"props":{"k":' || k || '},"tipo":"' || event_type || '"}') AS record_hash FROM ev""", "ev")),
    "explode_pages": (explode_pages, twin("SELECT page, parent_id, CAST(pos AS INTEGER) AS pos, record_hash FROM recs", "recs")),
    "page_totals": (page_totals, """WITH p AS (SELECT source AS parent_id, doc_id, len(string_split(text, chr(10))) AS n FROM documents)
  SELECT parent_id, count(*) AS pages_written, CAST(sum(n) AS BIGINT) AS record_count, count(*) FILTER (doc_id % 4 <> 3) AS with_next,
  CAST(sum((doc_id % 7) * 100 + n) AS BIGINT) AS total_hint FROM p GROUP BY 1"""),
    "dotted_path": (dotted_path, "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k.x') AS k_x, json_extract_string(props, '$.a.b') AS a_b FROM events"),
    "message_scan": (message_scan, twin(f"""SELECT event_id, CASE WHEN {_MSG} THEN 'ceap' END AS domain, CASE WHEN {_MSG} THEN 'ceap_daily_' || ymd END AS pipeline_run_id,
  CASE WHEN {_MSG} THEN CAST(k AS VARCHAR) END AS k, CASE WHEN {_MSG} THEN 'snapshot' END AS run_type FROM ev""", "ev")),
    "messages_for_run": (messages_for_run, twin(f"SELECT event_id FROM ev WHERE {_MSG} AND ymd = '20240115'", "ev")),
    "list_fingerprints_lastwins": (list_fingerprints_lastwins, twin("""SELECT CAST(user_id AS VARCHAR) AS id, arg_max(sha256('camara_dadosabertos|proposicoes|{"id":' || user_id || '}'), (ts, event_id)) AS uid,
  arg_max(sha256('{"id":' || user_id || ',"situacao":"' || substr('FOP', k % 3 + 1, 1) || '"}'), (ts, event_id)) AS hash FROM ev GROUP BY 1""", "ev")),
    "distinct_ids": (distinct_ids, "SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events"),
    "enrich_pages": (enrich_pages, twin("""SELECT CAST(page AS INTEGER) AS page, 'eventos' AS domain, '/eventos/' || parent_id || '/deputados' AS api_path,
  'raw/camara/eventos/api/deputados/evento_id=' || parent_id || '/pipeline_run_id=eventos_daily_' || lang || '/execution_id=exec_1/page_' || page || '.json' AS raw_path,
  parent_id, 'evento' AS parent_entity, 'w0' AS window_start, 'eventos daily/' || lang AS run, CAST(count(*) AS INTEGER) AS records,
  arg_min(record_uid, pos) AS first_uid, arg_max(record_hash, pos) AS last_hash FROM recs GROUP BY page, parent_id, lang""", "recs")),
    "enrich_pages_received": (enrich_pages_received, twin("""SELECT CAST(page AS INTEGER) AS page, CAST(pos AS INTEGER) AS pos, record_uid,
  sha256('{"id":' || pos || ',"nome":' || to_json(line)::VARCHAR || ',"situacao":"S"}') AS record_hash FROM recs""", "recs")),
    "bronze_received": (bronze_received, twin("""SELECT 'raw/camara/eventos/api/deputados/evento_id=' || parent_id || '/pipeline_run_id=eventos_daily_' || lang || '/execution_id=e/page_' || page || '.json' AS _source_file,
  CAST(pos AS INTEGER) AS pos, sha256('{"id":' || pos || ',"nome":' || to_json(line)::VARCHAR || ',"situacao":"S"}') AS _record_hash, 'S' AS situacao, sha256(line) AS nome_sha256 FROM recs""", "recs")),
    "deputies_envelope": (deputies_envelope, """WITH c AS (SELECT CAST(c_custkey // 50 + 1 AS INTEGER) AS page, c_custkey AS id, '{"id":' || c_custkey || ',"nome":' || to_json(c_name)::VARCHAR || '}' AS j FROM customer)
  SELECT page, 'deputado' AS entity, '2024-01-15' AS reference_date, sha256('{"dados":[' || string_agg(j, ',') OVER (PARTITION BY page ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) || '],"links":[]}') AS payload_hash,
  id, sha256('camara_dadosabertos|deputado|{"id":' || id || '}') AS record_uid, sha256(j) AS record_hash FROM c"""),
    "ceap_envelope": (ceap_envelope, twin(f"""SELECT 'raw/camara/ceap/api/despesas/reference_year=' || ano || '/reference_month=' || lpad(CAST(mes AS VARCHAR), 2, '0') || '/pipeline_run_id=ceap_daily_'
  || replace(_loaded_at, '-', '') || '/execution_id=x1/deputado_id=' || id_deputado || '/page_' || parcela || '.json' AS raw_path, mes AS reference_month, {_UID} AS record_uid, {_PAYLOAD} AS payload_hash FROM expenses""", "expenses")),
    "bronze_records": (bronze_records, twin("""SELECT 'raw/camara/eventos/api/deputados/evento_id=' || parent_id || '/pipeline_run_id=eventos_daily_' || lang || '/execution_id=e/page_' || page || '.json' AS _source_file,
  'evento_deputados' AS _source_endpoint, '2024-01-20' AS _ingestion_date, 'eventos_daily_' || lang AS _pipeline_run_id, record_hash AS _record_hash, CAST(pos AS INTEGER) AS pos FROM recs WHERE lang <> 'de'""", "recs")),
    "snapshot_pages": (snapshot_pages, """WITH p AS (SELECT conv_id AS parent_id, turn + 1 AS page, length(text) > 600 AS failed, len(string_split(text, '. ')) AS n, turn % 3 <> 2 AS nxt FROM conversations),
  s AS (SELECT parent_id, min(page) FILTER (NOT nxt AND NOT failed) AS e, min(page) FILTER (failed) AS x FROM p GROUP BY 1),
  t AS (SELECT p.parent_id, count(*) AS pages_written, CAST(sum(n) AS BIGINT) AS record_count FROM p JOIN s USING (parent_id) WHERE page <= coalesce(e, 10000) AND (x IS NULL OR page < x) GROUP BY 1)
  SELECT s.parent_id, coalesce(pages_written, 0) AS pages_written, coalesce(record_count, 0) AS record_count,
  CASE WHEN x IS NOT NULL AND (e IS NULL OR x < e) THEN 'FAILED' ELSE 'COMPLETED' END AS final_status FROM s LEFT JOIN t USING (parent_id)"""),
    "count_window": (count_window, """SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, count(DISTINCT o_custkey) AS distinct_ids,
  CAST(max(dayofyear(o_orderdate)) AS INTEGER) AS pages_fetched, CASE WHEN max(dayofyear(o_orderdate)) >= 300 THEN 'max_list_pages_reached_during_count' END AS warning FROM orders GROUP BY 1"""),
    "parent_context": (parent_context, "SELECT event_id, CAST(user_id AS VARCHAR) AS parent_id, 'r' AS run, CAST(NULL AS VARCHAR) AS execution FROM events"),
}
