"""Queries over the curated layers: expenses, dimensions, views, attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tribuna.functions import hashing as H
from tribuna.functions import scalars as S
from tribuna.operators import layers as L
from tribuna.plans import stand_ins as ST
from tribuna.plans.stand_ins import twin
from tribuna.session import cut_lineage, read_table, work_path
from tribuna.sources import sinks


def _newest(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ST.expenses(spark, sf).select(
        *L.EXPENSE_KEY, "numDocumento", "tipoDespesa", "valorDocumento", "cnpjCpfFornecedor", "_loaded_at",
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    return L.dedup_latest(wanted, L.expense_key(), ST.newest_first())


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return L.silver_cast(_newest(spark, sf))


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return L.fact_expenses(_silver(spark, sf), ST.deputies(spark, sf))


def _amount(df: DataFrame, col: str = "total") -> DataFrame:
    """Exact decimal sums, shown as double at the very end."""
    return df.withColumn(col, F.col(col).cast("double"))


def gold_expenses_by_party_month(spark, sf):
    return _amount(L.expenses_by(_facts(spark, sf), "partido", "uf", "ano", "mes"))


def gold_expenses_by_deputy(spark, sf):
    return _amount(L.expenses_by(L.deputy_view(_facts(spark, sf)), "id_deputado", "nome", "ano"))


def gold_expenses_by_category(spark, sf):
    return _amount(L.expenses_by(_facts(spark, sf), "tipoDespesa", "ano", "mes"))


def gold_views(spark, sf):
    """Deputy-only and leadership views side by side, per year."""
    f = _facts(spark, sf).where(F.col("beneficiario").isin("DEPUTADO", "LIDERANCA"))
    return _amount(f.groupBy("beneficiario", "ano").agg(
        F.sum("valor").alias("total"), F.count(F.lit(1)).alias("documentos")))


def gold_dims(spark, sf):
    """Keys and attributes of the month, supplier, category, deputy, party and state dimensions."""
    silver = L.silver_cast(ST.expenses(spark, sf))
    month = L.dim_month(silver).select(F.lit("mes").alias("dim"), F.col("mes_id").cast("string").alias("chave"), F.col("trimestre").cast("string").alias("atributo"))
    supplier = L.dim_supplier(silver).select(F.lit("fornecedor").alias("dim"), F.col("documento").alias("chave"), F.concat_ws("|", "tipo_documento", "fornecedor_id").alias("atributo"))
    category = L.dim_category(silver).select(F.lit("categoria").alias("dim"), F.col("tipoDespesa").alias("chave"), F.col("categoria_id").alias("atributo"))
    deputy = L.dim_deputy(ST.deputies(spark, sf)).select(F.lit("deputado").alias("dim"), F.col("id_deputado").cast("string").alias("chave"), F.concat_ws("|", "partido", "uf", "deputado_uid").alias("atributo"))
    out = month.unionByName(supplier).unionByName(category).unionByName(deputy)
    for dim, col in (("partido", "partido"), ("uf", "uf")):
        rows = L.dim_attribute(ST.deputies(spark, sf), col)
        out = out.unionByName(rows.select(F.lit(dim).alias("dim"), F.col(col).alias("chave"), F.col("attribute_id").alias("atributo")))
    return out


_FACT_DIMS = ("documento", "tipoDespesa", "competencia", "partido", "uf")


def gold_fact_keys(spark, sf):
    """Facts with the keys of all their dimensions, from two loads: years up to 1994, then all.

    Keys given at the first load are read back from its dimension tables and kept.
    """
    facts = cut_lineage(_facts(spark, sf).select("id_deputado", "ano", "urlDocumento", "dataDocumento", "valor", *_FACT_DIMS))
    dims = {}
    for name in _FACT_DIMS:
        path = work_path(spark, f"dim-{name}")
        sinks.write_layer(L.dense_keys(facts.where(F.col("ano") <= 1994), name), path)
        known = spark.read.schema(f"{name} {facts.schema[name].dataType.simpleString()}, key bigint").parquet(path)
        dims[name] = L.dense_keys(facts, name, known)
    out = L.with_keys(facts, dims)
    return out.select("id_deputado", "urlDocumento", "dataDocumento", F.col("valor").cast("double").alias("valor"), F.col("documento_key").alias("fornecedor_key"),
                      F.col("tipoDespesa_key").alias("categoria_key"), F.col("competencia_key").alias("mes_key"), "partido_key", "uf_key")


def dedup_latest(spark, sf):
    return _newest(spark, sf).select("id_deputado", "ano", "mes", "urlDocumento", "valorDocumento", "_loaded_at", "l_partkey")


_HASHED = ["id_deputado", "codDocumento", "urlDocumento", "tipoDespesa", "cnpjCpfFornecedor"]


def dedup_hash(spark, sf):
    """One row per hash of the chosen columns."""
    return L.dedup_hash(ST.expenses(spark, sf), _HASHED).select("record_hash", "id_deputado", "urlDocumento")


def classify_beneficiary(spark, sf):
    d = ST.deputies(spark, sf)
    return d.select("id", "partido", L.classify(F.col("ide_cadastro"), F.col("nome")).alias("beneficiario"))


def normalize_doc(spark, sf):
    """Supplier documents written in several ways, brought to digits."""
    s = read_table(spark, sf, "supplier")
    key = F.col("s_suppkey").cast("string")
    raw = (
        F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("12.345."), F.lpad(key, 6, "0"), F.lit("/0001")))
        .when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("123.456."), F.lpad(key, 5, "0"), F.lit("-")))
        .when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit("9999999999"), F.lpad(key, 6, "0")))
    )
    doc = S.normalize_document(raw)
    return s.select("s_suppkey", doc.alias("documento"), S.document_kind(doc).alias("tipo"))


def _flawed(spark, sf) -> DataFrame:
    """Expenses with flaws planted by value: text amounts, month 13, dates out of range."""
    e = ST.expenses(spark, sf)
    return e.withColumns({
        "valorDocumento": F.when(F.col("l_partkey") % 50 == 0, F.lit("n/d")).otherwise(F.col("valorDocumento")),
        "mes": F.when(F.col("l_partkey") % 41 == 0, F.lit(13)).otherwise(F.col("mes")),
        "dataDocumento": F.when(F.col("l_partkey") % 37 == 0, F.lit("1998-13-45")).otherwise(F.col("dataDocumento")),
        "cnpjCpfFornecedor": F.when(F.col("l_partkey") % 31 == 0, F.lit("-")).otherwise(F.col("cnpjCpfFornecedor")),
    })


def quarantine(spark, sf):
    """Valid and quarantined rows by violated rules."""
    rules = F.array_join("violations", ",")
    side = F.when(F.size("violations") == 0, F.lit("valid")).otherwise(F.lit("quarantine"))
    return L.check_quality(_flawed(spark, sf)).groupBy(side.alias("lado"), rules.alias("regras")).agg(F.count(F.lit(1)).alias("linhas"))


def silver_typed(spark, sf):
    """Typed columns of the flawed expenses: totals and nulls per category."""
    s = L.silver_cast(_flawed(spark, sf))
    return _amount(s.groupBy("tipoDespesa").agg(
        F.sum("valor").alias("total"), F.count_if(F.col("valor").isNull()).alias("sem_valor"),
        F.count_if(F.col("data_emissao").isNull()).alias("sem_data"),
        F.count_if(F.col("competencia").isNull()).alias("sem_competencia"),
        F.count_if(F.col("documento").isNull()).alias("sem_documento"),
        F.min("data_emissao").cast("string").alias("primeira"), F.max("data_emissao").cast("string").alias("ultima"),
    ))


def events_calendar(spark, sf):
    e = read_table(spark, sf, "events").withColumn("dia", ST.day_text(F.col("ts")))
    out = L.events_calendar(e, "dia", "event_type")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return out.select("dia", F.col("event_type").alias("orgao"), "eventos",
                      F.date_format("inicio", fmt).alias("inicio"), F.date_format("fim", fmt).alias("fim"))


def attendance(spark, sf):
    """Sessions are days with an error or purchase; a view or click that day is presence.

    Who was expected: everyone with any entry that day.
    """
    e = read_table(spark, sf, "events").select(ST.day_text(F.col("ts")).alias("dia"), "user_id", "event_type")
    expected = e.select("dia", "user_id").distinct()
    present = e.where(F.col("event_type").isin("view", "click"))
    out = L.attendance(expected, present, ["dia"], "user_id")
    return out.withColumn("taxa_presenca", F.col("taxa_presenca").cast("double"))


_BY = "SELECT {d}, CAST(sum(valor) AS DOUBLE) AS total, count(*) AS documentos FROM facts WHERE beneficiario <> 'LIDERANCA' {w} GROUP BY ALL"
_FLAWED = """, flawed AS (SELECT * EXCLUDE (valorDocumento, mes, dataDocumento, cnpjCpfFornecedor),
  CASE WHEN l_partkey % 50 = 0 THEN 'n/d' ELSE valorDocumento END AS valorDocumento, CASE WHEN l_partkey % 41 = 0 THEN 13 ELSE mes END AS mes,
  CASE WHEN l_partkey % 37 = 0 THEN '1998-13-45' ELSE dataDocumento END AS dataDocumento,
  CASE WHEN l_partkey % 31 = 0 THEN '-' ELSE cnpjCpfFornecedor END AS cnpjCpfFornecedor FROM expenses)
"""


def _flawed_twin(select: str) -> str:
    return twin("", "expenses").rstrip() + _FLAWED + select


QUERIES = {
    "gold_expenses_by_party_month": (gold_expenses_by_party_month, twin(_BY.format(d="partido, uf, ano, mes", w=""), "facts")),
    "gold_expenses_by_deputy": (gold_expenses_by_deputy, twin(_BY.format(d="id_deputado, nome, ano", w="AND beneficiario = 'DEPUTADO'"), "facts")),
    "gold_expenses_by_category": (gold_expenses_by_category, twin(_BY.format(d="tipoDespesa, ano, mes", w=""), "facts")),
    "gold_views": (gold_views, twin(
        "SELECT beneficiario, ano, CAST(sum(valor) AS DOUBLE) AS total, count(*) AS documentos FROM facts WHERE beneficiario IN ('DEPUTADO', 'LIDERANCA') GROUP BY ALL", "facts")),
    "gold_dims": (gold_dims, twin("""SELECT DISTINCT 'mes' AS dim, CAST(ano * 100 + mes AS VARCHAR) AS chave, CAST((mes + 2) // 3 AS VARCHAR) AS atributo FROM expenses
UNION ALL SELECT DISTINCT 'fornecedor', cnpjCpfFornecedor, 'CNPJ|' || sha256(cnpjCpfFornecedor) FROM expenses
UNION ALL SELECT DISTINCT 'categoria', tipoDespesa, sha256(tipoDespesa) FROM expenses
UNION ALL SELECT DISTINCT 'deputado', CAST(id AS VARCHAR), partido || '|' || uf || '|' || sha256('camara_dadosabertos|deputado|{"id":' || id || '}') FROM deputies
UNION ALL SELECT DISTINCT 'partido', partido, sha256(partido) FROM deputies UNION ALL SELECT DISTINCT 'uf', uf, sha256(uf) FROM deputies""", "expenses", "deputies")),
    "gold_fact_keys": (gold_fact_keys, twin("""SELECT id_deputado, urlDocumento, dataDocumento, CAST(valor AS DOUBLE) AS valor, fornecedor_key, categoria_key, mes_key, partido_key, uf_key FROM facts
  JOIN (SELECT d, row_number() OVER (ORDER BY late, d) AS fornecedor_key FROM (SELECT cnpjCpfFornecedor AS d, min(ano) > 1994 AS late FROM facts GROUP BY 1)) f ON f.d = cnpjCpfFornecedor
  JOIN (SELECT c, row_number() OVER (ORDER BY late, c) AS categoria_key FROM (SELECT tipoDespesa AS c, min(ano) > 1994 AS late FROM facts GROUP BY 1)) g ON g.c = tipoDespesa
  JOIN (SELECT m, row_number() OVER (ORDER BY late, m) AS mes_key FROM (SELECT ano * 100 + mes AS m, min(ano) > 1994 AS late FROM facts GROUP BY 1)) h ON h.m = ano * 100 + mes
  LEFT JOIN (SELECT p, row_number() OVER (ORDER BY late, p) AS partido_key FROM (SELECT partido AS p, min(ano) > 1994 AS late FROM facts WHERE partido IS NOT NULL GROUP BY 1)) i ON i.p = partido
  LEFT JOIN (SELECT u, row_number() OVER (ORDER BY late, u) AS uf_key FROM (SELECT uf AS u, min(ano) > 1994 AS late FROM facts WHERE uf IS NOT NULL GROUP BY 1)) j ON j.u = uf""", "facts")),
    "dedup_latest": (dedup_latest, twin("SELECT id_deputado, ano, mes, urlDocumento, valorDocumento, _loaded_at, l_partkey FROM latest", "latest")),
    "dedup_hash": (dedup_hash, twin("""SELECT DISTINCT sha256('{"cnpjCpfFornecedor":"' || cnpjCpfFornecedor || '","codDocumento":' || codDocumento || ',"id_deputado":' || id_deputado
  || ',"tipoDespesa":"' || tipoDespesa || '","urlDocumento":"' || urlDocumento || '"}') AS record_hash, id_deputado, urlDocumento FROM expenses""", "expenses")),
    "classify_beneficiary": (classify_beneficiary, twin("""SELECT id, partido, CASE WHEN ide_cadastro IS NOT NULL THEN 'DEPUTADO'
  WHEN nome LIKE 'LID.%' THEN 'LIDERANCA' ELSE 'OUTROS' END AS beneficiario FROM deputies""", "deputies")),
    "normalize_doc": (normalize_doc, """WITH r AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '12345' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') || '0001'
  WHEN 1 THEN '123456' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') WHEN 2 THEN '9999999999' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') ELSE '' END AS d FROM supplier),
  n AS (SELECT s_suppkey, CASE WHEN length(d) BETWEEN 1 AND 11 THEN lpad(d, 11, '0') WHEN length(d) BETWEEN 12 AND 14 THEN lpad(d, 14, '0') END AS documento FROM r)
  SELECT s_suppkey, documento, CASE length(documento) WHEN 11 THEN 'CPF' WHEN 14 THEN 'CNPJ' END AS tipo FROM n"""),
    "quarantine": (quarantine, _flawed_twin("""SELECT CASE WHEN regras = '' THEN 'valid' ELSE 'quarantine' END AS lado, regras, count(*) AS linhas FROM (
  SELECT concat_ws(',', CASE WHEN valorDocumento = 'n/d' THEN 'bad_value' END, CASE WHEN dataDocumento = '1998-13-45' THEN 'bad_date' END,
  CASE WHEN mes = 13 THEN 'bad_month' END, CASE WHEN cnpjCpfFornecedor = '-' THEN 'bad_supplier' END) AS regras FROM flawed) GROUP BY ALL""")),
    "silver_typed": (silver_typed, _flawed_twin("""SELECT tipoDespesa, CAST(sum(TRY_CAST(valorDocumento AS DECIMAL(18,2))) AS DOUBLE) AS total,
  count(*) FILTER (valorDocumento = 'n/d') AS sem_valor, count(*) FILTER (dataDocumento = '1998-13-45') AS sem_data, count(*) FILTER (mes = 13) AS sem_competencia,
  count(*) FILTER (cnpjCpfFornecedor = '-') AS sem_documento, min(nullif(dataDocumento, '1998-13-45')) AS primeira, max(nullif(dataDocumento, '1998-13-45')) AS ultima FROM flawed GROUP BY ALL""")),
    "events_calendar": (events_calendar, """SELECT strftime(ts, '%Y-%m-%d') AS dia, event_type AS orgao, count(*) AS eventos,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS inicio, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS fim FROM events GROUP BY 1, 2"""),
    "attendance": (attendance, """WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS dia, user_id, bool_or(event_type IN ('view', 'click')) AS p FROM events GROUP BY 1, 2)
  SELECT user_id, count(*) AS sessoes, count(*) FILTER (p) AS presencas, count(*) FILTER (NOT p) AS ausencias,
  round(count(*) FILTER (p) / CAST(count(*) AS DOUBLE), 6) AS taxa_presenca FROM e GROUP BY 1"""),
}
