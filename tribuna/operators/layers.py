"""Bronze, Silver and Gold: technical columns, de-duplication, typing, facts, views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tribuna.functions import hashing as H
from tribuna.functions import scalars as S
from tribuna.operators.budget import with_ordinal
from tribuna.operators.envelope import aligned, each_item

# Business key of an expense in the Silver layer.
EXPENSE_KEY = ("id_deputado", "ano", "mes", "codDocumento", "dataDocumento", "urlDocumento")
MONEY = "decimal(18,2)"


# -- Bronze ---------------------------------------------------------------

def bronze(pages: DataFrame, valid_runs: DataFrame | None = None, raw: str | None = None) -> DataFrame:
    """Exploded records with the technical columns, from valid runs only.

    ``pages`` are audited pages; ``valid_runs`` (``pipeline_run_id``) enters as
    a left semi join, so pages of other runs are dropped before the explode.
    ``raw`` names the page's text as received: each record then carries its own
    part of it as ``_received``, with the fields that no schema declares.
    """
    if valid_runs is not None:
        runs = valid_runs.select(F.col("pipeline_run_id").alias("_valid")).distinct()
        pages = pages.join(runs, F.col("_audit._pipeline_run_id") == F.col("_valid"), "left_semi")
    if raw is None:
        own, exploded = [], each_item(pages, F.col("dados"), "_audit")
    else:  # each record is paired with its own text first, so that no row carries the whole page
        texts = aligned(H.raw_items(F.col(raw)), F.col("dados"))
        pairs = F.zip_with("dados", texts, lambda x, t: F.struct(x.alias("item"), t.alias("text")))
        exploded = each_item(pages, pairs, "_audit").select("_audit", "pos", F.col("item.item").alias("item"), F.col("item.text").alias("_received"))
        own = ["_received"]
    return exploded.select(
        *own,
        F.col("_audit._raw_path").alias("_source_file"),
        F.col("_audit._source_endpoint").alias("_source_endpoint"),
        F.substring("_audit._ingested_at_utc", 1, 10).alias("_ingestion_date"),
        F.col("_audit._pipeline_run_id").alias("_pipeline_run_id"),
        F.col("_audit._execution_id").alias("_execution_id"),
        F.col("_audit._loaded_at").alias("_loaded_at"),
        F.col("_audit._payload_hash").alias("_payload_hash"),
        F.col("item._record_hash").alias("_record_hash"),
        "pos", "item",
    )


# -- Silver ---------------------------------------------------------------

def dedup_latest(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """One row per key: the one that sorts first by ``order`` (see :func:`newest`).

    An aggregate rather than a window: copies are combined on the map side
    wherever the shuffle falls, also when adaptive execution has to split a hot
    join below it.  Select the columns you need first, as the rows travel whole.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    # Keys and sort values are computed once per row, ahead of the aggregate that compares them.
    ready = df.select(
        *[k.alias(n) for k, n in zip(keys, names)], F.struct(*df.columns).alias("_row"),
        F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("_order"),
    )
    return ready.groupBy(*names).agg(F.min_by("_row", "_order").alias("_best")).select("_best.*")


def newest(loaded_at: Column) -> Column:
    """Sort key that puts the latest ISO load time first; times that do not parse go last."""
    return F.coalesce(-F.unix_micros(F.try_to_timestamp(loaded_at)), F.lit(2**62))


def expense_key() -> list[Column]:
    return [*[F.col(c) for c in EXPENSE_KEY], F.coalesce("numDocumento", F.lit(""))]


def dedup_hash(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per record hash; the hash is added when the rows lack it.

    Rows with equal hashes are equal in ``columns``, so keeping the columns and
    the hash only makes the choice among copies immaterial.
    """
    if columns:
        df = df.select(*columns, H.sha256(H.canonical_struct({c: F.col(c) for c in columns})).alias("record_hash"))
    return df.dropDuplicates(["record_hash"])


def silver_cast(df: DataFrame) -> DataFrame:
    """Typed expense columns; what does not parse becomes null and is left to the quality rules."""
    return df.withColumns({
        "valor": F.col("valorDocumento").try_cast(MONEY),
        "data_emissao": S.iso_date(F.col("dataDocumento")),
        "competencia": F.when(
            F.col("mes").between(1, 12), F.make_date(F.col("ano").cast("int"), F.col("mes").cast("int"), F.lit(1))
        ),
        "documento": S.normalize_document(F.col("cnpjCpfFornecedor")),
    })


def classify(ide_cadastro: Column, nome: Column) -> Column:
    """Beneficiary: a deputy, a party leadership (``LID.`` names), or other."""
    return (
        F.when(ide_cadastro.isNotNull(), F.lit("DEPUTADO"))
        .when(F.coalesce(nome, F.lit("")).startswith("LID."), F.lit("LIDERANCA"))
        .otherwise(F.lit("OUTROS"))
    )


def silver_from_csv(rows: DataFrame) -> DataFrame:
    """Annual-file rows: emission date is the analytic date, year and month the competency.

    ``nuDeputadoId`` stays as the technical id; beneficiaries are classified
    from the file's own columns.
    """
    month = F.col("numMes").between(1, 12)
    return rows.withColumns({
        "data_emissao": S.iso_date(F.col("datEmissao")),
        "competencia": F.when(month, F.make_date("numAno", "numMes", F.lit(1))),
        "beneficiario": classify(F.col("ideCadastro"), F.col("txNomeParlamentar")),
    })


def quality_rule(columns: dict[str, Column]) -> Column:
    """Names of the violated rules of a row; ``columns`` maps rule name to its failure test."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in columns.items()]))


EXPENSE_RULES = {
    "missing_document": lambda: F.col("codDocumento").isNull(),
    "bad_value": lambda: F.col("valorDocumento").try_cast(MONEY).isNull(),
    "bad_date": lambda: S.iso_date(F.col("dataDocumento")).isNull(),
    "bad_month": lambda: ~F.coalesce(F.col("mes").between(1, 12), F.lit(False)),
    "bad_supplier": lambda: S.normalize_document(F.col("cnpjCpfFornecedor")).isNull(),
}


def check_quality(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """Adds ``violations``, the names of the rules a row breaks."""
    return df.withColumn("violations", quality_rule({n: t() for n, t in (rules or EXPENSE_RULES).items()}))


def split_valid(df: DataFrame, rules: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows (with the rules they break); nothing is dropped."""
    checked = check_quality(df, rules)
    good = checked.where(F.size("violations") == 0).drop("violations")
    return good, checked.where(F.size("violations") > 0)


# -- Gold -----------------------------------------------------------------

def dim_month(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("competencia").isNotNull()).select(
        F.date_format("competencia", "yyyyMM").cast("int").alias("mes_id"),
        F.year("competencia").alias("ano"), F.month("competencia").alias("mes"),
        F.quarter("competencia").alias("trimestre"),
    ).distinct()


def dim_supplier(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("documento").isNotNull()).select(
        "documento", S.document_kind(F.col("documento")).alias("tipo_documento"),
    ).distinct().withColumn("fornecedor_id", H.sha256(F.col("documento")))


def dim_category(silver: DataFrame) -> DataFrame:
    return silver.select("tipoDespesa").distinct().withColumn("categoria_id", H.sha256(F.col("tipoDespesa")))


def dim_attribute(deputies: DataFrame, column: str) -> DataFrame:
    """Party or state dimension: the distinct values with their ids."""
    return deputies.where(F.col(column).isNotNull()).select(column).distinct().withColumn(
        "attribute_id", H.sha256(F.col(column))
    )


def dim_deputy(deputies: DataFrame) -> DataFrame:
    """Deputies with party and state, keyed by the deputy UID."""
    return deputies.select(
        F.col("id").cast("bigint").alias("id_deputado"), "nome", "partido", "uf",
        H.deputy_record_uid(F.col("id")).alias("deputado_uid"),
    ).distinct()


def fact_expenses(silver: DataFrame, deputies: DataFrame) -> DataFrame:
    """Expense facts joined to the deputy attributes on the technical id.

    The deputy side is unique on the key; its size decides broadcast or merge
    join at run time, and a hot deputy is split by the skew-join rule.
    """
    d = deputies.select(
        F.col("id").cast("bigint").alias("id_deputado"), "nome", "partido", "uf", "ide_cadastro"
    )
    facts = silver.join(d, "id_deputado", "left")
    return facts.withColumn("beneficiario", classify(F.col("ide_cadastro"), F.col("nome")))


def dense_keys(values: DataFrame, name: str, known: DataFrame | None = None, key: str = "key") -> DataFrame:
    """Dense whole-number keys, from 1, for the distinct values of a natural key; ``name, key``.

    Keys in ``known`` (``name, key``) stay for good; new values go on after its
    largest, in their own order.  New values are placed by ranges, counted per
    range and numbered inside it, so no task numbers them all.
    """
    new = values.where(F.col(name).isNotNull()).select(name).distinct()
    first = F.lit(1)
    if known is not None:
        new = new.join(known.select(name), name, "left_anti")
        first = F.coalesce(known.agg(F.max(key).alias("top")).scalar(), F.lit(0)) + 1
    numbered = with_ordinal(new, [name], key).select(name, (F.col(key) + first).cast("bigint").alias(key))
    return numbered if known is None else known.select(name, key).unionByName(numbered)


def with_keys(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Facts with ``<name>_key`` for each dimension ``{name: (name, key)}``; null where the natural key is.

    A dimension is unique on its natural key, so facts never multiply; its size
    decides broadcast or merge join at run time, and hot values are split.
    """
    for name, dim in dims.items():
        facts = facts.join(dim.select(name, F.col("key").alias(f"{name}_key")), name, "left")
    return facts


def deputy_view(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("beneficiario") == "DEPUTADO")


def leadership_view(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("beneficiario") == "LIDERANCA")


def expenses_by(facts: DataFrame, *dims: str) -> DataFrame:
    """Core indicators; leadership spending is left out here and only here."""
    return facts.where(F.col("beneficiario") != "LIDERANCA").groupBy(*dims).agg(
        F.sum("valor").alias("total"), F.count(F.lit(1)).alias("documentos"),
    )


def events_calendar(events: DataFrame, day: str, organ: str) -> DataFrame:
    return events.groupBy(day, organ).agg(
        F.count(F.lit(1)).alias("eventos"), F.min("ts").alias("inicio"), F.max("ts").alias("fim"),
    )


def attendance(expected: DataFrame, present: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Sessions expected, attended and missed per member.

    Presence is reduced to distinct (session, member) pairs before the join, so
    repeated entries never multiply and a busy session stays one row per member.
    """
    seen = present.select(*keys, member).distinct().withColumn("_in", F.lit(1))
    joined = expected.join(seen, [*keys, member], "left")
    got = F.count("_in")
    total = F.count(F.lit(1))
    return joined.groupBy(member).agg(
        total.alias("sessoes"), got.alias("presencas"), (total - got).alias("ausencias"),
    ).withColumn("taxa_presenca", (F.col("presencas") / F.col("sessoes")).cast("decimal(9,6)"))


def microbatch_sla(windows: DataFrame, runs: DataFrame, granularity_min: int) -> DataFrame:
    """Per day: expected windows, windows without a run, and delay from window end to completion.

    ``windows`` is the schedule (``window_start``); ``runs`` one row per window
    with ``completed_at``.
    """
    joined = windows.join(runs.select("window_start", "completed_at"), "window_start", "left")
    end = F.unix_micros(F.col("window_start").cast("timestamp")) + granularity_min * 60_000_000
    delay = F.greatest(
        F.floor((F.unix_micros(F.col("completed_at").cast("timestamp")) - end) / 1_000_000), F.lit(0)
    )
    return joined.groupBy(F.date_format("window_start", "yyyy-MM-dd").alias("dia")).agg(
        F.count(F.lit(1)).alias("janelas"),
        F.count_if(F.col("completed_at").isNull()).alias("janelas_perdidas"),
        F.max(delay).cast("bigint").alias("atraso_max_s"),
        F.sum(delay).cast("bigint").alias("atraso_total_s"),
    )


def schedule(bounds: DataFrame, granularity_min: int) -> DataFrame:
    """Every window start between two times (one row with ``lo`` and ``hi``).

    Stretches of about a day first, then the windows of each, so no row holds the whole schedule.
    """
    per_day = -(-1440 // granularity_min)
    mins = lambda n: F.make_dt_interval(mins=F.lit(n))
    days = bounds.select("hi", F.explode(F.sequence("lo", "hi", mins(per_day * granularity_min))).alias("day"))
    last = F.least(F.col("hi"), F.col("day") + mins((per_day - 1) * granularity_min))
    return days.select(F.explode(F.sequence("day", last, mins(granularity_min))).alias("window_start"))
