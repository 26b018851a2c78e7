"""Audit envelope: explode, strip, enrich pages, and cut page sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tribuna import catalog
from tribuna.functions import hashing as H
from tribuna.functions import scalars as S

RAW_ROOT = "raw/camara"
LINEAGE = ("_record_uid", "_record_hash")


def explode_records(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per record with its position; pages without records keep one null row."""
    return pages.select(*keep, F.posexplode_outer("dados").alias("pos", "item"))


def each_item(pages: DataFrame, items: Column, *keep: Column | str) -> DataFrame:
    """One row per item with its position, for arrays that are dear to work out.

    A plain ``posexplode`` lets the optimizer derive a filter on the array's size, which works the whole array out once more.
    """
    return pages.select(*keep, F.posexplode_outer(items).alias("pos", "item")).where(F.col("pos").isNotNull())


def strip_audit(pages: DataFrame) -> DataFrame:
    """Page without ``_audit`` and items without lineage fields."""
    out = pages.drop("_audit")
    item = out.schema["dados"].dataType.elementType
    present = [n for n in LINEAGE if n in item.fieldNames()]
    if present:
        out = out.withColumn("dados", F.transform("dados", lambda x: x.dropFields(*present)))
    return out


def aligned(texts: Column, items: Column) -> Column:
    """As many texts as there are items at most, none where there is no array."""
    return F.coalesce(F.slice(texts, F.lit(1), F.greatest(F.size(items), F.lit(0))), F.array().cast("array<string>"))


def page_totals(pages: DataFrame, *keys: str) -> DataFrame:
    """Pages written and records collected per key."""
    return pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pages_written"),
        F.sum(F.greatest(F.size(F.coalesce("dados", F.array())), F.lit(0))).cast("bigint").alias("record_count"),
    )


def raw_path(layout: str, endpoint: str) -> Column:
    """Logical page path of an endpoint; run and execution ids are made path-safe."""
    spec = catalog.endpoint(endpoint)
    tail = [
        F.lit("/pipeline_run_id="), S.safe_segment(F.col("pipeline_run_id")),
        F.lit("/execution_id="), S.safe_segment(F.col("execution_id")),
    ]
    file = [F.lit("/page_"), F.col("page").cast("string"), F.lit(".json")]
    head = F.lit(f"{RAW_ROOT}/{spec.raw_prefix}")
    if layout == "ceap":
        return F.concat(
            head, F.lit("/reference_year="), F.col("ano").cast("string"),
            F.lit("/reference_month="), F.lpad(F.col("mes").cast("string"), 2, "0"),
            *tail, F.lit("/deputado_id="), F.col("id_deputado").cast("string"), *file,
        )
    if layout == "dated":
        return F.concat(head, F.lit("/reference_date="), F.col("reference_date"), *tail, *file)
    part, _ = catalog.PARENT_PARTITION[endpoint]
    return F.concat(head, F.lit(f"/{part}="), F.col("parent_id").cast("string"), *tail, *file)


def _audit_core(endpoint: str, domain: str, entity: str, api_path: Column) -> dict[str, Column]:
    return {
        "_metadata_version": F.lit(catalog.METADATA_VERSION),
        "_pipeline_run_id": F.col("pipeline_run_id"),
        "_execution_id": F.col("execution_id"),
        "_source_system": F.lit(catalog.SOURCE_SYSTEM),
        "_source_endpoint": F.lit(endpoint),
        "_api_base_url": F.lit(catalog.API_BASE_URL),
        "_api_path": api_path,
        "_entity": F.lit(entity),
        "_domain": F.lit(domain),
        "_page": F.col("page").cast("int"),
        "_raw_path": F.col("raw_path"),
        "_ingested_at_utc": F.col("ingested_at"),
        "_loaded_at": F.col("ingested_at"),
        "_payload_hash": F.col("_payload_hash"),
    }


def _as_struct(fields: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def audit_ceap() -> Column:
    """Expense form: year, month and deputy."""
    core = _audit_core("deputado_despesas", "ceap", "deputado_despesas", F.lit("/deputados/{id}/despesas"))
    return _as_struct(core | {
        "_reference_year": F.col("ano").cast("int"),
        "_reference_month": F.col("mes").cast("int"),
        "_deputado_id": F.col("id_deputado").cast("bigint"),
    })


def audit_deputies() -> Column:
    """Deputies-list form: reference date."""
    core = _audit_core("deputado", "deputados", "deputado", F.lit("/deputados"))
    return _as_struct(core | {"_reference_date": F.col("reference_date")})


def audit_generic(endpoint: str, columns: list[str], extra: dict[str, Column] | None = None) -> Column:
    """Generic form; parent and date fields when the page has them, extras never override."""
    spec = catalog.endpoint(endpoint)
    path = F.lit(spec.path)
    fields: dict[str, Column] = {}
    if "parent_id" in columns:
        path = F.replace(path, F.lit("{id}"), F.col("parent_id").cast("string"))
        fields["_parent_id"] = F.col("parent_id").cast("string")
        tag = catalog.PARENT_PARTITION.get(endpoint, (None, None))[1]
        if tag:
            fields["_parent_entity"] = F.lit(tag)
    if "reference_date" in columns:
        fields["_reference_date"] = F.when(F.col("reference_date") != "", F.col("reference_date"))
    fields = _audit_core(endpoint, spec.domain, spec.name, path) | fields
    return _as_struct((extra or {}) | fields)


def enrich_pages(
    pages: DataFrame, endpoint: str, layout: str = "parent", extra: dict[str, Column] | None = None,
    raw: str | None = None,
) -> DataFrame:
    """Audited pages: payload hash, audit block, record UIDs and hashes.

    One projection without a shuffle.  ``pages`` has ``pipeline_run_id``,
    ``execution_id``, ``page``, ``ingested_at``, typed ``dados`` (and ``links``)
    plus the layout's columns.  With ``raw`` the hashes are taken over that
    JSON text; otherwise over the typed record inside the JVM.
    """
    out = strip_audit(pages)
    item = out.schema["dados"].dataType.elementType
    spec = catalog.endpoint(endpoint)
    if raw:
        payload = H.payload_hash(F.col(raw))
    else:
        named = [n for n in ("dados", "links") if n in out.columns]
        payload = H.sha256(H.canonical_struct({n: H.normal_form(F.col(n), out.schema[n].dataType) for n in named}))
    out = out.withColumn("raw_path", raw_path(layout, endpoint)).withColumn("_payload_hash", payload)

    if layout == "ceap":
        audit = audit_ceap()
        amount = item["valorDocumento"].dataType
        uid = lambda x: H.ceap_record_uid(x, F.col("id_deputado"), F.col("ano"), F.col("mes"), amount)
    elif endpoint == "deputados" and layout == "dated" and not extra:
        audit = audit_deputies()
        uid = lambda x: H.deputy_record_uid(x.getField("id"))
    else:
        audit = audit_generic(endpoint, out.columns, extra)
        uid = lambda x: H.endpoint_record_uid(x, spec.name, spec.business_keys)

    def lineage(x: Column) -> Column:
        return x.withField("_record_uid", uid(x)).withField("_record_hash", H.record_hash(x, item))

    if raw:
        # Hashes of the records as received, in the page's order; the parsed columns are for reading.  Both arrays are
        # arguments of one function: a column named inside of a lambda is worked out anew for every record.
        out = H.with_canonical_items(out, raw, "_canonical")
        texts = aligned(F.col("_canonical"), F.col("dados"))
        stamp = lambda x, t: x.withField("_record_uid", uid(x)).withField("_record_hash", H.sha256(t))
        return out.withColumn("_audit", audit).withColumn("dados", F.zip_with("dados", texts, stamp)).drop("_canonical")
    return out.withColumn("_audit", audit).withColumn("dados", F.transform("dados", lineage))


def _with_stops(pages: DataFrame, keys: list[str], max_pages: int | None) -> DataFrame:
    """Pages with ``_written`` (the page belongs to the snapshot) and ``_failed`` (the snapshot failed).

    A snapshot ends at the first page without ``next``; a failed fetch before
    that ends it early.  Both pages are found by an aggregate with map-side
    combine and joined back, so page bodies are never gathered per parent.
    ``failed`` (boolean, optional) marks a page whose fetch failed.
    """
    flagged = pages if "failed" in pages.columns else pages.withColumn("failed", F.lit(False))
    last = ~S.has_next(F.col("links")) & ~F.col("failed")
    stops = flagged.groupBy(*keys).agg(
        F.min(F.when(last, F.col("page"))).alias("_end"),
        F.min(F.when(F.col("failed"), F.col("page"))).alias("_error"),
    )
    end = F.least("_end", F.lit(max_pages))  # null: no end, and all pages belong
    broken = F.col("_error").isNotNull() & (F.col("_end").isNull() | (F.col("_error") < F.col("_end")))
    return flagged.join(stops, keys).withColumns({
        "_written": (end.isNull() | (F.col("page") <= end)) & (F.col("_error").isNull() | (F.col("page") < F.col("_error"))),
        "_failed": broken,
    })


def snapshot_pages(pages: DataFrame, keys: list[str], max_pages: int | None = None) -> DataFrame:
    """Pages of each snapshot, up to its end or before its first failed fetch; ``max_pages`` sets a limit, by default there is none."""
    return _with_stops(pages, keys, max_pages).where("_written").select(*pages.columns)


def snapshot_results(pages: DataFrame, keys: list[str], max_pages: int | None = None) -> DataFrame:
    """Per parent: pages and records written, and COMPLETED or FAILED with the counts so far."""
    items = F.when(F.col("_written"), F.col("_items")).otherwise(F.lit(0))
    slim = pages.withColumn("_items", F.greatest(F.size(F.coalesce("dados", F.array())), F.lit(0))).drop("dados")
    return _with_stops(slim, keys, max_pages).groupBy(*keys).agg(
        F.count_if("_written").alias("pages_written"),
        F.sum(items).cast("bigint").alias("record_count"),
        F.when(F.bool_or("_failed"), F.lit("FAILED")).otherwise(F.lit("COMPLETED")).alias("final_status"),
    )


def attach_parent(records: DataFrame, path: str, part: str) -> DataFrame:
    """Parent id for records that do not carry it, from the path segment."""
    return records.withColumn("parent_id", S.path_value(F.col(path), part))
