"""Daily health summary: run inspection, domain and day rollups, warnings as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tribuna import catalog
from tribuna.functions import scalars as S
from tribuna.functions import windows as W

IN_PROGRESS = ("RUNNING", "QUEUED", "QUEUING")
WARNING_KINDS = (
    "metadata_not_found", "success_marker_missing", "success_marker_exists_but_status_not_completed",
    "task_counts_inconsistent", "ingestion_control_differs_from_raw_metadata", "domain_not_implemented",
)
# Domains whose empty collection yields no placeholder row; they still roll up to NOT_FOUND.
NO_PLACEHOLDER = ("ceap", "reference", "votacoes", "institucional")


def ceap_candidates(days: DataFrame, now_utc: Column, day: str = "reference_date") -> DataFrame:
    """Run ids a day's expense runs may have: local and UTC date, daily and reconciliation.

    The reconciliation ids are expected only where the local date is a Sunday.
    """
    local, utc = F.date_format(day, "yyyyMMdd"), F.date_format(now_utc, "yyyyMMdd")
    ids = F.array(
        F.concat(F.lit("ceap_daily_"), local), F.concat(F.lit("ceap_reconciliation_"), local),
        F.concat(F.lit("ceap_daily_"), utc), F.concat(F.lit("ceap_reconciliation_"), utc),
    )
    keep = F.filter(
        F.array_distinct(ids),
        lambda i: i.contains("_daily_") | (W.ceap_mode(F.col(day)) == "reconciliation"),
    )
    return days.select(day, F.posexplode(keep).alias("ordinal", "pipeline_run_id"))


def dedup_runs(runs: DataFrame, keys: list[str], ordinal: str = "ordinal") -> DataFrame:
    """First collected row per run id."""
    w = Window.partitionBy(*keys).orderBy(ordinal)
    return runs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def collect_runs(*collections: DataFrame) -> DataFrame:
    """Union of the domains' inspections; columns a domain lacks are null."""
    out = collections[0]
    for c in collections[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def inspect_runs(expected: DataFrame, manifests: DataFrame, markers: DataFrame, runs: DataFrame) -> DataFrame:
    """Derived status and warnings of every expected run.

    Three left equi-joins (manifest, marker, control row), all on unique keys.
    ``expected`` has ``domain``, ``pipeline_run_id`` and the manifest key
    columns; warnings are an array of ``(warning_type, message)``.
    """
    joined = join_markers(expected.join(
        manifests.withColumn("_found", F.lit(True)), ["domain", "pipeline_run_id"], "left"), markers)
    joined = join_control(joined, runs)
    found = F.col("_found").isNotNull()
    st = S.normalize_status(F.col("status"))
    n = {k: S.int_or_zero(F.col(f"total_tasks_{k}").cast("string"))
         for k in ("expected", "success", "failed", "poison")}
    bad = (n["failed"] > 0) | (n["poison"] > 0)
    derived = (
        F.when(~found, F.lit("NOT_FOUND"))
        .when((st == "FAILED") | bad, F.lit("FAILED"))
        .when(st == "", F.lit("INVALID_METADATA"))
        .otherwise(st)
    )
    control = S.normalize_status(F.col("control_status"))
    joined = joined.withColumn("_derived", derived)

    def warn(cond: Column, kind: str, message: Column | str) -> Column:
        text = F.lit(message) if isinstance(message, str) else message
        return F.when(cond, F.struct(F.lit(kind).alias("warning_type"), text.alias("message")))

    d = F.col("_derived")
    rules = F.array(
        warn(~found, "metadata_not_found", "metadata.json missing"),
        warn(found & (st == "COMPLETED") & ~F.col("has_marker"), "success_marker_missing",
             "metadata.status is COMPLETED but _SUCCESS was not found"),
        warn(found & F.col("has_marker") & ~st.isin("COMPLETED", "NO_DATA"),
             "success_marker_exists_but_status_not_completed",
             F.concat(F.lit("_SUCCESS exists but metadata.status is "), st)),
        warn(found & (n["expected"] > 0) & (n["success"] != n["expected"]) & (st == "COMPLETED"),
             "task_counts_inconsistent", "status COMPLETED but total_tasks_success != total_tasks_expected"),
        warn(found & bad & st.isin("COMPLETED", "NO_DATA"), "task_counts_inconsistent",
             "failed/poison counters > 0 but status is terminal-success-like"),
        warn(found & (control != "") & (control != d) & ~d.isin("NOT_FOUND", "INVALID_METADATA"),
             "ingestion_control_differs_from_raw_metadata",
             F.concat(F.lit("control status "), control, F.lit(" vs metadata-derived "), d)),
    )
    return (
        joined.withColumn("warnings", F.array_compact(rules))
        .withColumnRenamed("status", "manifest_status").withColumnRenamed("_derived", "status")
        .drop("_found")
    )


def join_markers(manifests: DataFrame, markers: DataFrame) -> DataFrame:
    """Adds ``has_marker``: a marker row exists for the manifest's marker path."""
    found = markers.select("success_marker_path").distinct().withColumn("_mk", F.lit(True))
    return manifests.join(found, "success_marker_path", "left").withColumn(
        "has_marker", F.col("_mk").isNotNull()
    ).drop("_mk")


def join_control(inspected: DataFrame, runs: DataFrame) -> DataFrame:
    control = runs.select("domain", "pipeline_run_id", F.col("status").alias("control_status"))
    return inspected.join(control, ["domain", "pipeline_run_id"], "left")


def _expected_rows(days: DataFrame, names) -> DataFrame:
    expected = F.explode(F.array(*[F.lit(n) for n in names])).alias("expected")
    return days.select("reference_date", expected).withColumn("domain", catalog.canonical_domain(F.col("expected")))


def expected_vs_found(days: DataFrame, inspections: DataFrame, names=catalog.DEFAULT_EXPECTED_DOMAINS) -> DataFrame:
    """Expected domains of each day beside their collected runs.

    A registered domain without runs is NOT_FOUND, an unregistered one
    NOT_IMPLEMENTED; ``placeholder`` tells which of those rows the summary
    lists as a run of its own.
    """
    exp = _expected_rows(days, names)
    known = F.col("domain").isin(*catalog.DOMAINS)
    joined = exp.join(inspections, ["reference_date", "domain"], "left")
    missing = F.col("pipeline_run_id").isNull()
    return joined.withColumns({
        "status": F.when(~known, F.lit("NOT_IMPLEMENTED"))
        .when(missing, F.lit("NOT_FOUND")).otherwise(F.col("status")),
        "placeholder": _placeholder(missing),
    })


def rollup_expected(days: DataFrame, inspections: DataFrame, names=catalog.DEFAULT_EXPECTED_DOMAINS,
                    extra: tuple[Column, ...] = ()) -> DataFrame:
    """Status of every expected domain and day.

    Runs are rolled up first, with map-side combine, and only one row per
    domain and day meets the expected list: same statuses as rolling up
    :func:`expected_vs_found`, without moving the runs.
    """
    rolled = rollup_domain(inspections, "reference_date", "domain", extra=extra)
    joined = _expected_rows(days, names).join(rolled, ["reference_date", "domain"], "left")
    known = F.col("domain").isin(*catalog.DOMAINS)
    return joined.withColumn("placeholder", _placeholder(F.col("runs").isNull())).withColumns({
        # An unregistered domain's placeholder rolls up to PARTIAL.
        "domain_status": F.when(~known, F.lit("PARTIAL")).otherwise(F.coalesce("domain_status", F.lit("NOT_FOUND"))),
        # Where the summary lists a placeholder, that is the domain's one run.
        "runs": F.coalesce("runs", F.col("placeholder").cast("bigint")),
    }).drop("domain")


def _placeholder(missing: Column) -> Column:
    """Whether the summary lists a run of its own for an expected domain without runs."""
    known = F.col("domain").isin(*catalog.DOMAINS)
    return missing & (~known | ~F.col("domain").isin(*NO_PLACEHOLDER))


def placeholder_warnings(days: DataFrame, inspections: DataFrame, names=catalog.DEFAULT_EXPECTED_DOMAINS) -> DataFrame:
    """The warning of every placeholder run: a domain that is not registered, or one without runs that day."""
    found = inspections.select("reference_date", "domain").distinct()
    empty = _expected_rows(days, names).join(found, ["reference_date", "domain"], "left_anti").where(_placeholder(F.lit(True)))
    known = F.col("domain").isin(*catalog.DOMAINS)
    unwired = F.concat(F.lit("No collector wired for domain '"), F.col("domain"), F.lit("'."))
    return empty.select(
        "reference_date", F.col("expected").alias("domain"), F.lit("").alias("pipeline_run_id"),
        F.when(known, F.lit("metadata_not_found")).otherwise(F.lit("domain_not_implemented")).alias("warning_type"),
        F.when(known, F.lit("No pipeline_run_id directories matched this reference_date.")).otherwise(unwired).alias("message"),
    )


def rollup_domain(rows: DataFrame, *keys: str, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Domain status from its runs' statuses, worst first; unknown statuses make it PARTIAL.

    ``extra`` aggregates ride along in the same pass.
    """
    s = F.col("status")
    any_ = lambda *v: F.bool_or(s.isin(*v))
    all_ = lambda *v: F.bool_and(s.isin(*v))
    names = ("_f", "_r", "_p", "_i", "_nf", "_nd", "_ok")
    tests = (any_("FAILED"), any_(*IN_PROGRESS), any_("PARTIAL"), any_("INVALID_METADATA"), all_("NOT_FOUND"),
             all_("NO_DATA"), all_("COMPLETED", "NO_DATA"))
    flags = rows.groupBy(*keys).agg(
        *[t.alias(n) for n, t in zip(names, tests)], F.count(F.lit(1)).alias("runs"), *extra
    )
    verdicts = ("FAILED", "RUNNING", "PARTIAL", "FAILED", "NOT_FOUND", "NO_DATA", "COMPLETED")
    status = F.coalesce(*[F.when(F.col(n), F.lit(v)) for n, v in zip(names, verdicts)], F.lit("PARTIAL"))
    return flags.withColumn("domain_status", status).drop(*names)


def _daily_status(s: Column) -> Column:
    live = s != "NOT_IMPLEMENTED"
    any_ = lambda *v: F.coalesce(F.bool_or(live & s.isin(*v)), F.lit(False))
    return (
        F.when(F.count_if(live) == 0, F.lit("PARTIAL"))
        .when(any_("FAILED"), F.lit("FAILED"))
        .when(any_(*IN_PROGRESS), F.lit("RUNNING"))
        .when(any_("PARTIAL", "NOT_FOUND"), F.lit("PARTIAL"))
        .when(F.bool_and(~live | s.isin("COMPLETED", "NO_DATA")), F.lit("COMPLETED"))
        .otherwise(F.lit("PARTIAL"))
    )


def rollup_daily(domains: DataFrame, *keys: str) -> DataFrame:
    """Day status over the expected domains; NOT_IMPLEMENTED ones are ignored, a day with none left is PARTIAL."""
    return domains.groupBy(*keys).agg(_daily_status(F.col("domain_status")).alias("status"))


def _count_columns(s: Column) -> list[Column]:
    n = lambda name, *v: F.count_if(s.isin(*v)).alias(f"total_domains_{name}")
    return [
        F.count(F.lit(1)).alias("total_domains_expected"), n("completed", "COMPLETED"), n("running", *IN_PROGRESS),
        n("failed", "FAILED"), n("no_data", "NO_DATA"), n("not_found", "NOT_FOUND"), n("partial", "PARTIAL"),
        n("not_implemented", "NOT_IMPLEMENTED"),
    ]


def summary_counts(domains: DataFrame, *keys: str) -> DataFrame:
    return domains.groupBy(*keys).agg(*_count_columns(F.col("domain_status")))


def collect_warnings(inspected: DataFrame, *keys: str, placeholders: DataFrame | None = None) -> DataFrame:
    """Warnings of all runs as rows: a bad day's list may be long, so it is never one array.

    ``placeholders`` are those of :func:`placeholder_warnings`.
    """
    out = inspected.select(*keys, "domain", "pipeline_run_id", F.inline("warnings"))
    return out if placeholders is None else out.unionByName(placeholders)


def daily_documents(days: DataFrame, inspections: DataFrame, names=catalog.DEFAULT_EXPECTED_DOMAINS) -> DataFrame:
    """One document per day: status, counts, status by domain, warning kinds.

    ``inspections`` is :func:`inspect_runs`.  Two aggregates (day and domain,
    then day) carry everything; both arrays in the document are bounded by the
    catalog, while the runs and the warnings stay in tables of their own.
    """
    rows = inspections.select(
        "reference_date", "domain", "status", F.transform("warnings", lambda w: w["warning_type"]).alias("_kinds")
    )
    per_kind = tuple(F.bool_or(F.array_contains("_kinds", k)).alias(f"_w_{k}") for k in WARNING_KINDS)
    domains = rollup_expected(days, rows, names, extra=(F.sum(F.size("_kinds")).alias("_n"), *per_kind))
    # A placeholder has one warning: of a registered domain that nothing was found, of another that nobody collects it.
    known = catalog.canonical_domain(F.col("expected")).isin(*catalog.DOMAINS)
    own = {"metadata_not_found": F.col("placeholder") & known, "domain_not_implemented": F.col("placeholder") & ~known}
    domains = domains.withColumn("_n", F.coalesce("_n", F.lit(0)) + F.col("placeholder").cast("int")).withColumns(
        {f"_w_{k}": F.coalesce(f"_w_{k}", F.lit(False)) | c for k, c in own.items()})
    s = F.col("domain_status")
    day = domains.groupBy("reference_date").agg(
        _daily_status(s).alias("status"), *_count_columns(s),
        *[F.max(F.when(F.col("expected") == d, s)).alias(f"_d_{d}") for d in names],
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("warnings_count"),
        *[F.bool_or(f"_w_{k}").alias(f"_w_{k}") for k in WARNING_KINDS],
    )
    totals = [c for c in day.columns if c.startswith("total_domains_")]
    kinds = F.array_compact(F.array(*[F.when(F.col(f"_w_{k}"), F.lit(k)) for k in sorted(WARNING_KINDS)]))
    return day.select(
        "reference_date", F.lit(catalog.METADATA_VERSION).alias("metadata_version"), F.lit("camara").alias("source"),
        F.lit("daily_runs").alias("summary_type"), "status",
        F.array(*[F.lit(d) for d in names]).alias("expected_domains"), F.struct(*totals).alias("summary"),
        F.struct(*[F.col(f"_d_{d}").alias(d) for d in names]).alias("domain_status"),
        kinds.alias("warning_types"), "warnings_count",
    )
