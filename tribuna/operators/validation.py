"""Manifest validation, snapshot choice, request rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tribuna.functions import scalars as S

SUPPORTED_BACKFILL = ("proposicoes", "votacoes", "eventos", "discursos", "ceap")
DEFAULT_MAX_TASKS = 1000
ABSOLUTE_MAX_TASKS = 100_000
CONFIRM_ABOVE = 5000


@dataclass(frozen=True)
class Profile:
    """Completion checks on top of ``status = COMPLETED``."""

    records: bool = False
    pages: bool = False
    files_match_pages: bool = False
    tasks_balanced: bool = False


DIMENSION_SNAPSHOT = Profile(records=True, pages=True, files_match_pages=True)
FANOUT_RUN = Profile(tasks_balanced=True)

_BALANCE = ("failed", "pending", "poison", "running")


def _n(name: str) -> Column:
    return S.int_or_zero(F.col(name).cast("string"))


def invalid_reason(profile: Profile, present: Column) -> Column:
    """First failing rule as text, null when the manifest is valid.  Rule order is part of the contract."""
    rules = [
        F.when(~present, F.lit("metadata_missing")),
        F.when(
            F.upper(F.coalesce("status", F.lit(""))) != "COMPLETED",
            F.concat(F.lit("status="), F.coalesce("status", F.lit("None"))),
        ),
    ]
    if profile.records:
        rules.append(F.when(_n("record_count") <= 0, F.lit("record_count<=0")))
    if profile.pages:
        rules.append(F.when(_n("total_pages") <= 0, F.lit("total_pages<=0")))
    if profile.files_match_pages:
        mismatch = F.col("files_written").isNotNull() & (_n("files_written") != _n("total_pages"))
        rules.append(F.when(mismatch, F.lit("files_written!=total_pages")))
    if profile.tasks_balanced:
        exp = _n("total_tasks_expected")
        rules.append(F.when(exp < 0, F.lit("total_tasks_expected<0")))
        for k in ("success", *_BALANCE, "queued"):
            name = f"total_tasks_{k}"
            rules.append(
                F.when((exp == 0) & (_n(name) != 0), F.lit(f"{name}!=0 when total_tasks_expected=0"))
            )
        rules.append(F.when((exp > 0) & (_n("total_tasks_success") != exp), F.lit("success!=expected")))
        for k in (*_BALANCE, "queued"):
            name = f"total_tasks_{k}"
            rules.append(F.when((exp > 0) & (_n(name) != 0), F.lit(f"{name}!=0")))
    return F.coalesce(*rules)


def validate_manifests(manifests: DataFrame, profile: Profile, present: Column | None = None) -> DataFrame:
    reason = invalid_reason(profile, present if present is not None else F.lit(True))
    return manifests.withColumn("reason", F.coalesce(reason, F.lit(""))).withColumn("ok", F.col("reason") == "")


def validate_completed(manifests: DataFrame, markers: DataFrame, profile: Profile) -> DataFrame:
    """Content rules, then the marker; the marker is looked up by its path."""
    checked = validate_manifests(manifests, profile)
    found = markers.select("success_marker_path").distinct().withColumn("_marked", F.lit(True))
    out = checked.join(found, "success_marker_path", "left")
    missing = F.col("ok") & F.col("_marked").isNull()
    return out.withColumns({
        "reason": F.when(missing, F.lit("success_marker_missing")).otherwise(F.col("reason")),
        "ok": F.col("ok") & ~missing,
    }).drop("_marked")


def snapshot_is_valid() -> Column:
    return (
        (F.upper(F.coalesce("status", F.lit(""))) == "COMPLETED")
        & (_n("record_count") > 0) & (_n("total_pages") > 0) & (_n("files_written") == _n("total_pages"))
    )


def valid_snapshots(snapshots: DataFrame) -> DataFrame:
    return snapshots.where(snapshot_is_valid() & F.col("has_marker"))


def latest_snapshot(snapshots: DataFrame, before: Column, value: str = "pipeline_run_id") -> DataFrame:
    """Newest valid snapshot strictly before a date, in one row."""
    ok = valid_snapshots(snapshots).where(F.col("reference_date") < before)
    return ok.agg(
        F.max("reference_date").alias("reference_date"), F.max_by(value, "reference_date").alias(value)
    )


def latest_before_each(snapshots: DataFrame, year_of: int = 4) -> DataFrame:
    """For every snapshot date, the newest valid snapshot strictly before it.

    One row per date; the window runs in two levels (year, then dates of the
    year), so no task holds more than a year of dates.
    """
    per_date = snapshots.groupBy("reference_date").agg(
        F.max(F.when(snapshot_is_valid() & F.col("has_marker"), F.col("pipeline_run_id"))).alias("valid_run")
    ).withColumn("_year", F.substring("reference_date", 1, year_of))
    valid_date = F.when(F.col("valid_run").isNotNull(), F.struct("reference_date", "valid_run"))
    per_date = per_date.withColumn("_v", valid_date)
    years = per_date.groupBy("_year").agg(F.max("_v").alias("_top"))
    w_years = Window.orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    carried = years.select("_year", F.max("_top").over(w_years).alias("_carry"))
    w_in = Window.partitionBy("_year").orderBy("reference_date").rowsBetween(Window.unboundedPreceding, -1)
    inside = per_date.withColumn("_in", F.max("_v").over(w_in)).join(carried, "_year")
    best = F.coalesce("_in", "_carry")
    return inside.select(
        "reference_date",
        F.col("valid_run").alias("today_run"),
        best.getField("reference_date").alias("fallback_date"),
        best.getField("valid_run").alias("fallback_run"),
    )


def choose_snapshot(candidates: DataFrame, mode: Column) -> DataFrame:
    """Reuse today's snapshot, fall back to an older one in reconciliation only, else create.

    Input is the output of :func:`latest_before_each` plus ``created_records``,
    what a fresh listing would bring.
    """
    fallback = (mode == "reconciliation") & F.col("fallback_run").isNotNull()
    today = F.col("today_run").isNotNull()
    return candidates.withColumns({
        "snapshot_source": F.when(today, F.lit("reused_today"))
        .when(fallback, F.lit("reused_fallback"))
        .when(F.col("created_records") > 0, F.lit("created_today"))
        .otherwise(F.lit("none")),
        "snapshot_date": F.when(~today & fallback, F.col("fallback_date")).otherwise(F.col("reference_date")),
    })


def validate_requests(requests: DataFrame, now: Column) -> DataFrame:
    """Adds ``errors``: the error codes of each backfill request, in rule order.

    Reads ``year, start_date, end_date, domains, force, max_tasks,
    confirm_max_tasks``, all text as received.  A date that does not parse
    ends the checks.  Values are parsed once, in a projection of their own.
    """
    cal = F.year(now)
    raw_year = F.coalesce(F.trim("year"), F.lit(""))
    raw_tasks = F.coalesce("max_tasks", F.lit(str(DEFAULT_MAX_TASKS)))
    given = lambda name: F.when(F.trim(name) != "", F.trim(name))
    names = F.filter(
        F.transform(F.split(F.coalesce("domains", F.lit("")), ","), lambda d: F.lower(F.trim(d))), lambda d: d != ""
    )
    parsed = requests.withColumns({
        "_year": raw_year.try_cast("int"), "_has_year": raw_year != "", "_force": S.boolish(F.col("force")),
        "_tasks": raw_tasks.try_cast("bigint"), "_confirm": S.boolish(F.col("confirm_max_tasks")), "_domains": names,
    })
    year = F.coalesce("_year", cal)
    parsed = parsed.withColumns({
        "_start": S.iso_date(F.coalesce(given("start_date"), F.concat(year.cast("string"), F.lit("-01-01")))),
        "_end": S.iso_date(F.coalesce(given("end_date"), F.date_format(now, "yyyy-MM-dd"))),
        "_unknown": F.filter("_domains", lambda d: ~d.isin(*SUPPORTED_BACKFILL)),
    })
    start, end, tasks = F.col("_start"), F.col("_end"), F.coalesce("_tasks", F.lit(DEFAULT_MAX_TASKS))
    bad = start.isNull() | end.isNull()
    outside = (F.year(start) < year) | (F.year(end) > year)
    rules = [
        (F.col("_has_year") & F.col("_year").isNull(), "year_must_be_integer"),
        (year > cal, "year_cannot_exceed_current_calendar_year"),
        ((year < cal) & ~F.col("_force"), "past_year_requires_force_true"),
        (bad, "invalid_start_or_end_date_iso"),
        (~bad & (start > end), "date_start_after_date_end"),
        (~bad & outside & ~F.col("_force"), "window_outside_year_requires_force_true"),
        (~bad & (F.size("_domains") == 0), "domains_required"),
        (~bad & (F.size("_unknown") > 0), F.concat(F.lit("unknown_domains:"), F.array_join("_unknown", ","))),
        (~bad & F.col("_tasks").isNull(), "max_tasks_must_be_integer"),
        (~bad & (tasks < 1), "max_tasks_must_be_at_least_1"),
        (~bad & (tasks > ABSOLUTE_MAX_TASKS), f"max_tasks_cannot_exceed_{ABSOLUTE_MAX_TASKS}"),
        (~bad & (tasks > CONFIRM_ABOVE) & ~F.col("_confirm"),
         f"max_tasks_above_{CONFIRM_ABOVE}_requires_confirm_max_tasks_true"),
    ]
    codes = F.array(*[F.when(cond, F.lit(code) if isinstance(code, str) else code) for cond, code in rules])
    helpers = [c for c in parsed.columns if c.startswith("_") and c not in requests.columns]
    return parsed.withColumn("errors", F.array_compact(codes)).drop(*helpers)


def window_errors(start: Column, end: Column, target_year: Column | None = None,
                  allow_mismatch: Column | None = None,
                  mismatch_code: str = "dates_must_match_target_year_or_allow_year_mismatch") -> Column:
    """Error codes of a manual reconciliation window."""
    s, e = S.iso_date(start), S.iso_date(end)
    bad = s.isNull() | e.isNull()
    codes = [
        F.when(bad, F.lit("invalid_iso_date")),
        F.when(~bad & (s > e), F.lit("date_start_after_date_end")),
    ]
    if target_year is not None:
        off = (F.year(s) != target_year) | (F.year(e) != target_year)
        ordered = ~bad & (s <= e)
        codes.append(F.when(ordered & off & ~F.coalesce(allow_mismatch, F.lit(False)), F.lit(mismatch_code)))
    return F.array_compact(F.array(*codes))
