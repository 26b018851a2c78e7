"""Calendar rules as columns: month windows, date windows, run anchors.

``now`` is any timestamp or date column; nothing here reads the clock, so a
plan is replayable and a whole table of clock values can be evaluated at once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _months() -> Column:
    return F.sequence(F.lit(1), F.lit(12))


def max_dispatch_month(target_year: Column, now: Column) -> Column:
    """0 for a future year, this month for the current one, 12 for a past one."""
    return (
        F.when(target_year > F.year(now), F.lit(0))
        .when(target_year < F.year(now), F.lit(12))
        .otherwise(F.month(now))
    )


def months_between_bounds(low: Column, high: Column) -> Column:
    return F.filter(_months(), lambda m: (m >= low) & (m <= high))


def dispatch_order(target_year: Column, now: Column) -> Column:
    """Current month, previous month, then the rest ascending; a past year runs 1..12."""
    top = max_dispatch_month(target_year, now)
    upto = months_between_bounds(F.lit(1), top)
    cm = F.month(now)
    recent = F.filter(F.array(cm, cm - 1), lambda m: m >= 1)
    rest = F.filter(upto, lambda m: ~m.isin(cm, cm - 1))
    return F.when(target_year == F.year(now), F.concat(recent, rest)).otherwise(upto)


def daily_months(target_year: Column, now: Column, lookback: int) -> Column:
    """Anchor month and ``lookback`` months before it, newest first, inside the year."""
    top = max_dispatch_month(target_year, now)
    newest_first = F.reverse(_months())
    return F.filter(newest_first, lambda m: (m <= top) & (m >= top - lookback))


def reconciliation_months(target_year: Column, now: Column, start_month: int) -> Column:
    start = max(1, min(12, int(start_month)))
    return months_between_bounds(F.lit(start), max_dispatch_month(target_year, now))


def reconciliation_pair(target_year: Column, now: Column) -> Column:
    """Previous and current month, ascending; January stands alone, a past year gives 11, 12."""
    top = max_dispatch_month(target_year, now)
    return months_between_bounds(top - 1, top)


def legacy_month_pair(now: Column) -> Column:
    """Current and previous (year, month), crossing the year."""
    prev = F.add_months(F.to_date(now), -1)
    return F.array(
        F.struct(F.year(now).alias("ano"), F.month(now).alias("mes")),
        F.struct(F.year(prev).alias("ano"), F.month(prev).alias("mes")),
    )


def _span(start: Column, end: Column) -> Column:
    return F.struct(start.alias("date_start"), end.alias("date_end"))


def rolling_days(now: Column, days: int) -> Column:
    """Last ``days`` calendar days, today included (at least one, at most 366)."""
    today = F.to_date(now)
    return _span(F.date_sub(today, max(1, min(366, days)) - 1), today)


def month_to_date(now: Column) -> Column:
    today = F.to_date(now)
    return _span(F.to_date(F.trunc(today, "month")), today)


def today_and_future(now: Column, future_days: int) -> Column:
    today = F.to_date(now)
    return _span(today, F.date_add(today, max(0, future_days)))


def past_and_future(now: Column, past_days: int, future_days: int) -> Column:
    today = F.to_date(now)
    return _span(F.date_sub(today, max(0, past_days)), F.date_add(today, max(0, future_days)))


def previous_month_to_date(now: Column) -> Column:
    """First day of the previous month through today."""
    today = F.to_date(now)
    return _span(F.add_months(F.trunc(today, "month"), -1), today)


def year_to_date(target_year: Column, now: Column) -> Column:
    return _span(F.make_date(target_year, F.lit(1), F.lit(1)), F.to_date(now))


def day_start(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def day_end(day: Column) -> Column:
    """Last microsecond of a day."""
    return F.date_add(day, 1).cast("timestamp_ntz") - F.expr("INTERVAL '0.000001' SECOND")


def capped_end(now: Column, day: Column) -> Column:
    """End of a reconciliation window: the day's last instant, or now if that comes first."""
    return F.least(now.cast("timestamp_ntz"), day_end(day))


def in_days(ts: Column, start: Column, end: Column) -> Column:
    """Inclusive calendar-day window; a plain range test, so it reaches the scan."""
    return (ts >= day_start(start)) & (ts < day_start(F.date_add(end, 1)))


def round_minute_down(ts: Column, minutes: int) -> Column:
    """Start of the ``minutes``-wide slot of the hour that holds ``ts``."""
    over = F.minute(ts) % minutes
    return F.date_trunc("minute", ts) - F.make_dt_interval(mins=over)


def reference_date(ts_utc: Column, tz: str) -> Column:
    """Civil date in ``tz`` of a zone-less UTC time."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts_utc.cast("timestamp_ntz")))


def compact(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def ceap_mode(now: Column, legacy_day: int | None = None) -> Column:
    """Reconciliation on Sunday, or on a fixed day of the month in legacy mode."""
    hit = (F.dayofweek(now) == 1) if legacy_day is None else (F.dayofmonth(now) == legacy_day)
    return F.when(hit, F.lit("reconciliation")).otherwise(F.lit("daily"))


def votacoes_mode(now: Column, recon_day: int = 25, skip_weekend: bool = False) -> Column:
    mode = F.when(F.dayofmonth(now) == max(1, min(28, recon_day)), F.lit("reconciliation"))
    if skip_weekend:
        mode = mode.when(F.dayofweek(now).isin(1, 7), F.lit("skipped_weekend"))
    return mode.otherwise(F.lit("microbatch"))
