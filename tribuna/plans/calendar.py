"""Queries over clock values: month windows, date windows, run ids, modes.

Order dates and event times serve as a large table of clock values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tribuna import catalog
from tribuna.functions import scalars as S
from tribuna.functions import windows as W
from tribuna.operators import summary as SU
from tribuna.plans import stand_ins as ST
from tribuna.plans.stand_ins import twin
from tribuna.session import read_table, spread


def _join(months) -> F.Column:
    return F.array_join(F.transform(months, lambda m: m.cast("string")), ",")


def month_windows(spark, sf):
    """Every month rule for each order date, with target years around it."""
    o = spread(read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate"))
    now = F.col("o_orderdate")
    year = (F.year(now) + F.col("o_orderkey") % 3 - 1).cast("int")
    pair = F.transform(W.legacy_month_pair(now), lambda x: F.concat_ws("-", x["ano"].cast("string"), x["mes"].cast("string")))
    return o.select(
        "o_orderkey", W.max_dispatch_month(year, now).alias("max_month"), _join(W.dispatch_order(year, now)).alias("dispatch"),
        _join(W.daily_months(year, now, 1)).alias("daily1"), _join(W.reconciliation_months(year, now, 3)).alias("recon3"),
        _join(W.reconciliation_pair(year, now)).alias("pair"), F.array_join(pair, ",").alias("legacy"),
    )


def _text(span) -> F.Column:
    return F.concat_ws("..", span["date_start"].cast("string"), span["date_end"].cast("string"))


def calendar_windows(spark, sf):
    o = spread(read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate"))
    now = F.col("o_orderdate")
    return o.select(
        "o_orderkey", _text(W.rolling_days(now, 7)).alias("rolling7"), _text(W.month_to_date(now)).alias("month_to_date"),
        _text(W.today_and_future(now, 7)).alias("future7"), _text(W.past_and_future(now, 7, 30)).alias("past_future"),
        _text(W.previous_month_to_date(now)).alias("prev_month"), _text(W.year_to_date(F.year(now), now)).alias("ytd"),
        W.day_end(F.to_date(now)).cast("string").alias("day_end"),
        F.date_format(W.capped_end(now, F.date_sub(F.to_date(now), (F.col("o_orderkey") % 2).cast("int"))), "yyyy-MM-dd HH:mm:ss").alias("recon_end"),
    )


def in_window(spark, sf):
    """Inclusive day window and future-month filter over the events."""
    e = read_table(spark, sf, "events")
    lo, hi = F.lit("2024-01-10").cast("date"), F.lit("2024-01-15").cast("date")
    kept = e.where(W.in_days(F.col("ts"), lo, hi))
    return kept.where(F.month("ts") <= W.max_dispatch_month(F.year("ts"), ST.now())).select("event_id")


def run_ids(spark, sf):
    """Run ids built, checked, typed and attributed."""
    e = spread(read_table(spark, sf, "events"))
    ts = F.col("ts")
    slot = W.round_minute_down(ts, 10)
    kind = F.col("event_id") % 6
    rid = (
        F.when(kind == 0, catalog.minute_run_id("votacoes_microbatch_", slot))
        .when(kind == 1, catalog.daily_run_id("proposicoes_reconciliation_", ts))
        .when(kind == 2, catalog.daily_run_id("eventos_daily_", ts))
        .when(kind == 3, F.concat(F.lit("proposicoes_recoctl_"), F.substring(F.sha2("props", 256), 1, 16)))
        .when(kind == 4, F.concat(F.lit("Bad id "), F.col("event_id").cast("string")))
        .otherwise(F.concat(F.lit("current_year_backfill_"), F.date_format(ts, "yyyyMMdd_HHmmss")))
    )
    return e.select(
        "event_id", rid.alias("run_id"), catalog.is_well_formed_run_id(rid).alias("ok"),
        catalog.run_type(rid).alias("run_type"), catalog.owner_domain(rid).alias("domain"),
    )


def mode_by_day(spark, sf):
    """Mode of each event's day, reference date in Brasília time, anchor minute."""
    e = spread(read_table(spark, sf, "events"))
    ts = F.col("ts")
    return e.select(
        "event_id", W.ceap_mode(ts).alias("ceap"), W.ceap_mode(ts, 25).alias("ceap_legacy"),
        W.votacoes_mode(ts, 25, skip_weekend=True).alias("votacoes"),
        W.reference_date(ts, "America/Sao_Paulo").cast("string").alias("reference_date"), W.compact(ts).alias("compact"),
        F.date_format(W.round_minute_down(ts, 10), "yyyy-MM-dd HH:mm:ss").alias("anchor"),
    )


def scalar_rules(spark, sf):
    """Tolerant casts, ISO times, months lists, path segments and ids."""
    e = spread(read_table(spark, sf, "events"))
    k = ST.k_value()
    raw = F.when(k % 4 == 0, k.cast("string")).when(k % 4 == 1, F.lit("x1")).when(k % 4 == 2, F.lit(" ")).otherwise(F.lit(None))
    iso = F.when(k % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k % 3 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.lit("soon"))
    months = F.when(k % 5 == 0, F.lit("oops")).otherwise(F.concat(F.lit("["), k.cast("string"), F.lit(', "4", "x", 2]')))
    status = F.when(k % 2 == 0, F.lit(" partially_completed ")).otherwise(F.lower("event_type"))
    return e.select(
        "event_id", S.int_or_zero(raw).alias("n"), F.date_format(S.parse_iso_utc(iso), "yyyy-MM-dd HH:mm:ss").alias("iso"),
        _join(S.months_list(months)).alias("months"), S.normalize_status(status).alias("status"),
        S.safe_segment(F.concat(F.lit("run id/"), "event_type", F.lit(":é"))).alias("segment"),
        S.is_stale(F.col("ts"), ST.now(), 60).alias("stale"),
    )


def ceap_candidates(spark, sf):
    """Candidate expense runs of each event day; UTC already is the next day in one of three."""
    e = read_table(spark, sf, "events")
    days = e.select(F.to_date("ts").alias("reference_date"), (F.col("event_id") % 3 == 0).alias("late")).distinct()
    utc = F.when(F.col("late"), F.date_add("reference_date", 1)).otherwise(F.col("reference_date"))
    days = days.withColumn("utc", utc)
    both = SU.ceap_candidates(days, F.col("utc"))
    return SU.dedup_runs(both, ["reference_date", "pipeline_run_id"]).select(
        F.col("reference_date").cast("string").alias("reference_date"), "pipeline_run_id")


def discover_runs(spark, sf):
    """Runs of one day found in paths."""
    from tribuna.sources.pages import discover_runs as op

    e = read_table(spark, sf, "events")
    path = F.concat(F.lit("raw/camara/votacoes/api/_metadata/runs/pipeline_run_id=votacoes_microbatch_"),
                    F.date_format("ts", "yyyyMMddHHmm"), F.lit("/metadata.json"))
    return op(e.select(path.alias("path")), "20240115")


def id_order(spark, sf):
    """Sort keys of mixed ids: numeric first, then text."""
    p = read_table(spark, sf, "pages")
    tail = F.regexp_extract("url", r"/([0-9]+)[/#?]?", 1)
    pid = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("55-"), F.col("page_id").cast("string"))).otherwise(tail)
    num, text = S.id_order(pid)
    return p.select("page_id", pid.alias("id"), num.alias("num"), text.alias("text"))


QUERIES = {
    "month_windows": (month_windows, """WITH b AS (SELECT o_orderkey, o_orderdate AS d, year(o_orderdate) + o_orderkey % 3 - 1 AS y, year(o_orderdate) AS cy, month(o_orderdate) AS cm FROM orders),
  t AS (SELECT *, CAST(CASE WHEN y > cy THEN 0 WHEN y < cy THEN 12 ELSE cm END AS INTEGER) AS top FROM b),
  m AS (SELECT t.*, i FROM t, range(1, 13) r(i))
  SELECT o_orderkey, top AS max_month,
  coalesce(string_agg(CAST(i AS VARCHAR), ',' ORDER BY CASE WHEN y = cy AND i = cm THEN -1 WHEN y = cy AND i = cm - 1 THEN 0 ELSE i END) FILTER (i <= top), '') AS dispatch,
  coalesce(string_agg(CAST(i AS VARCHAR), ',' ORDER BY i DESC) FILTER (i <= top AND i >= top - 1), '') AS daily1,
  coalesce(string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FILTER (i BETWEEN 3 AND top), '') AS recon3,
  coalesce(string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FILTER (i BETWEEN top - 1 AND top), '') AS pair,
  any_value(cy || '-' || cm || ',' || year(d - INTERVAL 1 MONTH) || '-' || month(d - INTERVAL 1 MONTH)) AS legacy
  FROM m GROUP BY o_orderkey, top"""),
    "calendar_windows": (calendar_windows, """WITH b AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
  SELECT o_orderkey, strftime(d - 6, '%Y-%m-%d') || '..' || strftime(d, '%Y-%m-%d') AS rolling7, strftime(date_trunc('month', d), '%Y-%m-%d') || '..' || strftime(d, '%Y-%m-%d') AS month_to_date,
  strftime(d, '%Y-%m-%d') || '..' || strftime(d + 7, '%Y-%m-%d') AS future7, strftime(d - 7, '%Y-%m-%d') || '..' || strftime(d + 30, '%Y-%m-%d') AS past_future,
  strftime(date_trunc('month', d) - INTERVAL 1 MONTH, '%Y-%m-%d') || '..' || strftime(d, '%Y-%m-%d') AS prev_month,
  year(d) || '-01-01..' || strftime(d, '%Y-%m-%d') AS ytd, strftime(d, '%Y-%m-%d') || ' 23:59:59.999999' AS day_end,
  CASE WHEN o_orderkey % 2 = 1 THEN strftime(d - 1, '%Y-%m-%d') || ' 23:59:59' ELSE strftime(d, '%Y-%m-%d') || ' 00:00:00' END AS recon_end FROM b"""),
    "in_window": (in_window, "SELECT event_id FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'"),
    "run_ids": (run_ids, twin("""SELECT event_id, run_id, event_id % 6 < 4 AS ok,
  CASE event_id % 6 WHEN 0 THEN 'microbatch' WHEN 1 THEN 'reconciliation' WHEN 2 THEN 'daily' ELSE 'manual_replay' END AS run_type,
  CASE event_id % 6 WHEN 0 THEN 'votacoes' WHEN 2 THEN 'eventos' WHEN 4 THEN NULL ELSE 'proposicoes' END AS domain FROM (SELECT event_id,
  CASE event_id % 6 WHEN 0 THEN 'votacoes_microbatch_' || strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y%m%d%H%M') WHEN 1 THEN 'proposicoes_reconciliation_' || ymd
  WHEN 2 THEN 'eventos_daily_' || ymd WHEN 3 THEN 'proposicoes_recoctl_' || substr(sha256(props), 1, 16) WHEN 4 THEN 'Bad id ' || event_id
  ELSE 'current_year_backfill_' || strftime(ts, '%Y%m%d_%H%M%S') END AS run_id FROM ev)""", "ev")),
    "mode_by_day": (mode_by_day, """SELECT event_id, CASE WHEN isodow(ts) = 7 THEN 'reconciliation' ELSE 'daily' END AS ceap, CASE WHEN day(ts) = 25 THEN 'reconciliation' ELSE 'daily' END AS ceap_legacy,
  CASE WHEN day(ts) = 25 THEN 'reconciliation' WHEN isodow(ts) >= 6 THEN 'skipped_weekend' ELSE 'microbatch' END AS votacoes, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d') AS reference_date,
  strftime(ts, '%Y%m%d') AS compact, strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS anchor FROM events"""),
    "scalar_rules": (scalar_rules, twin("""SELECT event_id, CAST(CASE WHEN k % 4 = 0 THEN k ELSE 0 END AS BIGINT) AS n, CASE WHEN k % 3 < 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS iso,
  CASE WHEN k % 5 = 0 THEN '' ELSE k || ',4,2' END AS months, CASE WHEN k % 2 = 0 THEN 'PARTIAL' ELSE upper(event_type) END AS status,
  'run_id_' || event_type || '_' AS segment, ts < TIMESTAMP '2024-01-20 11:00:00' AS stale FROM ev""", "ev")),
    "ceap_candidates": (ceap_candidates, """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS r, event_id % 3 = 0 AS late FROM events), u AS (SELECT r, unnest([r, CASE WHEN late THEN r + 1 ELSE r END]) AS x FROM d)
  SELECT DISTINCT strftime(r, '%Y-%m-%d') AS reference_date, unnest(CASE WHEN isodow(r) = 7 THEN ['ceap_daily_' || strftime(x, '%Y%m%d'), 'ceap_reconciliation_' || strftime(x, '%Y%m%d')]
  ELSE ['ceap_daily_' || strftime(x, '%Y%m%d')] END) AS pipeline_run_id FROM u"""),
    "discover_runs": (discover_runs, "SELECT DISTINCT 'votacoes_microbatch_' || strftime(ts, '%Y%m%d%H%M') AS pipeline_run_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'"),
    "id_order": (id_order, """WITH b AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '55-' || page_id ELSE regexp_extract(url, '/([0-9]+)[/#?]?', 1) END AS id FROM pages)
  SELECT page_id, id, CASE WHEN regexp_full_match(id, '[0-9]+') THEN CAST(id AS BIGINT) ELSE 1000000000000000000 END AS num, CASE WHEN regexp_full_match(id, '[0-9]+') THEN '' ELSE id END AS text FROM b"""),
}
