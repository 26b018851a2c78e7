"""Streaming queries over the event feed, each drained to the end and compared with its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from tribuna.plans import stand_ins as ST
from tribuna.plans.stand_ins import twin
from tribuna.session import read_table, work_path
from tribuna.streaming import microbatch as MB
from tribuna.streaming import table_log
from tribuna.streaming import task_state as TS


def _feed(spark, sf):
    schema = read_table(spark, sf, "events").schema
    # A pattern that only this name matches: the table may be a folder of part files or one file.
    return MB.read_feed(spark, f"{sf.rstrip('/')}/events.[p]arquet", schema)


def _batches(spark, sf, n):
    """The feed as ``n`` files in mixed order of time, one to a batch: file ``i`` has every ``n``-th event from ``i`` on."""
    path = work_path(spark, "feed")
    e = read_table(spark, sf, "events")
    for i in range(n):  # one write after the other, as files are taken by their age
        e.where(F.pmod("event_id", F.lit(n)) == (i * 2 + 1) % n).coalesce(1).write.mode("append").parquet(path)
    return MB.read_feed(spark, path, e.schema, files_per_trigger=1)


def stream_microbatch(spark, sf):
    """Ten-minute windows with record counts and largest ids, from three batches in mixed time order."""
    path, cp = work_path(spark, "runs"), work_path(spark, "runs-cp")
    MB.stream_runs(_batches(spark, sf, 3).withColumnRenamed("event_id", "id"), path, cp)
    return MB.current_runs(spark, path)


def stream_dedup(spark, sf):
    """List rows by uid and hash over five batches, re-read rows dropped."""
    path, cp = work_path(spark, "dedup"), work_path(spark, "dedup-cp")
    fp = ST.stored_item_hash(F.col("user_id"))
    MB.stream_dedup(_batches(spark, sf, 5).select("ts", fp["uid"].alias("uid"), fp["hash"].alias("hash")), path, cp)
    return spark.read.parquet(path).select("uid", "hash")


def reconcile_feed(spark, sf):
    """Rows of the whole feed whose fingerprint the first half never brought."""
    e = read_table(spark, sf, "events")
    fp = ST.stored_item_hash(F.col("user_id"))
    rows = e.select("ts", fp["uid"].alias("uid"), fp["hash"].alias("hash"))
    return MB.reconcile_batch(rows, rows.where(F.col("ts") < F.lit("2024-01-05").cast("timestamp_ntz"))).select("uid", "hash")


def reconcile_digests(spark, sf):
    """Rows of the whole feed that a pass over all other days never brought; the other days have equal digests."""
    e = read_table(spark, sf, "events")
    fp = ST.stored_item_hash(F.col("event_id"))
    rows = e.select(ST.day_text(F.col("ts")).alias("day"), fp["uid"].alias("uid"), fp["hash"].alias("hash"))
    return MB.reconcile_by_digest(rows, rows.where(F.col("day") != "2024-01-05")).select("uid", "hash")


def stream_task_state(spark, sf):
    """Task state kept by a stream of task events, folded after every second batch that a bucket has."""
    path, cp = work_path(spark, "state"), work_path(spark, "state-cp")
    TS.stream_states(ST.task_events(_by_time(spark, sf, 4)), ["row_key"], path, cp, full=2)
    out = TS.current(spark, path, ["row_key"])
    return out.select("row_key", "status", "current_pipeline_run_id", "last_pipeline_run_id", "attempt_count", "reprocess_count", "record_count",
                      "last_list_item_hash", F.date_format("last_success_at", "yyyy-MM-dd HH:mm:ss").alias("last_success_at"))


def _by_time(spark, sf, n):
    """The feed as ``n`` files in order of time, one to a batch."""
    path = work_path(spark, "feed")
    e = read_table(spark, sf, "events")
    day = F.dayofyear("ts")
    span = e.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    width = ((span.hi or 0) - (span.lo or 0)) // n + 1
    for i in range(n):
        e.where(F.floor((day - (span.lo or 0)) / width) == i).coalesce(1).write.mode("append").parquet(path)
    return MB.read_feed(spark, path, e.schema, files_per_trigger=1)


def _feed_ids(feed):
    return feed.select(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("55-"), F.col("event_id").cast("string")))
                       .otherwise(F.col("event_id").cast("string")).alias("id"))


def stream_cursor(spark, sf):
    """Ids above the cursor of the earlier ticks, per user and event type."""
    path, cp = work_path(spark, "cursor"), work_path(spark, "cursor-cp")
    MB.stream_after_cursor(_feed_ids(_feed(spark, sf)), path, cp)
    return table_log.read_log(spark, f"{path}/rows").select("id")


def stream_cursor_outcomes(spark, sf):
    """Four ticks, each ending in an outage: the last tenth of a tick's ids fails when first offered.

    The failed ids stay above the cursor and are offered again at the next tick.
    """
    path, cp, src = work_path(spark, "cursor"), work_path(spark, "cursor-cp"), work_path(spark, "feed")
    e = read_table(spark, sf, "events")
    per_tick = e.agg(F.max("event_id").alias("n")).first().n // 4 + 1
    for i in range(4):
        e.where(F.floor(F.col("event_id") / per_tick) == i).coalesce(1).write.mode("append").parquet(src)

    def outcomes(offered):
        number = F.regexp_extract("id", r"(\d+)$", 1).cast("bigint")
        outage = (F.col("attempt") == 1) & (F.pmod(number, F.lit(per_tick)) * 10 >= per_tick * 9)
        return offered.withColumn("status", F.when(outage, F.lit("FAILED")).otherwise(F.lit("SUCCESS")))

    MB.stream_after_cursor(_feed_ids(MB.read_feed(spark, src, e.schema, files_per_trigger=1)), path, cp, outcomes)
    return table_log.read_log(spark, f"{path}/rows").select(F.col("batch_id").cast("int").alias("tick"), "id", "attempt", "status")


QUERIES = {
    "stream_microbatch": (stream_microbatch, """SELECT 'votacoes_microbatch_' || strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y%m%d%H%M') AS pipeline_run_id, strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%d %H:%M') AS window_start,
  count(*) AS records, max(event_id) AS max_id FROM events GROUP BY time_bucket(INTERVAL 10 MINUTE, ts)"""),
    "stream_dedup": (stream_dedup, twin("""SELECT DISTINCT sha256('camara_dadosabertos|proposicoes|{"id":' || user_id || '}') AS uid, sha256('{"id":' || user_id || ',"situacao":"' || substr('FOP', k % 3 + 1, 1) || '"}') AS hash FROM ev""", "ev")),
    "reconcile_feed": (reconcile_feed, twin("""SELECT sha256('camara_dadosabertos|proposicoes|{"id":' || user_id || '}') AS uid, sha256('{"id":' || user_id || ',"situacao":"' || substr('FOP', k % 3 + 1, 1) || '"}') AS hash FROM ev
  GROUP BY user_id, k % 3 HAVING min(ts) >= TIMESTAMP '2024-01-05'""", "ev")),
    "reconcile_digests": (reconcile_digests, twin("""SELECT sha256('camara_dadosabertos|proposicoes|{"id":' || event_id || '}') AS uid, sha256('{"id":' || event_id || ',"situacao":"' || substr('FOP', k % 3 + 1, 1) || '"}') AS hash FROM ev
  WHERE ymd = '20240105'""", "ev")),
    "stream_cursor_outcomes": (stream_cursor_outcomes, """WITH w AS (SELECT max(event_id) // 4 + 1 AS n FROM events),
  f AS (SELECT event_id, CAST(event_id // n AS INTEGER) AS tick, (event_id % n) * 10 >= n * 9 AS outage, CASE WHEN event_id % 7 = 0 THEN '55-' || event_id ELSE CAST(event_id AS VARCHAR) END AS id FROM events, w WHERE event_id > 0 OR event_id % 7 = 0)
  SELECT tick, id, CAST(1 AS INTEGER) AS attempt, CASE WHEN outage THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM f
  UNION ALL SELECT tick + 1, id, CAST(2 AS INTEGER), 'SUCCESS' FROM f WHERE outage AND tick < 3"""),
    "stream_task_state": (stream_task_state, twin("""SELECT row_key, status, current_pipeline_run_id, (SELECT arg_max(run_id, (ts, seq)) FROM task_events p WHERE p.row_key = b.row_key AND (p.ts, p.seq) < (b.dts, b.dseq)) AS last_pipeline_run_id,
  attempt_count, CAST(0 AS BIGINT) AS reprocess_count, record_count, last_list_item_hash, last_success_at FROM (SELECT row_key, arg_max(status, (ts, seq)) AS status, arg_max(run_id, (ts, seq)) AS current_pipeline_run_id,
  max(ts) FILTER (status IN ('QUEUED', 'RUNNING')) AS dts, arg_max(seq, (ts, seq)) FILTER (status IN ('QUEUED', 'RUNNING')) AS dseq, count(*) FILTER (status = 'RUNNING') AS attempt_count,
  arg_max(record_count, (ts, seq)) FILTER (status = 'SUCCESS') AS record_count, arg_max(hash, (ts, seq)) FILTER (status = 'SUCCESS') AS last_list_item_hash,
  strftime(max(ts) FILTER (status = 'SUCCESS'), '%Y-%m-%d %H:%M:%S') AS last_success_at FROM task_events GROUP BY 1) b""", "task_events")),
    "stream_cursor": (stream_cursor, "SELECT CASE WHEN event_id % 7 = 0 THEN '55-' || event_id ELSE CAST(event_id AS VARCHAR) END AS id FROM events WHERE event_id > 0 OR event_id % 7 = 0"),
}
