"""Ten-minute micro-batches over a list feed: windows, late rows, cursor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tribuna.functions.scalars import numeric_id
from tribuna.operators.fanout import after_cursor
from tribuna.session import work_path
from tribuna.streaming import table_log

RUN_PREFIX = "votacoes_microbatch_"


def read_feed(spark: SparkSession, path: str, schema, glob: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """File stream of one feed: a table's folder, one file, or with ``glob`` the matching files of a folder that holds others.

    A micro-batch takes ``files_per_trigger`` files, so a long backlog is many batches.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def windowed_runs(feed: DataFrame, ts: str = "ts", minutes: int = 10) -> DataFrame:
    """Run id per tumbling window with its record count and largest id.

    The run id is the window start, so a retried tick lands on the same run.
    """
    w = F.window(F.col(ts).cast("timestamp"), f"{minutes} minutes")
    return (
        feed.groupBy(w.alias("w"))
        .agg(F.count(F.lit(1)).alias("records"), F.max("id").alias("max_id"))
        .select(
            F.concat(F.lit(RUN_PREFIX), F.date_format("w.start", "yyyyMMddHHmm")).alias("pipeline_run_id"),
            F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("window_start"), "records", "max_id",
        )
    )


def stream_runs(feed: DataFrame, path: str, checkpoint: str, minutes: int = 10) -> None:
    """Each batch adds what it has of every window; :func:`current_runs` sums it up.

    A row that comes late, however late, adds to its window: no state, no watermark.
    """
    table_log.run_available(feed, lambda df, i: table_log.write_batch(windowed_runs(df, minutes=minutes), path, i), checkpoint)


def current_runs(spark: SparkSession, path: str) -> DataFrame:
    parts = table_log.read_log(spark, path).groupBy("pipeline_run_id", "window_start")
    return parts.agg(F.sum("records").alias("records"), F.max("max_id").alias("max_id"))


def stream_dedup(feed: DataFrame, path: str, checkpoint: str) -> list:
    """Drops rows re-read by the overlapping window, by uid and hash, against all that earlier batches kept.

    The pairs seen are the state of the stream, in RocksDB: a batch looks up its
    own pairs and saves the new ones, so what it reads does not grow with the
    batches before it.  There is no watermark, as a copy may come however late.
    """
    return table_log.run_available(
        feed.dropDuplicates(["uid", "hash"]), lambda df, i: table_log.write_batch(df, path, i), checkpoint)


def reconcile_batch(full: DataFrame, processed: DataFrame) -> DataFrame:
    """Periodic re-read of the whole feed: rows whose (uid, hash) was never processed."""
    return full.dropDuplicates(["uid", "hash"]).join(
        processed.select("uid", "hash"), ["uid", "hash"], "left_anti"
    )


def _digests(df: DataFrame, day: str, buckets: int) -> DataFrame:
    """Order-free digest per day and bucket: the number of rows and the sum of their hashes, added up before the shuffle."""
    h = F.xxhash64("uid", "hash")
    return df.groupBy(F.col(day).alias("day"), F.pmod(h, F.lit(buckets)).cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("s"))


def changed_parts(full: DataFrame, processed: DataFrame, day: str = "day", buckets: int = 64) -> DataFrame:
    """``day, bucket`` whose rows are not the processed ones."""
    a, b = _digests(full, day, buckets).alias("a"), _digests(processed, day, buckets).alias("b")
    on = F.col("a.day").eqNullSafe(F.col("b.day")) & (F.col("a.bucket") == F.col("b.bucket"))
    same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.s").eqNullSafe(F.col("b.s"))
    return a.join(b, on, "left").where(~same).select("a.day", "a.bucket")


def rows_of(df: DataFrame, parts: DataFrame, day: str = "day", buckets: int = 64) -> DataFrame:
    """Rows of the given days and buckets."""
    p = parts.select(F.col("day").alias("_day"), F.col("bucket").alias("_bucket"))
    mine = F.pmod(F.xxhash64("uid", "hash"), F.lit(buckets)).cast("int")
    return df.join(p, F.col(day).eqNullSafe(F.col("_day")) & (mine == F.col("_bucket")), "left_semi")


def reconcile_by_digest(full: DataFrame, processed: DataFrame, day: str = "day", buckets: int = 64) -> DataFrame:
    """The rows of :func:`reconcile_batch`, moving only what changed.

    Both sides are reduced to digests; only days and buckets whose digests
    differ take part further.  Each step is written, so the planner knows its
    size: while little has changed, both big sides are filtered by a broadcast
    of it and nothing of an unchanged day is shuffled; when much has, Spark
    shuffles as it would have anyway.
    """
    spark = full.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = work_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    parts = written(changed_parts(full, processed, day, buckets), "changed-parts")
    fresh = written(rows_of(full, parts, day, buckets).dropDuplicates(["uid", "hash"]), "changed-rows")
    keys = fresh.select("uid", "hash")
    seen = processed.select("uid", "hash").join(keys, ["uid", "hash"], "left_semi").distinct()
    return fresh.join(seen, ["uid", "hash"], "left_anti")


ROWS_DDL = "id string, attempt int, status string"


def _always_done(offered: DataFrame) -> DataFrame:
    return offered.withColumn("status", F.lit("SUCCESS"))


def stream_after_cursor(feed: DataFrame, path: str, checkpoint: str, outcomes: Callable[[DataFrame], DataFrame] = _always_done) -> None:
    """Offers the ids above the cursor at each tick, and moves the cursor by what succeeded.

    A tick offers its own ids and those that failed at the tick before; ids at or
    below the cursor are left out, text ids never are.  ``outcomes`` gives the
    offered rows (``id, attempt``) their ``status``, by a join with what the
    workers reported, say.  The cursor is the largest numeric id that ended in
    SUCCESS and never moves back, so a failed id above it is offered again.

    ``path/rows`` holds what was offered with its outcome, ``path/cursor`` a row
    per tick.  A tick reads the folders of the tick before it and nothing older,
    and a replayed tick sees the same.
    """
    def tick(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        rows, cursors = f"{path}/rows", f"{path}/cursor"
        before = table_log.read_batch(spark, cursors, batch_id - 1, "cursor bigint").first()
        old = before.cursor if before else 0
        failed = table_log.read_batch(spark, rows, batch_id - 1, ROWS_DDL).where("status <> 'SUCCESS'")
        again = failed.select("id", (F.col("attempt") + 1).alias("attempt"))
        offered = df.select("id", F.lit(1).alias("attempt")).unionByName(again).groupBy("id").agg(F.max("attempt").alias("attempt"))
        table_log.write_batch(outcomes(after_cursor(offered, F.lit(old))).select("id", "attempt", "status"), rows, batch_id)
        done = table_log.read_batch(spark, rows, batch_id, ROWS_DDL).where("status = 'SUCCESS'")
        top = F.greatest(F.coalesce(F.max(numeric_id(F.col("id"))), F.lit(0)), F.lit(old)).cast("bigint")
        table_log.write_batch(done.agg(top.alias("cursor")), cursors, batch_id)

    table_log.run_available(feed, tick, checkpoint)
