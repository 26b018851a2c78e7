"""Append-log tables for streaming upserts, without a table format.

Each micro-batch writes its own ``batch_id`` folder; a replayed batch
overwrites only that folder, which makes the sink exactly-once.  Readers keep
the newest row per key.  ``compact`` folds the log into a fresh folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_log(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    log = spark.read.option("basePath", path).parquet(path)
    return log if before is None else log.where(F.col("batch_id") < before)


def newest(log: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row per key; map-side combine keeps a hot key cheap."""
    values = [c for c in log.columns if c not in keys]
    rest = [c for c in values if c != "batch_id"]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_v")).select(*keys, "_v.*")


def read_batch(spark: SparkSession, path: str, batch_id: int, schema) -> DataFrame:
    """What one batch wrote; empty before the first."""
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")


def compact(spark: SparkSession, path: str, keys: list[str], target: str) -> None:
    newest(read_log(spark, path), keys).write.mode("overwrite").parquet(f"{target}/batch_id=0")


def run_available(stream: DataFrame, per_batch: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> list:
    """Drains what is available now through ``per_batch`` and stops; returns the progress of the last batches."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query.recentProgress
