"""Sinks.  Writes are partition-overwriting and therefore safe to replay.

``rebalance`` lets adaptive execution cut a hot partition into several files
and merge tiny ones, so a partition holding a third of all pages is written by
many tasks.  Page numbers, execution and deputy ids stay columns: one folder
per id would be millions of folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tribuna.session import cut_lineage
from tribuna.sources.keyed import KeyedTable

CRITICAL_WARNINGS = (
    "success_marker_missing",
    "task_counts_inconsistent",
    "success_marker_exists_but_status_not_completed",
)


def write_pages(pages: DataFrame, root: str, partitions: tuple[str, ...]) -> None:
    """Audited pages under run partitions; a rerun replaces its own partitions only."""
    (
        pages.hint("rebalance", *[F.col(p) for p in partitions])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False).partitionBy(*partitions).json(root)
    )


def write_jsonl(df: DataFrame, path: str, document: str | None = None) -> None:
    """JSON lines: whole rows, or one column that already holds JSON text."""
    if document is None:
        df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    else:
        df.select(F.col(document).alias("value")).write.mode("overwrite").text(path)


def write_changed(plan: DataFrame, path: str) -> int:
    """Changed-records file of a plan, written only when something changed."""
    changed = cut_lineage(changed_records(plan))
    if changed.isEmpty():
        return 0
    changed.write.mode("overwrite").json(path)
    return 1


def changed_records(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("action").startswith("enqueue")).select(
        F.col("id"), F.col("hash").alias("list_item_hash"), "endpoint", F.lit("enqueue").alias("reason")
    )


MANIFEST_STORE_DDL = "pipeline_run_id string, value string"
MARKER_STORE_DDL = "pipeline_run_id string, success_marker_path string, complete boolean"


def manifest_store(spark: SparkSession, path: str) -> KeyedTable:
    """Manifests of many runs as JSON text, by run."""
    return KeyedTable(spark, path, MANIFEST_STORE_DDL, ["pipeline_run_id"])


def marker_store(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, MARKER_STORE_DDL, ["pipeline_run_id"])


def write_manifests(manifests: DataFrame, manifest_path: str, marker_path: str, document: str | None = None) -> None:
    """Manifests and markers of the given runs; what other runs have written stays.

    Both are appended to keyed logs, so a write costs its own rows and no folder
    belongs to a run; the newest row of a run counts.  A run that is no longer
    COMPLETED gets a marker row that says so, which takes an earlier marker away.
    ``document`` names a column that holds the manifest as JSON text; without it
    the row is the manifest.  Buckets of many writes are folded on the way.
    """
    text = F.col(document) if document else F.to_json(F.struct(*manifests.columns), {"ignoreNullFields": "false"})
    # Both tables come from the same rows, whatever is lost in between; only what they store is kept for them.
    once = cut_lineage(manifests.select("pipeline_run_id", text.alias("value"), "success_marker_path", completed().alias("complete")))
    spark = once.sparkSession
    body, marks = manifest_store(spark, manifest_path), marker_store(spark, marker_path)
    body.append(once.select("pipeline_run_id", "value"))
    marks.append(once.select("pipeline_run_id", "success_marker_path", "complete"))
    body.compact()
    marks.compact()


def completed() -> Column:
    return F.coalesce(F.upper("status") == "COMPLETED", F.lit(False))


def markers(manifests: DataFrame) -> DataFrame:
    return manifests.where(completed()).select("success_marker_path", "pipeline_run_id")


def is_green(status: Column, warning_types: Column) -> Column:
    """Gate of the daily marker: COMPLETED and no critical warning."""
    return (status == "COMPLETED") & ~F.exists(warning_types, lambda w: w.isin(*CRITICAL_WARNINGS))


def summary_store(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, "reference_date string, value string", ["reference_date"])


def day_marker_store(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, "reference_date string, complete boolean", ["reference_date"])


def write_daily_summary(docs: DataFrame, path: str, marker_path: str) -> None:
    """Summary documents and markers of the given dates; other dates stay, and a day that is no longer green loses its marker.

    Keyed logs like the manifests': a write costs its own days, and no folder belongs to a day.
    """
    once = cut_lineage(docs)
    body, marks = summary_store(once.sparkSession, path), day_marker_store(once.sparkSession, marker_path)
    body.append(once.select("reference_date", F.to_json(F.struct(*once.columns)).alias("value")))
    green = F.coalesce(is_green(F.col("status"), F.col("warning_types")), F.lit(False))
    marks.append(once.select("reference_date", green.alias("complete")))
    body.compact()
    marks.compact()


def write_layer(df: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> None:
    """Bronze / Silver / Gold table as partitioned Parquet."""
    out = df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_delta(df: DataFrame, path: str, keys: list[str]) -> None:
    """MERGE into a Delta table, where the cluster has Delta."""
    try:
        from delta.tables import DeltaTable
    except ImportError as err:
        raise RuntimeError("Delta is not installed; use the merges in operators.merges") from err

    target = DeltaTable.forPath(df.sparkSession, path)
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    target.alias("t").merge(df.alias("s"), on).whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
