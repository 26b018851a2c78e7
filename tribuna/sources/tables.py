"""Control tables: manifests, markers, task state, runs, fingerprints, messages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tribuna.functions import scalars as S
from tribuna.schemas import MANIFEST_DDL, MESSAGE_DDL
from tribuna.sources import sinks


def read_manifests(spark: SparkSession, globs: list[str] | str) -> DataFrame:
    """Run manifests with the fixed contract; a missing file is simply an absent row.

    Reads JSON files by glob, or the store that :func:`sinks.write_manifests` keeps.
    """
    store = sinks.manifest_store(spark, globs) if isinstance(globs, str) else None
    if store is not None and "*" not in globs and store.live():
        parsed = F.from_json("value", MANIFEST_DDL + ", _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
        return store.newest().select(parsed.alias("m")).select("m.*", F.lit(globs).alias("metadata_path"))
    return (
        spark.read.schema(MANIFEST_DDL + ", _corrupt_record string").option("multiLine", False)
        .json(globs).withColumn("metadata_path", F.col("_metadata.file_path")).drop("run")
    )


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """Marker table; Spark cannot list files whose name starts with ``_``."""
    rows = sinks.marker_store(spark, path).newest()
    return rows.where("complete").select("success_marker_path", "pipeline_run_id").distinct()


def read_daily_summaries(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Summary documents by day, with the given fields."""
    docs = sinks.summary_store(spark, path).newest()
    return docs.select("reference_date", F.from_json("value", ddl).alias("d")).select("reference_date", "d.*")


def read_day_markers(spark: SparkSession, path: str) -> DataFrame:
    """Days whose summary is green."""
    return sinks.day_marker_store(spark, path).newest().where("complete").select("reference_date")


def read_state(spark: SparkSession, path: str, domain: str | None = None, run_id: str | None = None) -> DataFrame:
    """Latest version of a state table, filtered on domain and on current OR last run.

    State lies in hash buckets of its domains, so the domain filter prunes folders, and
    within a bucket row groups; the run filter is pushed to the Parquet reader.
    """
    state = _stored(spark, path)
    if domain is not None:
        if BUCKET in state.columns:
            state = state.where(F.col(BUCKET) == _bucket([F.lit(domain)]))
        state = state.where(F.col("domain") == domain)
    state = state.drop(BUCKET)
    return tied_to_run(state, run_id) if run_id is not None else state


def tied_to_run(state: DataFrame, run_id: str) -> DataFrame:
    return state.where(
        (F.col("current_pipeline_run_id") == run_id) | (F.col("last_pipeline_run_id") == run_id)
    )


#: Folders of a version that is written by keys: a bound, whatever the number of keys.
VERSION_BUCKETS = 64
BUCKET = "_bucket"


def _bucket(keys: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(VERSION_BUCKETS)).cast("int")


def write_version(df: DataFrame, path: str, version: int, partition_by: tuple[str, ...] = ()) -> None:
    """Writes one immutable version folder; rewriting a version replaces only it.

    ``partition_by`` names the keys that are looked up: their rows lie in folders by hash bucket, in the keys' order.
    """
    folder = f"{path}/version={version:08d}"
    if not partition_by:
        df.write.mode("overwrite").parquet(folder)
        return
    placed = df.withColumn(BUCKET, _bucket([F.col(p) for p in partition_by])).hint("rebalance", F.col(BUCKET))
    placed.sortWithinPartitions(BUCKET, *partition_by).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)


def latest_version(spark: SparkSession, path: str) -> int | None:
    """Newest version folder, from the folder names alone; None before the first write."""
    try:
        listed = spark.read.format("binaryFile").option("basePath", path).load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return listed.agg(F.max("version").alias("v")).first().v if "version" in listed.columns else None


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return _stored(spark, path, version).drop(BUCKET)


def _stored(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    version = latest_version(spark, path) if version is None else version
    if version is None:
        raise ValueError(f"no version below {path}")
    return spark.read.parquet(f"{path}/version={int(version):08d}")


def by_status(table: DataFrame, *statuses: str) -> DataFrame:
    """Runs, snapshots or controls in the given statuses."""
    return table.where(F.upper("status").isin(*[s.upper() for s in statuses]))


def explode_fingerprints(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """``{"fingerprints": {id: {uid, hash}}}`` to rows; entries that are not objects are skipped."""
    entries = F.from_json(F.get_json_object(raw, "$.fingerprints"), "map<string,string>")
    entry = F.from_json(F.col("value"), "uid string, hash string")
    return (
        docs.select(F.explode(entries).alias("id", "value"))
        .where(F.ltrim("value").startswith("{"))
        .select("id", _or_blank(entry.getField("uid")).alias("uid"), _or_blank(entry.getField("hash")).alias("hash"))
    )


def _or_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def message_text(body: Column) -> Column:
    """Message body as JSON text: plain JSON, base64 of it, or the text as it is."""
    decoded = F.try_to_binary(body, F.lit("base64")).cast("string")
    return F.when(F.try_parse_json(body).isNotNull(), body).otherwise(F.coalesce(decoded, body))


def parse_messages(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds the message fields; a body that is not JSON leaves them null."""
    text = message_text(F.col(body))
    parsed = F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, MESSAGE_DDL))
    return df.withColumn("_m", parsed).select(
        *df.columns,
        F.trim("_m.domain").alias("domain"),
        F.trim("_m.endpoint").alias("endpoint"),
        F.trim("_m.pipeline_run_id").alias("pipeline_run_id"),
        F.trim(F.coalesce("_m.run_type", F.lit("snapshot"))).alias("run_type"),
        F.col("_m.payload").alias("payload"),
    )


def messages_for_run(messages: DataFrame, run_id: str, body: str = "body") -> DataFrame:
    text = message_text(F.col(body))
    return messages.where(F.trim(F.get_json_object(text, "$.pipeline_run_id")) == run_id.strip())


def raw_files_for_run(paths: DataFrame, run_id: str, col: str = "path") -> DataFrame:
    """Data files of a run; manifest files never match."""
    import re

    safe = re.sub(S.SAFE_SEGMENT, "_", run_id)
    p = F.replace(F.col(col), F.lit("\\"), F.lit("/"))
    hit = p.contains(f"pipeline_run_id={run_id}") | p.contains(f"pipeline_run_id={safe}")
    return paths.where(hit & ~p.contains("_metadata/"))
