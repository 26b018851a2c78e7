"""Page scans: page-per-file JSON, JSON-lines snapshots, annual CSV files.

The raw text of every page is kept beside its parsed form, so unknown fields
survive and hashes can be taken over what the API actually sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tribuna.functions import scalars as S
from tribuna.schemas import page_schema

PAGE_FILE = r"(?i)page_([0-9]+)\.json$"


def _parsed(text: DataFrame, record) -> DataFrame:
    schema = page_schema(record)
    body = F.from_json("raw", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return text.withColumn("_body", body).select(
        *[c for c in text.columns], "_body.dados", "_body.links", F.col("_body._corrupt_record").alias("corrupt")
    )


def read_pages(spark: SparkSession, root: str, record, partitions: list[str], page_files: bool = True) -> DataFrame:
    """Pages below ``root/<first partition>=*``: one document per file, or one per line.

    The explicit first-level glob keeps ``_metadata`` folders out of partition
    discovery; partition values are strings, so ``04`` stays ``04``.  With
    ``page_files`` only ``page_<n>.json`` files count and ``page`` is their number.
    """
    schema = ", ".join(["value string"] + [f"`{p}` string" for p in partitions])
    text = (
        spark.read.schema(schema).option("wholetext", page_files).option("basePath", root)
        .text(f"{root}/{partitions[0]}=*")
        .withColumn("raw_path", F.col("_metadata.file_path"))
        .withColumnRenamed("value", "raw")
    )
    if page_files:
        text = text.withColumn("page", F.regexp_extract("raw_path", PAGE_FILE, 1).try_cast("int"))
        text = text.where(F.col("page").isNotNull())
    return _parsed(text, record)


def read_pages_jsonl(spark: SparkSession, path: str, record) -> DataFrame:
    """JSON-lines snapshot, one page per line: splittable, so large files scale out."""
    text = spark.read.text(path).withColumnRenamed("value", "raw").withColumn("raw_path", F.col("_metadata.file_path"))
    return _parsed(text, record)


def first_page_copy(pages: DataFrame, keys: list[str], page: str = "page", path: str = "raw_path") -> DataFrame:
    """One copy per page number when several executions wrote it: the smallest path.

    ``row_number = 1`` compiles to a group limit on the map side, so a page
    with very many copies ships one row per task.
    """
    from pyspark.sql import Window

    order = Window.partitionBy(*keys, page).orderBy(path)
    return pages.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def deputies_from_snapshot(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Deputy items of a snapshot, first page copies only, items without id dropped."""
    one = first_page_copy(pages, keys)
    return (
        one.select(*keys, "page", F.posexplode("dados").alias("pos", "item"))
        .where(F.col("item.id").isNotNull())
    )


def read_ceap_csv(spark: SparkSession, path: str, schema: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Annual expense CSV files with an explicit schema (no inference pass)."""
    return (
        spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding)
        .option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"').csv(path)
    )


def discover_runs(paths: DataFrame, yyyymmdd: str | None = None, col: str = "path") -> DataFrame:
    """Run ids found in ``pipeline_run_id=`` path segments, optionally of one day."""
    runs = paths.select(S.path_value(F.col(col), "pipeline_run_id").alias("pipeline_run_id"))
    runs = runs.where(F.col("pipeline_run_id").isNotNull())
    if yyyymmdd:
        runs = runs.where(F.col("pipeline_run_id").contains(yyyymmdd))
    return runs.distinct()
