"""The corpus pipeline: documents in, packed training sequences out.

Each stage gets what its predecessor kept, from Parquet.  All but the last
return the columns of ``documents``; the last returns the pieces of the
documents with their bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tribuna.llm import jaccard, linededup, mixing, packing, quality
from tribuna.llm.common import lean
from tribuna.session import prepare, read_table, work_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break the base rules, or whose host is rejected, go."""
    prepare(spark)
    lean(spark)
    return quality.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites are cut from all documents but the first; ``n_chars`` follows the text."""
    prepare(spark)
    lean(spark)
    cut = linededup.dedup_lines(docs)
    length = F.when(F.col("__n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.select(*[length.alias(c) if c == "n_chars" else cut[c] for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    prepare(spark)
    lean(spark)
    return jaccard.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document that is taken twice stands twice."""
    prepare(spark)
    lean(spark)
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of fixed length; no two copies of a document in one."""
    prepare(spark)
    lean(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packed", packed),
]

#: The shuffled order of the mixture has no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; what is between them is written below the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
