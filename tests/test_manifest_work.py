"""Manifests are written with no more work than they need."""

import tempfile

from pyspark.sql import functions as F

from tests.test_hashing import parts
from tribuna.operators import manifests as MF
from tribuna.plans import health
from tribuna.sources import sinks, tables

SF = "/root/testdata/sf0.001"


def test_a_manifest_is_joined_without_patterns(spark):
    """Head and blocks are cut and joined by position, also where the head ends with an object."""
    docs = MF.build_domain_manifest(health._run_rows(spark, SF), "votacoes").select("manifest")
    patterns = [p for p in parts(docs, "regexp_replace(", r"\}$")]
    assert patterns == [0, 0]
    df = spark.range(1).select(F.lit("r").alias("run"))
    got = MF.build_manifest(df, {"pipeline_run_id": F.col("run"), "target_year": F.lit(2024)}, always={"last": F.struct(F.lit(1).alias("a"))}).first().manifest
    assert got.endswith('"last":{"a":1},"target_year":2024}')


def test_only_what_is_stored_is_kept(spark, monkeypatch):
    """The rows that both stores are written from hold the text and the marker, not the manifest's columns beside them."""
    kept, cut = [], sinks.cut_lineage
    monkeypatch.setattr(sinks, "cut_lineage", lambda df: kept.append(df.columns) or cut(df))
    m, k = (f"{tempfile.mkdtemp(prefix='spark-')}/{n}" for n in "mk")
    sinks.write_manifests(MF.build_ceap_manifest(health._run_rows(spark, SF)), m, k, "manifest")
    assert kept == [["pipeline_run_id", "value", "success_marker_path", "complete"]]
    done = health._run_rows(spark, SF).where(sinks.completed()).count()
    assert tables.read_markers(spark, k).count() == done > 0
