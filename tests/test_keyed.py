"""Keyed tables: numbered writes, newest rows, copy on write, compaction, half-written commits."""

import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from tribuna.operators import merges
from tribuna.sources import sinks, tables
from tribuna.sources.keyed import KeyedTable

DDL = "k string, v bigint"


def table(spark, buckets=4):
    return KeyedTable(spark, f"{tempfile.mkdtemp(prefix='spark-')}/t", DDL, ["k"], buckets)


def put(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def got(df):
    return sorted((r.k, r.v) for r in df.collect())


def folders(t):
    return sorted(str(p.relative_to(t.path)) for p in Path(t.path).glob("rows/seq=*/bucket=*"))


def test_newest_row_of_a_key_counts(spark):
    t = table(spark)
    assert got(t.newest()) == [] and t.live() == [] and t.next_seq() == 0
    t.append(put(spark, *[(f"k{i}", i) for i in range(40)], (None, 1)))
    t.append(put(spark, ("k3", 300), (None, 2)))
    t.append(put(spark))
    assert [r.v for r in t.newest().where("k is null").collect()] == [2]
    want = dict([(f"k{i}", i) for i in range(40)], k3=300)
    assert dict(got(t.newest().where("k is not null"))) == want


def test_a_repeated_write_replaces_itself_and_a_lost_one_is_not_read(spark):
    t = table(spark)
    t.append(put(spark, ("a", 1)), 0)
    t.append(put(spark, ("b", 1), ("c", 1)), 1)
    t.append(put(spark, ("b", 2)), 1)
    assert got(t.newest()) == [("a", 1), ("b", 2)]
    put(spark, ("z", 9)).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{t.path}/rows/seq=7")
    assert got(t.newest()) == [("a", 1), ("b", 2)] and t.next_seq() == 2


def test_folders_follow_writes_and_not_keys(spark):
    t = table(spark)
    t.append(spark.range(5000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")))
    assert len(folders(t)) == 4


def test_a_delta_of_one_key_rewrites_one_bucket(spark):
    t = table(spark, 8)
    base = spark.range(200).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    t.upsert(base, lambda old, new: merges.upsert_merge(old, new, ["k"]))
    before = folders(t)
    hit = t.upsert(put(spark, ("k7", 700)), lambda old, new: merges.upsert_merge(old, new, ["k"]))
    assert len(hit) == 1 and sorted(set(folders(t)) - set(before)) == [f"rows/seq=1/bucket={hit[0]}"]
    assert dict(got(t.newest())) == dict([(f"k{i}", i) for i in range(200)], k7=700)
    assert len(t.live()) == 8 and t.live()[-1] == (1, hit[0])


def test_a_repeated_upsert_sees_what_was_there_before_it(spark):
    t = table(spark, 2)
    merge = lambda old, new: merges.upsert_merge(old, new, ["k"])
    t.upsert(put(spark, *[(f"k{i}", i) for i in range(20)]), merge, 0)
    for _ in range(2):
        t.upsert(put(spark, ("k1", 100), ("k2", 200)), merge, 1)
    again = KeyedTable(spark, t.path, DDL, ["k"], 2)
    again.upsert(put(spark, ("k1", 100), ("k2", 200)), merge, 1)
    assert got(again.newest()) == got(t.newest()) == sorted({**{f"k{i}": i for i in range(20)}, "k1": 100, "k2": 200}.items())


def test_compaction_folds_full_buckets_only_and_changes_no_answer(spark):
    t = table(spark, 4)
    t.append(put(spark, *[(f"k{i}", i) for i in range(30)]))
    for j in range(3):
        t.append(put(spark, ("k1", 100 + j)))
    want = got(t.newest())
    due = t.compact(full=3)
    assert len(due) == 1 and got(t.newest()) == want
    assert sorted(b for _, b in t.live()) == [0, 1, 2, 3] and t.compact(full=3) == []
    sums = table(spark, 2)
    for j in range(4):
        sums.append(put(spark, ("a", 1), (f"b{j}", 5)))
    total = lambda rows: rows.groupBy("k").agg(F.sum("v").alias("v"))
    want = got(total(sums.rows()))
    sums.compact(fold=total, full=2)
    assert got(total(sums.rows())) == want == [("a", 4), ("b0", 5), ("b1", 5), ("b2", 5), ("b3", 5)]


def test_manifests_of_many_runs_share_folders(spark):
    root = tempfile.mkdtemp(prefix="spark-")
    m, k = f"{root}/m", f"{root}/k"
    schema = "pipeline_run_id string, status string, success_marker_path string"
    for j in range(3):
        rows = [(f"r{i}", "COMPLETED" if j != 1 or i % 2 else "FAILED", f"p{i}") for i in range(j, 300)]
        sinks.write_manifests(spark.createDataFrame(rows, schema), m, k)
    assert len(list(Path(m).glob("rows/seq=*/bucket=*"))) <= 3 * 16
    assert {r.pipeline_run_id: r.status for r in tables.read_manifests(spark, m).collect()} == {f"r{i}": "COMPLETED" for i in range(300)}
    assert tables.read_markers(spark, k).count() == 300
