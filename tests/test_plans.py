"""Plan shapes that must hold at scale, hot keys, and every query against its SQL twin."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tribuna.operators import layers as L
from tribuna.operators import status
from tribuna.plans import stand_ins as ST
from tribuna.plans.registry import all_queries

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return "~" if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    fn, sql = QUERIES[name]
    df = fn(spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    assert sql, "every query has a twin"
    res = duck.execute(sql)
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    ix = [names.index(c) for c in cols]
    assert got == Counter(tuple(norm(r[i]) for i in ix) for r in res.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if "stream" in n or "roundtrip" in n or n in ("csv_history", "resume_plan")}))
def test_no_cartesian_product(spark, name):
    text = plan(QUERIES[name][0](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_the_reconciliation_never_moves_the_cursor(spark, tmp_path):
    """All events count, but only the successes of microbatch tasks (every second event) set the cursor."""
    events = [(1, 40, "purchase"), (2, 20, "purchase"), (4, 90, "view"), (6, 13, "purchase")]
    spark.createDataFrame(events, "event_id bigint, user_id bigint, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(n,) for n in (11, 14, 20, 21, 41, 91)], "page_id bigint").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(r.id for r in QUERIES["cursor_filter"][0](spark, str(tmp_path)).collect()) == ["21", "41", "55-20", "91"]


def test_copies_are_reduced_on_the_map_side(spark):
    text = plan(L.dedup_latest(ST.expenses(spark, SF), L.expense_key(), ST.newest_first()))
    assert "partial_min_by" in text and " Window " not in text
    text = plan(QUERIES["first_page_copy"][0](spark, SF))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_scans_are_pruned_and_filtered(spark):
    text = plan(QUERIES["in_window"][0](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text and "GreaterThanOrEqual(ts" in text
    assert "l_comment" not in plan(QUERIES["gold_expenses_by_category"][0](spark, SF))


def test_typed_hashing_needs_no_python(spark):
    for name in ("ceap_record_uid", "enrich_pages", "bronze_records", "record_hash_diff"):
        text = plan(QUERIES[name][0](spark, SF))
        assert "Python" not in text and "Arrow" not in text


def test_counts_combine_before_the_shuffle(spark):
    text = plan(status.status_counts(ST.run_state(spark, SF), "domain"))
    assert text.count("HashAggregate") == 2 and "partial_" in text


def test_hot_keys_change_nothing(spark):
    """A third of all rows on one key: copies, state rows and events."""
    e = ST.expenses(spark, SF)
    n = e.count()
    hot = e.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("copy")).drop("copy")
    one = L.dedup_latest(e.unionByName(hot), L.expense_key(), ST.newest_first())
    base = L.dedup_latest(e, L.expense_key(), ST.newest_first())
    assert sorted(map(str, one.collect())) == sorted(map(str, base.collect()))
    s = ST.run_state(spark, SF)
    many = s.withColumn("current_pipeline_run_id", F.when(F.col("event_id") % 3 != 1, F.lit("hot")).otherwise(F.col("current_pipeline_run_id"))).withColumn("domain", F.lit("d"))
    out = status.status_counts(many, "domain").where("pipeline_run_id = 'hot'").first()
    want = Counter(r.status for r in many.where("current_pipeline_run_id = 'hot'").collect())
    assert (out.queued, out.running, out.success, out.failed, out.pending) == tuple(want[k] for k in ("QUEUED", "RUNNING", "SUCCESS", "FAILED", "PENDING"))


def test_a_hot_join_key_is_split(spark):
    """Most lines on one order: the join below the de-duplication is split, and the result holds."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ids = spark.range(0, 60000, 1, 8)
        lines = ids.select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("k"), (F.col("id") % 50).alias("line"), F.col("id").alias("v"))
        orders = spark.range(0, 60000, 1, 4).select(F.col("id").alias("ok"), F.concat(F.lit("o"), F.col("id").cast("string")).alias("o"))
        joined = lines.join(orders, lines.k == orders.ok)
        df = L.dedup_latest(joined, [F.col("k"), F.col("line")], [-F.col("v")])
        rows = df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        best = {}
        for i in range(60000):
            best[(i if i % 3 == 0 else 7, i % 50)] = i
        assert {(r.k, r.line): r.v for r in rows} == best
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
