"""Status counts, merges, run decisions, the task state machine and its stream."""

import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tribuna.operators import merges, status
from tribuna.operators import maintenance as M
from tribuna.streaming import task_state as TS

STATE = ("domain string, row_key string, status string, current_pipeline_run_id string, last_pipeline_run_id string, "
         "record_count string, last_successful_page string")


def test_counts_cover_current_and_last_run_once(spark):
    rows = [("d", "a", "success", "r1", "r1", "5", "2"), ("d", "b", "QUEUED", "r2", "r1", None, None), ("d", "c", "weird", "r1", "", "x", "x"),
            ("d", "e", "SUCCESS", "r2", None, "bad", "3"), ("d", "f", None, None, "r2", None, None)]
    out = {r.pipeline_run_id: r for r in status.status_counts(spark.createDataFrame(rows, STATE), "domain").collect()}
    assert (out["r1"].success, out["r1"].queued, out["r1"].other, out["r1"].record_count_sum, out["r1"].pages_written_sum) == (1, 1, 1, 5, 2)
    assert (out["r2"].success, out["r2"].queued, out["r2"].other, out["r2"].record_count_sum, out["r2"].pages_written_sum) == (1, 1, 1, 0, 3)


COUNTS = {"queued": 0, "running": 0, "success": 0, "failed": 0, "poison": 0, "pending": 0, "stale": 0, "other": 0}


def decide(spark, expr, **values):
    row = {**COUNTS, **values}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'bigint'}" for k, v in row.items()))
    return df.select(expr.alias("x")).first().x


def ceap(spark, done, queued_so_far=1, **counts):
    exp = status.expected_tasks_ceap(F.lit(done), F.lit(0), F.lit(queued_so_far), F.lit(0))
    return decide(spark, status.run_status_ceap(F.lit(done), exp, F.lit(queued_so_far)), **counts)


def test_expense_run_status(spark):
    assert ceap(spark, True, success=3) == "COMPLETED"
    assert ceap(spark, True, 0) == "COMPLETED"
    assert ceap(spark, True, success=2, failed=1) == "PARTIAL"
    assert ceap(spark, True, poison=1) == "FAILED"
    assert ceap(spark, True, running=1, success=4) == "RUNNING"
    assert ceap(spark, True, queued=1, failed=1) == "QUEUED"
    assert ceap(spark, False, success=3) == "QUEUING"


def domain(spark, n_fanout, enqueued=0, skipped_queued=0, skipped_same_hash=0, **counts):
    tick = {"n_fanout": n_fanout, "enqueued": enqueued, "skipped_queued": skipped_queued, "skipped_same_hash": skipped_same_hash}
    phase = status.enqueue_phase_complete(F.lit(True), F.lit(False))
    return decide(spark, status.run_status_domain(phase, status.expected_tasks_domain(F.col("n_fanout"))), **counts, **tick)


def test_domain_run_status_is_a_fixpoint(spark):
    assert domain(spark, 4, enqueued=4, queued=4) == "RUNNING"
    assert domain(spark, 4, skipped_same_hash=4) == "COMPLETED"
    assert domain(spark, 4, skipped_same_hash=2, skipped_queued=2, success=2, running=2) == "RUNNING"
    assert domain(spark, 0) == "COMPLETED"
    assert domain(spark, 4, skipped_same_hash=2, failed=2) == "QUEUING"


def test_merge_keeps_and_replace_removes(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, s string, e string")
    delta = spark.createDataFrame([(1, None, "new"), (3, "c", None)], "k int, s string, e string")
    assert sorted(map(tuple, merges.upsert_merge(base, delta, ["k"]).collect())) == [(1, "a", "new"), (2, "b", "y"), (3, "c", None)]
    delta = spark.createDataFrame([(1, "z", None, ["e"]), (2, None, None, None)], "k int, s string, e string, cleared array<string>")
    assert sorted(map(tuple, merges.upsert_replace(base, delta, ["k"]).collect())) == [(1, "z", None), (2, "b", "y")]


def test_counters_recover(spark):
    runs = spark.createDataFrame(
        [("r1", "PARTIAL", 3, 0, 2, 0, "t", "boom"), ("r2", "QUEUED", 0, 4, 0, 0, "", ""), ("r3", "QUEUED", 2, 0, 0, 0, "", "")],
        "pipeline_run_id string, status string, total_tasks_expected int, total_tasks_queued int, total_tasks_success int, total_tasks_failed int, failed_at string, last_error string",
    ).withColumns({"completed_at": F.lit(None).cast("string"), "last_recovered_at": F.lit(None).cast("string")})
    out = spark.createDataFrame([("r1", True), ("r2", True), ("r3", True), ("r3", False), ("ghost", True)], "pipeline_run_id string, ok boolean")
    got = {r.pipeline_run_id: r for r in status.merge_counters(runs, out, F.lit("now"), ["pipeline_run_id"]).collect()}
    assert set(got) == {"r1", "r2", "r3"}
    assert (got["r1"].status, got["r1"].last_recovered_at, got["r1"].failed_at, got["r1"].total_tasks_success) == ("COMPLETED", "now", "", 3)
    assert (got["r2"].status, got["r2"].completed_at) == ("RUNNING", None)
    assert (got["r3"].status, got["r3"].total_tasks_failed, got["r3"].completed_at) == ("PARTIAL", 1, "now")


def fold_by_hand(events):
    """Plain transition loop over one task's events in order."""
    s = {"cur": None, "last": None, "status": None, "att": 0, "poison": 0, "rc": None, "hash": None}
    for ts, seq, st, run, rc, h in events:
        if st in ("QUEUED", "RUNNING"):
            s["last"] = s["cur"]
        s["att"] += st == "RUNNING"
        s["poison"] += st == "POISON"
        if st == "SUCCESS":
            s["rc"], s["hash"] = rc, h
        s["cur"], s["status"] = run, st
    return s


def make_events(seed, tasks=12, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"t{rnd.randrange(tasks)}"  # a third of all events on one task
        rows.append((key, i // 4, i, rnd.choice(["QUEUED", "RUNNING", "SUCCESS", "FAILED", "POISON"]), f"r{rnd.randrange(5)}", rnd.randrange(99), f"h{i}"))
    return rows


EVENTS = "row_key string, ts bigint, seq bigint, status string, run_id string, record_count int, hash string"


def check(rows, out):
    want = {}
    for key in {r[0] for r in rows}:
        want[key] = fold_by_hand([r[1:] for r in rows if r[0] == key])
    got = {r.row_key: r for r in out.collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert (g.status, g.current_pipeline_run_id, g.last_pipeline_run_id, g.attempt_count, g.reprocess_count, g.record_count, g.last_list_item_hash) == (
            w["status"], w["cur"], w["last"], w["att"], w["poison"], w["rc"], w["hash"]), k


def test_fold_equals_the_transition_loop(spark):
    rows = make_events(1)
    check(rows, TS.fold(spark.createDataFrame(rows, EVENTS), ["row_key"]))


def test_stream_over_many_batches_equals_the_loop(spark):
    rows = make_events(2)
    src, out, cp = (tempfile.mkdtemp(prefix="spark-") for _ in range(3))
    for i in range(5):  # five files, one micro-batch each, in arrival order
        spark.createDataFrame(rows[i * 80:(i + 1) * 80], EVENTS).coalesce(1).write.mode("append").parquet(f"{src}/in")
    feed = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{src}/in")
    TS.stream_states(feed, ["row_key"], f"{out}/log", cp)
    assert [s for s, _ in TS.state_table(spark, f"{out}/log", ["row_key"]).live()[-1:]] == [8]
    check(rows, TS.current(spark, f"{out}/log", ["row_key"]))


@pytest.mark.parametrize("cuts,full", [(1, 8), (3, 2), (7, 2), (10, 3)])
def test_folding_and_batch_borders_change_nothing(spark, cuts, full):
    """Events in order of time, cut into batches anywhere; full buckets are folded on the way."""
    rows = make_events(3)
    src, out, cp = (tempfile.mkdtemp(prefix="spark-") for _ in range(3))
    edges = sorted({0, len(rows), *random.Random(cuts).sample(range(1, len(rows)), cuts - 1)})
    for a, z in zip(edges, edges[1:]):
        spark.createDataFrame(rows[a:z], EVENTS).coalesce(1).write.mode("append").parquet(f"{src}/in")
    feed = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{src}/in")
    TS.stream_states(feed, ["row_key"], f"{out}/log", cp, full=full)
    table = TS.state_table(spark, f"{out}/log", ["row_key"])
    writes = Counter(b for _, b in table.live())
    assert max(writes.values()) < max(full, 2)
    check(rows, TS.current(spark, f"{out}/log", ["row_key"]))


def test_requeue_and_resume(spark):
    rows = [("a", "QUEUED", "2026-01-01 10:00:00", None, "r"), ("b", "QUEUED", "2026-01-01 11:30:00", 2, "r"), ("c", "QUEUED", None, 1, "r"),
            ("d", "RUNNING", "2026-01-01 09:00:00", 0, "r"), ("e", "QUEUED", "2026-01-01 10:00:00", 3, "other")]
    s = spark.createDataFrame(rows, "row_key string, status string, t string, stale_requeue_count int, current_pipeline_run_id string")
    s = s.withColumn("last_dispatched_at", F.col("t").cast("timestamp_ntz"))
    out = TS.requeue_stale(s, F.lit("r"), F.lit("2026-01-01 11:00:00").cast("timestamp_ntz"), 60)
    got = {r.row_key: (r.requeued, r.stale_requeue_count) for r in out.collect()}
    assert got == {"a": (True, 1), "b": (False, 2), "c": (False, 1), "d": (False, 0), "e": (False, 3)}
    p = spark.createDataFrame([("RUNNING", "r", "4"), ("RUNNING", "q", "4"), ("SUCCESS", "r", "4"), ("RUNNING", "r", None)], "status string, current_pipeline_run_id string, last_successful_page string")
    assert [x[0] for x in p.select(TS.resume_page(F.lit("r"))).collect()] == [5, 1, 1, 1]


def test_reconcile_recovers(spark):
    state = spark.createDataFrame([("d", "a", "SUCCESS", "r1", None, "5", "1"), ("d", "b", "SUCCESS", "r1", None, "6", "2"), ("d", "c", "FAILED", "r2", None, None, None)], STATE)
    runs = spark.createDataFrame([("d", "r1", "PARTIAL", 9, True, "f", "e", None), ("d", "r2", "FAILED", 1, True, "f", "e", None), ("d", "r3", "", 4, False, "", "", None)],
                                 "domain string, pipeline_run_id string, status string, total_tasks_expected int, enqueue_phase_complete boolean, failed_at string, last_error string, completed_at string")
    got = {r.pipeline_run_id: r for r in status.reconcile_runs(state, runs, F.lit("now"), ["domain", "pipeline_run_id"]).collect()}
    assert (got["r1"].status, got["r1"].write_marker, got["r1"].last_recovered_at, got["r1"].record_count_sum) == ("COMPLETED", True, "now", 11)
    assert (got["r2"].status, got["r2"].failed_at, got["r2"].write_marker) == ("FAILED", "f", False)
    assert (got["r3"].status, got["r3"].total_tasks_expected) == ("UNKNOWN", 4)


def test_replay_keeps_other_rows(spark):
    state = spark.createDataFrame([("d", "a", "FAILED", "r1", "r0", "5", "7"), ("d", "b", "SUCCESS", "r1", "r0", "6", "2")], STATE).withColumns(
        {"last_error": F.lit("x"), "last_dispatched_at": F.lit(None).cast("string"), "last_successful_page": F.col("last_successful_page").cast("int")})
    out = M.replay(state, M.select_for_replay(state), "rx", F.lit("now"), full=True)
    got = {r.row_key: r for r in out.collect()}
    assert (got["a"].status, got["a"].current_pipeline_run_id, got["a"].last_pipeline_run_id, got["a"].last_successful_page, got["a"].last_error) == ("QUEUED", "rx", "r1", 0, "")
    assert (got["b"].status, got["b"].last_successful_page, got["b"].last_error) == ("SUCCESS", 2, "x")
