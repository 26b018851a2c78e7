"""Fan-out actions, budgets, cursors and ordinals against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tribuna.operators import batches, budget, fanout
from tribuna.operators import fingerprints as FP
from tribuna.plans.registry import all_queries

STATE = "row_key string, status string, current_pipeline_run_id string, last_list_item_uid string, last_list_item_hash string, attempt_count int"


def actions(df, *cols):
    return {tuple(r[:-1]): r[-1] for r in df.select(*cols, "action").collect()}


def test_hash_aware_plan(spark):
    ids = spark.createDataFrame([("1", "h1"), ("2", "h2"), ("3", ""), ("4", "h4")], "id string, hash string")
    state = spark.createDataFrame([
        ("a|1", "queued", "run", None, "h1", 0), ("a|2", "SUCCESS", "old", None, "h2", 1), ("a|3", "SUCCESS", "old", None, "", 1),
        ("a|4", "SUCCESS", "run", None, "other", 1), ("b|1", "QUEUED", "old", None, "h1", 0), ("b|2", "FAILED", "run", None, "h2", 0)], STATE)
    got = actions(fanout.plan_hash_aware(ids, ("a", "b"), state, "run"), "id", "endpoint")
    assert got == {("1", "a"): "skip_queued", ("2", "a"): "skip_same_hash", ("3", "a"): "enqueue", ("4", "a"): "enqueue",
                   ("1", "b"): "enqueue", ("2", "b"): "enqueue", ("3", "b"): "enqueue", ("4", "b"): "enqueue"}
    assert actions(fanout.plan_hash_aware(ids, ("a",), state, "run", force=True), "id")[("2",)] == "enqueue"


def test_votes_need_uid_and_hash(spark):
    ids = spark.createDataFrame([("1", "u1", "h1"), ("2", "u2", "h2")], "id string, uid string, hash string")
    state = spark.createDataFrame([("votacao_votos|1", "SUCCESS", "old", "u1", "h1", 0), ("votacao_votos|2", "SUCCESS", "old", "zz", "h2", 0)], STATE)
    plan = fanout.plan_votacoes(ids, state, "run")
    assert actions(plan, "id") == {("1",): "skip_same_hash", ("2",): "enqueue"}
    patch = fanout.dispatch_patch(plan, "run", F.lit("now")).collect()
    assert [(p.row_key, p.last_pipeline_run_id, p.last_list_item_uid, p.last_error) for p in patch] == [("votacao_votos|2", "old", "u2", "")]


def test_institucional_plan_looks_at_this_run_only(spark):
    parents = spark.createDataFrame([("legislaturas_parent", "57"), ("orgaos_parent", "9")], "kind string, id string")
    state = spark.createDataFrame([("legislatura_mesa|57", "SUCCESS", "run", None, None, 0), ("orgao_membros|9", "SUCCESS", "old", None, None, 0),
                                   ("legislatura_lideres|57", "RUNNING", "run", None, None, 0)], STATE)
    assert actions(fanout.plan_institucional(parents, state, "run"), "endpoint") == {
        ("legislatura_mesa",): "skip_success", ("legislatura_lideres",): "skip_queued", ("orgao_membros",): "enqueue"}


def test_expense_actions(spark):
    rows = [(1, None, None, None, None), (2, "FAILED", "x", None, None), (3, "SUCCESS", "run", None, None), (4, "SUCCESS", "x", None, None),
            (5, "QUEUED", "x", "2026-05-12 09:00:00", None), (6, "QUEUED", "run", "2026-05-12 11:30:00", None), (7, "RUNNING", "x", None, "2026-05-12 09:00:00"),
            (8, "RUNNING", "x", None, None), (9, "", "x", None, None)]
    deps = spark.createDataFrame([(str(r[0]),) for r in rows] + [("not-int",)], "id string")
    state = spark.createDataFrame([(f"despesas|{r[0]}|2026|5", *r[1:], 1, None, 4) for r in rows if r[1] is not None],
                                  "row_key string, status string, current_pipeline_run_id string, d string, s string, attempt_count int, stale_requeue_count int, reprocess_count int")
    state = state.withColumns({"last_dispatched_at": F.col("d").cast("timestamp_ntz"), "last_started_at": F.col("s").cast("timestamp_ntz")})
    plan = fanout.plan_ceap(deps, F.array(F.lit(5), F.lit(6)), F.lit(2026), state, "run", F.lit("2026-05-12 12:00:00").cast("timestamp_ntz"), 60)
    assert [v for _, v in sorted(actions(plan, "id_deputado").items())] == [
        "enqueue_new", "enqueue_reprocess", "skip_success_same_run", "enqueue_reprocess", "enqueue_stale_queued", "skip_queued",
        "enqueue_stale_running", "skip_running", "enqueue_reprocess"]
    patch = {p.row_key: (p.stale_requeue_count, p.reprocess_count) for p in fanout.dispatch_patch(plan, "run", F.lit("now")).collect()}
    assert patch["despesas|5|2026|5"] == (0, 5) and patch["despesas|2|2026|5"] == (0, 4) and patch["despesas|1|2026|5"] == (0, 0)


def random_plan(spark, seed, n=600):
    rnd = random.Random(seed)
    rows = [(i // 2, i % 2, rnd.choice(["enqueue", "skip_same_hash", "skip_queued"])) for i in range(n)]
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    return rows, spark.createDataFrame(shuffled, "num int, seq int, action string").repartition(5)


@pytest.mark.parametrize("n", [1, 50, 200, 5000])
def test_budget_equals_a_scan(spark, n):
    rows, plan = random_plan(spark, n)
    got = {(r.num, r.seq): r.outcome for r in budget.apply_budget(plan, ["num", "seq"], n).collect()}
    used = 0
    for num, seq, action in rows:
        if used >= n:
            want = "deferred"
        else:
            want = "dispatch" if action == "enqueue" else "skip"
            used += action == "enqueue"
        assert got[(num, seq)] == want


@pytest.mark.parametrize("n", [1, 37, 200, 5000])
def test_backfill_summary_equals_the_scan(spark, n):
    rows, plan = random_plan(spark, 100 + n)
    seen = used = same = run = 0
    stop = False
    for num in range(300):
        if stop:
            break
        seen += 1
        for _, _, action in rows[2 * num:2 * num + 2]:
            if used >= n:
                stop = True
                break
            used += action == "enqueue"
            same += action == "skip_same_hash"
            run += action == "skip_queued"
    r = budget.backfill_summary(plan, ["num", "seq"], ["num"], n, dry_run=False).first()
    assert (r.records_seen, r.messages_enqueued, r.records_skipped_same_hash, r.records_skipped_same_run, r.limit_reached) == (seen, used, same, run, stop)
    assert r.status == ("LIMIT_REACHED" if stop else "SUCCESS")


def test_backfill_without_budget_counts_all_pairs(spark):
    """More messages than the largest budget of a tick."""
    n = spark.read.parquet("/root/testdata/sf0.1/orders.parquet").count()
    r = all_queries()["backfill_force"][0](spark, "/root/testdata/sf0.1").first()
    assert r.records_seen == n and r.messages_enqueued + r.records_skipped_same_run == 2 * n > 100_000


@pytest.mark.parametrize("n", [1, 100_001, 180_000, 10**9])
def test_budget_of_any_size(spark, n):
    """More messages than a task would want to hold; every third pair is skipped."""
    i = F.col("id")
    plan = spark.range(0, 300_000, 1, 8).select(
        (F.pmod(i * 7919, F.lit(300_000)) - 150_000).alias("num"), F.when(i % 3 == 0, "skip_queued").otherwise("enqueue").alias("action"))
    out = budget.apply_budget(plan, ["num"], n)
    last = plan.where("action = 'enqueue'").orderBy("num").offset(n - 1).limit(1).first() if n < 200_000 else None
    got = {r.outcome: (r.n, r.top) for r in out.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.max("num").alias("top")).collect()}
    assert got["dispatch"][0] == min(n, 200_000) and sum(g for g, _ in got.values()) == 300_000
    assert ("deferred" in got) == (n < 200_000) and (last is None or got["dispatch"][1] == last.num)


def test_nth_key_of_texts_times_and_hot_values(spark):
    """A third of the rows on one first value; texts longer than one number, nulls first."""
    rnd = random.Random(6)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else "naïve text " + "x" * rnd.randrange(12) + rnd.choice("ab\x00"), f"2024-01-{i % 28 + 1:02d} 10:00:00", rnd.choice([-(2**62), 0, i, 2**62])) for i in range(6000)]
    df = spark.createDataFrame(rows, "s string, t string, v long").withColumn("t", F.col("t").cast("timestamp_ntz")).repartition(5)
    order = ["s", "t", "v"]
    placed, names = budget._placed(df.withColumn("action", F.lit("enqueue")), order)
    want = df.orderBy(*order).collect()
    for n in (1, 100, 2500, 4100, 6000):
        cut = budget.nth(placed.select(*names), names, n)
        hit = placed.where(F.struct(*names) == F.struct(*[F.lit(c).cast("bigint").alias(x) for x, c in zip(names, cut)])).select(*order).first()
        assert tuple(hit) == tuple(want[n - 1])
    assert budget.nth(placed.select(*names), names, 6001) is None


def test_ordinals_are_exact_and_dense(spark):
    vals = [(i * 7919 % 10007, "x" if i % 3 else "hot") for i in range(3000)]
    out = budget.with_ordinal(spark.createDataFrame(vals, "v int, k string").repartition(7), ["k", "v"]).collect()
    assert [(r.k, r.v) for r in sorted(out, key=lambda r: r.ordinal)] == sorted((k, v) for v, k in vals)
    assert sorted(r.ordinal for r in out) == list(range(3000))


def test_resume_cursor_round_trip(spark):
    df = spark.range(0, 1000, 1).select(F.col("id").alias("ordinal"))
    df = df.select("ordinal", budget.resume_cursor(F.col("ordinal"), 3).alias("c")).collect()
    assert all(((r.c.next_pagina - 1) * 100 + r.c.next_idx) * 3 + r.c.next_month_idx == r.ordinal for r in df)


def test_slices_and_checkpoint(spark):
    pages = spark.createDataFrame([("a", p, p == 7) for p in range(1, 8)] + [("b", p, False) for p in range(1, 12)], "run string, page int, is_last boolean")
    cut = budget.page_slice(pages, F.when(F.col("run") == "a", F.lit(5)).otherwise(F.lit(2)), 4)
    got = {r.run: (r.listing_complete, r.list_next_page) for r in budget.slice_checkpoint(cut, "run").collect()}
    assert got == {"a": (True, 1), "b": (False, 6)}


def test_cursor(spark):
    ids = spark.createDataFrame([("5",), ("10",), ("55-1",), ("011",)], "id string")
    assert sorted(r.id for r in fanout.after_cursor(ids, F.lit(9)).collect()) == ["011", "10", "55-1"]
    done = spark.createDataFrame([("12", "SUCCESS", "microbatch"), ("99", "SUCCESS", "reconciliation"), ("55-1", "SUCCESS", "microbatch"), ("40", "FAILED", "microbatch")],
                                 "id string, status string, run_type string")
    assert fanout.advance_cursor(done, 3).first().cursor == 12
    assert fanout.advance_cursor(done, 50).first().cursor == 50
    assert fanout.advance_cursor(done.limit(0), 4).first().cursor == 4


def test_running_totals_equal_a_scan(spark):
    rnd = random.Random(4)
    rows = [("hot" if i % 3 else "k", f"day{i // 30:02d}", i, rnd.randrange(9), rnd.randrange(9), rnd.randrange(9)) for i in range(300)]
    df = spark.createDataFrame(rows, "c string, d string, i int, records_seen int, messages_enqueued int, records_skipped_same_hash int")
    got = {(r.c, r.i): r for r in batches.batch_totals(df, ["c"], "d", ["i"]).collect()}
    sums = {}
    for c, _, i, a, b, s in rows:
        n, x, y, z = sums.get(c, (0, 0, 0, 0))
        sums[c] = (n + 1, x + a, y + b, z + s)
        r = got[(c, i)]
        assert (r.batch_index, r.records_seen_total, r.messages_enqueued_total, r.skipped_same_hash_total) == sums[c]


def test_idle_streak(spark):
    df = spark.createDataFrame([("r", i, q) for i, q in enumerate([0, 0, 3, 0, 0, 0, 0, 1])], "run string, tick int, queued int")
    got = [(r.idle_ticks, r.enqueue_phase_complete) for r in batches.idle_streak(df, ["run"], "tick").orderBy("tick").collect()]
    assert got == [(1, False), (2, False), (0, False), (1, False), (2, False), (3, True), (4, True), (0, False)]


def test_idle_streak_of_a_hot_key_spans_chunks(spark):
    """One key with a third of all ticks, long idle stretches over many chunks, missing counts."""
    rnd = random.Random(9)
    rows, want = [], {}
    for key, n in (("hot", 4000), ("a", 300), (None, 200), *((f"k{i}", 60) for i in range(100))):
        streak, busy = 0, rnd.choice([0.001, 0.3])
        for t in range(n):
            q = None if t % 97 == 5 else rnd.randrange(1, 5) if rnd.random() < (0.0008 if key == "hot" else busy) else 0
            streak = 0 if q else streak + (q == 0)
            rows.append((key, t, q))
            want[(key, t)] = (streak, streak >= 3)
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "run string, tick int, queued int").repartition(6)
    out = batches.idle_streak(df, ["run"], "tick")
    assert out.columns == ["run", "tick", "queued", "idle_ticks", "enqueue_phase_complete"]
    assert {(r.run, r.tick): (r.idle_ticks, r.enqueue_phase_complete) for r in out.collect()} == want


def test_fingerprint_merge_and_diff(spark):
    f = lambda rows: spark.createDataFrame(rows, "id string, uid string, hash string")
    old, new = f([("1", "u", "a"), ("2", "u", "b")]), f([("2", "u", "c"), ("3", "u", "d")])
    assert sorted(map(tuple, FP.merge_fingerprints(old, new).collect())) == [("1", "u", "a"), ("2", "u", "c"), ("3", "u", "d")]
    assert dict(map(tuple, FP.diff(old, new).collect())) == {"1": "absent", "2": "changed", "3": "new"}
    assert dict(map(tuple, FP.diff(old, old).collect())) == {"1": "unchanged", "2": "unchanged"}


def test_count_window_warns_even_at_the_true_end(spark):
    df = spark.createDataFrame([("w", p, i) for p in range(1, 4) for i in ("a", f"b{p}")], "k string, page int, id string")
    r = batches.count_window(df, ["k"], 3).first()
    assert (r.distinct_ids, r.pages_fetched, r.warning) == (4, 3, "max_list_pages_reached_during_count")
    assert batches.count_window(df, ["k"], 4).first().warning is None
    r = batches.count_window(df, ["k"], 2).first()
    assert (r.distinct_ids, r.pages_fetched, r.warning is None) == (4, 3, False)  # long listings are counted whole
