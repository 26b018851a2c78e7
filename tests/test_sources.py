"""Page files, markers, messages, fingerprints, sinks, versions, envelopes."""

import base64
import json
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from tribuna.operators import envelope as E
from tribuna.operators import layers as L
from tribuna.schemas import record_ddl
from tribuna.sources import pages as PG
from tribuna.sources import sinks, tables
from tribuna.streaming import microbatch as MB
from tribuna.streaming import table_log


def fresh():
    return tempfile.mkdtemp(prefix="spark-")


def put(root, path, doc):
    p = Path(root) / path
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(doc if isinstance(doc, str) else json.dumps(doc), encoding="utf-8")


def test_page_files_beside_metadata_folders(spark):
    root = fresh()
    base = "reference_year=2026/reference_month=04/pipeline_run_id=r1"
    put(root, f"{base}/execution_id=e1/page_1.json", {"dados": [{"id": 1, "nome": "a"}, {"nome": "no id"}], "links": [{"rel": "next"}], "extra": 5})
    put(root, f"{base}/execution_id=e2/page_1.json", {"dados": [{"id": 9, "nome": "copy"}]})
    put(root, f"{base}/execution_id=e1/page_2.json", {"dados": [{"id": 2, "nome": "b"}], "links": []})
    put(root, f"{base}/execution_id=e1/page_3.json", "{broken")
    put(root, "_metadata/runs/pipeline_run_id=r1/metadata.json", {"status": "COMPLETED"})
    parts = ["reference_year", "reference_month", "pipeline_run_id", "execution_id"]
    df = PG.read_pages(spark, root, record_ddl("deputados"), parts)
    rows = df.orderBy("page", "execution_id").collect()
    assert [(r.page, r.execution_id, r.reference_month) for r in rows] == [(1, "e1", "04"), (1, "e2", "04"), (2, "e1", "04"), (3, "e1", "04")]
    assert json.loads(rows[0].raw)["extra"] == 5 and rows[3].corrupt is not None and rows[3].dados is None
    got = PG.deputies_from_snapshot(df, ["pipeline_run_id"]).orderBy("page", "pos").select("item.id").collect()
    assert [r.id for r in got] == [1, 2]


def test_pages_write_replaces_only_its_run(spark):
    root = fresh()
    schema = "run string, page int, dados array<struct<id:bigint,nome:string>>"
    a = spark.createDataFrame([("r1", 1, [(1, None)]), ("r2", 1, [(2, "x")])], schema)
    sinks.write_pages(a, root, ("run",))
    sinks.write_pages(spark.createDataFrame([("r1", 1, [(3, "new")])], schema), root, ("run",))
    back = spark.read.json(root).select("run", "dados.id").collect()
    assert sorted((r.run, r.id[0]) for r in back) == [("r1", 3), ("r2", 2)]


def test_markers_only_for_completed_runs(spark):
    m, k = f"{fresh()}/m", f"{fresh()}/k"
    df = spark.createDataFrame([("r1", "completed", "p1"), ("r2", "PARTIALLY_COMPLETED", "p2")], "pipeline_run_id string, status string, success_marker_path string")
    sinks.write_manifests(df, m, k)
    assert [r.pipeline_run_id for r in tables.read_markers(spark, k).collect()] == ["r1"]
    back = tables.read_manifests(spark, m)
    assert sorted(r.status for r in back.collect()) == ["PARTIALLY_COMPLETED", "completed"]


def test_sinks_leave_other_runs_and_days(spark):
    m, k = f"{fresh()}/m", f"{fresh()}/k"
    schema = "pipeline_run_id string, status string, success_marker_path string"
    write = lambda *rows: sinks.write_manifests(spark.createDataFrame(rows, schema), m, k)
    write(("r1", "COMPLETED", "p1"), ("r2", "COMPLETED", "p2"))
    write(("r3", "COMPLETED", "p3"))
    write(("r2", "FAILED", "p2"), ("r4", None, "p4"))
    assert sorted((r.pipeline_run_id, r.status) for r in tables.read_manifests(spark, m).collect()) == [("r1", "COMPLETED"), ("r2", "FAILED"), ("r3", "COMPLETED"), ("r4", None)]
    assert sorted(r.pipeline_run_id for r in tables.read_markers(spark, k).collect()) == ["r1", "r3"]
    d, g = f"{fresh()}/d", f"{fresh()}/g"
    schema = "reference_date string, status string, warning_types array<string>"
    write = lambda *rows: sinks.write_daily_summary(spark.createDataFrame(rows, schema), d, g)
    write(("2024-01-01", "COMPLETED", []), ("2024-01-02", "COMPLETED", []))
    write(("2024-01-03", "COMPLETED", ["other"]))
    write(("2024-01-02", "COMPLETED", ["success_marker_missing"]))
    assert sorted(r.reference_date for r in tables.read_day_markers(spark, g).collect()) == ["2024-01-01", "2024-01-03"]
    docs = tables.read_daily_summaries(spark, d, "status string, warning_types array<string>").collect()
    assert sorted((r.reference_date, tuple(r.warning_types)) for r in docs) == [("2024-01-01", ()), ("2024-01-02", ("success_marker_missing",)), ("2024-01-03", ("other",))]


def test_changed_records_written_only_when_there_are_some(spark):
    schema = "id string, hash string, endpoint string, action string"
    path = f"{fresh()}/c"
    assert sinks.write_changed(spark.createDataFrame([("1", "h", "e", "skip_queued")], schema), path) == 0
    assert not Path(path).exists()
    assert sinks.write_changed(spark.createDataFrame([("1", "h", "e", "enqueue"), ("2", "h", "e", "skip_queued")], schema), path) == 1
    assert spark.read.json(path).first().asDict() == {"id": "1", "list_item_hash": "h", "endpoint": "e", "reason": "enqueue"}


def test_messages(spark):
    body = json.dumps({"domain": " d ", "pipeline_run_id": "r1 ", "payload": {"a": 1}})
    rows = [(body,), (base64.b64encode(body.encode()).decode(),), ("garbage",), ("{}",)]
    df = spark.createDataFrame(rows, "body string")
    got = tables.parse_messages(df).collect()
    assert [r.pipeline_run_id for r in got] == ["r1", "r1", None, None]
    assert got[0].domain == "d" and got[1].payload == {"a": "1"} and got[0].run_type == "snapshot"
    assert tables.messages_for_run(df, "r1").count() == 2


def test_fingerprint_map(spark):
    doc = {"fingerprints": {"1": {"uid": "u", "hash": "h"}, "2": "nope", "3": {"uid": None}}}
    df = spark.createDataFrame([(json.dumps(doc),)], "raw string")
    assert sorted(map(tuple, tables.explode_fingerprints(df).collect())) == [("1", "u", "h"), ("3", "", "")]


def test_state_versions(spark):
    path = fresh() + "/s"
    ddl = "domain string, row_key string, current_pipeline_run_id string, last_pipeline_run_id string"
    tables.write_version(spark.createDataFrame([("d", "a", "r1", None)], ddl), path, 1, ("domain",))
    tables.write_version(spark.createDataFrame([("d", "a", "r2", "r1"), ("e", "b", "r1", "r0"), ("d", "c", "r9", None)], ddl), path, 2, ("domain",))
    assert sorted(r.row_key for r in tables.read_state(spark, path, run_id="r1").collect()) == ["a", "b"]
    assert [r.row_key for r in tables.read_state(spark, path, "d", "r1").collect()] == ["a"]
    assert tables.read_version(spark, path, 1).first().current_pipeline_run_id == "r1"


def test_state_of_many_domains_lies_in_few_folders(spark):
    """A version's folders are bounded, and a domain comes back as it went in: also one that looks like a number, is blank or missing."""
    path = fresh() + "/s"
    rows = spark.range(300).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("domain"), F.col("id").cast("string").alias("row_key"), F.lit("r").alias("current_pipeline_run_id"), F.lit("q").alias("last_pipeline_run_id"))
    odd = spark.createDataFrame([("007", "x", "r", "q"), ("", "y", "r", "q"), (None, "z", "r", "q")], "domain string, row_key string, current_pipeline_run_id string, last_pipeline_run_id string")
    tables.write_version(rows.unionByName(odd), path, 1, ("domain",))
    assert len([p for p in Path(path, "version=00000001").iterdir() if p.is_dir()]) <= tables.VERSION_BUCKETS
    for domain, key in (("d7", "7"), ("007", "x"), ("", "y")):
        state = tables.read_state(spark, path, domain, "r")
        assert [tuple(r) for r in state.collect()] == [(domain, key, "r", "q")]
        assert len(state.inputFiles()) == 1 or "PartitionFilters: [isnotnull(_bucket" in state._jdf.queryExecution().executedPlan().toString()
    back = tables.read_version(spark, path)
    assert back.count() == 303 and back.columns == rows.columns and back.where("domain IS NULL").first().row_key == "z"


def test_run_file_match(spark):
    paths = spark.createDataFrame([(p,) for p in ("x/pipeline_run_id=r 1/page_1.json", "x/pipeline_run_id=r_1/page_1.json", "x/_metadata/runs/pipeline_run_id=r 1/metadata.json", "x/pipeline_run_id=r2/p")], "path string")
    assert tables.raw_files_for_run(paths, "r 1").count() == 2
    assert sorted(r[0] for r in PG.discover_runs(paths).collect()) == ["r 1", "r2", "r_1"]


def pages_df(spark, rows):
    return spark.createDataFrame(rows, "parent_id string, page int, dados array<struct<id:bigint,nome:string>>, links array<struct<rel:string,href:string>>, failed boolean")


def test_snapshot_stops_at_the_first_page_without_next(spark):
    nxt, end, one = [("next", "h")], [], [(1, "a")]
    df = pages_df(spark, [("p", 1, one, nxt, False), ("p", 2, one, end, False), ("p", 3, one, end, False), ("q", 1, one, nxt, False), ("q", 2, one, nxt, True),
                          ("r", 1, one, None, False), ("s", 1, one, end, False), ("s", 2, one, nxt, True), ("t", 1, one, nxt, True)])
    got = {r.parent_id: (r.pages_written, r.record_count, r.final_status) for r in E.snapshot_results(df, ["parent_id"]).collect()}
    assert got == {"p": (2, 2, "COMPLETED"), "q": (1, 1, "FAILED"), "r": (1, 1, "COMPLETED"), "s": (1, 1, "COMPLETED"), "t": (0, 0, "FAILED")}
    capped = {r.parent_id: r.pages_written for r in E.snapshot_results(df.where("parent_id = 'p'"), ["parent_id"], max_pages=1).collect()}
    assert capped == {"p": 1}


def test_envelope_is_deterministic_and_strips_old_lineage(spark):
    ddl = "parent_id string, pipeline_run_id string, execution_id string, page int, ingested_at string, dados array<struct<id:bigint,nome:string,_record_uid:string,_record_hash:string>>, links array<struct<rel:string,href:string>>"
    rows = [("7", "r/1", "e", 1, "t", [(1, "a", None, None), (None, None, None, None)], [])]
    a = E.enrich_pages(spark.createDataFrame(rows, ddl), "frente_membros").first()
    rows[0][5][0] = (1, "a", "old", "old")
    b = E.enrich_pages(spark.createDataFrame(rows, ddl), "frente_membros").first()
    assert a == b
    assert a._audit["_raw_path"] == "raw/camara/institucional/api/frentes/membros/parent_id=7/pipeline_run_id=r_1/execution_id=e/page_1.json"
    assert a._audit["_parent_entity"] == "frente" and a._audit["_pipeline_run_id"] == "r/1"
    assert a.dados[0]["_record_uid"] and a.dados[1]["_record_uid"] is None and a.dados[1]["_record_hash"]


def test_raw_and_typed_envelopes_agree(spark):
    raw = json.dumps({"links": [], "dados": [{"nome": "é", "id": 3}]})
    df = spark.createDataFrame([("2026-05-12", "r", "e", 1, "t", raw)], "reference_date string, pipeline_run_id string, execution_id string, page int, ingested_at string, raw string")
    df = df.withColumn("b", F.from_json("raw", "dados array<struct<id:bigint,nome:string>>, links array<string>")).select("*", "b.dados", "b.links").drop("b")
    typed = E.enrich_pages(df.drop("raw"), "partidos", layout="dated").first()
    exact = E.enrich_pages(df, "partidos", layout="dated", raw="raw").first()
    assert typed._audit["_payload_hash"] == exact._audit["_payload_hash"]
    assert typed._audit["_reference_date"] == "2026-05-12" and typed._audit["_api_path"] == "/partidos"


def test_deputies_envelope(spark):
    df = spark.createDataFrame([("2026-05-12", "r", "e", 1, "t", [("5", "n"), ("x", "n"), (None, "n")])],
                               "reference_date string, pipeline_run_id string, execution_id string, page int, ingested_at string, dados array<struct<id:string,nome:string>>")
    row = E.enrich_pages(df, "deputados", layout="dated").first()
    assert row._audit["_entity"] == "deputado" and row._audit["_domain"] == "deputados"
    assert [bool(x["_record_uid"]) for x in row.dados] == [True, False, False]


def test_classification_and_quarantine(spark):
    df = spark.createDataFrame([(1, "LID.X"), (None, "LID.X"), (None, "Z"), (None, None)], "c bigint, n string")
    assert [r[0] for r in df.select(L.classify(F.col("c"), F.col("n"))).collect()] == ["DEPUTADO", "LIDERANCA", "OUTROS", "OUTROS"]
    rows = [(1, "1.50", "2026-01-02", 1, "123"), (None, "x", "bad", 13, "")]
    e = spark.createDataFrame(rows, "codDocumento bigint, valorDocumento string, dataDocumento string, mes int, cnpjCpfFornecedor string")
    good, bad = L.split_valid(e)
    assert good.count() == 1
    assert bad.first().violations == ["missing_document", "bad_value", "bad_date", "bad_month", "bad_supplier"]


def test_views_and_core_indicators(spark):
    silver = spark.createDataFrame([(1, "1.10"), (2, "2.20"), (3, "3.30"), (9, "4.40")], "id_deputado bigint, v string").withColumn("valor", F.col("v").cast("decimal(18,2)"))
    deps = spark.createDataFrame([(1, "A", "P", "SP", 1), (2, "LID.P", "P", "SP", None), (3, "C", "P", "RJ", None)], "id bigint, nome string, partido string, uf string, ide_cadastro bigint")
    facts = L.fact_expenses(silver, deps)
    assert [r.id_deputado for r in L.deputy_view(facts).collect()] == [1]
    assert [r.id_deputado for r in L.leadership_view(facts).collect()] == [2]
    got = {r.uf: (str(r.total), r.documentos) for r in L.expenses_by(facts, "uf").collect()}
    assert got == {"SP": ("1.10", 1), "RJ": ("3.30", 1), None: ("4.40", 1)}


def test_stream_windows_dedup_and_cursor_over_many_files(spark):
    """Files in mixed order of days, one, two or all to a batch: late rows count, and the answer is the batch one."""
    src, out = fresh(), fresh()
    schema = "id string, ts timestamp_ntz, uid string, hash string"
    for i in range(4):
        rows = [(str(100 * (3 - i) + j) if j % 5 else f"55-{i}{j}", f"2026-01-{(25, 3, 14, 3)[i]:02d} 0{i % 2}:{j:02d}:00", f"u{j % 7}{i % 3}", f"h{j % 3}") for j in range(40)]
        df = spark.createDataFrame(rows, "id string, t string, uid string, hash string")
        df.select("id", F.col("t").cast("timestamp_ntz").alias("ts"), "uid", "hash").coalesce(1).write.mode("append").parquet(f"{src}/in")
    batch = spark.read.schema(schema).parquet(f"{src}/in")
    cols = ["pipeline_run_id", "window_start", "records", "max_id"]
    for n in (1, 2, 4):
        feed = lambda: MB.read_feed(spark, f"{src}/in", schema, files_per_trigger=n)  # noqa: E731, B023
        MB.stream_runs(feed(), f"{out}/runs{n}", f"{out}/r{n}")
        got = MB.current_runs(spark, f"{out}/runs{n}").select(cols).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, MB.windowed_runs(batch).select(cols).collect()))
        MB.stream_dedup(feed().select("ts", "uid", "hash"), f"{out}/dedup{n}", f"{out}/d{n}")
        got = [tuple(r) for r in spark.read.parquet(f"{out}/dedup{n}").select("uid", "hash").collect()]
        assert sorted(got) == sorted(map(tuple, batch.select("uid", "hash").distinct().collect()))
    feed = lambda: MB.read_feed(spark, f"{src}/in", schema, files_per_trigger=1)
    MB.stream_after_cursor(feed().select("id"), f"{out}/cur", f"{out}/c3")
    kept = {r.batch_id: {x.id for x in table_log.read_log(spark, f"{out}/cur/rows").where(F.col("batch_id") == r.batch_id).collect()}
            for r in table_log.read_log(spark, f"{out}/cur/rows").select("batch_id").distinct().collect()}
    assert len(kept[0]) == 40 and all(all(x.startswith("55-") for x in kept[b]) for b in kept if b)


def test_log_compaction_keeps_the_newest(spark):
    out = fresh()
    for i in range(3):
        table_log.write_batch(spark.createDataFrame([("a", i), (f"k{i}", i)], "k string, v int"), f"{out}/log", i)
    table_log.compact(spark, f"{out}/log", ["k"], f"{out}/small")
    got = dict(map(tuple, table_log.read_log(spark, f"{out}/small").select("k", "v").collect()))
    assert got == {"a": 2, "k0": 0, "k1": 1, "k2": 2}


def test_failed_ids_are_offered_again_above_the_cursor(spark):
    """Ticks of ten ids; 8 and 9 fail at first, 25 twice, a text id once: the cursor follows the successes only."""
    src, out = fresh(), fresh()
    fails = {"8": 1, "9": 1, "25": 2, "29": 2, "x1": 1}
    for i in range(4):
        ids = [(str(10 * i + j),) for j in range(10)] + ([("x1",)] if i == 0 else [])
        spark.createDataFrame(ids, "id string").coalesce(1).write.mode("append").parquet(f"{src}/in")
    times = spark.createDataFrame(list(fails.items()), "id string, n int")

    def outcomes(offered):
        joined = offered.join(times, "id", "left")
        return joined.withColumn("status", F.when(F.col("attempt") <= F.coalesce("n", F.lit(0)), "FAILED").otherwise("SUCCESS"))

    MB.stream_after_cursor(MB.read_feed(spark, f"{src}/in", "id string", files_per_trigger=1), f"{out}/c", f"{out}/cp", outcomes)
    rows = {(r.batch_id, r.id): (r.attempt, r.status) for r in table_log.read_log(spark, f"{out}/c/rows").collect()}
    cursors = {r.batch_id: r.cursor for r in table_log.read_log(spark, f"{out}/c/cursor").collect()}
    assert cursors == {0: 7, 1: 19, 2: 28, 3: 39}
    assert rows[(1, "8")] == rows[(1, "9")] == rows[(1, "x1")] == (2, "SUCCESS")
    assert rows[(2, "25")] == (1, "FAILED") and (3, "25") not in rows  # at or below the cursor: the reconciliation has it
    assert rows[(2, "29")] == (1, "FAILED") and rows[(3, "29")] == (2, "FAILED")
    assert {i for b, i in rows if b == 3} == {*map(str, range(30, 40)), "29"}


def test_dedup_reads_no_more_as_batches_go_by(spark):
    """Eight equal batches, half of each seen before: what the state reads per batch stays level."""
    src, out = fresh(), fresh()
    schema = "uid string, hash string"
    for i in range(8):
        ids = spark.range(i * 500, i * 500 + 1000, 1, 1).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("uid"), F.lit("h").alias("hash"))
        ids.coalesce(1).write.mode("append").parquet(f"{src}/in")
    progress = MB.stream_dedup(MB.read_feed(spark, f"{src}/in", schema, files_per_trigger=1), f"{out}/d", f"{out}/cp")
    busy = [p for p in progress if p.numInputRows]
    assert len(busy) == 8 and spark.read.parquet(f"{out}/d").count() == 4500
    read = [p.stateOperators[0].customMetrics["rocksdbTotalBytesRead"] for p in busy]
    new = [p.stateOperators[0].numRowsUpdated for p in busy]
    assert new == [1000] + [500] * 7
    assert max(read[1:]) <= 1.5 * max(1, min(read[1:])), read


def test_an_unchanged_day_is_not_shuffled(spark):
    days = spark.range(0, 20000, 1, 4).select(
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0")).alias("day"),
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("uid"), F.lit("h").alias("hash"))
    src = fresh()
    days.write.parquet(f"{src}/full")
    days.where("day <> '2024-01-07' or uid = 'u6'").write.parquet(f"{src}/done")
    full, done = spark.read.parquet(f"{src}/full"), spark.read.parquet(f"{src}/done")
    want = sorted(map(tuple, MB.reconcile_batch(full, done).select("uid", "hash").collect()))
    out = MB.reconcile_by_digest(full, done)
    assert sorted(map(tuple, out.select("uid", "hash").collect())) == want and len(want) == 999
    parts = MB.changed_parts(full, done)
    assert {r.day for r in parts.collect()} == {"2024-01-07"}
    path = f"{src}/parts"
    parts.write.parquet(path)
    moved = MB.rows_of(full, spark.read.parquet(path))
    text = moved._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and moved.count() == 1000
    assert sorted(map(tuple, MB.reconcile_by_digest(full, full).collect())) == []
