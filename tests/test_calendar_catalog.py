"""Month and date windows, run ids, catalog."""

from pyspark.sql import functions as F

from tribuna import catalog
from tribuna.functions import scalars as S
from tribuna.functions import windows as W


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def span(col):
    return F.concat_ws("..", col["date_start"].cast("string"), col["date_end"].cast("string"))


def test_month_rules(spark):
    r = one(
        spark, W.reconciliation_pair(F.lit(2026), at("2026-05-12")), W.reconciliation_pair(F.lit(2026), at("2026-01-15")),
        W.daily_months(F.lit(2026), at("2026-05-12"), 0), W.dispatch_order(F.lit(2026), at("2026-05-12")),
        W.dispatch_order(F.lit(2025), at("2026-05-12")), W.dispatch_order(F.lit(2027), at("2026-05-12")),
        W.reconciliation_pair(F.lit(2025), at("2026-05-12")), W.daily_months(F.lit(2026), at("2026-02-12"), 5),
        W.reconciliation_months(F.lit(2026), at("2026-05-12"), 0), W.reconciliation_months(F.lit(2026), at("2026-05-12"), 9),
    )
    assert list(r) == [[4, 5], [1], [5], [5, 4, 1, 2, 3], list(range(1, 13)), [], [11, 12], [2, 1], [1, 2, 3, 4, 5], []]


def test_date_windows(spark):
    days = ["2026-05-12", "2026-03-01", "2026-01-15"]
    r = one(spark, *[span(W.previous_month_to_date(at(d))) for d in days], span(W.past_and_future(at("2026-05-12"), 2, 3)),
            span(W.rolling_days(at("2026-05-12"), 7)), span(W.month_to_date(at("2026-05-12"))), span(W.today_and_future(at("2026-05-12"), 7)))
    assert list(r) == ["2026-04-01..2026-05-12", "2026-02-01..2026-03-01", "2025-12-01..2026-01-15", "2026-05-10..2026-05-15",
                       "2026-05-06..2026-05-12", "2026-05-01..2026-05-12", "2026-05-12..2026-05-19"]


def test_day_bounds_and_anchor(spark):
    r = one(spark, W.day_end(F.lit("2026-05-12").cast("date")).cast("string"), W.round_minute_down(at("2026-05-12 10:39:59"), 10).cast("string"),
            W.reference_date(at("2026-05-12 01:00:00"), "America/Sao_Paulo").cast("string"))
    assert list(r) == ["2026-05-12 23:59:59.999999", "2026-05-12 10:30:00", "2026-05-11"]


def test_modes(spark):
    r = one(spark, W.ceap_mode(at("2026-05-10")), W.ceap_mode(at("2026-05-12")), W.ceap_mode(at("2026-05-25"), 25),
            W.votacoes_mode(at("2026-05-25")), W.votacoes_mode(at("2026-05-09"), skip_weekend=True), W.votacoes_mode(at("2026-05-12")))
    assert list(r) == ["reconciliation", "daily", "reconciliation", "reconciliation", "skipped_weekend", "microbatch"]


def test_catalog_shape():
    assert len(catalog.DOMAINS) == 7 and len(catalog.ENDPOINTS) == 26
    assert catalog.endpoint("evento_pauta").business_keys == ("ordem", "proposicao_.id")
    assert catalog.endpoint("votacoes").page_size == 200


def test_catalog_frame_and_lookup(spark):
    df = catalog.endpoints_df(spark)
    assert df.count() == 26
    assert df.where(catalog.lookup(F.col("endpoint"), "raw_prefix") != F.col("raw_prefix")).count() == 0


def test_run_ids(spark):
    ids = ["proposicoes_reconciliation_20260511", "eventos_microbatch_202605121200", "eventos_daily_20260512", "proposicoes_replay_20260512", "",
           "reference_snapshot_20260511", "current_year_backfill_20260513150000", "proposicoes_recoctl_a1b2c3d4e5f67890",
           "current_year_backfill_20260513_150000", "invalid id with spaces"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(ids)], "i int, r string").orderBy("i")
    rows = df.select(catalog.run_type(F.col("r")), catalog.is_well_formed_run_id(F.col("r")), catalog.owner_domain(F.col("r"))).collect()
    assert [r[0] for r in rows[:5]] == ["reconciliation", "microbatch", "daily", "manual_replay", "manual_replay"]
    assert [r[1] for r in rows] == [True, True, True, True, False, True, True, True, False, False]
    assert [r[2] for r in rows] == ["proposicoes", "eventos", "eventos", None, None, "reference", "proposicoes", "proposicoes", "proposicoes", None]


def test_registry_moves_only_for_automated_runs(spark):
    r = one(spark, *[catalog.updates_ceap_registry(F.lit(x)) for x in ("ceap_daily_20260101", " ceap_reconciliation_1", "ceap_replay_20260101", "")])
    assert list(r) == [True, True, False, False]


def test_id_order(spark):
    df = spark.createDataFrame([(x,) for x in ("100", "9", "20", "25001234", "x-1")], "id string")
    assert [r[0] for r in df.orderBy(*S.id_order(F.col("id"))).collect()] == ["9", "20", "100", "25001234", "x-1"]


def test_scalar_rules(spark):
    links = F.from_json(F.lit('[{"rel":"last","href":"x?pagina=4&itens=100"},{"rel":"self"}]'), "array<struct<rel:string,href:string>>")
    nxt = F.from_json(F.lit('[{"rel":null},{"rel":"next"}]'), "array<struct<rel:string,href:string>>")
    none = F.lit(None).cast("array<struct<rel:string,href:string>>")
    r = one(
        spark, S.total_hint(links, F.lit(7)), S.has_next(links), S.has_next(nxt), S.has_next(none), S.total_hint(none, F.lit(1)),
        S.months_list(F.lit("[5, 4]")), S.months_list(F.lit("oops")), S.months_list(F.lit('["3","x",null,-2]')),
        S.int_or_zero(F.lit("1.5")), S.normalize_status(F.lit(" partially_completed ")), S.normalize_status(F.lit(None).cast("string")),
        S.normalize_document(F.lit("12.345.678/0001-90")), S.normalize_document(F.lit("123.456.789-0")), S.normalize_document(F.lit("-")),
        S.legacy_key(F.lit(2026), F.lit(4), F.lit(77)), S.path_value(F.lit("a/pipeline_run_id=r1/b"), "pipeline_run_id"),
        S.path_value(F.lit("a/b"), "pipeline_run_id"), S.safe_segment(F.lit("a b/ç.d-e")),
        S.iso_date(F.lit("20260512")).cast("string"), S.iso_date(F.lit("2026")), S.iso_date(F.lit("2026-02-30")),
    )
    assert list(r) == [307, False, True, False, None, [5, 4], [], [3, -2], 0, "PARTIAL", "", "12345678000190", "01234567890", None,
                       "2026_04_77", "r1", None, "a_b_.d-e", "2026-05-12", None, None]
