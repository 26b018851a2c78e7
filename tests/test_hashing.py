"""Laws of the canonical form, the UIDs and the content hashes."""

import hashlib
import json
import random
import struct
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tribuna.catalog import CEAP_UID_FIELDS
from tribuna.functions import hashing as H
from tribuna.operators import envelope as E

SOURCE = "camara_dadosabertos"


def digest(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def expected(doc):
    def plain(v):
        if isinstance(v, float):
            return format(Decimal(str(v)), "f")
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, list) else v

    return json.dumps(plain(doc), sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def raw_hashes(spark, docs, fn=H.record_hash_raw):
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "i int, raw string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("raw"))).collect()]


def test_key_order_and_lineage_do_not_matter(spark):
    a, b, c = raw_hashes(spark, [{"a": 1, "b": None}, '{"b":null, "a":1}', {"a": 1, "b": None, "_record_uid": "u", "_record_hash": "h"}])
    assert a == b == c == digest('{"a":1,"b":null}')


def test_null_is_not_absent(spark):
    a, b = raw_hashes(spark, [{"a": 1, "b": None}, {"a": 1}])
    assert a != b


def test_floats_become_decimal_text(spark):
    docs = [{"v": 1234.5}, {"v": "1234.5"}, {"v": "1234.50"}, {"v": 1e20}, {"v": 0.00001}, {"v": 1.0}, {"v": 123456789.25}]
    got = raw_hashes(spark, docs)
    assert got == [digest(expected(d)) for d in docs]
    assert got[0] == got[1] != got[2]


def test_payload_hash_ignores_audit_and_item_lineage(spark):
    page = {"dados": [{"id": 1}, 7], "links": []}
    audited = {"_audit": {"x": 1}, "dados": [{"id": 1, "_record_uid": "u", "_record_hash": "h"}, 7], "links": []}
    a, b = raw_hashes(spark, [page, audited], H.payload_hash)
    assert a == b == digest(expected(page))


def test_text_that_is_not_json_has_no_hash(spark):
    assert raw_hashes(spark, ["not json"]) == [None]


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**12), 10**12) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=4), inner, max_size=3), max_leaves=8,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.text(alphabet="abçz", min_size=1, max_size=4), json_values, max_size=4), min_size=20, max_size=40))
def test_raw_form_agrees_with_the_definition(spark, docs):
    assert raw_hashes(spark, docs) == [digest(expected(d)) for d in docs]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=12) | st.none(), st.integers(-5, 10**15) | st.none()), min_size=20, max_size=60))
def test_typed_form_agrees_with_the_definition(spark, rows):
    df = spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(rows)], "i int, t string, n bigint")
    got = df.orderBy("i").select(H.canonical_struct({"t": F.col("t"), "n": F.col("n")})).collect()
    assert [r[0] for r in got] == [expected({"t": t, "n": n}) for t, n in rows]


def test_control_characters_and_escaped_backslashes(spark):
    texts = ["".join(map(chr, range(32))), "\\u000B", "\\\x0b", "\\\\\x1f\x0e", " é\x7f/"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(H.canonical_struct({"t": F.col("t")})).collect()]
    assert got == [expected({"t": t}) for t in texts]


def test_typed_doubles_use_plain_decimals(spark):
    vals = [1234.5, 1.0, 1e7, 123456789.25, -0.001, 1e16, 2.5e17, 100.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(H.decimal_text(F.col("v"))).collect()]
    assert got == [format(Decimal(repr(v)), "f") for v in vals]


def test_expense_uid(spark):
    item = {"codDocumento": 7, "numDocumento": None, "dataDocumento": "2026-01-02", "tipoDespesa": "X", "urlDocumento": None,
            "parcela": 0, "numRessarcimento": None, "cnpjCpfFornecedor": "1", "valorDocumento": "1234.5"}
    schema = ("codDocumento bigint, numDocumento string, dataDocumento string, tipoDespesa string, urlDocumento string, parcela int, "
              "numRessarcimento string, cnpjCpfFornecedor string, valorDocumento string")
    df = spark.createDataFrame([(item, 10, 2026, 5)], f"item struct<{schema.replace(' ', ':').replace(',:', ',')}>, d bigint, a int, m int")
    uid = df.select(H.ceap_record_uid(F.col("item"), F.col("d"), F.col("a"), F.col("m"))).first()[0]
    keys = dict(item, id_deputado=10, ano=2026, mes=5)
    assert uid == digest(f"{SOURCE}|deputado_despesas|{expected(keys)}")


def test_deputy_uid_needs_an_integer(spark):
    df = spark.createDataFrame([("7",), ("not-int",), (None,)], "id string")
    got = [r[0] for r in df.select(H.deputy_record_uid(F.col("id"))).collect()]
    assert got == [digest(SOURCE + '|deputado|{"id":7}'), None, None]


def test_record_uid_is_null_when_all_keys_are(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a bigint, b string")
    got = [r[0] for r in df.select(H.record_uid("s", "e", {"a": F.col("a"), "b": F.col("b")})).collect()]
    assert got == [None, digest('s|e|{"a":1,"b":null}')]


def test_list_item_fingerprint_ignores_underscore_fields(spark):
    df = spark.createDataFrame([({"id": 1, "x": "a", "_l": "q"},), ({"id": 1, "x": "a", "_l": "z"},)], "item struct<id:bigint,x:string,_l:string>")
    rows = H.list_item_fingerprint(df, "item", "votacoes").select("uid", "hash").collect()
    assert rows[0] == rows[1]
    assert rows[0]["hash"] == digest('{"id":1,"x":"a"}')


def test_dotted_business_keys(spark):
    df = spark.createDataFrame([({"deputado_": {"id": 5, "nome": "n"}, "tipoVoto": "Sim"},)], "item struct<tipoVoto:string,deputado_:struct<id:bigint,nome:string>>")
    uid = df.select(H.endpoint_record_uid(F.col("item"), "votacao_votos", ("deputado_.id", "tipoVoto"))).first()[0]
    assert uid == digest(SOURCE + '|votacao_votos|{"deputado_.id":5,"tipoVoto":"Sim"}')


def test_doubles_of_any_size(spark):
    """No exponent, no lost digit; 17 digits may differ from the shortest form where Java 17 prints more than it needs."""
    rnd = random.Random(1)
    values = [0.0, -0.0, 1e-5, 1e-20, 1e20, 1e21, 1.2345678901234568e-05, 1e7, 1e15, 1e16, 12345678.9, -1e7, 5e-324, 1.7976931348623157e308, 1e22]
    values += [v for v in (struct.unpack("d", struct.pack("Q", rnd.getrandbits(64)))[0] for _ in range(3000)) if v == v and abs(v) != float("inf")]
    values += [round(rnd.uniform(-1e9, 1e9), rnd.randrange(6)) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(H.decimal_text(F.col("v"))).collect()]
    differ = [(v, g) for v, g in zip(values, got) if g != format(Decimal(repr(v)), "f")]
    assert len(differ) < 30 and all(float(g) == v and len(g.strip("-0.").replace(".", "")) >= 2 for v, g in differ)
    assert not [d for d in differ if 1e-3 < abs(d[0]) < 1e9]


def test_amounts_as_text(spark):
    given = ["1e3", " 12 ", "+5", "1.50", "abc", "", "  ", ".5", "5.", "007", "00.50", "-0.0", "1.5e-3", "-12.30E2", "0", "000", None]
    want = ["1000", "12", "5", "1.50", "abc", None, None, "0.5", "5", "7", "0.50", "-0.0", "0.0015", "-1230", "0", "0", None]
    df = spark.createDataFrame(list(enumerate(given)), "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(H.amount_text(F.col("v"), df.schema["v"].dataType)).collect()] == want


def test_hash_of_the_record_as_received(spark):
    """Undeclared keys count, absent and null keys differ, and lineage fields never count."""
    pages = ['{"dados":[{"id":1},{"id":1,"nome":null},{"id":1,"z":{"b":1.50,"a":[]}},{"z":{"a":[],"b":1.5},"id":1,"_record_uid":"x"}]}', '{"dados":[]}', "{}", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page int, raw string")
    rows = H.explode_raw(df, "raw", "page").orderBy("page", "pos").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    third = sha('{"id":1,"z":{"a":[],"b":"1.5"}}')
    assert [r.record_hash for r in rows] == [sha('{"id":1}'), sha('{"id":1,"nome":null}'), third, third]
    items = spark.createDataFrame([('{"id":5,"_x":1}',), ('{"id":"5"}',), ('{"nome":"a"}',)], "raw string")
    got = H.fingerprint_raw(items, "raw", "e").collect()
    assert [r.uid for r in got] == [sha(f'camara_dadosabertos|e|{{"id":{k}}}') for k in ("5", '"5"', "null")]
    assert [r.hash for r in got] == [sha('{"id":5}'), sha('{"id":"5"}'), sha('{"nome":"a"}')]


def test_pages_with_raw_text_hash_the_text(spark):
    raw = '{"dados":[{"id":1,"nome":"a","extra":2},{"id":2}],"links":[]}'
    row = [("r", "e", 1, "2024", "7", raw, [(1, "a"), (2, None)])]
    df = spark.createDataFrame(row, "pipeline_run_id string, execution_id string, page int, ingested_at string, parent_id string, raw string, dados array<struct<id:bigint,nome:string>>")
    out = E.enrich_pages(df, "evento_deputados", raw="raw").first()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert [d["_record_hash"] for d in out.dados] == [sha('{"extra":2,"id":1,"nome":"a"}'), sha('{"id":2}')]
    typed = E.enrich_pages(df.drop("raw"), "evento_deputados").first()
    assert [d["_record_uid"] for d in out.dados] == [d["_record_uid"] for d in typed.dados]


ODD_JSON = [
    '{"b":1,"a":null,"c":[1,{"z":0,"y":"x"}]}', ' {"a" : "sp ace" , "B":true}\n', '{"a":1.50}', '{"a":1e5}', '{"a":-0}', '{"a":-0.0}', '{"a":12345678901234567890123}',
    '{"a":999999999999999999}', '{"a":1} {"b":2}', '{"a":1}x', '{"a":1', '{"a":1,"a":2}', '{"_x":1,"a":2}', '{"a":{"_x":1}}', '{"_record_hash":"h","_record_uid":"u","id":3}',
    '{"a":"\\u00e9\\ud83d\\ude00"}', '{"a":"\\ud83d"}', '{"é":1,"z":2,"😀":3,"\uffee":4}', '{"a":"tab\\t nl\\n bs\\b ff\\f cr\\r q\\" s\\/ b\\\\"}', '{"a":"raw\x1fcontrol"}',
    '{"a":NaN}', '{"a":Infinity}', '{"a":"}{"}', '{"a":"} x"}', "{}", "[]", "[1]", "5", "null", '"text"', "", None, "nonsense", '{"a":"\x7f\u2028é"}', '{"a":[[],{}],"b":""}',
    '{"a":"3.5","b":3}', '{"10":1,"9":2,"A":3,"a":4,"_":5}',
]


def random_json(rnd, depth=0):
    kind = rnd.randrange(9 if depth < 3 else 6)
    if kind < 6:
        return [rnd.randrange(-10**6, 10**6), rnd.choice(["", "a b", "é", "x\ny", "ç/", "q\"", "\\\\"]), None, True, False, rnd.random()][kind]
    if kind == 6:
        return [random_json(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {rnd.choice("abcXYZé_09") + rnd.choice(["", "b", "Ç"]): random_json(rnd, depth + 1) for _ in range(rnd.randrange(5))}


@pytest.mark.parametrize("drop", ["record", "page", "underscore"])
def test_both_raw_routes_write_the_same(spark, drop):
    """What stays inside the JVM is what the other route would have written, byte by byte."""
    rnd = random.Random(11)
    texts = ODD_JSON + [json.dumps({"k": random_json(rnd), "é": i, "a": random_json(rnd)}, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1])) for i in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: (r.c, r.j) for r in df.select("i", H.canonical_raw(F.col("t"), drop).alias("c"), H._canonical_jvm(F.col("t")).alias("j")).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == H._canonical_text(t, drop), t
    assert sum(j is not None for _, j in got.values()) > 100
    items = df.groupBy((F.col("i") % 7).alias("k")).agg(F.collect_list("t").alias("page"), F.collect_list("i").alias("ids"))
    items = items.unionByName(spark.createDataFrame([(99, ['{"b":2,"a":1}', "{}"], [0, 1])], "k int, page array<string>, ids array<int>"))
    for r in items.select("page", H.canonical_items(F.col("page")).alias("c")).collect():
        assert list(r.c) == [H._canonical_text(t, "record") for t in r.page]


def test_plain_records_are_not_sent_to_python(spark):
    """The function gets null for what the JVM has written already."""
    df = H.fingerprint_raw(spark.createDataFrame([('{"id":1}',)], "raw string").repartition(1), "raw", "proposicoes")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    at = text.index("encode(")
    assert text[at : at + 20].startswith("encode(CASE WHEN")


def parts(df, *names):
    conf = "spark.sql.maxPlanStringLength"
    old = df.sparkSession.conf.get(conf)
    df.sparkSession.conf.set(conf, "10000000")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    df.sparkSession.conf.set(conf, old)
    return [text.count(n) for n in names]


def test_amounts_are_worked_out_once(spark):
    """Every part of an expense's identifier stands in the plan once, not once for every place that needs it."""
    item = F.struct(*[F.col("t").alias(n) for n in CEAP_UID_FIELDS])
    df = spark.range(1).select(F.col("id").cast("string").alias("t"), "id")
    uid = df.select(H.ceap_record_uid(item, F.col("id"), F.col("id"), F.col("id")).alias("uid"))
    regexes, writers = parts(uid, "regexp_extract", "StructsToJsonEvaluator")
    assert regexes <= 8 and writers == 1
    number = df.select(H.decimal_text(F.col("id").cast("double")).alias("n"))
    assert parts(number, "as double)") == [1]


def test_expense_pages_write_each_document_once(spark):
    """The envelope of an expense page: one text each for the identifier, the record and the payload."""
    rows = [("r", "e", 1, "2024", 5, 2024, 1, [tuple("x" for _ in CEAP_UID_FIELDS[:-1]) + (" 1.5e1",)])]
    fields = ",".join(f"{n}:string" for n in (*CEAP_UID_FIELDS[:-1], CEAP_UID_FIELDS[-1]))
    df = spark.createDataFrame(rows, f"pipeline_run_id string, execution_id string, page int, ingested_at string, id_deputado bigint, ano int, mes int, dados array<struct<{fields}>>")
    out = E.enrich_pages(df, "deputado_despesas", layout="ceap").select(F.col("dados")[0]["_record_uid"].alias("uid"), "_audit._payload_hash")
    assert parts(out, "StructsToJsonEvaluator")[0] <= 3 and parts(out, "regexp_extract")[0] <= 8
