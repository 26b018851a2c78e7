"""Records beside their text as received: every page is parsed once, and no row carries the page."""

import hashlib
import json

from pyspark.sql import functions as F

from tests.test_hashing import parts
from tribuna.operators import envelope as E
from tribuna.operators import layers as L

PAGES = "pipeline_run_id string, execution_id string, page int, ingested_at string, parent_id string, raw string, dados array<struct<id:bigint,nome:string>>"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def audited(spark, raws, items):
    rows = [("r", "e", i, "2024", "7", raw, dados) for i, (raw, dados) in enumerate(zip(raws, items))]
    return E.enrich_pages(spark.createDataFrame(rows, PAGES), "evento_deputados", raw="raw")


def test_each_page_is_parsed_once(spark):
    df = spark.range(1).select(*[F.col("id").cast("string").alias(n) for n in ("pipeline_run_id", "execution_id", "ingested_at", "parent_id", "raw")],
                               F.col("id").cast("int").alias("page"), F.array(F.struct("id", F.col("id").cast("string").alias("nome"))).alias("dados"))
    pages = E.enrich_pages(df, "evento_deputados", raw="raw")
    out = E.each_item(pages, F.col("dados")).select("pos", F.col("item._record_hash").alias("h"), F.col("item._record_uid").alias("u"))
    assert parts(out, "get_json_object", "from_json") == [1, 1]
    own = L.bronze(pages, raw="raw").select("pos", "_received", "_record_hash")
    assert parts(own, "get_json_object", "from_json") == [2, 2]  # the hash's and the text's
    generate = [line for line in own._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate" in line]
    assert len(generate) == 1 and "_items" not in own._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]


def test_texts_and_items_of_different_length(spark):
    """The parsed items give the rows; a text that is missing leaves its hash out, one too many is no record."""
    one, two = {"id": 1}, {"id": 2, "x": "1.5"}
    raws = [json.dumps({"dados": d}) for d in ([one, two], [one], [one, two])] + ["{broken", None, json.dumps({"dados": []})]
    items = [[(1, None), (2, None)], [(1, None), (2, None)], [(1, None)], [(3, None)], [(4, None)], None]
    rows = {(r._source_file.split("page_")[1][0], r.pos): r for r in L.bronze(audited(spark, raws, items), raw="raw").collect()}
    texts = {k: (r.item.id, r._received, r._record_hash) for k, r in rows.items()}
    plain, other = '{"id":1}', '{"id":2,"x":"1.5"}'
    assert texts == {
        ("0", 0): (1, plain, sha(plain)), ("0", 1): (2, other, sha(other)), ("1", 0): (1, plain, sha(plain)), ("1", 1): (2, None, None),
        ("2", 0): (1, plain, sha(plain)), ("3", 0): (3, None, None), ("4", 0): (4, None, None),
    }
