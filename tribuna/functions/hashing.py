"""Canonical JSON, SHA-256 identifiers and content hashes.

Two routes to the same bytes:

* **typed** – the record is a struct: keys are sorted when the struct is
  built and ``to_json`` writes it, all inside the JVM.  Null fields are kept.
* **raw text** – the record is JSON text whose absent and null keys must stay
  distinct.  VARIANT brings the keys into order inside the JVM; one small Arrow
  UDF re-encodes the texts whose numbers or escapes need more care.

Floats become plain decimal text *in quotes*, so 1234.5 and "1234.5" hash
alike and "1234.50" does not.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tribuna.catalog import CEAP_UID_FIELDS, SOURCE_SYSTEM

# Control characters whose \\u escape holds a hex letter; the writer prints it
# in upper case, the canonical form wants lower case.
_LETTERED_ESCAPES = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is worked out once, however often ``body`` names it.

    A column expression has no variables: a part that is named twice is written out twice, and
    nested rewrites of text grow with the power of their depth.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lower_escapes(text: Column) -> Column:
    def lower(raw: Column) -> Column:
        fixed = raw
        for code in _LETTERED_ESCAPES:
            fixed = F.regexp_replace(
                fixed, rf"((?<!\\)(?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}"
            )
        return F.when(raw.contains("\\u00"), fixed).otherwise(raw)

    return _let(text, lower)


def _without_exponent(text: Column) -> Column:
    def placed(p: Column) -> Column:
        digits, exponent = p["digits"], p["exponent"]
        point = exponent + 1
        whole = F.concat(F.rpad(digits, point, "0"), F.when(exponent < 16, F.lit(".0")).otherwise(F.lit("")))
        mixed = F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.lit(20)))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
        plain = F.when(exponent < 0, small).when(F.length(digits) <= point, whole).otherwise(mixed)
        return F.concat(p["sign"], plain)

    digits = F.regexp_replace(F.translate(F.substring_index(text, "E", 1), "-.", ""), "0+$", "")
    return _let(F.struct(
        F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign"), digits.alias("digits"),
        F.substring_index(text, "E", -1).cast("int").alias("exponent"),
    ), placed)


def decimal_text(value: Column) -> Column:
    """Plain decimal text of a double of any size: no exponent, at least one decimal below 1e16."""
    return _let(value.cast("string"), lambda t: F.when(t.contains("E"), _without_exponent(t)).otherwise(t))


def _number_text(text: Column) -> Column:
    """Text of a number, its exponent worked in."""
    number = r"^\s*([+-]?)0*(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,3}))?\s*$"
    stripped = lambda digits: F.coalesce(F.nullif(F.regexp_replace(digits, "^0+", ""), F.lit("")), F.lit("0"))

    def shifted(p: Column) -> Column:
        shift, digits = p["shift"], p["digits"]
        padded = F.lpad(digits, F.greatest(F.length(digits), 1 - shift), "0")
        pointed = _let(padded, lambda d: F.concat(
            stripped(F.substring(d, F.lit(1), F.length(d) + shift)), F.lit("."), F.substring(d, F.length(d) + shift + 1, -shift)))
        plain = F.when(shift < 0, pointed).otherwise(F.concat(stripped(digits), F.repeat(F.lit("0"), shift)))
        return F.concat(F.when(p["sign"] == "-", F.lit("-")).otherwise(F.lit("")), plain)

    def parted(p: Column) -> Column:
        exponent = F.coalesce(F.ltrim(p["exponent"], F.lit("+")).try_cast("int"), F.lit(0))
        return _let(F.struct(
            p["sign"].alias("sign"), F.concat(p["whole"], p["part"]).alias("digits"), (exponent - F.length(p["part"])).alias("shift"),
        ), shifted)

    names = ("sign", "whole", "part", "exponent")
    return _let(F.struct(*[F.regexp_extract(text, number, i + 1).alias(n) for i, n in enumerate(names)]), parted)


def amount_text(value: Column, dtype: T.DataType) -> Column:
    """An amount as plain decimal text; blank text counts as missing, text that is no number stays."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return decimal_text(value.cast("double"))

    def written(text: Column) -> Column:
        as_it_is = text.rlike(r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?\z")
        is_number = text.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?\s*$")
        return F.when(as_it_is, text).when(F.trim(text) != "", F.when(is_number, _number_text(text)).otherwise(text))

    return _let(value.cast("string"), written)


def normal_form(col: Column, dtype: T.DataType) -> Column:
    """Column rebuilt with sorted struct fields and floats as text, recursively."""
    if isinstance(dtype, T.StructType):
        fields = [normal_form(col.getField(f.name), f.dataType).alias(f.name)
                  for f in sorted(dtype.fields, key=lambda f: f.name)]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: normal_form(x, dtype.elementType))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return decimal_text(col.cast("double"))
    if isinstance(dtype, T.DecimalType):
        return col.cast("string")
    return col


def canonical_struct(fields: dict[str, Column]) -> Column:
    """Canonical JSON object of named columns; keys sorted, nulls kept."""
    record = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return _lower_escapes(F.to_json(record, {"ignoreNullFields": "false"}))


def canonical_typed(col: Column, dtype: T.StructType, drop=lambda name: False) -> Column:
    """Canonical JSON of a typed record, leaving out the fields ``drop`` names."""
    return canonical_struct({
        f.name: normal_form(col.getField(f.name), f.dataType)
        for f in dtype.fields if not drop(f.name)
    })


def _plain(token: str) -> str:
    return format(Decimal(repr(float(token))), "f")


def _canonical_text(raw: str | None, drop: str) -> str | None:
    try:
        doc = json.loads(raw, parse_float=_plain, parse_constant=str)
    except (TypeError, ValueError):
        return None
    if isinstance(doc, dict):
        if drop == "underscore":
            doc = {k: v for k, v in doc.items() if not k.startswith("_")}
        elif drop == "page":
            doc.pop("_audit", None)
            for item in doc["dados"] if isinstance(doc.get("dados"), list) else ():
                if isinstance(item, dict):
                    item.pop("_record_uid", None)
                    item.pop("_record_hash", None)
        else:
            doc.pop("_record_uid", None)
            doc.pop("_record_hash", None)
    text = json.dumps(doc, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    if "\\u" in raw:
        try:
            text.encode()
        except UnicodeEncodeError:  # half of a surrogate pair: no text
            return None
    return text


#: What the JVM route leaves to the other one: numbers with a fraction, an exponent or many digits, keys or texts
#: that start with an underscore, \\u escapes, anything behind a closing brace that is no part of the same document,
#: and letters beyond the basic plane, which sort differently.
_HARD = r'[0-9][.eE]|[0-9]{18}|"_|\\u|\}\s*[^\s,}\]]|[\x{10000}-\x{10FFFF}]'


def _canonical_jvm(raw: Column) -> Column:
    """Canonical JSON of an object as VARIANT writes it, keys in order; null where the other route is needed."""
    plain = raw.rlike(r"^\s*\{") & ~raw.rlike(_HARD)
    return F.when(plain, _lower_escapes(F.to_json(F.try_parse_json(raw))))


def canonical_raw(raw: Column, drop: str = "record") -> Column:
    """Canonical JSON of JSON text, null for text that does not parse.

    ``drop`` names the lineage keys to leave out: ``record`` (``_record_*``),
    ``page`` (``_audit`` and the items' ``_record_*``) or ``underscore``
    (every top-level key that starts with ``_``, used for list items).

    Records without fractions, escapes and lineage keys are written inside the
    JVM; only the others are sent to Python.
    """

    @F.pandas_udf("string")
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _canonical_text(t, drop))

    text = _canonical_jvm(raw)
    return F.coalesce(text, encode(F.when(text.isNull(), raw)))


def _items_written(texts: Column, items: Column) -> Column:
    """The texts that the JVM wrote, or those of the other route where one of a page is missing."""

    @F.pandas_udf("array<string>")
    def encode(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: None if page is None else [_canonical_text(t, "record") for t in page])

    hard = F.exists(texts, lambda t: t.isNull())
    return F.when(~hard, texts).otherwise(encode(F.when(hard, items)))


def canonical_items(items: Column) -> Column:
    """Canonical JSON of each record text of an array; pages of plain records stay inside the JVM."""
    return _items_written(F.transform(items, _canonical_jvm), items)


def with_canonical_items(pages: DataFrame, raw: str, name: str) -> DataFrame:
    """Adds the canonical JSON of each record of a page's text; every step is a column, so that it is done once a page."""
    items, texts = f"{name}_items", f"{name}_texts"
    out = pages.withColumn(items, raw_items(F.col(raw))).withColumn(texts, F.transform(items, _canonical_jvm))
    return out.withColumn(name, _items_written(F.col(texts), F.col(items))).drop(items, texts)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def payload_hash(raw_page: Column) -> Column:
    return sha256(canonical_raw(raw_page, "page"))


def record_hash_raw(raw_record: Column) -> Column:
    return sha256(canonical_raw(raw_record, "record"))


def raw_items(raw_page: Column, path: str = "$.dados") -> Column:
    """The records of a page as JSON texts, in order, with every key they came with."""
    return F.from_json(F.get_json_object(raw_page, path), T.ArrayType(T.StringType()))


def explode_raw(pages: DataFrame, raw: str, *keep: str) -> DataFrame:
    """One row per record as received: its position, its text and its content hash."""
    items = pages.select(*keep, F.posexplode(raw_items(F.col(raw))).alias("pos", "item"))
    return items.withColumn("record_hash", record_hash_raw(F.col("item")))


def fingerprint_raw(df: DataFrame, raw: str, entity: str, business_keys=("id",)) -> DataFrame:
    """Adds ``uid`` and ``hash`` of a list item as received; ``_`` fields never count, absent and null keys differ.

    Keys keep their JSON type: 5 and "5" are different ids.
    """
    doc = F.try_parse_json(F.col(raw))
    keys = [F.concat(F.lit(f'"{k}":'), F.coalesce(F.to_json(F.try_variant_get(doc, f"$.{k}", "variant")), F.lit("null"))) for k in sorted(business_keys)]
    ids = F.concat(F.lit(f"{SOURCE_SYSTEM}|{entity}|{{"), F.concat_ws(",", *keys), F.lit("}"))
    return df.withColumns({"uid": sha256(ids), "hash": sha256(canonical_raw(F.col(raw), "underscore"))})


def record_hash(col: Column, dtype: T.StructType) -> Column:
    """Content hash of a typed record without its own lineage fields."""
    return sha256(canonical_typed(col, dtype, lambda n: n in ("_record_uid", "_record_hash")))


def record_uid(source: str, entity: str, keys: dict[str, Column]) -> Column:
    """``sha256(source|entity|canonical keys)``; null when every key is null."""
    uid = sha256(F.concat(F.lit(f"{source}|{entity}|"), canonical_struct(keys)))
    return F.when(F.coalesce(*[k.cast("string") for k in keys.values()]).isNotNull(), uid)


def resolve_path(raw: Column, path: str) -> Column:
    """Dotted-path lookup in JSON text; null when a node is missing or not an object."""
    return F.get_json_object(raw, "$." + path)


def field_at(col: Column, path: str) -> Column:
    """Dotted-path lookup in a struct column."""
    for part in path.split("."):
        col = col.getField(part)
    return col


def endpoint_record_uid(col: Column, entity: str, business_keys, source: str = SOURCE_SYSTEM) -> Column:
    return record_uid(source, entity, {k: field_at(col, k) for k in business_keys})


def ceap_record_uid(item: Column, id_deputado: Column, ano: Column, mes: Column, amount: T.DataType = T.StringType()) -> Column:
    """Expense UID: the three context keys plus the nine document fields; ``amount`` is the type of ``valorDocumento``."""
    keys = {name: item.getField(name) for name in CEAP_UID_FIELDS}
    keys["valorDocumento"] = amount_text(item.getField("valorDocumento"), amount)
    keys |= {"id_deputado": id_deputado.cast("long"), "ano": ano.cast("int"), "mes": mes.cast("int")}
    return record_uid(SOURCE_SYSTEM, "deputado_despesas", keys)


def deputy_record_uid(raw_id: Column) -> Column:
    """Deputy UID; an id that is not an integer gives null."""
    return record_uid(SOURCE_SYSTEM, "deputado", {"id": raw_id.cast("string").try_cast("bigint")})


def list_item_fingerprint(df: DataFrame, col_name: str, entity: str, business_keys=("id",)) -> DataFrame:
    """Adds ``uid`` and ``hash`` of a typed list item; ``_`` fields never count.

    The UID is present even when all keys are null, unlike a record UID.
    """
    dtype = df.schema[col_name].dataType
    col = F.col(col_name)
    keys = canonical_struct({k: field_at(col, k) for k in business_keys})
    return df.withColumns({
        "uid": sha256(F.concat(F.lit(f"{SOURCE_SYSTEM}|{entity}|"), keys)),
        "hash": sha256(canonical_typed(col, dtype, lambda n: n.startswith("_"))),
    })
