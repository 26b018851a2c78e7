"""Scalar column rules: statuses, tolerant casts, keys, paths, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAFE_SEGMENT = r"[^\w.\-]+"
ID_RANK_TEXT = 10**18


def normalize_status(col: Column) -> Column:
    up = F.upper(F.trim(F.coalesce(col, F.lit(""))))
    return F.when(up == "PARTIALLY_COMPLETED", F.lit("PARTIAL")).otherwise(up)


def int_or_zero(col: Column) -> Column:
    """Integer value of a tolerant field: null, blank and garbage count as 0."""
    return F.coalesce(col.try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_iso_utc(col: Column) -> Column:
    """ISO-8601 text to timestamp; the session runs in UTC, bad text is null."""
    return F.try_to_timestamp(col)


def is_stale(ts: Column, now: Column, minutes: int, inclusive: bool = False) -> Column:
    """``ts`` lies more than ``minutes`` before ``now``; a null time is never stale."""
    limit = now - F.make_dt_interval(mins=F.lit(minutes))
    hit = (ts <= limit) if inclusive else (ts < limit)
    return F.coalesce(hit, F.lit(False))


def is_digits(col: Column) -> Column:
    return F.coalesce(col, F.lit("")).rlike(r"^[0-9]+$")


def numeric_id(col: Column) -> Column:
    """Numeric value of an all-digits id, else null."""
    return F.when(is_digits(col), col.try_cast("bigint"))


def id_order(col: Column) -> list[Column]:
    """Sort keys: numeric ids ascending first, then the others as text."""
    num = numeric_id(F.trim(col))
    return [
        F.coalesce(num, F.lit(ID_RANK_TEXT)),
        F.when(num.isNull(), F.trim(col)).otherwise(F.lit("")),
    ]


def has_next(links: Column) -> Column:
    """True when any link says ``next``; missing links mean the last page."""
    return F.coalesce(F.exists(links, lambda l: F.coalesce(l.getField("rel") == "next", F.lit(False))), F.lit(False))


def total_hint(links: Column, n_items: Column, page_size: int = 100) -> Column:
    """Record total promised by the ``last`` link: full pages before it plus this page."""
    pages = F.transform(
        F.filter(links, lambda l: l.getField("rel") == "last"),
        lambda l: F.regexp_extract(l.getField("href"), r"(?i)pagina=(\d+)", 1).try_cast("int"),
    )
    found = F.filter(pages, lambda p: p.isNotNull())
    return F.when(F.size(found) > 0, (F.get(found, F.lit(0)) - 1) * page_size + n_items)


def state_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def legacy_key(ano: Column, mes: Column, id_deputado: Column) -> Column:
    return F.format_string("%d_%02d_%d", ano, mes, id_deputado)


def safe_segment(col: Column) -> Column:
    return F.regexp_replace(col, SAFE_SEGMENT, "_")


def path_value(path: Column, name: str) -> Column:
    """Value of a ``name=value`` path segment, null when the segment is absent."""
    value = F.regexp_extract(path, rf"(?:^|/){name}=([^/]*)", 1)
    return F.when(value != "", value)


def months_list(raw: Column) -> Column:
    """Month integers in a JSON array; other elements dropped, bad JSON gives []."""
    items = F.from_json(raw, "array<string>")
    ints = F.transform(items, lambda m: F.when(F.trim(m).rlike(r"^-?[0-9]+$"), F.trim(m).try_cast("int")))
    empty = F.array().cast("array<int>")
    return F.coalesce(F.filter(ints, lambda m: m.isNotNull()), empty)


def normalize_document(raw: Column) -> Column:
    """CNPJ / CPF digits: up to 11 pad to a CPF, 12–14 to a CNPJ, else null."""
    digits = F.regexp_replace(F.coalesce(raw, F.lit("")), r"\D", "")
    n = F.length(digits)
    return (
        F.when((n > 0) & (n <= 11), F.lpad(digits, 11, "0"))
        .when((n > 11) & (n <= 14), F.lpad(digits, 14, "0"))
    )


def document_kind(digits: Column) -> Column:
    return F.when(F.length(digits) == 11, F.lit("CPF")).when(F.length(digits) == 14, F.lit("CNPJ"))


def boolish(col: Column) -> Column:
    """Flag text: 1/true/yes/on, anything else (or nothing) is false."""
    return F.lower(F.trim(F.coalesce(col.cast("string"), F.lit("")))).isin("1", "true", "yes", "on")


def iso_date(col: Column) -> Column:
    """Date of ISO text (``YYYY-MM-DD``, ``YYYYMMDD``, optional time), null when malformed."""
    dashed = col.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$")
    compact = col.rlike(r"^[0-9]{8}$")
    text = F.when(dashed, F.substring(col, 1, 10)).when(
        compact,
        F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2)),
    )
    return text.try_cast("date")
