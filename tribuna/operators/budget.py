"""Dispatch budgets, resumable slices and cursors.

A budget needs the N-th enqueue row of a global order, for any N.  The order's
columns become numbers, and the N-th key is found by histograms: each pass
counts the rows of equal ranges, the range that holds the N-th is cut again,
column by column, until so few rows are left that they are ordered.  A pass
shuffles one row per range and task, nothing is sorted as a whole, and no task
ever holds N rows.  Every other row is then compared with that one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tribuna.session import cut_lineage

#: Ranges of a histogram, and rows that are no longer counted but ordered.
RANGES = 1024
REST = 4096
#: Bytes of a text that one number holds.
CHUNK = 7


def _key(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _is_enqueue() -> Column:
    return F.col("action").startswith("enqueue")


def numbers(df: DataFrame, order: list[str]) -> list[Column]:
    """The order's columns as numbers that sort alike; a null comes first, as it does in Spark.

    Texts become numbers of seven bytes each, as many as the longest of them has.
    """
    out = []
    for name in order:
        c, kind = F.col(name), df.schema[name].dataType
        if isinstance(kind, T.StringType):
            longest = df.agg(F.max(F.octet_length(name)).alias("n")).first().n or 0
            raw = F.hex(c.cast("binary"))
            for at in range(0, max(longest, 1), CHUNK):
                part = F.rpad(F.substring(raw, 2 * at + 1, 2 * CHUNK), 2 * CHUNK, "0")
                out.append(F.coalesce(F.conv(part, 16, 10).cast("bigint"), F.lit(-1)))
            out.append(F.coalesce(F.octet_length(name).cast("bigint"), F.lit(-1)))  # trailing zero bytes count too
            continue
        if isinstance(kind, T.DateType):
            c = F.unix_date(c)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        elif not isinstance(kind, (T.IntegralType, T.BooleanType)):
            raise ValueError(f"no order by {name}: {kind.simpleString()}")
        if df.schema[name].nullable:
            out.append(c.isNotNull().cast("bigint"))
        out.append(F.coalesce(c.cast("bigint"), F.lit(0)))
    return out


def nth(keys: DataFrame, columns: list[str], n: int) -> tuple | None:
    """The ``n``-th smallest row (from 1) of columns of whole numbers; None when fewer exist."""
    fixed: list[int] = []
    for i, c in enumerate(columns):
        span = keys.agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(F.lit(1)).alias("n")).first()
        if not i and n > span.n:
            return None
        lo, hi, left = span.lo, span.hi, span.n
        while lo < hi:
            if left <= REST:
                row = keys.orderBy(*columns[i:]).limit(n).agg(F.max(F.struct(*columns[i:])).alias("k")).first().k
                return (*fixed, *row)
            width = (hi - lo) // RANGES + 1
            # Differences of far numbers need more than 64 bits.
            at = F.floor((F.col(c).cast("decimal(20,0)") - F.lit(lo).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
            counts = {r.b: r.n for r in keys.groupBy(at.cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
            for b in sorted(counts):
                if n <= counts[b]:
                    break
                n -= counts[b]
            lo, hi, left = lo + b * width, min(hi, lo + (b + 1) * width - 1), counts[b]
            keys = keys.where(F.col(c).between(lo, hi))
        fixed.append(lo)
    return tuple(fixed)


def _placed(plan: DataFrame, order: list[str]) -> tuple[DataFrame, list[str]]:
    """The plan, evaluated once, with its order as numbers."""
    plan = cut_lineage(plan)
    found = numbers(plan, order)
    names = [f"_order{i}" for i in range(len(found))]
    return plan.withColumns(dict(zip(names, found))), names


def _within(placed: DataFrame, names: list[str], n: int | None) -> Column:
    """Whether a row comes no later than the N-th enqueue row."""
    cut = None if n is None else nth(placed.where(_is_enqueue()).select(*names), names, n)
    if cut is None:
        return F.lit(True)
    return F.struct(*names) <= F.struct(*[F.lit(v).cast("bigint").alias(c) for c, v in zip(names, cut)])


def apply_budget(plan: DataFrame, order: list[str], n: int) -> DataFrame:
    """Splits a plan at the N-th enqueue row: ``dispatch`` / ``deferred`` / ``skip``.

    The tick stops right after its N-th message, so later rows are deferred
    whatever their action was.  The plan runs once.
    """
    placed, names = _placed(plan, order)
    cut = _within(placed, names, n)
    outcome = F.when(~cut, F.lit("deferred")).when(_is_enqueue(), F.lit("dispatch")).otherwise(F.lit("skip"))
    return placed.withColumn("outcome", outcome).drop(*names)


def tallies(plan: DataFrame, *keys: str) -> DataFrame:
    """Seen / enqueued / skipped counts of a plan (per key)."""
    n = lambda cond: F.count_if(cond).alias
    a = F.col("action")
    return plan.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pairs_seen"),
        n(a.startswith("enqueue"))("enqueued"),
        n(a == "skip_same_hash")("skipped_same_hash"),
        n(a.isin("skip_queued", "skip_running"))("skipped_queued"),
        n(a.startswith("skip_success"))("skipped_success"),
    )


def backfill_summary(plan: DataFrame, order: list[str], item: list[str], n: int | None, dry_run: bool = True) -> DataFrame:
    """Counts of a budgeted backfill scan in one row.

    ``order`` starts with ``item``, the columns that order the list items.
    Pairs are visited in order; the scan stops at the first pair reached with
    the budget used up, and items are counted when the scan enters them; with
    ``n`` None the budget covers all pairs.  The
    plan's join runs once: its keys and actions are checkpointed and the four
    small passes read those.
    """
    plan, names = _placed(plan.select(*order, "action"), order)
    before = plan.withColumn("_in", _within(plan, names, n))
    stop_item = before.where(~F.col("_in")).agg(F.min(_key(order)).alias("stop"))
    stop = stop_item.scalar()
    entered = stop.isNull() | (_key(item) <= F.struct(*[stop.getField(c) for c in item]))
    a = F.col("action")
    counts = before.agg(
        F.count_if(F.col("_in") & a.startswith("enqueue")).alias("budget_used"),
        F.count_if(F.col("_in") & (a == "skip_same_hash")).alias("records_skipped_same_hash"),
        F.count_if(F.col("_in") & (a == "skip_queued")).alias("records_skipped_same_run"),
        F.coalesce(F.bool_or(~F.col("_in")), F.lit(False)).alias("limit_reached"),
    )
    first_pair = F.col(order[-1]) == 0  # one row per item: its first endpoint
    seen = plan.where(first_pair & entered).agg(F.count(F.lit(1)).alias("records_seen"))
    zero = F.lit(0).cast("bigint")
    return counts.select(
        seen.scalar().alias("records_seen"),
        (zero if dry_run else F.col("budget_used")).alias("messages_enqueued"),
        (F.col("budget_used") if dry_run else zero).alias("would_enqueue"),
        "records_skipped_same_hash", "records_skipped_same_run", "limit_reached",
        F.lit("DRY_RUN" if dry_run else None).alias("_dry"),
    ).select(
        "*",
        F.coalesce(
            "_dry", F.when(F.col("limit_reached"), F.lit("LIMIT_REACHED")).otherwise(F.lit("SUCCESS"))
        ).alias("status"),
    ).drop("_dry")


def page_slice(pages: DataFrame, next_page: Column, k: int, max_pages: int | None = None) -> DataFrame:
    """Pages ``[next_page, next_page + k - 1]`` of a resumable listing.

    Pages past the listing's end do not exist in the input, so the slice stops
    there by itself; ``next_page`` is a column so each run resumes at its own page.
    ``max_pages`` sets a further limit; by default there is none.
    """
    first = F.greatest(next_page, F.lit(1))
    return pages.where((F.col("page") >= first) & (F.col("page") <= F.least(first + (k - 1), F.lit(max_pages))))


def slice_checkpoint(sliced: DataFrame, *keys: str) -> DataFrame:
    """Checkpoint after a slice: done once a page without ``next`` was read."""
    done = F.bool_or(F.col("is_last"))
    return sliced.groupBy(*keys).agg(
        done.alias("listing_complete"),
        F.when(done, F.lit(1)).otherwise(F.max("page") + 1).cast("bigint").alias("list_next_page"),
    )


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """Exact 0-based position of each row in a global order.

    Rows are range-partitioned (a hot range is cut by sampling) and written to
    the checkpoint folder, so a partition's content is fixed.  One count per
    partition gives the offsets; rows are then numbered inside their partition.
    The offsets are one row per shuffle partition, hence safe to broadcast.
    """
    placed = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_part", "_offset")
    )


def resume_cursor(ordinal: Column, n_months: int, chunk: int = 100) -> Column:
    """Cursor (page, index, month index) of a position in deputies × months."""
    dep = F.floor(ordinal / n_months)
    return F.struct(
        (F.floor(dep / chunk) + 1).cast("int").alias("next_pagina"),
        (dep % chunk).cast("int").alias("next_idx"),
        (ordinal % n_months).cast("int").alias("next_month_idx"),
    )


def resume_at(pairs: DataFrame, pagina: int, idx: int, month_idx: int, n_months: int, chunk: int = 100) -> DataFrame:
    """Pairs at or after a saved cursor."""
    start = ((pagina - 1) * chunk + idx) * n_months + month_idx
    return pairs.where(F.col("ordinal") >= start)
