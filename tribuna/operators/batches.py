"""Totals over ticks and batches, listing counts, detected parents."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tribuna import catalog
from tribuna.session import cut_lineage


def running_totals(df: DataFrame, keys: list[str], chunk: str, order: list[str], values: dict[str, str]) -> DataFrame:
    """Cumulative sums and a 1-based index per key, in two levels.

    ``chunk`` splits a key's rows into ordered pieces (a day, say): totals per
    chunk are accumulated first, rows only inside their chunk.  A hot key is
    therefore spread over its chunks and never sorted in one task.
    """
    sums = {f"_t_{v}": F.sum(F.col(v)).alias(f"_t_{v}") for v in values}
    per_chunk = df.groupBy(*keys, chunk).agg(F.count(F.lit(1)).alias("_t_n"), *sums.values())
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        *keys, chunk,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_o{c[2:]}") for c in ["_t_n", *sums]],
    )
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.join(offsets, [*keys, chunk])
    return out.select(
        *df.columns,
        (F.col("_o_n") + F.count(F.lit(1)).over(inside)).alias("batch_index"),
        *[(F.col(f"_o_{v}") + F.sum(v).over(inside)).alias(name) for v, name in values.items()],
    )


def batch_totals(batches: DataFrame, control: list[str], chunk: str, order: list[str]) -> DataFrame:
    """Batch index and running totals of a reconciliation control."""
    return running_totals(batches, control, chunk, order, {
        "records_seen": "records_seen_total",
        "messages_enqueued": "messages_enqueued_total",
        "records_skipped_same_hash": "skipped_same_hash_total",
    })


def idle_streak(ticks: DataFrame, keys: list[str], order: str, idle_limit: int = 3) -> DataFrame:
    """Consecutive ticks that queued nothing; ``idle_limit`` of them end the phase.

    A scan in two levels.  Rows are placed by ranges of key and order, so a key
    with a third of all ticks lies in many chunks.  A chunk is known by its idle
    ticks, those after its last busy tick, and whether it has a busy one; these
    are carried on from chunk to chunk of a key (a row per chunk), and rows add
    what was carried in until their chunk's first busy tick.
    """
    placed = cut_lineage(ticks.repartitionByRange(*keys, order).withColumn("_part", F.spark_partition_id()))
    busy, idle = (F.col("queued") > 0).cast("int"), (F.col("queued") == 0).cast("long")
    here = Window.partitionBy(*keys, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumn("_island", F.sum(F.coalesce(busy, F.lit(0))).over(here)).withColumn("_idle", F.coalesce(idle, F.lit(0)))
    chunk = rows.groupBy(*keys, "_part", "_island").agg(F.sum("_idle").alias("_n")).groupBy(*keys, "_part").agg(
        F.max("_island").alias("_last"), F.max_by("_n", "_island").alias("_tail"))
    broken = (F.col("_last") > 0).cast("int")
    so_far = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    chunk = chunk.withColumn("_breaks", F.sum(broken).over(so_far))
    # Chunks between two with busy ticks add up; the one with a busy tick adds its tail.
    until = Window.partitionBy(*keys, "_breaks").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    carried = chunk.withColumn("_sum", F.sum("_tail").over(until))
    into = carried.select(*keys, "_part", F.lag("_sum", 1, 0).over(Window.partitionBy(*keys).orderBy("_part")).alias("_carry"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_part"]]
    joined = rows.alias("r").join(into.alias("c"), reduce(and_, same)).select("r.*", "_carry")
    inside = Window.partitionBy(*keys, "_part", "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    streak = F.sum("_idle").over(inside) + F.when(F.col("_island") == 0, F.col("_carry")).otherwise(0)
    return (
        joined.withColumn("idle_ticks", streak.cast("bigint"))
        .withColumn("enqueue_phase_complete", F.col("idle_ticks") >= idle_limit)
        .drop("_part", "_island", "_idle", "_carry")
    )


def count_window(items: DataFrame, keys: list[str], warn_pages: int) -> DataFrame:
    """Exact distinct ids of a dry-run listing, over all its pages, and the page it ended at.

    ``items`` has ``page`` and ``id``.  ``warn_pages`` is the length from which a
    listing is reported as long; it cuts nothing.
    """
    top = F.max("page")
    return items.groupBy(*keys).agg(
        F.countDistinct(F.col("id").cast("string")).alias("distinct_ids"),
        top.alias("pages_fetched"),
        F.when(top >= warn_pages, F.lit("max_list_pages_reached_during_count")).alias("warning"),
    )


def parents_detected(parents: DataFrame, *keys: str) -> DataFrame:
    """Distinct parents per kind and the tasks they stand for."""
    workers = F.create_map(*[
        x for k, eps in catalog.SUB_ENDPOINTS.items() if k.endswith("_parent") for x in (F.lit(k), F.lit(len(eps)))
    ])
    return parents.groupBy(*keys, "kind").agg(F.countDistinct("id").alias("parents")).withColumn(
        "expected_tasks", F.col("parents") * F.element_at(workers, F.col("kind"))
    )
