"""Fingerprint sets: last-wins per id, merge over ticks, change detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_wins(records: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """Fingerprint of the last record per id.

    ``max_by`` combines on the map side: an id with a third of all records
    ships one row per task.
    """
    return (
        records.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("string").alias("id"))
        .agg(F.max_by(F.struct("uid", "hash"), F.struct(*order)).alias("fp"))
        .select("id", "fp.uid", "fp.hash")
    )


def merge_fingerprints(saved: DataFrame, tick: DataFrame) -> DataFrame:
    """Saved map united with this tick's; the tick wins."""
    both = saved.select("id", "uid", "hash", F.lit(0).alias("_age")).unionByName(
        tick.select("id", "uid", "hash", F.lit(1).alias("_age"))
    )
    return last_wins(both, ["_age"])


def distinct_ids(pages: DataFrame, id_col: str = "id") -> DataFrame:
    return pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id")).distinct()


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Change per id between two sets: new, changed, unchanged or absent."""
    o, n = old.alias("o"), new.alias("n")
    same = (F.col("o.uid") == F.col("n.uid")) & (F.col("o.hash") == F.col("n.hash"))
    change = (
        F.when(F.col("o.id").isNull(), F.lit("new"))
        .when(F.col("n.id").isNull(), F.lit("absent"))
        .when(same, F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    return o.join(n, F.col("o.id") == F.col("n.id"), "full_outer").select(
        F.coalesce("o.id", "n.id").alias("id"), change.alias("change")
    )


def to_documents(fingerprints: DataFrame, key: str) -> DataFrame:
    """One ``{id: {uid, hash}}`` line per fingerprint, keyed by run.

    The map is written as many small documents; readers take their union, so no
    run's whole map has to fit in one row.
    """
    entry = F.to_json(F.create_map(F.col("id"), F.struct("uid", "hash")))
    return fingerprints.select(key, F.concat(F.lit('{"fingerprints":'), entry, F.lit("}")).alias("raw"))
