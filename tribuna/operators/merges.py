"""State merges.  Both are one equi-join on the keys; no row lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _columns(base: DataFrame, delta: DataFrame, keys: list[str], skip=()) -> list[str]:
    return [c for c in dict.fromkeys(base.columns + delta.columns) if c not in keys and c not in skip]


def _pick(side: str, df: DataFrame, name: str):
    return F.col(f"{side}.{name}") if name in df.columns else F.lit(None)


def upsert_merge(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Key-value merge: a null in ``delta`` keeps the old value."""
    b, d = base.alias("b"), delta.alias("d")
    joined = b.join(d, [F.col(f"b.{k}") == F.col(f"d.{k}") for k in keys], "full_outer")
    return joined.select(
        *[F.coalesce(F.col(f"d.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
        *[F.coalesce(_pick("d", delta, c), _pick("b", base, c)).alias(c) for c in _columns(base, delta, keys)],
    )


def upsert_replace(base: DataFrame, delta: DataFrame, keys: list[str], cleared: str = "cleared") -> DataFrame:
    """Replacing merge: columns named in ``delta.cleared`` are removed, others merge.

    SQL null cannot mean both "not sent" and "remove", hence the explicit list.
    """
    b, d = base.alias("b"), delta.alias("d")
    joined = b.join(d, [F.col(f"b.{k}") == F.col(f"d.{k}") for k in keys], "full_outer")
    gone = F.coalesce(F.col(f"d.{cleared}"), F.array().cast("array<string>"))
    return joined.select(
        *[F.coalesce(F.col(f"d.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
        *[
            F.when(~F.array_contains(gone, c), F.coalesce(_pick("d", delta, c), _pick("b", base, c))).alias(c)
            for c in _columns(base, delta, keys, (cleared,))
        ],
    )
