"""All registered queries: name -> (callable, SQL twin or None)."""

from __future__ import annotations

from functools import wraps

from tribuna.plans import calendar, control, dispatch, gold, health, records, storage, streams
from tribuna.session import prepare

MODULES = (gold, records, calendar, control, dispatch, health, storage, streams)


def _prepared(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)

    return run


def all_queries() -> dict:
    out: dict = {}
    for module in MODULES:
        for name, entry in module.QUERIES.items():
            if name in out:
                raise ValueError(f"query {name} registered twice")
            fn, sql = entry
            out[name] = (_prepared(fn), sql)
    return out
