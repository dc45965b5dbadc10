"""Query registry: every key of SURVEY §2 that is built, as a callable
``(spark, sf_dir) -> DataFrame``, plus its DuckDB oracle SQL."""

from __future__ import annotations

import importlib

MODULES = ["acl", "data", "catalog", "flows", "text", "docs", "streams"]


def _load():
    queries, oracle = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"relcheck.plans.{m}")
        queries.update(mod.QUERIES)
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
