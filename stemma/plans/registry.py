"""All registered queries of the core and their SQL."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stemma import plans

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    for m in sorted(pkgutil.iter_modules(plans.__path__), key=lambda m: m.name):
        if m.name.startswith("q_"):
            yield importlib.import_module(f"stemma.plans.{m.name}")


def queries() -> dict[str, Query]:
    return {name: q for m in _modules() for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.SQL.items()}
