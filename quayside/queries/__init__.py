"""The registered queries: each operator on the given tables, beside the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.queries import catalog, differences, kept, loads, members, monthly, repair, sales, scalars, watch

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (repair, differences, loads, kept, catalog, monthly, sales, members, watch, scalars)


def all_queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: text for module in _MODULES for name, text in module.ORACLES.items()}
