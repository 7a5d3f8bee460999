"""Predicates with the three-valued logic of a SQL DELETE or WHERE spelled out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_condition(predicate: str | Column) -> Column:
    """Catalog text or a column."""
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def is_true(predicate: str | Column) -> Column:
    """TRUE stays true; FALSE and UNKNOWN become false."""
    return F.coalesce(as_condition(predicate), F.lit(False))


def all_zero(columns: Sequence[str]) -> Column:
    """True only if every column equals 0. A NULL is not 0."""
    if not columns:
        raise ValueError("all_zero needs at least one column")
    return reduce(lambda a, b: a & b, [is_true(F.col(f"`{c}`") == 0) for c in columns])


def in_use(column: str = "DEL_YN") -> Column:
    """Not marked as deleted. A NULL mark also drops the row, as ``!=`` does in SQL."""
    return F.col(column) != "Y"


