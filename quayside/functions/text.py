"""Text and number expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(columns: Sequence[str], separator: str = "|") -> Column:
    """Key parts as one text, for display only. Joins use the typed columns."""
    return F.concat_ws(separator, *[F.col(c).cast("string") for c in columns])


def swap_suffix(column: Column, suffix: str, replacement: str = "") -> Column:
    """Replace a literal suffix where it is present."""
    stem = F.left(column, F.length(column) - len(suffix))
    return F.when(F.endswith(column, F.lit(suffix)), F.concat(stem, F.lit(replacement))).otherwise(column)


def whole_number(column: Column) -> Column:
    """Text to a whole number; NULL where the text is none.

    The pattern comes first because a failing cast is some twenty times slower than a match.
    """
    return F.when(column.rlike(r"^\s*[+-]?[0-9]+\s*$"), column.try_cast("bigint"))


def error_mark(condition: Column) -> Column:
    """``Error`` where the condition holds, else empty text."""
    return F.when(condition, F.lit("Error")).otherwise(F.lit(""))
