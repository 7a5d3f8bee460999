"""Database reads and writes through Spark's JDBC source.

Filters and column choice on these frames are pushed into the database. Grouping is not, so the
monthly counts and the column catalog are read as subqueries that the database runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.dates import shift_months
from quayside.operators.reconcile import COUNTED_MONTHS
from quayside.operators.schema import trimmed
from quayside.plans.settle import settle

# Every column of every table, with its place in the primary key. Foreign and unique keys do not count.
COLUMN_CATALOG = """
SELECT c.TABLE_NAME, c.COLUMN_NAME, c.ORDINAL_POSITION, c.DATA_TYPE, c.NUMERIC_PRECISION, c.NUMERIC_SCALE,
       c.IS_NULLABLE, k.KEY_POSITION
FROM INFORMATION_SCHEMA.COLUMNS c
LEFT JOIN (SELECT u.TABLE_SCHEMA, u.TABLE_NAME, u.COLUMN_NAME, u.ORDINAL_POSITION AS KEY_POSITION
           FROM INFORMATION_SCHEMA.KEY_COLUMN_USAGE u
           JOIN INFORMATION_SCHEMA.TABLE_CONSTRAINTS p
             ON p.CONSTRAINT_NAME = u.CONSTRAINT_NAME AND p.TABLE_SCHEMA = u.TABLE_SCHEMA AND p.TABLE_NAME = u.TABLE_NAME
           WHERE p.CONSTRAINT_TYPE = 'PRIMARY KEY') k
  ON k.TABLE_SCHEMA = c.TABLE_SCHEMA AND k.TABLE_NAME = c.TABLE_NAME AND k.COLUMN_NAME = c.COLUMN_NAME
""".strip()


def _identifier(name: str) -> str:
    if not re.fullmatch(r'[\w.\[\]"]+', name):
        raise ValueError(f"not a table or column name: {name}")
    return name


def range_predicates(column: str, edges: Sequence[date | int]) -> list[str]:
    """Splits a table into half-open ranges of a column, each read by its own task.

    ``edges`` ascend. Before the first, from the last on and without value are ranges too, so that
    each row of the table is in exactly one of them.
    """
    if not edges or any(a >= b for a, b in zip(edges[:-1], edges[1:], strict=True)):
        raise ValueError("edges must ascend")
    name = _identifier(column)
    texts = [str(e) if isinstance(e, int) else f"'{e}'" for e in edges]
    inside = [f"{name} >= {low} AND {name} < {high}" for low, high in zip(texts[:-1], texts[1:], strict=True)]
    return [*inside, f"{name} < {texts[0]}", f"{name} >= {texts[-1]}", f"{name} IS NULL"]


def year_predicates(moment: str, first: int, last: int) -> list[str]:
    """One range per year, and the rows outside these years or without a date."""
    return range_predicates(moment, [date(year, 1, 1) for year in range(first, last + 2)])


def month_predicates(moment: str, first: date, last: date) -> list[str]:
    """One range per month from that of ``first`` to that of ``last``, and all rows outside. For large years."""
    months = (last.year - first.year) * 12 + last.month - first.month
    return range_predicates(moment, [shift_months(first, k) for k in range(months + 2)])


def key_predicates(key: str, low: int, high: int, parts: int) -> list[str]:
    """About ``parts`` equal ranges of a numeric key from ``low`` to ``high``, and all rows outside. For undated tables."""
    if parts < 1 or high < low:
        raise ValueError("needs a part and a range")
    step = -(-(high - low + 1) // parts)
    return range_predicates(key, [*range(low, high + 1, step), high + 1])


Bins = Mapping[int, int]


def histogram(df: DataFrame, column: str, low: int, width: int) -> DataFrame:
    """Rows per range of ``width`` of a whole-number column, from ``low`` on: bin, n. Rows below and without value are left out."""
    number = F.col(f"`{column}`").cast("bigint")
    inside = df.where(number >= low)
    return inside.groupBy(F.call_function("div", number - F.lit(low), F.lit(width)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram_query(table: str, column: str, low: int, width: int, end: int) -> str:
    """``histogram`` up to, not including, ``end``, counted by the database: one row per range leaves it."""
    name = _identifier(column)
    return (
        f"SELECT FLOOR(({name} - {low}) / {width}) AS bin, COUNT(*) AS n FROM {_identifier(table)} "
        f"WHERE {name} >= {low} AND {name} < {end} GROUP BY FLOOR(({name} - {low}) / {width})"
    )


def balanced_edges(counts: Callable[[int, int, int], Bins], low: int, high: int, parts: int, bins: int = 1024) -> list[int]:
    """Edges that cut a whole-number column from ``low`` to ``high`` into ``parts`` ranges with about equally many rows.

    ``counts(low, end, width)`` asks for the rows per range of a width, at most ``bins`` of them at a time. A range that holds
    more than half a part is asked for again in narrower ranges, so that a crowded stretch is cut where it is crowded; a single
    value is never cut. For ``range_predicates``, as is, and for columns whose values are not spread evenly.
    """
    if parts < 1 or high < low:
        raise ValueError("needs a part and a range")
    width = -(-(high - low + 1) // bins)
    cells = sorted((low + b * width, width, n) for b, n in counts(low, high + 1, width).items() if n)
    total = sum(n for _, _, n in cells)
    share = max(1.0, total / parts)
    while crowded := [c for c in cells if c[2] > share / 2 and c[1] > 1]:
        fine = [c for c in cells if c not in set(crowded)]
        for start, size, _ in crowded:
            narrow = -(-size // 64)
            end = min(start + size, high + 1)
            fine += [(start + b * narrow, narrow, n) for b, n in counts(start, end, narrow).items() if n]
        cells = sorted(fine)
    edges, held = [low], 0.0
    for start, _, n in cells:
        # A cell goes where it leaves the range nearer to its share.
        if start > edges[-1] and held and held + n - share > share - held:
            edges.append(start)
            held = 0.0
        held += n
    return [*edges, high + 1]


def balanced_predicates(
    spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, properties: Mapping[str, str]
) -> list[str]:
    """``key_predicates`` with ranges of about equally many rows; the database counts them."""

    def counts(start: int, end: int, width: int) -> Bins:
        rows = _read_query(spark, url, histogram_query(table, column, start, width, end), properties).collect()
        return {int(r[0]): int(r[1]) for r in rows}

    return range_predicates(column, balanced_edges(counts, low, high, parts))


def month_counts_query(table: str, moment: str, as_of: date, months: int = COUNTED_MONTHS) -> str:
    """Rows per month since the first day of the month ``months`` ago, counted by the database."""
    column = _identifier(moment)
    since = shift_months(as_of, -months)
    return (
        f"SELECT YEAR({column}) AS y, MONTH({column}) AS m, COUNT(*) AS n FROM {_identifier(table)} "
        f"WHERE {column} >= '{since}' GROUP BY YEAR({column}), MONTH({column})"
    )


def read_database(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], predicates: Sequence[str], trim: bool = False
) -> DataFrame:
    """A database table in one read per predicate; see ``range_predicates``. A table is never read by one task.

    ``trim`` takes the padding off text columns, so that keys of fixed width meet those of a target without it.
    """
    if not predicates:
        raise ValueError("split the table by predicates")
    rows = spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))
    return trimmed(rows) if trim else rows


def _read_query(spark: SparkSession, url: str, query: str, properties: Mapping[str, str]) -> DataFrame:
    """A short result that the database computes, one row per month or column, in one read."""
    return spark.read.jdbc(url, f"({query}) q", properties=dict(properties))


def labelled_counts(counted: DataFrame, job: str, name: str = "row_count") -> DataFrame:
    """Year and month numbers as the ``yyyy-MM`` labels of ``monthly_counts``."""
    label = F.format_string("%04d-%02d", F.col("y").cast("int"), F.col("m").cast("int"))
    return counted.select(F.lit(job).alias("job_code"), label.alias("date"), F.col("n").cast("bigint").alias(name))


def read_month_counts(
    spark: SparkSession,
    url: str,
    job: str,
    table: str,
    moment: str,
    as_of: date,
    properties: Mapping[str, str],
    months: int = COUNTED_MONTHS,
) -> DataFrame:
    """The monthly counts of a source table; only one row per month leaves the database."""
    return labelled_counts(_read_query(spark, url, month_counts_query(table, moment, as_of, months), properties), job)


def read_column_catalog(spark: SparkSession, url: str, properties: Mapping[str, str]) -> DataFrame:
    """The column catalog of a database, the input of ``derive_schema``."""
    return _read_query(spark, url, COLUMN_CATALOG, properties)


class Target(NamedTuple):
    """A database table that a copy fills."""

    url: str
    table: str
    properties: Mapping[str, str]


def copy_options(properties: Mapping[str, str], batch_rows: int) -> dict[str, str]:
    """Empty the table and keep its definition, unless ``properties`` say otherwise."""
    return {"truncate": "true", "batchsize": str(batch_rows), **properties}


def copy_to_database(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_rows: int = 10_000
) -> None:
    """Empty a database table and fill it again, keeping its definition."""
    df.write.jdbc(url, table, mode="overwrite", properties=copy_options(properties, batch_rows))


def copy_to_databases(df: DataFrame, targets: Sequence[Target], batch_rows: int = 10_000) -> DataFrame:
    """Fill several databases with the same rows: ``df`` is read once and stored, and the stored rows are copied."""
    rows = settle(df, "copied")
    for target in targets:
        copy_to_database(rows, *target, batch_rows)
    return rows
