"""Historical load by year, and dated snapshots of a table."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.conditions import is_true
from quayside.functions.dates import day_literal, in_days
from quayside.operators.schema import STAMP
from quayside.operators.upsert import CREATED, stamped

YEAR = "LOAD_YEAR"


def _placed(first: int, last: int, moment: str):
    return in_days(F.col(moment), date(first, 1, 1), date(last + 1, 1, 1))


def historical_load(
    source: DataFrame, first: int, last: int, run_ts: datetime, moment: str = CREATED, stamp: str = STAMP
) -> DataFrame:
    """The source rows of the years ``first`` to ``last``, with the year to partition by.

    One scan serves all years. A source without the date column is loaded whole and once, with
    a NULL year.
    """
    if moment not in source.columns:
        return stamped(source.withColumn(YEAR, F.lit(None).cast("int")), run_ts, stamp)
    rows = source.where(_placed(first, last, moment)).withColumn(YEAR, F.year(moment))
    return stamped(rows, run_ts, stamp)


def unplaced_rows(source: DataFrame, first: int, last: int, moment: str = CREATED) -> DataFrame:
    """How many source rows fall in no year of the load, by reason."""
    reason = (
        F.when(F.col(moment).isNull(), F.lit("NO_DATE"))
        .when(F.year(moment) < first, F.lit("BEFORE"))
        .otherwise(F.lit("AFTER"))
    )
    outside = source.where(~is_true(_placed(first, last, moment)))
    return outside.groupBy(reason.alias("REASON")).agg(F.count(F.lit(1)).alias("ROW_COUNT"))


def snapshot_of(rows: DataFrame, as_of: date, day: str = "SNAPSHOT_DATE") -> DataFrame:
    """Rows as the snapshot of one day, to be written under a partition of that day."""
    return rows.withColumn(day, day_literal(as_of))


def snapshot_at(snapshots: DataFrame, as_of: date, day: str = "SNAPSHOT_DATE") -> DataFrame:
    """The snapshot of one day; only its partition is read."""
    return snapshots.where(F.col(day) == day_literal(as_of)).drop(day)


def snapshot_pair(snapshots: DataFrame, as_of: date, day: str = "SNAPSHOT_DATE") -> tuple[DataFrame, DataFrame]:
    """Today's and yesterday's snapshot."""
    return snapshot_at(snapshots, as_of, day), snapshot_at(snapshots, as_of - timedelta(days=1), day)
