"""Daily snapshots as validity intervals: one row for as long as nothing changes, instead of one a day.

A dated full copy of a table grows by the whole table every day. Here rows that are the same on consecutive snapshots
are one interval, from the day they first appear up to, not including, the first snapshot without them. The next day
is merged by one grouping of the open intervals and the new snapshot; closed ones are not touched. The snapshot of
any day is one filter, and a lookup "as of" a time is a join on the key with a range beside it: no interval is
written out by days.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.dates import day_literal

FROM, TO, COPIES = "VALID_FROM", "VALID_TO", "COPIES"
DAY = "SNAPSHOT_DATE"


def _columns(names: Sequence[str]) -> list:
    return [F.col(f"`{c}`") for c in names]


def _counted(rows: DataFrame, *by: Column) -> DataFrame:
    """Equal rows once, with COPIES.

    Each task counts before the shuffle, so a row with very many copies is no hot key. A task of a scan may give any number
    of rows, as where few bytes are decoded or multiplied, and would hold them all while it counts: rows are dealt out first.
    """
    return rows.hint("rebalance").groupBy(*by).agg(F.count(F.lit(1)).cast("int").alias(COPIES))


def to_intervals(snapshots: DataFrame, day: str = DAY, days: Sequence[date] | None = None) -> DataFrame:
    """Intervals of stored snapshots: their columns, COPIES (of equal rows in a snapshot), VALID_FROM and VALID_TO.

    VALID_TO is NULL while the last snapshot has the row. Days without a snapshot are no gap. ``days`` names the days of
    the snapshots where some are empty; without it these are the days that have rows.
    """
    names = [c for c in snapshots.columns if c != day]
    dated = snapshots.select(*_columns(names), F.col(day).cast("date").alias("_day"))
    rows = _counted(dated, *_columns(names), F.col("_day"))
    # One row per day of the calendar, so numbering and broadcasting it stay small.
    told = dated.select("_day") if days is None else rows.sparkSession.createDataFrame([(d,) for d in days], "_day date")
    days = told.distinct().select(
        "_day", F.row_number().over(Window.orderBy("_day")).alias("_n"), F.lead("_day").over(Window.orderBy("_day")).alias("_next")
    )
    numbered = rows.join(F.broadcast(days), "_day")
    # Of each run of days only the ends are kept, side by side: one sort, no map of runs beside it.
    same = [*_columns(names), F.col(COPIES)]
    in_order = Window.partitionBy(*same).orderBy("_n")
    begins = F.coalesce(F.lag("_n").over(in_order) != F.col("_n") - 1, F.lit(True))
    ends = F.coalesce(F.lead("_n").over(in_order) != F.col("_n") + 1, F.lit(True))
    kept = numbered.withColumns({"_begins": begins, "_ends": ends}).where(F.col("_begins") | F.col("_ends"))
    until = F.when(F.col("_ends"), F.col("_next")).otherwise(F.lead("_next").over(in_order))
    return kept.withColumn("_until", until).where("_begins").select(*same, F.col("_day").alias(FROM), F.col("_until").alias(TO))


def merge_day(intervals: DataFrame, snapshot: DataFrame, as_of: date) -> DataFrame:
    """The intervals after one more snapshot, of a day after all others. The same snapshot may be merged again.

    Rows the snapshot still has stay open, others are closed on this day, and new ones begin.
    """
    names = [c for c in intervals.columns if c not in (FROM, TO, COPIES)]
    today = _counted(snapshot.select(*_columns(names)), *_columns(names))
    never = F.lit(None).cast("date")
    open_ = intervals.where(F.col(TO).isNull()).select(*_columns(names), COPIES, FROM, F.lit(None).cast("boolean").alias("_now"))
    both = open_.unionByName(today.select(*_columns(names), COPIES, never.alias(FROM), F.lit(True).alias("_now")))
    merged = both.groupBy(*_columns(names), COPIES).agg(F.max(FROM).alias("_from"), F.max("_now").alias("_now"))
    changed = merged.select(
        *_columns(names), COPIES, F.coalesce("_from", day_literal(as_of)).alias(FROM), F.when(F.col("_now").isNull(), day_literal(as_of)).alias(TO)
    )
    closed = intervals.where(F.col(TO).isNotNull())
    return closed.unionByName(changed)


def valid_at(intervals: DataFrame, day: date) -> DataFrame:
    """The snapshot of a day: that of the last snapshot on or before it."""
    there = (F.col(FROM) <= day_literal(day)) & (F.col(TO).isNull() | (F.col(TO) > day_literal(day)))
    rows = intervals.where(there).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(COPIES))))
    return rows.drop("_copy", FROM, TO, COPIES)


def look_up(rows: DataFrame, intervals: DataFrame, keys: Sequence[str], moment: str, take: Sequence[str], how: str = "left") -> DataFrame:
    """``rows`` with the columns ``take`` as they were valid at ``moment``, NULL where nothing was.

    An equal join on the keys with the range beside it, which adaptive execution splits where one key has very many rows.
    """
    known = intervals.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], *_columns(take), FROM, TO)
    day = F.col(f"`{moment}`").cast("date")
    met = (day >= F.col(FROM)) & (F.col(TO).isNull() | (day < F.col(TO)))
    for i, k in enumerate(keys):
        met = met & (rows[k] == known[f"_k{i}"])
    return rows.join(known, met, how).select(*[rows[c] for c in rows.columns], *_columns(take))
