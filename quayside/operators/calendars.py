"""Month calendars: the open accounting month, and balances at month ends."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.dates import day_literal, month_end, month_label, ntz, on_day, shift_months

CLOSE_MONTHS = 24
BALANCE_MONTHS = 25


def month_spine(spark: SparkSession, as_of: date, months: int = CLOSE_MONTHS) -> DataFrame:
    """One row per month, the last ``months`` months including this one."""
    first, last = shift_months(as_of, 1 - months), shift_months(as_of, 0)
    starts = F.explode(F.sequence(day_literal(first), day_literal(last), F.expr("interval 1 month")))
    return spark.range(0, 1, 1, 1).select(starts.alias("MONTH_START"))


def open_month(
    close_table: DataFrame, as_of: date, months: int = CLOSE_MONTHS, min_year: int | None = None
) -> DataFrame:
    """The earliest month that is not closed or was closed yesterday, with its first and last day.

    A month the close table does not know is open. No open month gives no row. The calendar and
    the close table meet in one grouping by month.
    """
    spine = month_spine(close_table.sparkSession, as_of, months)
    if min_year is not None:
        spine = spine.where(F.year("MONTH_START") >= min_year)
    first, last = shift_months(as_of, 1 - months), shift_months(as_of, 0)
    still_open = (F.coalesce("BI_CLOSE_YN", F.lit("N")) == "N") | (
        (F.col("BI_CLOSE_YN") == "Y") & on_day(F.col("BI_CLOSE_DAY"), as_of - timedelta(days=1))
    )
    known = close_table.where(
        F.col("CLOSE_YYYY_MM").between(first.strftime("%Y-%m"), last.strftime("%Y-%m"))
    ).select("CLOSE_YYYY_MM", F.lit(0).alias("_spine"), still_open.cast("int").alias("_open"))
    rows = spine.select(
        month_label(F.col("MONTH_START")).alias("CLOSE_YYYY_MM"),
        F.lit(1).alias("_spine"),
        F.lit(None).cast("int").alias("_open"),
    ).unionByName(known)
    by_month = rows.groupBy("CLOSE_YYYY_MM").agg(
        F.max("_spine").alias("_spine"),
        F.max("_open").alias("_open"),
        F.sum(1 - F.col("_spine")).alias("_known"),
    )
    open_months = by_month.where(
        (F.col("_spine") == 1) & ((F.col("_known") == 0) | (F.col("_open") == 1))
    )
    start = F.to_date(F.concat("CLOSE_YYYY_MM", F.lit("-01")))
    return (
        open_months.agg(F.min("CLOSE_YYYY_MM").alias("CLOSE_YYYY_MM"))
        .where(F.col("CLOSE_YYYY_MM").isNotNull())
        .select("CLOSE_YYYY_MM", start.alias("START_DATE"), F.last_day(start).alias("END_DATE"))
    )


def month_end_snapshots(
    movements: DataFrame,
    keys: Sequence[str],
    moment: str,
    amount: str,
    as_of: date,
    run_ts: datetime,
    months: int = BALANCE_MONTHS,
) -> DataFrame:
    """The balance per key at each of the last month ends, this month's end included.

    A balance is the sum of the amounts dated on or before the month end; a key has no row
    before its first movement. All month ends are summed side by side in one grouping, so a
    movement is shuffled at most once, already summed per task, and not once per month end.
    """
    ends = [month_end(as_of, -tick) for tick in range(months)]
    dated = [(end, F.col(moment) < ntz(end + timedelta(days=1))) for end in ends]
    sums = [F.sum(F.when(due, F.col(amount))).alias(f"_b{i}") for i, (_, due) in enumerate(dated)]
    wide = (
        movements.where(dated[0][1])
        .groupBy(*keys)
        .agg(F.min(moment).alias("_first"), *sums)
    )
    balances = F.inline(
        F.array(
            *[
                F.struct(day_literal(end).alias("END_DATE"), F.col(f"_b{i}").alias("BALANCE"))
                for i, end in enumerate(ends)
            ]
        )
    )
    return (
        wide.select(*keys, "_first", balances)
        .where(F.col("_first") < F.date_add("END_DATE", 1))
        .select(
            *keys,
            "BALANCE",
            ntz(run_ts).alias("ADATETIME"),
            month_label(F.col("END_DATE")).alias("CHECK_MONTH"),
        )
    )


def sparse_balances(
    movements: DataFrame, keys: Sequence[str], moment: str, amount: str, as_of: date, months: int = BALANCE_MONTHS
) -> DataFrame:
    """The balances of ``month_end_snapshots`` that differ from those a month before: keys, BALANCE, END_DATE.

    A key has a row for each month end whose month has movements, and one at the first month end for all that was before.
    Movements are summed per key and month in the tasks, so the running total goes over a few rows per key.
    """
    first, last = month_end(as_of, -(months - 1)), month_end(as_of)
    end = F.greatest(F.last_day(F.to_date(moment)), day_literal(first))
    moved = (
        movements.where(F.col(moment) < ntz(last + timedelta(days=1)))
        .groupBy(*keys, end.alias("END_DATE"))
        .agg(F.sum(amount).alias("_moved"))
    )
    total = F.sum("_moved").over(Window.partitionBy(*keys).orderBy("END_DATE"))
    return moved.select(*keys, total.alias("BALANCE"), "END_DATE")


def add_month(sparse: DataFrame, movements: DataFrame, keys: Sequence[str], amount: str, end: date) -> DataFrame:
    """Sparse balances after one more month, that of ``end``, of which ``movements`` are all. Former rows stay as they are."""
    moved = movements.groupBy(*keys).agg(F.sum(amount).alias("_moved"))
    last = balances_at(sparse, keys, end)
    # Amounts that are all missing leave a balance as it is.
    total = F.when(F.col("BALANCE").isNull(), F.col("_moved")).otherwise(F.col("BALANCE") + F.coalesce("_moved", F.lit(0)))
    new = moved.join(last, list(keys), "left").select(*keys, total.alias("BALANCE"), day_literal(end).alias("END_DATE"))
    return sparse.unionByName(new)


def balances_at(sparse: DataFrame, keys: Sequence[str], end: date) -> DataFrame:
    """The balance of each key at a month end: its last row up to it."""
    return sparse.where(F.col("END_DATE") <= day_literal(end)).groupBy(*keys).agg(F.max_by(F.struct("BALANCE"), "END_DATE")["BALANCE"].alias("BALANCE"))


def carried_forward(sparse: DataFrame, keys: Sequence[str], as_of: date, run_ts: datetime) -> DataFrame:
    """``month_end_snapshots`` from sparse balances: each one carried to the month end before the key's next."""
    following = F.lead("END_DATE").over(Window.partitionBy(*keys).orderBy("END_DATE"))
    until = F.coalesce(F.add_months(F.trunc("_next", "month"), -1), day_literal(month_end(as_of).replace(day=1)))
    months = F.sequence(F.trunc("END_DATE", "month"), until, F.expr("INTERVAL 1 MONTH"))
    return sparse.withColumn("_next", following).withColumn("_month", F.explode(months)).select(
        *keys, "BALANCE", ntz(run_ts).alias("ADATETIME"), month_label(F.col("_month")).alias("CHECK_MONTH")
    )


def snapshot_sizes(snapshots: DataFrame) -> DataFrame:
    """Rows per month end, and the rows of all month ends up to it."""
    sizes = snapshots.groupBy("CHECK_MONTH").agg(F.count(F.lit(1)).alias("row_count"))
    # One row per calendar month.
    return sizes.withColumn("total_rows", F.sum("row_count").over(Window.orderBy("CHECK_MONTH")))
