"""Rows per month of a table, kept up by what each load adds and removes instead of counted anew.

A load notes the difference it makes per month as one small part of the counter table, under its run's name, so a
repeated run notes it once. The counts are the sums of the differences. From time to time an audit counts the table and
notes what the sums were wrong by, which it also returns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.conditions import is_true
from quayside.functions.dates import month_label, shift_months
from quayside.operators.reconcile import COUNTED_MONTHS
from quayside.operators.upsert import CREATED, UPDATED, replaced_keys
from quayside.plans.publish import publish_parts
from quayside.plans.settle import settle
from quayside.sources.scans import table_exists

RUN = "RUN"


def _by_month(rows: DataFrame, moment: str, sign: int) -> DataFrame:
    """Grouped by a date and labelled afterwards; rows without a date are a month of their own."""
    counted = rows.groupBy(F.trunc(moment, "month").alias("_month")).agg((F.count(F.lit(1)) * sign).alias("delta"))
    return counted.select(month_label(F.col("_month")).alias("date"), "delta")


def removed_by(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], target_pred, updated: str = UPDATED, strict: bool = False
) -> DataFrame:
    """The target rows that ``incremental_upsert`` of the batch removes, each once."""
    inside = target.where(is_true(target_pred))
    replaced = replaced_keys(batch, keys, updated, strict) if keys else None
    if replaced is None:
        return inside
    outside = target.where(~is_true(target_pred))
    return inside.unionByName(outside.join(replaced, list(keys), "left_semi").select(*[f"`{c}`" for c in target.columns]))


def note_changes(
    counter: str, job: str, run: str, added: Sequence[DataFrame] = (), removed: Sequence[DataFrame] = (), moment: str = CREATED,
    spark: SparkSession | None = None, place: str | None = None,
) -> None:
    """Note the rows a run added to and removed from the table of ``job``. Noted before the table is written or after, once per run."""
    sides = [_by_month(rows, moment, sign) for frames, sign in ((added, 1), (removed, -1)) for rows in frames]
    spark = spark or next(iter([*added, *removed])).sparkSession

    def changed(_: DataFrame | None) -> tuple[DataFrame, list[tuple[str]]]:
        rows = sides[0] if sides else spark.createDataFrame([], "date string, delta bigint")
        for side in sides[1:]:
            rows = rows.unionByName(side)
        sums = rows.groupBy("date").agg(F.sum("delta").alias("delta")).where("delta <> 0")
        return sums.select(F.lit(job).alias("job_code"), "date", "delta", F.lit(f"{job}.{run}").alias(RUN)), [(f"{job}.{run}",)]

    publish_parts(spark, changed, counter, [RUN], f"{job}.{run}", place)


def counted_months(
    spark: SparkSession, counter: str, as_of: date | None = None, months: int = COUNTED_MONTHS, jobs: Sequence[str] | None = None, name: str = "row_count"
) -> DataFrame:
    """``monthly_counts`` from the counter: job_code, date and the count. Without ``as_of`` all months, undated rows too."""
    rows = spark.table(counter)
    if jobs is not None:
        rows = rows.where(F.col("job_code").isin(*jobs))
    if as_of is not None:
        rows = rows.where(F.col("date") >= shift_months(as_of, -months).strftime("%Y-%m"))
    return rows.groupBy("job_code", "date").agg(F.sum("delta").alias(name)).where(F.col(name) != 0)


def audit(counter: str, job: str, table: DataFrame, run: str, moment: str = CREATED, place: str | None = None) -> DataFrame:
    """Count the table and correct the counter; returns the months that were wrong: date, counted, row_count (of the table)."""
    spark = table.sparkSession
    real = _by_month(table, moment, 1).withColumnRenamed("delta", "row_count")
    known = counted_months(spark, counter, jobs=[job], name="counted") if table_exists(spark, counter) else spark.createDataFrame([], "job_code string, date string, counted bigint")
    both = real.withColumn("counted", F.lit(0).cast("bigint")).unionByName(known.select("date", F.lit(0).cast("bigint").alias("row_count"), "counted"))
    wrong = settle(both.groupBy("date").agg(F.sum("counted").alias("counted"), F.sum("row_count").alias("row_count")).where("counted <> row_count"), "wrong", compact=True)
    fixed = wrong.select(F.lit(job).alias("job_code"), "date", (F.col("row_count") - F.col("counted")).alias("delta"), F.lit(f"{job}.{run}").alias(RUN))
    publish_parts(spark, lambda _: (fixed, [(f"{job}.{run}",)]), counter, [RUN], f"{job}.{run}", place)
    return wrong
