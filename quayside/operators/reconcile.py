"""Comparison of source and target by month, and repair of the months that differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import month_label, ntz, shift_months
from quayside.operators.upsert import CREATED, delete_keys
from quayside.plans.settle import settle
from quayside.sources.scans import scan_keys

# The status codes of the two passes.
PASS1_DONE = "PASS1_DONE"
PASS1_NEEDED = "PASS1_NEEDED"
PASS2_DONE = "PASS2_DONE"
NOT_YET_REFLECTED = "NOT_YET_REFLECTED"

COUNTED_MONTHS = 12
KEY_MONTHS = 24
PAIR = ["job_code", "date"]


def monthly_counts(
    tables: Mapping[str, DataFrame],
    as_of: date,
    moment: str = CREATED,
    jobs: Sequence[str] | None = None,
    name: str = "row_count",
    months: int = COUNTED_MONTHS,
) -> DataFrame:
    """Rows per job and month since the first day of the month ``months`` ago.

    ``jobs`` limits the count to some of the tables.
    """
    since = ntz(shift_months(as_of, -months))
    counts = [
        df.where(F.col(moment) >= since)
        # Grouped by a date and labelled afterwards: one format call per month, not per row.
        .groupBy(F.trunc(moment, "month").alias("_month"))
        .agg(F.count(F.lit(1)).alias(name))
        .select(F.lit(job).alias("job_code"), month_label(F.col("_month")).alias("date"), name)
        for job, df in tables.items()
        if jobs is None or job in jobs
    ]
    if not counts:
        raise ValueError("no table to count")
    return reduce(DataFrame.unionByName, counts)


def _compare(source: DataFrame, target: DataFrame, how: str, equal: str, unequal: str) -> DataFrame:
    joined = source.select(*PAIR, F.col("row_count").alias("row_count_source")).join(
        target.select(*PAIR, F.col("row_count").alias("row_count_target")), PAIR, how
    )
    difference = F.col("row_count_source") - F.col("row_count_target")
    return (
        joined.fillna(0, ["row_count_source", "row_count_target"])
        .withColumn("agg_row_count", difference)
        .withColumn("status", F.when(F.col("agg_row_count") == 0, equal).otherwise(unequal))
    )


def reconcile(source: DataFrame, target: DataFrame, how: str = "inner") -> DataFrame:
    """First pass: source count minus target count per job and month.

    A month on one side only is not seen by the inner join; ``how="full"`` counts the missing
    side as 0.
    """
    return _compare(source, target, how, PASS1_DONE, PASS1_NEEDED)


def mismatches(compared: DataFrame, job: str | None = None) -> DataFrame:
    """The months that differ, of all jobs or of one."""
    unequal = compared.where(F.col("agg_row_count") != 0)
    return unequal if job is None else unequal.where(F.col("job_code") == job)


def surplus_jobs(compared: DataFrame) -> DataFrame:
    """Jobs with more rows in the target than in the source in some month."""
    return compared.where(F.col("agg_row_count") < 0).select("job_code").distinct()


def orphans(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    months: DataFrame,
    as_of: date,
    moment: str = CREATED,
    allow_empty: bool = False,
    compat: bool = False,
) -> DataFrame:
    """Keys that the target holds in one of ``months`` and the source does not hold at all.

    ``months`` are the mismatches of this table: labels ``yyyy-MM`` in the column ``date``. The target's keys of these months
    are stored and looked up among all source rows, whatever their date, in one scan of the source's key columns;
    the source is not shuffled while they can be broadcast. ``compat`` looks only at source rows of the 24 months up to the
    end of this month, which deletes rows that the source holds under another date.
    """
    if not keys:
        raise ValueError("orphans cannot be told without a key")
    end = shift_months(as_of, 1)
    source_keys = scan_keys(source, keys, moment, shift_months(end, -KEY_MONTHS), end)
    if not allow_empty and source_keys.isEmpty():
        raise ValueError("the source has no keys in the window; every target row would be an orphan")
    # Calendar months: a list that cannot grow with the data.
    wanted = F.broadcast(months.select(F.to_date(F.concat("date", F.lit("-01"))).alias("_month")).distinct())
    in_months = target.join(wanted, F.trunc(moment, "month") == F.col("_month"), "left_semi")
    if compat:
        return in_months.select(*keys).join(source_keys, list(keys), "left_anti")
    suspects = settle(in_months.select(*keys), "suspects", compact=True)
    held = source.select(*keys).join(suspects.distinct(), list(keys), "left_semi")
    return suspects.join(settle(held.distinct(), "held", compact=True), list(keys), "left_anti")


def delete_orphans(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    months: DataFrame,
    as_of: date,
    moment: str = CREATED,
    allow_empty: bool = False,
    compat: bool = False,
) -> DataFrame:
    """The target without its orphans. Rows that the target lacks are not added."""
    found = settle(orphans(source, target, keys, months, as_of, moment, allow_empty, compat), "orphans")
    return delete_keys(target, found)


def reconcile_second_pass(first_pass: DataFrame, source: DataFrame, recounted: DataFrame) -> DataFrame:
    """Both passes in one table.

    ``first_pass`` are the mismatches of the first pass, ``source`` the source counts and
    ``recounted`` the target counts after the repair. Only pairs of the first pass are compared again.
    """
    pairs = first_pass.select(*PAIR)
    again = _compare(
        source.join(pairs, PAIR, "left_semi"),
        recounted.join(pairs, PAIR, "left_semi"),
        "inner",
        PASS2_DONE,
        NOT_YET_REFLECTED,
    )
    return first_pass.unionByName(again)
