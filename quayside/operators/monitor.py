"""Tables for people who watch the loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import clock_seconds, hour_start, ntz
from quayside.operators.jobs import HOURLY, OK
from quayside.plans.numbering import number_rows

FAILED_STATE = "failed"
FAILED_HOURS = 2


def load_summary(
    report: DataFrame, by: Sequence[str] = (), start: str = "START_TIME", only_success: bool = False
) -> DataFrame:
    """Loads, successes and elapsed seconds of a report with ``HH:mm:ss`` start times.

    Elapsed is the last start less the first. The re-sent report counts successes only.
    """
    rows = report.where(F.col("STATUS") == OK) if only_success else report
    seconds = clock_seconds(F.col(start))
    return rows.groupBy(*by).agg(
        F.count_if(F.col("STATUS") == OK).alias("success_count"),
        F.count(F.lit(1)).alias("total_count"),
        (F.max(seconds) - F.min(seconds)).cast("bigint").alias("run_seconds"),
    )


def latest_hour_report(
    log: DataFrame,
    schedule: str = HOURLY,
    moment: str = "insert_time",
    status: str | None = None,
    ties: Sequence[str] = ("job_code",),
    compat: bool = False,
) -> DataFrame:
    """Log rows of the latest day and hour of a schedule, numbered by time.

    The latest hour is that of the wanted schedule and status; with ``compat`` it is that of
    the whole log, which leaves the report empty if another schedule wrote last.
    """
    wanted = log.where(F.col("schedule") == schedule)
    if status is not None:
        wanted = wanted.where(F.col("status") == status)
    newest = (log if compat else wanted).agg(hour_start(F.max(moment)).alias("_hour"))
    # One value, computed first; the range then reaches the scan.
    hour = newest.scalar()
    rows = wanted.where((F.col(moment) >= hour) & (F.col(moment) < hour + F.expr("interval 1 hour")))
    return number_rows(rows, [F.col(c).asc_nulls_last() for c in [moment, *ties]])


def failed_tasks(runs: DataFrame, tasks: DataFrame, now: datetime, hours: int = FAILED_HOURS) -> DataFrame:
    """Failed tasks of the failed runs of the last hours.

    A run is known by its flow and time. Tasks are only tested against the runs, so each comes
    once, and a run with very many tasks can be split.
    """
    recent = F.col("execution_date") >= ntz(now - timedelta(hours=hours))
    failed_runs = runs.where((F.col("state") == FAILED_STATE) & recent).select("dag_id", "execution_date")
    failed = tasks.where((F.col("state") == FAILED_STATE) & recent).drop("state")
    return failed.join(failed_runs, ["dag_id", "execution_date"], "left_semi").select(
        "dag_id", "task_id", "execution_date", "start_date", "end_date"
    )
