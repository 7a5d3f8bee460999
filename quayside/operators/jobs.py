"""The job catalog: which loads may run, which marts are ready, and what is logged."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.conditions import as_condition, in_use
from quayside.functions.dates import day_literal, in_hour, ntz, on_day
from quayside.plans.settle import settle

# Log status and schedule codes.
OK = "O"
FAILED = "X"
SKIPPED = "SKIPPED"
DAILY = "D"
HOURLY = "H"
SWITCHED_OFF = "X"

# What the mart log says of a job that was not carried out.
PREREQUISITE = "prerequisite not done"
DONE_BEFORE = "already done"

RAW_LEVEL = 0


def _level() -> Column:
    return F.col("AGG_LEVEL").try_cast("int")


def eligible_jobs(
    job_info: DataFrame,
    table_info: DataFrame,
    schedule: str = DAILY,
    predicate: str = "UPDATE_COL",
    source_predicate: str | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Raw load jobs of a schedule and their load predicate.

    A job runs only if it has exactly one predicate row; the others are listed as ``SKIPPED``.
    Both catalogs meet in one grouping by job. The hourly load names the columns of its target
    predicate and of its ``source_predicate``; rows that switch it off do not count.
    """
    wanted = job_info.where(
        (_level() == RAW_LEVEL) & in_use() & (F.col("SCHEDULE") == schedule) & ~F.col("JOB_CODE").isin(*exclude)
    )
    counted = in_use() & (F.col(predicate) != SWITCHED_OFF) if schedule == HOURLY else in_use()
    none = F.lit(None).cast("string")
    jobs = wanted.select(
        "JOB_CODE", F.lit(1).alias("_job"), F.lit(0).alias("_rows"), none.alias("_target"), none.alias("_source")
    )
    texts = table_info.where(counted).select(
        "JOB_CODE",
        F.lit(0).alias("_job"),
        F.lit(1).alias("_rows"),
        F.col(predicate).alias("_target"),
        F.col(source_predicate or predicate).alias("_source"),
    )
    one = F.sum("_rows") == 1
    return (
        jobs.unionByName(texts)
        .groupBy("JOB_CODE")
        .agg(
            F.max("_job").alias("_job"),
            F.when(one, F.max("_target")).alias("PREDICATE"),
            F.when(one, F.max("_source")).alias("SOURCE_PREDICATE"),
            F.when(one, F.lit("RUN")).otherwise(F.lit(SKIPPED)).alias("STATUS"),
        )
        .where(F.col("_job") == 1)
        .drop("_job")
    )


def listed_jobs(job_info: DataFrame, listed: DataFrame, schedule: str = DAILY) -> DataFrame:
    """Raw load jobs of a schedule that occur in ``listed``, each once.

    ``listed`` has a ``JOB_CODE`` column, for example the catalog rows with one predicate text,
    or the mismatches of the first pass.
    """
    wanted = job_info.where((_level() == RAW_LEVEL) & in_use() & (F.col("SCHEDULE") == schedule))
    return wanted.select("JOB_CODE").join(listed.select("JOB_CODE"), ["JOB_CODE"], "left_semi")


def ready_jobs(
    job_info: DataFrame,
    pre_job_info: DataFrame,
    log: DataFrame,
    as_of: date,
    schedule: str = DAILY,
    log_schedule: str | None = None,
    hour: datetime | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Mart jobs of a schedule as ``READY``, ``BLOCKED`` or ``ALREADY_DONE`` today.

    A job is ready if every listed prerequisite has succeeded today; a job without any is
    ready. ``log_schedule`` counts only successes of that schedule; without it an hourly
    success counts for the daily job. The hourly refresh passes its ``hour`` and counts only
    successes within it.
    """
    started = F.col("start_date")
    in_time = on_day(started, as_of) if hour is None else in_hour(started, hour)
    today = log.where(in_time & (F.col("status") == OK))
    if log_schedule is not None:
        today = today.where(F.col("schedule") == log_schedule)
    done = settle(today.select(F.col("job_code").alias("PRE_JOB_CODE")).distinct(), "done-jobs")

    candidates = job_info.where(
        (_level() > RAW_LEVEL) & in_use() & (F.col("SCHEDULE") == schedule) & ~F.col("JOB_CODE").isin(*exclude)
    ).select("JOB_CODE", _level().alias("AGG_LEVEL"), "ACCUMULATE")
    edges = pre_job_info.where(in_use() & (F.col("SCHEDULE") == schedule)).select("JOB_CODE", "PRE_JOB_CODE")
    met = edges.join(done.withColumn("_met", F.lit(1)), ["PRE_JOB_CODE"], "left")

    # Candidates, prerequisites and successes meet in one grouping by job.
    rows = (
        candidates.withColumn("_job", F.lit(1))
        .unionByName(
            met.select("JOB_CODE", F.lit(1).alias("_listed"), F.coalesce("_met", F.lit(0)).alias("_met")),
            allowMissingColumns=True,
        )
        .unionByName(done.select(F.col("PRE_JOB_CODE").alias("JOB_CODE"), F.lit(1).alias("_done")), allowMissingColumns=True)
    )
    listed = F.coalesce(F.sum("_listed"), F.lit(0))
    succeeded = F.coalesce(F.sum("_met"), F.lit(0))
    status = (
        F.when(F.max("_done") == 1, F.lit("ALREADY_DONE"))
        .when(listed == succeeded, F.lit("READY"))
        .otherwise(F.lit("BLOCKED"))
    )
    return (
        rows.groupBy("JOB_CODE")
        .agg(
            F.max("_job").alias("_job"),
            F.max("AGG_LEVEL").alias("AGG_LEVEL"),
            F.max("ACCUMULATE").alias("ACCUMULATE"),
            listed.cast("bigint").alias("PRE_JOBS"),
            succeeded.cast("bigint").alias("PRE_JOBS_DONE"),
            status.alias("STATUS"),
        )
        .where(F.col("_job") == 1)
        .drop("_job")
        .orderBy("AGG_LEVEL", "JOB_CODE")
    )


def quality_gate(log: DataFrame, as_of: date, latest_only: bool = False, moment: str = "insert_time") -> DataFrame:
    """One row: is the way open for the marts?

    Closed by any log row of today that failed or has no status. With ``latest_only`` only the
    last row of each job counts, so a repaired job does not close the gate.
    """
    today = log.where(on_day(F.col(moment), as_of))
    bad = F.col("status").isNull() | (F.col("status") == FAILED)
    marks = today.select("job_code", F.col(moment).alias("_at"), F.when(bad, 1).otherwise(0).alias("_bad"))
    if latest_only:
        # Equal times: the bad row counts.
        marks = marks.groupBy("job_code").agg(F.max(F.struct("_at", "_bad")).alias("_last")).select("_last._bad")
    return marks.agg(
        (F.coalesce(F.sum("_bad"), F.lit(0)) == 0).alias("gate_open"),
        F.coalesce(F.sum("_bad"), F.lit(0)).cast("bigint").alias("bad_rows"),
        F.count(F.lit(1)).alias("log_rows"),
    )


def load_log(
    job: str,
    table: DataFrame,
    window_pred: str | Column,
    run_ts: datetime,
    schedule: str = DAILY,
    batch_is_empty: bool = False,
) -> DataFrame:
    """The log row of a finished load: how many rows the table now holds in the window.

    An empty batch logs 0.
    """
    counted = F.lit(0) if batch_is_empty else F.count(F.lit(1))
    inside = table.where(as_condition(window_pred))  # a filter reaches the scan, a counted condition does not
    return _log_row(inside.agg(counted.alias("row_count")), job, F.col("row_count"), run_ts, schedule, OK)


def outcome_log(
    spark: SparkSession, job: str, run_ts: datetime, status: str, schedule: str = DAILY
) -> DataFrame:
    """The one log row of a job that did not load: ``X`` failed or ``SKIPPED``."""
    return _log_row(spark.range(0, 1, 1, 1), job, F.lit(0), run_ts, schedule, status)


def mart_log(states: DataFrame, outcomes: DataFrame, run_ts: datetime, schedule: str = DAILY) -> DataFrame:
    """The log rows of a mart run: of each job carried out, and of each that was blocked or already done.

    ``states`` is the result of ``ready_jobs``. ``outcomes`` has job_code, start_date, end_date, row_count
    and error, null where the job succeeded; a failed job logs no end and no rows. A ready job without
    outcome was passed over and logs nothing. A blocked job logs the time of the run as its start in the
    daily run only.
    """
    failed, blocked = F.col("error").isNotNull(), F.col("STATUS") == "BLOCKED"
    never = F.lit(None).cast("timestamp_ntz")
    ran = outcomes.select(
        "job_code",
        F.col("start_date").cast("timestamp_ntz").alias("start_date"),
        F.when(~failed, F.col("end_date").cast("timestamp_ntz")).alias("end_date"),
        F.when(failed, F.lit(FAILED)).otherwise(F.lit(OK)).alias("status"),
        F.when(failed, F.lit(0)).otherwise(F.col("row_count")).cast("bigint").alias("row_count"),
        F.lit(schedule).alias("schedule"),
        F.col("error").cast("string").alias("error"),
    )
    held = states.where(F.col("STATUS").isin("BLOCKED", "ALREADY_DONE")).select(
        F.col("JOB_CODE").alias("job_code"),
        F.when(blocked & F.lit(schedule == DAILY), ntz(run_ts)).otherwise(never).alias("start_date"),
        never.alias("end_date"),
        F.lit(FAILED).alias("status"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(schedule).alias("schedule"),
        F.when(blocked, F.lit(PREREQUISITE)).otherwise(F.lit(DONE_BEFORE)).alias("error"),
    )
    return ran.unionByName(held)


def _log_row(
    one_row: DataFrame, job: str, row_count: Column, run_ts: datetime, schedule: str, status: str
) -> DataFrame:
    return one_row.select(
        F.lit(job).alias("job_code"),
        day_literal(run_ts.date()).alias("date"),
        ntz(run_ts).alias("insert_time"),
        row_count.cast("bigint").alias("row_count"),
        F.lit(schedule).alias("schedule"),
        F.lit(status).alias("status"),
    )
