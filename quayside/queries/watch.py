"""Load reports and failed tasks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.dates import clock_label
from quayside.operators import monitor
from quayside.queries import fixtures as fx
from quayside.sources.scans import table

NOW = datetime(2024, 1, 31, 0, 0)
TIES = ["job_code", "row_count", "status"]


def _report(spark: SparkSession, folder: str) -> DataFrame:
    return fx.job_log(spark, folder).select(
        F.to_date("insert_time").alias("run_date"),
        "schedule",
        clock_label(F.col("insert_time")).alias("START_TIME"),
        F.col("status").alias("STATUS"),
    )


def load_summary(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.load_summary(_report(spark, folder), by=["run_date", "schedule"])


def load_summary_resent(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.load_summary(_report(spark, folder), only_success=True)


def latest_hour_report(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.latest_hour_report(fx.job_log(spark, folder).drop("start_date"), ties=TIES)


def latest_hour_report_marts(spark: SparkSession, folder: str) -> DataFrame:
    log = fx.job_log(spark, folder).withColumnRenamed("insert_time", "end_date")
    return monitor.latest_hour_report(log, moment="start_date", status="O", ties=TIES)


def latest_hour_report_compat(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.latest_hour_report(fx.job_log(spark, folder).drop("start_date"), ties=TIES, compat=True)


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    state = F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("success"))
    return table(spark, folder, "events").select(
        F.concat(F.lit("J"), F.col("user_id").cast("string")).alias("dag_id"),
        F.col("ts").alias("execution_date"),
        state.alias("state"),
    )


def _tasks(spark: SparkSession, folder: str) -> DataFrame:
    """One to three tasks per run; every second task failed."""
    number = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("event_id") % 3))
    failed = (F.col("event_id") + F.col("task")) % 2 == 0
    return (
        table(spark, folder, "events")
        .select("event_id", "user_id", "ts", number.alias("task"))
        .select(
            F.concat(F.lit("J"), F.col("user_id").cast("string")).alias("dag_id"),
            F.concat(F.lit("task_"), F.col("task").cast("string")).alias("task_id"),
            F.col("ts").alias("execution_date"),
            fx.hours_later(F.col("ts"), F.col("task")).alias("start_date"),
            fx.hours_later(F.col("ts"), F.col("task") + 1).alias("end_date"),
            F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("state"),
        )
    )


def failed_task_report(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.failed_tasks(_runs(spark, folder), _tasks(spark, folder), NOW)


QUERIES = {
    "load_summary": load_summary,
    "load_summary_resent": load_summary_resent,
    "latest_hour_report": latest_hour_report,
    "latest_hour_report_marts": latest_hour_report_marts,
    "latest_hour_report_compat": latest_hour_report_compat,
    "failed_task_report": failed_task_report,
}

_SECONDS = "hour(insert_time) * 3600 + minute(insert_time) * 60 + second(insert_time)"
_SUMMARY = f"""COUNT(*) FILTER (WHERE status = 'O') AS success_count, COUNT(*) AS total_count,
  CAST(MAX({_SECONDS}) - MIN({_SECONDS}) AS BIGINT) AS run_seconds"""


def _latest_sql(moment: str, wanted: str, newest_of: str, columns: str) -> str:
    return f"""WITH {fx.JOB_CTES},
wanted AS (SELECT * {columns} FROM log WHERE {wanted}),
newest AS (SELECT date_trunc('hour', MAX({moment})) AS hour_ FROM {newest_of})
SELECT ROW_NUMBER() OVER (ORDER BY {moment} NULLS LAST, job_code NULLS LAST, row_count NULLS LAST, status NULLS LAST) AS num, wanted.*
FROM wanted, newest WHERE date_trunc('hour', {moment}) = hour_"""


ORACLES = {
    "load_summary": f"""WITH {fx.JOB_CTES}
SELECT CAST(insert_time AS DATE) AS run_date, schedule, {_SUMMARY} FROM log GROUP BY ALL""",
    "load_summary_resent": f"WITH {fx.JOB_CTES} SELECT {_SUMMARY} FROM log WHERE status = 'O'",
    "latest_hour_report": _latest_sql("insert_time", "schedule = 'H'", "wanted", "EXCLUDE (start_date)"),
    "latest_hour_report_marts": _latest_sql("start_date", "schedule = 'H' AND status = 'O'", "wanted", "RENAME (insert_time AS end_date)"),
    "latest_hour_report_compat": _latest_sql("insert_time", "schedule = 'H'", "log", "EXCLUDE (start_date)"),
    "failed_task_report": f"""WITH tasks AS (
  SELECT 'J' || user_id AS dag_id, ts AS execution_date, event_id, event_type, unnest(generate_series(0, event_id % 3)) AS task
  FROM events)
SELECT dag_id, 'task_' || task AS task_id, execution_date, execution_date + to_hours(CAST(task AS INTEGER)) AS start_date,
       execution_date + to_hours(CAST(task + 1 AS INTEGER)) AS end_date
FROM tasks
WHERE event_type = 'error' AND (event_id + task) % 2 = 0 AND execution_date >= TIMESTAMP '{NOW}' - INTERVAL 2 HOUR""",
}
