from datetime import datetime

from helpers import frame, settings, values
from pyspark.sql import functions as F

from quayside.operators import monitor
from quayside.plans.numbering import number_rows

LOG = "job_code string, insert_time timestamp_ntz, status string, schedule string"


def at(hour, minute=0):
    return datetime(2024, 1, 10, hour, minute)


def test_summary(spark):
    report = frame(spark, "START_TIME string, STATUS string", ("03:00:10", "O"), ("03:10:00", "X"), ("03:05:00", "O"), ("oops", None))
    assert values(monitor.load_summary(report)) == [(2, 4, 590)]
    assert values(monitor.load_summary(report, only_success=True)) == [(2, 2, 290)]


def test_latest_hour(spark):
    log = frame(
        spark, LOG,
        ("a", at(8, 5), "O", "H"), ("b", at(9, 50), "O", "H"), ("c", at(9, 1), "X", "H"), ("d", at(9, 30), "O", "D"),
        ("e", datetime(2024, 1, 9, 9, 10), "O", "H"), ("f", at(10), "O", "D"),
    )
    assert values(monitor.latest_hour_report(log), "num", "job_code") == [(1, "c"), (2, "b")]
    assert values(monitor.latest_hour_report(log, status="O"), "num", "job_code") == [(1, "b")]
    # The last entry is a daily one, so the hour of the whole log has no hourly rows.
    assert values(monitor.latest_hour_report(log, compat=True)) == []


def test_latest_hour_in_a_zone_with_clock_changes(spark):
    # 02:30 on this day does not exist on New York's clocks.
    log = frame(spark, LOG, ("a", datetime(2024, 3, 10, 2, 30), "O", "H"), ("b", datetime(2024, 3, 10, 1, 30), "O", "H"))
    with settings(spark, spark__sql__session__timeZone="America/New_York"):
        assert values(monitor.latest_hour_report(log), "num", "job_code") == [(1, "a")]


def test_numbers_have_no_gaps(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.lit(1).alias("same"))
    numbered = number_rows(rows, [F.col("same"), F.col("x")])
    assert [tuple(r) for r in numbered.orderBy("num").select("num", "x").collect()] == [(i + 1, i) for i in range(5000)]
    assert number_rows(rows.where("false"), [F.col("x")]).count() == 0


def test_equal_rows_are_spread(spark):
    rows = spark.range(0, 40000, 1, 8).select(F.lit(1).alias("same"), F.col("id"))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        numbered = number_rows(rows, [F.col("same")])
    assert numbered.agg(F.min("num"), F.max("num"), F.count_distinct("num")).first() == (1, 40000, 40000)
    assert len(numbered.inputFiles()) >= 8


def test_failed_tasks(spark):
    runs = frame(
        spark, "dag_id string, execution_date timestamp_ntz, state string",
        ("a", at(11), "failed"), ("b", at(11), "success"), ("a", at(9, 59), "failed"), ("c", at(10), "failed"),
    )
    tasks = frame(
        spark, "dag_id string, task_id string, execution_date timestamp_ntz, start_date timestamp_ntz, end_date timestamp_ntz, state string",
        *[(d, f"t{s}", e, e, e, s) for d, e in (("a", at(11)), ("b", at(11)), ("a", at(9, 59)), ("c", at(10))) for s in ("failed", "success")],
    )
    assert values(monitor.failed_tasks(runs, tasks, at(12)), "dag_id", "task_id", "execution_date") == [
        ("a", "tfailed", at(11)), ("c", "tfailed", at(10)),
    ]
