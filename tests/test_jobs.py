from datetime import date, datetime

from helpers import TS, frame, values

from quayside.operators import jobs

DAY = date(2024, 1, 10)
INFO = "JOB_CODE string, AGG_LEVEL string, DEL_YN string, SCHEDULE string, ACCUMULATE string"
EDGES = "JOB_CODE string, PRE_JOB_CODE string, DEL_YN string, SCHEDULE string"
LOG = "job_code string, start_date timestamp_ntz, insert_time timestamp_ntz, status string, row_count bigint, schedule string"


def log_row(job, status="O", schedule="D", at=TS):
    return (job, at, at, status, 1, schedule)


def test_one_predicate_row_is_needed(spark):
    info = frame(
        spark, INFO,
        ("a", "0", "N", "D", None), ("b", "0", "N", "D", None), ("c", "0", "N", "D", None), ("d", "1", "N", "D", None),
        ("e", "0", "Y", "D", None), ("f", "0", None, "D", None), ("g", "0", "N", "H", None), ("h", "0", "N", "D", None),
    )
    table_info = frame(
        spark, "JOB_CODE string, UPDATE_COL string, DEL_YN string",
        ("a", "p", "N"), ("a", "q", "Y"), ("b", "p", "N"), ("b", "p", "N"), ("h", "p", "N"), ("z", "p", "N"),
    )
    found = jobs.eligible_jobs(info, table_info, exclude=["h"])
    assert values(found, "JOB_CODE", "PREDICATE", "STATUS") == [
        ("a", "p", "RUN"), ("b", None, "SKIPPED"), ("c", None, "SKIPPED"),
    ]


def test_hourly_predicates(spark):
    info = frame(spark, INFO, *[(j, "0", "N", "H", None) for j in ("a", "b", "c")])
    table_info = frame(
        spark, "JOB_CODE string, UPDATE_COL_RT string, UPDATE_COL_RT_2 string, DEL_YN string",
        ("a", "t", "s", "N"), ("a", "X", "s", "N"), ("b", "X", "s", "N"), ("c", None, "s", "N"),
    )
    found = jobs.eligible_jobs(info, table_info, jobs.HOURLY, "UPDATE_COL_RT", "UPDATE_COL_RT_2")
    assert values(found, "JOB_CODE", "PREDICATE", "SOURCE_PREDICATE", "STATUS") == [
        ("a", "t", "s", "RUN"), ("b", None, None, "SKIPPED"), ("c", None, None, "SKIPPED"),
    ]


def test_level_that_is_no_number(spark):
    info = frame(spark, INFO, ("a", "zero", "N", "D", None))
    table_info = frame(spark, "JOB_CODE string, UPDATE_COL string, DEL_YN string", ("a", "p", "N"))
    assert values(jobs.eligible_jobs(info, table_info)) == []


def test_listed_jobs_come_once(spark):
    info = frame(spark, INFO, ("a", "0", "N", "D", None), ("b", "0", "N", "D", None), ("c", "0", "Y", "D", None))
    listed = frame(spark, "JOB_CODE string, date string", ("a", "2024-01"), ("a", "2024-02"), ("c", "2024-01"))
    assert values(jobs.listed_jobs(info, listed)) == [("a",)]


def ready(spark, log, edges, **options):
    info = frame(spark, INFO, *[(j, "1", "N", "D", "O") for j in ("a", "b", "c")], ("raw", "0", "N", "D", None))
    found = jobs.ready_jobs(info, frame(spark, EDGES, *edges), frame(spark, LOG, *log), DAY, **options)
    return dict(values(found, "JOB_CODE", "STATUS"))


def test_readiness(spark):
    edges = [("b", "x", "N", "D"), ("b", "y", "N", "D"), ("c", "x", "N", "D"), ("c", "z", "Y", "D"), ("c", "z", "N", "H")]
    log = [log_row("x"), log_row("x"), log_row("y", "X"), log_row("y", at=datetime(2024, 1, 9, 23, 59))]
    assert ready(spark, log, edges) == {"a": "READY", "b": "BLOCKED", "c": "READY"}


def test_done_job_is_not_run_again(spark):
    assert ready(spark, [log_row("a")], [("a", "x", "N", "D")])["a"] == "ALREADY_DONE"


def test_schedule_of_the_success(spark):
    edges = [("b", "x", "N", "D")]
    assert ready(spark, [log_row("x", schedule="H")], edges)["b"] == "READY"
    assert ready(spark, [log_row("x", schedule="H")], edges, log_schedule="D")["b"] == "BLOCKED"


def test_success_of_the_same_hour(spark):
    edges = [("b", "x", "N", "D")]
    log = [log_row("x", at=datetime(2024, 1, 10, 9, 59)), log_row("a", at=datetime(2024, 1, 9, 10, 5))]
    assert ready(spark, log, edges, hour=datetime(2024, 1, 10, 10, 30)) == {"a": "READY", "b": "BLOCKED", "c": "READY"}
    assert ready(spark, log, edges, hour=datetime(2024, 1, 10, 9))["b"] == "READY"


def test_prerequisite_listed_twice(spark):
    edges = [("b", "x", "N", "D"), ("b", "x", "N", "D")]
    assert ready(spark, [log_row("x")], edges)["b"] == "READY"


def test_jobs_come_by_level(spark):
    info = frame(spark, INFO, ("late", "10", "N", "D", "O"), ("early", "2", "N", "D", "O"))
    found = jobs.ready_jobs(info, frame(spark, EDGES, ("q", "q", "N", "D")), frame(spark, LOG, log_row("q")), DAY)
    assert [r.JOB_CODE for r in found.collect()] == ["early", "late"]


def gate(spark, *log, **options):
    return jobs.quality_gate(frame(spark, LOG, *log), DAY, **options).first()


def test_gate(spark):
    assert gate(spark, log_row("a")).gate_open
    assert gate(spark, log_row("a", "X", at=datetime(2024, 1, 9))).gate_open
    assert not gate(spark, log_row("a"), log_row("b", None)).gate_open
    repaired = [log_row("a", "X"), log_row("a", "O", at=datetime(2024, 1, 10, 5))]
    assert not gate(spark, *repaired).gate_open
    assert gate(spark, *repaired, latest_only=True).gate_open


def test_log_counts_the_window(spark):
    rows = frame(spark, "t int", (1,), (5,), (None,))
    assert values(jobs.load_log("J", rows, "t > 2", TS)) == [("J", TS.date(), TS, 1, "D", "O")]
    assert values(jobs.load_log("J", rows, "t > 2", TS, batch_is_empty=True), "row_count") == [(0,)]


def test_log_of_a_job_that_did_not_load(spark):
    rows = jobs.outcome_log(spark, "J", TS, jobs.FAILED).unionByName(jobs.outcome_log(spark, "K", TS, jobs.SKIPPED, "H"))
    assert values(rows, "job_code", "row_count", "schedule", "status") == [("J", 0, "D", "X"), ("K", 0, "H", "SKIPPED")]


def test_mart_log(spark):
    states = frame(spark, "JOB_CODE string, STATUS string", ("ran", "READY"), ("passed over", "READY"), ("broke", "READY"), ("held", "BLOCKED"), ("done", "ALREADY_DONE"))
    outcomes = frame(spark, "job_code string, start_date timestamp_ntz, end_date timestamp_ntz, row_count int, error string", ("ran", TS, TS, 5, None), ("broke", TS, TS, 3, "no view"))
    rows = values(jobs.mart_log(states, outcomes, TS), "job_code", "start_date", "end_date", "status", "row_count", "schedule", "error")
    assert rows == [
        ("broke", TS, None, "X", 0, "D", "no view"),
        ("done", None, None, "X", 0, "D", "already done"),
        ("held", TS, None, "X", 0, "D", "prerequisite not done"),
        ("ran", TS, TS, "O", 5, "D", None),
    ]
    hourly = values(jobs.mart_log(states, outcomes.limit(0), TS, jobs.HOURLY), "job_code", "start_date", "schedule")
    assert hourly == [("done", None, "H"), ("held", None, "H")]
