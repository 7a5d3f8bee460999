"""Waves, cycles and the critical path against plain Python."""

import random
from datetime import date, datetime

import pytest
from helpers import frame, values

from quayside.operators import jobs, run_order

DAY, AT = date(2024, 1, 10), datetime(2024, 1, 10, 3)
INFO = "JOB_CODE string, AGG_LEVEL string, DEL_YN string, SCHEDULE string, ACCUMULATE string"
PRE = "JOB_CODE string, PRE_JOB_CODE string, DEL_YN string, SCHEDULE string"
LOG = "job_code string, start_date timestamp_ntz, status string, schedule string"


def plan(spark, names, edges, done=(), seconds=None, **options):
    info = frame(spark, INFO, *[(n, "1", "N", "D", "N") for n in names])
    pre = frame(spark, PRE, *[(a, b, "N", "D") for a, b in edges])
    log = frame(spark, LOG, *[(n, AT, "O", "D") for n in done])
    took = None if seconds is None else frame(spark, "job_code string, seconds int", *seconds.items())
    return run_order.run_plan(info, pre, log, DAY, seconds=took, **options)


def test_a_chain_of_fifty(spark):
    names = [f"J{i:02}" for i in range(50)]
    found = plan(spark, names, list(zip(names[1:], names[:-1], strict=True)), seconds={n: 2 for n in names})
    rows = {r.JOB_CODE: r for r in found.collect()}
    assert [rows[n].WAVE for n in names] == list(range(50))
    assert rows["J49"].START == 98 and rows["J49"].FINISH == 100 and all(r.ON_CRITICAL_PATH for r in rows.values())
    with pytest.raises(ValueError, match="over 20 waves"):
        plan(spark, names, list(zip(names[1:], names[:-1], strict=True)), most=20)


def test_cycles_and_what_they_hold(spark):
    edges = [
        ("a", "b"), ("b", "a"),  # a cycle
        ("c", "c"),  # a job that waits for itself
        ("d", "a"), ("e", "d"),  # behind
        ("between", "a"), ("f", "between"), ("f", "g"), ("g", "f"),  # between two cycles
        ("h", "outside"), ("i", "h"), ("a", "i"),  # waits for a job of no catalog; a cycle waits for it
        ("x", "y"),
    ]
    names = ["a", "b", "c", "d", "e", "between", "f", "g", "h", "i", "x", "y"]
    found = dict(values(plan(spark, names, edges), "JOB_CODE", "STATUS"))
    assert found == {
        **dict.fromkeys(["a", "b", "c", "between", "f", "g"], "CYCLE"), **dict.fromkeys(["d", "e", "h", "i"], "HELD"), "x": "PLANNED", "y": "PLANNED",
    }


def test_done_jobs_hold_up_nothing(spark):
    found = plan(spark, ["a", "b", "c"], [("b", "a"), ("c", "b"), ("c", "raw")], done=["a", "raw"])
    assert values(found, "JOB_CODE", "STATUS", "WAVE") == [("a", "ALREADY_DONE", None), ("b", "PLANNED", 0), ("c", "PLANNED", 1)]
    info = frame(spark, INFO, *[(n, "1", "N", "D", "N") for n in "abc"])
    pre = frame(spark, PRE, ("b", "a", "N", "D"), ("c", "b", "N", "D"), ("c", "raw", "N", "D"))
    log = frame(spark, LOG, ("a", AT, "O", "D"), ("raw", AT, "O", "D"))
    ready = values(jobs.ready_jobs(info, pre, log, DAY).where("STATUS = 'READY'"), "JOB_CODE")
    assert ready == values(found.where("WAVE = 0"), "JOB_CODE")


def test_the_critical_path_takes_the_longest_way(spark):
    edges = [("end", "short"), ("end", "long2"), ("long2", "long1"), ("side", "short")]
    found = plan(spark, ["end", "short", "long1", "long2", "side"], edges, seconds={"short": 5, "long1": 3, "long2": 4, "end": 1})
    assert values(found.where("ON_CRITICAL_PATH"), "JOB_CODE") == [("end",), ("long1",), ("long2",)]
    rows = {r.JOB_CODE: (r.WAVE, r.START, r.FINISH, r.AFTER) for r in found.collect()}
    assert rows["end"] == (2, 7.0, 8.0, "long2") and rows["side"] == (1, 5.0, 5.0, "short")


def test_empty_and_left_out(spark):
    assert values(plan(spark, [], [])) == []
    assert values(plan(spark, ["a", "b"], [("b", "a")], exclude=["a"]), "JOB_CODE", "STATUS") == [("b", "HELD")]


@pytest.mark.parametrize("seed", [3, 4])
def test_against_plain_python(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i:02}" for i in range(18)]
    edges = {(a, b) for a, b in ((rng.choice(names), rng.choice(names)) for _ in range(22)) if a > b or rng.random() < 0.1}
    pres = {n: {b for a, b in edges if a == n} for n in names}
    waves = {}
    while step := [n for n in names if n not in waves and pres[n] <= set(waves)]:
        waves |= {n: max((waves[p] + 1 for p in pres[n]), default=0) for n in step}
    found = {r.JOB_CODE: r.WAVE for r in plan(spark, names, sorted(edges)).collect()}
    assert found == {n: waves.get(n) for n in names}
