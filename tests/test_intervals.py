"""Intervals against the snapshots they stand for; sparse balances against full ones."""

from datetime import date, datetime, timedelta

import pytest
from helpers import TS, frame, plan_of, settings, values
from hypothesis import HealthCheck, given
from hypothesis import settings as examples
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators import calendars, intervals

D0 = date(2024, 1, 1)
SCHEMA = "k int, v string, SNAPSHOT_DATE date"
SNAPSHOTS = st.lists(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=5), min_size=1, max_size=5)


@examples(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=SNAPSHOTS, split=st.integers(0, 4))
def test_every_day_is_restored(spark, days, split):
    """Repeated rows and missing values too; some days by one grouping, the others merged one by one, each twice."""
    split = min(split, len(days) - 1)
    at = lambda n: D0 + timedelta(days=2 * n)  # noqa: E731  every other day has no snapshot
    known = intervals.to_intervals(frame(spark, SCHEMA, *[(*r, at(n)) for n, rows in enumerate(days[: split + 1]) for r in rows]), days=[at(n) for n in range(split + 1)])
    for n in range(split + 1, len(days)):
        snapshot = frame(spark, "k int, v string", *days[n])
        known = intervals.merge_day(intervals.merge_day(known, snapshot, at(n)), snapshot, at(n))
    known = frame(spark, known.schema, *known.collect())
    for n, rows in enumerate(days):
        assert sorted(map(repr, values(intervals.valid_at(known, at(n))))) == sorted(map(repr, [tuple(r) for r in rows]))
    assert values(intervals.valid_at(known, D0 - timedelta(days=1))) == []


def test_rows_follow_changes_and_not_days(spark):
    rows = [(k, "same", D0 + timedelta(days=n)) for k in range(5) for n in range(20)]
    assert intervals.to_intervals(frame(spark, SCHEMA, *rows)).count() == 5


def test_rows_of_one_scan_task_are_dealt_out_before_they_are_counted(spark):
    """A task that writes few rows many times must not hold them all in its map of copies; nor is there a map of runs."""
    days = F.explode(F.sequence(F.lit(0), F.lit(4)))
    daily = spark.range(0, 1000, 1, 1).select(F.col("id").alias("k"), days.alias("n")).select("k", F.date_add(F.lit(D0), F.col("n")).alias("SNAPSHOT_DATE"))
    known = intervals.to_intervals(daily)
    merged = intervals.merge_day(frame(spark, known.schema), daily.select("k"), D0)
    for plan in (plan_of(known), plan_of(merged)):
        assert plan.count("REBALANCE_PARTITIONS_BY_NONE") == 1 and "SortAggregate" not in plan
    assert (known.where("VALID_TO IS NULL").count(), known.count(), merged.where("COPIES = 5").count()) == (1000, 1000, 1000)


def test_look_up(spark):
    known = intervals.to_intervals(frame(spark, SCHEMA, (1, "a", D0), (1, "b", D0 + timedelta(days=1)), (1, "b", D0 + timedelta(days=2))))
    moments = [datetime(2023, 12, 31, 23), datetime(2024, 1, 1, 5), datetime(2024, 1, 2), datetime(2024, 5, 1), None]
    rows = frame(spark, "k int, at timestamp_ntz", *[(1, m) for m in moments], (2, moments[1]))
    found = intervals.look_up(rows, known, ["k"], "at", ["v"])
    assert {(r.k, r.at): r.v for r in found.collect()} == dict(zip([(1, m) for m in moments] + [(2, moments[1])], [None, "a", "b", "b", None, None], strict=True))
    plan = plan_of(found)
    assert "Generate" not in plan and "NestedLoop" not in plan


MOVES = "k int, d timestamp_ntz, a double"


def moves():
    out = [(1, datetime(2023, 1, 5), 10.0), (1, datetime(2024, 1, 31, 23), 1.0), (2, datetime(2024, 3, 1), None), (2, datetime(2024, 4, 2), 4.0), (3, datetime(2024, 5, 20), -2.0), (None, datetime(2024, 2, 1), 7.0)]
    return [*out, (4, datetime(2024, 6, 1), 9.0), (5, None, 3.0)]


@pytest.mark.parametrize("months", [1, 3, 6])
def test_carried_balances_are_the_full_ones(spark, months):
    rows, as_of = frame(spark, MOVES, *moves()), date(2024, 5, 15)
    sparse = calendars.sparse_balances(rows, ["k"], "d", "a", as_of, months)
    full = calendars.month_end_snapshots(rows, ["k"], "d", "a", as_of, TS, months)
    assert values(calendars.carried_forward(sparse, ["k"], as_of, TS), "k", "CHECK_MONTH", "BALANCE") == values(full, "k", "CHECK_MONTH", "BALANCE")
    end = calendars.month_end(as_of, -1) if months > 1 else calendars.month_end(as_of)
    at = values(full.where(f"CHECK_MONTH = '{end:%Y-%m}'"), "k", "BALANCE")
    assert values(calendars.balances_at(sparse, ["k"], end), "k", "BALANCE") == at


def test_a_month_is_added(spark):
    rows, april, may = frame(spark, MOVES, *moves()), date(2024, 4, 15), date(2024, 5, 15)
    before = calendars.sparse_balances(rows, ["k"], "d", "a", april, 4)
    added = calendars.add_month(before, rows.where("d >= timestamp_ntz'2024-05-01' AND d < timestamp_ntz'2024-06-01'"), ["k"], "a", calendars.month_end(may))
    assert values(added) == values(calendars.sparse_balances(rows, ["k"], "d", "a", may, 5))


def test_rows_follow_movements(spark):
    rows = frame(spark, MOVES, *[(k, datetime(2023, 1, 1), 1.0) for k in range(10)])
    assert calendars.sparse_balances(rows, ["k"], "d", "a", date(2024, 5, 15), 25).count() == 10
    assert calendars.sparse_balances(frame(spark, MOVES), ["k"], "d", "a", date(2024, 5, 15), 25).collect() == []
