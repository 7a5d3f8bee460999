from datetime import date, datetime

import pytest
from helpers import frame, values

from quayside.operators import reconcile

AS_OF = date(2024, 3, 15)
SCHEMA = "k string, n string, RDATETIME timestamp_ntz"
JAN, FEB = datetime(2024, 1, 5), datetime(2024, 2, 5)


def counts(spark, rows):
    return reconcile.monthly_counts({"JOB": rows}, AS_OF)


def test_trailing_months_have_no_upper_bound(spark):
    rows = frame(
        spark, SCHEMA,
        ("a", "1", datetime(2023, 2, 28)), ("b", "1", datetime(2023, 3, 1)), ("c", "1", datetime(2025, 1, 1)), ("d", "1", None),
    )
    assert values(counts(spark, rows)) == [("JOB", "2023-03", 1), ("JOB", "2025-01", 1)]


def test_only_wanted_jobs_are_counted(spark):
    rows = frame(spark, SCHEMA, ("a", "1", JAN))
    found = reconcile.monthly_counts({"A": rows, "B": rows}, AS_OF, jobs=["B"])
    assert values(found, "job_code") == [("B",)]


def test_month_on_one_side_only(spark):
    source = frame(spark, SCHEMA, ("a", "1", JAN), ("b", "1", FEB))
    target = frame(spark, SCHEMA, ("a", "1", JAN))
    inner = reconcile.reconcile(counts(spark, source), counts(spark, target))
    full = reconcile.reconcile(counts(spark, source), counts(spark, target), how="full")
    assert values(inner, "date", "agg_row_count", "status") == [("2024-01", 0, "PASS1_DONE")]
    assert values(full, "date", "agg_row_count", "status") == [
        ("2024-01", 0, "PASS1_DONE"), ("2024-02", 1, "PASS1_NEEDED"),
    ]


def test_repair_and_second_pass(spark):
    source = frame(spark, SCHEMA, ("a", "1", JAN), ("b", "1", FEB), ("c", "1", FEB), ("d", "1", FEB))
    target = frame(spark, SCHEMA, ("a", "1", JAN), ("x", "1", JAN), ("x", "1", JAN), ("b", "1", FEB), ("y", "9", FEB))
    first = reconcile.mismatches(reconcile.reconcile(counts(spark, source), counts(spark, target)))
    assert values(reconcile.surplus_jobs(first)) == [("JOB",)]
    repaired = reconcile.delete_orphans(source, target, ["k", "n"], first, AS_OF)
    # Orphans go, also twice; rows missing in the target are not added.
    assert values(repaired, "k") == [("a",), ("b",)]
    both = reconcile.reconcile_second_pass(first, counts(spark, source), counts(spark, repaired))
    assert values(both, "date", "agg_row_count", "status") == [
        ("2024-01", -2, "PASS1_NEEDED"),
        ("2024-01", 0, "PASS2_DONE"),
        ("2024-02", 1, "PASS1_NEEDED"),
        ("2024-02", 2, "NOT_YET_REFLECTED"),
    ]


def test_months_that_agree_keep_their_orphans(spark):
    source = frame(spark, SCHEMA, ("a", "1", JAN), ("b", "1", FEB))
    target = frame(spark, SCHEMA, ("x", "1", JAN), ("b", "1", FEB), ("y", "1", FEB))
    first = reconcile.mismatches(reconcile.reconcile(counts(spark, source), counts(spark, target)))
    assert values(reconcile.delete_orphans(source, target, ["k", "n"], first, AS_OF), "k") == [("b",), ("x",)]


def test_key_parts_are_not_glued(spark):
    source = frame(spark, SCHEMA, ("1", "23", JAN), ("9", "9", JAN), ("8", "8", JAN))
    target = frame(spark, SCHEMA, ("12", "3", JAN), ("9", "9", JAN))
    first = reconcile.mismatches(reconcile.reconcile(counts(spark, source), counts(spark, target)))
    assert values(reconcile.orphans(source, target, ["k", "n"], first, AS_OF)) == [("12", "3")]


def test_empty_source_is_refused(spark):
    target = frame(spark, SCHEMA, ("a", "1", JAN))
    months = frame(spark, "job_code string, date string", ("JOB", "2024-01"))
    empty = target.where("false")
    with pytest.raises(ValueError, match="no keys"):
        reconcile.delete_orphans(empty, target, ["k"], months, AS_OF)
    assert values(reconcile.delete_orphans(empty, target, ["k"], months, AS_OF, allow_empty=True)) == []


def test_key_is_required(spark):
    rows = frame(spark, SCHEMA, ("a", "1", JAN))
    with pytest.raises(ValueError, match="key"):
        reconcile.orphans(rows, rows, [], frame(spark, "date string", ("2024-01",)), AS_OF)


def test_rows_under_another_date_are_no_orphans(spark):
    """The source holds 2 after the month of ``as_of`` and 9 long before the window."""
    day = lambda y, m: datetime(y, m, 5)
    source = frame(spark, "k int, RDATETIME timestamp_ntz", (1, day(2024, 1)), (2, day(2024, 3)), (3, day(2024, 3)), (9, day(2021, 5)))
    target = frame(spark, "k int, RDATETIME timestamp_ntz", (1, day(2024, 1)), (2, day(2024, 3)), (9, day(2024, 1)), (5, day(2024, 1)))
    months = frame(spark, "date string", ("2024-01",), ("2024-03",))
    assert values(reconcile.orphans(source, target, ["k"], months, date(2024, 1, 31))) == [(5,)]
    assert values(reconcile.delete_orphans(source, target, ["k"], months, date(2024, 1, 31)), "k") == [(1,), (2,), (9,)]
    assert values(reconcile.orphans(source, target, ["k"], months, date(2024, 1, 31), compat=True)) == [(2,), (5,), (9,)]
