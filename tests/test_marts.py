import uuid
from datetime import date, datetime

import pytest
from helpers import TS, frame, values
from pyspark.sql import functions as F

from quayside.operators import marts, snapshots
from quayside.plans import mart_load

AS_OF = date(2024, 1, 10)
SCHEMA = "p string, CHECK_MONTH string, ADATETIME timestamp_ntz"
NEW = ("new", "2024-01-10", TS)
YESTERDAY = ("yesterday", "2024-01-09", datetime(2024, 1, 9, 4))
OTHER_MONTH = ("other month", "2023-12", datetime(2024, 1, 9, 4))
OLDER = ("older", "2024-01-08", datetime(2024, 1, 8, 4))
UNSTAMPED = ("unstamped", "2024-01-08", None)


def refreshed(spark, mode):
    history = frame(spark, SCHEMA, YESTERDAY, OTHER_MONTH, OLDER, UNSTAMPED)
    return marts.refresh_mart(frame(spark, SCHEMA, NEW), history, mode, AS_OF)


def test_modes(spark):
    assert values(refreshed(spark, "replace").table, "p") == [("new",)]
    assert values(refreshed(spark, "replace").history, "p") == [("older",), ("other month",), ("unstamped",), ("yesterday",)]
    assert len(values(refreshed(spark, "accumulate").history)) == 5
    assert values(refreshed(spark, "accumulate_month").history, "p") == [("new",), ("older",), ("other month",), ("unstamped",)]


def test_bad_calls(spark):
    snapshot = frame(spark, SCHEMA, NEW)
    with pytest.raises(ValueError, match="history"):
        marts.refresh_mart(snapshot, None, "accumulate")
    with pytest.raises(ValueError, match="unknown mode"):
        marts.refresh_mart(snapshot, snapshot, "other")
    with pytest.raises(ValueError, match="as_of"):
        marts.refresh_mart(snapshot, snapshot, "accumulate_month")


def test_names_and_flags():
    assert [marts.mode_of(f) for f in ("O", "OO", "N", None)] == ["accumulate", "accumulate_month", "replace", "replace"]
    assert marts.history_name("SALES_1D", "accumulate") == "SALES"
    assert marts.history_name("SALES_1D", "accumulate_month") == "SALES_M"
    assert marts.history_name("SALES", "accumulate_month") == "SALES"


def test_monthly_roll(spark):
    schema = "CHECK_DATE date, code string"
    daily = frame(spark, schema, (date(2024, 1, 31), "a"), (date(2024, 3, 31), "b"))
    monthly = frame(spark, "CHECK_MONTH string, code string", ("2023-11", "z"))
    accumulated = frame(spark, schema, (date(2024, 1, 8), "x"), (date(2024, 1, 9), "y"), (None, "n"))
    rolled = marts.monthly_roll(daily, monthly, accumulated, AS_OF)
    assert values(rolled.monthly, "CHECK_MONTH", "code") == [("2023-11", "z"), ("2023-12", "a"), ("2024-02", "b")]
    assert values(rolled.accumulated, "code") == [("n",), ("y",)]


def test_snapshot_cleaning(spark):
    rows = frame(spark, "p string, `in stock` int, sold double", ("zero", 0, 0.0), ("null", 0, None), ("sold", 0, 1.0))
    clean = snapshots.clean_snapshot(rows, ["in stock", "sold"], date(2024, 1, 1), date(2024, 1, 31), TS)
    assert values(clean, "p", "START_DATE", "END_DATE", "MIG_DATETIME") == [
        ("null", "2024-01-01", "2024-01-31", TS), ("sold", "2024-01-01", "2024-01-31", TS),
    ]
    with pytest.raises(ValueError, match="missing"):
        snapshots.clean_snapshot(rows, ["instock"], date(2024, 1, 1), date(2024, 1, 31), TS)


def test_snapshot_append_replaces_the_period(spark):
    schema = "code string, START_DATE string, MIG_DATETIME timestamp_ntz"
    first, stale = datetime(2024, 1, 8, 3), datetime(2024, 1, 9, 3)
    monthly = frame(spark, schema, ("a", "2024-01", first), ("b", "2024-01", first), ("a", "2023-12", stale))
    snapshot = frame(spark, schema, ("a", "2024-01", TS), ("left over", "2024-01", stale))
    done = marts.append_snapshot(monthly, snapshot, ["code", "START_DATE"], AS_OF)
    assert values(done.daily, "code") == [("a",)]
    assert values(done.monthly) == [("a", "2023-12", stale), ("a", "2024-01", TS)]
    with pytest.raises(ValueError, match="missing"):
        marts.append_snapshot(monthly, snapshot, ["cod"], AS_OF)


def stored(spark, flag, rows, history, job=None):
    """A refresh carried out on a history of its own; the names of table and history are returned too."""
    job = job or f"m_{uuid.uuid4().hex}_1D"
    name = marts.history_name(job, marts.mode_of(flag))
    if history is not None:
        mart_load.store_history(frame(spark, SCHEMA, *history), name)
    return mart_load.refresh_stored(frame(spark, SCHEMA, *rows), job, flag, AS_OF), job, name


def test_refresh_is_carried_out(spark):
    history = [YESTERDAY, OTHER_MONTH, OLDER, UNSTAMPED]
    for flag, left in {"N": None, "O": 5, "OO": 4}.items():
        done, job, name = stored(spark, flag, [NEW], history if flag != "N" else None)
        assert values(done.table) == values(spark.table(job)) == [NEW]
        if left is None:
            assert done.history is None and not spark.catalog.tableExists(name.replace("_1D", ""))
            continue
        want = marts.refresh_mart(frame(spark, SCHEMA, NEW), frame(spark, SCHEMA, *history), marts.mode_of(flag), AS_OF)
        assert values(done.history) == values(spark.table(name).drop(*mart_load.PARTITIONS)) == values(want.history)
        assert len(values(done.history)) == left


def test_refresh_without_rows_history_or_month(spark):
    done, _, _ = stored(spark, "OO", [], [YESTERDAY])
    assert values(done.table) == values(done.history) == []  # the only partition goes
    done, _, _ = stored(spark, "OO", [NEW, ("dateless", None, TS)], None)
    assert values(done.history, "p") == [("dateless",), ("new",)]
    done, _, _ = stored(spark, "OO", [("past", "2023-11", TS)], [YESTERDAY, OTHER_MONTH])
    assert values(done.history, "p") == [("other month",), ("past",)]


def test_refresh_twice_and_with_a_new_column(spark):
    first, job, name = stored(spark, "OO", [YESTERDAY], [OLDER])
    wider = frame(spark, SCHEMA + ", extra int", (*NEW, 7))
    second = mart_load.refresh_stored(wider, job, "OO", AS_OF)
    assert values(second.table) == [(*NEW, 7)]
    assert values(second.history, "p", "extra") == [("new", 7), ("older", None)]


def test_refresh_that_fails_leaves_the_table(spark):
    _, job, _ = stored(spark, "N", [NEW], None)
    broken = frame(spark, SCHEMA, NEW).withColumn("p", F.raise_error(F.lit("view is broken")).cast("string"))
    with pytest.raises(Exception, match="view is broken"):
        mart_load.refresh_stored(broken, job, "N", AS_OF)
    assert values(spark.table(job)) == [NEW]
    with pytest.raises(ValueError, match="own history"):
        mart_load.refresh_stored(frame(spark, SCHEMA, NEW), "no_suffix", "O", AS_OF)
