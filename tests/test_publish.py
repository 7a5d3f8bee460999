"""Published tables: runs that fail after each step and are repeated."""

import os
import uuid
from datetime import date

import pytest
from helpers import TS, frame, values
from pyspark.sql import functions as F

from quayside.plans import mart_load, publish, settle

AS_OF = date(2024, 1, 10)
SCHEMA = "p string, CHECK_MONTH string, ADATETIME timestamp_ntz"
OLD = [("old", "2024-01-08", None), ("past", "2023-12", None)]
NEW = [("new", "2024-01-10", TS)]


@pytest.fixture
def job(spark):
    job = f"m_{uuid.uuid4().hex}_1D"
    yield job
    for name in (job, job.removesuffix("_1D"), job.removesuffix("_1D") + "_M"):
        publish.drop(spark, name)


def refresh(spark, job, rows, run, flag="O"):
    return mart_load.refresh_stored(frame(spark, SCHEMA, *rows), job, flag, AS_OF, run=run)


def broken_note(monkeypatch, broken, table):
    """A journal that fails to note one step of one table, as if the driver died there."""
    noted = publish.Journal.note

    def note(self, run, step, **told):
        if step == broken and self.folder.endswith(f"/{table}/_journal"):
            raise OSError("lost")
        noted(self, run, step, **told)

    monkeypatch.setattr(publish.Journal, "note", note)


@pytest.mark.parametrize("flag, suffix", [("O", ""), ("OO", "_M")])
@pytest.mark.parametrize("step", [publish.WRITTEN, publish.PUBLISHED])
@pytest.mark.parametrize("which", ["table", "history"])
def test_a_run_that_fails_is_repeated(spark, job, monkeypatch, flag, suffix, step, which):
    history = job.removesuffix("_1D") + suffix
    mart_load.store_history(frame(spark, SCHEMA, *OLD), history)
    refresh(spark, job, OLD, "first", "N")
    with monkeypatch.context() as patched:
        broken_note(patched, step, job if which == "table" else history)
        with pytest.raises(OSError, match="lost"):
            refresh(spark, job, NEW, "second", flag)
    seen = values(spark.table(history), "p")
    assert seen in ([("old",), ("past",)], [("new",), ("old",), ("past",)])  # never half
    assert values(spark.table(job), "p") in ([("new",)], [("old",), ("past",)])
    for _ in range(2):
        done = refresh(spark, job, NEW, "second", flag)
        assert values(done.table, "p") == values(spark.table(job), "p") == [("new",)]
        assert values(done.history, "p") == values(spark.table(history), "p") == [("new",), ("old",), ("past",)]


def test_a_run_that_fails_while_it_writes(spark, job):
    refresh(spark, job, OLD, "first", "N")
    rows = frame(spark, SCHEMA, *NEW).withColumn("p", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        mart_load.refresh_stored(rows, job, "N", AS_OF, run="second")
    assert values(spark.table(job), "p") == [("old",), ("past",)]
    assert values(refresh(spark, job, NEW, "second", "N").table, "p") == [("new",)]


def test_a_switch_that_fails_half_way(spark, job, monkeypatch):
    """Two rewritten months: the first points to the new version, then the driver dies."""
    name = job.removesuffix("_1D")
    rows = frame(spark, "p string, part string", ("a", "x"), ("b", "y"))
    publish.publish_parts(spark, lambda _: (rows, [("x",), ("y",)]), name, ["part"], "one")
    later = rows.withColumn("p", F.upper("p"))
    made, calls = publish._make, []

    def make(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        made(*args)

    with monkeypatch.context() as patched:
        patched.setattr(publish, "_make", make)
        with pytest.raises(OSError, match="lost"):
            publish.publish_parts(spark, lambda _: (later, [("x",), ("y",)]), name, ["part"], "two")
    never = lambda _: pytest.fail("written once")
    assert values(publish.publish_parts(spark, never, name, ["part"], "two"), "p") == [("A",), ("B",)]


def test_marts_survive_release(spark, job):
    refresh(spark, job, NEW, "first", "N")
    settle.release(spark)
    assert values(spark.table(job), "p") == [("new",)]


def test_former_versions_go(spark, job):
    for k in range(4):
        refresh(spark, job, [(str(k), "2024-01", TS)], f"run{k}", "N")
    folder = publish.folder_of(spark, job).removeprefix("file:")
    assert sorted(f for f in os.listdir(folder) if f.startswith("version")) == ["version=run2", "version=run3"]
    assert values(spark.table(job), "p") == [("3",)]


def test_versions_of_a_history_without_parts_go(spark, job):
    name = job.removesuffix("_1D")
    for k in range(4):
        rows = frame(spark, "p string, part string", (str(k), "x"))
        publish.publish_parts(spark, lambda _, rows=rows: (rows, [("x",)]), name, ["part"], f"run{k}")
    assert values(spark.table(name), "p") == [("3",)]
    folder = publish.folder_of(spark, name).removeprefix("file:")
    assert {"version=run0", "version=run1"}.isdisjoint(os.listdir(folder)) and "version=run3" in os.listdir(folder)


def test_other_types_columns_and_spellings(spark, job):
    name = job.removesuffix("_1D")
    first, second = frame(spark, "p bigint, part string", (1, "x")), frame(spark, "P int, part string, more int", (2, "y", 5))
    publish.publish_parts(spark, lambda _: (first, [("x",)]), name, ["part"], "one")
    table = publish.publish_parts(spark, lambda _: (second, [("y",)]), name, ["part"], "two")
    assert values(table, "p", "more", "part") == [(1, None, "x"), (2, 5, "y")]


def test_a_mart_may_change_its_columns(spark, job):
    refresh(spark, job, NEW, "first", "N")
    done = mart_load.refresh_stored(frame(spark, "other int", (7,)), job, "N", AS_OF, run="second")
    assert values(done.table) == values(spark.table(job)) == [(7,)]


def test_names_are_checked(spark):
    rows = frame(spark, "a int", (1,))
    for name, run in (("a b", "r"), ("a; DROP TABLE x", "r"), ("a", "../r"), ("a", "")):
        with pytest.raises(ValueError, match="not a"):
            publish.publish_table(rows, name, run)
