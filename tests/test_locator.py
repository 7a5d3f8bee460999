"""Loads by the locator against loads that read the whole table; the index of newest load times against the whole history."""

import glob
import os
import uuid
from datetime import date, datetime, timedelta

import pytest
from helpers import TS, frame, plan_of, values
from hypothesis import HealthCheck, given
from hypothesis import settings as examples
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators import dedup, upsert
from quayside.plans import batch_index, locator, publish
from quayside.plans.locator import Window
from quayside.plans.table_load import create_by_month, load_table

ROW = "id bigint, v string, RDATETIME timestamp_ntz, UDATETIME timestamp_ntz"
TARGET = f"{ROW}, MIG_DATETIME timestamp_ntz"
WINDOW = Window(date(2024, 3, 1), date(2024, 3, 11))


def at(month, day, year=2024):
    return datetime(year, month, day)


OLD = [(k, "old", at(1 + k % 3, 1 + k % 20), None, at(1, 1)) for k in range(40)]


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    locator.drop_locator(spark, name)
    publish.drop(spark, name)


def stored(spark, name, rows=OLD, schema=TARGET):
    create_by_month(frame(spark, schema, *rows), name, path=publish.folder_of(spark, name))
    locator.create_locator(spark, name, ["id"], buckets=8)


def rebuilt(spark, name):
    """What the locator should say now."""
    return values(spark.table(name).select("id", "LOAD_MONTH").distinct())


def kept(spark, name):
    return values(spark.table(f"{name}__keys"), "id", "LOAD_MONTH")


BATCHES = st.lists(
    st.lists(
        st.tuples(st.integers(0, 60), st.integers(1, 10), st.booleans()),
        max_size=6, unique_by=lambda r: r[0],
    ), min_size=1, max_size=3,
)


@examples(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=BATCHES, strict=st.booleans())
def test_as_the_load_that_reads_all(spark, batches, strict):
    """Rows created in the window, or created long before and updated in it."""
    name, plain = f"t_{uuid.uuid4().hex}", f"t_{uuid.uuid4().hex}"
    stored(spark, name)
    create_by_month(frame(spark, TARGET, *OLD), plain, path=publish.folder_of(spark, plain))
    for n, batch in enumerate(batches):
        rows = [(k, f"new{n}", at(1 + k % 3, d) if u else at(3, d), at(3, d) if u else None) for k, d, u in batch]
        source, run_ts = frame(spark, ROW, *rows), TS + timedelta(days=n)
        located = locator.load_located(name, source, WINDOW, run_ts, strict=strict)
        loaded = load_table(plain, source, ["id"], WINDOW.condition(), run_ts, strict=strict)
        columns = sorted(loaded.columns)
        assert values(located, *columns) == values(loaded, *columns)
        assert kept(spark, name) == rebuilt(spark, name)
    locator.drop_locator(spark, name)
    for t in (name, plain):
        publish.drop(spark, t)


def test_other_months_and_buckets_are_not_read(spark, name):
    """Their files are gone, and the load works."""
    stored(spark, name)
    batch = frame(spark, ROW, (4, "new", at(2, 5), at(3, 2)), (100, "new", at(3, 2), None))
    folder = publish.folder_of(spark, name).removeprefix("file:")
    for path in glob.glob(f"{folder}/LOAD_MONTH=2024-01/*.parquet"):
        os.remove(path)
    keys = spark.range(0).select(F.col("id").alias("id")).unionByName(batch.select("id"))
    used = {r[0] for r in keys.select(F.pmod(F.xxhash64("id"), F.lit(8)).cast("int")).collect()}
    parts = glob.glob(publish.folder_of(spark, f"{name}__keys").removeprefix("file:") + "/version=*/KEY_BUCKET=*")
    changed = {r[0] for r in spark.range(40).where("id % 3 = 2 AND id % 20 < 10").select(F.pmod(F.xxhash64("id"), F.lit(8)).cast("int")).collect()}
    for path in parts:
        if int(path.rsplit("=", 1)[1]) not in used | changed:
            for file in glob.glob(f"{path}/*.parquet"):
                os.remove(file)
    loaded = locator.load_located(name, batch, WINDOW, TS)
    assert values(loaded.where("v = 'new' AND LOAD_MONTH <> '2024-01'"), "id") == [(4,), (100,)]
    assert values(loaded.where("id = 4 AND LOAD_MONTH <> '2024-01'"), "v") == [("new",)]


def test_plans_name_the_buckets_and_months(spark, name):
    stored(spark, name)
    plan = plan_of(locator.key_months(spark, name, frame(spark, "id int", (4,))))
    assert "PartitionFilters: [" in plan and "KEY_BUCKET" in plan.split("PartitionFilters: [")[1].split("]")[0]
    plan = plan_of(locator.window_months(spark, name, WINDOW))
    assert "2024-03" in plan.split("PartitionFilters: [")[1].split("]")[0] and "2024-01" not in plan


@pytest.mark.parametrize("step", ["loaded", "done", "written", "published"])
def test_a_run_that_fails_is_repeated(spark, name, monkeypatch, step):
    stored(spark, name)
    batch = frame(spark, ROW, (4, "new", at(2, 5), at(3, 2)), (100, "new", at(3, 2), None))
    noted = publish.Journal.note

    def note(self, run, what, **told):
        if what == step and run == "day":
            raise OSError("lost")
        noted(self, run, what, **told)

    with monkeypatch.context() as patched:
        patched.setattr(publish.Journal, "note", note)
        with pytest.raises(OSError, match="lost"):
            locator.load_located(name, batch, WINDOW, TS, "day")
    with pytest.raises(ValueError, match="repeat the run day"):
        locator.load_located(name, batch, WINDOW, TS, "next")
    want = values(upsert.incremental_upsert(frame(spark, TARGET, *OLD), batch, ["id"], WINDOW.condition(), TS))
    for _ in range(2):
        loaded = locator.load_located(name, batch, WINDOW, TS, "day")
        assert values(loaded.drop("LOAD_MONTH")) == want
        assert kept(spark, name) == rebuilt(spark, name)


def test_odd_cases(spark, name):
    stored(spark, name, [(None, "none", at(1, 3), None, at(1, 1)), (1, "undated", None, None, at(1, 1)), *OLD[2:]])
    assert values(locator.load_located(name, frame(spark, ROW), WINDOW, TS).drop("LOAD_MONTH"), "id")[:2] == [(None,), (1,)]
    loaded = locator.load_located(name, frame(spark, "ID bigint, V string, rdatetime timestamp_ntz, udatetime timestamp_ntz", (1, "new", at(3, 3), at(3, 4))), WINDOW, TS)
    assert values(loaded.where("id = 1"), "v", "LOAD_MONTH") == [("new", "2024-03")]
    assert values(loaded.where("id IS NULL"), "v") == [("none",)]
    assert kept(spark, name) == rebuilt(spark, name)
    with pytest.raises(ValueError, match="types differ"):
        locator.load_located(name, frame(spark, "id string, RDATETIME timestamp_ntz", ("1", at(3, 3))), WINDOW, TS)
    assert values(locator.load_located(name, frame(spark, ROW, (9, "later", at(3, 9), None)), WINDOW, TS).where("v = 'later'"), "id") == [(9,)]
    with pytest.raises(ValueError, match="no locator"):
        locator.load_located("default.nothing", frame(spark, ROW), WINDOW, TS)
    with pytest.raises(ValueError, match="knows none"):
        locator.window_months(spark, name, Window(date(2024, 1, 1), date(2024, 1, 2), ("OTHER",)))


# The index of newest load times.

STAMPED = "k int, MIG_DATETIME timestamp_ntz"
SERIES = st.lists(
    st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(1, 6))), max_size=5), min_size=1, max_size=4
)


@examples(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(series=SERIES)
def test_as_the_whole_history(spark, series):
    """Batches with load times in any order, repeated, and missing; the history is purged after each."""
    name, history = f"i_{uuid.uuid4().hex}", []
    for n, batch in enumerate(series):
        rows = [(k, d and at(1, d)) for k, d in batch]
        history += rows
        whole = values(dedup.superseded_stamps(frame(spark, STAMPED, *history), ["k"]))
        found = batch_index.merge_batch(name, frame(spark, STAMPED, *rows), ["k"], f"r{n}", buckets=4)
        assert [d for d in values(found) if d[0] is not None] == [d for d in whole if d[0] is not None]
        gone = {d[0] for d in whole}
        history = [r for r in history if r[1] is None or r[1] not in gone]
    batch_index.drop_index(spark, name)


def test_a_merge_is_repeated(spark, monkeypatch):
    name = f"i_{uuid.uuid4().hex}"
    first, second = frame(spark, STAMPED, (1, at(1, 1)), (2, at(1, 1))), frame(spark, STAMPED, (1, at(1, 2)))
    assert values(batch_index.merge_batch(name, first, ["k"], "a")) == []
    noted = publish.Journal.note
    for step in (publish.WRITTEN, publish.PUBLISHED, batch_index.DONE):
        with monkeypatch.context() as patched:
            patched.setattr(publish.Journal, "note", lambda self, run, what, **t: (_ for _ in ()).throw(OSError("lost")) if what == step and run == "b" else noted(self, run, what, **t))  # noqa: B023
            with pytest.raises(OSError, match="lost"):
                batch_index.merge_batch(name, second, ["k"], "b")
    with pytest.raises(ValueError, match="repeat the run b"):
        batch_index.merge_batch(name, second, ["k"], "c")
    for _ in range(2):
        assert values(batch_index.merge_batch(name, second, ["k"], "b")) == [(at(1, 1),)]
    assert values(batch_index.merge_batch(name, frame(spark, STAMPED, (2, at(1, 3))), ["k"], "c")) == []  # key 2 was purged
    with pytest.raises(ValueError, match="is an index of"):
        batch_index.merge_batch(name, second, ["MIG_DATETIME"], "d")
    batch_index.drop_index(spark, name)


def test_a_load_tells_what_is_stale_without_a_join(spark, monkeypatch):
    """Entries are grouped by key once, without a sort for it; only keys with more load times in one batch are joined."""
    name, plans, publish_parts = f"i_{uuid.uuid4().hex}", [], batch_index.publish_parts

    def noted(spark, changed, *args, **options):
        plans.append(plan_of(changed(None)[0]))
        return publish_parts(spark, changed, *args, **options)

    monkeypatch.setattr(batch_index, "publish_parts", noted)
    first = [(1, at(1, 1)), (1, at(1, 2)), (2, at(1, 2)), (2, at(1, 2)), (None, at(1, 3)), (4, None), (4, at(1, 5))]
    second = [(1, at(1, 6)), (None, at(1, 3)), (5, at(1, 7)), (5, at(1, 8)), (5, at(1, 9)), (5, at(1, 10))]
    found = values(batch_index.merge_batch(name, frame(spark, STAMPED, *first), ["k"], "a"))
    assert found == [(None,), (at(1, 1),), (at(1, 2),), (at(1, 5),)]
    assert not [p for p in plans if "Join" in p] and "Aggregate" not in plans[1] and len(plans) == 2
    # The unstamped entry stays the newest of its key and is told again; those of the purged second day are void.
    found = values(batch_index.merge_batch(name, frame(spark, STAMPED, *second), ["k"], "b"))
    assert found == [(None,), (at(1, 3),), (at(1, 7),), (at(1, 8),), (at(1, 9),)]
    assert "Join" in plans[2] and "Join" not in plans[3]
    batch_index.drop_index(spark, name)


def test_only_touched_buckets_are_read(spark):
    name = f"i_{uuid.uuid4().hex}"
    batch_index.merge_batch(name, spark.range(64).select(F.col("id").cast("int").alias("k"), F.lit(at(1, 1)).cast("timestamp_ntz").alias("MIG_DATETIME")), ["k"], "a", buckets=16)
    bucket = spark.range(7, 8).select(F.pmod(F.xxhash64(F.col("id").cast("int")), F.lit(16))).first()[0]
    folder = publish.folder_of(spark, name).removeprefix("file:")
    for file in glob.glob(f"{folder}/version=*/KEY_BUCKET=*/*.parquet"):
        if f"KEY_BUCKET={bucket}/" not in file:
            os.remove(file)
    assert values(batch_index.merge_batch(name, frame(spark, STAMPED, (7, at(1, 2))), ["k"], "b")) == [(at(1, 1),)]
    batch_index.drop_index(spark, name)


def test_undated_rows_are_parts_by_key(spark, name):
    """A load into a table without dates rewrites the parts of its keys only."""
    from quayside.plans.table_load import PARTITION

    rows = frame(spark, "id bigint, v string, MIG_DATETIME timestamp_ntz", *[(k, "old", at(1, 1)) for k in range(200)])
    create_by_month(rows, name, keys=["id"], undated_parts=16, path=publish.folder_of(spark, name))
    assert spark.table(name).select(PARTITION).distinct().count() == 16
    folder = publish.folder_of(spark, name).removeprefix("file:")
    before = set(glob.glob(f"{folder}/*/*.parquet"))
    batch = frame(spark, "id bigint, v string", (7, "new"), (500, "new"))
    loaded = load_table(name, batch, ["id"], "false", TS, strict=True, undated_parts=16)
    assert values(loaded.where("v = 'new'"), "id") == [(7,), (500,)] and loaded.count() == 201
    assert len(before - set(glob.glob(f"{folder}/*/*.parquet"))) <= 2
    again = load_table(name, batch, ["id"], "false", TS + timedelta(days=1), strict=True)  # as one part
    assert again.count() == 201 and values(again.where("v = 'new'"), "id") == [(7,), (500,)]
