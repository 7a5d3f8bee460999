"""A stream with state against one batch load, whatever way the rows are dealt to files, micro-batches and runs."""

import random
import shutil
from datetime import datetime, timedelta

import pytest
from helpers import TS, frame, plan_of, values
from pyspark.sql import functions as F

from quayside.operators.upsert import incremental_upsert, stamped
from quayside.streaming import keyed_state

SCHEMA = "k bigint, v string, RDATETIME timestamp_ntz, UDATETIME timestamp_ntz"
OLD, DAY = datetime(2024, 1, 1), datetime(2024, 1, 9)
IN = "RDATETIME >= timestamp_ntz'2024-01-09' OR UDATETIME >= timestamp_ntz'2024-01-09'"
TARGET_IN = "RDATETIME >= timestamp_ntz'2024-01-09'"


def versions():
    """Per key one to four versions; the first is a creation, some before the day."""
    rng = random.Random(5)
    out = []
    for k in range(12):
        created = OLD if k % 3 == 0 else DAY + timedelta(hours=k % 5)
        out.append((k, "0", created, None))
        out += [(k, str(n), created, DAY + timedelta(hours=rng.randrange(20), seconds=n)) for n in range(1, 1 + k % 4)]
    return out


def target(spark):
    return stamped(frame(spark, SCHEMA, (0, "old", OLD, None), (1, "old", DAY, None), (90, "gone", DAY, None), (91, "kept", OLD, None)), OLD)


def wanted(spark):
    newest = {}
    for row in versions():
        if row[2] >= DAY or (row[3] and row[3] >= DAY):
            key = (row[3] or row[2], row[3] is not None)
            if row[0] not in newest or key > newest[row[0]][0]:
                newest[row[0]] = key, row
    batch = frame(spark, SCHEMA, *[row for _, row in newest.values()])
    return values(incremental_upsert(target(spark), batch, ["k"], TARGET_IN, TS, strict=True))


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("seed, runs", [(1, 1), (2, 2), (3, 3)])
def test_any_split_and_order(spark, tmp_path, seed, runs):
    rng = random.Random(seed)
    rows = versions()
    rows += rng.sample(rows, 8)  # repeated rows
    rng.shuffle(rows)
    files = [rows[i::6] for i in range(6)]
    source, checkpoint, now = str(tmp_path / "in"), str(tmp_path / "checkpoint"), target(spark)
    for run in range(runs):
        for part in files[run::runs]:
            frame(spark, SCHEMA, *part).coalesce(1).write.mode("append").parquet(source)
        now = keyed_state.stateful_upsert(
            stream(spark, source), now, ["k"], IN, TS, str(tmp_path / f"landing{run}"), checkpoint, TARGET_IN if run == 0 else None
        )
    assert values(now) == wanted(spark)


def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch):
    """The driver dies in the second micro-batch; the run is repeated with its folder and checkpoint."""
    source, where = str(tmp_path / "in"), (str(tmp_path / "landing"), str(tmp_path / "checkpoint"))
    rows = versions()
    for i in range(4):
        frame(spark, SCHEMA, *rows[i::4]).coalesce(1).write.mode("append").parquet(source)
    write, calls = keyed_state.replace_partitions, []

    def stopped(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        write(*args)

    with monkeypatch.context() as patched:
        patched.setattr(keyed_state, "replace_partitions", stopped)
        with pytest.raises(Exception, match="lost"):
            keyed_state.stateful_upsert(stream(spark, source), target(spark), ["k"], IN, TS, *where, TARGET_IN)
    done = keyed_state.stateful_upsert(stream(spark, source), target(spark), ["k"], IN, TS, *where, TARGET_IN)
    assert values(done) == wanted(spark)


def test_a_version_older_than_the_target_s_changes_nothing(spark):
    held = stamped(frame(spark, SCHEMA, (1, "newer", OLD, DAY + timedelta(hours=5)), (2, "undated", None, None)), OLD)
    late = frame(spark, SCHEMA, (1, "late", OLD, DAY + timedelta(hours=4)), (2, "dated", OLD, None), (3, "other", OLD, None))
    loaded = keyed_state.load_newest(held, late, ["k"], TS)
    assert values(loaded, "k", "v") == [(1, "newer"), (2, "dated"), (3, "other")]


def test_state_is_let_go_by_arrival(spark, tmp_path):
    """With a span of no time at all, older versions land again in later runs and are settled by the target."""
    source, checkpoint, now = str(tmp_path / "in"), str(tmp_path / "checkpoint"), target(spark)
    for run, part in enumerate([versions()[::-1][::2], versions()[::-1][1::2]]):
        frame(spark, SCHEMA, *part).coalesce(1).write.mode("append").parquet(source)
        now = keyed_state.stateful_upsert(
            stream(spark, source), now, ["k"], IN, TS, str(tmp_path / f"l{run}"), checkpoint, TARGET_IN if run == 0 else None, span="1 second", delay="0 seconds"
        )
    assert values(now) == wanted(spark)


def test_no_rows_and_no_python(spark, tmp_path):
    source = str(tmp_path / "in")
    frame(spark, SCHEMA).write.parquet(source)
    now = keyed_state.stateful_upsert(stream(spark, source), target(spark), ["k"], IN, TS, str(tmp_path / "l"), str(tmp_path / "c"))
    assert values(now) == values(target(spark))
    assert "Python" not in plan_of(keyed_state.landed_newest(spark, str(tmp_path / "l"), target(spark).drop("MIG_DATETIME").schema, ["k"]))
    shutil.rmtree(source)


def test_composite_and_missing_keys(spark):
    rows = frame(spark, "a int, b string, v int, RDATETIME timestamp_ntz, UDATETIME timestamp_ntz", (1, None, 1, DAY, None), (1, None, 2, DAY, DAY), (1, "x", 3, DAY, None))
    newest = rows.groupBy("a", "b").agg(keyed_state._newest(rows.columns, keyed_state.version()).alias("r")).select(F.col("r.v"))
    assert values(newest) == [(2,), (3,)]
