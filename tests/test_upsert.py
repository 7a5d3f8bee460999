import random
from datetime import date, datetime

import pytest
from helpers import TS, frame, values
from pyspark.sql import functions as F

from quayside.operators import upsert

SCHEMA = "k bigint, v string, RDATETIME timestamp_ntz, UDATETIME timestamp_ntz"
DAY = "RDATETIME >= timestamp_ntz'2024-01-09' AND RDATETIME < timestamp_ntz'2024-01-10'"
IN = f"({DAY}) OR (UDATETIME >= timestamp_ntz'2024-01-09' AND UDATETIME < timestamp_ntz'2024-01-10')"
OLD, NOW = datetime(2024, 1, 1), datetime(2024, 1, 9, 8)


def target(spark):
    rows = [(1, "old", OLD, None), (2, "old", OLD, None), (3, "gone", NOW, None), (4, "old", OLD, None)]
    return upsert.stamped(frame(spark, SCHEMA, *rows), OLD)


def source(spark):
    rows = [
        (1, "updated", OLD, NOW),
        (4, "moved into the window", NOW, None),
        (5, "new", NOW, None),
        (6, "outside", OLD, None),
    ]
    return frame(spark, SCHEMA, *rows)


def test_delete_keeps_unknown_rows(spark):
    rows = frame(spark, "a int", (1,), (None,), (5,))
    assert values(upsert.delete_where(rows, "a > 3")) == [(None,), (1,)]


def test_delete_older_keeps_undated_rows(spark):
    rows = frame(spark, "t timestamp_ntz", (OLD,), (None,), (NOW,))
    assert values(upsert.delete_older(rows, "t", date(2024, 1, 9))) == [(None,), (NOW,)]


def test_daily_load(spark):
    loaded = upsert.load_window(source(spark), target(spark), ["k"], IN, TS)
    # Row 4 was never updated, so its old copy outside the window stays: a duplicate.
    assert values(loaded, "k", "v") == [
        (1, "updated"), (2, "old"), (4, "moved into the window"), (4, "old"), (5, "new"),
    ]
    assert {r.MIG_DATETIME for r in loaded.where("v = 'new' OR v = 'updated'").collect()} == {TS}


def test_strict_load_replaces_every_key(spark):
    loaded = upsert.load_window(source(spark), target(spark), ["k"], IN, TS, strict=True)
    assert values(loaded, "k", "v") == [(1, "updated"), (2, "old"), (4, "moved into the window"), (5, "new")]


def test_load_twice_equals_once(spark):
    once = upsert.load_window(source(spark), target(spark), ["k"], IN, TS)
    twice = upsert.load_window(source(spark), once, ["k"], IN, TS)
    assert values(twice) == values(once)


def test_empty_batch_changes_nothing(spark):
    loaded = upsert.load_window(source(spark).where("false"), target(spark), ["k"], IN, TS)
    assert values(loaded) == values(target(spark))


def test_table_without_key(spark):
    with pytest.raises(ValueError, match="no key"):
        upsert.load_window(source(spark), target(spark), None, IN, TS)
    loaded = upsert.load_window(source(spark), target(spark), [], IN, TS)
    assert (1, "old") in values(loaded, "k", "v")
    assert (3, "gone") not in values(loaded, "k", "v")


def test_source_without_update_time(spark):
    loaded = upsert.load_window(source(spark).drop("UDATETIME"), target(spark), ["k"], DAY, TS)
    assert values(loaded, "k", "v") == [
        (1, "old"), (2, "old"), (4, "moved into the window"), (4, "old"), (5, "new"),
    ]


def test_keys_are_compared_by_column(spark):
    rows = frame(spark, "a string, b string", ("1", "23"), ("12", "3"))
    assert values(upsert.delete_keys(rows, frame(spark, "a string, b string", ("1", "23")))) == [("12", "3")]


def test_key_with_a_missing_part_is_not_deleted(spark):
    rows = frame(spark, "a int, b int", (1, None), (1, 2))
    assert values(upsert.delete_keys(rows, rows)) == [(1, None)]


def test_hourly_predicates_differ(spark):
    loaded = upsert.load_window(source(spark), target(spark), ["k"], IN, TS, target_pred="RDATETIME > timestamp_ntz'2024-01-09'")
    assert (1, "updated") in values(loaded, "k", "v")


def test_load_of_a_new_column(spark):
    loaded = upsert.load_window(source(spark).withColumn("extra", F.lit("x")), target(spark), ["k"], IN, TS)
    assert (2, None) in values(loaded, "k", "extra")
    assert (5, "x") in values(loaded, "k", "extra")


def brute_load(target, batch, in_window, strict):
    """The load row by row: batch and target rows are (key, value, created, updated)."""
    if not batch:
        return target
    replaced = {r[0] for r in batch if r[0] is not None and (strict or r[3] is not None)}
    return [r for r in target if r[0] not in replaced and not in_window(r)] + batch


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("strict", [False, True])
def test_load_equals_brute_force(spark, seed, strict):
    rng = random.Random(seed)
    moments = [None, OLD, NOW, datetime(2024, 1, 9), datetime(2024, 1, 10), TS]

    def some(n, value):
        return [(rng.choice([None, 1, 1, 1, *range(2, 12)]), f"{value}{i}", rng.choice(moments), rng.choice(moments)) for i in range(n)]

    def in_window(row):
        return any(m is not None and datetime(2024, 1, 9) <= m < datetime(2024, 1, 10) for m in row[2:4])

    old, new = some(40, "old"), some(25, "new")
    batch = [r for r in new if in_window(r)]
    loaded = upsert.load_window(frame(spark, SCHEMA, *new), frame(spark, SCHEMA, *old), ["k"], IN, TS, strict=strict)
    expected = [r[1] for r in brute_load(old, batch, in_window, strict)]
    assert sorted(r.v for r in loaded.collect()) == sorted(expected)


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz"])
def test_load_time_has_the_type_of_the_table(spark, kind):
    typed = target(spark).withColumn("MIG_DATETIME", F.col("MIG_DATETIME").cast(kind))
    loaded = upsert.load_window(source(spark), typed, ["k"], IN, TS)
    assert loaded.schema["MIG_DATETIME"].dataType.simpleString() == kind
    assert loaded.where("v = 'new'").select(F.col("MIG_DATETIME").cast("string")).first()[0] == "2024-01-10 03:00:00"


def test_touched_partitions(spark):
    found = upsert.touched_partitions(
        target(spark), source(spark).where(IN), ["k"], IN, F.to_date("RDATETIME"), "day"
    )
    assert values(found) == [(date(2024, 1, 1),), (date(2024, 1, 9),)]
