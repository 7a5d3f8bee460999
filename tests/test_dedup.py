import random
from datetime import datetime, timedelta

import pytest
from helpers import frame, values

from quayside.operators import dedup

SCHEMA = "a int, b string, v int, MIG_DATETIME timestamp_ntz"
T = [datetime(2024, 1, 1) + timedelta(days=i) for i in range(6)]


def brute_purge(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[:2], []).append(row[3])
    stale = set()
    for stamps in groups.values():
        ordered = sorted(stamps, key=lambda s: (s is not None, -s.timestamp() if s else 0))
        stale.update(s for s in ordered[1:] if s is not None)
    return [r for r in rows if r[3] not in stale]


def key(row):
    return [(v is not None, v) for v in row]


def test_latest_row_per_key(spark):
    rows = frame(spark, SCHEMA, (1, "x", 1, T[0]), (1, "x", 2, T[2]), (2, "x", 3, T[1]))
    assert values(dedup.keep_latest(rows, ["a", "b"]), "v") == [(2,), (3,)]


def test_unstamped_row_is_the_newest(spark):
    rows = frame(spark, SCHEMA, (1, "x", 1, T[0]), (1, "x", 2, None))
    assert values(dedup.keep_latest(rows, ["a", "b"]), "v") == [(2,)]


def test_ties_are_broken(spark):
    rows = frame(spark, SCHEMA, *[(1, "x", v, T[0]) for v in range(5)])
    assert values(dedup.keep_latest(rows, ["a", "b"], tie_breakers=["v"]), "v") == [(4,)]


def test_a_batch_goes_as_a_whole(spark):
    # (2, y) has no newer copy, but it was loaded with the superseded (1, x).
    rows = frame(spark, SCHEMA, (1, "x", 1, T[0]), (2, "y", 2, T[0]), (1, "x", 3, T[1]))
    assert values(dedup.purge_superseded_batches(rows, ["a", "b"]), "v") == [(3,)]


def test_two_copies_in_one_batch_remove_it(spark):
    rows = frame(spark, SCHEMA, (1, "x", 1, T[0]), (1, "x", 2, T[0]), (3, "z", 3, T[1]))
    assert values(dedup.purge_superseded_batches(rows, ["a", "b"]), "v") == [(3,)]


def test_unstamped_rows_stay(spark):
    rows = frame(spark, SCHEMA, (1, "x", 1, None), (1, "x", 2, None), (1, "x", 3, T[0]))
    assert values(dedup.purge_superseded_batches(rows, ["a", "b"]), "v") == [(1,), (2,)]


@pytest.mark.parametrize("seed", range(4))
def test_purge_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    stamps = [*T, None] if seed % 2 else T
    rows = [
        (
            rng.choice([None, 1, 1, 1, 2, 3, *range(10, 40)]),
            rng.choice(["x", None]) if seed > 1 else "x",
            i,
            rng.choice(stamps) if seed != 3 else T[0] + timedelta(hours=rng.randrange(60)),
        )
        for i in range(20 + 10 * seed)
    ]
    found = values(dedup.purge_superseded_batches(frame(spark, SCHEMA, *rows), ["a", "b"]))
    assert found == sorted(brute_purge(rows), key=key)


def test_one_row_per_key(spark):
    rng = random.Random(7)
    rows = frame(spark, SCHEMA, *[(rng.choice([1] * 20 + list(range(30))), "x", i, rng.choice(T)) for i in range(300)])
    latest = dedup.keep_latest(rows, ["a", "b"])
    assert latest.count() == rows.select("a", "b").distinct().count()
