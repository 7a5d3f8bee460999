import hashlib
from datetime import date, datetime

import pytest
from helpers import TS, frame, plan_of, values
from hypothesis import HealthCheck, given
from hypothesis import settings as examples
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators import checksums
from quayside.operators.checksums import Differing, Ranges

KEY = Ranges("k", 4, fanout=3, levels=4)
SCHEMA = "k bigint, v string, RDATETIME timestamp_ntz"
DAY = datetime(2024, 1, 5)


def test_statuses(spark):
    source = frame(spark, SCHEMA, (1, "a", DAY), (2, "b", DAY), (-7, None, DAY), (50, "x", DAY), (50, "x", DAY), (None, "n", DAY))
    target = frame(spark, SCHEMA, (1, "a", DAY), (3, "b", DAY), (-7, "", DAY), (50, "x", DAY), (None, "m", DAY))
    found = checksums.differences(source, target, ["k"], KEY)
    assert values(found) == [
        (None, "CHANGED", 1, 1), (-7, "CHANGED", 1, 1), (2, "MISSING", 1, 0), (3, "ORPHAN", 0, 1), (50, "CHANGED", 2, 1),
    ]


def test_equal_counts_do_not_hide(spark):
    """One row of a month lost and another one added."""
    source, target = frame(spark, SCHEMA, (1, "a", DAY), (2, "b", DAY)), frame(spark, SCHEMA, (1, "a", DAY), (9, "b", DAY))
    for ranges in (KEY, Ranges("RDATETIME", 16)):
        assert values(checksums.differences(source, target, ["k"], ranges), "k", "status") == [(2, "MISSING"), (9, "ORPHAN")]


def test_empty_sides(spark):
    none, some = frame(spark, SCHEMA), frame(spark, SCHEMA, (1, "a", DAY))
    assert values(checksums.differences(none, none, ["k"], KEY)) == []
    assert values(checksums.differences(some, none, ["k"], KEY), "k", "status") == [(1, "MISSING")]
    assert values(checksums.differences(none, some, ["k"], KEY), "k", "status") == [(1, "ORPHAN")]


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(-40, 40)), st.sampled_from(["a", "b", None])), max_size=12)


@examples(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=ROWS, right=ROWS)
def test_against_plain_python(spark, left, right):
    def grouped(rows):
        out = {}
        for k, v in rows:
            out.setdefault(k, []).append(v)
        return {k: sorted(map(repr, v)) for k, v in out.items()}

    a, b = grouped(left), grouped(right)
    expected = {k: "MISSING" if k not in b else "ORPHAN" if k not in a else "CHANGED" for k in {*a, *b} if a.get(k) != b.get(k)}
    found = checksums.differences(frame(spark, "k int, v string", *left), frame(spark, "k int, v string", *right), ["k"], KEY)
    assert {r.k: r.status for r in found.collect()} == expected


def test_equal_ranges_are_not_read(spark, tmp_path):
    """Rows of ranges that do not differ would end the query if they were looked at."""
    rows = spark.range(4000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    damaged = rows.withColumn("v", F.when(F.col("k") == 2345, F.lit("b")).otherwise(F.col("v")))
    ranges = Ranges("k", 10, fanout=8, levels=5)
    sides = [checksums.tree(checksums.leaves(s, ranges, ["k", "v"]), ranges) for s in (rows, damaged)]
    trapped = lambda df: df.withColumn("v", F.when(F.col("k").between(2340, 2349), F.col("v")).otherwise(F.raise_error(F.lit("read")).cast("string")))
    found = checksums.differences(trapped(rows), trapped(damaged), ["k"], ranges, trees=sides)
    assert values(found) == [(2345, "CHANGED", 1, 1)]
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    plan = plan_of(checksums.in_ranges(spark.read.parquet(path), Differing(0, [234]), ranges))
    assert "GreaterThanOrEqual(k,2340), LessThan(k,2350)" in plan


def test_many_differences_widen_the_ranges(spark):
    ranges = Ranges("k", 1, fanout=4, levels=5)
    sides = [checksums.tree(checksums.leaves(spark.range(n).withColumnRenamed("id", "k"), ranges, ["k"]), ranges) for n in (0, 200)]
    assert checksums.differing(*sides, ranges, most=20) == Differing(2, list(range(13)))
    with pytest.raises(ValueError, match="more levels"):
        checksums.differing(*sides, ranges, most=0)


def test_leaves_add_up(spark):
    """Stored leaves of parts are the leaves of the whole."""
    rows = spark.range(100).select(F.col("id").alias("k"))
    parts = [checksums.leaves(rows.where(w), KEY, ["k"]) for w in ("k % 3 = 0", "k % 3 <> 0")]
    summed = parts[0].unionByName(parts[1]).groupBy("node").agg(*[F.sum(c).alias(c) for c in checksums.SUMS])
    assert values(summed) == values(checksums.leaves(rows, KEY, ["k"]))


def test_portable_hash(spark):
    rows = frame(spark, "k int, v string, d date", (7, None, date(2024, 1, 5)))
    text = "7|\\0|2024-01-05"
    assert rows.select(checksums.portable_hash(["k", "v", "d"])).first()[0] == int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    query = checksums.leaves_query("dbo.T", KEY, ["k", "v"])
    assert "HASHBYTES('MD5', CONCAT_WS('|', COALESCE(CAST(k AS VARCHAR(4000)), '\\0'), COALESCE(CAST(v" in query and "GROUP BY node" in query
    with pytest.raises(ValueError, match="not a table"):
        checksums.leaves_query("T; DROP", KEY, ["k"])


def test_repair(spark):
    source = frame(spark, SCHEMA, (1, "a", DAY), (2, "b", DAY), (4, "d", DAY))
    target = frame(spark, SCHEMA + ", MIG_DATETIME timestamp_ntz", (1, "a", DAY, DAY), (2, "old", DAY, DAY), (3, "c", DAY, DAY))
    found = checksums.differences(source, target, ["k"], KEY)
    whole = checksums.repaired(source, target, ["k"], found, TS)
    assert values(whole, "k", "v", "MIG_DATETIME") == [(1, "a", DAY), (2, "b", TS), (4, "d", TS)]


def test_bad_calls(spark):
    with pytest.raises(ValueError, match="neither"):
        checksums.leaves(frame(spark, SCHEMA), Ranges("v", 4), ["k"])
    with pytest.raises(ValueError, match="lacks"):
        checksums.differences(frame(spark, SCHEMA), frame(spark, "k bigint"), ["k"], KEY)
