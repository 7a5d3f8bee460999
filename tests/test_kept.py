"""Counts by difference, sketches, balanced ranges and registered schemas against plain ways."""

import itertools
import random
import uuid
from datetime import date, datetime, timedelta
from statistics import median

import pytest
from helpers import TS, frame, plan_of, settings, values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import distinct, upsert
from quayside.plans import counters, publish, schema_register
from quayside.plans.schema_register import wider, widest
from quayside.sources import databases

ROW = "id bigint, v string, RDATETIME timestamp_ntz, UDATETIME timestamp_ntz"
TARGET = f"{ROW}, MIG_DATETIME timestamp_ntz"
PRED = "RDATETIME >= timestamp_ntz'2024-03-01' OR UDATETIME >= timestamp_ntz'2024-03-01'"


def at(month, day):
    return datetime(2024, month, day)


@pytest.fixture
def name(spark):
    name = f"k_{uuid.uuid4().hex}"
    yield name
    publish.drop(spark, name)


def recount(rows):
    return values(rows.groupBy(F.date_format("RDATETIME", "yyyy-MM").alias("date")).count())


@pytest.mark.parametrize("strict", [False, True])
def test_counts_after_loads_deletes_and_purges(spark, name, strict):
    rng, now = random.Random(3), frame(spark, TARGET, *[(k, "old", at(1 + k % 3, 1), None, at(1, 1)) for k in range(20)], (99, "undated", None, None, at(1, 1)))
    counters.note_changes(name, "T", "first", added=[now])
    for n in range(3):
        keys = rng.sample(range(30), 5)
        batch = frame(spark, ROW, *[(k, "new", at(1 + k % 3, 2), at(3, 3)) if k % 2 else (k, "new", at(3, 4), None) for k in keys])
        gone = counters.removed_by(now, batch, ["id"], PRED, strict=strict)
        after = upsert.incremental_upsert(now, batch, ["id"], PRED, TS + timedelta(days=n), strict=strict)
        for _ in range(2):
            counters.note_changes(name, "T", f"load{n}", added=[batch], removed=[gone])
        now = frame(spark, TARGET, *after.collect())
        assert values(counters.counted_months(spark, name), "date", "row_count") == recount(now)
    doomed = now.where("id < 4")
    counters.note_changes(name, "T", "orphans", removed=[doomed])
    now = upsert.delete_keys(now, doomed.select("id"))
    assert values(counters.counted_months(spark, name), "date", "row_count") == recount(now)
    assert counters.audit(name, "T", now, "audit1").collect() == []
    wrong = counters.audit(name, "T", now.where("id <> 9"), "audit2")
    assert [(r.counted - r.row_count) for r in wrong.collect()] == [now.where("id = 9").count()] if now.where("id = 9").count() else True
    assert values(counters.counted_months(spark, name), "date", "row_count") == recount(now.where("id <> 9"))


def test_counts_of_several_jobs(spark, name):
    rows = frame(spark, ROW, (1, "a", at(1, 1), None), (2, "a", at(2, 1), None))
    counters.note_changes(name, "A", "r", added=[rows])
    counters.note_changes(name, "B", "r", added=[rows, rows])
    assert values(counters.counted_months(spark, name, date(2024, 2, 10), 0)) == [("A", "2024-02", 1), ("B", "2024-02", 2)]
    assert values(counters.counted_months(spark, name, jobs=["B"]), "date", "row_count") == [("2024-01", 2), ("2024-02", 2)]
    counters.note_changes(name, "C", "r", spark=spark)
    assert values(counters.counted_months(spark, name, jobs=["C"])) == []


# Distinct counts.

FACTS = "g string, d date, item bigint"


def facts(spark):
    big = spark.range(60_000).select(F.lit("big").alias("g"), F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("d"), (F.col("id") % 20_000).alias("item"))
    few = frame(spark, FACTS, ("few", date(2024, 1, 3), 1), ("few", date(2024, 1, 4), 1), ("few", date(2024, 1, 4), None), (None, date(2024, 1, 5), 7), ("out", date(2023, 1, 1), 5))
    return big.unionByName(few)


def test_sketches_are_within_their_error(spark):
    rows = facts(spark)
    sketches = distinct.daily_sketches(rows, ["g"], "d", "item")
    for days in (1, 5, 20):
        end = date(2024, 1, 1) + timedelta(days=days - 1)
        found = dict(values(distinct.estimated(sketches, ["g"], "d", date(2024, 1, 1), end)))
        true = dict(values(distinct.exact(rows, ["g"], "d", "item", date(2024, 1, 1), end)))
        assert set(found) == set(true) and all(abs(found[g] - n) <= distinct.relative_error() * n for g, n in true.items())


def test_days_are_united_as_they_come(spark):
    rows = facts(spark)
    days = [distinct.daily_sketches(rows.where(w), ["g"], "d", "item") for w in ("d < '2024-01-08'", "d >= '2024-01-08'")]
    whole = distinct.daily_sketches(rows, ["g"], "d", "item")
    args = (["g"], "d", date(2024, 1, 1), date(2024, 1, 31))
    assert values(distinct.estimated(days[0].unionByName(days[1]), *args)) == values(distinct.estimated(whole, *args))


def test_counts_near_the_tolerance_are_exact(spark):
    rows = facts(spark)
    sketches = distinct.daily_sketches(rows, ["g"], "d", "item")
    for stated, check, exact in ((20_000, "", True), (20_999, "", True), (21_001, "Error", True), (40_000, "Error", False), (100, "Error", False)):
        told = frame(spark, "g string, stated bigint", ("big", stated), ("few", 1), (None, 2), ("none", 0))
        found = distinct.verify_counts(told, rows, sketches, ["g"], "d", "item", date(2024, 1, 1), date(2024, 1, 31), 0.05)
        assert {r.g: r.CHECK for r in found.collect()} == {"big": check, "few": "", None: "Error", "none": ""}
        assert exact or not found.where("g = 'big'").first().EXACT
    wide = distinct.verify_counts(frame(spark, "g string, stated bigint", ("big", 20_000)), rows, sketches, ["g"], "d", "item", date(2024, 1, 1), date(2024, 1, 31), 0.5)
    assert not wide.first().EXACT and wide.first().CHECK == ""


# Balanced ranges.


def edges_of(keys, parts):
    asked = []

    def counts(low, end, width):
        found = {}
        for k in keys:
            if low <= k < end:
                found[(k - low) // width] = found.get((k - low) // width, 0) + 1
        asked.append(len(found))
        return found

    return databases.balanced_edges(counts, min(keys), max(keys), parts), asked


@pytest.mark.parametrize("shape", ["even", "crowded", "powers", "two ends"])
def test_ranges_are_balanced(shape):
    rng = random.Random(1)
    keys = {
        "even": lambda: rng.randrange(10**6),
        "crowded": lambda: rng.randrange(500, 1500) if rng.random() < 0.6 else rng.randrange(10**9),
        "powers": lambda: int(rng.random() ** 6 * 10**12),
        "two ends": lambda: rng.choice([0, 10**8]) + rng.randrange(3000),
    }[shape]
    keys = [keys() for _ in range(20_000)]
    edges, asked = edges_of(keys, 32)
    sizes = [sum(a <= k < b for k in keys) for a, b in itertools.pairwise(edges)]
    assert sum(sizes) == len(keys) and max(sizes) <= 2 * median(sizes) and 24 <= len(sizes) <= 40
    assert max(asked) <= 1024


def test_ranges_of_odd_tables():
    assert edges_of([7], 4)[0] == [7, 8]
    assert edges_of([5] * 100 + [6], 10)[0][0] == 5
    assert databases.balanced_edges(lambda *_: {}, 0, 9, 3) == [0, 10]
    with pytest.raises(ValueError, match="needs a part"):
        databases.balanced_edges(lambda *_: {}, 9, 0, 3)


def test_histograms(spark):
    rows = frame(spark, "k int", *[(k,) for k in (0, 1, 9, 10, 25, None, -3)])
    assert values(databases.histogram(rows, "k", 0, 10)) == [(0, 3), (1, 1), (2, 1)]
    assert databases.histogram_query("dbo.T", "K", 5, 10, 95) == (
        "SELECT FLOOR((K - 5) / 10) AS bin, COUNT(*) AS n FROM dbo.T WHERE K >= 5 AND K < 95 GROUP BY FLOOR((K - 5) / 10)"
    )
    with pytest.raises(ValueError, match="not a table"):
        databases.histogram_query("T; DROP", "K", 0, 1, 2)


# Schemas.

TYPES = [T.ByteType(), T.IntegerType(), T.LongType(), T.DecimalType(5, 2), T.DecimalType(38, 10), T.DecimalType(20, 18), T.FloatType(), T.DoubleType(), T.DateType(), T.TimestampNTZType(), T.TimestampType(), T.StringType(), T.NullType(), T.BooleanType()]


def test_widening_does_not_depend_on_the_order():
    for a, b in itertools.product(TYPES, repeat=2):
        assert wider(a, b) == wider(b, a)
    rng = random.Random(2)
    for _ in range(300):
        some = rng.sample(TYPES, 4)
        assert len({str(widest(p)) for p in itertools.permutations(some)}) == 1
    assert wider(T.IntegerType(), T.DecimalType(5, 2)) == T.DecimalType(12, 2) and wider(T.DecimalType(38, 10), T.DecimalType(20, 18)) == T.DoubleType()
    assert wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType() and wider(T.StringType(), T.IntegerType()) is None


def test_any_order_of_batches_gives_one_schema(spark):
    batches = [T.StructType.fromDDL(d) for d in ("id int, note string, n int", "ID bigint, Extra date, N decimal(5,2)", "Id int, NOTE int, extra timestamp_ntz", "n double")]
    found = set()
    for k, order in enumerate(list(itertools.permutations(range(4)))[::7]):
        name = f"r_{uuid.uuid4().hex}"
        for i in order:
            for _ in range(2):
                schema_register.note_schema(spark, name, batches[i], f"b{i}")
        schema, conflicts = schema_register.registered(spark, name)
        found.add((schema.simpleString(), str(conflicts)))
        publish.drop(spark, name)
    ((text, told),) = found
    assert "ID:bigint" in text and "Extra:timestamp_ntz" in text and "N:double" in text and "NOTE:string" in text and told == "{'NOTE': ['int', 'string']}"


def test_fitted_rows(spark, name):
    assert schema_register.registered(spark, name) == (T.StructType([]), {})
    schema_register.note_schema(spark, name, T.StructType.fromDDL("id int, note string"), "a")
    schema_register.note_schema(spark, name, T.StructType.fromDDL("ID decimal(3,1), more date"), "b")
    schema, _ = schema_register.registered(spark, name)
    assert values(schema_register.fitted(frame(spark, "Note string, id int", ("x", 1)), schema)) == [(1, None, "x")]
    with pytest.raises(ValueError, match="not registered"):
        schema_register.fitted(frame(spark, "other int", (1,)), schema)
    with pytest.raises(ValueError, match="only in case"):
        schema_register.note_schema(spark, name, T.StructType.fromDDL("a int, A int"), "c")
    with settings(spark, spark__sql__caseSensitive="true"):
        schema_register.note_schema(spark, name, T.StructType.fromDDL("a int, A int"), "d")


def test_counting_by_difference_reads_no_table(spark, name):
    rows = frame(spark, ROW, (1, "a", at(1, 1), None))
    counters.note_changes(name, "A", "r", added=[rows])
    plan = plan_of(counters.counted_months(spark, name, date(2024, 1, 10)))
    assert plan.count("Scan parquet") == 2 and f"{name}" in plan  # once in the tree, once among its details
