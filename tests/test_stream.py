from datetime import datetime

from helpers import TS, frame, values

from quayside.operators.upsert import load_window, stamped
from quayside.sources import sinks
from quayside.streaming import micro_batch

SCHEMA = "k bigint, v string, RDATETIME timestamp_ntz, UDATETIME timestamp_ntz"
OLD, NOW, LATER = datetime(2024, 1, 1), datetime(2024, 1, 9, 8), datetime(2024, 1, 9, 9)
IN = "RDATETIME >= timestamp_ntz'2024-01-09' OR UDATETIME >= timestamp_ntz'2024-01-09'"
TARGET_IN = "RDATETIME >= timestamp_ntz'2024-01-09'"
FILES = [
    [(1, "first", OLD, NOW), (2, "new", NOW, None), (9, "outside", OLD, None)],
    [(1, "second", OLD, LATER), (3, "new", NOW, None)],
]


def target(spark):
    return stamped(frame(spark, SCHEMA, (1, "old", OLD, None), (2, "old", NOW, None), (4, "gone", NOW, None), (5, "kept", OLD, None)), OLD)


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(path)


def write(spark, path, rows):
    frame(spark, SCHEMA, *rows).coalesce(1).write.mode("append").parquet(path)


def test_later_micro_batch_replaces_the_earlier(spark, tmp_path):
    source = str(tmp_path / "in")
    where = dict(landing=str(tmp_path / "landing"), checkpoint=str(tmp_path / "checkpoint"))
    for rows in FILES:
        write(spark, source, rows)
        loaded = micro_batch.micro_batch_upsert(stream(spark, source), target(spark), ["k"], IN, TARGET_IN, TS, **where)
    assert values(loaded, "k", "v") == [(1, "second"), (2, "new"), (3, "new"), (5, "kept")]


def test_next_run_loads_only_new_rows(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    write(spark, source, FILES[0])
    first = micro_batch.micro_batch_upsert(
        stream(spark, source), target(spark), ["k"], IN, TARGET_IN, TS, landing=str(tmp_path / "run1"), checkpoint=checkpoint
    )
    write(spark, source, [(6, "next hour", datetime(2024, 1, 9, 10), None)])
    next_hour = "RDATETIME >= timestamp_ntz'2024-01-09 10:00:00'"
    second = micro_batch.micro_batch_upsert(
        stream(spark, source), first, ["k"], next_hour, next_hour, TS, landing=str(tmp_path / "run2"), checkpoint=checkpoint
    )
    assert values(second, "k", "v") == [(1, "first"), (2, "new"), (5, "kept"), (6, "next hour")]
    quiet = micro_batch.micro_batch_upsert(
        stream(spark, source), second, ["k"], next_hour, next_hour, TS, landing=str(tmp_path / "run3"), checkpoint=checkpoint
    )
    assert values(quiet) == values(second)


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    write(spark, source, FILES[0])
    write(spark, source, FILES[1][1:])
    streamed = micro_batch.micro_batch_upsert(
        stream(spark, source), target(spark), ["k"], IN, TARGET_IN, TS,
        landing=str(tmp_path / "landing"), checkpoint=str(tmp_path / "checkpoint"),
    )
    loaded = load_window(spark.read.schema(SCHEMA).parquet(source), target(spark), ["k"], IN, TS, target_pred=TARGET_IN)
    assert values(streamed) == values(loaded)


def test_repeated_micro_batch_lands_once(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for rows in (FILES[0], FILES[0]):
        sinks.replace_partitions(frame(spark, SCHEMA, *rows).selectExpr("*", "0L AS _batch_id"), landing, ["_batch_id"], balance=False)
    landed = micro_batch.landed_rows(spark, landing, target(spark).drop("MIG_DATETIME").schema, ["k"])
    assert values(landed, "k") == [(1,), (2,), (9,)]
