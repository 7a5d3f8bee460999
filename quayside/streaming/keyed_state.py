"""The hourly load from a stream with state: the newest version of each key, whatever order changes arrive in.

``micro_batch`` lets a later micro-batch replace an earlier one, so it trusts the order of arrival. Here the stream keeps
the newest version of each key as state, by the time of its last change: late, repeated and overtaken rows change
nothing. A version that became the newest lands in the partition of its micro-batch; equal ones may land again.

State is kept for ``span`` of arrival time and ``delay`` beyond it, then the watermark lets it go. The watermark
follows arrival and not the time of change, so no row is ever too late to be taken. What state no longer knows is
settled when the landed rows are loaded: of each key the newest landed version counts, and it counts only if the
target does not hold a newer one. A run that stops goes on from its checkpoint.

Everything is built-in aggregation; the state store is the session's. ``spark.sql.shuffle.partitions`` is fixed by
the first run of a checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.conditions import as_condition, is_true
from quayside.operators.schema import STAMP, evolve
from quayside.operators.upsert import CREATED, UPDATED, stamped
from quayside.plans.settle import settle
from quayside.sources.sinks import replace_partitions
from quayside.streaming.micro_batch import BATCH, landing_schema

ARRIVAL, SPAN = "_arrival", "_span"


def version(created: str = CREATED, updated: str = UPDATED) -> Column:
    """What versions of a key are ordered by: the time of the last change, an update before a creation at the same time."""
    return F.struct(F.coalesce(F.col(updated), F.col(created)).alias("at"), F.col(updated).isNotNull().alias("updated"))


def _newest(columns: Sequence[str], order: Column) -> Column:
    """The row of the newest version; of equal versions with other values the one with the larger hash."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    return F.max_by(row, F.struct(order, F.xxhash64(*[F.col(f"`{c}`") for c in columns])))


def land_newest(
    changes: DataFrame,
    keys: Sequence[str],
    landing: str,
    checkpoint: str,
    source_pred: str | Column | None = None,
    order: Column | None = None,
    span: str = "1 day",
    delay: str = "1 hour",
) -> None:
    """Take all waiting rows of a streaming frame and land the versions that are newest in the state."""
    order = version() if order is None else order
    wanted = changes if source_pred is None else changes.where(as_condition(source_pred))
    arrived = wanted.withColumn(ARRIVAL, F.current_timestamp()).withWatermark(ARRIVAL, delay)
    kept = arrived.groupBy(F.window(ARRIVAL, span).alias(SPAN), *[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)])
    newest = kept.agg(_newest(changes.columns, order).alias("_row")).select("_row.*")

    def land(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")), landing, [BATCH])

    empty = changes.sparkSession.createDataFrame([], landing_schema(changes.schema))
    empty.write.mode("append").partitionBy(BATCH).parquet(landing)
    query = (
        newest.writeStream.outputMode("update")
        .foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed_newest(spark: SparkSession, landing: str, schema: T.StructType, keys: Sequence[str], order: Column | None = None) -> DataFrame:
    """The newest landed version of each key."""
    rows = spark.read.schema(landing_schema(schema)).parquet(landing).drop(BATCH)
    named = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    return rows.groupBy(*named).agg(_newest(rows.columns, version() if order is None else order).alias("_row")).select("_row.*")


def newer_than_target(batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Column | None = None) -> DataFrame:
    """The batch without rows that the target holds in a newer version. Of the target key and time columns are read."""
    order = version() if order is None else order
    named = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    known = target.select(*named, order.alias("_known"))
    asked = batch.withColumns({"_version": order, **{f"_key{i}": F.col(f"`{k}`") for i, k in enumerate(keys)}})
    newer = F.col("_known") > F.col("_version")
    for i in range(len(keys)):
        newer = newer & (asked[f"_key{i}"] == known[f"_key{i}"])
    return asked.join(known, newer, "left_anti").select(*[f"`{c}`" for c in batch.columns])


def load_newest(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    run_ts: datetime,
    target_pred: str | Column | None = None,
    order: Column | None = None,
    stamp: str = STAMP,
) -> DataFrame:
    """The target after the newest versions of a stream are loaded: a version replaces all older rows of its key.

    ``target_pred`` names rows that go whether the stream has them or not, as in the hourly load. The first run of a window
    passes it, and runs that continue the window do not, as they would remove what the first one loaded.
    """
    batch = settle(stamped(batch, run_ts, stamp, target), "batch", compact=True)
    target, batch = evolve(target, batch)
    kept = target if target_pred is None else target.where(~is_true(target_pred))
    fresh = settle(newer_than_target(batch, kept, keys, order), "fresh", compact=True)
    replaced = fresh.select(*[f"`{k}`" for k in keys])
    left = kept.join(replaced, list(keys), "left_anti").select(*[f"`{c}`" for c in kept.columns])
    return left.unionByName(fresh)


def stateful_upsert(
    changes: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    source_pred: str | Column | None,
    run_ts: datetime,
    landing: str,
    checkpoint: str,
    target_pred: str | Column | None = None,
    order: Column | None = None,
    span: str = "1 day",
    delay: str = "1 hour",
) -> DataFrame:
    """The target after all waiting rows of the stream are taken.

    ``landing`` belongs to one run; the next one takes a new folder and the same ``checkpoint``. The result is that of
    ``incremental_upsert(strict=True)`` with the newest version of each key, however the rows are dealt to files,
    micro-batches and runs, and in whatever order, if ``target_pred`` is passed by the first run only.
    """
    land_newest(changes, keys, landing, checkpoint, source_pred, order, span, delay)
    batch = landed_newest(target.sparkSession, landing, changes.schema, keys, order)
    return load_newest(target, batch, keys, run_ts, target_pred, order)
