"""Micro-batch form of the hourly load.

The stream only collects: each micro-batch overwrites its own partition of a landing table, so
a batch that Spark repeats after a failure lands once. When all waiting files are landed, one
load brings the landed rows into the target. The target is thus rewritten
once per run and not once per micro-batch, and the window delete sees the whole window.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.conditions import as_condition
from quayside.operators.schema import STAMP, named_like
from quayside.operators.upsert import UPDATED, apply_batch, stamped
from quayside.plans.settle import settle
from quayside.sources.sinks import replace_partitions

BATCH = "_batch_id"


def landing_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def land_stream(
    changes: DataFrame, landing: str, checkpoint: str, source_pred: str | Column | None = None
) -> None:
    """Land all waiting rows of a streaming frame, one partition per micro-batch."""
    wanted = changes if source_pred is None else changes.where(as_condition(source_pred))

    def land(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")), landing, [BATCH])

    # A run without changes lands an empty table.
    empty = changes.sparkSession.createDataFrame([], landing_schema(changes.schema))
    empty.write.mode("append").partitionBy(BATCH).parquet(landing)
    query = (
        wanted.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed_rows(
    spark: SparkSession, landing: str, schema: T.StructType, keys: Sequence[str], updated: str = UPDATED
) -> DataFrame:
    """The landed rows as one batch: a micro-batch that updates a key replaces the earlier rows of that key."""
    rows = spark.read.schema(landing_schema(schema)).parquet(landing)
    if updated in rows.columns and keys:
        updates = rows.where(F.col(updated).isNotNull())
        last = settle(updates.groupBy(*keys).agg(F.max(BATCH).alias("_last")), "last-updates")
        replaced = F.col(f"r.{BATCH}") < F.col("l._last")
        for key in keys:
            replaced = replaced & (F.col(f"r.{key}") == F.col(f"l.{key}"))
        rows = rows.alias("r").join(last.alias("l"), replaced, "left_anti")
    return rows.drop(BATCH)


def micro_batch_upsert(
    changes: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    source_pred: str | Column,
    target_pred: str | Column,
    run_ts: datetime,
    landing: str,
    checkpoint: str,
    **options,
) -> DataFrame:
    """The target after all waiting rows of the stream are loaded.

    ``landing`` belongs to one run: the next run takes a new folder and the same ``checkpoint``.
    A run that failed after landing is repeated with its own folder, whose rows are then loaded.
    """
    land_stream(changes, landing, checkpoint, source_pred)
    # The landed rows are stored already, so they are loaded as they are and the folder has to stay while the result is read.
    batch = named_like(landed_rows(target.sparkSession, landing, changes.schema, keys), target.columns)
    return apply_batch(target, stamped(batch, run_ts, options.pop("stamp", STAMP), target), keys, target_pred, **options)
