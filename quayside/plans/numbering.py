"""Row numbers over a whole table without moving it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.plans.settle import settle

_POSITION_MASK = (1 << 33) - 1  # the part of monotonically_increasing_id that counts within a task


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "num") -> DataFrame:
    """Number rows 1..n in ``order``.

    The sort spreads the rows over range partitions. Each task numbers its own rows, and the
    rows in the partitions before it are added. Rows equal in all order columns are told apart
    by their place in the input, so that the sort can spread them too; give enough columns to
    make the order total if their numbers matter.
    """
    placed = settle(
        df.withColumn("_input", F.monotonically_increasing_id())
        .orderBy(*order, "_input")
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)))
        .drop("_input"),
        "numbered",
    )
    # One row per task, so this window is as small as the task list.
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.select(
        "_task",
        (F.sum("_rows").over(Window.orderBy("_task")) - F.col("_rows")).alias("_before"),
    )
    numbered = placed.join(F.broadcast(before), "_task")
    return numbered.select(
        (F.col("_before") + F.col("_place") + 1).cast("bigint").alias(name),
        *[F.col(f"`{c}`") for c in df.columns],
    )
