"""Stored tables by month: created, filled with history, and loaded so that only changed months are rewritten."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.conditions import is_true
from quayside.functions.dates import month_label, ntz
from quayside.operators.history import YEAR, historical_load
from quayside.operators.schema import STAMP, named_like, struct_of, trimmed
from quayside.operators.upsert import CREATED, UPDATED, apply_batch, stamped, touched_partitions
from quayside.plans.settle import settle
from quayside.sources.scans import table_exists
from quayside.sources.sinks import add_columns, append_table, create_table, replace_table_partitions

PARTITION = "LOAD_MONTH"
UNDATED = "undated"


def by_month(rows: DataFrame, moment: str = CREATED, keys: Sequence[str] = (), undated_parts: int = 1) -> DataFrame:
    """Rows with the partition they belong to: their month of creation.

    Rows without a date are one partition, or with ``keys`` as many as ``undated_parts``, by the key's hash, so that a load
    into a table without dates rewrites the parts of its keys and not the whole table. Which part a row is in says
    nothing else: a table may be loaded with another number of parts than it was created with.
    """
    undated = F.lit(UNDATED)
    if keys and undated_parts > 1:
        part = F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(undated_parts))
        undated = F.concat(F.lit(f"{UNDATED}-"), part.cast("string"))
    if moment not in rows.columns:
        return rows.withColumn(PARTITION, undated)
    return rows.withColumn(PARTITION, F.coalesce(month_label(F.trunc(moment, "month")), undated))


def create_by_month(
    rows: DataFrame, name: str, moment: str = CREATED, path: str | None = None, keys: Sequence[str] = (), undated_parts: int = 1
) -> None:
    """Store rows as a catalog table partitioned by month of creation."""
    create_table(by_month(rows, moment, keys, undated_parts), name, PARTITION, path)


def create_from_catalog(
    derived: DataFrame, table: str, name: str, moment: str = CREATED, path: str | None = None
) -> list[str]:
    """An empty table with the columns that ``derive_schema`` gives for ``table``; returns its key columns."""
    struct, keys = struct_of(derived, table)
    create_by_month(derived.sparkSession.createDataFrame([], struct), name, moment, path)
    return keys


def load_history(
    source: DataFrame,
    name: str,
    first: int,
    last: int,
    run_ts: datetime,
    moment: str = CREATED,
    path: str | None = None,
    trim: bool = False,
) -> DataFrame:
    """Append the years ``first`` to ``last`` of a source to a table, which is created if absent.

    A load that is repeated, as it failed or was not known to have ended, has the same load time: rows of its months
    that carry it are replaced, so no row is there twice. ``trim`` takes the padding off text columns.
    """
    spark = source.sparkSession
    rows = by_month(historical_load(trimmed(source) if trim else source, first, last, run_ts, moment).drop(YEAR), moment)
    if not table_exists(spark, name) or STAMP not in spark.table(name).columns:
        append_table(rows, name, PARTITION, path)
        return spark.table(name)
    target = spark.table(name)
    rows = settle(stamped(named_like(rows, target.columns), run_ts, like=target), "history")
    months = [row[0] for row in rows.select(PARTITION).distinct().collect()]  # table layout
    inside = target.where(F.col(PARTITION).isin(months))
    earlier = F.col(STAMP) == ntz(run_ts).cast(target.schema[STAMP].dataType)
    if inside.where(earlier).isEmpty():
        append_table(rows, name, PARTITION, path)
    else:
        add_columns(rows, name)
        kept = spark.table(name).where(F.col(PARTITION).isin(months) & ~is_true(earlier))
        replace_table_partitions(kept.unionByName(rows, allowMissingColumns=True), name, PARTITION, rows.select(PARTITION).limit(0))
    return spark.table(name)


def load_table(
    name: str,
    batch: DataFrame,
    keys: Sequence[str],
    target_pred: str | Column,
    run_ts: datetime,
    moment: str = CREATED,
    updated: str = UPDATED,
    strict: bool = False,
    trim: bool = False,
    undated_parts: int = 1,
) -> DataFrame:
    """``incremental_upsert`` into a table made by ``create_by_month``; returns the table.

    New columns of the batch are added to the table first. Which months change is found from the
    key and date columns alone. Whole rows are read and written only for these months, once; months
    that lose rows and get none are asked whether any are left.
    """
    spark = batch.sparkSession
    target = spark.table(name)
    batch = trimmed(batch) if trim else batch
    batch = settle(stamped(by_month(named_like(batch, target.columns), moment, keys, undated_parts), run_ts, like=target), "batch", compact=True)
    if batch.isEmpty():
        return target
    add_columns(batch, name)
    target = spark.table(name)
    rule = {"updated": updated, "strict": strict}
    touched = settle(
        touched_partitions(target, batch, keys, target_pred, F.col(PARTITION), PARTITION, **rule), "touched"
    )
    # The list of changed partitions is table layout, so it may come to the driver.
    months = [row[PARTITION] for row in touched.collect()]
    changed = target.where(F.col(PARTITION).isin(months))
    loaded = apply_batch(changed, batch, keys, target_pred, **rule)
    # A month that the batch has rows for cannot become empty.
    suspects = touched.join(batch.select(PARTITION).distinct(), [PARTITION], "left_anti")
    replace_table_partitions(loaded, name, PARTITION, suspects)
    return spark.table(name)
