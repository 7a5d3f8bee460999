"""Loads into raw tables: incremental by window and key, deletes, full refresh.

Parquet has no row-level delete, so each operator returns the table as it is afterwards.
``replace_partitions`` in ``quayside.sources.sinks`` writes back only the partitions that
``touched_partitions`` lists.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.conditions import as_condition, is_true
from quayside.functions.dates import ntz
from quayside.operators.schema import STAMP, evolve, named_like, trimmed
from quayside.plans.settle import settle

UPDATED = "UDATETIME"
CREATED = "RDATETIME"


def delete_where(target: DataFrame, predicate: str | Column) -> DataFrame:
    """Remove the rows for which the predicate is TRUE. UNKNOWN rows stay, as in SQL."""
    return target.where(~is_true(predicate))


def delete_older(target: DataFrame, moment: str, day: date) -> DataFrame:
    """Remove rows dated before ``day``; rows with no date stay."""
    return delete_where(target, F.col(moment) < ntz(day))


def delete_keys(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove the rows whose key occurs in ``keys``, compared column by column."""
    kept = target.join(keys, list(keys.columns), "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in target.columns])


def stamped(df: DataFrame, run_ts: datetime, stamp: str = STAMP, like: DataFrame | None = None) -> DataFrame:
    """All rows of one load carry one load time, in the type it has in the table ``like``."""
    moment = ntz(run_ts)
    if like is not None and stamp in like.columns:
        moment = moment.cast(like.schema[stamp].dataType)
    return df.withColumn(stamp, moment)


def _need_keys(keys: Sequence[str] | None) -> None:
    if keys is None:
        raise ValueError("the table has no key: pass keys=[] to delete by window only")


def replaced_keys(batch: DataFrame, keys: Sequence[str], updated: str, strict: bool) -> DataFrame | None:
    if strict:
        return batch.select(*keys)
    if updated in batch.columns:
        return batch.where(F.col(updated).isNotNull()).select(*keys)
    return None


def incremental_upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] | None,
    target_pred: str | Column,
    run_ts: datetime,
    updated: str = UPDATED,
    stamp: str = STAMP,
    strict: bool = False,
) -> DataFrame:
    """The target after loading ``batch``, the source rows of one window.

    Removed are target rows whose key belongs to an updated batch row, and target rows in the
    window (``target_pred`` TRUE). Then the whole batch is added under one load time. An empty
    batch changes nothing.

    A batch row that was never updated replaces no older copy outside the window; that leaves a
    duplicate for ``keep_latest``. ``strict`` removes by every batch key instead. ``keys=[]``
    asks for the window delete alone; ``None`` is an error.
    """
    _need_keys(keys)
    batch = named_like(batch, target.columns)
    # The source is read once. Later steps see the same rows, and the size of the key list is known.
    batch = settle(stamped(batch, run_ts, stamp, target), "batch", compact=True)
    return apply_batch(target, batch, keys, target_pred, updated, strict)


def apply_batch(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] | None,
    target_pred: str | Column,
    updated: str = UPDATED,
    strict: bool = False,
) -> DataFrame:
    """``incremental_upsert`` of a batch that is already stored and stamped."""
    _need_keys(keys)
    target, batch = evolve(target, batch)
    if batch.isEmpty():
        return target
    kept = delete_where(target, target_pred)
    replaced = replaced_keys(batch, keys, updated, strict) if keys else None
    if replaced is not None:
        kept = delete_keys(kept, replaced)
    return kept.unionByName(batch)


def load_window(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str] | None,
    source_pred: str | Column,
    run_ts: datetime,
    target_pred: str | Column | None = None,
    trim: bool = False,
    **options,
) -> DataFrame:
    """``incremental_upsert`` of the source rows in a window.

    The hourly form has a wider predicate at the source than at the target; the daily form
    uses one for both. ``trim`` takes the padding off the batch's text columns.
    """
    batch = source.where(as_condition(source_pred))
    batch = trimmed(batch) if trim else batch
    return incremental_upsert(
        target, batch, keys, source_pred if target_pred is None else target_pred, run_ts, **options
    )


def touched_partitions(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    target_pred: str | Column,
    partition: Column,
    name: str,
    updated: str = UPDATED,
    strict: bool = False,
) -> DataFrame:
    """The partitions that ``incremental_upsert`` changes, one row each.

    Joining the result to the post-image keeps a daily load from rewriting the whole table.
    """
    replaced = replaced_keys(batch, keys, updated, strict) if keys else None
    hit = as_condition(target_pred)
    if replaced is not None:
        # One scan of the target's key and date columns answers both questions.
        target = target.join(replaced.distinct().withColumn("_hit", F.lit(True)), list(keys), "left")
        hit = hit | F.col("_hit").isNotNull()
    found = target.where(hit).select(partition.alias(name))
    return batch.select(partition.alias(name)).unionByName(found).distinct()


def full_refresh(source: DataFrame, run_ts: datetime, stamp: str = STAMP) -> DataFrame:
    """The table after it is emptied and filled with the whole source."""
    return stamped(source, run_ts, stamp)
