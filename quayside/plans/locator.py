"""Where the rows of a key are: a stored map from keys to months, kept up by each load.

A daily load has to find the months that hold an older row of a replaced key, and the months with rows of the
window. Without help it reads the key and date columns of the whole table every day. Two small tables beside the
table spare that:

* ``<table>__keys``: each key and month once, in buckets by the key's hash, sorted by key. Only the buckets of the
  batch's keys are read and written.
* ``<table>__zones``: the first and last creation and update time of each month. Only months whose times can meet
  the window are asked which of their rows do.

Both are published under the run's name after the table is written. What a run will change, months and keys, is noted
before it writes, so a run that failed in between is repeated under its name; until then other runs are refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.conditions import is_true
from quayside.functions.dates import in_days, ntz
from quayside.operators.schema import evolve, named_like, typed_like
from quayside.operators.upsert import CREATED, UPDATED, apply_batch, replaced_keys, stamped
from quayside.plans.publish import Journal, folder_of, publish_parts, publish_table
from quayside.plans.publish import drop as drop_published
from quayside.plans.settle import settle
from quayside.plans.table_load import PARTITION, by_month
from quayside.sources.sinks import add_columns, replace_table_partitions

BUCKET = "KEY_BUCKET"
BUCKETS = 64
STARTED, LOADED, DONE = "started", "loaded", "done"


class Window(NamedTuple):
    """Rows created or updated from ``start`` up to, not including, ``end``."""

    start: date
    end: date
    moments: tuple[str, ...] = (CREATED, UPDATED)

    def condition(self) -> Column:
        return reduce(lambda a, b: a | b, [in_days(F.col(m), self.start, self.end) for m in self.moments])


def _keys_table(name: str) -> str:
    return f"{name}__keys"


def _zones_table(name: str) -> str:
    return f"{name}__zones"


def _journal(spark: SparkSession, name: str, place: str | None) -> Journal:
    return Journal(spark, folder_of(spark, _keys_table(name), place) + "__loads")


def _settings(spark: SparkSession, name: str, place: str | None) -> dict:
    told = _journal(spark, name, place).told("settings", DONE)
    if told is None:
        raise ValueError(f"{name} has no locator: create one")
    return told


def _bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int"))


def _numbers(rows: DataFrame) -> list[int]:
    """The buckets of some keys: at most as many as there are, so they may come to the driver."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def _zones(table: DataFrame, moments: Sequence[str]) -> DataFrame:
    """First and last time of each column in each month."""
    ends = [f(F.col(m).cast("timestamp_ntz")).alias(f"{m}_{n}") for m in moments for f, n in ((F.min, "first"), (F.max, "last"))]
    return table.groupBy(PARTITION).agg(*ends)


def create_locator(
    spark: SparkSession, name: str, keys: Sequence[str], moments: Sequence[str] = (CREATED, UPDATED), buckets: int = BUCKETS, place: str | None = None
) -> None:
    """Map the keys of a table made by ``create_by_month``. Reads its key and date columns once."""
    table, run = spark.table(name), f"created-{uuid.uuid4().hex}"
    moments = [m for m in moments if m in table.columns]
    entries = _bucketed(table.select(*keys, PARTITION).distinct(), keys, buckets)
    journal = _journal(spark, name, place)
    journal.note("settings", DONE, keys=list(keys), buckets=buckets, moments=moments)
    publish_parts(spark, lambda old: (entries, [(n,) for n in range(buckets)]), _keys_table(name), [BUCKET], run, place, order=keys)
    publish_table(_zones(table, moments), _zones_table(name), run, place)


def drop_locator(spark: SparkSession, name: str, place: str | None = None) -> None:
    for table in (_keys_table(name), _zones_table(name)):
        drop_published(spark, table, place)
    journal = _journal(spark, name, place)
    for run in [*journal.runs(STARTED), "settings"]:
        journal.forget(run)


def key_months(spark: SparkSession, name: str, wanted: DataFrame, place: str | None = None) -> DataFrame:
    """The months that hold rows of ``wanted`` keys. Only the buckets of these keys are read."""
    told = _settings(spark, name, place)
    entries = spark.table(_keys_table(name))
    asked = settle(_bucketed(typed_like(wanted, entries).select(*told["keys"]).distinct(), told["keys"], told["buckets"]), "asked", compact=True)
    found = entries.where(F.col(BUCKET).isin(_numbers(asked))).join(asked, [BUCKET, *told["keys"]], "left_semi")
    return found.select(PARTITION).distinct()


def window_months(spark: SparkSession, name: str, window: Window, place: str | None = None) -> DataFrame:
    """The months that hold rows of the window. Only months whose first and last times allow it are read."""
    zones = spark.table(_zones_table(name))
    moments = [m for m in window.moments if f"{m}_first" in zones.columns]
    if not moments:
        raise ValueError(f"the locator of {name} knows none of {window.moments}")
    meets = [(F.col(f"{m}_last") >= ntz(window.start)) & (F.col(f"{m}_first") < ntz(window.end)) for m in moments]
    candidates = [r[0] for r in zones.where(is_true(reduce(lambda a, b: a | b, meets))).select(PARTITION).collect()]  # table layout
    rows = spark.table(name).where(F.col(PARTITION).isin(candidates) & is_true(window.condition()))
    return rows.select(PARTITION).distinct()


def _locate_again(spark: SparkSession, name: str, changed_keys: DataFrame, months: Sequence[str], run: str, place: str | None) -> None:
    """Map the changed keys of the months just written, in their buckets."""
    told = _settings(spark, name, place)
    keys, buckets = told["keys"], told["buckets"]
    table = spark.table(name).where(F.col(PARTITION).isin(list(months)))

    def changed(entries: DataFrame) -> tuple[DataFrame, list[tuple[int]]]:
        numbers = _numbers(_bucketed(typed_like(changed_keys, entries), keys, buckets))
        now = _bucketed(typed_like(table.select(*keys, PARTITION), entries), keys, buckets)
        inside = F.col(BUCKET).isin(numbers)
        kept = entries.where(inside & ~F.col(PARTITION).isin(list(months)))
        return kept.unionByName(now.where(inside).distinct()), [(n,) for n in numbers]

    publish_parts(spark, changed, _keys_table(name), [BUCKET], run, place, order=keys)
    zones = spark.table(_zones_table(name)).where(~F.col(PARTITION).isin(list(months)))
    publish_table(lambda: zones.unionByName(_zones(table, told["moments"])), _zones_table(name), run, place)


def load_located(
    name: str,
    batch: DataFrame,
    window: Window,
    run_ts: datetime,
    run: str | None = None,
    updated: str = UPDATED,
    strict: bool = False,
    place: str | None = None,
) -> DataFrame:
    """``load_table`` by the table's locator, which is kept up; returns the table.

    Of the table only the months that change are read, and those whose times can meet the window; of the locator only the
    buckets of the batch's keys. A ``run`` that failed is repeated under its name; before, other runs are an error.
    """
    spark = batch.sparkSession
    told, journal = _settings(spark, name, place), _journal(spark, name, place)
    run = run or uuid.uuid4().hex
    open_ = [r for r in journal.runs(STARTED) if r != run and journal.told(r, DONE) is None]
    if open_:
        raise ValueError(f"{name}: repeat the run {open_[0]} first")
    if journal.told(run, DONE) is not None:
        return spark.table(name)
    keys, table = told["keys"], spark.table(name)
    batch = settle(stamped(by_month(named_like(batch, table.columns)), run_ts, like=table), "batch", compact=True)
    if batch.isEmpty():
        return table
    evolve(table, batch)  # types that differ end the run before it begins
    add_columns(batch, name)
    table, gone_path = spark.table(name), f"{journal.folder}/{run}/keys"
    begun = journal.told(run, STARTED)
    if begun is None:
        found = batch.select(PARTITION).unionByName(window_months(spark, name, window, place))
        replaced = replaced_keys(batch, keys, updated, strict)
        if replaced is not None:
            found = found.unionByName(key_months(spark, name, replaced, place))
        months = sorted(r[0] for r in found.distinct().collect())  # table layout
        # Keys whose rows go, kept with the journal: once the table is written they can no longer be told.
        removed = table.where(F.col(PARTITION).isin(months) & is_true(window.condition())).select(*keys)
        batch.select(*keys).unionByName(removed).distinct().hint("rebalance").write.mode("overwrite").parquet(gone_path)
        begun = {"months": months}
        journal.note(run, STARTED, **begun)
    months = begun["months"]
    if journal.told(run, LOADED) is None:
        loaded = apply_batch(table.where(F.col(PARTITION).isin(months)), batch, keys, window.condition(), updated, strict)
        filled = {r[0] for r in batch.select(PARTITION).distinct().collect()}
        suspects = spark.createDataFrame([(m,) for m in months if m not in filled], f"{PARTITION} string")
        replace_table_partitions(loaded, name, PARTITION, suspects)
        journal.note(run, LOADED)
    _locate_again(spark, name, spark.read.parquet(gone_path), months, run, place)
    journal.note(run, DONE)
    return spark.table(name)
