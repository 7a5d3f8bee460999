"""Stored marts: rebuilt from their view, and added to their history, by runs that may be repeated."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import on_day
from quayside.operators.marts import MartRefresh, history_name, mode_of
from quayside.operators.upsert import delete_where
from quayside.plans.publish import publish_parts, publish_table
from quayside.plans.table_load import UNDATED

PARTITION, RUN = "HISTORY_MONTH", "HISTORY_RUN"
PARTITIONS = [PARTITION, RUN]


def _placed(rows: DataFrame, month: str, run: str) -> DataFrame:
    """Rows with the part they belong to: their month, and the run that adds them."""
    label = F.coalesce(F.substring(F.col(month).cast("string"), 1, 7), F.lit(UNDATED))
    return rows.withColumns({PARTITION: label, RUN: F.lit(run)})


def _parts(rows: DataFrame) -> list[tuple[str, str]]:
    return [tuple(r) for r in rows.select(*PARTITIONS).distinct().collect()]  # table layout, not data


def store_history(rows: DataFrame, name: str, month: str = "CHECK_MONTH", place: str | None = None, run: str = "initial") -> None:
    """Add rows to a history, which is created if it does not exist. It is partitioned by month and run."""
    placed = _placed(rows, month, run)
    publish_parts(rows.sparkSession, lambda _: (placed, _parts(placed)), name, PARTITIONS, run, place)


def refresh_stored(
    view: DataFrame,
    job: str,
    flag: str | None,
    as_of: date,
    loaded: str = "ADATETIME",
    month: str = "CHECK_MONTH",
    run: str | None = None,
    place: str | None = None,
) -> MartRefresh:
    """``refresh_mart`` carried out: the table ``job`` is rebuilt from ``view``, which is evaluated once,
    and as ``flag`` of the catalog says, the stored rows are added to the history the job's name leads to.

    A history that does not exist is created. A run's rows are parts of their own, so adding rewrites nothing. By month,
    parts of this month that hold rows loaded yesterday are written anew without them. Both tables are returned as read
    back. A job that accumulates needs a name that differs from its history's.

    Each table changes in one step (``plans.publish``). A ``run`` that failed is repeated under its name: it goes on where
    it stopped, and rows are never added twice. Without a name each call is a run of its own.
    """
    spark, mode = view.sparkSession, mode_of(flag)
    run = run or uuid.uuid4().hex
    name = history_name(job, mode)
    if mode != "replace" and name == job:
        raise ValueError(f"{job} would be its own history")
    table = publish_table(view, job, run, place)
    if mode == "replace":
        return MartRefresh(table, None)

    def changed(history: DataFrame | None) -> tuple[DataFrame, list[tuple[str, str]]]:
        rows = _placed(table, month, run)
        parts = _parts(rows)
        if mode != "accumulate_month" or history is None:
            return rows, parts
        stale = on_day(F.col(loaded), as_of - timedelta(days=1))
        this_month = history.where(F.col(PARTITION) == as_of.strftime("%Y-%m"))
        touched = _parts(this_month.where(stale))
        kept = delete_where(this_month.where(F.col(RUN).isin([r for _, r in touched])), stale)
        return kept.unionByName(rows, allowMissingColumns=True), [*parts, *touched]

    return MartRefresh(table, publish_parts(spark, changed, name, PARTITIONS, run, place).drop(*PARTITIONS))
