"""Mart refresh: replace, accumulate, accumulate by month; monthly roll; snapshot append."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import month_label, on_day
from quayside.operators.dedup import purge_superseded_batches
from quayside.operators.schema import STAMP
from quayside.operators.upsert import delete_older, delete_where

# The accumulate flags of the job catalog. Any other flag means replace.
MODES = {"O": "accumulate", "OO": "accumulate_month"}
DAILY_SUFFIX = "_1D"
MONTHLY_SUFFIX = "_M"


class MartRefresh(NamedTuple):
    table: DataFrame
    history: DataFrame | None


def mode_of(flag: str | None) -> str:
    return MODES.get(flag, "replace")


def history_name(job: str, mode: str) -> str:
    """The table a refresh accumulates into."""
    if not job.endswith(DAILY_SUFFIX):
        return job
    return job.removesuffix(DAILY_SUFFIX) + (MONTHLY_SUFFIX if mode == "accumulate_month" else "")


def refresh_mart(
    snapshot: DataFrame,
    history: DataFrame | None = None,
    mode: str = "replace",
    as_of: date | None = None,
    loaded: str = "ADATETIME",
    month: str = "CHECK_MONTH",
) -> MartRefresh:
    """A mart's table and history after a refresh from its view's rows.

    ``replace`` makes the snapshot the table. ``accumulate`` also adds it to the history.
    ``accumulate_month`` first removes yesterday's rows of this month from the history. Pass
    the rows as read back from the written table, so the view is evaluated once.
    """
    if mode == "replace":
        return MartRefresh(snapshot, history)
    if history is None:
        raise ValueError(f"{mode} needs a history")
    if mode == "accumulate_month":
        if as_of is None:
            raise ValueError("accumulate_month needs as_of")
        same_month = F.substring(F.col(month), 1, 7) == as_of.strftime("%Y-%m")
        history = delete_where(history, on_day(F.col(loaded), as_of - timedelta(days=1)) & same_month)
    elif mode != "accumulate":
        raise ValueError(f"unknown mode {mode}")
    return MartRefresh(snapshot, history.unionByName(snapshot))


class MonthlyRoll(NamedTuple):
    monthly: DataFrame
    accumulated: DataFrame


def monthly_roll(
    daily: DataFrame,
    monthly: DataFrame,
    accumulated: DataFrame,
    as_of: date,
    day: str = "CHECK_DATE",
    month: str = "CHECK_MONTH",
) -> MonthlyRoll:
    """Add the daily rows to the monthly table under the month before their date, and drop
    rows before yesterday from the accumulated table."""
    rolled = daily.withColumn(month, month_label(F.add_months(F.col(day), -1))).drop(day)
    return MonthlyRoll(
        monthly.unionByName(rolled), delete_older(accumulated, day, as_of - timedelta(days=1))
    )


class SnapshotAppend(NamedTuple):
    daily: DataFrame
    monthly: DataFrame


def append_snapshot(
    monthly: DataFrame, snapshot: DataFrame, keys: Sequence[str], as_of: date, stamp: str = STAMP
) -> SnapshotAppend:
    """Make a cleaned snapshot the daily table, add it to the monthly table and purge the
    batches it supersedes there. Snapshot rows stamped before today are dropped."""
    missing = [c for c in [*keys, stamp] if c not in snapshot.columns or c not in monthly.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    daily = delete_older(snapshot, stamp, as_of)
    return SnapshotAppend(daily, purge_superseded_batches(monthly.unionByName(daily), keys, stamp))


