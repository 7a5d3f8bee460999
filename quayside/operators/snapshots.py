"""Cleaning of a period snapshot before it is stored."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.conditions import all_zero
from quayside.operators.schema import STAMP
from quayside.operators.upsert import stamped


def clean_snapshot(
    snapshot: DataFrame,
    zero_columns: Sequence[str],
    start: date,
    end: date,
    run_ts: datetime,
    stamp: str = STAMP,
) -> DataFrame:
    """Drop rows in which all ``zero_columns`` are 0 and add the period and the load time.

    A NULL is not 0, so a row with a NULL among them stays.
    """
    missing = [c for c in zero_columns if c not in snapshot.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    period = snapshot.where(~all_zero(zero_columns)).withColumns(
        {"START_DATE": F.lit(start.isoformat()), "END_DATE": F.lit(end.isoformat())}
    )
    return stamped(period, run_ts, stamp)
