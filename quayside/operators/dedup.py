"""Removal of duplicate keys and of superseded load batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.schema import STAMP
from quayside.operators.upsert import delete_keys
from quayside.plans.settle import settle


def keep_latest(
    df: DataFrame, keys: Sequence[str], stamp: str = STAMP, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the newest. A row without a stamp counts as newest.

    Only the first row per key is asked for, so each task drops its older copies before the
    shuffle and a key with very many copies costs one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(
        F.col(stamp).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in tie_breakers]
    )
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def superseded_stamps(df: DataFrame, keys: Sequence[str], stamp: str = STAMP) -> DataFrame:
    """The load times of all rows that are not the single newest row of their key.

    No shuffle holds a key's copies together: copies are first counted per key and load time,
    the newest load time per key is a plain maximum, and the two meet on key and load time.
    """
    # As one struct, missing key parts are equal to each other, as they are when rows are ranked
    # per key, and the counts need no second shuffle to meet the newest copies.
    return superseded_of_copies(copies_of(df, keys, stamp), stamp)


def copies_of(df: DataFrame, keys: Sequence[str], stamp: str = STAMP) -> DataFrame:
    """How many rows each key (as one struct, ``_key``) has at each load time."""
    return df.groupBy(F.struct(*keys).alias("_key"), stamp).agg(F.count(F.lit(1)).alias("_copies"))


def superseded_of_copies(copies: DataFrame, stamp: str = STAMP) -> DataFrame:
    """``superseded_stamps`` of counted copies: one row per ``_key`` and load time."""
    newest = copies.groupBy("_key").agg(
        F.max(stamp).alias(stamp),
        F.sum("_copies").alias("_all_copies"),
        F.max(F.col(stamp).isNull()).alias("_has_unstamped"),
    )
    # A row without a stamp is the newest of its key, so every stamped copy of that key is superseded.
    newest = newest.where(~F.col("_has_unstamped")).drop("_has_unstamped")
    matched = copies.join(newest, ["_key", stamp], "left")
    superseded = F.col("_all_copies").isNull() | (F.col("_copies") > 1)
    return matched.where(superseded).select(stamp).distinct()


def purge_superseded_batches(df: DataFrame, keys: Sequence[str], stamp: str = STAMP) -> DataFrame:
    """Remove every row loaded at a time at which any superseded row was loaded.

    This removes whole batches, also rows of other keys: the right tool where a load replaces a
    whole snapshot. Two copies of a key within one batch remove that batch. Rows without a stamp stay.
    """
    stale = settle(superseded_stamps(df, keys, stamp), "stale-stamps")
    return delete_keys(df, stale)
