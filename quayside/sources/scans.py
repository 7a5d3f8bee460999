"""Scans: by predicate, by key columns, by year, of a procedure's result."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.conditions import as_condition
from quayside.functions.dates import in_days
from quayside.operators.schema import folded


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_where(df: DataFrame, predicate: str | Column) -> DataFrame:
    """The rows for which a catalog predicate is TRUE."""
    return df.where(as_condition(predicate))


def scan_keys(df: DataFrame, keys: Sequence[str], moment: str, start: date, end: date) -> DataFrame:
    """Only the key columns of the rows dated from ``start`` up to, not including, ``end``."""
    return df.where(in_days(F.col(moment), start, end)).select(*keys)


def has_column(df: DataFrame, name: str) -> bool:
    """Whether the frame has the column, as the session compares names."""
    fold = folded(df.sparkSession)
    return fold(name) in map(fold, df.columns)


def named_result(df: DataFrame, names: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """Name a procedure's unnamed result columns by position and keep some of them."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    named = df.toDF(*names)
    return named.select(*[f"`{c}`" for c in keep]) if keep else named


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
