"""The hand-kept catalogs: jobs, load predicates, prerequisites."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans.settle import settle
from quayside.sources.sinks import replace

# The columns of the three catalogs.
JOB_INFO = "JOB_CODE string, AGG_LEVEL string, DEL_YN string, SCHEDULE string, ACCUMULATE string"
JOB_TABLE_INFO = "JOB_CODE string, UPDATE_COL string, UPDATE_COL_RT string, UPDATE_COL_RT_2 string, DEL_YN string"
PRE_JOB_INFO = "JOB_CODE string, PRE_JOB_CODE string, DEL_YN string, SCHEDULE string"


def read_catalog(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A catalog kept as CSV with a header. A header that differs from the schema is an error."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST")


def stamp_catalog(df: DataFrame, run_ts: datetime) -> DataFrame:
    """The rows as they replace the catalog table, with the load date as text."""
    return df.withColumn("UDATETIME", F.lit(run_ts.strftime("%Y-%m-%d")))


def refresh_catalog(spark: SparkSession, kept: str, schema: str, path: str, run_ts: datetime) -> DataFrame:
    """Replace the stored catalog at ``path`` by the CSV at ``kept``; returns the stored rows.

    The CSV is read before anything is replaced: a header or row that does not fit leaves the old catalog.
    """
    rows = settle(stamp_catalog(read_catalog(spark, kept, schema), run_ts), "catalog")
    replace(rows, path)
    return spark.read.parquet(path)
