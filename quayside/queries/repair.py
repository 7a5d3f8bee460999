"""Counting, comparing and repairing months; duplicates and superseded batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import dedup, reconcile, upsert
from quayside.plans import batch_index
from quayside.plans.settle import settle
from quayside.queries import fixtures as fx
from quayside.sources.scans import table

JOB = "ORDERS"


def _counts(rows: DataFrame) -> DataFrame:
    return reconcile.monthly_counts({JOB: rows}, fx.AS_OF)


def monthly_counts(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_shipdate", "RDATETIME")
    return reconcile.monthly_counts({JOB: fx.order_source(spark, folder), "LINES": lines}, fx.AS_OF, jobs=[JOB, "LINES"])


def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.reconcile(_counts(fx.order_source(spark, folder)), _counts(fx.order_target(spark, folder)))


def reconcile_counts_full(spark: SparkSession, folder: str) -> DataFrame:
    source, target = fx.order_source(spark, folder), fx.order_target(spark, folder)
    return reconcile.reconcile(_counts(source), _counts(target), how="full")


JOBS = [f"C{i}" for i in range(5)]


def reconcile_counts_by_job(spark: SparkSession, folder: str) -> DataFrame:
    """Five jobs, each with the orders of a fifth of the customers; some of their months differ, others do not."""

    def counts(rows: DataFrame) -> DataFrame:
        tables = {job: rows.where(F.col("o_custkey") % len(JOBS) == i) for i, job in enumerate(JOBS)}
        return reconcile.monthly_counts(tables, fx.AS_OF)

    return reconcile.reconcile(counts(fx.order_source(spark, folder)), counts(fx.order_target(spark, folder)))


def _mismatches(spark: SparkSession, folder: str) -> DataFrame:
    """The stored result of the first pass, so that the repair does not count again."""
    return settle(reconcile.mismatches(reconcile_counts(spark, folder), JOB), "mismatches")


def _repaired(spark: SparkSession, folder: str, months: DataFrame) -> DataFrame:
    return reconcile.delete_orphans(
        fx.order_source(spark, folder), fx.order_target(spark, folder), fx.ORDER_KEYS, months, fx.AS_OF
    )


def orphan_delete(spark: SparkSession, folder: str) -> DataFrame:
    return _repaired(spark, folder, _mismatches(spark, folder))


def orphan_keys(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.orphans(
        fx.order_source(spark, folder),
        fx.order_target(spark, folder),
        fx.ORDER_KEYS,
        _mismatches(spark, folder),
        fx.AS_OF,
    )


def reconcile_second_pass(spark: SparkSession, folder: str) -> DataFrame:
    first_pass = _mismatches(spark, folder)
    repaired = _repaired(spark, folder, first_pass)
    return reconcile.reconcile_second_pass(first_pass, _counts(fx.order_source(spark, folder)), _counts(repaired))


def dedup_targets(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.surplus_jobs(reconcile_counts(spark, folder))


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["l_extendedprice", "l_partkey", "l_suppkey"]


def dedup_keep_latest(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*LINE_KEYS, "l_shipdate", *LINE_TIES)
    return dedup.keep_latest(lines, LINE_KEYS, "l_shipdate", LINE_TIES)


def dedup_purge_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The purge of a stored table, which is read for the stale batches and for the rows that stay."""
    return dedup.purge_superseded_batches(settle(fx.all_loads(spark, folder), "loads"), fx.BATCH_KEYS)


def dedup_purge_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """The same purge after two loads, told by the stored newest load times and not by the history."""
    name = f"newest_{uuid.uuid4().hex}"
    loads = settle(fx.all_loads(spark, folder), "loads")
    again = F.dayofmonth("MIG_DATETIME") == 2
    try:
        stale = [batch_index.merge_batch(name, loads.where(w), fx.BATCH_KEYS, run, buckets=8) for run, w in (("first", ~again), ("second", again))]
        return upsert.delete_keys(loads, settle(stale[0].unionByName(stale[1]).distinct(), "stale-stamps"))
    finally:
        batch_index.drop_index(spark, name)


QUERIES = {
    "monthly_counts": monthly_counts,
    "reconcile_counts": reconcile_counts,
    "reconcile_counts_full": reconcile_counts_full,
    "reconcile_counts_by_job": reconcile_counts_by_job,
    "orphan_keys": orphan_keys,
    "orphan_delete": orphan_delete,
    "reconcile_second_pass": reconcile_second_pass,
    "dedup_targets": dedup_targets,
    "dedup_keep_latest": dedup_keep_latest,
    "dedup_purge_batches": dedup_purge_batches,
    "dedup_purge_indexed": dedup_purge_indexed,
}

_SINCE = "TIMESTAMP '2000-08-01'"
_COUNTS = f"""
source_counts AS (
  SELECT 'ORDERS' AS job_code, strftime(RDATETIME, '%Y-%m') AS date, COUNT(*) AS row_count
  FROM source WHERE RDATETIME >= {_SINCE} GROUP BY ALL),
target_counts AS (
  SELECT 'ORDERS' AS job_code, strftime(RDATETIME, '%Y-%m') AS date, COUNT(*) AS row_count
  FROM target WHERE RDATETIME >= {_SINCE} GROUP BY ALL),
compared AS (
  SELECT s.job_code, s.date, s.row_count AS row_count_source, t.row_count AS row_count_target,
         s.row_count - t.row_count AS agg_row_count,
         CASE WHEN s.row_count = t.row_count THEN 'PASS1_DONE' ELSE 'PASS1_NEEDED' END AS status
  FROM source_counts s JOIN target_counts t ON s.job_code = t.job_code AND s.date = t.date),
mismatches AS (SELECT * FROM compared WHERE agg_row_count <> 0),
orphans AS (
  SELECT o_orderkey FROM target
  WHERE strftime(RDATETIME, '%Y-%m') IN (SELECT date FROM mismatches)
    AND o_orderkey NOT IN (SELECT o_orderkey FROM source)),
repaired AS (SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orphans))
"""
_BASE = f"WITH {fx.ORDER_CTES}, {_COUNTS}"

_PURGED = f"""WITH {fx.BATCH_CTES}, {fx.stale_stamps('batches')}
SELECT * FROM batches WHERE MIG_DATETIME NOT IN (SELECT MIG_DATETIME FROM stale)"""

ORACLES = {
    "monthly_counts": f"""WITH {fx.ORDER_CTES}
SELECT 'ORDERS' AS job_code, strftime(RDATETIME, '%Y-%m') AS date, COUNT(*) AS row_count
FROM source WHERE RDATETIME >= {_SINCE} GROUP BY ALL
UNION ALL
SELECT 'LINES', strftime(l_shipdate, '%Y-%m'), COUNT(*) FROM lineitem WHERE l_shipdate >= {_SINCE} GROUP BY ALL""",
    "reconcile_counts": f"{_BASE} SELECT * FROM compared",
    "reconcile_counts_full": f"""{_BASE}
SELECT COALESCE(s.job_code, t.job_code) AS job_code, COALESCE(s.date, t.date) AS date,
       COALESCE(s.row_count, 0) AS row_count_source, COALESCE(t.row_count, 0) AS row_count_target,
       COALESCE(s.row_count, 0) - COALESCE(t.row_count, 0) AS agg_row_count,
       CASE WHEN COALESCE(s.row_count, 0) = COALESCE(t.row_count, 0) THEN 'PASS1_DONE' ELSE 'PASS1_NEEDED' END AS status
FROM source_counts s FULL JOIN target_counts t ON s.job_code = t.job_code AND s.date = t.date""",
    "reconcile_counts_by_job": f"""WITH {fx.ORDER_CTES},
s AS (SELECT 'C' || (o_custkey % 5) AS job_code, strftime(RDATETIME, '%Y-%m') AS date, COUNT(*) AS n FROM source WHERE RDATETIME >= {_SINCE} GROUP BY ALL),
t AS (SELECT 'C' || (o_custkey % 5) AS job_code, strftime(RDATETIME, '%Y-%m') AS date, COUNT(*) AS n FROM target WHERE RDATETIME >= {_SINCE} GROUP BY ALL)
SELECT job_code, date, s.n AS row_count_source, t.n AS row_count_target, s.n - t.n AS agg_row_count,
       CASE WHEN s.n = t.n THEN 'PASS1_DONE' ELSE 'PASS1_NEEDED' END AS status
FROM s JOIN t USING (job_code, date)""",
    "orphan_keys": f"{_BASE} SELECT o_orderkey FROM orphans",
    "orphan_delete": f"{_BASE} SELECT * FROM repaired",
    "reconcile_second_pass": f"""{_BASE},
recounted AS (
  SELECT 'ORDERS' AS job_code, strftime(RDATETIME, '%Y-%m') AS date, COUNT(*) AS row_count
  FROM repaired WHERE RDATETIME >= {_SINCE} GROUP BY ALL)
SELECT * FROM mismatches
UNION ALL
SELECT s.job_code, s.date, s.row_count, t.row_count, s.row_count - t.row_count,
       CASE WHEN s.row_count = t.row_count THEN 'PASS2_DONE' ELSE 'NOT_YET_REFLECTED' END
FROM source_counts s JOIN recounted t ON s.job_code = t.job_code AND s.date = t.date
WHERE (s.job_code, s.date) IN (SELECT job_code, date FROM mismatches)""",
    "dedup_targets": f"{_BASE} SELECT DISTINCT job_code FROM compared WHERE agg_row_count < 0",
    "dedup_keep_latest": """
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS FIRST, l_extendedprice DESC NULLS LAST, l_partkey DESC NULLS LAST,
             l_suppkey DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""",
    "dedup_purge_batches": _PURGED,
    "dedup_purge_indexed": _PURGED,
}
