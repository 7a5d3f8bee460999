"""Incremental, historical and full loads, and the stream form."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import history, jobs, schema, upsert
from quayside.plans import publish
from quayside.plans.locator import Window, create_locator, drop_locator, key_months, load_located, window_months
from quayside.plans.publish import folder_of
from quayside.plans.settle import scratch_path, settle
from quayside.plans.table_load import by_month, create_by_month, load_history, load_table
from quayside.queries import fixtures as fx
from quayside.sources import sinks
from quayside.sources.scans import table
from quayside.streaming.keyed_state import stateful_upsert as upsert_by_state
from quayside.streaming.micro_batch import micro_batch_upsert as upsert_stream


def _daily(spark: SparkSession, folder: str, **options) -> DataFrame:
    return upsert.load_window(
        fx.order_source(spark, folder), fx.order_target(spark, folder), fx.ORDER_KEYS, fx.WINDOW, fx.RUN_TS, **options
    )


def incremental_upsert_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder)


def incremental_upsert_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder, strict=True)


def incremental_upsert_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return upsert.load_window(
        fx.event_source(spark, folder),
        fx.event_target(spark, folder),
        fx.EVENT_KEYS,
        fx.EVENT_SOURCE_PRED,
        fx.EVENTS_RUN_TS,
        target_pred=fx.EVENT_TARGET_PRED,
    )


def incremental_upsert_table(spark: SparkSession, folder: str) -> DataFrame:
    """The daily load into a stored table, month by month."""
    name = f"quayside_orders_{uuid.uuid4().hex}"
    create_by_month(fx.order_target(spark, folder), name, path=scratch_path(spark, "orders"))
    batch = fx.order_source(spark, folder).where(fx.WINDOW)
    return load_table(name, batch, fx.ORDER_KEYS, fx.WINDOW, fx.RUN_TS)


# About a bucket for each million keys; the test tables need few.
KEY_BUCKETS = 8
LOADED_WINDOW = Window(fx.WINDOW_START, fx.AS_OF)


def _located(spark: SparkSession, folder: str) -> str:
    """A stored table of the orders with a locator."""
    name = f"quayside_located_{uuid.uuid4().hex}"
    create_by_month(fx.order_target(spark, folder), name, path=f"{folder_of(spark, name)}")
    create_locator(spark, name, fx.ORDER_KEYS, buckets=KEY_BUCKETS)
    return name


def _drop_located(spark: SparkSession, name: str) -> None:
    drop_locator(spark, name)
    publish.drop(spark, name)


def incremental_upsert_located(spark: SparkSession, folder: str) -> DataFrame:
    """The daily load into a stored table by its locator."""
    name = _located(spark, folder)
    try:
        batch = fx.order_source(spark, folder).where(fx.WINDOW)
        return settle(load_located(name, batch, LOADED_WINDOW, fx.RUN_TS, "day"), "located")
    finally:
        _drop_located(spark, name)


def located_months(spark: SparkSession, folder: str) -> DataFrame:
    """The months that the daily load changes, as the locator tells them."""
    name = _located(spark, folder)
    try:
        batch = fx.order_source(spark, folder).where(fx.WINDOW)
        months = by_month(batch).select("LOAD_MONTH").distinct()
        replaced = batch.where("UDATETIME IS NOT NULL").select(*fx.ORDER_KEYS)
        found = months.unionByName(window_months(spark, name, LOADED_WINDOW)).unionByName(key_months(spark, name, replaced))
        return settle(found.distinct(), "months")
    finally:
        _drop_located(spark, name)


def touched_partitions(spark: SparkSession, folder: str) -> DataFrame:
    source = fx.order_source(spark, folder)
    return upsert.touched_partitions(
        fx.order_target(spark, folder),
        source.where(fx.WINDOW),
        fx.ORDER_KEYS,
        fx.WINDOW,
        F.to_date(F.trunc("RDATETIME", "month")),
        "month",
    )


def delete_where(spark: SparkSession, folder: str) -> DataFrame:
    return upsert.delete_where(fx.order_target(spark, folder), fx.WINDOW)


def delete_older(spark: SparkSession, folder: str) -> DataFrame:
    return upsert.delete_older(fx.order_source(spark, folder), "UDATETIME", fx.WINDOW_START)


def schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    # The batch spells one column in its own way.
    target = fx.order_target(spark, folder).drop("o_orderstatus")
    batch = fx.order_source(spark, folder).where(fx.WINDOW).withColumnRenamed("o_totalprice", "O_TOTALPRICE")
    grown, filled = schema.evolve(target, batch)
    return grown.unionByName(filled)


def schema_evolution_as_text(spark: SparkSession, folder: str) -> DataFrame:
    target = fx.order_target(spark, folder).drop("o_custkey")
    batch = fx.order_source(spark, folder).where(fx.WINDOW)
    grown, filled = schema.evolve(target, batch, new_as_text=True)
    return grown.unionByName(filled)


FIRST_YEAR, LAST_YEAR = 1996, 2000


def historical_load_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return history.historical_load(fx.order_source(spark, folder), FIRST_YEAR, LAST_YEAR, fx.RUN_TS)


def historical_load_table(spark: SparkSession, folder: str) -> DataFrame:
    """The historical load into a stored table, followed by a daily load."""
    name = f"quayside_history_{uuid.uuid4().hex}"
    source = fx.order_source(spark, folder)
    load_history(source, name, FIRST_YEAR, LAST_YEAR, fx.OLD_TS, path=scratch_path(spark, "history"))
    return load_table(name, source.where(fx.WINDOW), fx.ORDER_KEYS, fx.WINDOW, fx.RUN_TS)


def historical_load_unplaced(spark: SparkSession, folder: str) -> DataFrame:
    return history.unplaced_rows(fx.order_source(spark, folder), FIRST_YEAR, LAST_YEAR, "UDATETIME")


def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "supplier")
    sinks.replace(upsert.full_refresh(table(spark, folder, "supplier"), fx.RUN_TS), path)
    return spark.read.parquet(path)


def load_log_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = jobs.load_log("ORDERS", _daily(spark, folder), fx.WINDOW, fx.RUN_TS)
    events = jobs.load_log(
        "EVENTS",
        incremental_upsert_hourly(spark, folder),
        fx.EVENT_TARGET_PRED,
        fx.EVENTS_RUN_TS,
        schedule=jobs.HOURLY,
    )
    return orders.unionByName(events)


# A micro-batch holds at most as many change files, whatever is waiting.
FILES_PER_BATCH = 64


def micro_batch_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly load from a folder of change files, taken in micro-batches of ``FILES_PER_BATCH``."""
    waiting = scratch_path(spark, "changes")
    source = fx.event_source(spark, folder)
    sinks.append(source.withColumn("arrival", F.col("event_id") % 4), waiting, ["arrival"])
    changes = (
        spark.readStream.schema(source.schema)
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .option("recursiveFileLookup", "true")
        .parquet(waiting)
    )
    return upsert_stream(
        changes,
        fx.event_target(spark, folder),
        fx.EVENT_KEYS,
        fx.EVENT_SOURCE_PRED,
        fx.EVENT_TARGET_PRED,
        fx.EVENTS_RUN_TS,
        landing=scratch_path(spark, "landing"),
        checkpoint=scratch_path(spark, "stream"),
    )


def stateful_stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly load from change files that hold older versions, repeated rows and newer ones before older ones, in two runs."""
    waiting, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "stream")
    source = fx.event_source(spark, folder)
    before = source.where("UDATETIME IS NOT NULL").withColumns({"value": F.col("value") - 7, "UDATETIME": fx.null("timestamp_ntz")})
    again = source.where("event_id % 3 = 0")

    def run(target: DataFrame, target_pred: str | None) -> DataFrame:
        changes = (
            spark.readStream.schema(source.schema)
            .option("maxFilesPerTrigger", FILES_PER_BATCH)
            .option("recursiveFileLookup", "true")
            .parquet(waiting)
        )
        return upsert_by_state(changes, target, fx.EVENT_KEYS, fx.EVENT_SOURCE_PRED, fx.EVENTS_RUN_TS, scratch_path(spark, "landing"), checkpoint, target_pred)

    sinks.append(source.withColumn("arrival", F.col("event_id") % 4), waiting, ["arrival"])
    first = run(fx.event_target(spark, folder), fx.EVENT_TARGET_PRED)
    sinks.append(before.unionByName(again).withColumn("arrival", 4 + F.col("event_id") % 2), waiting, ["arrival"])
    return run(first, None)


QUERIES = {
    "incremental_upsert_daily": incremental_upsert_daily,
    "incremental_upsert_strict": incremental_upsert_strict,
    "incremental_upsert_hourly": incremental_upsert_hourly,
    "incremental_upsert_table": incremental_upsert_table,
    "incremental_upsert_located": incremental_upsert_located,
    "located_months": located_months,
    "touched_partitions": touched_partitions,
    "delete_where": delete_where,
    "delete_older": delete_older,
    "schema_evolution": schema_evolution,
    "schema_evolution_as_text": schema_evolution_as_text,
    "historical_load_by_year": historical_load_by_year,
    "historical_load_table": historical_load_table,
    "historical_load_unplaced": historical_load_unplaced,
    "full_refresh": full_refresh,
    "load_log_rows": load_log_rows,
    "micro_batch_upsert": micro_batch_upsert,
    "stateful_stream_upsert": stateful_stream_upsert,
}


def _upsert_sql(ctes: str, key: str, source_pred: str, target_pred: str, run_ts, strict: bool = False) -> str:
    replaced = "TRUE" if strict else "UDATETIME IS NOT NULL"
    return f"""WITH {ctes},
batch AS (SELECT *, TIMESTAMP '{run_ts}' AS MIG_DATETIME FROM source WHERE {source_pred}),
loaded AS (
  SELECT * FROM target
  WHERE {key} NOT IN (SELECT {key} FROM batch WHERE {replaced}) AND ({target_pred}) IS NOT TRUE
  UNION ALL
  SELECT * FROM batch)
"""


_DAILY = _upsert_sql(fx.ORDER_CTES, "o_orderkey", fx.WINDOW_SQL, fx.WINDOW_SQL, fx.RUN_TS)
_STRICT = _upsert_sql(fx.ORDER_CTES, "o_orderkey", fx.WINDOW_SQL, fx.WINDOW_SQL, fx.RUN_TS, strict=True)
_HOURLY = _upsert_sql(fx.EVENT_CTES, "event_id", fx.EVENT_SOURCE_SQL, fx.EVENT_TARGET_SQL, fx.EVENTS_RUN_TS)
_HOURLY_COUNT = f"SELECT COUNT(*) FROM ({_HOURLY} SELECT * FROM loaded WHERE {fx.EVENT_TARGET_SQL})"

ORACLES = {
    "incremental_upsert_daily": _DAILY + "SELECT * FROM loaded",
    "incremental_upsert_table": _DAILY + "SELECT *, strftime(RDATETIME, '%Y-%m') AS LOAD_MONTH FROM loaded",
    "incremental_upsert_located": _DAILY + "SELECT *, strftime(RDATETIME, '%Y-%m') AS LOAD_MONTH FROM loaded",
    "located_months": f"""WITH {fx.ORDER_CTES},
batch AS (SELECT * FROM source WHERE {fx.WINDOW_SQL})
SELECT DISTINCT strftime(RDATETIME, '%Y-%m') AS LOAD_MONTH FROM (
  SELECT RDATETIME FROM batch
  UNION ALL SELECT RDATETIME FROM target WHERE {fx.WINDOW_SQL}
  UNION ALL SELECT RDATETIME FROM target
            WHERE o_orderkey IN (SELECT o_orderkey FROM batch WHERE UDATETIME IS NOT NULL))""",
    "incremental_upsert_strict": _STRICT + "SELECT * FROM loaded",
    "incremental_upsert_hourly": _HOURLY + "SELECT * FROM loaded",
    "touched_partitions": f"""WITH {fx.ORDER_CTES},
batch AS (SELECT * FROM source WHERE {fx.WINDOW_SQL})
SELECT DISTINCT CAST(date_trunc('month', RDATETIME) AS DATE) AS month FROM (
  SELECT RDATETIME FROM batch
  UNION ALL SELECT RDATETIME FROM target WHERE {fx.WINDOW_SQL}
  UNION ALL SELECT RDATETIME FROM target
            WHERE o_orderkey IN (SELECT o_orderkey FROM batch WHERE UDATETIME IS NOT NULL))""",
    "delete_where": f"WITH {fx.ORDER_CTES} SELECT * FROM target WHERE ({fx.WINDOW_SQL}) IS NOT TRUE",
    "delete_older": f"""WITH {fx.ORDER_CTES}
SELECT * FROM source WHERE UDATETIME IS NULL OR UDATETIME >= TIMESTAMP '{fx.WINDOW_START}'""",
    "schema_evolution": f"""WITH {fx.ORDER_CTES}
SELECT o_orderkey, o_custkey, o_totalprice, RDATETIME, UDATETIME, MIG_DATETIME, CAST(NULL AS VARCHAR) AS o_orderstatus
FROM target
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, RDATETIME, UDATETIME, NULL, o_orderstatus FROM source WHERE {fx.WINDOW_SQL}""",
    "schema_evolution_as_text": f"""WITH {fx.ORDER_CTES}
SELECT o_orderkey, o_orderstatus, o_totalprice, RDATETIME, UDATETIME, MIG_DATETIME, CAST(NULL AS VARCHAR) AS o_custkey
FROM target
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice, RDATETIME, UDATETIME, NULL, CAST(o_custkey AS VARCHAR)
FROM source WHERE {fx.WINDOW_SQL}""",
    "historical_load_by_year": f"""WITH {fx.ORDER_CTES}
SELECT *, CAST(year(RDATETIME) AS INTEGER) AS LOAD_YEAR, TIMESTAMP '{fx.RUN_TS}' AS MIG_DATETIME
FROM source WHERE RDATETIME >= TIMESTAMP '{FIRST_YEAR}-01-01' AND RDATETIME < TIMESTAMP '{LAST_YEAR + 1}-01-01'""",
    "historical_load_table": f"""WITH {fx.ORDER_CTES},
batch AS (SELECT *, TIMESTAMP '{fx.RUN_TS}' AS MIG_DATETIME FROM source WHERE {fx.WINDOW_SQL}),
history AS (
  SELECT *, TIMESTAMP '{fx.OLD_TS}' AS MIG_DATETIME FROM source
  WHERE RDATETIME >= TIMESTAMP '{FIRST_YEAR}-01-01' AND RDATETIME < TIMESTAMP '{LAST_YEAR + 1}-01-01')
SELECT *, strftime(RDATETIME, '%Y-%m') AS LOAD_MONTH FROM (
  SELECT * FROM history
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch WHERE UDATETIME IS NOT NULL) AND ({fx.WINDOW_SQL}) IS NOT TRUE
  UNION ALL SELECT * FROM batch)""",
    "historical_load_unplaced": f"""WITH {fx.ORDER_CTES}
SELECT CASE WHEN UDATETIME IS NULL THEN 'NO_DATE' WHEN year(UDATETIME) < {FIRST_YEAR} THEN 'BEFORE' ELSE 'AFTER' END AS REASON,
       COUNT(*) AS ROW_COUNT
FROM source WHERE UDATETIME IS NULL OR year(UDATETIME) NOT BETWEEN {FIRST_YEAR} AND {LAST_YEAR} GROUP BY ALL""",
    "full_refresh": f"SELECT *, TIMESTAMP '{fx.RUN_TS}' AS MIG_DATETIME FROM supplier",
    "load_log_rows": f"""{_DAILY}
SELECT 'ORDERS' AS job_code, DATE '{fx.RUN_TS.date()}' AS date, TIMESTAMP '{fx.RUN_TS}' AS insert_time,
       COUNT(*) FILTER (WHERE {fx.WINDOW_SQL}) AS row_count, 'D' AS schedule, 'O' AS status
FROM loaded
UNION ALL
SELECT 'EVENTS', DATE '{fx.EVENTS_RUN_TS.date()}', TIMESTAMP '{fx.EVENTS_RUN_TS}', ({_HOURLY_COUNT}), 'H', 'O'""",
    "micro_batch_upsert": _HOURLY + "SELECT * FROM loaded",
    "stateful_stream_upsert": _upsert_sql(
        fx.EVENT_CTES, "event_id", fx.EVENT_SOURCE_SQL, fx.EVENT_TARGET_SQL, fx.EVENTS_RUN_TS, strict=True
    )
    + "SELECT * FROM loaded",
}
