"""Warehouse tables derived from the given tables, as Spark frames and as the same SQL.

Every fixture keeps all rows of its table. Remainders of keys only decide which rows are
damaged, updated or marked, so that each rule of an operator has rows to act on.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.dates import ntz
from quayside.sources.scans import table

# The day after the last order and the last event: the whole of both tables lies in the past.
AS_OF = date(2001, 8, 2)
RUN_TS = datetime(2001, 8, 2, 3, 0)
OLD_TS = datetime(2001, 7, 23, 3, 0)
WINDOW_START = date(2001, 7, 3)
TARGET_END = date(2001, 7, 23)

EVENTS_AS_OF = date(2024, 1, 31)
EVENTS_DAY = date(2024, 1, 30)
EVENTS_RUN_TS = datetime(2024, 1, 31, 0, 30)
EVENTS_OLD_TS = datetime(2024, 1, 30, 0, 30)


def days_later(moment: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("int"), moment)


def hours_later(moment: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours.cast("int"), moment)


def null(kind: str) -> Column:
    return F.lit(None).cast(kind)


# Orders as a source with creation and update times, and a target that lost, aged and kept too many rows.

WINDOW = (
    f"(RDATETIME >= timestamp_ntz'{WINDOW_START}' AND RDATETIME < timestamp_ntz'{AS_OF}') OR "
    f"(UDATETIME >= timestamp_ntz'{WINDOW_START}' AND UDATETIME < timestamp_ntz'{AS_OF}')"
)
ORDER_KEYS = ["o_orderkey"]


def order_source(spark: SparkSession, folder: str) -> DataFrame:
    created = F.col("o_orderdate")
    updated = days_later(created, F.col("o_orderkey") % 400)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        created.alias("RDATETIME"),
        F.when((F.col("o_orderkey") % 5 == 0) & (updated < ntz(AS_OF)), updated).alias("UDATETIME"),
    )


def order_target(spark: SparkSession, folder: str) -> DataFrame:
    old = order_source(spark, folder).where(F.col("RDATETIME") < ntz(TARGET_END))
    key, price, created = F.col("o_orderkey"), F.col("o_totalprice"), F.col("RDATETIME")

    def copy(key: Column, price: Column, created: Column, updated: Column) -> Column:
        return F.struct(
            key.alias("o_orderkey"), price.alias("o_totalprice"), created.alias("RDATETIME"), updated.alias("UDATETIME")
        )

    lost = key % 29 == 0
    # Every second copy of the window is dated before it: only a strict load replaces those never updated.
    dated = F.when((key % 2 == 0) & (created >= ntz(WINDOW_START)), days_later(created, F.lit(-60))).otherwise(created)
    aged = F.when(~lost, copy(key, price * 0.9, dated, null("timestamp_ntz")))
    # Every second month holds more rows that the source no longer has than it lost.
    stray = (key % 41 == 0) | ((F.month("RDATETIME") % 2 == 0) & (key % 23 == 0))
    orphan = F.when(stray, copy(key + 1000000000, price, created, F.col("UDATETIME")))
    return old.select(
        "o_custkey", "o_orderstatus", F.inline(F.array_compact(F.array(aged, orphan)))
    ).withColumn("MIG_DATETIME", ntz(OLD_TS))


ORDER_CTES = f"""
source AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS RDATETIME,
         CASE WHEN o_orderkey % 5 = 0 AND o_orderdate + to_days(CAST(o_orderkey % 400 AS INTEGER)) < TIMESTAMP '{AS_OF}'
              THEN o_orderdate + to_days(CAST(o_orderkey % 400 AS INTEGER)) END AS UDATETIME
  FROM orders),
target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 0.9 AS o_totalprice,
         CASE WHEN o_orderkey % 2 = 0 AND RDATETIME >= TIMESTAMP '{WINDOW_START}' THEN RDATETIME - INTERVAL 60 DAY ELSE RDATETIME END AS RDATETIME,
         CAST(NULL AS TIMESTAMP) AS UDATETIME, TIMESTAMP '{OLD_TS}' AS MIG_DATETIME
  FROM source WHERE RDATETIME < TIMESTAMP '{TARGET_END}' AND o_orderkey % 29 <> 0
  UNION ALL
  SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, RDATETIME, UDATETIME, TIMESTAMP '{OLD_TS}'
  FROM source WHERE RDATETIME < TIMESTAMP '{TARGET_END}' 
    AND (o_orderkey % 41 = 0 OR (month(RDATETIME) % 2 = 0 AND o_orderkey % 23 = 0)))
"""
WINDOW_SQL = WINDOW.replace("timestamp_ntz'", "TIMESTAMP '")


# Events as an hourly source. The source predicate also takes rows updated in the window.

EVENT_KEYS = ["event_id"]
EVENT_SOURCE_PRED = (
    f"(RDATETIME >= timestamp_ntz'{EVENTS_DAY}' AND RDATETIME < timestamp_ntz'{EVENTS_AS_OF}') OR "
    f"(UDATETIME >= timestamp_ntz'{EVENTS_DAY}' AND UDATETIME < timestamp_ntz'{EVENTS_AS_OF}')"
)
EVENT_TARGET_PRED = f"RDATETIME >= timestamp_ntz'{EVENTS_DAY}' AND RDATETIME < timestamp_ntz'{EVENTS_AS_OF}'"


def event_source(spark: SparkSession, folder: str) -> DataFrame:
    updated = hours_later(F.col("ts"), F.col("event_id") % 48)
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("ts").alias("RDATETIME"),
        F.when((F.col("event_id") % 5 == 0) & (updated < ntz(EVENTS_AS_OF)), updated).alias("UDATETIME"),
    )


def event_target(spark: SparkSession, folder: str) -> DataFrame:
    """The target of the day before, with the values then known and half of the last day already loaded."""
    old = event_source(spark, folder).where(F.col("RDATETIME") < ntz(datetime(2024, 1, 30, 12, 0)))
    return old.withColumns(
        {
            "value": F.col("value") - 1,
            "UDATETIME": null("timestamp_ntz"),
            "MIG_DATETIME": ntz(EVENTS_OLD_TS),
        }
    )


EVENT_CTES = f"""
source AS (
  SELECT event_id, user_id, event_type, value, ts AS RDATETIME,
         CASE WHEN event_id % 5 = 0 AND ts + to_hours(CAST(event_id % 48 AS INTEGER)) < TIMESTAMP '{EVENTS_AS_OF}'
              THEN ts + to_hours(CAST(event_id % 48 AS INTEGER)) END AS UDATETIME
  FROM events),
target AS (
  SELECT event_id, user_id, event_type, value - 1 AS value, RDATETIME, CAST(NULL AS TIMESTAMP) AS UDATETIME,
         TIMESTAMP '{EVENTS_OLD_TS}' AS MIG_DATETIME
  FROM source WHERE RDATETIME < TIMESTAMP '2024-01-30 12:00:00')
"""
EVENT_SOURCE_SQL = EVENT_SOURCE_PRED.replace("timestamp_ntz'", "TIMESTAMP '")
EVENT_TARGET_SQL = EVENT_TARGET_PRED.replace("timestamp_ntz'", "TIMESTAMP '")


# Part quantities by ship month as snapshot batches. Every even month was loaded again a day
# later without a third of its parts.

BATCH_KEYS = ["l_partkey", "ship_month"]


def _part_months(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", F.to_date(F.trunc("l_shipdate", "month")).alias("ship_month"))
        .agg(F.sum("l_quantity").alias("quantity"))
    )


def _month_load(days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(days), F.add_months("ship_month", 1).cast("timestamp_ntz"))


def first_loads(spark: SparkSession, folder: str) -> DataFrame:
    return _part_months(spark, folder).withColumn("MIG_DATETIME", _month_load(0))


def _loaded_again() -> Column:
    return (F.month("ship_month") % 2 == 0) & (F.col("l_partkey") % 3 != 0)


def reloads(spark: SparkSession, folder: str) -> DataFrame:
    return _part_months(spark, folder).where(_loaded_again()).withColumn("MIG_DATETIME", _month_load(1))


def all_loads(spark: SparkSession, folder: str) -> DataFrame:
    """First loads and reloads, from one grouping."""
    first = F.array(_month_load(0))
    loads = F.when(_loaded_again(), F.array(_month_load(0), _month_load(1))).otherwise(first)
    return _part_months(spark, folder).withColumn("MIG_DATETIME", F.explode(loads))


BATCH_CTES = """
part_months AS (
  SELECT l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month, SUM(l_quantity) AS quantity
  FROM lineitem GROUP BY ALL),
batches AS (
  SELECT *, CAST(ship_month + INTERVAL 1 MONTH AS TIMESTAMP) AS MIG_DATETIME FROM part_months
  UNION ALL
  SELECT *, CAST(ship_month + INTERVAL 1 MONTH AS TIMESTAMP) + INTERVAL 1 DAY
  FROM part_months WHERE month(ship_month) % 2 = 0 AND l_partkey % 3 <> 0)
"""


def stale_stamps(batches: str) -> str:
    """SQL for the load times of all rows that are not the newest of their key, each once."""
    return f"""newest AS (
  SELECT l_partkey, ship_month, MAX(MIG_DATETIME) AS newest FROM {batches} GROUP BY l_partkey, ship_month),
stale AS (
  SELECT DISTINCT b.MIG_DATETIME FROM {batches} b JOIN newest n ON b.l_partkey = n.l_partkey AND b.ship_month = n.ship_month
  WHERE b.MIG_DATETIME < n.newest)"""


# Job catalogs and logs. One job per user of the events, one log row per event.

LOG_DAY = EVENTS_DAY
LAST_HOUR = datetime(2024, 1, 30, 23)


def job_log(spark: SparkSession, folder: str) -> DataFrame:
    status = (
        F.when(F.col("event_type") == "error", F.lit("X"))
        .when(F.col("event_id") % 41 == 0, null("string"))
        .otherwise(F.lit("O"))
    )
    return table(spark, folder, "events").select(
        F.concat(F.lit("J"), F.col("user_id").cast("string")).alias("job_code"),
        F.col("ts").alias("start_date"),
        F.col("ts").alias("insert_time"),
        status.alias("status"),
        F.col("value").cast("bigint").alias("row_count"),
        # Only the daily schedule writes in the last hour.
        F.when((F.col("event_id") % 3 == 0) & (F.col("ts") < ntz(LAST_HOUR)), F.lit("H")).otherwise(F.lit("D")).alias("schedule"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("user_id").distinct()


def _code(number: Column) -> Column:
    return F.concat(F.lit("J"), number.cast("string"))


def job_info(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    return users(spark, folder).select(
        _code(user).alias("JOB_CODE"),
        (user % 4).cast("string").alias("AGG_LEVEL"),
        F.when(user % 13 == 0, F.lit("Y")).when(user % 17 == 0, null("string")).otherwise(F.lit("N")).alias("DEL_YN"),
        F.when(user % 7 == 0, F.lit("H")).otherwise(F.lit("D")).alias("SCHEDULE"),
        F.when(user % 3 == 0, F.lit("O")).when(user % 3 == 1, F.lit("OO")).otherwise(F.lit("N")).alias("ACCUMULATE"),
    )


def pre_job_info(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    return (
        users(spark, folder)
        .select(
            "user_id",
            F.explode(
                F.concat(
                    F.when(user >= 2, F.array(F.floor(user / 2))).otherwise(F.array().cast("array<bigint>")),
                    F.when(user >= 3, F.array(F.floor(user / 3))).otherwise(F.array().cast("array<bigint>")),
                )
            ).alias("pre"),
        )
        .select(
            _code(user).alias("JOB_CODE"),
            _code(F.col("pre")).alias("PRE_JOB_CODE"),
            F.lit("N").alias("DEL_YN"),
            F.when(user % 7 == 0, F.lit("H")).otherwise(F.lit("D")).alias("SCHEDULE"),
        )
    )


def job_table_info(spark: SparkSession, folder: str) -> DataFrame:
    """One load predicate per job, two for some, none for others."""
    user = F.col("user_id")
    copies = F.when(user % 19 == 0, F.sequence(F.lit(1), F.lit(2))).when(
        user % 23 == 0, F.array().cast("array<int>")
    ).otherwise(F.array(F.lit(1)))
    text = F.concat(F.lit("RDATETIME >= DATE '2024-01-"), F.lpad((user % 28 + 1).cast("string"), 2, "0"), F.lit("'"))
    return (
        users(spark, folder)
        .select("user_id", F.explode(copies).alias("copy"))
        .select(
            _code(user).alias("JOB_CODE"),
            text.alias("UPDATE_COL"),
            F.when(user % 11 == 0, F.lit("X")).otherwise(text).alias("UPDATE_COL_RT"),
            F.concat(text, F.lit(" OR UDATETIME >= DATE '2024-01-30'")).alias("UPDATE_COL_RT_2"),
            F.lit("N").alias("DEL_YN"),
        )
    )


USUAL_WINDOWS = [f"RDATETIME >= DATE '2024-01-{day:02d}'" for day in (5, 9, 13)]

JOB_CTES = f"""
users AS (SELECT DISTINCT user_id FROM events),
log AS (
  SELECT 'J' || user_id AS job_code, ts AS start_date, ts AS insert_time,
         CASE WHEN event_type = 'error' THEN 'X' WHEN event_id % 41 = 0 THEN NULL ELSE 'O' END AS status,
         CAST(trunc(value) AS BIGINT) AS row_count,
         CASE WHEN event_id % 3 = 0 AND ts < TIMESTAMP '{LAST_HOUR}' THEN 'H' ELSE 'D' END AS schedule
  FROM events),
job_info AS (
  SELECT 'J' || user_id AS JOB_CODE, CAST(user_id % 4 AS VARCHAR) AS AGG_LEVEL,
         CASE WHEN user_id % 13 = 0 THEN 'Y' WHEN user_id % 17 = 0 THEN NULL ELSE 'N' END AS DEL_YN,
         CASE WHEN user_id % 7 = 0 THEN 'H' ELSE 'D' END AS SCHEDULE,
         CASE user_id % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'OO' ELSE 'N' END AS ACCUMULATE
  FROM users),
pre_job_info AS (
  SELECT 'J' || user_id AS JOB_CODE, 'J' || (user_id // divisor) AS PRE_JOB_CODE,
         CASE WHEN user_id % 7 = 0 THEN 'H' ELSE 'D' END AS SCHEDULE
  FROM users, (SELECT unnest([2, 3]) AS divisor) WHERE user_id >= divisor),
job_table_info AS (
  SELECT 'J' || user_id AS JOB_CODE,
         'RDATETIME >= DATE ''2024-01-' || lpad(CAST(user_id % 28 + 1 AS VARCHAR), 2, '0') || '''' AS UPDATE_COL,
         user_id % 11 = 0 AS switched_off
  FROM users, (SELECT unnest([1, 2]) AS copy)
  WHERE copy <= CASE WHEN user_id % 19 = 0 THEN 2 WHEN user_id % 23 = 0 THEN 0 ELSE 1 END)
"""


# Users of two days, from the customers.

USERS_RUN_TS = datetime(2001, 8, 2, 6, 30)


def _customer_users(spark: SparkSession, folder: str, department: Column, mark: Column) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        "c_custkey",
        key.alias("USER_ID"),
        F.concat(F.lit("U"), key).alias("USER_CODE"),
        F.col("c_name").alias("USER_NM"),
        department.cast("string").alias("PART_CODE"),
        mark.alias("BI_USE_YN"),
    )


def current_users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    mark = F.when(key % 10 == 0, F.lit("N")).otherwise(F.lit("Y"))
    return _customer_users(spark, folder, key % 40 + 1, mark).where(key % 17 != 0).drop("c_custkey")


def previous_users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    department = F.when(key % 13 == 0, (key + 3) % 40 + 1).otherwise(key % 40 + 1)
    mark = F.when(key % 9 == 0, F.lit("N")).when(key % 23 == 0, null("string")).otherwise(F.lit("Y"))
    return _customer_users(spark, folder, department, mark).where((key % 11 != 0) | (key % 17 == 0)).drop("c_custkey")


def portal_groups(spark: SparkSession, folder: str) -> DataFrame:
    """A data group for each department of yesterday, the common group, and groups that are no data groups."""
    departments = previous_users(spark, folder).select(F.col("PART_CODE").alias("group_code")).distinct()
    roles = spark.sql("SELECT * FROM VALUES ('9001'), ('9002'), ('9003'), ('9004'), ('9005') AS g(group_code)")
    common = spark.sql("SELECT 'T' AS group_code, 'T,data' AS group_desc")
    return (
        departments.withColumn("group_desc", F.concat("group_code", F.lit(",data")))
        .unionByName(common)
        .unionByName(roles.withColumn("group_desc", F.concat(F.lit("role "), F.col("group_code"))))
    )


def existing_grants(spark: SparkSession, folder: str) -> DataFrame:
    """Yesterday's grants: base, role, own department, common group and all other data groups of each user in use."""
    code = F.explode(F.array(F.lit("9001"), F.lit("9002"), F.col("PART_CODE"), F.lit("T")))
    users = previous_users(spark, folder).where(F.col("BI_USE_YN") == "Y")
    named = users.select(code.alias("GROUP_CODE"), F.lit("GROUP").alias("rule"), F.col("USER_ID").alias("usr_id"))
    return named.unionByName(
        users.select(F.col("PART_CODE").alias("GROUP_CODE"), F.lit("OTHER_DATA_GROUPS").alias("rule"), F.col("USER_ID").alias("usr_id"))
    )


USER_CTES = """
cur AS (
  SELECT CAST(c_custkey AS VARCHAR) AS USER_ID, c_name AS USER_NM, CAST(c_custkey % 40 + 1 AS VARCHAR) AS PART_CODE,
         CASE WHEN c_custkey % 10 = 0 THEN 'N' ELSE 'Y' END AS BI_USE_YN
  FROM customer WHERE c_custkey % 17 <> 0),
prev AS (
  SELECT CAST(c_custkey AS VARCHAR) AS USER_ID, c_name AS USER_NM,
         CAST(CASE WHEN c_custkey % 13 = 0 THEN (c_custkey + 3) % 40 + 1 ELSE c_custkey % 40 + 1 END AS VARCHAR) AS PART_CODE,
         CASE WHEN c_custkey % 9 = 0 THEN 'N' WHEN c_custkey % 23 = 0 THEN NULL ELSE 'Y' END AS BI_USE_YN
  FROM customer WHERE c_custkey % 11 <> 0 OR c_custkey % 17 = 0),
groups AS (
  SELECT DISTINCT PART_CODE AS group_code, PART_CODE || ',data' AS group_desc FROM prev
  UNION ALL SELECT 'T', 'T,data'
  UNION ALL SELECT c, 'role ' || c FROM (SELECT unnest(['9001', '9002', '9003', '9004', '9005']) AS c)),
grants AS (
  SELECT unnest(['9001', '9002', PART_CODE, 'T']) AS GROUP_CODE, 'GROUP' AS rule, USER_ID AS usr_id FROM prev WHERE BI_USE_YN = 'Y'
  UNION ALL
  SELECT PART_CODE, 'OTHER_DATA_GROUPS', USER_ID FROM prev WHERE BI_USE_YN = 'Y'),
changes AS (
  SELECT c.USER_ID, c.USER_NM, 'NEW' AS CHANGE, c.PART_CODE, CAST(NULL AS VARCHAR) AS OLD_PART_CODE
  FROM cur c LEFT JOIN prev p ON c.USER_ID = p.USER_ID WHERE p.USER_ID IS NULL AND c.BI_USE_YN = 'Y'
  UNION ALL
  SELECT c.USER_ID, c.USER_NM, 'ACTIVATED', c.PART_CODE, p.PART_CODE
  FROM cur c JOIN prev p ON c.USER_ID = p.USER_ID WHERE c.BI_USE_YN = 'Y' AND p.BI_USE_YN <> c.BI_USE_YN
  UNION ALL
  SELECT c.USER_ID, c.USER_NM, 'TRANSFERRED', c.PART_CODE, p.PART_CODE
  FROM cur c JOIN prev p ON c.USER_ID = p.USER_ID AND c.PART_CODE <> p.PART_CODE AND p.BI_USE_YN = 'Y'
  WHERE c.BI_USE_YN = 'Y'
  UNION ALL
  SELECT p.USER_ID, p.USER_NM, 'LEFT', NULL, p.PART_CODE
  FROM prev p LEFT JOIN cur c ON p.USER_ID = c.USER_ID AND c.BI_USE_YN = 'Y'
  WHERE p.BI_USE_YN = 'Y' AND c.USER_ID IS NULL)
"""
