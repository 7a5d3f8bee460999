"""User changes between two days and the portal rows that follow."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import history, intervals, members
from quayside.plans.settle import scratch_path, settle
from quayside.queries import fixtures as fx
from quayside.sources import sinks
from quayside.sources.scans import table


def user_changes(spark: SparkSession, folder: str) -> DataFrame:
    return members.user_changes(fx.current_users(spark, folder), fx.previous_users(spark, folder))


def _stored_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The changes as the later steps read them: found once, then stored."""
    return settle(user_changes(spark, folder), "changes")


def _stored_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The group table as a stored table, whose size is known."""
    return settle(fx.portal_groups(spark, folder), "groups")


def snapshot_rotation(spark: SparkSession, folder: str) -> DataFrame:
    """Changes found from stored daily snapshots, counted per kind."""
    path = scratch_path(spark, "users")
    yesterday = fx.AS_OF - timedelta(days=1)
    day = ["SNAPSHOT_DATE"]
    sinks.replace_partitions(history.snapshot_of(fx.previous_users(spark, folder), yesterday), path, day)
    sinks.replace_partitions(history.snapshot_of(fx.current_users(spark, folder), fx.AS_OF), path, day)
    current, previous = history.snapshot_pair(spark.read.parquet(path), fx.AS_OF)
    return members.user_changes(current, previous).groupBy("CHANGE").agg(F.count(F.lit(1)).alias("users"))


DAYS = 10
FIRST_DAY = fx.AS_OF - timedelta(days=DAYS - 1)
LOOK_BACK = FIRST_DAY + timedelta(days=4)


def _daily_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users on ten days. Each is absent now and then, some change their department on one of the days, some have no mark."""
    key, n = F.col("c_custkey"), F.col("n")
    # The file may be small enough for one task, ten days of its users are not.
    users = table(spark, folder, "customer").select("c_custkey").hint("rebalance")
    days = users.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(DAYS - 1))))
    return days.where((key + n) % 11 != 0).select(
        key.alias("USER_KEY"),
        F.when((key % 20 < DAYS) & (n >= key % 20), (key + 3) % 40 + 1).otherwise(key % 40 + 1).alias("PART_CODE"),
        F.when(key % 23 == 0, fx.null("string")).otherwise(F.lit("Y")).alias("BI_USE_YN"),
        F.date_add(F.lit(FIRST_DAY), n).alias("SNAPSHOT_DATE"),
    )


def _user_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Intervals of all days but the last, merged with the last one."""
    users, last = _daily_users(spark, folder), FIRST_DAY + timedelta(days=DAYS - 1)
    known = settle(intervals.to_intervals(users.where(F.col("SNAPSHOT_DATE") < F.lit(last))), "intervals")
    return intervals.merge_day(known, history.snapshot_at(users, last), last)


def user_intervals(spark: SparkSession, folder: str) -> DataFrame:
    return _user_intervals(spark, folder)


def user_snapshot_restored(spark: SparkSession, folder: str) -> DataFrame:
    return intervals.valid_at(settle(_user_intervals(spark, folder), "intervals"), LOOK_BACK)


def order_departments(spark: SparkSession, folder: str) -> DataFrame:
    """The department each customer had on the day of the order, for the days that snapshots tell."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("USER_KEY"), "o_orderdate")
    known = settle(_user_intervals(spark, folder), "intervals")
    return intervals.look_up(orders, known, ["USER_KEY"], "o_orderdate", ["PART_CODE"])


def permission_grants(spark: SparkSession, folder: str) -> DataFrame:
    """One row per group named and one per user for all data groups but the own."""
    return members.permission_grants(user_changes(spark, folder), fx.USERS_RUN_TS)


def permission_revokes(spark: SparkSession, folder: str) -> DataFrame:
    return members.permission_revokes(
        fx.existing_grants(spark, folder), user_changes(spark, folder), _stored_groups(spark, folder)
    )


def permission_state(spark: SparkSession, folder: str) -> DataFrame:
    """All grants after the run: what the revokes left and what was granted."""
    changes, groups = _stored_changes(spark, folder), _stored_groups(spark, folder)
    kept = members.permission_revokes(fx.existing_grants(spark, folder), changes, groups)
    granted = members.permission_grants(changes, fx.USERS_RUN_TS).select(*kept.columns)
    return kept.unionByName(granted)


def group_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How many users hold each group after the run."""
    return members.group_sizes(permission_state(spark, folder), _stored_groups(spark, folder))


def portal_users(spark: SparkSession, folder: str) -> DataFrame:
    return members.portal_users(user_changes(spark, folder), fx.USERS_RUN_TS)


def product_grants(spark: SparkSession, folder: str) -> DataFrame:
    return members.product_grants(user_changes(spark, folder), fx.USERS_RUN_TS)


def _user_master(spark: SparkSession, folder: str) -> DataFrame:
    return fx.previous_users(spark, folder).select(
        F.col("USER_ID").alias("usr_id"), F.col("USER_NM").alias("usr_nm"), F.col("PART_CODE").alias("usr_desc")
    )


def user_rows_revoked(spark: SparkSession, folder: str) -> DataFrame:
    return members.revoke_rows(_user_master(spark, folder), user_changes(spark, folder))


def user_transfer_update(spark: SparkSession, folder: str) -> DataFrame:
    return members.apply_transfer(_user_master(spark, folder), user_changes(spark, folder))


def user_audit_log(spark: SparkSession, folder: str) -> DataFrame:
    return members.audit_log(user_changes(spark, folder), fx.USERS_RUN_TS)


QUERIES = {
    "user_changes": user_changes,
    "snapshot_rotation": snapshot_rotation,
    "user_intervals": user_intervals,
    "user_snapshot_restored": user_snapshot_restored,
    "order_departments": order_departments,
    "permission_grants": permission_grants,
    "permission_revokes": permission_revokes,
    "permission_state": permission_state,
    "group_sizes": group_sizes,
    "portal_users": portal_users,
    "product_grants": product_grants,
    "user_rows_revoked": user_rows_revoked,
    "user_transfer_update": user_transfer_update,
    "user_audit_log": user_audit_log,
}

_ROLES = ", ".join(f"('{code}', '{group}')" for group, codes in members.ROLE_GROUPS.items() for code in codes)
_GRANTS = f"""
joined AS (SELECT USER_ID, PART_CODE FROM changes WHERE CHANGE IN ('NEW', 'ACTIVATED')),
roles(department, role) AS (VALUES {_ROLES}),
granted AS (
  SELECT '9001' AS GROUP_CODE, 'GROUP' AS rule, USER_ID AS usr_id FROM joined
  UNION ALL
  SELECT role, 'GROUP', USER_ID FROM changes JOIN roles ON department = PART_CODE WHERE CHANGE IN ('NEW', 'ACTIVATED', 'TRANSFERRED')
  UNION ALL
  SELECT PART_CODE, 'GROUP', USER_ID FROM joined
  UNION ALL
  SELECT PART_CODE, 'OTHER_DATA_GROUPS', USER_ID FROM joined WHERE PART_CODE IS NOT NULL
  UNION ALL
  SELECT 'T', 'GROUP', USER_ID FROM joined)
"""
_KEPT = """
kept AS (
  SELECT * FROM grants
  WHERE usr_id NOT IN (SELECT USER_ID FROM changes WHERE CHANGE IN ('NEW', 'ACTIVATED', 'LEFT'))
    AND NOT (usr_id IN (SELECT USER_ID FROM changes WHERE CHANGE = 'TRANSFERRED') AND GROUP_CODE <> '9001'
             AND rule = 'GROUP' AND GROUP_CODE NOT IN (SELECT group_code FROM groups WHERE group_desc LIKE '%,data')))
"""
# Every grant written out, as the rules stand for them.
_HELD = """
state AS (SELECT * FROM kept UNION ALL SELECT * FROM granted),
held AS (
  SELECT GROUP_CODE FROM state WHERE rule = 'GROUP'
  UNION ALL
  SELECT g.group_code FROM groups g JOIN state s ON g.group_code <> s.GROUP_CODE
  WHERE s.rule <> 'GROUP' AND g.group_desc LIKE '%,data' AND g.group_code <> 'T')
"""
_CHANGES = f"WITH {fx.USER_CTES}"
_NOW = f"TIMESTAMP '{fx.USERS_RUN_TS}'"

_DAILY = f"""WITH days AS (SELECT unnest(range({DAYS})) AS n),
daily AS (
  SELECT c_custkey AS USER_KEY, CASE WHEN c_custkey % 20 < {DAYS} AND n >= c_custkey % 20 THEN (c_custkey + 3) % 40 + 1 ELSE c_custkey % 40 + 1 END AS PART_CODE,
         CASE WHEN c_custkey % 23 <> 0 THEN 'Y' END AS BI_USE_YN, n, CAST(DATE '{FIRST_DAY}' + to_days(CAST(n AS INTEGER)) AS DATE) AS day_
  FROM customer, days WHERE (c_custkey + n) % 11 <> 0)"""

ORACLES = {
    "user_intervals": f"""{_DAILY},
islands AS (SELECT *, n - ROW_NUMBER() OVER (PARTITION BY USER_KEY, PART_CODE, BI_USE_YN ORDER BY n) AS island FROM daily)
SELECT USER_KEY, PART_CODE, BI_USE_YN, CAST(1 AS INTEGER) AS COPIES, MIN(day_) AS VALID_FROM,
       CASE WHEN MAX(n) < {DAYS - 1} THEN CAST(MAX(day_) + INTERVAL 1 DAY AS DATE) END AS VALID_TO
FROM islands GROUP BY USER_KEY, PART_CODE, BI_USE_YN, island""",
    "user_snapshot_restored": f"{_DAILY} SELECT USER_KEY, PART_CODE, BI_USE_YN FROM daily WHERE day_ = DATE '{LOOK_BACK}'",
    "order_departments": f"""{_DAILY}
SELECT o_orderkey, o_custkey AS USER_KEY, o_orderdate, PART_CODE FROM orders
LEFT JOIN daily ON USER_KEY = o_custkey AND day_ = CAST(o_orderdate AS DATE)""",
    "user_changes": f"{_CHANGES} SELECT * FROM changes",
    "snapshot_rotation": f"{_CHANGES} SELECT CHANGE, COUNT(*) AS users FROM changes GROUP BY CHANGE",
    "permission_grants": f"{_CHANGES}, {_GRANTS} SELECT *, 'SYSTEM' AS creator, {_NOW} AS created FROM granted",
    "permission_revokes": f"{_CHANGES}, {_KEPT} SELECT * FROM kept",
    "permission_state": f"{_CHANGES}, {_KEPT}, {_GRANTS} SELECT * FROM kept UNION ALL SELECT * FROM granted",
    "group_sizes": f"{_CHANGES}, {_KEPT}, {_GRANTS}, {_HELD} SELECT GROUP_CODE, COUNT(*) AS holders FROM held GROUP BY GROUP_CODE",
    "portal_users": f"""{_CHANGES}
SELECT USER_ID AS usr_id, USER_NM AS usr_nm, CAST(NULL AS VARCHAR) AS reserved_1, strftime({_NOW}, '%Y-%m-%d') AS joined_day,
       CAST(0 AS INTEGER) AS failures, 'ko' AS language, PART_CODE AS usr_desc, CAST(NULL AS VARCHAR) AS reserved_2,
       {_NOW} AS password_time, 'Y' AS in_use, 'SYSTEM' AS creator, {_NOW} AS created, 'SYSTEM' AS changer, {_NOW} AS changed
FROM changes WHERE CHANGE IN ('NEW', 'ACTIVATED')""",
    "product_grants": f"""{_CHANGES}
SELECT 'dashboard' AS product, USER_ID AS usr_id, 'SYSTEM' AS creator, {_NOW} AS created
FROM changes WHERE CHANGE IN ('NEW', 'ACTIVATED')""",
    "user_rows_revoked": f"""{_CHANGES}
SELECT USER_ID AS usr_id, USER_NM AS usr_nm, PART_CODE AS usr_desc FROM prev
WHERE USER_ID NOT IN (SELECT USER_ID FROM changes WHERE CHANGE IN ('NEW', 'ACTIVATED', 'LEFT'))""",
    "user_transfer_update": f"""{_CHANGES}
SELECT p.USER_ID AS usr_id, p.USER_NM AS usr_nm, COALESCE(m.PART_CODE, p.PART_CODE) AS usr_desc
FROM prev p LEFT JOIN (SELECT * FROM changes WHERE CHANGE = 'TRANSFERRED') m ON p.USER_ID = m.USER_ID""",
    "user_audit_log": f"""{_CHANGES}
SELECT USER_ID AS usr_id, CASE CHANGE WHEN 'TRANSFERRED' THEN 'TRANSFER' WHEN 'LEFT' THEN 'DELETE' ELSE 'NEW' END AS action,
       {_NOW} AS action_time
FROM changes""",
}
