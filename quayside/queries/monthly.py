"""Mart refreshes, monthly rolls, the accounting month and period snapshots."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.dates import month_label, ntz
from quayside.operators import calendars, marts, snapshots
from quayside.plans import mart_load, publish
from quayside.plans.settle import settle
from quayside.queries import fixtures as fx
from quayside.sources.scans import named_result, table

YESTERDAY = fx.AS_OF - timedelta(days=1)


def part_view(spark: SparkSession, folder: str) -> DataFrame:
    """A mart view: sales by part up to now, under this month."""
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("lines"))
        .withColumns({"CHECK_MONTH": F.lit(fx.AS_OF.strftime("%Y-%m")), "ADATETIME": ntz(fx.RUN_TS)})
    )


def part_history(spark: SparkSession, folder: str) -> DataFrame:
    """Sales by part and ship month. The last months were loaded yesterday, the others long ago."""
    month = month_label(F.col("l_shipdate"))
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", month.alias("CHECK_MONTH"))
        .agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("lines"))
        .withColumn("ADATETIME", F.when(F.col("CHECK_MONTH") >= "2001-07", ntz(YESTERDAY)).otherwise(ntz(fx.OLD_TS)))
    )


def _refresh(spark: SparkSession, folder: str, flag: str, times: int = 1) -> DataFrame:
    """The mart PART_SALES of a run of its own, whose history holds the sales by month; copied, and the tables dropped."""
    job = f"part_sales_{uuid.uuid4().hex}{marts.DAILY_SUFFIX}"
    name = marts.history_name(job, marts.mode_of(flag))
    try:
        if marts.mode_of(flag) != "replace":
            mart_load.store_history(part_history(spark, folder), name)
        for _ in range(times):
            done = mart_load.refresh_stored(part_view(spark, folder), job, flag, fx.AS_OF, run="2001-08-02")
        return settle(done.table if done.history is None else done.history, "mart")
    finally:
        for table_name in {job, name}:
            publish.drop(spark, table_name)


def mart_replace(spark: SparkSession, folder: str) -> DataFrame:
    return _refresh(spark, folder, "N")


def mart_accumulate(spark: SparkSession, folder: str) -> DataFrame:
    return _refresh(spark, folder, "O")


def mart_accumulate_month(spark: SparkSession, folder: str) -> DataFrame:
    return _refresh(spark, folder, "OO")


def mart_refresh_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """The run of a day carried out twice: its rows are in the history once."""
    return _refresh(spark, folder, "O", times=2)


def _type_counts(spark: SparkSession, folder: str, day: date) -> DataFrame:
    return (
        table(spark, folder, "part")
        .groupBy(F.concat(F.col("p_type"), F.lit("/"), F.col("p_brand")).alias("GT_PRODUCT_DETAIL_DE"), F.col("p_type").alias("GT_PRODUCT_DETAIL_DE_NM"))
        .agg(F.count(F.lit(1)).alias("PROD_CNT"))
        .withColumn("CHECK_DATE", F.lit(day.isoformat()).cast("date"))
    )


def _roll(spark: SparkSession, folder: str) -> marts.MonthlyRoll:
    daily = _type_counts(spark, folder, fx.AS_OF)
    monthly = _type_counts(spark, folder, fx.AS_OF).drop("CHECK_DATE").withColumn("CHECK_MONTH", F.lit("2001-06"))
    accumulated = (
        _type_counts(spark, folder, date(2001, 7, 31))
        .unionByName(_type_counts(spark, folder, YESTERDAY))
        .unionByName(daily)
    )
    return marts.monthly_roll(daily, monthly, accumulated, fx.AS_OF)


def monthly_roll(spark: SparkSession, folder: str) -> DataFrame:
    return _roll(spark, folder).monthly


def monthly_roll_accumulated(spark: SparkSession, folder: str) -> DataFrame:
    return _roll(spark, folder).accumulated


def close_table(spark: SparkSession, folder: str) -> DataFrame:
    """The months of the orders: closed up to 2001-05, which was closed yesterday; 2001-06 is unknown, later ones are open."""
    month = F.col("CLOSE_YYYY_MM")
    return (
        table(spark, folder, "orders")
        .select(month_label(F.trunc("o_orderdate", "month")).alias("CLOSE_YYYY_MM"))
        .distinct()
        .where(month != "2001-06")
        .withColumns(
            {
                "BI_CLOSE_YN": F.when(month <= "2001-05", F.lit("Y")).otherwise(F.lit("N")),
                "BI_CLOSE_DAY": F.when(month == "2001-05", ntz(YESTERDAY)).when(month < "2001-05", ntz(fx.OLD_TS)),
            }
        )
    )


def close_month_select(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.open_month(close_table(spark, folder), fx.AS_OF, min_year=2000)


def close_month_select_next_day(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.open_month(close_table(spark, folder), fx.AS_OF + timedelta(days=1), min_year=2000)


STOCK_START, STOCK_END = date(2001, 6, 1), date(2001, 6, 30)
STOCK_NAMES = ["part_code", "part_name", "sold", "amount", "returned", "shipped"]
ZERO_COLUMNS = ["sold", "amount", "returned"]


def stock_result(spark: SparkSession, folder: str) -> DataFrame:
    """A procedure's stock rows of one month: parts without movements have zeros, some have no figure."""
    shipped = F.col("l_shipdate")
    moved = (
        table(spark, folder, "lineitem")
        .where((shipped >= ntz(STOCK_START)) & (shipped < ntz(STOCK_END + timedelta(days=1))))
        .groupBy("l_partkey")
        .agg(
            F.sum("l_quantity").alias("sold"),
            F.round(F.sum("l_extendedprice"), 2).alias("amount"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("returned"),
            F.max("l_shipdate").alias("shipped"),
        )
    )
    missing = F.when(F.col("p_partkey") % 10 != 0, F.lit(0.0))
    rows = table(spark, folder, "part").join(moved, F.col("p_partkey") == F.col("l_partkey"), "left")
    figures = [F.coalesce(c, missing) for c in ZERO_COLUMNS]
    return rows.select("p_partkey", "p_name", *figures, "shipped")


def stock_snapshot_clean(spark: SparkSession, folder: str) -> DataFrame:
    named = named_result(stock_result(spark, folder), STOCK_NAMES)
    return snapshots.clean_snapshot(named, ZERO_COLUMNS, STOCK_START, STOCK_END, fx.RUN_TS)


def _append(spark: SparkSession, folder: str) -> marts.SnapshotAppend:
    # The reloads play today's snapshot; its rows are stamped after the first loads of their months.
    # Both are read from one stored table, as they are read twice: for the stale batches and for the rows that stay.
    loads, again = settle(fx.all_loads(spark, folder), "loads"), F.dayofmonth("MIG_DATETIME") == 2
    return marts.append_snapshot(loads.where(~again), loads.where(again), fx.BATCH_KEYS, date(2000, 1, 1))


def snapshot_append(spark: SparkSession, folder: str) -> DataFrame:
    return _append(spark, folder).monthly


def month_end_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    balances = calendars.month_end_snapshots(orders, ["o_custkey"], "o_orderdate", "o_totalprice", fx.AS_OF, fx.RUN_TS)
    return balances.withColumn("BALANCE", F.round("BALANCE", 2))


def _sparse(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.sparse_balances(table(spark, folder, "orders"), ["o_custkey"], "o_orderdate", "o_totalprice", fx.AS_OF)


def month_end_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Only the balances that changed in a month."""
    return _sparse(spark, folder).withColumn("BALANCE", F.round("BALANCE", 2))


def month_end_carried_forward(spark: SparkSession, folder: str) -> DataFrame:
    """All balances again, from the stored changes."""
    stored = settle(_sparse(spark, folder), "changes")
    return calendars.carried_forward(stored, ["o_custkey"], fx.AS_OF, fx.RUN_TS).withColumn("BALANCE", F.round("BALANCE", 2))


def month_end_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.snapshot_sizes(month_end_snapshots(spark, folder))


QUERIES = {
    "mart_replace": mart_replace,
    "mart_accumulate": mart_accumulate,
    "mart_accumulate_month": mart_accumulate_month,
    "mart_refresh_repeated": mart_refresh_repeated,
    "monthly_roll": monthly_roll,
    "monthly_roll_accumulated": monthly_roll_accumulated,
    "close_month_select": close_month_select,
    "close_month_select_next_day": close_month_select_next_day,
    "stock_snapshot_clean": stock_snapshot_clean,
    "snapshot_append": snapshot_append,
    "month_end_snapshots": month_end_snapshots,
    "month_end_sizes": month_end_sizes,
    "month_end_changes": month_end_changes,
    "month_end_carried_forward": month_end_carried_forward,
}

_MART = f"""
view_ AS (
  SELECT l_partkey, SUM(l_quantity) AS quantity, COUNT(*) AS lines, '2001-08' AS CHECK_MONTH,
         TIMESTAMP '{fx.RUN_TS}' AS ADATETIME
  FROM lineitem GROUP BY l_partkey),
history AS (
  SELECT l_partkey, SUM(l_quantity) AS quantity, COUNT(*) AS lines, strftime(l_shipdate, '%Y-%m') AS CHECK_MONTH,
         CASE WHEN strftime(l_shipdate, '%Y-%m') >= '2001-07' THEN TIMESTAMP '{YESTERDAY}' ELSE TIMESTAMP '{fx.OLD_TS}' END AS ADATETIME
  FROM lineitem GROUP BY ALL)
"""
_COUNTS = """
counts AS (SELECT p_type || '/' || p_brand AS GT_PRODUCT_DETAIL_DE, p_type AS GT_PRODUCT_DETAIL_DE_NM, COUNT(*) AS PROD_CNT
           FROM part GROUP BY ALL)
"""


def _close_sql(as_of: date) -> str:
    yesterday = as_of - timedelta(days=1)
    return f"""WITH months AS (
  SELECT strftime(m, '%Y-%m') AS month_ FROM (
    SELECT unnest(generate_series(TIMESTAMP '1999-09-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS m) WHERE year(m) >= 2000),
closed AS (
  SELECT month_ AS c, CASE WHEN month_ <= '2001-05' THEN 'Y' ELSE 'N' END AS yn,
         CASE WHEN month_ = '2001-05' THEN TIMESTAMP '{YESTERDAY}' WHEN month_ < '2001-05' THEN TIMESTAMP '{fx.OLD_TS}' END AS day_
  FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month_ FROM orders) WHERE month_ <> '2001-06'),
found AS (
  SELECT MIN(month_) AS CLOSE_YYYY_MM FROM months LEFT JOIN closed ON month_ = c
  WHERE COALESCE(yn, 'N') = 'N' OR (yn = 'Y' AND CAST(day_ AS DATE) = DATE '{yesterday}'))
SELECT CLOSE_YYYY_MM, CAST(CLOSE_YYYY_MM || '-01' AS DATE) AS START_DATE, last_day(CAST(CLOSE_YYYY_MM || '-01' AS DATE)) AS END_DATE
FROM found WHERE CLOSE_YYYY_MM IS NOT NULL"""


_BALANCES = f"""
ends AS (
  SELECT last_day(CAST(m AS DATE)) AS end_ FROM (
    SELECT unnest(generate_series(TIMESTAMP '1999-08-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS m)),
balances AS (
  SELECT o_custkey, ROUND(SUM(o_totalprice), 2) AS BALANCE, TIMESTAMP '{fx.RUN_TS}' AS ADATETIME,
         strftime(end_, '%Y-%m') AS CHECK_MONTH
  FROM orders JOIN ends ON o_orderdate < end_ + INTERVAL 1 DAY GROUP BY o_custkey, end_)
"""

ORACLES = {
    "mart_replace": f"WITH {_MART} SELECT * FROM view_",
    "mart_accumulate": f"WITH {_MART} SELECT * FROM history UNION ALL SELECT * FROM view_",
    "mart_refresh_repeated": f"WITH {_MART} SELECT * FROM history UNION ALL SELECT * FROM view_",
    "mart_accumulate_month": f"""WITH {_MART}
SELECT * FROM history WHERE NOT (CAST(ADATETIME AS DATE) = DATE '{YESTERDAY}' AND substr(CHECK_MONTH, 1, 7) = '2001-08')
UNION ALL SELECT * FROM view_""",
    "monthly_roll": f"""WITH {_COUNTS}
SELECT *, '2001-06' AS CHECK_MONTH FROM counts UNION ALL SELECT *, '2001-07' FROM counts""",
    "monthly_roll_accumulated": f"""WITH {_COUNTS}
SELECT *, DATE '{YESTERDAY}' AS CHECK_DATE FROM counts UNION ALL SELECT *, DATE '{fx.AS_OF}' FROM counts""",
    "close_month_select": _close_sql(fx.AS_OF),
    "close_month_select_next_day": _close_sql(fx.AS_OF + timedelta(days=1)),
    "stock_snapshot_clean": f"""WITH moved AS (
  SELECT l_partkey, SUM(l_quantity) AS sold, ROUND(SUM(l_extendedprice), 2) AS amount,
         SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned, MAX(l_shipdate) AS shipped
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '{STOCK_START}' AND l_shipdate < TIMESTAMP '{STOCK_END + timedelta(days=1)}'
  GROUP BY l_partkey),
rows_ AS (
  SELECT p_partkey AS part_code, p_name AS part_name,
         COALESCE(sold, CASE WHEN p_partkey % 10 <> 0 THEN 0.0 END) AS sold,
         COALESCE(amount, CASE WHEN p_partkey % 10 <> 0 THEN 0.0 END) AS amount,
         COALESCE(returned, CASE WHEN p_partkey % 10 <> 0 THEN 0.0 END) AS returned, shipped
  FROM part LEFT JOIN moved ON p_partkey = l_partkey)
SELECT *, '{STOCK_START}' AS START_DATE, '{STOCK_END}' AS END_DATE, TIMESTAMP '{fx.RUN_TS}' AS MIG_DATETIME
FROM rows_ WHERE (sold = 0 AND amount = 0 AND returned = 0) IS NOT TRUE""",
    "snapshot_append": f"""WITH {fx.BATCH_CTES},
loaded AS (SELECT * FROM batches WHERE day(MIG_DATETIME) = 1 OR MIG_DATETIME >= TIMESTAMP '2000-01-01'),
{fx.stale_stamps('loaded')}
SELECT * FROM loaded WHERE MIG_DATETIME NOT IN (SELECT MIG_DATETIME FROM stale)""",
    "month_end_snapshots": f"WITH {_BALANCES} SELECT * FROM balances",
    "month_end_carried_forward": f"WITH {_BALANCES} SELECT * FROM balances",
    "month_end_changes": f"""WITH {_BALANCES}
SELECT o_custkey, BALANCE, last_day(CAST(CHECK_MONTH || '-01' AS DATE)) AS END_DATE FROM balances
WHERE (o_custkey, CHECK_MONTH) IN (
  SELECT o_custkey, CASE WHEN o_orderdate < TIMESTAMP '1999-08-01' THEN '1999-08' ELSE strftime(o_orderdate, '%Y-%m') END FROM orders
  WHERE o_orderdate < TIMESTAMP '2001-09-01')""",
    "month_end_sizes": f"""WITH {_BALANCES}
SELECT CHECK_MONTH, COUNT(*) AS row_count, CAST(SUM(COUNT(*)) OVER (ORDER BY CHECK_MONTH) AS BIGINT) AS total_rows
FROM balances GROUP BY CHECK_MONTH""",
}
