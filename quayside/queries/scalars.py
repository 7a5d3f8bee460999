"""Scalar functions on every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import dates, text
from quayside.queries import fixtures as fx
from quayside.sources.scans import table


def scalar_dates(spark: SparkSession, folder: str) -> DataFrame:
    at = F.col("o_orderdate")
    later = F.timestamp_add("SECOND", (F.col("o_orderkey") % 86400).cast("int"), at)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dates.month_label(at).alias("month_label"),
        dates.day_label(at).alias("day_label"),
        F.date_add(F.to_date(at), -1).alias("day_before"),
        F.add_months(F.to_date(at), -12).alias("year_before"),
        F.to_date(F.trunc(at, "month")).alias("month_start"),
        F.last_day(F.to_date(at)).alias("month_end"),
        F.to_date(at).alias("day"),
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        F.hour(later).alias("hour"),
        F.datediff(dates.day_literal(fx.AS_OF), F.to_date(at)).cast("bigint").alias("age_days"),
        F.to_timestamp_ntz(F.concat(dates.day_label(at), F.lit(" 03:00:00")), F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed"),
        (dates.clock_seconds(F.lit("23:59:59")) - dates.clock_seconds(dates.clock_label(later))).cast("bigint").alias("seconds_left"),
        dates.in_days(at, fx.WINDOW_START, fx.AS_OF).alias("in_window"),
        dates.ntz(fx.RUN_TS).alias("run_ts"),
    )


def scalar_text_numeric(spark: SparkSession, folder: str) -> DataFrame:
    discount = F.when(F.col("l_linenumber") != 1, F.col("l_discount"))
    job = F.concat(F.lit("MART_"), F.col("l_returnflag"), F.when(F.col("l_linenumber") % 2 == 0, F.lit("_1D")).otherwise(F.lit("_X")))
    group = F.when(F.col("l_suppkey").isin(1, 3, 5), F.lit("a")).when(F.col("l_suppkey") == 12, F.lit("b")).otherwise(F.lit("c"))
    difference = F.col("l_quantity") * 1.5 - F.col("l_tax") * 1000
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.coalesce(discount, F.lit(0.0)).alias("discount"),
        group.alias("group_code"),
        text.error_mark(F.abs(difference) > F.col("l_extendedprice") * 0.001).alias("check"),
        difference.cast("int").alias("cut"),
        (-difference).alias("negated"),
        F.abs(difference).alias("absolute"),
        text.key_text(["l_orderkey", "l_linenumber"]).alias("key_text"),
        F.left(job, F.lit(6)).alias("prefix"),
        text.swap_suffix(job, "_1D", "_M").alias("monthly_name"),
        text.whole_number(F.substring(F.concat(F.col("l_returnflag"), F.col("l_partkey").cast("string")), 2, 20)).alias("number"),
        text.whole_number(F.concat(F.col("l_returnflag"), F.col("l_partkey").cast("string"))).alias("no_number"),
    )


QUERIES = {"scalar_dates": scalar_dates, "scalar_text_numeric": scalar_text_numeric}

ORACLES = {
    "scalar_dates": f"""WITH o AS (SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS later FROM orders)
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_label, strftime(o_orderdate, '%Y-%m-%d') AS day_label,
       CAST(o_orderdate AS DATE) - 1 AS day_before, CAST(o_orderdate - INTERVAL 12 MONTH AS DATE) AS year_before,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, last_day(CAST(o_orderdate AS DATE)) AS month_end,
       CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(hour(later) AS INTEGER) AS hour, CAST(date_diff('day', o_orderdate, TIMESTAMP '{fx.AS_OF}') AS BIGINT) AS age_days,
       date_trunc('day', o_orderdate) + INTERVAL 3 HOUR AS parsed,
       CAST(86399 - (hour(later) * 3600 + minute(later) * 60 + second(later)) AS BIGINT) AS seconds_left,
       o_orderdate >= TIMESTAMP '{fx.WINDOW_START}' AND o_orderdate < TIMESTAMP '{fx.AS_OF}' AS in_window,
       TIMESTAMP '{fx.RUN_TS}' AS run_ts
FROM o""",
    "scalar_text_numeric": """WITH l AS (
  SELECT *, l_quantity * 1.5::DOUBLE - l_tax * 1000 AS difference,
         'MART_' || l_returnflag || CASE WHEN l_linenumber % 2 = 0 THEN '_1D' ELSE '_X' END AS job FROM lineitem)
SELECT l_orderkey, l_linenumber, COALESCE(CASE WHEN l_linenumber <> 1 THEN l_discount END, 0) AS discount,
       CASE WHEN l_suppkey IN (1, 3, 5) THEN 'a' WHEN l_suppkey = 12 THEN 'b' ELSE 'c' END AS group_code,
       CASE WHEN abs(difference) > l_extendedprice * 0.001::DOUBLE THEN 'Error' ELSE '' END AS "check",
       CAST(trunc(difference) AS INTEGER) AS cut, -difference AS negated, abs(difference) AS absolute,
       l_orderkey || '|' || l_linenumber AS key_text, "left"(job, 6) AS prefix,
       regexp_replace(job, '_1D$', '_M') AS monthly_name,
       TRY_CAST(substr(l_returnflag || l_partkey, 2, 20) AS BIGINT) AS number,
       TRY_CAST(l_returnflag || l_partkey AS BIGINT) AS no_number
FROM l""",
}
