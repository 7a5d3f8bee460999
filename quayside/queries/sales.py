"""Sales figures of two systems, compared."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import verify
from quayside.plans.settle import settle
from quayside.sources.scans import table

AS_OF = date(2001, 8, 1)
START, END = verify.month_to_yesterday(AS_OF)


def order_fact(spark: SparkSession, folder: str) -> DataFrame:
    """An order and return fact. Discounts, returns and costs are missing in places."""
    price = F.col("l_extendedprice")
    returned = F.when(F.col("l_returnflag") == "R", price * 0.1)
    return (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("CUSTOMER_CODE"),
            price.alias("PRO_ORDER_AMOUNT"),
            F.when(F.col("l_linenumber") != 1, price * F.col("l_discount")).alias("ORDER_UNIT_SALES_DC"),
            returned.alias("RETURN_MONEY"),
            (returned * F.col("l_discount")).alias("DC_RETURN_AMOUNT"),
            F.when(F.col("l_orderkey") % 50 != 0, F.col("l_quantity") * 100).alias("ORD_COST"),
            F.when(F.col("l_returnflag") == "R", F.col("l_quantity") * 10).alias("VRY_COST"),
            F.concat(F.lit("06000"), (F.col("l_suppkey") % 6).cast("string")).alias("GT_PRODUCT_DETAIL_DE"),
            F.to_date("o_orderdate").alias("PAY_DAY"),
        )
    )


def customer_departments(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("CUSTOMER_CODE"),
            (F.col("c_nationkey") + 1).alias("PART_CODE"),
            F.col("n_name").alias("PART_NM"),
        )
    )


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return verify.sales_metrics(order_fact(spark, folder), customer_departments(spark, folder), START, END)


def _other_system(metrics: DataFrame) -> DataFrame:
    """The other system's figures: 0.2 % higher in every fifth department."""
    factor = F.when(F.col("PART_CODE") % 5 == 0, F.lit(1.002)).otherwise(F.lit(1.0))
    return metrics.withColumns({m: F.col(m) * factor for m in ("ORDER_AMOUNT", "ORDER_MONEY")})


def sales_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _metrics(spark, folder).withColumns(
        {m: F.round(m, 2) for m in ("ORDER_AMOUNT", "ORDER_MONEY")}
    )


def sales_metric_verify(spark: SparkSession, folder: str) -> DataFrame:
    ours = settle(_metrics(spark, folder), "metrics")
    return verify.compare_metrics(_other_system(ours), ours)


def sales_metric_verify_compat(spark: SparkSession, folder: str) -> DataFrame:
    ours = settle(_metrics(spark, folder), "metrics")
    return verify.compare_metrics(_other_system(ours), ours, compat=True)


def _with_losses(metrics: DataFrame) -> DataFrame:
    """Every second department has made a loss."""
    loss = F.when(F.col("PART_CODE") % 2 == 0, -F.abs("ORDER_MONEY")).otherwise(F.col("ORDER_MONEY"))
    return metrics.withColumn("ORDER_MONEY", loss)


def sales_metric_verify_losses(spark: SparkSession, folder: str) -> DataFrame:
    ours = settle(_with_losses(_metrics(spark, folder)), "metrics")
    return verify.compare_metrics(ours, ours)


def sales_metric_verify_losses_compat(spark: SparkSession, folder: str) -> DataFrame:
    """As the original took the tolerance of a figure with its sign: every loss is an error."""
    ours = settle(_with_losses(_metrics(spark, folder)), "metrics")
    return verify.compare_metrics(ours, ours, compat=True)


QUERIES = {
    "sales_metrics": sales_metrics,
    "sales_metric_verify": sales_metric_verify,
    "sales_metric_verify_compat": sales_metric_verify_compat,
    "sales_metric_verify_losses": sales_metric_verify_losses,
    "sales_metric_verify_losses_compat": sales_metric_verify_losses_compat,
}

_DEPARTMENTS = ", ".join(str(d) for d in verify.DEPARTMENTS)
_CLASSES = ", ".join(f"'{c}'" for c in verify.PRODUCT_CLASSES)
_METRICS = f"""
fact AS (
  SELECT o_custkey AS customer, l_extendedprice AS amount,
         CASE WHEN l_linenumber <> 1 THEN l_extendedprice * l_discount END AS dc,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice * 0.1::DOUBLE END AS ret,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice * 0.1::DOUBLE * l_discount END AS ret_dc,
         CASE WHEN l_orderkey % 50 <> 0 THEN l_quantity * 100 END AS cost,
         CASE WHEN l_returnflag = 'R' THEN l_quantity * 10 END AS ret_cost,
         '06000' || (l_suppkey % 6) AS class, CAST(o_orderdate AS DATE) AS pay_day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
b AS (
  SELECT c_nationkey + 1 AS PART_CODE, n_name AS PART_NM,
         COALESCE(SUM(amount - COALESCE(dc, 0)), 0) - SUM(COALESCE(ret, 0) - COALESCE(ret_dc, 0)) AS ORDER_AMOUNT,
         SUM(amount - COALESCE(dc, 0) - cost) - SUM(ret - COALESCE(ret_dc, 0) - ret_cost) AS ORDER_MONEY,
         COUNT(DISTINCT customer) AS CUSTOMER_CNT
  FROM fact JOIN customer ON customer = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE class IN ({_CLASSES}) AND c_nationkey + 1 IN ({_DEPARTMENTS}) AND pay_day BETWEEN DATE '{START}' AND DATE '{END}'
  GROUP BY ALL),
a AS (
  SELECT PART_CODE, PART_NM, ORDER_AMOUNT * CASE WHEN PART_CODE % 5 = 0 THEN 1.002::DOUBLE ELSE 1 END AS ORDER_AMOUNT,
         ORDER_MONEY * CASE WHEN PART_CODE % 5 = 0 THEN 1.002::DOUBLE ELSE 1 END AS ORDER_MONEY, CUSTOMER_CNT
  FROM b)
"""


_LOSSES = """,
l AS (SELECT * REPLACE (CASE WHEN PART_CODE % 2 = 0 THEN -abs(ORDER_MONEY) ELSE ORDER_MONEY END AS ORDER_MONEY) FROM b)"""


def _verify_sql(absolute: str, losses: bool = False) -> str:
    checks = []
    for metric, side in (("ORDER_AMOUNT", "a"), ("ORDER_MONEY", "b"), ("CUSTOMER_CNT", "b")):
        checks.append(
            f"CAST(trunc(a.{metric}) AS BIGINT) AS {metric}_A, CAST(trunc(b.{metric}) AS BIGINT) AS {metric}_B, "
            f"CAST(trunc(a.{metric} - b.{metric}) AS BIGINT) AS {metric}_DIFF, "
            f"CASE WHEN abs(a.{metric} - b.{metric}) > {absolute}({side}.{metric}) * 0.001 THEN 'Error' ELSE '' END AS {metric}_CHECK"
        )
    return (
        f"WITH {_METRICS}{_LOSSES * losses} SELECT a.PART_CODE, a.PART_NM, {', '.join(checks)} FROM {'l a JOIN l b' if losses else 'a JOIN b'} "
        "ON a.PART_CODE IS NOT DISTINCT FROM b.PART_CODE AND a.PART_NM IS NOT DISTINCT FROM b.PART_NM"
    )


ORACLES = {
    "sales_metrics": f"""WITH {_METRICS}
SELECT PART_CODE, PART_NM, ROUND(ORDER_AMOUNT, 2) AS ORDER_AMOUNT, ROUND(ORDER_MONEY, 2) AS ORDER_MONEY, CUSTOMER_CNT FROM b""",
    "sales_metric_verify": _verify_sql("abs"),
    "sales_metric_verify_compat": _verify_sql(""),
    "sales_metric_verify_losses": _verify_sql("abs", losses=True),
    "sales_metric_verify_losses_compat": _verify_sql("", losses=True),
}
