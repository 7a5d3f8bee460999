"""Department sales of two systems, compared within a tolerance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import error_mark

# Departments and product classes in the check, and the tolerance.
DEPARTMENTS = (1, 3, 4, 5, 6, 7, 8, 9, 26, 27, 40)
PRODUCT_CLASSES = ("060001", "060002", "060003", "060004")
TOLERANCE = 0.001

KEYS = ["PART_CODE", "PART_NM"]
METRICS = ["ORDER_AMOUNT", "ORDER_MONEY", "CUSTOMER_CNT"]
# The system whose figure the tolerance is taken of, per metric.
REFERENCE_SIDE = {"ORDER_AMOUNT": "a", "ORDER_MONEY": "b", "CUSTOMER_CNT": "b"}


def month_to_yesterday(as_of: date) -> tuple[date, date]:
    """First day of yesterday's month, and yesterday."""
    yesterday = as_of - timedelta(days=1)
    return yesterday.replace(day=1), yesterday


def _number(column: str) -> Column:
    return F.col(column).cast("double")


def _or_zero(column: str) -> Column:
    return F.coalesce(_number(column), F.lit(0.0))


def sales_metrics(
    fact: DataFrame,
    customers: DataFrame,
    start: date,
    end: date,
    departments: Sequence[int] = DEPARTMENTS,
    classes: Sequence[str] = PRODUCT_CLASSES,
) -> DataFrame:
    """Sales, profit and number of buying customers per department, ``start`` to ``end`` inclusive.

    Sales treat a missing return as 0. Profit does not: a row with a missing return, order cost
    or return cost is left out of that part. The fact rows are summed per customer before they
    meet the departments, so the join moves one row per customer.
    """
    in_scope = fact.where(
        F.col("GT_PRODUCT_DETAIL_DE").isin(*classes)
        & F.col("PAY_DAY").between(F.lit(start.isoformat()).cast("date"), F.lit(end.isoformat()).cast("date"))
    )
    ordered = _number("PRO_ORDER_AMOUNT") - _or_zero("ORDER_UNIT_SALES_DC")
    per_customer = in_scope.groupBy("CUSTOMER_CODE").agg(
        F.sum(ordered).alias("_ordered"),
        F.sum(_or_zero("RETURN_MONEY") - _or_zero("DC_RETURN_AMOUNT")).alias("_returned"),
        F.sum(ordered - _number("ORD_COST")).alias("_order_profit"),
        F.sum(_number("RETURN_MONEY") - _or_zero("DC_RETURN_AMOUNT") - _number("VRY_COST")).alias("_return_profit"),
    )
    staffed = customers.where(F.col("PART_CODE").isin(*departments)).select("CUSTOMER_CODE", *KEYS)
    return (
        per_customer.join(staffed, "CUSTOMER_CODE")
        .groupBy(*KEYS)
        .agg(
            (F.coalesce(F.sum("_ordered"), F.lit(0.0)) - F.sum("_returned")).alias("ORDER_AMOUNT"),
            (F.sum("_order_profit") - F.sum("_return_profit")).alias("ORDER_MONEY"),
            F.countDistinct("CUSTOMER_CODE").alias("CUSTOMER_CNT"),
        )
    )


def compare_metrics(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str] = tuple(KEYS),
    metrics: Sequence[str] = tuple(METRICS),
    tolerance: float = TOLERANCE,
    reference_side: Mapping[str, str] = REFERENCE_SIDE,
    compat: bool = False,
) -> DataFrame:
    """Both systems' figures per key, their difference and ``Error`` where it exceeds the tolerance.

    Keys match also where both are NULL. The tolerance is a share of the absolute figure of the
    reference side; ``compat`` takes the figure with its sign, so a negative one is always an
    error. Figures are compared first and cut to whole numbers afterwards.
    """
    left, right = a.alias("a"), b.alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    columns = [F.col(f"a.{k}").alias(k) for k in keys]
    for metric in metrics:
        ours, theirs = F.col(f"a.{metric}"), F.col(f"b.{metric}")
        reference = ours if reference_side[metric] == "a" else theirs
        reference = reference if compat else F.abs(reference)
        difference = ours.cast("double") - theirs.cast("double")
        columns += [
            ours.cast("bigint").alias(f"{metric}_A"),
            theirs.cast("bigint").alias(f"{metric}_B"),
            difference.cast("bigint").alias(f"{metric}_DIFF"),
            error_mark(F.abs(difference) > reference.cast("double") * tolerance).alias(f"{metric}_CHECK"),
        ]
    return left.join(right, condition).select(*columns).orderBy(*keys)
