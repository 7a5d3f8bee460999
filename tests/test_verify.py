from datetime import date

from helpers import frame, values

from quayside.operators import verify

FACT = (
    "CUSTOMER_CODE bigint, PRO_ORDER_AMOUNT double, ORDER_UNIT_SALES_DC double, RETURN_MONEY double, "
    "DC_RETURN_AMOUNT double, ORD_COST double, VRY_COST double, GT_PRODUCT_DETAIL_DE string, PAY_DAY date"
)
DAY = date(2024, 1, 5)
METRICS = "PART_CODE int, PART_NM string, ORDER_AMOUNT double, ORDER_MONEY double, CUSTOMER_CNT bigint"


def test_period():
    assert verify.month_to_yesterday(date(2024, 3, 1)) == (date(2024, 2, 1), date(2024, 2, 29))


def test_missing_figures(spark):
    fact = frame(
        spark, FACT,
        (1, 100.0, None, None, None, 40.0, None, "060001", DAY),  # no return: counts for sales, not for return profit
        (1, 50.0, 10.0, 20.0, 5.0, None, 2.0, "060002", DAY),  # no order cost: left out of order profit
        (2, None, 3.0, None, None, 1.0, 1.0, "060001", DAY),
        (3, 7.0, None, None, None, 1.0, 1.0, "060009", DAY),
        (3, 7.0, None, None, None, 1.0, 1.0, "060001", date(2024, 1, 6)),
        (4, 7.0, None, None, None, 1.0, 1.0, "060001", DAY),
    )
    customers = frame(spark, "CUSTOMER_CODE bigint, PART_CODE int, PART_NM string", (1, 1, "one"), (2, 1, "one"), (3, 1, "one"), (4, 2, "two"))
    found = verify.sales_metrics(fact, customers, date(2024, 1, 1), DAY)
    assert values(found) == [(1, "one", 100.0 + 40.0 - 15.0, 60.0 - 13.0, 2)]


def checks(spark, a, b, **options):
    found = verify.compare_metrics(frame(spark, METRICS, a), frame(spark, METRICS, b), **options)
    return tuple(found.select("ORDER_AMOUNT_CHECK", "ORDER_MONEY_CHECK", "CUSTOMER_CNT_CHECK").first())


def test_tolerance_is_strict(spark):
    assert checks(spark, (1, "x", 1000.0, 999.0, 5), (1, "x", 999.0, 1000.0, 5)) == ("", "", "")
    assert checks(spark, (1, "x", 1000.0, 998.0, 5), (1, "x", 998.0, 1000.0, 4)) == ("Error", "Error", "Error")


def test_negative_reference(spark):
    same = (1, "x", -1000.0, -1000.0, 5)
    assert checks(spark, same, same) == ("", "", "")
    assert checks(spark, same, same, compat=True) == ("Error", "Error", "")


def test_missing_names_match_and_figures_are_cut(spark):
    found = verify.compare_metrics(frame(spark, METRICS, (1, None, -1.7, 1.7, 1)), frame(spark, METRICS, (1, None, -1.7, 1.7, 1)))
    assert values(found, "ORDER_AMOUNT_A", "ORDER_MONEY_B") == [(-1, 1)]
