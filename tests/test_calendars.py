import random
from datetime import date, datetime, timedelta

from helpers import TS, frame, values

from quayside.functions.dates import month_end, shift_months
from quayside.operators import calendars

AS_OF = date(2024, 3, 15)
CLOSE = "CLOSE_YYYY_MM string, BI_CLOSE_YN string, BI_CLOSE_DAY timestamp_ntz"


def closed(spark, *open_rows):
    known = {r[0] for r in open_rows}
    months = [shift_months(AS_OF, -i).strftime("%Y-%m") for i in range(24)]
    return frame(spark, CLOSE, *[(m, "Y", datetime(2020, 1, 1)) for m in months if m not in known], *[r for r in open_rows if r[1] != "absent"])


def chosen(spark, *rows, **options):
    return values(calendars.open_month(closed(spark, *rows), AS_OF, **options))


def test_month_arithmetic():
    assert shift_months(date(2024, 1, 31), -1) == date(2023, 12, 1)
    assert month_end(date(2024, 2, 10)) == date(2024, 2, 29)
    assert month_end(date(2024, 12, 10), 2) == date(2025, 2, 28)


def test_spine(spark):
    months = values(calendars.month_spine(spark, AS_OF))
    assert (months[0], months[-1], len(months)) == ((date(2022, 4, 1),), (date(2024, 3, 1),), 24)


def test_open_months(spark):
    assert chosen(spark) == []
    assert chosen(spark, ("2024-02", "N", None), ("2024-03", "N", None)) == [("2024-02", date(2024, 2, 1), date(2024, 2, 29))]
    assert chosen(spark, ("2023-11", "absent", None))[0][0] == "2023-11"
    assert chosen(spark, ("2023-11", None, None))[0][0] == "2023-11"
    assert chosen(spark, ("2024-01", "Y", datetime(2024, 3, 14, 18)))[0][0] == "2024-01"
    assert chosen(spark, ("2023-12", "N", None), ("2024-03", "N", None), min_year=2024)[0][0] == "2024-03"


def test_balances_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["hot"] * 5 + ["a", "b", None]), datetime(2021, 12, 1) + timedelta(hours=rng.randrange(24 * 900)), rng.randrange(-50, 100))
        for _ in range(400)
    ]
    rows += [("edge", datetime(2024, 3, 31, 23, 59), 1), ("edge", datetime(2024, 4, 1), 5), ("empty", datetime(2024, 1, 1), None)]
    found = calendars.month_end_snapshots(frame(spark, "k string, t timestamp_ntz, v bigint", *rows), ["k"], "t", "v", AS_OF, TS)
    expected = []
    for tick in range(25):
        end = month_end(AS_OF, -tick)
        due = [r for r in rows if r[1].date() <= end]
        for key in {r[0] for r in due}:
            amounts = [r[2] for r in due if r[0] == key and r[2] is not None]
            expected.append((key, sum(amounts) if amounts else None, end.strftime("%Y-%m")))
    assert values(found, "k", "BALANCE", "CHECK_MONTH") == sorted(expected, key=lambda r: [(v is not None, v) for v in r])


def test_sizes_add_up(spark):
    rows = frame(spark, "CHECK_MONTH string", ("2024-01",), ("2024-02",), ("2024-02",))
    assert values(calendars.snapshot_sizes(rows)) == [("2024-01", 1, 1), ("2024-02", 2, 3)]
