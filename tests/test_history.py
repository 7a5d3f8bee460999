from datetime import date, datetime

from helpers import TS, frame, values

from quayside.operators import history
from quayside.sources import sinks

SCHEMA = "k int, RDATETIME timestamp_ntz"
ROWS = [(1, datetime(2021, 12, 31, 23, 59)), (2, datetime(2022, 1, 1)), (3, datetime(2023, 12, 31, 23, 59)), (4, datetime(2024, 1, 1)), (5, None)]


def test_years(spark):
    source = frame(spark, SCHEMA, *ROWS)
    assert values(history.historical_load(source, 2022, 2023, TS), "k", "LOAD_YEAR", "MIG_DATETIME") == [(2, 2022, TS), (3, 2023, TS)]
    assert values(history.unplaced_rows(source, 2022, 2023)) == [("AFTER", 1), ("BEFORE", 1), ("NO_DATE", 1)]


def test_source_without_dates_is_loaded_once(spark):
    loaded = history.historical_load(frame(spark, "k int", (1,), (2,)), 2022, 2023, TS)
    assert values(loaded, "k", "LOAD_YEAR") == [(1, None), (2, None)]


def test_snapshot_of_a_day(spark, tmp_path):
    path = str(tmp_path / "users")
    for day, key in ((date(2024, 1, 9), 1), (date(2024, 1, 10), 2), (date(2024, 1, 10), 3)):
        sinks.replace_partitions(history.snapshot_of(frame(spark, "k int", (key,)), day), path, ["SNAPSHOT_DATE"])
    current, previous = history.snapshot_pair(spark.read.parquet(path), date(2024, 1, 10))
    assert (values(current), values(previous)) == ([(3,)], [(1,)])
