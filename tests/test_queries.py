"""Every registered query against its SQL on the same tables."""

import math

import pytest

from quayside.queries import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()
EMPTY_AT_SMALL_SCALE = {"eligible_load_jobs_hourly", "failed_task_report", "latest_hour_report_compat"}


def plain(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("f", round(value, 6))
    return (type(value).__name__, str(value))


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, duck, name):
    result = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in result.collect()]
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    wanted = expected.fetchall()
    assert sorted(result.columns) == sorted(columns)
    assert len(rows) == len(wanted)
    assert as_rows(result.columns, rows) == as_rows(columns, wanted)
    assert rows or name in EMPTY_AT_SMALL_SCALE


@pytest.mark.parametrize("option, default", [("incremental_upsert_strict", "incremental_upsert_daily"), ("latest_hour_report_compat", "latest_hour_report"), ("sales_metric_verify_losses_compat", "sales_metric_verify_losses")])
def test_options_differ_from_the_default(duck, option, default):
    """Else a green row of the option would show nothing."""
    rows = [sorted(map(repr, duck.execute(ORACLES[name]).fetchall())) for name in (option, default)]
    assert rows[0] != rows[1]
