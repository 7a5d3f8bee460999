import uuid
from datetime import date, datetime

import pytest
from helpers import TS, frame, settings, values
from pyspark.sql import functions as F

from quayside.functions import dates, text
from quayside.operators import upsert
from quayside.plans import settle
from quayside.operators.schema import derive_schema
from quayside.plans.table_load import create_by_month, create_from_catalog, load_history, load_table
from quayside.sources import catalogs, databases, scans, sinks

SCHEMA = "k bigint, v string, RDATETIME timestamp_ntz, UDATETIME timestamp_ntz"
IN = "RDATETIME >= timestamp_ntz'2024-03-01' OR UDATETIME >= timestamp_ntz'2024-03-01'"
ROWS = [
    (1, "jan", datetime(2024, 1, 5), None),
    (2, "feb", datetime(2024, 2, 5), None),
    (3, "mar", datetime(2024, 3, 5), None),
    (4, "apr", datetime(2024, 4, 5), None),
    (5, "undated", None, None),
]


def test_year_predicates():
    assert databases.year_predicates("t", 2023, 2024) == [
        "t >= '2023-01-01' AND t < '2024-01-01'",
        "t >= '2024-01-01' AND t < '2025-01-01'",
        "t < '2023-01-01'",
        "t >= '2025-01-01'",
        "t IS NULL",
    ]


def test_every_row_is_in_one_split(folder, duck):
    """Dates before, inside and after the ranges, keys and missing values."""
    duck.execute("CREATE TEMP TABLE split_rows AS SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders")
    rows = duck.execute("SELECT COUNT(*) FROM split_rows").fetchone()
    splits = {
        "years": databases.year_predicates("d", 1997, 1999),
        "months": databases.month_predicates("d", date(1997, 11, 20), date(1998, 2, 3)),
        "keys": databases.key_predicates("k", 100, 900, 7),
        "one key": databases.key_predicates("k", 5, 5, 3),
    }
    assert {name: len(found) for name, found in splits.items()} == {"years": 6, "months": 7, "keys": 10, "one key": 4}
    for found in splits.values():
        hits = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in found)
        assert duck.execute(f"SELECT COUNT(*) FROM split_rows WHERE {hits} = 1").fetchone() == rows


def test_bad_splits(spark):
    for call in (
        lambda: databases.range_predicates("d", []),
        lambda: databases.range_predicates("k", [2, 2]),
        lambda: databases.range_predicates("k; DROP TABLE x", [1]),
        lambda: databases.key_predicates("k", 1, 9, 0),
        lambda: databases.read_database(spark, "jdbc:none", "t", {}, []),
    ):
        with pytest.raises(ValueError):
            call()


def test_copies_to_several_databases(spark, monkeypatch):
    """Both copies get the same stored rows and their own options; no database is opened."""
    calls = []
    monkeypatch.setattr(databases, "copy_to_database", lambda *given: calls.append(given))
    targets = [databases.Target("jdbc:a", "dbo.U", {"user": "a"}), databases.Target("jdbc:b", "dbo.V", {})]
    rows = databases.copy_to_databases(frame(spark, "id int", (1,), (2,)), targets, batch_rows=5)
    assert values(rows) == [(1,), (2,)]
    assert [call[1:] for call in calls] == [("jdbc:a", "dbo.U", {"user": "a"}, 5), ("jdbc:b", "dbo.V", {}, 5)]
    assert all(call[0] is rows for call in calls)
    assert databases.copy_options({"user": "a"}, 5) == {"truncate": "true", "batchsize": "5", "user": "a"}


def test_padded_text_is_trimmed(spark):
    rows = frame(spark, "`a.b` string, other string, n int", ("x  ", " y ", 1), (None, "", 2))
    assert values(databases.trimmed(rows)) == [(None, "", 2), ("x", " y", 1)]
    assert values(databases.trimmed(rows, ["other"])) == [(None, "", 2), ("x  ", " y", 1)]


def test_catalog_refresh_replaces_and_survives_bad_files(spark, tmp_path):
    path, kept, bad = (str(tmp_path / name) for name in ("stored", "kept", "bad"))
    sinks.replace(frame(spark, "JOB_CODE string, UDATETIME string", ("old", "2024-01-01")), path)
    frame(spark, catalogs.PRE_JOB_INFO, ("A", "B", "N", "D")).write.csv(kept, header=True)
    assert values(catalogs.refresh_catalog(spark, kept, catalogs.PRE_JOB_INFO, path, TS)) == [("A", "B", "N", "D", "2024-01-10")]
    frame(spark, "WRONG string, PRE_JOB_CODE string, DEL_YN string, SCHEDULE string", ("C", "D", "N", "D")).write.csv(bad, header=True)
    with pytest.raises(Exception, match="header"):
        catalogs.refresh_catalog(spark, bad, catalogs.PRE_JOB_INFO, path, TS)
    assert values(spark.read.parquet(path), "JOB_CODE") == [("A",)]


def test_catalog_round_trip(spark, tmp_path):
    path = str(tmp_path / "jobs")
    info = frame(spark, catalogs.JOB_INFO, ("A", "0", "N", "D", "O"), ("B, with comma", "1", None, "H", None))
    info.write.csv(path, header=True)
    read = catalogs.stamp_catalog(catalogs.read_catalog(spark, path, catalogs.JOB_INFO), TS)
    assert values(read) == [("A", "0", "N", "D", "O", "2024-01-10"), ("B, with comma", "1", None, "H", None, "2024-01-10")]


def test_catalog_with_another_header(spark, tmp_path):
    path = str(tmp_path / "jobs")
    frame(spark, catalogs.JOB_INFO.replace("AGG_LEVEL", "LEVEL"), ("A", "0", "N", "D", "O")).write.csv(path, header=True)
    with pytest.raises(Exception, match="(?i)header"):
        catalogs.read_catalog(spark, path, catalogs.JOB_INFO).collect()


def test_named_result(spark):
    rows = frame(spark, "_1 int, _2 string", (1, "a"))
    assert scans.named_result(rows, ["code", "name, full"], ["name, full"]).columns == ["name, full"]
    with pytest.raises(ValueError, match="3 names for 2 columns"):
        scans.named_result(rows, ["a", "b", "c"])


def test_scans(spark):
    rows = frame(spark, SCHEMA, *ROWS)
    assert values(scans.scan_where(rows, IN), "k") == [(3,), (4,)]
    assert values(scans.scan_keys(rows, ["k"], "RDATETIME", date(2024, 1, 5), date(2024, 2, 5))) == [(1,)]
    assert scans.has_column(rows, "UDATETIME") and not scans.has_column(rows, "MIG_DATETIME")


def test_partitions_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(frame(spark, "m int, v int", (1, 1), (2, 2)), path, ["m"])
    sinks.append(frame(spark, "m int, v int", (2, 3)), path, ["m"])
    sinks.replace_partitions(spark.read.parquet(path).where("m = 2").withColumn("v", F.col("v") * 10), path, ["m"])
    assert values(spark.read.parquet(path), "m", "v") == [(1, 1), (2, 20), (2, 30)]
    sinks.replace(frame(spark, "m int, v int", (7, 7)), path, ["m"])
    assert values(spark.read.parquet(path), "m", "v") == [(7, 7)]


def test_table_load_rewrites_touched_months(spark, tmp_path):
    target = upsert.stamped(frame(spark, SCHEMA, *ROWS), datetime(2024, 4, 6))
    create_by_month(target, "orders_by_month", path=str(tmp_path / "orders"))
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "orders").glob("LOAD_MONTH=2024-02/*.parquet")}
    # January is updated, March is reloaded, April has no source rows any more, February stays.
    batch = frame(spark, SCHEMA, (1, "jan, updated", datetime(2024, 1, 5), datetime(2024, 3, 9)), (3, "mar, again", datetime(2024, 3, 5), None))
    loaded = load_table("orders_by_month", batch, ["k"], IN, TS)
    assert values(loaded, "k", "v", "LOAD_MONTH") == [
        (1, "jan, updated", "2024-01"), (2, "feb", "2024-02"), (3, "mar, again", "2024-03"), (5, "undated", "undated"),
    ]
    assert values(loaded.drop("LOAD_MONTH")) == values(upsert.incremental_upsert(target, batch, ["k"], IN, TS))
    assert untouched == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "orders").glob("LOAD_MONTH=2024-02/*.parquet")}
    again = load_table("orders_by_month", batch, ["k"], IN, TS)
    assert values(again, "k", "v") == values(loaded, "k", "v")
    assert values(load_table("orders_by_month", batch.where("false"), ["k"], IN, TS)) == values(again)
    spark.sql("DROP TABLE orders_by_month")


def test_table_from_catalog_to_daily_load(spark, tmp_path):
    columns = [
        ("t", "k", 1, "bigint", None, None, "NO", 1), ("t", "v", 2, "nvarchar", None, None, "YES", None),
        ("t", "RDATETIME", 3, "datetime", None, None, "YES", None), ("t", "UDATETIME", 4, "datetime", None, None, "YES", None),
    ]
    catalog = frame(
        spark, "TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, DATA_TYPE string, NUMERIC_PRECISION int, "
        "NUMERIC_SCALE int, IS_NULLABLE string, KEY_POSITION int", *columns,
    )
    keys = create_from_catalog(derive_schema(catalog), "t", "from_catalog", path=str(tmp_path / "t"))
    assert (keys, spark.table("from_catalog").count()) == (["k"], 0)
    source = frame(spark, SCHEMA, *ROWS)
    assert values(load_history(source, "from_catalog", 2024, 2024, TS), "k") == [(1,), (2,), (3,), (4,)]
    changed = frame(spark, SCHEMA, (4, "april again", datetime(2024, 4, 5), None))
    assert values(load_table("from_catalog", changed, keys, IN, TS), "v") == [("april again",), ("feb",), ("jan",)]
    spark.sql("DROP TABLE from_catalog")


def test_history_without_dates(spark, tmp_path):
    loaded = load_history(frame(spark, "k int", (1,), (2,)), "no_dates", 2024, 2024, TS, path=str(tmp_path / "n"))
    assert values(loaded, "k", "LOAD_MONTH") == [(1, "undated"), (2, "undated")]
    spark.sql("DROP TABLE no_dates")


def test_table_load_adds_columns(spark, tmp_path):
    create_by_month(upsert.stamped(frame(spark, SCHEMA, *ROWS), TS), "grown", path=str(tmp_path / "grown"))
    batch = frame(spark, SCHEMA, (6, "mar", datetime(2024, 3, 7), None)).withColumn("extra", F.lit(1.5))
    loaded = load_table("grown", batch, ["k"], IN, TS)
    assert values(loaded, "k", "extra") == [(1, None), (2, None), (5, None), (6, 1.5)]
    assert loaded.columns[-2:] == ["extra", "LOAD_MONTH"]
    spark.sql("DROP TABLE grown")


def test_partitions_are_replaced_alone_in_any_session(spark, tmp_path):
    with settings(spark, spark__sql__sources__partitionOverwriteMode="static"):
        rows = spark.range(4).withColumn("m", F.col("id").cast("string"))
        sinks.create_table(rows, "alone", "m", str(tmp_path / "alone"))
        changed = spark.table("alone").where("m = '1'").withColumn("id", F.lit(10).cast("bigint"))
        sinks.replace_table_partitions(changed, "alone", "m", spark.sql("SELECT '1' AS m"))
        assert values(spark.table("alone"), "m", "id") == [("0", 0), ("1", 10), ("2", 2), ("3", 3)]
        path = str(tmp_path / "files")
        sinks.append(rows, path, ["m"])
        sinks.replace_partitions(spark.read.parquet(path).where("m = 1").withColumn("id", F.lit(10)), path, ["m"])
        assert values(spark.read.parquet(path), "id") == [(0,), (2,), (3,), (10,)]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    spark.sql("DROP TABLE alone")


def test_append_creates_and_grows_a_table(spark, tmp_path):
    where = dict(name="years", partition="LOAD_YEAR", path=str(tmp_path / "years"))
    for year, extra in ((2023, []), (2024, ["extra"])):
        rows = spark.range(2).selectExpr("id", *[f"'x' AS {c}" for c in extra], f"{year} AS LOAD_YEAR")
        sinks.append_table(rows, **where)
    assert values(spark.table("years"), "LOAD_YEAR", "id", "extra") == [
        (2023, 0, None), (2023, 1, None), (2024, 0, "x"), (2024, 1, "x"),
    ]
    spark.sql("DROP TABLE years")


def test_emptied_partitions_are_dropped(spark, tmp_path):
    rows = spark.range(100).withColumn("m", (F.col("id") % 4).cast("string"))
    sinks.create_table(rows, "emptied", "m", str(tmp_path / "emptied"))
    table = spark.table("emptied")
    sinks.replace_table_partitions(table.where("m = '1' AND id > 50"), "emptied", "m", spark.sql("SELECT * FROM VALUES ('1'), ('2') AS t(m)"))
    assert values(spark.table("emptied").groupBy("m").count()) == [("0", 25), ("1", 12), ("3", 25)]
    sinks.replace_table_partitions(table.where("false"), "emptied", "m", spark.sql("SELECT '3' AS m"))
    assert values(spark.table("emptied").groupBy("m").count()) == [("0", 25), ("1", 12)]
    spark.sql("DROP TABLE emptied")


def test_text_functions(spark):
    rows = frame(spark, "t string", ("A_1D",), ("A_1D_X",), (" 12 ",), ("12.5",), ("99999999999999999999",), (None,))
    found = rows.select(text.swap_suffix(F.col("t"), "_1D", "_M"), text.whole_number(F.col("t")), dates.clock_seconds(F.col("t")))
    assert [tuple(r) for r in found.collect()] == [
        ("A_M", None, None), ("A_1D_X", None, None), (" 12 ", 12, None), ("12.5", None, None),
        ("99999999999999999999", None, None), (None, None, None),
    ]


def test_shared_folder(spark):
    assert settle.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    rows = settle.settle(frame(spark, SCHEMA, *ROWS), "rows")
    assert values(rows) == values(frame(spark, SCHEMA, *ROWS))
    assert all(settle.shared_folder(spark) in f for f in rows.inputFiles())


def test_counts_by_the_database(spark, folder, duck):
    """The subquery for the database gives the counts that Spark finds itself."""
    from quayside.operators.reconcile import monthly_counts
    from quayside.queries import fixtures as fx

    query = databases.month_counts_query("orders", "o_orderdate", fx.AS_OF)
    counted = spark.createDataFrame(duck.execute(query).fetchall(), "y bigint, m bigint, n bigint")
    ours = monthly_counts({"ORDERS": fx.order_source(spark, folder)}, fx.AS_OF)
    assert values(databases.labelled_counts(counted, "ORDERS")) == values(ours)
    with pytest.raises(ValueError, match="not a table"):
        databases.month_counts_query("orders; DROP TABLE x", "o_orderdate", fx.AS_OF)


def test_column_catalog_query():
    import duckdb

    connection = duckdb.connect()
    connection.execute("CREATE TABLE parent (id INTEGER PRIMARY KEY)")
    connection.execute("CREATE TABLE t (b INTEGER, a VARCHAR, p INTEGER REFERENCES parent(id), u INTEGER UNIQUE, PRIMARY KEY (a, b))")
    rows = connection.execute(databases.COLUMN_CATALOG + " WHERE c.TABLE_NAME = 't' ORDER BY c.ORDINAL_POSITION").fetchall()
    assert [(r[1], r[7]) for r in rows] == [("b", 2), ("a", 1), ("p", None), ("u", None)]


def test_scratch_needs_a_shared_folder(spark):
    from quayside.plans.settle import shared_folder

    class Bare:
        class conf:
            get = staticmethod(lambda name, default=None: None)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Bare)


@pytest.mark.parametrize("master, warehouse, allowed, fine", [
    ("spark://host:7077", "file:/tmp/w", "false", False), ("local-cluster[3,2,1000]", "/tmp/w", "false", False), ("yarn", "/tmp/w", "true", True),
    ("local[8]", "/tmp/w", "false", True), ("yarn", "hdfs://host/w/", "false", True),
])
def test_a_local_warehouse_is_no_scratch_of_a_cluster(master, warehouse, allowed, fine):
    from types import SimpleNamespace as Made

    from quayside.plans.settle import LOCAL_ALLOWED, shared_folder

    held = {"spark.sql.warehouse.dir": warehouse, LOCAL_ALLOWED: allowed}
    session = Made(conf=Made(get=lambda name, default=None: held.get(name, default)), sparkContext=Made(getCheckpointDir=lambda: None, master=master))
    if fine:
        assert shared_folder(session) == f"{warehouse.rstrip('/')}/_scratch"
    else:
        with pytest.raises(ValueError, match="checkpoint"):
            shared_folder(session)


def test_a_historical_load_is_repeated(spark):


    name, schema = f"history_{uuid.uuid4().hex}", "k string, RDATETIME timestamp_ntz"
    old = datetime(2020, 5, 1)
    create_by_month(frame(spark, f"{schema}, MIG_DATETIME timestamp_ntz", ("other load", old, old)), name)
    rows = frame(spark, schema, ("a  ", old), ("b", datetime(2021, 1, 1)), ("outside", datetime(2019, 1, 1)))
    for _ in range(3):
        loaded = load_history(rows, name, 2020, 2021, TS, trim=True)
        assert values(loaded, "k") == [("a",), ("b",), ("other load",)]
    spark.sql(f"DROP TABLE {name}")


def test_padded_keys_meet(spark):
    from quayside.operators.upsert import load_window

    day = datetime(2024, 1, 9)
    target = frame(spark, "k string, UDATETIME timestamp_ntz, MIG_DATETIME timestamp_ntz", ("a", day, day))
    source = frame(spark, "k string, UDATETIME timestamp_ntz", ("a   ", day))
    window = "UDATETIME > timestamp_ntz'2024-01-09'"
    assert load_window(source, target, ["k"], "true", TS, target_pred=window, trim=True).count() == 1
    assert load_window(source, target, ["k"], "true", TS, target_pred=window).count() == 2
