import uuid
from datetime import datetime

import pytest
from helpers import TS, frame, settings, values
from pyspark.sql import types as T

from quayside.operators import schema, upsert
from quayside.plans.table_load import create_by_month, load_table

CATALOG = (
    "TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, DATA_TYPE string, NUMERIC_PRECISION int, "
    "NUMERIC_SCALE int, IS_NULLABLE string, KEY_POSITION int"
)
ROWS = [
    ("t", "line", 2, "int", 10, 0, "NO", 1),
    ("t", "doc", 1, "VARCHAR", None, None, "NO", 2),
    ("t", "amount", 3, "decimal", 12, 3, "YES", None),
    ("t", "price", 4, "money", 19, 4, "YES", None),
    ("t", "rate", 5, "numeric", None, None, "NO", None),
    ("t", "id", 6, "uniqueidentifier", None, None, "YES", None),
    ("t", "photo", 7, "image", None, None, "YES", None),
    ("t", "at", 8, "datetime", None, None, "YES", None),
    ("u", "x", 1, "real", 24, None, "YES", None),
]


def test_types_and_keys(spark):
    struct, keys = schema.struct_of(schema.derive_schema(frame(spark, CATALOG, *ROWS)), "t")
    assert keys == ["line", "doc"]
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in struct] == [
        ("doc", "string", False),
        ("line", "int", False),
        ("amount", "decimal(12,3)", True),
        ("price", "decimal(19,4)", True),
        ("rate", "decimal(18,0)", False),
        ("id", "string", True),
        ("photo", "binary", True),
        ("at", "timestamp_ntz", True),
        ("MIG_DATETIME", "timestamp_ntz", True),
    ]


def test_lossy_types(spark):
    found = schema.derive_schema(frame(spark, CATALOG, *ROWS), lossy=True)
    types = dict(values(found.where("TABLE_NAME = 't'"), "COLUMN_NAME", "SPARK_TYPE"))
    assert (types["amount"], types["price"], types["rate"]) == ("double", "double", "decimal(18,0)")


def test_unknown_table(spark):
    with pytest.raises(ValueError, match="nothing"):
        schema.struct_of(schema.derive_schema(frame(spark, CATALOG, *ROWS)), "nothing")


def test_columns_are_added_on_both_sides(spark):
    target = frame(spark, "a int, old string", (1, "o"))
    batch = frame(spark, "new bigint, a int", (7, 2))
    grown, filled = schema.evolve(target, batch)
    both = grown.unionByName(filled)
    assert both.schema["new"].dataType == T.LongType()
    assert values(both, "a", "old", "new") == [(1, "o", None), (2, None, 7)]


def test_new_columns_as_text(spark):
    grown, filled = schema.evolve(frame(spark, "a int", (1,)), frame(spark, "a int, new bigint", (2, 7)), new_as_text=True)
    assert values(grown.unionByName(filled), "a", "new") == [(1, None), (2, "7")]


def test_type_conflict(spark):
    with pytest.raises(ValueError, match="a: int / string"):
        schema.evolve(frame(spark, "a int", (1,)), frame(spark, "a string", ("1",)))


def test_names_meet_without_case(spark):
    target, batch = frame(spark, "id int, note string", (1, "old")), frame(spark, "ID int, NOTE string, Extra int", (2, "new", 5))
    grown, filled = schema.evolve(target, batch)
    assert grown.columns == filled.columns == ["id", "note", "Extra"]
    assert values(grown.unionByName(filled), "id", "note", "Extra") == [(1, "old", None), (2, "new", 5)]
    loaded = upsert.incremental_upsert(target, batch, ["id"], "id = 0", TS, updated="note")
    assert values(loaded, "id", "note") == [(1, "old"), (2, "new")]


def test_names_that_collide(spark):
    with pytest.raises(ValueError, match="only in case: note, NOTE"):
        schema.evolve(frame(spark, "id int", (1,)), frame(spark, "id int, note string, NOTE string", (2, "a", "b")))
    with pytest.raises(ValueError, match="twice"):
        schema.named_like(frame(spark, "a int", (1,)).selectExpr("a", "a"), ["a"])
    with settings(spark, spark__sql__caseSensitive="true"):
        grown, filled = schema.evolve(frame(spark, "note string", ("old",)), frame(spark, "NOTE string", ("new",)))
        assert values(grown.unionByName(filled), "note", "NOTE") == [(None, "new"), ("old", None)]


def test_stored_load_keeps_both_spellings(spark):
    name = f"spelled_{uuid.uuid4().hex}"
    day = datetime(2024, 1, 5)
    create_by_month(frame(spark, "id int, note string, RDATETIME timestamp_ntz, MIG_DATETIME timestamp_ntz", (1, "old", day, day)), name)
    batch = frame(spark, "ID int, NOTE string, rdatetime timestamp_ntz", (2, "new", day))
    load_table(name, batch, ["id"], "RDATETIME >= timestamp_ntz'2024-01-06'", TS)
    assert values(spark.table(name), "id", "note", "LOAD_MONTH") == [(1, "old", "2024-01"), (2, "new", "2024-01")]
    spark.sql(f"DROP TABLE {name}")
