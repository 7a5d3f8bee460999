"""One schema for a table, whatever order its batches come in.

Each batch's names and types are noted, names as the session compares them. The type of a column is the narrowest that
holds all that were noted: whole numbers widen to larger ones and to decimals, those to doubles, dates to timestamps.
Types without a common wider one make the column text, and are listed as a conflict. The widening does not depend on the
order of the batches, so two loads that met the same batches have the same table.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.schema import folded, named_like
from quayside.plans.publish import publish_parts
from quayside.sources.scans import table_exists

WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}  # digits a decimal needs to hold them
MOST_DIGITS = 38


def wider(a: T.DataType | None, b: T.DataType | None) -> T.DataType | None:
    """The narrowest type that holds both, None if there is none. The order of the arguments, and of several, does not matter."""
    if a is None or b is None or a == b:
        return a if a == b else None
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    whole = [type(t) in WHOLE for t in (a, b)]
    if all(whole):
        return max(a, b, key=lambda t: WHOLE[type(t)])
    if all(isinstance(t, T.NumericType) for t in (a, b)):
        if any(isinstance(t, T.FloatType | T.DoubleType) for t in (a, b)):
            return T.DoubleType()
        scales = [0 if w else t.scale for t, w in zip((a, b), whole, strict=True)]
        before = [WHOLE[type(t)] if w else t.precision - t.scale for t, w in zip((a, b), whole, strict=True)]
        digits, scale = max(before) + max(scales), max(scales)
        return T.DecimalType(digits, scale) if digits <= MOST_DIGITS else T.DoubleType()
    moments = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if all(isinstance(t, moments) for t in (a, b)) and any(isinstance(t, T.DateType) for t in (a, b)):
        return b if isinstance(a, T.DateType) else a
    return None


def widest(types: Iterable[T.DataType]) -> T.DataType | None:
    """The narrowest type that holds all. Whole numbers and decimals are brought together before doubles, so no order differs."""
    rest = sorted(set(types), key=lambda t: (isinstance(t, T.FloatType | T.DoubleType), t.simpleString()))
    return reduce(wider, rest) if rest else None


def note_schema(spark: SparkSession, register: str, schema: T.StructType, run: str, place: str | None = None) -> None:
    """Note the columns of a batch, once per run. Two columns of one name are an error."""
    named_like(spark.createDataFrame([], schema), [])
    fold = folded(spark)
    rows = [(fold(f.name), f.name, json.dumps(f.dataType.jsonValue()), i, run) for i, f in enumerate(schema)]
    frame = spark.createDataFrame(rows, "name string, spelled string, type string, place int, run string")
    publish_parts(spark, lambda _: (frame, [(run,)]), register, ["run"], run, place)


def registered(spark: SparkSession, register: str) -> tuple[T.StructType, dict[str, list[str]]]:
    """The schema of all noted batches, and the conflicts: the types of each column that became text.

    Columns stand by the first place any batch gave them, then by name, and are spelled as the least of their spellings.
    What is read are names and types, not data.
    """
    if not table_exists(spark, register):
        return T.StructType([]), {}
    noted = spark.table(register).groupBy("name").agg(
        F.min("spelled").alias("spelled"), F.collect_set("type").alias("types"), F.min("place").alias("place")
    )
    fields, conflicts = [], {}
    for row in sorted(noted.collect(), key=lambda r: (r.place, r.name)):
        types = [_type(t) for t in row.types]
        found = widest(types)
        if found is None:
            conflicts[row.spelled] = sorted(t.simpleString() for t in types)
        fields.append(T.StructField(row.spelled, found or T.StringType(), True))
    return T.StructType(fields), conflicts


def _type(text: str) -> T.DataType:
    return T.StructType.fromJson({"type": "struct", "fields": [{"name": "x", "type": json.loads(text), "nullable": True, "metadata": {}}]})["x"].dataType


def fitted(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """A batch or a table brought to a registered schema: widened, and NULL where a column is missing."""
    rows = named_like(rows, schema.names)
    if lacking := [c for c in rows.columns if c not in schema.names]:
        raise ValueError(f"columns that are not registered: {lacking}")
    return rows.select(
        *[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )
