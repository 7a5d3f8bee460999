"""Table schemas: derived from a source's column catalog, and grown when a batch brings new columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type name to Spark type. Types in SIZED take precision and scale from the catalog.
TYPE_MAP = {
    "int": "int",
    "bigint": "bigint",
    "float": "double",
    "real": "float",
    "money": "decimal(19,4)",
    "char": "string",
    "nchar": "string",
    "varchar": "string",
    "nvarchar": "string",
    "text": "string",
    "image": "binary",
    "date": "date",
    "datetime": "timestamp_ntz",
    "time": "string",
}
SIZED = ("numeric", "decimal")
APPROXIMATE = ("decimal", "money")
STAMP = "MIG_DATETIME"


def spark_type(data_type: Column, precision: Column, scale: Column, lossy: bool = False) -> Column:
    """The Spark type, as text, of a source type. Unknown types become text.

    ``lossy`` loads ``decimal`` and ``money`` as floating point.
    """
    name = F.lower(data_type)
    names = [*TYPE_MAP, *SIZED]
    mapping = {**TYPE_MAP, **({t: "double" for t in APPROXIMATE} if lossy else {})}
    expression = F.when(~name.isin(names) | name.isNull(), F.lit("string"))
    for source, target in mapping.items():
        expression = expression.when(name == source, F.lit(target))
    return expression.otherwise(
        F.concat(
            F.lit("decimal("),
            F.coalesce(precision, F.lit(18)).cast("string"),
            F.lit(","),
            F.coalesce(scale, F.lit(0)).cast("string"),
            F.lit(")"),
        )
    )


def derive_schema(catalog: DataFrame, lossy: bool = False, stamp: str = STAMP) -> DataFrame:
    """Target columns of every table in a source column catalog.

    Input: ``TABLE_NAME, COLUMN_NAME, ORDINAL_POSITION, DATA_TYPE, NUMERIC_PRECISION,
    NUMERIC_SCALE, IS_NULLABLE, KEY_POSITION`` (the place in the primary key, else NULL).
    Each table gets the load stamp as its last column.
    """
    columns = catalog.select(
        "TABLE_NAME",
        "COLUMN_NAME",
        F.col("ORDINAL_POSITION").cast("int").alias("ORDINAL_POSITION"),
        spark_type(F.col("DATA_TYPE"), F.col("NUMERIC_PRECISION"), F.col("NUMERIC_SCALE"), lossy).alias("SPARK_TYPE"),
        ((F.col("IS_NULLABLE") == "YES") & F.col("KEY_POSITION").isNull()).alias("NULLABLE"),
        F.col("KEY_POSITION").cast("int").alias("KEY_POSITION"),
    )
    stamps = catalog.groupBy("TABLE_NAME").agg(
        F.lit(stamp).alias("COLUMN_NAME"),
        (F.max("ORDINAL_POSITION") + 1).cast("int").alias("ORDINAL_POSITION"),
        F.lit("timestamp_ntz").alias("SPARK_TYPE"),
        F.lit(True).alias("NULLABLE"),
        F.lit(None).cast("int").alias("KEY_POSITION"),
    )
    return columns.unionByName(stamps)


def struct_of(derived: DataFrame, table: str) -> tuple[T.StructType, list[str]]:
    """The schema and the key columns, in key order, of one table of ``derive_schema``.

    Reads the columns of one table only, which is schema and not data.
    """
    rows = derived.where(F.col("TABLE_NAME") == table).orderBy("ORDINAL_POSITION").collect()
    if not rows:
        raise ValueError(f"table {table} is not in the catalog")
    struct = T.StructType(
        [T.StructField(r.COLUMN_NAME, T.DataType.fromDDL(r.SPARK_TYPE), r.NULLABLE) for r in rows]
    )
    keyed = sorted((r.KEY_POSITION, r.COLUMN_NAME) for r in rows if r.KEY_POSITION is not None)
    return struct, [name for _, name in keyed]


def folded(spark: SparkSession) -> Callable[[str], str]:
    """Names as the session compares them: without case, unless it is told otherwise."""
    return str if spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true" else str.lower


def named_like(batch: DataFrame, names: Sequence[str]) -> DataFrame:
    """The batch with its columns spelled as ``names`` spell them; columns that ``names`` lack keep their name.

    Two columns of the batch that come to one name are an error, as are two of ``names``.
    """
    fold = folded(batch.sparkSession)
    known: dict[str, str] = {}
    for name in names:
        if known.setdefault(fold(name), name) != name:
            raise ValueError(f"columns differ only in case: {known[fold(name)]}, {name}")
    spelled = [known.get(fold(c), c) for c in batch.columns]
    taken: dict[str, str] = {}
    for old, new in zip(batch.columns, spelled, strict=True):
        if taken.setdefault(fold(new), old) != old:
            raise ValueError(f"columns differ only in case: {taken[fold(new)]}, {old}")
    if len(taken) < len(spelled):
        raise ValueError(f"a column occurs twice: {', '.join(sorted({c for c in spelled if spelled.count(c) > 1}))}")
    return batch if spelled == batch.columns else batch.toDF(*spelled)


def typed_like(rows: DataFrame, like: DataFrame) -> DataFrame:
    """Rows with the names and types that ``like`` has for their columns; further columns stay as they are."""
    rows = named_like(rows, like.columns)
    types = {f.name: f.dataType for f in like.schema}
    return rows.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in rows.columns])


def evolve(target: DataFrame, batch: DataFrame, new_as_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Target and batch brought to one schema.

    Columns only in the batch are added to the target, NULL in old rows; with ``new_as_text``
    they are added as text. Columns only in the target are NULL in the batch. No column is
    dropped or retyped: a type conflict is an error. Names meet as the session compares them, so
    a column of the batch that differs only in case from one of the target is that column.
    """
    batch = named_like(batch, target.columns)
    old = {f.name: f.dataType for f in target.schema}
    new = {f.name: f.dataType for f in batch.schema}
    conflicts = [f"{c}: {old[c].simpleString()} / {new[c].simpleString()}" for c in new if c in old and old[c] != new[c]]
    if conflicts:
        raise ValueError("column types differ: " + ", ".join(conflicts))
    added = [c for c in new if c not in old]
    if new_as_text:
        batch = batch.withColumns({c: F.col(f"`{c}`").cast("string") for c in added})
        new.update({c: T.StringType() for c in added})
    grown = target.withColumns({c: F.lit(None).cast(new[c]) for c in added})
    filled = batch.withColumns({c: F.lit(None).cast(t) for c, t in old.items() if c not in new})
    return grown, filled.select(*[f"`{c}`" for c in grown.columns])


def trimmed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns without the spaces at the end that fixed-width ``char`` columns carry, so that keys meet.

    Without ``columns`` these are all text columns. Names are taken as the table has them.
    """
    wanted = {f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType))}
    wanted = wanted if columns is None else set(columns)
    return df.select(*[F.rtrim(f"`{c}`").alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])
