"""Writes to folders of parquet files and to partitioned catalog tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.schema import named_like
from quayside.sources.scans import table_exists


def _balanced(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together before the write, a large one in several tasks.

    Without it each task writes a small file into each partition.
    """
    return df.hint("rebalance", *partitions) if partitions else df


def append(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    _balanced(df, partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def replace(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Write a whole table anew. ``path`` must not be one that ``df`` reads."""
    writer = _balanced(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partitions).parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str], balance: bool = True) -> None:
    """Replace only the partitions that occur in ``df``; all others stay as they are."""
    if not partitions:
        raise ValueError("name the partition columns")
    rows = _balanced(df, partitions) if balance else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def create_table(df: DataFrame, name: str, partition: str, path: str | None = None) -> None:
    """Create a partitioned catalog table from ``df``, in ``path`` if one is given.

    The table itself says that an overwrite replaces only the partitions it writes.
    """
    writer = _balanced(df, [partition]).write.partitionBy(partition).format("parquet").option("partitionOverwriteMode", "dynamic")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def add_columns(df: DataFrame, name: str) -> None:
    """Add to a catalog table the columns that only ``df`` has. Old rows read as NULL there.

    Names meet as the session compares them; two columns of ``df`` that meet are an error.
    """
    spark = df.sparkSession
    known = set(spark.table(name).columns)
    named = named_like(df, spark.table(name).columns).schema
    added = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in named if f.name not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")


def _in_table_order(df: DataFrame, name: str) -> DataFrame:
    """The columns of ``df`` in the order and spelling of the table; a column that ``df`` lacks is NULL."""
    df = named_like(df, df.sparkSession.table(name).columns)
    present = set(df.columns)
    return df.select(
        *[
            F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in df.sparkSession.table(name).schema
        ]
    )


def append_table(df: DataFrame, name: str, partition: str, path: str | None = None) -> None:
    """Add rows to a partitioned catalog table, which is created if it does not exist."""
    if not table_exists(df.sparkSession, name):
        create_table(df, name, partition, path)
        return
    add_columns(df, name)
    _balanced(_in_table_order(df, name), [partition]).write.mode("append").insertInto(name)


def _says_dynamic(spark: SparkSession, name: str) -> bool:
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Storage Properties")
    return any("partitionOverwriteMode=dynamic" in row.data_type for row in told.collect())


@contextmanager
def _only_written_partitions(spark: SparkSession, name: str) -> Iterator[None]:
    """An insert takes this mode from the table or the session, not from the writer. The session is only set for tables made elsewhere."""
    if _says_dynamic(spark, name):
        yield
        return
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def replace_table_partitions(df: DataFrame, name: str, partition: str, suspects: DataFrame) -> None:
    """Put ``df`` in the place of its partitions of a catalog table.

    The new files are written beside the old ones and moved in when the job ends, so ``df`` may
    read the table. ``suspects`` lists the partitions that may have no rows any more; those without
    any are dropped afterwards. Without suspects ``df`` is evaluated once, else also for the suspects.
    """
    spark = df.sparkSession
    # Lists of partitions, which are table layout and not data. Asked before the write, while
    # df still reads the old files; only the columns that decide which rows stay are read.
    asked = {row[0] for row in suspects.select(partition).distinct().collect()}
    still = df.where(F.col(partition).isin(list(asked))).select(partition).distinct().collect() if asked else []
    rows = _balanced(_in_table_order(df, name), [partition])
    with _only_written_partitions(spark, name):
        rows.write.mode("overwrite").insertInto(name)
    for value in sorted(asked - {row[0] for row in still}):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition} = :value)", {"value": value})
