"""Write a small intermediate once, so that its true size drives the next join.

A delete list or a batch is computed from large tables, and the planner can only guess how
large it came out. Written as a table in the shared folder its size is known: below
``spark.sql.autoBroadcastJoinThreshold`` the next join broadcasts it and the large side is
never shuffled; above it the join shuffles two plain scans, which adaptive execution can
split where one key holds much of the data. It also cuts the lineage, so a lost executor does
not bring back the work behind the list.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


LOCAL_ALLOWED = "quayside.scratch.local"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the context's checkpoint folder, else one beside the warehouse's tables.

    Executors of a cluster may not reach a folder of the driver's file system. There the warehouse is taken only if it lies in
    another one, or if the setting ``quayside.scratch.local`` says that its folder is shared.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    own = warehouse and warehouse.startswith(("file:", "/")) and not re.match(r"local(\[|$)", spark.sparkContext.master)
    if not warehouse or own and spark.conf.get(LOCAL_ALLOWED, "false") != "true":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, grouped by application for later cleaning."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, compact: bool = False) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    ``compact`` brings few rows from many scan tasks together first, so that they do not become
    as many small files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.hint("rebalance") if compact else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str | None = None) -> None:
    """Remove one scratch path, or all that this application has written, once nothing reads it any more."""
    path = path or f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
