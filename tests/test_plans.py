"""Plans at a scale where nothing is small enough to broadcast by itself."""

import pytest
from helpers import plan_of, settings, values
from pyspark.sql import functions as F

from quayside.operators import dedup, reconcile, upsert
from quayside.queries import all_queries
from quayside.queries import fixtures as fx

NEVER = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture
def no_broadcast(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        yield


@pytest.mark.parametrize("name", sorted(set(all_queries()) - {"micro_batch_upsert", "incremental_upsert_table", "historical_load_table"}))
def test_no_unwanted_operators(spark, folder, no_broadcast, name):
    plan = plan_of(all_queries()[name](spark, folder))
    assert not [operator for operator in NEVER if operator in plan]


def test_counts_read_one_column_of_the_window(spark, folder):
    plan = plan_of(reconcile.monthly_counts({"ORDERS": fx.order_source(spark, folder)}, fx.AS_OF))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_older_copies_are_dropped_before_the_shuffle(spark, folder):
    plan = plan_of(all_queries()["dedup_keep_latest"](spark, folder))
    assert plan.count("WindowGroupLimit") >= 2


def test_balances_take_one_shuffle(spark, folder):
    plan = plan_of(all_queries()["month_end_snapshots"](spark, folder))
    assert plan.count("Exchange\n") == 1 and "Join" not in plan


def test_scalars_take_no_shuffle(spark, folder):
    for name in ("scalar_dates", "scalar_text_numeric", "delete_where", "historical_load_by_year"):
        assert "Exchange" not in plan_of(all_queries()[name](spark, folder))


def skewed(spark):
    """Adaptive execution with partition sizes of a test, and no broadcast."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__files__maxPartitionBytes="200KB",
    )


def test_hot_stamp_is_split(spark, tmp_path):
    """A third of all rows in one batch: the delete by load time splits it over tasks."""
    path = str(tmp_path / "rows")
    rows = spark.range(60000).select(
        F.col("id"),
        F.xxhash64("id").alias("payload"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.concat(F.lit("2023-01-"), F.col("id") % 19 + 10)).cast("timestamp_ntz").alias("MIG_DATETIME"),
    )
    copies = rows.where("id < 600 AND id % 3 = 1").withColumn("MIG_DATETIME", F.lit("2024-02-01").cast("timestamp_ntz"))
    rows.unionByName(copies).repartition(16).write.parquet(path)
    with skewed(spark):
        kept = dedup.purge_superseded_batches(spark.read.parquet(path), ["id"])
        assert values(kept.groupBy("MIG_DATETIME").count(), "count") == [(200,), (20000,)]
        kept.collect()
        assert "skew=true" in plan_of(kept)


def test_hot_key_in_a_delete_is_split(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.xxhash64("id").alias("payload")
    ).repartition(16).write.parquet(path)
    keys = str(tmp_path / "keys")
    spark.range(1, 60000, 5).select(F.col("id").alias("k")).write.parquet(keys)
    with skewed(spark):
        kept = upsert.delete_keys(spark.read.parquet(path), spark.read.parquet(keys))
        kept.collect()
        assert "skew=true" in plan_of(kept)
        assert kept.where("k = 7").count() == 20001


def test_settled_list_is_broadcast_by_its_size(spark, folder):
    rows = spark.read.parquet(f"{folder}/lineitem.parquet")
    assert "BroadcastHashJoin" in plan_of(dedup.purge_superseded_batches(rows, ["l_orderkey"], "l_shipdate"))


def test_counts_meet_newest_copies_without_a_second_shuffle(spark, folder, no_broadcast):
    rows = spark.read.parquet(f"{folder}/lineitem.parquet")
    stale = dedup.superseded_stamps(rows, ["l_orderkey", "l_linenumber"], "l_shipdate")
    stale.collect()
    final = plan_of(stale).split("Initial Plan")[0]
    assert "ReusedExchange" in final
