"""Joins split where one key holds a third of all rows, with broadcasts off."""

import contextlib
import io

import pytest
from helpers import plan_of, settings
from pyspark.sql import functions as F

from quayside.llm import components


def skewed(spark):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__files__maxPartitionBytes="100KB",
    )


@pytest.fixture
def hub(spark, tmp_path):
    """One node that a third of all links meet."""
    path = str(tmp_path / "links")
    rows = spark.range(120_000).select(
        (F.col("id") + 1).alias("src"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.xxhash64("id") % 40_000 + 200_000).alias("dst")
    )
    rows.repartition(16).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("star", ["_large_star", "_small_star"])
def test_a_hub_is_split(spark, hub, star):
    with skewed(spark):
        links = hub if star == "_large_star" else hub.selectExpr("dst AS src", "src AS dst")
        made = getattr(components, star)(links)
        made.collect()
        assert "skew=true" in plan_of(made)


def test_components_with_a_hub(spark, hub):
    found = components.connected_components(hub.where("src <= 3000"))
    with contextlib.redirect_stdout(io.StringIO()):
        assert found.where("component = 0").count() == 1001
