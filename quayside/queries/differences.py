"""Comparison of source and target by checksums of key ranges, and the repair that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import checksums
from quayside.queries import fixtures as fx

# Every eighth stretch of STRETCH order keys is damaged.
STRETCH = 128
KEY_RANGES = checksums.Ranges("o_orderkey", 64)
DAY_RANGES = checksums.Ranges("RDATETIME", 16)


def _damaged() -> Column:
    return F.floor(F.col("o_orderkey") / STRETCH) % 8 == 3


def order_copy(spark: SparkSession, folder: str) -> DataFrame:
    """A copy of the orders that in some stretches lost rows, kept others under a key of their own, and holds old prices.

    Each lost order has an orphan dated alike, so the counts of all months are those of the source.
    """
    source = fx.order_source(spark, folder)
    key = F.col("o_orderkey")
    lost = _damaged() & (key % 29 == 0)
    priced = F.when(_damaged() & (key % 31 == 0), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return source.withColumns({"o_orderkey": F.when(lost, -key).otherwise(key), "o_totalprice": F.when(lost, F.col("o_totalprice")).otherwise(priced)})


def checksum_differences(spark: SparkSession, folder: str) -> DataFrame:
    return checksums.differences(fx.order_source(spark, folder), order_copy(spark, folder), fx.ORDER_KEYS, KEY_RANGES)


def checksum_differences_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return checksums.differences(fx.order_source(spark, folder), order_copy(spark, folder), fx.ORDER_KEYS, DAY_RANGES)


def checksum_repair(spark: SparkSession, folder: str) -> DataFrame:
    source, target = fx.order_source(spark, folder), order_copy(spark, folder)
    return checksums.repaired(source, target, fx.ORDER_KEYS, checksum_differences(spark, folder), fx.RUN_TS)


def checksum_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The leaves of both sides that differ in rows or in checksum, with their counts."""
    sides = [checksums.leaves(side, KEY_RANGES, checksum_columns(side)) for side in (fx.order_source(spark, folder), order_copy(spark, folder))]
    sums = [s.select("node", F.col("row_count").alias(f"{n}_rows"), F.struct("high", "low").alias(n)) for s, n in zip(sides, ("source", "target"), strict=True)]
    both = sums[0].join(sums[1], "node", "full")
    return both.where("NOT (source <=> target)").select("node", F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("target_rows", F.lit(0)).alias("target_rows"))


def checksum_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "MIG_DATETIME"]


QUERIES = {
    "checksum_differences": checksum_differences,
    "checksum_differences_by_day": checksum_differences_by_day,
    "checksum_ranges": checksum_ranges,
    "checksum_repair": checksum_repair,
}

_COPY = f"""WITH {fx.ORDER_CTES},
copy AS (
  SELECT CASE WHEN hit AND o_orderkey % 29 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN hit AND o_orderkey % 31 = 0 AND o_orderkey % 29 <> 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         RDATETIME, UDATETIME
  FROM (SELECT *, (o_orderkey // {STRETCH}) % 8 = 3 AS hit FROM source)),
differences AS (
  SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
         CASE WHEN t.o_orderkey IS NULL THEN 'MISSING' WHEN s.o_orderkey IS NULL THEN 'ORPHAN' ELSE 'CHANGED' END AS status,
         CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END::BIGINT AS source_rows, CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END::BIGINT AS target_rows
  FROM source s FULL JOIN copy t ON s.o_orderkey = t.o_orderkey
  WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR (s.o_custkey, s.o_orderstatus, s.o_totalprice, s.RDATETIME, s.UDATETIME)
    IS DISTINCT FROM (t.o_custkey, t.o_orderstatus, t.o_totalprice, t.RDATETIME, t.UDATETIME))"""

ORACLES = {
    "checksum_differences": f"{_COPY} SELECT * FROM differences",
    "checksum_differences_by_day": f"{_COPY} SELECT * FROM differences",
    "checksum_ranges": f"""{_COPY}
SELECT node, COALESCE(s.n, 0) AS source_rows, COALESCE(t.n, 0) AS target_rows
FROM (SELECT DISTINCT CAST(floor(o_orderkey / {KEY_RANGES.width}) AS BIGINT) AS node FROM differences)
LEFT JOIN (SELECT CAST(floor(o_orderkey / {KEY_RANGES.width}) AS BIGINT) AS node, COUNT(*) AS n FROM source GROUP BY 1) s USING (node)
LEFT JOIN (SELECT CAST(floor(o_orderkey / {KEY_RANGES.width}) AS BIGINT) AS node, COUNT(*) AS n FROM copy GROUP BY 1) t USING (node)""",
    "checksum_repair": f"""{_COPY}
SELECT *, CAST(NULL AS TIMESTAMP) AS MIG_DATETIME FROM copy WHERE o_orderkey NOT IN (SELECT o_orderkey FROM differences WHERE status <> 'MISSING')
UNION ALL SELECT *, TIMESTAMP '{fx.RUN_TS}' FROM source WHERE o_orderkey IN (SELECT o_orderkey FROM differences WHERE status <> 'ORPHAN')""",
}
