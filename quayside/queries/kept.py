"""What is kept up beside a table: counts by difference, sketches of distinct items, one schema, balanced ranges."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import distinct
from quayside.plans import counters, publish, schema_register
from quayside.plans.settle import settle
from quayside.queries import fixtures as fx
from quayside.queries import sales
from quayside.sources import databases
from quayside.sources.scans import table

JOB = "ORDERS"


def _noted(spark: SparkSession, folder: str, counter: str, forget: bool = False) -> None:
    """The target as it was, and the daily load; ``forget`` leaves out what the load removed."""
    target = fx.order_target(spark, folder)
    batch = settle(fx.order_source(spark, folder).where(fx.WINDOW), "batch")
    gone = counters.removed_by(target, batch, fx.ORDER_KEYS, fx.WINDOW)
    counters.note_changes(counter, JOB, "before", added=[target])
    for _ in range(2):  # a repeated run is noted once
        counters.note_changes(counter, JOB, "day", added=[batch], removed=[] if forget else [gone])


def monthly_counts_by_difference(spark: SparkSession, folder: str) -> DataFrame:
    counter = f"counter_{uuid.uuid4().hex}"
    try:
        _noted(spark, folder, counter)
        return settle(counters.counted_months(spark, counter, fx.AS_OF), "counts")
    finally:
        publish.drop(spark, counter)


def month_counter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The months that a counter has wrong which was not told of the removed rows; after the audit it is right."""
    from quayside.queries.loads import incremental_upsert_daily

    counter = f"counter_{uuid.uuid4().hex}"
    try:
        _noted(spark, folder, counter, forget=True)
        loaded = settle(incremental_upsert_daily(spark, folder).select("RDATETIME"), "loaded")
        wrong = counters.audit(counter, JOB, loaded, "audit")
        again = counters.audit(counter, JOB, loaded, "again").select("date", F.lit("AGAIN").alias("turn"), "counted", "row_count")
        return settle(wrong.select("date", F.lit("FIRST").alias("turn"), "counted", "row_count").unionByName(again), "audit")
    finally:
        publish.drop(spark, counter)


CLASS = "GT_PRODUCT_DETAIL_DE"
TOLERANCE = 0.05


def distinct_customers_verify(spark: SparkSession, folder: str) -> DataFrame:
    """Buying customers per product class in the month, as another system states them: too many in one class, a few more in others."""
    facts = settle(sales.order_fact(spark, folder).select(CLASS, "CUSTOMER_CODE", "PAY_DAY"), "facts")
    sketches = settle(distinct.daily_sketches(facts, [CLASS], "PAY_DAY", "CUSTOMER_CODE"), "sketches")
    true = distinct.exact(facts, [CLASS], "PAY_DAY", "CUSTOMER_CODE", sales.START, sales.END)
    factor = F.when(F.col(CLASS) == "060001", F.lit(1.5)).when(F.col(CLASS) == "060002", F.lit(1.04)).otherwise(F.lit(1.0))
    stated = settle(true.select(CLASS, F.floor(F.col("exact") * factor).alias("stated")), "stated")
    found = distinct.verify_counts(stated, facts, sketches, [CLASS], "PAY_DAY", "CUSTOMER_CODE", sales.START, sales.END, TOLERANCE)
    return found.select(CLASS, "stated", "CHECK")


PARTS = 16


def balanced_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Orders under a key of which a third lie in one narrow stretch, cut into ranges: rows, rows placed in a range, and whether no range is over twice the median."""
    key = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 997 + 50_000).otherwise(F.col("o_orderkey") * 10)
    rows = settle(table(spark, folder, "orders").select(key.alias("k")), "keys")
    ends = rows.agg(F.min("k"), F.max("k")).first()

    def counts(low: int, end: int, width: int) -> dict[int, int]:
        return {r.bin: r.n for r in databases.histogram(rows.where(F.col("k") < end), "k", low, width).collect()}

    edges = databases.balanced_edges(counts, *ends, PARTS)
    predicates = databases.range_predicates("k", edges)
    placed = reduce(DataFrame.unionByName, [rows.where(p).agg(F.lit(i).alias("part"), F.count(F.lit(1)).alias("n")) for i, p in enumerate(predicates)])
    inside = settle(placed.where("n > 0"), "ranges")
    both = inside.select("n", F.lit(0).alias("rows")).unionByName(rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(None).cast("bigint").alias("n"), "rows"))
    return both.agg(F.max("rows").alias("row_count"), F.sum("n").alias("placed"), (F.max("n") <= 2 * F.percentile("n", 0.5)).alias("balanced"))


def registered_load(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches with other spellings, types and columns, brought to the one schema that all of them give."""
    register = f"schemas_{uuid.uuid4().hex}"
    orders = fx.order_source(spark, folder)
    part = lambda k: orders.where(F.col("o_orderkey") % 3 == k)
    batches = [
        part(0).select(F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_custkey").cast("int").alias("O_CUSTKEY"), F.to_date("RDATETIME").alias("RDATETIME")),
        part(1).select("o_orderkey", F.col("o_custkey").cast("decimal(12,0)").alias("o_custkey"), "RDATETIME", F.col("o_orderstatus").alias("mark")),
        part(2).select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "RDATETIME", F.col("o_totalprice").alias("MARK")),
    ]
    try:
        for i in (2, 0, 1):
            schema_register.note_schema(spark, register, batches[i].schema, f"batch{i}")
        schema, _ = schema_register.registered(spark, register)
        return reduce(DataFrame.unionByName, [schema_register.fitted(b, schema) for b in batches])
    finally:
        publish.drop(spark, register)


QUERIES = {
    "monthly_counts_by_difference": monthly_counts_by_difference,
    "month_counter_audit": month_counter_audit,
    "distinct_customers_verify": distinct_customers_verify,
    "balanced_ranges": balanced_ranges,
    "registered_load": registered_load,
}

_LOADED = f"""WITH {fx.ORDER_CTES},
batch AS (SELECT * FROM source WHERE {fx.WINDOW_SQL}),
kept AS (
  SELECT RDATETIME FROM target
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch WHERE UDATETIME IS NOT NULL) AND ({fx.WINDOW_SQL}) IS NOT TRUE),
loaded AS (SELECT strftime(RDATETIME, '%Y-%m') AS date FROM kept UNION ALL SELECT strftime(RDATETIME, '%Y-%m') FROM batch),
noted AS (SELECT strftime(RDATETIME, '%Y-%m') AS date FROM target UNION ALL SELECT strftime(RDATETIME, '%Y-%m') FROM batch)"""
_FIRST_CLASS = "'06000' || (l_suppkey % 6)"

ORACLES = {
    "monthly_counts_by_difference": f"{_LOADED} SELECT 'ORDERS' AS job_code, date, COUNT(*) AS row_count FROM loaded WHERE date >= '2000-08' GROUP BY date",
    "month_counter_audit": f"""{_LOADED},
l AS (SELECT date, COUNT(*) AS n FROM loaded GROUP BY date), c AS (SELECT date, COUNT(*) AS n FROM noted GROUP BY date)
SELECT date, 'FIRST' AS turn, c.n AS counted, COALESCE(l.n, 0) AS row_count FROM c LEFT JOIN l USING (date) WHERE c.n <> COALESCE(l.n, 0)""",
    "distinct_customers_verify": f"""WITH counted AS (
  SELECT {_FIRST_CLASS} AS {CLASS}, COUNT(DISTINCT o_custkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{sales.START}' AND DATE '{sales.END}' GROUP BY 1),
stated AS (
  SELECT {CLASS}, n, CAST(floor(n * CASE {CLASS} WHEN '060001' THEN 1.5::DOUBLE WHEN '060002' THEN 1.04::DOUBLE ELSE 1.0::DOUBLE END) AS BIGINT) AS stated FROM counted)
SELECT {CLASS}, stated, CASE WHEN abs(stated - n) > {TOLERANCE}::DOUBLE * n THEN 'Error' ELSE '' END AS "CHECK" FROM stated""",
    "balanced_ranges": "SELECT COUNT(*) AS row_count, COUNT(*) AS placed, TRUE AS balanced FROM orders",
    "registered_load": f"""WITH {fx.ORDER_CTES}
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS "O_CUSTKEY",
       CASE WHEN o_orderkey % 3 = 0 THEN date_trunc('day', RDATETIME) ELSE RDATETIME END AS RDATETIME,
       CASE o_orderkey % 3 WHEN 1 THEN o_orderstatus WHEN 2 THEN CAST(o_totalprice AS VARCHAR) END AS "MARK"
FROM source""",
}
