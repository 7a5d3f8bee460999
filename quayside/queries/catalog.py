"""Schemas from a column catalog, the job catalogs, readiness and the gate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import jobs, run_order, schema
from quayside.plans.settle import scratch_path, settle
from quayside.queries import fixtures as fx
from quayside.sources import catalogs, sinks
from quayside.sources.scans import table

# The source types of the fixture's columns, dealt out in turn.
TYPES = [
    "int", "bigint", "numeric", "decimal", "money", "float", "real", "char", "nchar", "varchar",
    "nvarchar", "text", "image", "date", "datetime", "time", "uniqueidentifier",
]


def column_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """A column catalog with one column per part and one table per brand."""
    key = F.col("p_partkey")
    types = F.array(*[F.lit(t) for t in TYPES])
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("TABLE_NAME"),
        F.concat(F.lit("C"), key.cast("string")).alias("COLUMN_NAME"),
        (key + 1).cast("int").alias("ORDINAL_POSITION"),
        F.element_at(types, (key % len(TYPES) + 1).cast("int")).alias("DATA_TYPE"),
        F.when(key % 5 != 0, F.col("p_size") % 20 + 10).alias("NUMERIC_PRECISION"),
        F.when(key % 5 != 0, F.col("p_size") % 7).alias("NUMERIC_SCALE"),
        F.when(F.col("p_size") % 2 == 0, F.lit("YES")).otherwise(F.lit("NO")).alias("IS_NULLABLE"),
        F.when(F.col("p_size") == 1, (key % 3 + 1).cast("int")).alias("KEY_POSITION"),
    )


def derive_table_schema(spark: SparkSession, folder: str) -> DataFrame:
    return schema.derive_schema(column_catalog(spark, folder))


def derive_table_schema_lossy(spark: SparkSession, folder: str) -> DataFrame:
    return schema.derive_schema(column_catalog(spark, folder), lossy=True)


def _refreshed(spark: SparkSession, rows: DataFrame, schema: str) -> DataFrame:
    """A catalog kept as CSV, in the place of the stored one of the day before."""
    kept, path = scratch_path(spark, "kept"), scratch_path(spark, "catalog")
    rows.write.csv(kept, header=True)
    sinks.replace(catalogs.stamp_catalog(rows, fx.EVENTS_OLD_TS), path)
    return catalogs.refresh_catalog(spark, kept, schema, path, fx.EVENTS_RUN_TS)


def catalog_refresh(spark: SparkSession, folder: str) -> DataFrame:
    return _refreshed(spark, fx.job_info(spark, folder), catalogs.JOB_INFO)


def catalog_refresh_predicates(spark: SparkSession, folder: str) -> DataFrame:
    return _refreshed(spark, fx.job_table_info(spark, folder), catalogs.JOB_TABLE_INFO)


def catalog_refresh_prerequisites(spark: SparkSession, folder: str) -> DataFrame:
    return _refreshed(spark, fx.pre_job_info(spark, folder), catalogs.PRE_JOB_INFO)


def eligible_load_jobs(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.eligible_jobs(fx.job_info(spark, folder), fx.job_table_info(spark, folder), exclude=["J4"])


def eligible_load_jobs_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.eligible_jobs(
        fx.job_info(spark, folder),
        fx.job_table_info(spark, folder),
        jobs.HOURLY,
        predicate="UPDATE_COL_RT",
        source_predicate="UPDATE_COL_RT_2",
    )


def listed_load_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """The jobs whose months are counted: those loaded by the usual window."""
    usual = fx.job_table_info(spark, folder).where(F.col("UPDATE_COL").isin(fx.USUAL_WINDOWS))
    return jobs.listed_jobs(fx.job_info(spark, folder), usual)


def ready_jobs(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.ready_jobs(
        fx.job_info(spark, folder), fx.pre_job_info(spark, folder), fx.job_log(spark, folder), fx.LOG_DAY
    )


def ready_jobs_same_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.ready_jobs(
        fx.job_info(spark, folder),
        fx.pre_job_info(spark, folder),
        fx.job_log(spark, folder),
        fx.LOG_DAY,
        log_schedule=jobs.DAILY,
    )


LOG_HOUR = datetime(2024, 1, 30, 12, 0)


def ready_jobs_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.ready_jobs(
        fx.job_info(spark, folder),
        fx.pre_job_info(spark, folder),
        fx.job_log(spark, folder),
        fx.LOG_DAY,
        schedule=jobs.HOURLY,
        log_schedule=jobs.HOURLY,
        hour=LOG_HOUR,
    )


def _run_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The prerequisites, and pairs of jobs that wait for each other."""
    user = F.col("user_id")
    pair = F.when(user % 30 == 22, user + 1).when(user % 30 == 23, user - 1)
    pairs = fx.users(spark, folder).select(user, pair.alias("pre")).where("pre IS NOT NULL").join(
        fx.users(spark, folder).select(F.col("user_id").alias("pre")), "pre", "left_semi"
    )
    code = lambda c: F.concat(F.lit("J"), F.col(c).cast("string"))
    extra = pairs.select(code("user_id").alias("JOB_CODE"), code("pre").alias("PRE_JOB_CODE"), F.lit("N").alias("DEL_YN"), F.lit(jobs.DAILY).alias("SCHEDULE"))
    return fx.pre_job_info(spark, folder).unionByName(extra)


def mart_run_plan(spark: SparkSession, folder: str) -> DataFrame:
    """The run of a day on which all jobs that are no daily marts have succeeded."""
    log = fx.job_log(spark, folder).join(
        fx.job_info(spark, folder).where("AGG_LEVEL = '0' OR SCHEDULE = 'H' OR DEL_YN = 'Y' OR DEL_YN IS NULL").select(F.col("JOB_CODE").alias("job_code")), "job_code", "left_semi"
    )
    seconds = fx.users(spark, folder).select(F.concat(F.lit("J"), F.col("user_id").cast("string")).alias("job_code"), (F.col("user_id") % 7 + 1).alias("seconds"))
    done = log.withColumns({"status": F.lit(jobs.OK), "start_date": F.lit(fx.LOG_DAY).cast("timestamp_ntz")})
    return run_order.run_plan(fx.job_info(spark, folder), _run_edges(spark, folder), done, fx.LOG_DAY, seconds=seconds)


def mart_quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.quality_gate(fx.job_log(spark, folder), fx.LOG_DAY)


def mart_quality_gate_latest(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.quality_gate(fx.job_log(spark, folder), fx.LOG_DAY, latest_only=True)


def mart_log_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The mart log of the day's run. The events of a ready job tell when it ran, what it made and whether it failed."""
    states = settle(ready_jobs(spark, folder), "states")
    events = fx.job_log(spark, folder).groupBy("job_code").agg(
        F.min("start_date").alias("start_date"),
        F.max("start_date").alias("end_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.when(F.bool_or(F.col("status") == jobs.FAILED), F.lit("failed")).alias("error"),
    )
    ready = states.where(F.col("STATUS") == "READY").select(F.col("JOB_CODE").alias("job_code"))
    return jobs.mart_log(states, events.join(ready, "job_code", "left_semi"), fx.EVENTS_RUN_TS)


QUERIES = {
    "derive_table_schema": derive_table_schema,
    "derive_table_schema_lossy": derive_table_schema_lossy,
    "catalog_refresh": catalog_refresh,
    "catalog_refresh_predicates": catalog_refresh_predicates,
    "catalog_refresh_prerequisites": catalog_refresh_prerequisites,
    "eligible_load_jobs": eligible_load_jobs,
    "eligible_load_jobs_hourly": eligible_load_jobs_hourly,
    "listed_load_jobs": listed_load_jobs,
    "ready_jobs": ready_jobs,
    "ready_jobs_hourly": ready_jobs_hourly,
    "ready_jobs_same_schedule": ready_jobs_same_schedule,
    "mart_log_rows": mart_log_rows,
    "mart_run_plan": mart_run_plan,
    "mart_quality_gate": mart_quality_gate,
    "mart_quality_gate_latest": mart_quality_gate_latest,
}

_TYPE_LIST = ", ".join(f"'{t}'" for t in TYPES)


def _schema_sql(decimal: str, money: str) -> str:
    sized = "'decimal(' || COALESCE(CAST(precision_ AS VARCHAR), '18') || ',' || COALESCE(CAST(scale_ AS VARCHAR), '0') || ')'"
    return f"""WITH columns_ AS (
  SELECT p_brand AS TABLE_NAME, 'C' || p_partkey AS COLUMN_NAME, CAST(p_partkey + 1 AS INTEGER) AS ORDINAL_POSITION,
         [{_TYPE_LIST}][p_partkey % {len(TYPES)} + 1] AS type_,
         CASE WHEN p_partkey % 5 <> 0 THEN p_size % 20 + 10 END AS precision_,
         CASE WHEN p_partkey % 5 <> 0 THEN p_size % 7 END AS scale_,
         p_size % 2 = 0 AS null_,
         CASE WHEN p_size = 1 THEN CAST(p_partkey % 3 + 1 AS INTEGER) END AS KEY_POSITION
  FROM part)
SELECT TABLE_NAME, COLUMN_NAME, ORDINAL_POSITION,
       CASE WHEN type_ = 'int' THEN 'int' WHEN type_ = 'bigint' THEN 'bigint'
            WHEN type_ = 'numeric' THEN {sized} WHEN type_ = 'decimal' THEN {decimal.format(sized=sized)}
            WHEN type_ = 'money' THEN '{money}' WHEN type_ = 'float' THEN 'double' WHEN type_ = 'real' THEN 'float'
            WHEN type_ = 'image' THEN 'binary' WHEN type_ = 'date' THEN 'date' WHEN type_ = 'datetime' THEN 'timestamp_ntz'
            ELSE 'string' END AS SPARK_TYPE,
       null_ AND KEY_POSITION IS NULL AS NULLABLE, KEY_POSITION
FROM columns_
UNION ALL
SELECT TABLE_NAME, 'MIG_DATETIME', MAX(ORDINAL_POSITION) + 1, 'timestamp_ntz', TRUE, NULL FROM columns_ GROUP BY TABLE_NAME"""


def _ready_sql(schedule: str, log_condition: str) -> str:
    return f"""WITH {fx.JOB_CTES},
done AS (SELECT DISTINCT job_code FROM log WHERE status = 'O' AND {log_condition}),
pre AS (
  SELECT p.JOB_CODE, COUNT(*) AS listed, COUNT(d.job_code) AS met
  FROM pre_job_info p LEFT JOIN done d ON p.PRE_JOB_CODE = d.job_code
  WHERE p.SCHEDULE = '{schedule}' GROUP BY p.JOB_CODE)
SELECT j.JOB_CODE, CAST(j.AGG_LEVEL AS INTEGER) AS AGG_LEVEL, j.ACCUMULATE,
       COALESCE(p.listed, 0) AS PRE_JOBS, COALESCE(p.met, 0) AS PRE_JOBS_DONE,
       CASE WHEN d.job_code IS NOT NULL THEN 'ALREADY_DONE'
            WHEN COALESCE(p.listed, 0) = COALESCE(p.met, 0) THEN 'READY' ELSE 'BLOCKED' END AS STATUS
FROM job_info j LEFT JOIN pre p ON j.JOB_CODE = p.JOB_CODE LEFT JOIN done d ON j.JOB_CODE = d.job_code
WHERE j.DEL_YN <> 'Y' AND j.SCHEDULE = '{schedule}' AND CAST(j.AGG_LEVEL AS INTEGER) >= 1"""


def _eligible_sql(schedule: str, counted: str, source: str, wanted: str) -> str:
    return f"""WITH {fx.JOB_CTES},
texts AS (SELECT JOB_CODE, COUNT(*) AS n, MAX(UPDATE_COL) AS text_ FROM job_table_info WHERE {counted} GROUP BY JOB_CODE)
SELECT j.JOB_CODE, CASE WHEN n = 1 THEN text_ END AS PREDICATE, CASE WHEN n = 1 THEN {source} END AS SOURCE_PREDICATE,
       CASE WHEN n = 1 THEN 'RUN' ELSE 'SKIPPED' END AS STATUS
FROM job_info j LEFT JOIN texts t ON j.JOB_CODE = t.JOB_CODE
WHERE AGG_LEVEL = '0' AND DEL_YN <> 'Y' AND SCHEDULE = '{schedule}' AND {wanted}"""


_ON_DAY = f"start_date >= TIMESTAMP '{fx.LOG_DAY}' AND start_date < TIMESTAMP '{fx.EVENTS_AS_OF}'"
_IN_HOUR = f"CAST(start_date AS DATE) = DATE '{fx.LOG_DAY}' AND hour(start_date) = {LOG_HOUR.hour} AND schedule = 'H'"
_USUAL = ", ".join("'" + text.replace("'", "''") + "'" for text in fx.USUAL_WINDOWS)
_WIDER = "text_ || ' OR UDATETIME >= DATE ' || chr(39) || '2024-01-30' || chr(39)"
_TODAY = f"insert_time >= TIMESTAMP '{fx.LOG_DAY}' AND insert_time < TIMESTAMP '{fx.EVENTS_AS_OF}'"

ORACLES = {
    "derive_table_schema": _schema_sql("{sized}", "decimal(19,4)"),
    "derive_table_schema_lossy": _schema_sql("'double'", "double"),
    "catalog_refresh": f"WITH {fx.JOB_CTES} SELECT *, '{fx.EVENTS_RUN_TS:%Y-%m-%d}' AS UDATETIME FROM job_info",
    "catalog_refresh_predicates": f"""WITH {fx.JOB_CTES}
SELECT JOB_CODE, UPDATE_COL, CASE WHEN switched_off THEN 'X' ELSE UPDATE_COL END AS UPDATE_COL_RT,
       UPDATE_COL || ' OR UDATETIME >= DATE ''2024-01-30''' AS UPDATE_COL_RT_2, 'N' AS DEL_YN, '{fx.EVENTS_RUN_TS:%Y-%m-%d}' AS UDATETIME
FROM job_table_info""",
    "catalog_refresh_prerequisites": f"""WITH {fx.JOB_CTES}
SELECT JOB_CODE, PRE_JOB_CODE, 'N' AS DEL_YN, SCHEDULE, '{fx.EVENTS_RUN_TS:%Y-%m-%d}' AS UDATETIME FROM pre_job_info""",
    "eligible_load_jobs": _eligible_sql("D", "TRUE", "text_", "j.JOB_CODE <> 'J4'"),
    "eligible_load_jobs_hourly": _eligible_sql("H", "NOT switched_off", _WIDER, "TRUE"),
    "listed_load_jobs": f"""WITH {fx.JOB_CTES}
SELECT JOB_CODE FROM job_info
WHERE AGG_LEVEL = '0' AND DEL_YN <> 'Y' AND SCHEDULE = 'D'
  AND JOB_CODE IN (SELECT JOB_CODE FROM job_table_info WHERE UPDATE_COL IN ({_USUAL}))""",
    "ready_jobs": _ready_sql("D", _ON_DAY),
    "ready_jobs_same_schedule": _ready_sql("D", f"{_ON_DAY} AND schedule = 'D'"),
    "ready_jobs_hourly": _ready_sql("H", _IN_HOUR),
    "mart_log_rows": f"""WITH states AS ({_ready_sql("D", _ON_DAY)}),
events_ AS (
  SELECT 'J' || user_id AS job_code, MIN(ts) AS start_date, MAX(ts) AS end_date, COUNT(*) AS row_count,
         COUNT(*) FILTER (WHERE event_type = 'error') > 0 AS failed
  FROM events GROUP BY user_id)
SELECT job_code, start_date, CASE WHEN NOT failed THEN end_date END AS end_date, CASE WHEN failed THEN 'X' ELSE 'O' END AS status,
       CASE WHEN failed THEN 0 ELSE row_count END AS row_count, 'D' AS schedule, CASE WHEN failed THEN 'failed' END AS error
FROM events_ WHERE job_code IN (SELECT JOB_CODE FROM states WHERE STATUS = 'READY')
UNION ALL
SELECT JOB_CODE, CASE WHEN STATUS = 'BLOCKED' THEN TIMESTAMP '{fx.EVENTS_RUN_TS}' END, NULL, 'X', 0, 'D',
       CASE WHEN STATUS = 'BLOCKED' THEN 'prerequisite not done' ELSE 'already done' END
FROM states WHERE STATUS <> 'READY'""",
    "mart_run_plan": f"""WITH RECURSIVE {fx.JOB_CTES},
wanted AS (
  SELECT CAST(substr(JOB_CODE, 2) AS BIGINT) AS u, JOB_CODE AS job, CAST(AGG_LEVEL AS INTEGER) AS AGG_LEVEL, CAST(substr(JOB_CODE, 2) AS BIGINT) % 7 + 1.0::DOUBLE AS seconds
  FROM job_info WHERE AGG_LEVEL <> '0' AND DEL_YN <> 'Y' AND SCHEDULE = 'D'),
edges AS (
  SELECT job, 'J' || (u // d) AS pre FROM wanted, (SELECT unnest([2, 3]) AS d) WHERE u >= d AND 'J' || (u // d) IN (SELECT job FROM wanted)
  UNION SELECT job, 'J' || CASE u % 30 WHEN 22 THEN u + 1 ELSE u - 1 END FROM wanted
  WHERE u % 30 IN (22, 23) AND 'J' || CASE u % 30 WHEN 22 THEN u + 1 ELSE u - 1 END IN (SELECT job FROM wanted)),
walk(job, depth) AS (
  SELECT job, 0 FROM wanted UNION SELECT e.job, w.depth + 1 FROM walk w JOIN edges e ON e.pre = w.job WHERE w.depth < 40),
waves AS (SELECT job, MAX(depth) AS wave FROM walk GROUP BY job),
reach(job, pre) AS (SELECT job, pre FROM edges UNION SELECT r.job, e.pre FROM reach r JOIN edges e ON e.job = r.pre),
circles AS (SELECT DISTINCT job FROM reach WHERE job = pre),
planned AS (SELECT w.*, wave FROM wanted w JOIN waves USING (job) WHERE wave < 40),
ends(job, finish) AS (
  SELECT job, seconds FROM planned
  UNION SELECT e.job, x.finish + p.seconds FROM ends x JOIN edges e ON e.pre = x.job JOIN planned p ON p.job = e.job),
finishes AS (SELECT job, MAX(finish) AS finish FROM ends GROUP BY job),
afters AS (
  SELECT e.job, e.pre FROM edges e JOIN finishes f ON f.job = e.pre JOIN planned p ON p.job = e.job
  QUALIFY ROW_NUMBER() OVER (PARTITION BY e.job ORDER BY f.finish DESC, e.pre DESC) = 1),
critical(job) AS (
  SELECT job FROM (SELECT job FROM finishes ORDER BY finish DESC, job DESC LIMIT 1)
  UNION SELECT a.pre FROM critical c JOIN afters a ON a.job = c.job)
SELECT w.job AS JOB_CODE, w.AGG_LEVEL, CASE WHEN p.job IS NOT NULL THEN 'PLANNED' WHEN c.job IS NOT NULL THEN 'CYCLE' ELSE 'HELD' END AS STATUS,
       CAST(p.wave AS INTEGER) AS WAVE, f.finish - w.seconds AS START, f.finish AS FINISH, a.pre AS AFTER, x.job IS NOT NULL AS ON_CRITICAL_PATH
FROM wanted w LEFT JOIN planned p ON p.job = w.job LEFT JOIN circles c ON c.job = w.job LEFT JOIN finishes f ON f.job = p.job
LEFT JOIN afters a ON a.job = p.job LEFT JOIN critical x ON x.job = w.job""",
    "mart_quality_gate": f"""WITH {fx.JOB_CTES}
SELECT COUNT(*) FILTER (WHERE status IS NULL OR status = 'X') = 0 AS gate_open,
       COUNT(*) FILTER (WHERE status IS NULL OR status = 'X') AS bad_rows, COUNT(*) AS log_rows
FROM log WHERE {_TODAY}""",
    "mart_quality_gate_latest": f"""WITH {fx.JOB_CTES},
latest AS (SELECT * FROM log WHERE {_TODAY}
           QUALIFY ROW_NUMBER() OVER (PARTITION BY job_code ORDER BY insert_time DESC,
                                      status IS NULL OR status = 'X' DESC) = 1)
SELECT COUNT(*) FILTER (WHERE status IS NULL OR status = 'X') = 0 AS gate_open,
       COUNT(*) FILTER (WHERE status IS NULL OR status = 'X') AS bad_rows, COUNT(*) AS log_rows
FROM latest""",
}
