"""The order of a run over chains of prerequisites: waves, the critical path, cycles and what they hold up.

``jobs.ready_jobs`` looks one prerequisite deep. Here jobs are peeled off wave by wave: a job belongs to the wave after the
last of its prerequisites. Each wave is one pass over the prerequisites that are still open, stored before the next,
so a chain of n jobs takes n short passes and the graph is never in one place. What cannot be peeled off lies on a
cycle or behind one; peeling from the other end tells which.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.conditions import in_use
from quayside.functions.dates import in_hour, on_day
from quayside.operators.jobs import DAILY, OK, RAW_LEVEL
from quayside.plans.settle import settle

DONE, PLANNED, CYCLE, HELD = "ALREADY_DONE", "PLANNED", "CYCLE", "HELD"
_STEP = "job string, wave int, start double, finish double, after string, path array<string>"


def _peel(jobs: DataFrame, edges: DataFrame, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Waves of ``jobs`` (job, seconds) by ``edges`` (job, pre), both ends in jobs; also the jobs and edges that are left."""
    spark = jobs.sparkSession
    done = spark.createDataFrame([], _STEP)
    last = F.max(F.struct("finish", F.struct("pre", "path")))
    for wave in range(most):
        ready = jobs.join(edges.select("job").distinct(), "job", "left_anti") if wave == 0 else met
        step = settle(ready, "wave", compact=True) if wave else settle(
            ready.select("job", F.lit(0).alias("wave"), F.lit(0.0).alias("start"), F.col("seconds").alias("finish"), F.lit(None).cast("string").alias("after"), F.array("job").alias("path")),
            "wave", compact=True,
        )
        if step.isEmpty():
            break
        done = settle(done.unionByName(step), "waves", compact=True) if wave % 8 == 7 else done.unionByName(step)
        jobs = settle(jobs.join(step.select("job"), "job", "left_anti"), "left", compact=True)
        # An edge to a job that was peeled off is met; a job none of whose edges is open comes next.
        known = edges.join(done.select(F.col("job").alias("pre"), "finish", "path"), "pre", "left")
        open_ = F.max(F.col("finish").isNull()).alias("_open")
        met = (
            known.join(jobs.select("job"), "job", "left_semi")
            .groupBy("job")
            .agg(open_, last.alias("_last"))
            .where(~F.col("_open"))
            .join(jobs, "job")
            .select(
                "job",
                F.lit(wave + 1).alias("wave"),
                F.col("_last.finish").alias("start"),
                (F.col("_last.finish") + F.col("seconds")).alias("finish"),
                F.col("_last.col2.pre").alias("after"),
                F.concat(F.col("_last.col2.path"), F.array("job")).alias("path"),
            )
        )
    else:
        raise ValueError(f"the run has over {most} waves")
    left = edges.join(jobs.select("job"), "job", "left_semi").join(jobs.select(F.col("job").alias("pre")), "pre", "left_semi")
    return done, jobs, left


def _on_cycles(edges: DataFrame) -> DataFrame:
    """Of edges among jobs that cannot be peeled off, the jobs on cycles or between two of them.

    Both ends are peeled: jobs that nothing waits for, and jobs that wait for nothing that is left.
    """
    edges = settle(edges.select("job", "pre"), "left-edges", compact=True)
    count = edges.count()
    while True:
        awaited = edges.select(F.col("pre").alias("job")).distinct()
        waiting = edges.select(F.col("job").alias("pre")).distinct()
        edges = settle(edges.join(awaited, "job", "left_semi").join(waiting, "pre", "left_semi").select("job", "pre"), "left-edges", compact=True)
        before, count = count, edges.count()
        if before == count:
            return edges.select("job").distinct()


def run_plan(
    job_info: DataFrame,
    pre_job_info: DataFrame,
    log: DataFrame,
    as_of: date,
    schedule: str = DAILY,
    log_schedule: str | None = None,
    hour: datetime | None = None,
    exclude: Sequence[str] = (),
    seconds: DataFrame | None = None,
    most: int = 1000,
) -> DataFrame:
    """Mart jobs of a schedule with the wave of the run they belong to.

    Columns: JOB_CODE, AGG_LEVEL, STATUS, WAVE from 0, START and FINISH in seconds after the run began if each job starts
    as soon as it may, AFTER (the prerequisite that ends last, of several the last in order of code), ON_CRITICAL_PATH.

    A job that has succeeded in time is ``ALREADY_DONE`` and holds up nothing. ``CYCLE`` is a job that waits for itself, or
    lies between two such; ``HELD`` one that waits for such a job, or for one that is neither done nor part of the run.
    The other arguments are those of ``ready_jobs``; its READY jobs are wave 0. ``seconds`` has job_code and seconds, 0 where
    it is silent.
    """
    level = F.col("AGG_LEVEL").try_cast("int")
    started = F.col("start_date")
    today = log.where((on_day(started, as_of) if hour is None else in_hour(started, hour)) & (F.col("status") == OK))
    today = today if log_schedule is None else today.where(F.col("schedule") == log_schedule)
    done = settle(today.select(F.col("job_code").alias("job")).distinct(), "done-jobs", compact=True)
    wanted = (level > RAW_LEVEL) & in_use() & (F.col("SCHEDULE") == schedule) & ~F.col("JOB_CODE").isin(*exclude)
    catalog = settle(job_info.where(wanted).groupBy(F.col("JOB_CODE").alias("job")).agg(F.max(level).alias("AGG_LEVEL")), "jobs", compact=True)
    waiting = catalog.select("job").join(done, "job", "left_anti")
    if seconds is None:
        waiting = waiting.withColumn("seconds", F.lit(0.0))
    else:
        took = seconds.groupBy(F.col("job_code").alias("job")).agg(F.max("seconds").cast("double").alias("_took"))
        waiting = waiting.join(took, "job", "left").select("job", F.coalesce("_took", F.lit(0.0)).alias("seconds"))
    waiting = settle(waiting, "waiting", compact=True)
    edges = pre_job_info.where(in_use() & (F.col("SCHEDULE") == schedule))
    edges = edges.select(F.col("JOB_CODE").alias("job"), F.col("PRE_JOB_CODE").alias("pre")).distinct()
    edges = edges.join(waiting.select("job"), "job", "left_semi").join(done.select(F.col("job").alias("pre")), "pre", "left_anti")
    edges = settle(edges, "edges", compact=True)

    inside = edges.join(waiting.select(F.col("job").alias("pre")), "pre", "left_semi")
    # Jobs that wait for one outside the run never come off: an edge to no job keeps them open.
    outside = edges.join(waiting.select(F.col("job").alias("pre")), "pre", "left_anti")
    steps, left, left_edges = _peel(waiting, inside.unionByName(outside), most)
    steps = settle(steps, "waves", compact=True)
    circles = settle(_on_cycles(left_edges), "cycles", compact=True)
    # The path of the job that ends last; of several the last in order of code.
    critical = steps.agg(F.max(F.struct("finish", "job", "path")).alias("_end")).select(F.explode("_end.path").alias("job"))
    state = (
        steps.select("job", F.lit(PLANNED).alias("STATUS"), "wave", "start", "finish", "after")
        .unionByName(left.select("job", F.lit(None).cast("string").alias("STATUS")), allowMissingColumns=True)
        .join(circles.withColumn("_circle", F.lit(True)), "job", "left")
        .join(critical.withColumn("_critical", F.lit(True)), "job", "left")
    )
    status: Column = F.coalesce("STATUS", F.when(F.col("_circle"), F.lit(CYCLE)).otherwise(F.lit(HELD)))
    planned = state.withColumn("STATUS", status)
    return (
        catalog.join(planned, "job", "left")
        .select(
            F.col("job").alias("JOB_CODE"),
            "AGG_LEVEL",
            F.coalesce("STATUS", F.lit(DONE)).alias("STATUS"),
            F.col("wave").alias("WAVE"),
            F.col("start").alias("START"),
            F.col("finish").alias("FINISH"),
            F.col("after").alias("AFTER"),
            F.coalesce("_critical", F.lit(False)).alias("ON_CRITICAL_PATH"),
        )
        .orderBy("WAVE", "AGG_LEVEL", "JOB_CODE")
    )
