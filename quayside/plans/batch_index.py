"""Superseded batches without reading the history: the newest load time and its copies of each key, stored.

``dedup.superseded_stamps`` groups all rows ever loaded. A row that is not its key's newest stays so, and its load
time was told when it became so; a new batch can only add load times of its own keys. So the newest load time of each
key, and how many rows it has there, are all that a merge needs. They lie in buckets by the key's hash, of which
only those of the batch's keys are read and written.

After a purge a key whose newest rows went is unknown again. Entries carry the number of their merge, and purged load
times the number of the merge that found them stale, so an entry is void if its load time was purged by its own
merge or a later one, and no entry has to be sought.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.dedup import copies_of
from quayside.operators.schema import STAMP, typed_like
from quayside.plans.publish import Journal, folder_of, publish_parts
from quayside.plans.publish import drop as drop_published
from quayside.plans.settle import settle
from quayside.sources.scans import table_exists

BUCKET = "KEY_BUCKET"
STARTED, DONE = "started", "done"
ENTRY = ["_key", "_stamp", "_copies"]


def _stale_table(name: str) -> str:
    return f"{name}__stale"


def _journal(spark: SparkSession, name: str, place: str | None) -> Journal:
    return Journal(spark, folder_of(spark, name, place) + "__merges")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"_key.`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def drop_index(spark: SparkSession, name: str, place: str | None = None) -> None:
    for table in (name, _stale_table(name)):
        drop_published(spark, table, place)
    journal = _journal(spark, name, place)
    for run in [*journal.runs(STARTED), "settings"]:
        journal.forget(run)


def merge_batch(
    name: str, batch: DataFrame, keys: Sequence[str], run: str, stamp: str = STAMP, buckets: int = 64, place: str | None = None
) -> DataFrame:
    """Merge a batch into the index ``name``, which is created if it does not exist; returns the load times to be purged now.

    These are the load times of rows that are not the single newest of their key, as ``superseded_stamps`` of the whole
    history would tell if all that was returned before has been purged. A repeated ``run`` returns the same and merges
    nothing twice. The first batch may be a whole history. Load times of purged batches may occur again later.
    """
    spark, journal = batch.sparkSession, _journal(batch.sparkSession, name, place)
    told = journal.told("settings", DONE)
    if told is None:
        told = {"keys": list(keys), "buckets": buckets, "stamp": stamp}
        journal.note("settings", DONE, **told)
    if told["keys"] != list(keys) or told["stamp"] != stamp:
        raise ValueError(f"{name} is an index of {told['keys']} by {told['stamp']}")
    if open_ := [r for r in journal.runs(STARTED) if r != run and journal.told(r, DONE) is None]:
        raise ValueError(f"{name}: repeat the run {open_[0]} first")
    if journal.told(run, STARTED) is None:
        journal.note(run, STARTED, number=len(journal.runs(STARTED)))
    number = journal.told(run, STARTED)["number"]

    if journal.told(run, DONE) is None:
        fresh, latest, numbers = _merged(spark, name, batch, told, number)
        stale = _superseded(latest, fresh).withColumn("merge", F.lit(number))
        publish_parts(spark, lambda _: (stale.withColumn("run", F.lit(run)), [(run,)]), _stale_table(name), ["run"], run, place)
        newest = latest.select(*ENTRY, F.lit(number).alias("merge"), _bucket(keys, told["buckets"]).alias(BUCKET))
        publish_parts(spark, lambda _: (newest, [(n,) for n in numbers]), name, [BUCKET], run, place, order=["_key"])
        journal.note(run, DONE)
    return spark.table(_stale_table(name)).where(F.col("run") == run).select(F.col("_stamp").alias(stamp))


def _merged(spark: SparkSession, name: str, batch: DataFrame, told: dict, number: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Counted copies of the batch, the newest of its keys and of the entries that share its buckets, and these buckets."""
    keys, buckets = told["keys"], told["buckets"]
    fresh = copies_of(batch, keys, told["stamp"]).withColumnRenamed(told["stamp"], "_stamp").select(*ENTRY)
    known = spark.table(name) if table_exists(spark, name) else None
    if known is not None:
        fresh = typed_like(fresh, known.select(*ENTRY))
    fresh = settle(fresh.withColumn(BUCKET, _bucket(keys, buckets)), "copies")
    numbers = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # at most as many as there are buckets
    fresh = fresh.select(*ENTRY)
    if known is None:
        return fresh, settle(_latest(fresh), "latest"), numbers
    purged = spark.table(_stale_table(name)).where(F.col("merge") < number).groupBy("_stamp").agg(F.max("merge").alias("_purged"))
    known = known.where(F.col(BUCKET).isin(numbers)).alias("k")
    purged = settle(purged, "purged", compact=True).alias("p")
    void = (F.col("k._stamp") == F.col("p._stamp")) & (F.col("k.merge") <= F.col("p._purged"))
    valid = known.join(purged, void, "left_anti").select(*ENTRY)
    return fresh, settle(_latest(fresh, valid), "latest"), numbers


def _latest(fresh: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The newest load time of each key and its copies, by one grouping of the batch's copies and the known entries.

    Beside them are the load times by which ``_superseded`` needs no join: the known one, of which a key has one at most, and
    the first and last of the batch. Plain numbers and moments only, so that no sort is needed to group them.
    """
    both = fresh.withColumn("_fresh", F.lit(True))
    if known is not None:
        both = both.unionByName(known.withColumn("_fresh", F.lit(False)))
    stamp, copies, new = F.col("_stamp"), F.col("_copies"), F.col("_fresh")
    found = both.groupBy("_key").agg(
        F.max(F.when(~new, stamp)).alias("_known"),
        F.max(F.when(~new & stamp.isNotNull(), copies)).alias("_known_copies"),
        F.min(F.when(new, stamp)).alias("_first"),
        F.max(F.when(new, stamp)).alias("_last"),
        F.max_by(copies, F.when(new, stamp)).alias("_last_copies"),
        F.count(F.when(new, stamp)).alias("_stamps"),
        F.sum(F.when(stamp.isNull(), copies)).alias("_unstamped"),
    )
    newest = F.greatest("_known", "_last")
    there = [F.when(F.col(c) == newest, F.col(f"{c}_copies")) for c in ("_known", "_last")]
    counted = F.coalesce(there[0], F.lit(0)) + F.coalesce(there[1], F.lit(0))
    return found.select(
        "_key",
        F.when(F.col("_unstamped").isNull(), newest).alias("_stamp"),  # none is the newest
        F.coalesce("_unstamped", counted).alias("_copies"),
        "_known", "_first", "_last", "_stamps", F.col("_unstamped").isNotNull().alias("_has_unstamped"),
    )


def _superseded(latest: DataFrame, fresh: DataFrame) -> DataFrame:
    """The load times of rows that are not the single newest of their key.

    Keys with at most two load times in the batch tell theirs by themselves; only others meet the batch's copies again.
    """
    none = F.col("_has_unstamped")
    old = lambda c: none | (F.col(c) < F.col("_stamp")) | (F.col("_copies") > 1)
    told = [F.when(F.col(c).isNotNull() & old(c), F.struct(F.col(c).alias("_stamp"))) for c in ("_known", "_first", "_last")]
    kind = latest.schema["_stamp"].dataType
    told.append(F.when(none, F.struct(F.lit(None).cast(kind).alias("_stamp"))))
    stale = latest.select(F.inline(F.array_compact(F.array(*told))))
    many = settle(latest.where(F.col("_stamps") > 2).select("_key", F.col("_stamp").alias("_newest"), "_has_unstamped"), "many-stamps", compact=True)
    if not many.isEmpty():
        between = fresh.join(many, "_key").where(none | (F.col("_stamp") < F.col("_newest")))
        stale = stale.unionByName(between.select("_stamp"))
    return stale.distinct()
