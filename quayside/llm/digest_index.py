"""Exact deduplication against a persistent index of text digests, bucketed and sorted by digest.

The index is a Parquet table in a shared folder. A load appends one row per distinct text: its SHA-256, how many rows had
it, and if no load had it before, the row that stays. So the rows of a digest tell together who stays and how often
the text came. Rows are written in buckets of the digest, sorted inside each, so that new data meets them in a
sort-merge anti-join for which only the new digests are shuffled. What the anti-join leaves is new.

The number of buckets is noted beside the rows, and opening the index with another one is an error. When loads have left
many files in a bucket, they are written anew as one generation, to which the note then points.

Only digests and ids are moved; no text leaves the task that reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans.publish import Journal
from quayside.plans.settle import release, scratch_path, settle

BUCKETS = 64  # files an append adds at most; about the number of tasks of the anti-join
MANY = 16  # files of a bucket, on average, that make one generation of them worth while


def digest_of(text: Column) -> Column:
    """Binary SHA-256 of the text in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


class DigestIndex:
    """An index at ``path``, new or of an earlier session. ``close`` it when done: its name leaves the catalog, its files stay."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path, self.journal = spark, path, Journal(spark, path)
        told = self.journal.told("index", "settings")
        if told is None:
            told = {"buckets": buckets or BUCKETS, "generation": 0}
            self.journal.note("index", "settings", **told)
        if buckets is not None and told["buckets"] != buckets:
            raise ValueError(f"the index at {path} has {told['buckets']} buckets, not {buckets}")
        self.buckets, self.generation = told["buckets"], told["generation"]
        self._open()

    def _open(self) -> None:
        self.table = f"digest_index_{uuid.uuid4().hex}"  # a name for this session; the files are the index
        place = f"{self.path}/generation={self.generation}"
        quoted = place.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))
        self.spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, rows BIGINT, first BOOLEAN) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(self.buckets)} BUCKETS LOCATION '{quoted}'"
        )

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def read(self) -> DataFrame:
        """One row per text: digest, keep_id, and rows of all loads. Bucketed rows are added up without a shuffle."""
        keep = F.max(F.when(F.col("first"), F.col("keep_id"))).alias("keep_id")
        return self.spark.table(self.table).groupBy("digest").agg(keep, F.sum("rows").alias("rows"))

    def _meet(self, groups: DataFrame, how: str) -> DataFrame:
        """Rows of ``groups`` (digest, ...) whose digest the index does not hold, or does: merged with its sorted buckets."""
        held = self.spark.table(self.table).where("first").select("digest")
        return groups.hint("merge").join(held, "digest", how)

    def load(self, groups: DataFrame) -> None:
        """Add (digest, keep_id, rows), one row per text. One write: a load that fails adds nothing."""
        fresh, again = self._meet(groups, "left_anti"), self._meet(groups, "left_semi")
        self._write(fresh.withColumn("first", F.lit(True)).unionByName(again.withColumn("first", F.lit(False))), "append")
        self.spark.catalog.refreshTable(self.table)
        if len(self.spark.table(self.table).inputFiles()) > MANY * self.buckets:
            self.compact()

    def _write(self, rows: DataFrame, mode: str) -> None:
        # Whole buckets go to a task, so that each gets one file.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        (
            rows.select("digest", "keep_id", "rows", "first")
            .repartition(self.buckets, bucket)
            .write.mode(mode)
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", f"{self.path}/generation={self.generation}")
            .saveAsTable(self.table)
        )

    def compact(self) -> None:
        """Write all rows as a new generation, one per text and file per bucket; the former one goes."""
        rows = settle(self.read().withColumn("first", F.lit(True)), "generation")
        old, table = f"{self.path}/generation={self.generation}", self.table
        self.generation += 1
        release(self.spark, f"{self.path}/generation={self.generation}")  # of an attempt that failed
        self._open()
        self._write(rows, "append")
        self.journal.note("index", "settings", buckets=self.buckets, generation=self.generation)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        release(self.spark, old)


def _digests(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return settle(docs.select(F.col(id_column).cast("bigint").alias("doc_id"), digest_of(F.col(text_column)).alias("digest")), "digests")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per text, counted in the tasks before the shuffle: a text that fills a third of the table is one row per task."""
    return settle(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("rows")), "groups")


def _told(rows: DataFrame, groups: DataFrame, index: DigestIndex) -> DataFrame:
    """What the index tells of each row. A text with one row in all loads is new and says all itself, so only others are looked up.

    Both sides are plain shuffled scans, so adaptive execution splits a text that very many rows share.
    """
    told = settle(groups.select("digest").join(index.read(), "digest").where("rows > 1"), "told")
    found = rows.join(told.withColumn("told", F.lit(True)), "digest", "left")
    keep = F.when(F.col("told"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("rows", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, index: DigestIndex, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Meet ``docs`` with the index, append them, and tell of each row whether it stays.

    Returns one row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256. For a text that an earlier load
    had, keep_id is the id that stayed then; for a new text it is the largest id among its rows. group_size counts the
    rows of all loads up to this one. Texts are compared unchanged, null as the empty text, at any length. Rows without
    id never stay before rows with one; where all ids of a new text are null keep_id is null. Rows that repeat both id
    and text are all kept or all dropped: kept compares ids. Other columns are not read. An empty table returns no rows
    and adds none. The rows returned are computed from what was written; a load that is repeated counts twice.
    """
    rows = _digests(docs, id_column, text_column)
    groups = _groups(rows)
    index.load(groups)
    return _told(rows, groups, index)


def deduplicate_once(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All of ``docs`` through an index of its own: the row with the largest id of each text stays.

    The corpus is loaded in two parts, the larger ids first, so that the second part meets the index of the first and
    what it repeats is dropped by the anti-join. Then all rows are told. The index is removed.
    """
    rows = _digests(docs, id_column, text_column)
    middle = rows.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    later = F.coalesce(F.col("doc_id") >= F.lit(middle), F.lit(False))
    index = DigestIndex(docs.sparkSession, scratch_path(docs.sparkSession, "index"))
    for part in (rows.where(later), rows.where(~later)):
        index.load(_groups(part))
    told = _told(rows, _groups(rows), index)
    drop_index(index)
    return told


def drop_index(index: DigestIndex) -> None:
    """Forget the index and remove its files."""
    index.close()
    release(index.spark, index.path)
