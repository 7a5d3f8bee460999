"""Tables that change in one step, by runs that can be repeated.

A run writes what is new into a version folder of its own and then lets the catalog point to it. Readers see
the old rows until that step and the new ones after it; a run that fails before leaves the table as it was. A journal
beside the versions notes each step of a run, so that a repeated run goes on where it stopped: what is written is not
computed again, what is published is not added again.

* A whole table (``publish_table``) is a view on its version, replaced by one catalog statement, whatever columns it has.
* A history (``publish_parts``) is a table whose partitions each point to the version that last changed them. All
  parts that a run adds appear in one statement; a part that it rewrites is switched by one statement of its own.

Folders lie below ``quayside.tables.dir``, else the warehouse: never in the scratch folder, which ``release`` empties.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quayside.operators.schema import typed_like
from quayside.sources.scans import table_exists
from quayside.sources.sinks import add_columns

WRITTEN, PUBLISHED = "written", "published"
KEPT_VERSIONS = 1  # former versions that running readers may still need


def tables_folder(spark: SparkSession) -> str:
    """Where tables of this library lie."""
    folder = spark.conf.get("quayside.tables.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/quayside_tables"
    return folder.rstrip("/")


def identifier(name: str) -> str:
    """A table name that may stand in a statement: one to three words joined by dots."""
    if not re.fullmatch(r"\w+(\.\w+){0,2}", name):
        raise ValueError(f"not a table name: {name}")
    return name


class Journal:
    """The steps of runs, one small file each, made in one move so that a half-written one is never read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.folder = spark._jvm, f"{folder}/_journal"
        self.conf = spark._jsc.hadoopConfiguration()

    def _place(self, *parts: str):
        path = self.jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path, path.getFileSystem(self.conf)

    def note(self, run: str, step: str, **told) -> None:
        path, files = self._place(run, step)
        half, _ = self._place(run, f"_{step}")
        stream = files.create(half, True)
        try:
            stream.write(bytearray(json.dumps(told).encode()))
        finally:
            stream.close()
        files.delete(path, False)
        if not files.rename(half, path):
            raise OSError(f"cannot note {path}")

    def told(self, run: str, step: str) -> dict | None:
        """What a step noted, None if it is not done."""
        path, files = self._place(run, step)
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def runs(self, step: str) -> list[str]:
        """Runs that have done a step, the oldest first."""
        top, files = self._place()
        if not files.exists(top):
            return []
        done = []
        for run in files.listStatus(top):
            path, _ = self._place(run.getPath().getName(), step)
            if files.exists(path):
                done.append((files.getFileStatus(path).getModificationTime(), run.getPath().getName()))
        return [run for _, run in sorted(done)]

    def forget(self, run: str) -> None:
        path, files = self._place(run)
        files.delete(path, True)


def folder_of(spark: SparkSession, name: str, place: str | None = None) -> str:
    return f"{place or tables_folder(spark)}/{identifier(name)}"


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _checked(run: str) -> str:
    if not re.fullmatch(r"[\w.:-]+", run):
        raise ValueError(f"not a run's name: {run}")
    return run.replace(":", "-")


def publish_table(view: Callable[[], DataFrame] | DataFrame, name: str, run: str, place: str | None = None) -> DataFrame:
    """Make the rows of ``view`` the table ``name``; returns it as this run published it.

    ``view`` is evaluated once, and not at all by a run that is repeated after it was written. The version before this
    one stays for its readers, older ones go. A former stored table of that name is dropped first, once.
    """
    df = view() if callable(view) else view
    spark, run = df.sparkSession, _checked(run)
    folder = folder_of(spark, name, place)
    journal, version = Journal(spark, folder), f"{folder}/version={run}"
    if journal.told(run, WRITTEN) is None:
        df.write.mode("overwrite").parquet(version)
        journal.note(run, WRITTEN)
    if journal.told(run, PUBLISHED) is None:
        if table_exists(spark, name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {identifier(name)}")
        quoted = version.replace("`", "``")
        spark.sql(f"CREATE OR REPLACE VIEW {identifier(name)} AS SELECT * FROM parquet.`{quoted}`")
        journal.note(run, PUBLISHED)
    for old in [r for r in journal.runs(PUBLISHED) if r != run][: -KEPT_VERSIONS or None]:
        _remove(spark, f"{folder}/version={old}")
        journal.forget(old)
    return spark.read.parquet(version)


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


Part = tuple[str, ...]


def publish_parts(
    spark: SparkSession,
    changed: Callable[[DataFrame | None], tuple[DataFrame, Sequence[Part]]],
    name: str,
    partitions: Sequence[str],
    run: str,
    place: str | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Change parts of the table ``name``, which is created if it does not exist; returns the table.

    A part is a tuple of values of the ``partitions`` columns. ``changed`` is given the table (None if there is none) and
    returns the rows that the changed parts have from now on, and the list of these parts; others are not touched. It
    is asked once: a run that is repeated after it wrote its version only switches parts, and one that is published
    does nothing. Versions to which no part pointed before this run are removed. Files are sorted by ``order`` inside.
    """
    run, folder = _checked(run), folder_of(spark, name, place)
    journal, version = Journal(spark, folder), f"{folder}/version={run}"
    if journal.told(run, PUBLISHED) is not None:
        return spark.table(name)
    table = spark.table(name) if table_exists(spark, name) else None
    told = journal.told(run, WRITTEN)
    if told is None:
        rows, parts = changed(table)
        parts = [tuple(map(str, p)) for p in parts]
        rows = typed_like(rows, table) if table is not None else rows
        dealt = rows.hint("rebalance", *partitions)
        dealt = dealt.sortWithinPartitions(*partitions, *order) if order else dealt
        dealt.write.mode("overwrite").partitionBy(*partitions).parquet(version)
        told = {"parts": sorted(map(list, parts)), "schema": rows.schema.json()}
        journal.note(run, WRITTEN, **told)
    empty = spark.createDataFrame([], StructType.fromJson(json.loads(told["schema"])))
    if table is None and not table_exists(spark, name):
        empty.write.partitionBy(*partitions).format("parquet").option("path", f"{folder}/version=none").saveAsTable(name)
    add_columns(empty, name)
    _switch(spark, identifier(name), partitions, told["parts"], version)
    unused = _unused(journal)
    journal.note(run, PUBLISHED, number=len(journal.runs(PUBLISHED)), parts=told["parts"])
    spark.catalog.refreshTable(name)
    for old in unused:
        _remove(spark, f"{folder}/version={old}")
    return spark.table(name)


def _switch(spark: SparkSession, name: str, partitions: Sequence[str], parts: Sequence[Sequence[str]], version: str) -> None:
    """Let the catalog look for the parts in the version: one statement for all new parts, one for each that it knows."""
    known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}  # table layout
    missing = []
    for part in parts:
        path = "/".join(f"{c}={_plain(v)}" for c, v in zip(partitions, part, strict=True))
        _make(spark, f"{version}/{path}")
        spec = "PARTITION (" + ", ".join(f"{c} = '{v}'" for c, v in zip(partitions, part, strict=True)) + ")"
        place = f"{version}/{path}".replace("'", "\\'")
        if path in known:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{place}'")
        else:
            missing.append(f"{spec} LOCATION '{place}'")
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(missing)}")


def _plain(value: str) -> str:
    """A partition value that Spark writes into a path as it is: months, runs and the mark of undated rows."""
    if not re.fullmatch(r"[\w.-]+", value):
        raise ValueError(f"not a name of a part: {value}")
    return value


def _make(spark: SparkSession, path: str) -> None:
    """A part without rows has an empty folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


def _unused(journal: Journal) -> list[str]:
    """Published runs whose every part was published again by a later run."""
    told = sorted(((journal.told(r, PUBLISHED) or {}).get("number", 0), r) for r in journal.runs(PUBLISHED))
    holder = {tuple(p): r for _, r in told for p in (journal.told(r, PUBLISHED) or {}).get("parts", [])}
    return [r for _, r in told if r not in holder.values()]


def drop(spark: SparkSession, name: str, place: str | None = None) -> None:
    """Remove a published table: its name, versions and journal."""
    if table_exists(spark, name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {identifier(name)}")
    _remove(spark, folder_of(spark, name, place))
