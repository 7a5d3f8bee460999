"""Comparison of source and target by a tree of checksums, so that only ranges that differ are read.

Equal counts hide a month in which one row was lost and another one added. Here each row has a hash, and
each range of a numeric or date column a checksum that does not depend on the order of its rows: how many there
are, and two sums over their hashes. Ranges of ``width`` are the leaves; ``fanout`` neighbours form one node
of the next level. The trees of both sides are compared from the top: only children of nodes that differ are
looked at. What remains is a short list of ranges, which both sides are asked for by a filter that reaches
the scan, and one grouping by key tells missing, orphan and changed keys.

The leaves of a side are one scan with one row per range as its result, or a query that a database runs
(``leaves_query``). They may be stored, since sums of parts are sums of wholes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.dates import ntz
from quayside.operators.schema import STAMP, named_like
from quayside.operators.upsert import delete_keys, stamped
from quayside.plans.settle import settle

MISSING, ORPHAN, CHANGED = "MISSING", "ORPHAN", "CHANGED"
SUMS = ["row_count", "high", "low"]
PARTS = 30  # bits of a hash in one sum: eight thousand million rows of a range cannot overflow it


class Ranges(NamedTuple):
    """How a column is cut: numbers into ranges of ``width``, dates and times into ranges of ``width`` days."""

    column: str
    width: int
    fanout: int = 16
    levels: int = 5


def _kind(df: DataFrame, ranges: Ranges) -> type[T.DataType]:
    kind = type(df.schema[ranges.column].dataType)
    if not issubclass(kind, T.IntegralType | T.DateType | T.TimestampType | T.TimestampNTZType):
        raise ValueError(f"{ranges.column} is neither a whole number nor a date")
    return kind


def _cut(number: Column, width: Column) -> Column:
    """The range a whole number lies in, rounded down also below zero."""
    return F.call_function("div", number - F.pmod(number, width), width)


def _leaf(df: DataFrame, ranges: Ranges) -> Column:
    column = F.col(ranges.column)
    if not issubclass(_kind(df, ranges), T.IntegralType):
        column = F.datediff(column, F.lit(date(1970, 1, 1)))
    return _cut(column.cast("bigint"), F.lit(ranges.width))


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of a row that Spark alone computes. NULL and empty differ, and so do values that change columns."""
    return F.xxhash64(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns])


def portable_hash(columns: Sequence[str]) -> Column:
    """The same hash as ``leaves_query``: of whole numbers, texts, dates and times (to the second) as text."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\0")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 15), 16, 10).cast("bigint")


def leaves(df: DataFrame, ranges: Ranges, columns: Sequence[str], portable: bool = False) -> DataFrame:
    """One row per range: node, row_count, high, low. Rows without a value in the column form a range of their own."""
    hashed = portable_hash(columns) if portable else row_hash(columns)
    mask = (1 << PARTS) - 1
    rows = df.select(_leaf(df, ranges).alias("node"), hashed.alias("_hash"))
    return rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.shiftright("_hash", PARTS).bitwiseAND(F.lit(mask))).alias("high"),
        F.sum(F.col("_hash").bitwiseAND(F.lit(mask))).alias("low"),
    )


def leaves_query(table: str, ranges: Ranges, columns: Sequence[str]) -> str:
    """``leaves`` of a numeric column for a database with MD5 hashes; the texts must be UTF-8 there."""
    for name in (table, ranges.column, *columns):
        if not re.fullmatch(r'[\w.\[\]"]+', name):
            raise ValueError(f"not a table or column name: {name}")
    texts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR(4000)), '\\0')" for c in columns)
    digits = f"SUBSTRING(CONVERT(CHAR(32), HASHBYTES('MD5', CONCAT_WS('|', {texts})), 2), 1, 15)"
    number = f"CONVERT(BIGINT, CONVERT(VARBINARY(8), '0x0' + {digits}, 1))"
    cut = f"({ranges.column} - ((({ranges.column} % {ranges.width}) + {ranges.width}) % {ranges.width})) / {ranges.width}"
    scale = 1 << PARTS
    return (
        f"SELECT node, COUNT_BIG(*) AS row_count, SUM(h / {scale} % {scale}) AS high, SUM(h % {scale}) AS low "
        f"FROM (SELECT {cut} AS node, {number} AS h FROM {table}) t GROUP BY node"
    )


def tree(leaf_rows: DataFrame, ranges: Ranges) -> DataFrame:
    """All levels over the leaves (level 0): level, node and the sums, from one grouping of the leaves."""
    step = F.pow(F.lit(ranges.fanout), F.col("level")).cast("bigint")
    lifted = leaf_rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(ranges.levels - 1))))
    lifted = lifted.withColumn("node", _cut(F.col("node"), step))
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in SUMS]
    return lifted.groupBy("level", "node").agg(*wide)


def _unequal(source: DataFrame, target: DataFrame) -> DataFrame:
    """Nodes whose sums differ, or that one side lacks."""
    signs = [F.col(c) for c in SUMS]
    both = source.select("node", *signs).unionByName(target.select("node", *[(-s).alias(c) for s, c in zip(signs, SUMS, strict=True)]))
    sums = both.groupBy("node").agg(*[F.sum(c).alias(c) for c in SUMS])
    return sums.where(" OR ".join(f"{c} <> 0" for c in SUMS)).select("node")


class Differing(NamedTuple):
    """Ranges that differ: nodes of one level, None for rows without a value."""

    level: int
    nodes: list[int | None]


def differing(source: DataFrame, target: DataFrame, ranges: Ranges, most: int = 256) -> Differing:
    """Compares two trees from the top down, children of differing nodes only.

    Stops at the leaves, or above a level with more than ``most`` differing nodes: the list that comes to the
    driver and into the filter stays as short, at the cost of wider ranges.
    """
    found = Differing(ranges.levels, [])
    for level in reversed(range(ranges.levels)):
        sides = [side.where(F.col("level") == level) for side in (source, target)]
        if level < ranges.levels - 1:
            numbers = [n for n in found.nodes if n is not None]
            inside = _cut(F.col("node"), F.lit(ranges.fanout)).isin(numbers)
            inside = inside | F.col("node").isNull() if None in found.nodes else inside
            sides = [side.where(inside) for side in sides]
        nodes = [row.node for row in _unequal(*sides).limit(most + 1).collect()]
        if len(nodes) > most and found.nodes:
            return found
        if len(nodes) > most:
            raise ValueError(f"over {most} ranges differ at the top: more levels or a larger fanout are needed")
        found = Differing(level, sorted(nodes, key=lambda n: (n is not None, n or 0)))
        if not nodes:
            break
    return found


def _spans(found: Differing, ranges: Ranges) -> list[tuple[int, int]]:
    """The differing nodes as ranges of the column, neighbours joined."""
    size = ranges.width * ranges.fanout**found.level
    out: list[tuple[int, int]] = []
    for node in found.nodes:
        if node is None:
            continue
        if out and out[-1][1] == node * size:
            out[-1] = (out[-1][0], (node + 1) * size)
        else:
            out.append((node * size, (node + 1) * size))
    return out


def in_ranges(df: DataFrame, found: Differing, ranges: Ranges) -> DataFrame:
    """The rows of the ranges found, by comparisons with constants that a scan can push down."""
    column, kind = F.col(ranges.column), df.schema[ranges.column].dataType
    whole = issubclass(_kind(df, ranges), T.IntegralType)

    def bound(n: int) -> Column:
        return F.lit(n) if whole else ntz(datetime(1970, 1, 1) + timedelta(days=n)).cast(kind)

    wanted = F.lit(False)
    for low, high in _spans(found, ranges):
        wanted = wanted | ((column >= bound(low)) & (column < bound(high)))
    return df.where(wanted | column.isNull() if None in found.nodes else wanted)


def key_differences(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], found: Differing, ranges: Ranges
) -> DataFrame:
    """The keys in the ranges found whose rows differ: keys, status, source_rows, target_rows.

    ``MISSING`` from the target, ``ORPHAN`` there, or ``CHANGED``: other values, or another number of rows. Both sides
    meet in one grouping, so a key with very many rows is added up before the shuffle.
    """
    mask = (1 << PARTS) - 1
    hashed = row_hash(columns)

    def side(df: DataFrame, sign: int) -> DataFrame:
        return in_ranges(df, found, ranges).select(
            *[f"`{k}`" for k in keys],
            F.lit(int(sign > 0)).alias("source_rows"),
            F.lit(int(sign < 0)).alias("target_rows"),
            (sign * F.shiftright(hashed, PARTS).bitwiseAND(F.lit(mask))).alias("high"),
            (sign * hashed.bitwiseAND(F.lit(mask))).alias("low"),
        )

    both = side(source, 1).unionByName(side(target, -1))
    sums = both.groupBy(*[f"`{k}`" for k in keys]).agg(*[F.sum(c).alias(c) for c in ("source_rows", "target_rows", "high", "low")])
    status = F.when(F.col("target_rows") == 0, F.lit(MISSING)).when(F.col("source_rows") == 0, F.lit(ORPHAN)).otherwise(F.lit(CHANGED))
    unequal = (F.col("source_rows") != F.col("target_rows")) | (F.col("high") != 0) | (F.col("low") != 0)
    return sums.where(unequal).select(*[f"`{k}`" for k in keys], status.alias("status"), "source_rows", "target_rows")


def differences(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    ranges: Ranges,
    stamp: str = STAMP,
    trees: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Keys whose rows differ between source and target, found through the trees of both.

    All columns of the source but the load stamp are compared; names meet as the session compares them. Pass stored
    ``trees`` of both sides to read nothing but the ranges that differ.
    """
    target = named_like(target, source.columns)
    columns = [c for c in source.columns if c != stamp]
    if lacking := [c for c in columns if c not in target.columns]:
        raise ValueError(f"the target lacks columns: {lacking}")
    if trees is None:
        trees = tuple(settle(tree(leaves(side, ranges, columns), ranges), "tree", compact=True) for side in (source, target))
    found = differing(*trees, ranges)
    return key_differences(source, target, keys, columns, found, ranges)


def repaired(
    source: DataFrame, target: DataFrame, keys: Sequence[str], found: DataFrame, run_ts: datetime, stamp: str = STAMP
) -> DataFrame:
    """The target with its orphans and changed rows removed and the source's rows of missing and changed keys added.

    ``found`` is the result of ``differences``, which is stored first. Keys with a missing part are left to reports: they
    meet no row.
    """
    found = settle(found, "differences", compact=True)
    target = named_like(target, source.columns)
    gone = found.where(F.col("status").isin(ORPHAN, CHANGED)).select(*keys)
    taken = found.where(F.col("status").isin(MISSING, CHANGED)).select(*keys)
    added = source.join(taken, list(keys), "left_semi").select(*[f"`{c}`" for c in source.columns])
    return delete_keys(target, gone).unionByName(stamped(added, run_ts, stamp, target), allowMissingColumns=True)
