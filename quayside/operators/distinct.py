"""Distinct counts of any period from daily sketches, exact where the answer is near.

One sketch per group and day is stored; sketches of days are united for a period, so no fact row is read again. A sketch
gives a count within a few percent. A stated count that is surely inside or outside of the tolerance is settled by
that; only groups where it may be either way are counted exactly, from the facts of these groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import day_literal
from quayside.functions.text import error_mark
from quayside.plans.settle import settle

LG_K = 12  # a sketch has 2^LG_K cells
DEVIATIONS = 4.0


def relative_error(lg_k: int = LG_K, deviations: float = DEVIATIONS) -> float:
    """What a count from a sketch is wrong by at most, as a share of it, save one in some ten thousand."""
    return deviations * 1.04 / (1 << lg_k) ** 0.5


def daily_sketches(facts: DataFrame, groups: Sequence[str], day: str, item: str, lg_k: int = LG_K) -> DataFrame:
    """groups, day and the sketch of the distinct items of each day. Missing items do not count; the result can be appended to day by day."""
    return facts.groupBy(*groups, F.col(day).cast("date").alias(day)).agg(F.hll_sketch_agg(item, lg_k).alias("sketch"))


def estimated(sketches: DataFrame, groups: Sequence[str], day: str, start: date, end: date) -> DataFrame:
    """The number of distinct items per group from ``start`` to ``end`` inclusive, as the united sketches tell."""
    wanted = sketches.where(F.col(day).between(day_literal(start), day_literal(end)))
    return wanted.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def exact(facts: DataFrame, groups: Sequence[str], day: str, item: str, start: date, end: date) -> DataFrame:
    wanted = facts.where(F.col(day).cast("date").between(day_literal(start), day_literal(end)))
    return wanted.groupBy(*groups).agg(F.count_distinct(item).alias("exact"))


def verify_counts(
    stated: DataFrame, facts: DataFrame, sketches: DataFrame, groups: Sequence[str], day: str, item: str, start: date, end: date,
    tolerance: float, lg_k: int = LG_K,
) -> DataFrame:
    """``stated`` (groups, stated) with ``CHECK``: ``Error`` where it is off the true count by over ``tolerance`` of that, else empty.

    EXACT tells which groups had to be counted. A group without facts counts 0. Groups meet also where both are NULL.
    """
    wrong = relative_error(lg_k)
    told = estimated(sketches, groups, day, start, end)

    def met(left: DataFrame, right: DataFrame, value: str) -> DataFrame:
        same = F.lit(True)
        for g in groups:
            same = same & left[g].eqNullSafe(right[g])
        return left.join(right, same, "left").select(*[left[c] for c in left.columns], F.coalesce(right[value], F.lit(0)).alias(value))

    known = met(stated, told, "estimate")
    # The true count lies between these; both are 0 where the sketch has seen nothing.
    low, high = F.col("estimate") / (1 + wrong), F.col("estimate") / (1 - wrong)
    off = lambda true: F.abs(F.col("stated") - true) > tolerance * true
    surely_off = (F.col("stated") > high * (1 + tolerance)) | (F.col("stated") < low * (1 - tolerance))
    surely_fine = (F.col("stated") <= low * (1 + tolerance)) & (F.col("stated") >= high * (1 - tolerance))
    settled = settle(known.withColumn("_off", F.when(surely_off, F.lit(True)).when(surely_fine, F.lit(False))), "known", compact=True)
    near = settled.where("_off IS NULL").select(*groups)
    same = F.lit(True)
    wanted = near.toDF(*[f"_g{i}" for i in range(len(groups))])
    for i, g in enumerate(groups):
        same = same & facts[g].eqNullSafe(wanted[f"_g{i}"])
    counted = exact(facts.join(wanted, same, "left_semi"), groups, day, item, start, end)
    final = met(settled, counted, "exact")
    verdict = F.coalesce("_off", off(F.col("exact")))
    return final.select(*groups, "stated", error_mark(verdict).alias("CHECK"), F.col("_off").isNull().alias("EXACT"))
