"""Running states over an array inside a row, by SQL functions.

``aggregate`` that appends to an array copies it at each step, which takes the square of the array's length.
Here the array is cut into blocks of about the square root of it: the state at the start of each block comes from the
totals of the blocks before, and each block is gone through by itself. The work is the length times its square root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST = 64  # shorter arrays are one block


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once: inside a function over an array it would be anew for each item."""
    return F.element_at(F.transform(F.array(value), use), 1)


def blocks_of(items: Column) -> Column:
    """The array as an array of blocks; an empty array has none."""
    size = F.greatest(F.lit(LEAST), F.ceil(F.sqrt(F.size(items))).cast("int"))
    count = F.ceil(F.size(items) / size).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda b: F.slice(items, b * size + 1, size))


def running(
    items: Column, zero: Column, add: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str
) -> Column:
    """What ``emit(state, item)`` gives for all items, one behind the other: an array of ``kind`` for each.

    ``state`` is ``zero`` and all earlier items brought in by ``add(state, item)``, a sum or a maximum: any ``add`` for which
    the state after two blocks is ``add`` of the second one's totals to the state after the first.
    """
    none, states = F.array().cast(kind), F.array(zero)

    def through(block: Column, at: Column) -> Column:
        step = lambda s, x: F.struct(add(s["at"], x).alias("at"), F.concat(s["out"], emit(s["at"], x)).alias("out"))
        return F.aggregate(block, F.struct(at.alias("at"), none.alias("out")), step, lambda s: s["out"])

    def over(blocks: Column) -> Column:
        # The state before each block, and behind the last one.
        before = F.aggregate(blocks, states, lambda s, block: F.concat(s, F.array(F.aggregate(block, F.element_at(s, -1), add))))
        return F.coalesce(F.flatten(F.zip_with(blocks, bound(before, lambda b: F.slice(b, 1, F.size(b) - 1)), through)), none)

    return bound(items, lambda whole: bound(blocks_of(whole), over))


def cut_out(text: Column, spans: Column, start: Callable[[Column], Column], end: Callable[[Column], Column]) -> Column:
    """The texts of ascending spans. Each is sought in the part of the text that its block spans, not from the text's start."""

    def of(block: Column) -> Column:
        first = start(block[0])
        whole = F.substring(text, first + 1, end(F.element_at(block, -1)) - first)
        return bound(whole, lambda part: F.transform(block, lambda s: F.substring(part, start(s) - first + 1, end(s) - start(s))))

    return F.coalesce(F.flatten(bound(spans, lambda all_: F.transform(blocks_of(all_), of))), F.array().cast("array<string>"))
