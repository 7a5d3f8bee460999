"""Length buckets of least padding, and batches of a token budget inside each.

The lengths of the whole table are counted in a histogram whose bins are exact up to ``fine`` tokens
and above it as wide as ``1/fine`` of the length, so it has at most ``fine * (1 + log2(longest/fine))``
bins however large the table is: that, not the table, is what the driver gets. A dynamic program over
the bins chooses the bucket boundaries of least total padding. Documents are then numbered by length,
without one task seeing all of them, and cut into batches: a bucket with boundary b takes
``max(1, budget // b)`` documents a batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.plans.numbering import number_rows
from quayside.plans.settle import settle

BUDGET = 65536  # tokens a batch, with padding
BUCKETS = 16
FINE = 1024


def byte_tokens(text: Column) -> Column:
    """Length of a text for a byte-level model: its UTF-8 bytes and an end token. Null counts as empty."""
    return (F.octet_length(F.coalesce(text.cast("string"), F.lit(""))) + 1).cast("bigint")


def bin_of(length: Column, fine: int = FINE) -> Column:
    """The histogram bin of a length, as the smallest length in it."""
    exponent = F.greatest(F.lit(0), F.floor(F.log2(length.cast("double") / fine)))
    width = F.pow(F.lit(2.0), exponent)
    return F.when(length <= fine, length).otherwise((F.floor(length / width) * width).cast("bigint"))


def least_padding(lengths: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> list[int]:
    """Boundaries that minimise padding. lengths: the longest of each bin, ascending; counts, sums: of its documents.

    Padding of a bucket is its boundary times its documents less their tokens. The best cut before a
    later bin never lies before that of an earlier bin, so each layer is solved by halving.
    """
    n = len(lengths)
    if not n:
        return []
    number, total = (np.concatenate(([0], np.cumsum(x.astype(object)))).astype(float) for x in (counts, sums))
    lengths = lengths.astype(float)
    best = lengths * number[1:] - total[1:]  # one bucket up to bin j
    cuts: list[np.ndarray] = []
    for _ in range(min(buckets, n) - 1):
        after, cut = best.copy(), np.full(n, -1)
        work = [(0, n - 1, -1, n - 1)]
        while work:
            low, high, first, last = work.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(max(first, 0), min(last, j - 1) + 1)  # the bucket before ends at bin i
            cut_at = -1
            if len(i):
                cost = best[i] + lengths[j] * (number[j + 1] - number[i + 1]) - (total[j + 1] - total[i + 1])
                k = int(cost.argmin())
                if cost[k] < after[j]:
                    after[j], cut_at = cost[k], int(i[k])
            cut[j] = cut_at
            work += [(low, j - 1, first, cut_at if cut_at >= 0 else last), (j + 1, high, cut_at if cut_at >= 0 else first, last)]
        cuts.append(cut)
        best = after
    ends, j = [], n - 1
    for cut in [*cuts[::-1], np.full(n, -1)]:
        if cut[j] >= 0:
            ends.append(j)
            j = int(cut[j])
    return [int(lengths[x]) for x in sorted({*ends, j, n - 1})]


def histogram(sizes: DataFrame, length: str = "n_tokens", fine: int = FINE) -> DataFrame:
    return sizes.groupBy(bin_of(F.col(length), fine).alias("bin")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(length).alias("tokens"), F.max(length).alias("longest")
    )


def pack(sizes: DataFrame, id_column: str = "doc_id", length: str = "n_tokens", budget: int = BUDGET, buckets: int = BUCKETS, fine: int = FINE) -> DataFrame:
    """(id, length) -> doc_id, n_tokens, bucket, bucket_length, batch, slot, padding, one row per row.

    buckets are numbered from 0 by length, batches from 0 over the whole table, slots from 0 inside a
    batch; padding is bucket_length - n_tokens. Documents longer than the budget get batches of their
    own; none is cut. Null lengths count as 0. Inside a bucket documents are placed by length, then id,
    null ids first; rows equal in both may take either's place. Other columns are not read. An empty
    table gives an empty result.
    """
    sizes = settle(sizes.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(length).cast("bigint"), F.lit(0)).alias("n_tokens")), "sizes")
    bins = sorted(tuple(r) for r in histogram(sizes, fine=fine).select("longest", "documents", "tokens").collect())
    longest, documents, tokens = (np.array([b[i] for b in bins], dtype=np.int64) for i in range(3))
    ends = least_padding(longest, documents, tokens, buckets)

    rows = number_rows(sizes, [F.col("n_tokens"), F.col("doc_id")], "place")
    plan, before, batches, low = [], 0, 0, -1
    for k, end in enumerate(ends):
        inside = int(documents[(longest > low) & (longest <= end)].sum())
        each = max(1, budget // max(end, 1))
        plan.append((k, low, end, before, each, batches))
        before, batches, low = before + inside, batches + -(-inside // each), end

    def choose(i: int) -> Column:
        out = F.lit(None).cast("bigint")
        for row in reversed(plan):  # at most ``buckets`` branches
            out = F.when(F.col("n_tokens") <= row[2], F.lit(row[i]).cast("bigint")).otherwise(out)
        return out

    placed = rows.select("doc_id", "n_tokens", (F.col("place") - 1 - choose(3)).alias("_rank"), choose(0).alias("bucket"), choose(2).alias("bucket_length"), choose(4).alias("_each"), choose(5).alias("_batches"))
    return placed.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "bucket_length",
        F.expr("_batches + _rank div _each").alias("batch"),
        F.expr("_rank % _each").alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
    )


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """``pack`` with the byte-level lengths of documents."""
    return pack(docs.select("doc_id", byte_tokens(F.col("text")).alias("n_tokens")), **options)
