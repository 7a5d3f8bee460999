"""Hard negatives: rows of other labels that score closest below an anchor's own positives.

Anchors are clustered by direction. In each block of rows a cluster sorts the candidates once, by an upper
bound of their inner product with any of its members: for a candidate at angle t from the cluster's centroid,
and members within an angle b of it, that is ``|candidate| * cos(max(0, t - b))``. Every member walks this one
list, best bound first, until the bound of what is left, times the member's own length, is below the worst of
the rows it already holds: no later candidate can enter, so the walk ends with a certificate and the result
is exact. Rows are dealt in blocks of bounded size and anchors in chunks of bounded size; each block is walked
for each chunk in a task of its own, and gives at most the first k rows of each anchor, so no task sees all
rows or all anchors, whatever label or cluster holds most of them.

Scores are inner products of whole numbers, kept exact: by doubles where all sums stay below 2^53, by Python
integers beyond.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.plans.numbering import number_rows
from quayside.plans.settle import settle

BLOCK = 4096  # rows of a block
CHUNK = 2048  # anchors of a chunk
STEP = 512  # candidates a walk takes at once
CLUSTERS = 64
SAMPLE = 4096  # anchors the centroids are fitted on

_HITS = pa.schema([("walker", pa.int64()), ("row_id", pa.int64()), ("score", pa.int64())])


def whole_vectors(rows: DataFrame, scale: int = 256, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector): components ``floor(scale * x)``, x as double.

    Rows without id, label or vector, and rows with a component that is null, not finite or does not fit in
    32 bits once scaled, take no part.
    """
    fine = lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < float(1 << 31))  # noqa: E731  false for NaN: abs(NaN) is the largest
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & F.forall(vector, fine))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), whole.alias("vector"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; what a shorter one lacks counts as 0."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max([1, *(int(x) for c in columns for x in [pc.max(pc.list_value_length(c)).as_py() or 0])])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with the rows of ``b``."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _angles(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1) * np.linalg.norm(centroid)
    return np.arccos(np.clip(vectors @ centroid / np.where(lengths > 0, lengths, 1), -1, 1))


def _centroids(sample: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Directions of spherical k-means over a bounded sample."""
    lengths = np.linalg.norm(sample, axis=1, keepdims=True)
    units = (sample / np.where(lengths > 0, lengths, 1)).astype(np.float64)
    chosen = units[np.random.default_rng(13).permutation(len(units))[:clusters]]
    for _ in range(rounds):
        near = (units @ chosen.T).argmax(1)
        sums = np.zeros_like(chosen)
        np.add.at(sums, near, units)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        chosen = np.where(size > 0, sums / np.where(size > 0, size, 1), chosen)
    return chosen


def _first(walker: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k hits of each walker, higher scores first, ties by smaller row id; by walker and rank."""
    order = np.lexsort((row, -score, walker))
    starts = np.flatnonzero(np.diff(walker[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


def _walk(
    vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, order: np.ndarray, bounds: np.ndarray,
    members: np.ndarray, member_label: np.ndarray, own: np.ndarray, low: np.ndarray | None, high: np.ndarray | None, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hits of a cluster's members in one list of candidates, sorted by falling ``bounds``.

    Without ``low`` and ``high`` the candidates share the member's label and are other rows; with them they
    have another label and score between both.
    """
    n = len(members)
    lengths = np.linalg.norm(members.astype(np.float64), axis=1)
    walking = np.arange(n)
    held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    worst = np.full(n, -np.inf)  # the k-th score so far
    if low is not None:
        worst = np.maximum(worst, low.astype(np.float64) - 1)
    for at in range(0, len(order), STEP):
        # What is left scores at most this. A tie may still enter, so the walk ends only below it.
        walking = walking[bounds[at] * lengths[walking] + 1e-6 >= worst[walking]]
        if not len(walking):
            break
        step = order[at : at + STEP]
        scores = _products(members[walking], vectors[step])
        same = member_label[walking, None] == labels[step][None]
        wanted = same & (ids[step][None] != own[walking, None]) if low is None else ~same & (scores >= low[walking, None]) & (scores <= high[walking, None])
        wanted &= scores >= worst[walking, None]
        at_member, at_row = np.nonzero(wanted)
        if not len(at_member):
            continue
        new = (walking[at_member], ids[step][at_row], scores[at_member, at_row].astype(np.int64))
        held = tuple(np.concatenate(x) for x in zip(held, new, strict=True))
        best = _first(*held, k)
        held = tuple(x[best] for x in held)
        count = np.bincount(held[0], minlength=n)
        last = np.cumsum(count) - 1
        full = count >= k
        worst[full] = held[2][last[full]]
    return held


def _hits(walkers: pa.Table, rows: pa.Table, centroids: np.ndarray, k: int) -> pa.Table:
    """The first k rows of one block for each walker of one chunk."""
    if not len(walkers) or not len(rows):
        return _HITS.empty_table()
    width = max(centroids.shape[1], _width(walkers["vector"], rows["vector"]))
    middle = np.zeros((len(centroids), width))
    middle[:, : centroids.shape[1]] = centroids
    vectors, members = _matrix(rows["vector"], width), _matrix(walkers["vector"], width)
    floats = vectors.astype(np.float64)
    length = np.linalg.norm(floats, axis=1)
    labels, ids = rows["label"].to_numpy(), rows["vec_id"].to_numpy()
    number, cluster = walkers["walker"].to_numpy(), walkers["cluster"].to_numpy()
    own, own_label = walkers["vec_id"].to_numpy(), walkers["label"].to_numpy()
    ranged = "low" in walkers.column_names
    low, high = (walkers["low"].to_numpy(), walkers["high"].to_numpy()) if ranged else (None, None)
    out = []
    for c in np.unique(cluster):
        who = np.flatnonzero(cluster == c)
        widest = _angles(members[who].astype(np.float64), middle[c]).max()
        apart = np.maximum(0, _angles(floats, middle[c]) - widest)
        bounds = length * (np.cos(apart) + 1e-6)  # room for rounding
        order = np.argsort(-bounds)
        at = (low[who], high[who]) if ranged else (None, None)
        hit = _walk(vectors, labels, ids, order, bounds[order], members[who], own_label[who], own[who], *at, k)
        out.append((number[who][hit[0]], hit[1], hit[2]))
    return pa.Table.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)], schema=_HITS)


def _best(walkers: DataFrame, rows: DataFrame, blocks: int, centroids: np.ndarray, k: int) -> DataFrame:
    """The first k of all rows for each walker: (walker, row_id, score, rank).

    The stated anchors meet all rows in blocks: a chunk and a block are one group of bounded size.
    """
    chunks = (walkers.agg(F.max("chunk")).first()[0] or 0) + 1
    dealt = walkers.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    spread = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1).cast("int"))))
    found = (
        dealt.groupBy("chunk", "block")
        .cogroup(spread.groupBy("chunk", "block"))
        .applyInArrow(lambda w, r: _hits(w, r, centroids, k), "walker bigint, row_id bigint, score bigint")
    )
    first = Window.partitionBy("walker").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _clustered(anchors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Anchors numbered by cluster, so that a chunk of them holds few clusters."""

    def nearest(batches):
        for batch in batches:
            vectors = _matrix(pa.chunked_array([batch["vector"]]), max(centroids.shape[1], _width(pa.chunked_array([batch["vector"]]))))
            cluster = (vectors[:, : centroids.shape[1]].astype(np.float64) @ centroids.T).argmax(1)
            yield batch.append_column("cluster", pa.array(cluster, pa.int32()))

    told = anchors.mapInArrow(nearest, "vec_id bigint, label bigint, vector array<bigint>, cluster int")
    numbered = number_rows(told, [F.col("cluster"), F.col("vec_id")], "walker")
    return settle(numbered.withColumn("chunk", F.expr(f"CAST((walker - 1) DIV {CHUNK} AS int)")), "anchors")


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """``rows`` (vec_id, label, vector of whole numbers); ``anchors`` says which of them are anchors.

    Positives of an anchor are its first rows of the same label, itself excepted. For each of them, the first rows of
    other labels with ``low * positive <= 100 * score <= high * positive``: (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score). Higher scores come first, ties by smaller vec_id. All are given if there are fewer;
    a positive score below zero admits none.

    Repeated rows are rows of their own; an anchor takes no row with its own id. Vectors of unequal length are compared
    as if the shorter had zeros. Without rows or anchors there is no result. Further columns are ignored. Scores beyond
    64 bits count as the largest there are. The centroids come from at most ``SAMPLE`` anchors and only set the order of walks.
    """
    spark = rows.sparkSession
    rows = settle(rows.select("vec_id", "label", "vector", F.monotonically_increasing_id().alias("_seed")), "rows")
    blocks = max(1, -(-rows.count() // BLOCK))
    chosen = rows.where(anchors).select("vec_id", "label", "vector")
    sample = [r.vector for r in chosen.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("vector").collect()]
    if not sample:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    table = pa.chunked_array([pa.array(sample, pa.list_(pa.int64()))])
    centroids = _centroids(_matrix(table, _width(table)), CLUSTERS)
    rows = rows.select("vec_id", "label", "vector", F.pmod(F.xxhash64("_seed"), F.lit(blocks)).cast("int").alias("block"))
    walkers = _clustered(chosen, centroids)
    found = settle(_best(walkers, rows, blocks, centroids, positives), "positives")
    # Whole-number limits of 100 * score, rounded inwards.
    bounds = found.select(
        F.col("walker").alias("_anchor"),
        (F.col("walker") * positives + F.col("rank") - 1).alias("walker"),
        F.col("row_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.expr(f"-((-{low} * score - pmod(-{low} * score, 100)) DIV 100)").alias("low"),
        F.expr(f"({high} * score - pmod({high} * score, 100)) DIV 100").alias("high"),
    ).where("low <= high")
    pairs = settle(bounds.join(walkers.withColumnRenamed("walker", "_anchor"), "_anchor"), "pairs")
    taken = pairs.select("walker", "vec_id", "label", "vector", "cluster", "chunk", "low", "high")
    below = _best(taken, rows, blocks, centroids, negatives)
    named = pairs.select("walker", F.col("vec_id").alias("anchor_id"), "positive_id", "positive_score")
    return below.join(named, "walker").select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
