"""Near-duplicate vectors by NN-descent on a neighbour graph.

1. Seeds: each vector is put into several orders, by the signs of random projections and then by one
   projection, and meets the vectors next to it. The orders are range-partitioned, so no bucket, also
   not one of a third of all vectors, is one task.
2. Descent: around each vector its neighbours and the vectors it is a neighbour of meet each other; the
   best of what they find replaces worse neighbours. A list that is saturated, as all its neighbours are
   links, is enlarged in the next round to twice its length, and so on, up to ``widest_list`` links.
3. Pairs seen at or above the threshold are links. Seeds hand on all of them, neighbourhoods the best few of
   each member and all that these few do not connect. A few members of each component then search among
   themselves, other members in every round, until a round merges no components. Only then are the members
   of each component compared block by block. Only counts per vector leave a block, so no pair of a group
   is emitted.
4. Bounded samples of vectors (without links, of small and of large components) are compared with all
   others. While too many of the vectors that have links have a wrong number of them, apart for small and
   large components, or while new random projections still change too many, the search goes on; one trial
   is enough where the samples hold. Labels
   that fail after the last trial are compared whole, block by block, until fresh samples hold.

Vectors that are equal in all components are one node from the start.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.components import connected_components
from quayside.plans.settle import settle


@dataclass(frozen=True)
class Search:
    """threshold: least cosine of a link. neighbours: of a list; widest_list: links in an enlarged one. orders, window, per_bucket: of the seeds.

    members: of each component that search for others. rounds, change: a descent ends after so many rounds, or when less than this share of all list
    entries is new. block: vectors compared at once; widest: the same, where a whole label is compared.
    sample: vectors of each audited kind. recall: least share of linked vectors whose number of links is
    exact. trials: of the search, before labels that fail are compared whole.
    """

    threshold: float = 0.98
    neighbours: int = 8
    widest_list: int = 16
    orders: int = 8
    window: int = 6
    per_bucket: int = 32
    members: int = 4
    rounds: int = 3
    change: float = 0.02
    block: int = 256
    widest: int = 2048
    sample: int = 1024
    recall: float = 0.999
    trials: int = 4


DEFAULT = Search()
_PAIRS = "src bigint, dst bigint, cosine double"


def _vectors(batch, column: str = "vector") -> np.ndarray:
    """Unit vectors of a batch, all of one length, in double precision."""
    raw = np.frombuffer(b"".join(batch.column(column).to_pylist()), "<f8").reshape(batch.num_rows, -1)
    return raw / np.sqrt((raw * raw).sum(1, keepdims=True))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 4096) -> Iterator[pa.Table]:
    """Tables of ``least`` rows or more that hold all rows of their groups, from batches sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        edge = group_edges(table, keys)[-2]  # where the last group begins
        if edge:
            yield table.slice(0, edge)
            held = table.slice(edge).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Starts of the groups, and the number of rows."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        column = table.column(key).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def prepare(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, label, vector (binary doubles): rows that can link; the others have a null vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, label in zip(batch.column("vector"), batch.column("label"), strict=True):
                ok = row.is_valid and label.is_valid and len(row.values) and not row.values.null_count
                values = row.values.to_numpy(zero_copy_only=False) if ok else None
                with np.errstate(over="ignore"):
                    ok = ok and bool(np.isfinite(values).all()) and bool(np.isfinite(squares := float(values @ values))) and squares > 0
                out.append(values.astype("<f8").tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())], names=["vec_id", "label", "vector"])

    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"), F.col(label_column).cast("string").alias("label"))
    return rows.mapInArrow(run, "vec_id bigint, label string, vector binary")


def _seeds(nodes: DataFrame, bits: int, seed: int | list[int], search: Search) -> DataFrame:
    """Pairs next to each other in the random orders: per vector and order its best few."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vector").to_pylist()]) // 8
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                if size not in planes:
                    planes[size] = np.random.default_rng([*np.atleast_1d(seed).tolist(), int(size)]).standard_normal((search.orders, bits + 1, size))
                seen = np.einsum("nd,obd->nob", _vectors(part), planes[size])
                sign = ((seen[:, :, :bits] > 0) * (1 << np.arange(bits))).sum(2)
                for o in range(search.orders):
                    yield pa.RecordBatch.from_arrays(
                        [part.column("label"), pa.array(np.full(part.num_rows, size), pa.int64()), pa.array(np.full(part.num_rows, o), pa.int64()), pa.array(sign[:, o]), pa.array(seen[:, o, bits]), part.column("node"), part.column("vector")],
                        names=["label", "size", "turn", "sign", "place", "node", "vector"],
                    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["label", "size", "turn"], 20_000):
            edges = group_edges(table, ["label", "size", "turn"])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                for start in range(a, b, 20_000):  # neighbouring parts share a window
                    part = table.slice(start, min(b, start + 20_000 + search.window) - start).combine_chunks()
                    unit, node, n = _vectors(part), part.column("node").to_numpy(), part.num_rows
                    best = np.full((n, 2 * search.window), -2.0)
                    other = np.zeros((n, 2 * search.window), np.int64)
                    for k in range(1, min(search.window, n - 1) + 1):
                        cosine = np.einsum("nd,nd->n", unit[:-k], unit[k:])
                        best[:-k, k - 1], other[:-k, k - 1] = cosine, node[k:]
                        best[k:, search.window + k - 1], other[k:, search.window + k - 1] = cosine, node[:-k]
                    top = np.argsort(-best, axis=1)[:, :3]
                    rows = np.repeat(np.arange(n), 3)
                    cosine = best[rows, top.ravel()]
                    some = cosine > -2
                    yield pa.RecordBatch.from_arrays([pa.array(node[rows][some]), pa.array(other[rows, top.ravel()][some]), pa.array(cosine[some])], names=["src", "dst", "cosine"])
                    best[rows, top.ravel()] = -2  # the few are out; other links go too
                    rows, turn = np.nonzero(best >= search.threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(node[rows]), pa.array(other[rows, turn]), pa.array(best[rows, turn])], names=["src", "dst", "cosine"])

    dealt = nodes.select("node", "label", "vector").mapInArrow(deal, "label string, size bigint, turn bigint, sign bigint, place double, node bigint, vector binary")
    order = ["label", "size", "turn", "sign", "place", "node"]
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(meet, _PAIRS)


def _nearest(pairs: DataFrame, key: str, search: Search, turn: int = 0) -> DataFrame:
    """The best pairs of each ``key``; most are dropped in the tasks before the shuffle.

    Lists that are full of links hold twice as many links in the next turn, and so on.
    """
    other = "dst" if key == "src" else "src"
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("cosine"), other))
    longest = max(search.neighbours, min(search.widest_list, search.neighbours << turn))
    best = pairs.withColumn("_rank", rank).where(F.col("_rank") <= longest)
    return best.where((F.col("_rank") <= search.neighbours) | (F.col("cosine") >= search.threshold)).drop("_rank")


def _both_ways(pairs: DataFrame) -> DataFrame:
    turned = pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "cosine")
    return pairs.unionByName(turned).groupBy("src", "dst").agg(F.max("cosine").alias("cosine"))


def _bridges(cosine: np.ndarray, top: np.ndarray, threshold: float) -> np.ndarray:
    """Which links of each neighbourhood join members that the links among the ``top`` of each do not connect."""
    linked = cosine >= threshold
    few = np.zeros_like(linked)
    np.put_along_axis(few, top, True, 2)
    few &= linked
    few |= few.transpose(0, 2, 1)
    low = np.broadcast_to(np.arange(cosine.shape[1]), cosine.shape[:2])
    while True:
        lower = np.minimum(low, np.where(few, low[:, None, :], cosine.shape[1]).min(2))
        if (lower == low).all():
            return linked & (low[:, :, None] > low[:, None, :])
        low = lower


def _local_joins(graph: DataFrame, nodes: DataFrame, search: Search) -> DataFrame:
    """Pairs among the neighbours of each vector: of every member its best few, and links that these do not connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["centre"]):
            edges = group_edges(table, ["centre"])
            sizes = np.diff(edges)
            width = int(sizes.max())
            group = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(table.num_rows) - np.repeat(edges[:-1], sizes)
            dims = np.array([len(v) for v in table.column("vector").to_pylist()]) // 8
            unit = np.zeros((len(sizes), width, dims.max()))
            for size in np.unique(dims):  # a neighbourhood has one label and one length
                own = dims == size
                unit[group[own], place[own], :size] = _vectors(table.filter(pa.array(own)))
            node = np.full((len(sizes), width), -1, np.int64)
            node[group, place] = table.column("node").to_numpy()
            cosine = unit @ unit.transpose(0, 2, 1)
            cosine[(node[:, :, None] < 0) | (node[:, None, :] < 0) | (node[:, :, None] == node[:, None, :])] = -2
            few = min(3, width)
            top = np.argpartition(-cosine, few - 1, axis=2)[:, :, :few]
            found = np.take_along_axis(cosine, top, 2)
            src = np.broadcast_to(node[:, :, None], found.shape)
            dst = np.take_along_axis(np.broadcast_to(node[:, None, :], cosine.shape), top, 2)
            some = found > -2
            yield pa.RecordBatch.from_arrays([pa.array(src[some]), pa.array(dst[some]), pa.array(found[some])], names=["src", "dst", "cosine"])
            of, a, b = np.nonzero(_bridges(cosine, top, search.threshold))
            yield pa.RecordBatch.from_arrays([pa.array(node[of, a]), pa.array(node[of, b]), pa.array(cosine[of, a, b])], names=["src", "dst", "cosine"])

    forward = graph.select(F.col("src").alias("centre"), F.col("dst").alias("node"))
    back = _nearest(graph, "dst", search).select(F.col("dst").alias("centre"), F.col("src").alias("node"))
    self = graph.select(F.col("src").alias("centre"), F.col("src").alias("node"))
    around = forward.unionByName(back).unionByName(self).distinct()
    return around.join(nodes.select("node", "vector"), "node").select("centre", "node", "vector").repartition("centre").sortWithinPartitions("centre").mapInArrow(run, _PAIRS)


def _descend(nodes: DataFrame, graph: DataFrame, pairs: DataFrame, search: Search) -> tuple[DataFrame, DataFrame]:
    """From ``graph`` (or None) and new ``pairs`` to the improved graph and the links seen on the way."""
    links, grown = [], 0 if graph is None else 2  # lists that were enlarged before stay so
    for turn in range(search.rounds + 1):
        found = settle(pairs, "pairs")
        links.append(found.where(F.col("cosine") >= search.threshold).select("src", "dst"))
        both = _both_ways(found)
        if graph is not None:
            both = graph.select("src", "dst", "cosine").unionByName(both).groupBy("src", "dst").agg(F.max("cosine").alias("cosine"))
        better = settle(_nearest(both, "src", search, turn + grown), "graph")
        if graph is not None and turn:
            new = better.join(graph, ["src", "dst"], "left_anti").count()
            graph = better
            if new <= search.change * max(1, better.count()):
                break
        graph = better
        if turn < search.rounds:
            pairs = _local_joins(graph, nodes, search)
    whole = links[0]
    for more in links[1:]:
        whole = whole.unionByName(more)
    return graph, whole


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each member of a symmetric link matrix."""
    root = np.arange(len(linked))
    for k in range(len(linked)):
        if root[k] == k:  # not reached from a smaller member
            reached = np.zeros(len(linked), bool)
            edge = np.arange(len(linked)) == k
            while edge.any():
                reached |= edge
                edge = linked[edge].any(0) & ~reached
            root[reached] = k
    return root


def _block_counts(members: DataFrame, block: int | Column, search: Search) -> DataFrame:
    """members (component, size, node, copies, vector) -> node, n, root: all pairs of a component, in blocks of ``block``.

    n: rows of other nodes linked to the node in this pair of blocks. root: a node that links reach there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["component", "low", "high"]
        for table in whole_groups(batches, keys, 1):
            edges = group_edges(table, keys)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = table.slice(a, b - a).combine_chunks()
                unit, node, copies = _vectors(part), part.column("node").to_numpy(), part.column("copies").to_numpy()
                of, low, high = part.column("block").to_numpy(), int(part.column("low")[0].as_py()), int(part.column("high")[0].as_py())
                linked = unit @ unit.T >= search.threshold
                np.fill_diagonal(linked, False)
                root = node[_roots(linked)]
                if low != high:
                    linked &= of[:, None] != of[None, :]  # pairs of one block are counted once, where it meets itself
                n = np.array([int(copies[row].sum()) for row in linked])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n, pa.int64()), pa.array(root)], names=["node", "n", "root"])

    blocks = F.ceil(F.col("size") / block).cast("bigint")
    dealt = members.select("component", "node", "copies", "vector", F.pmod(F.xxhash64("node"), blocks).alias("block"), blocks.alias("blocks"))
    met = dealt.select("component", "node", "copies", "vector", "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("with"))
    keyed = met.select("component", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "node", "copies", "vector")
    order = ["component", "low", "high"]
    return keyed.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "node bigint, n bigint, root bigint")


def _merged(nodes: DataFrame, links: DataFrame, bits: int, seed: int, search: Search) -> tuple[DataFrame, DataFrame]:
    """links with those that a few members of each component find, and node, component for the linked nodes."""
    found = settle(connected_components(links), "found")
    components = found.select("component").distinct().count()
    for turn in itertools.count():
        if components < 2:
            break
        place = F.row_number().over(Window.partitionBy("component").orderBy(F.xxhash64("node", F.lit(seed), F.lit(turn)), "node"))
        few = found.withColumn("place", place).where(F.col("place") <= search.members).select("node")
        ends = settle(nodes.join(few, "node").select("node", "label", "vector"), "members")
        more = _descend(ends, None, _seeds(ends, bits, [seed, turn], search), search)[1]
        links = settle(links.unionByName(more).distinct(), "links")
        found = settle(connected_components(links), "found")
        before, components = components, found.select("component").distinct().count()
        if components == before:
            break
    return links, found


def _linked(nodes: DataFrame, found: DataFrame, search: Search, before: DataFrame | None = None) -> DataFrame:
    """node, component, n for the linked nodes ``found`` (node, component): all members of a component are compared.

    Components that have the members they had ``before`` (a result of this) keep their counts.
    """
    signed = lambda rows: rows.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("members"))
    sizes = settle(signed(found), "sizes", compact=True)
    if before is not None:
        same = settle(sizes.join(signed(before), ["component", "size", "members"], "left_semi").select("component"), "same", compact=True)
        changed = found.join(same, "component", "left_anti")
        kept = before.join(same, "component", "left_semi")
        return settle(_linked(nodes, settle(changed, "changed"), search).unionByName(kept.select("node", "component", "n")), "linked")
    members = found.join(sizes.select("component", "size"), "component").join(nodes.select("node", "copies", "vector"), "node")
    width = F.least(F.greatest(F.lit(search.block), F.ceil(F.col("size") / 64)), F.lit(search.widest))
    counts = _block_counts(members, width, search).groupBy("node").agg(F.sum("n").alias("n"))
    return settle(found.select("node", "component").join(counts, "node"), "linked")


def _whole_labels(nodes: DataFrame, labels: DataFrame, search: Search) -> DataFrame:
    """node, component, n for the linked nodes of ``labels``, every vector compared with every other."""
    own = nodes.join(labels, "label", "left_semi").withColumn("length", F.length("vector"))
    groups = settle(own.groupBy("label", "length").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("size")), "groups", compact=True)
    members = own.join(groups, ["label", "length"]).select("component", "size", "node", "copies", "vector")
    met = settle(_block_counts(members, search.widest, search).where("n > 0 OR root != node"), "met")
    found = connected_components(met.select(F.col("node").alias("src"), F.col("root").alias("dst")), "whole")
    return found.join(met.groupBy("node").agg(F.sum("n").alias("n")), "node").select("node", "component", "n")


def _kinds(nodes: DataFrame, linked: DataFrame, search: Search) -> DataFrame:
    """The nodes with n and kind: 0 without links, 1 in a component of at most ``search.block`` nodes, 2 in a larger one."""
    large = linked.groupBy("component").count().where(F.col("count") > search.block).select("component", F.lit(2).alias("large"))
    told = linked.join(large, "component", "left").select("node", "n", F.coalesce("large", F.lit(1)).alias("kind"))
    return nodes.join(told, "node", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "kind": F.coalesce("kind", F.lit(0))})


def audit(nodes: DataFrame, linked: DataFrame, search: Search, seed: int = 7) -> tuple[dict[str, float], list[str]]:
    """Shares of the linked nodes whose n is exact, estimated from samples, and the labels of wrong ones where a share is too small.

    Of each kind of nodes the sample is the ``search.sample`` nodes with the smallest hash of their vector. A
    node weighs as many nodes as it stands for; its number of links does not matter. Nodes without links and
    those in small components are one share, so a large component says nothing about them. 1.0: none is linked.
    """
    kinds = settle(_kinds(nodes, linked, search), "kinds")
    sizes = {r["kind"]: r["count"] for r in kinds.groupBy("kind").count().collect()}
    chosen = []
    for kind in sizes:
        picked = kinds.where(F.col("kind") == kind).orderBy(F.xxhash64("vector", F.lit(seed)), "node").limit(search.sample)
        chosen += [(r["node"], r["label"], bytes(r["vector"]), kind, r["n"]) for r in picked.select("node", "label", "vector", "n").collect()]  # at most ``sample`` rows
    shared = nodes.sparkSession.sparkContext.broadcast([x[:3] for x in chosen])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[tuple[str, int], tuple[list, list]] = {}
        for node, label, vector in shared.value:
            own = asked.setdefault((label, len(vector)), ([], []))
            own[0].append(node)
            own[1].append(vector)
        true: dict[int, int] = {}
        for batch in batches:
            labels, lengths = np.array(batch.column("label").to_pylist(), object), np.array([len(v) for v in batch.column("vector").to_pylist()])
            for (label, length), (ids, vectors) in asked.items():
                part = batch.filter(pa.array((labels == label) & (lengths == length)))
                if part.num_rows:
                    raw = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
                    met = (raw / np.sqrt((raw * raw).sum(1, keepdims=True))) @ _vectors(part).T >= search.threshold
                    met &= np.array(ids)[:, None] != part.column("node").to_numpy()[None, :]
                    for node, n in zip(ids, met @ part.column("copies").to_numpy(), strict=True):
                        true[node] = true.get(node, 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(true), pa.int64()), pa.array(list(true.values()), pa.int64())], names=["node", "links"])

    counted = nodes.select("node", "label", "vector", "copies").mapInArrow(run, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))
    true = {r["node"]: r["links"] for r in counted.where("links > 0").collect()}  # at most three samples
    stands = {kind: size / sum(x[3] == kind for x in chosen) for kind, size in sizes.items()}
    shares, wrong = {}, set()
    for name, own in (("small", (0, 1)), ("large", (2,))):
        asked = [x for x in chosen if x[3] in own and x[0] in true]
        failed = [x for x in asked if x[4] != true[x[0]]]
        shares[name] = 1 - sum(stands[x[3]] for x in failed) / sum(stands[x[3]] for x in asked) if asked else 1.0
        if shares[name] < search.recall:
            wrong |= {x[1] for x in failed}
    return shares, sorted(wrong)


def _moved_labels(nodes: DataFrame, before: DataFrame, linked: DataFrame, search: Search) -> list[str]:
    """Labels of nodes that the last trial gave another n, if these are too many of the linked nodes of small or of large components."""
    earlier = before.select("node", F.col("n").alias("earlier"))
    kinds = _kinds(nodes, linked, search).where("kind > 0").join(earlier, "node", "left").withColumn("moved", ~F.col("n").eqNullSafe(F.col("earlier")))
    kinds = settle(kinds.select("label", "kind", "moved"), "moved")
    shares = kinds.groupBy("kind").agg(F.avg(F.col("moved").cast("int")).alias("share")).collect()
    failed = [r["kind"] for r in shares if r["share"] > 1 - search.recall]
    return [r["label"] for r in kinds.where(F.col("moved") & F.col("kind").isin(failed)).select("label").distinct().collect()] if failed else []


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", search: Search = DEFAULT) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows link if their labels are equal and not null, their vectors have one length and their cosine in
    double precision is at least the threshold. Vectors that are null, empty, zero, or hold null, NaN
    or infinite components link with nothing. n_links counts other rows, copies included; component_id
    is the smallest vec_id reachable, the own one without links. Rows with a null vec_id take part;
    component_id is null where no row reached has an id; kept is true where vec_id and component_id
    are the same, nulls too. Other columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = settle(prepare(vectors, id_column, vector_column, label_column), "vectors")
    nodes = settle(
        rows.where("vector is not null")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits = int(np.clip(np.ceil(np.log2(max(1, most / search.per_bucket))), 4, 40))

    graph, links, linked, failed = None, spark.createDataFrame([], "src bigint, dst bigint"), None, []
    for trial in range(search.trials):
        graph, more = _descend(nodes, graph, _seeds(nodes, bits, trial, search), search)
        links = settle(links.unionByName(more).distinct(), "links")
        links, found = _merged(nodes, links, bits, trial, search)
        before, linked = linked, _linked(nodes, found, search, linked)
        failed = audit(nodes, linked, search, trial)[1]
        if before is not None:
            failed += _moved_labels(nodes, before, linked, search)
        if not failed:
            break
    whole: set[str] = set()
    while new := set(failed) - whole:
        whole |= new
        labels = spark.createDataFrame([(x,) for x in new], "label string")
        others = linked.join(nodes.join(labels, "label", "left_semi").select("node"), "node", "left_anti")
        linked = settle(others.unionByName(_whole_labels(nodes, labels, search)), "linked")
        failed = audit(nodes, linked, search, search.trials + len(whole))[1]

    placed = nodes.select("label", "vector", "node", "first_id", "copies").join(linked, "node", "left")
    firsts = placed.where("component is not null").groupBy("component").agg(F.min("first_id").alias("component_first"))
    # Only nodes of several rows or with links say more than the row itself knows.
    told = settle(
        placed.where("component is not null or copies > 1")
        .join(firsts, "component", "left")
        .select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component_first", "first_id").alias("component_id"), F.lit(True).alias("told")),
        "told",
    )
    found = rows.join(told, ["label", "vector"], "left")
    component = F.when(F.col("told"), F.col("component_id")).otherwise(F.col("vec_id"))
    return found.select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
