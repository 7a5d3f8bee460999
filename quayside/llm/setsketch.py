"""Near-duplicate documents by SetSketch registers.

Each distinct shingle of a document draws one exponential variable per register; a register holds
the smallest of them on an exponential scale with base ``base``, truncated to ``0..limit + 1``.
Registers of a union are the larger ones of both parts, so sketches merge, and two registers are
equal with a probability near the Jaccard similarity, so a band of consecutive registers is a key
under which similar documents meet.

1. One pass over the texts gives sketches and a digest of the whole shingle set. Documents with
   equal sets are one class from then on; copies are never paired.
2. Classes are dealt under their bands. In each bucket all members are compared with the first: jointly
   by the likelihood of the registers, which only rules out pairs far below the threshold, then exactly
   on full shingle sets. Components of the links found are formed.
3. In buckets that still hold several components, all members of different components are compared on
   full shingle sets, a block of the bucket with a block at a time; only links leave a block, so texts
   that meet by a widespread passage alone make no rows. Pairs inside one component need no look, which
   keeps a bucket of thousands of near copies linear.
4. Components over all links.

Bands are consecutive registers in the given order and in two reshuffled orders, so 192 registers give
80 bands of 6. A pair at the threshold of 0.75 shares no bucket with probability 2.5e-5, at 0.8 with
2e-7; two documents that have a third of their shingles in common with all bearers of some passage
meet only if all six minima of a band fall into it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import connected_components
from quayside.llm.nn_descent import group_edges, whole_groups
from quayside.llm.shingles import mix, shingle_set
from quayside.plans.settle import settle


@dataclass(frozen=True)
class Sketch:
    """registers and band: how many, and how many of them form one key. base, rate, limit: the scale.

    words: of a shingle. share, of: links have ``of * intersection >= share * union``.
    floor: pairs whose likeliest similarity is below it are not confirmed; it lies six standard
    deviations (0.031 with 192 registers) below the threshold.
    """

    registers: int = 192
    band: int = 6
    bands: int = 80
    base: float = 1.001
    rate: float = 20.0
    limit: int = (1 << 16) - 2
    words: int = 5
    share: int = 75
    of: int = 100
    floor: float = 0.55
    block: int = 512

    def members(self) -> np.ndarray:
        """The registers of each band."""
        rng = np.random.default_rng(11)
        each = self.registers // self.band
        orders = [np.arange(self.registers)] + [rng.permutation(self.registers) for _ in range(-(-self.bands // each) - 1)]
        return np.concatenate([o[: each * self.band].reshape(each, self.band) for o in orders])[: self.bands]


DEFAULT = Sketch()


def registers_of(hashes: np.ndarray, starts: np.ndarray, sketch: Sketch = DEFAULT) -> np.ndarray:
    """A row of register values per set; ``hashes`` holds the sets one behind the other, none empty, from ``starts`` on."""
    seeds = mix(np.arange(1, 2 * sketch.registers + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)
    xor, odd = seeds[: sketch.registers], seeds[sketch.registers :] | np.uint32(1)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    lowest = np.empty((len(starts), sketch.registers), np.uint32)
    ends = np.append(starts[1:], len(hashes))
    first = 0
    while first < len(starts):  # some sets at a time, so that they stay in the processor's cache
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + 16384, "right")))
        block, own = short[starts[first] : ends[last - 1]], starts[first:last] - starts[first]
        for i in range(sketch.registers):
            lowest[first:last, i] = np.minimum.reduceat((block ^ xor[i]) * odd[i], own)
        first = last
    uniform = (lowest.astype(np.float64) + 0.5) / 2.0**32
    exponential = -np.log1p(-uniform) / sketch.rate
    values = np.floor(1 - np.log(exponential) / np.log(sketch.base))
    return np.clip(values, 0, sketch.limit + 1).astype(np.uint16)


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, sketch: Sketch = DEFAULT) -> np.ndarray:
    """Jaccard similarities of greatest joint likelihood for rows of registers with known set sizes."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    chance = lambda x: -np.log1p(-x * (sketch.base - 1) / sketch.base) / np.log(sketch.base)
    tiny = 1e-12

    def likelihood(j):
        p, q = chance(np.maximum(u - v * j, tiny)), chance(np.maximum(v - u * j, tiny))
        return above * np.log(p) + below * np.log(q) + same * np.log(np.maximum(1 - p - q, tiny))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(40):  # the likelihood has one peak
        x, y = high - ratio * (high - low), low + ratio * (high - low)
        left = likelihood(x) > likelihood(y)
        high, low = np.where(left, y, high), np.where(left, low, x)
    return (low + high) / 2


_SKETCHED = "doc_id bigint, n_shingles bigint, digest binary, registers binary"


def _sketch_batches(sketch: Sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), sketch.words) for text in batch.column("text")]
            sizes = np.array([len(x) for x in sets], np.int64)
            some = [x for x in sets if len(x)]
            rows = iter(registers_of(np.concatenate(some), np.cumsum([0, *map(len, some[:-1])]), sketch) if some else ())
            digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
            registers = [next(rows).tobytes() if n else None for n in sizes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(registers, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "registers"],
            )

    return run


def sketch_documents(docs: DataFrame, sketch: Sketch = DEFAULT) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_shingles, digest of the set, registers); the last two null without words."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(_sketch_batches(sketch), _SKETCHED)


def _set_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sets = [], []
            for text in batch.column("text"):
                hashes = shingle_set(text.as_py(), words)
                digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                sets.append(hashes.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["digest", "shingles"])

    return run


def _likely(sketch: Sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, sketch.registers) for c in ("r_a", "r_b"))
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            keep = likely_similarity(a, b, n_a, n_b, sketch) >= sketch.floor
            yield batch.select(["src", "dst"]).filter(pa.array(keep))

    return run


def _band_keys(sketch: Sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = sketch.members()
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                registers = np.frombuffer(b"".join(part.column("registers").to_pylist()), np.uint16).reshape(-1, sketch.registers).astype(np.uint64)
                keys = np.empty((len(registers), sketch.bands), np.uint64)
                for i, chosen in enumerate(members):
                    key = np.full(len(registers), i + 1, np.uint64)
                    for r in chosen:
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + registers[:, r])
                    keys[:, i] = key
                again = np.repeat(np.arange(part.num_rows), sketch.bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), part.column("node").take(pa.array(again))], names=["key", "node"])

    return run


def _shingle_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, sketch: Sketch, label: str) -> DataFrame:
    """node, shingles of the classes in ``nodes`` (node), from the text of one document each."""
    wanted = settle(classes.join(nodes, "node", "left_semi").select("node", "digest", "first_id"), f"{label}-wanted", compact=True)
    texts = docs.join(wanted.select("first_id").distinct(), docs["doc_id"].eqNullSafe(F.col("first_id"))).select("text")
    found = texts.mapInArrow(_set_batches(sketch.words), "digest binary, shingles array<bigint>").join(wanted.select("digest", "node"), "digest")
    return settle(found.dropDuplicates(["node"]).select("node", "shingles"), f"{label}-sets")


def _met(sketch: Sketch):
    """Links inside parts of buckets, counted by products of node x shingle tables, a run of shingles at a time."""
    keys, run_length = ["key", "low", "high"], 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys, 1):
            bounds = group_edges(table, keys)
            for first, last in zip(bounds[:-1], bounds[1:], strict=True):
                group = table.slice(first, last - first)
                node, part, block = (group.column(c).to_numpy() for c in ("node", "part", "block"))
                lists = group.column("shingles").combine_chunks()
                sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
                _, token, often = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
                row, several = np.repeat(np.arange(len(node)), sizes), often[token] > 1
                row, column = row[several], (np.cumsum(often > 1) - 1)[token[several]]
                order = np.argsort(column, kind="stable")
                row, column = row[order], column[order]
                shared = np.zeros((len(node), len(node)), np.float32)
                for low in range(0, int(column.max(initial=-1)) + 1, run_length):
                    some = slice(*np.searchsorted(column, [low, low + run_length]))
                    has = np.zeros((len(node), run_length), np.float32)
                    has[row[some], column[some] - low] = 1
                    shared += has @ has.T
                link = sketch.of * shared >= sketch.share * (sizes[:, None] + sizes[None, :] - shared)
                link &= (part[:, None] != part[None, :]) & (node[:, None] > node[None, :])
                if group.column("low")[0] != group.column("high")[0]:
                    link &= block[:, None] != block[None, :]
                a, b = np.nonzero(link)
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["src", "dst"])

    return run


def _links_across(left: DataFrame, sets: DataFrame, sketch: Sketch) -> DataFrame:
    """left (key, node, part): the links between nodes of one bucket and different parts.

    A bucket is dealt into blocks of about ``block`` nodes, and each two blocks are one unit of work; only
    links leave it, no other pair.
    """
    sizes = settle(left.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / sketch.block).cast("bigint").alias("blocks")), "sizes", compact=True)
    dealt = left.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    met = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    units = met.select("key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "node", "part").join(sets, "node")
    order = ["key", "low", "high"]
    return units.repartition(*order).sortWithinPartitions(*order).mapInArrow(_met(sketch), "src bigint, dst bigint").distinct()


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, sketch: Sketch, label: str) -> DataFrame:
    """The pairs (src, dst) of classes that are links."""
    side = lambda x, as_: classes.select(F.col("node").alias(as_), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    fit = F.expr(f"{sketch.of} * least(n_a, n_b) >= {sketch.share} * greatest(n_a, n_b)")
    sketched = pairs.join(side("a", "src"), "src").join(side("b", "dst"), "dst").where(fit)
    likely = settle(sketched.mapInArrow(_likely(sketch), "src bigint, dst bigint"), f"{label}-likely", compact=True)

    ends = likely.select(F.col("src").alias("node")).unionByName(likely.select(F.col("dst").alias("node"))).distinct()
    sets = _shingle_sets(ends, classes, docs, sketch, label)
    met = likely.join(sets.select(F.col("node").alias("src"), F.col("shingles").alias("s_a")), "src").join(
        sets.select(F.col("node").alias("dst"), F.col("shingles").alias("s_b")), "dst"
    )
    shared = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - shared
    return settle(met.where(sketch.of * shared >= sketch.share * union).select("src", "dst"), f"{label}-links", compact=True)


def near_duplicates(docs: DataFrame, sketch: Sketch = DEFAULT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, n_shingles, component_id, kept, class_id.

    component_id is the smallest doc_id reachable by links, class_id the smallest with the same
    shingle set. Null and empty texts and texts of white space have n_shingles 0 and are linked with
    nothing. Texts of any length are read whole. Repeated doc_ids keep their own rows; rows with a
    null doc_id take part, and get a null component_id if no member of their component has an id;
    kept is true for the rows whose doc_id is component_id, and where both are null. Other columns
    are not read, whatever their names. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = settle(sketch_documents(docs, sketch), "sketches")
    classes = settle(
        sketched.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"), F.count(F.lit(1)).alias("rows"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )

    dealt = classes.select("node", "registers").mapInArrow(_band_keys(sketch), "key bigint, node bigint")
    shared = settle(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key"), "shared", compact=True)
    members = settle(dealt.join(shared, "key", "left_semi"), "members", compact=True)

    # What is joined by a bucket's key is stored before, so that adaptive execution can split a bucket that holds a third of all.
    leaders = settle(members.groupBy("key").agg(F.min("node").alias("dst")), "leaders", compact=True)
    to_leader = members.join(leaders, "key").where("node != dst").select(F.col("node").alias("src"), "dst").distinct()
    first = _confirmed(to_leader, classes, docs, sketch, "leader")
    found = settle(connected_components(first), "found")

    placed = settle(members.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part")), "placed")
    mixed = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("p"), F.max("part").alias("q")).where("n > 2 and p != q").select("key")
    mixed = settle(mixed, "mixed", compact=True)
    left = settle(placed.join(mixed, "key", "left_semi"), "left", compact=True)
    sets = _shingle_sets(left.select("node").distinct(), classes, docs, sketch, "left")
    second = settle(_links_across(left, sets, sketch), "across", compact=True)

    whole = connected_components(found.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionByName(second))
    parts = classes.join(whole, "node", "left").select("digest", "first_id", "rows", "component")
    firsts = parts.where("component is not null").groupBy("component").agg(F.min("first_id").alias("component_id"))
    # Only classes of several rows or with links say more than the row itself knows.
    told = settle(
        parts.where("component is not null or rows > 1")
        .join(firsts, "component", "left")
        .select("digest", F.col("first_id").alias("class_id"), F.coalesce("component_id", "first_id").alias("component_id"), F.lit(True).alias("told")),
        "told",
    )
    rows = sketched.select("doc_id", "n_shingles", "digest").join(told, "digest", "left")
    component = F.when(F.col("told"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.when(F.col("told"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
    )
