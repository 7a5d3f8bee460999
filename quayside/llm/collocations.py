"""Phrases whose words occur together more often than apart, by weighted acyclic automata.

1. Shards. A task numbers the words of some megabytes of one language and sorts the n-grams that start at each word. One
   path stands for each word of the texts, so sums over prefixes count phrases of every length up to the
   longest. The sorted paths are cut at the edges of prefix ranges, and a count transducer (``transducers``) is built of
   each part. The edges come from a bounded sample of the texts and only balance the ranges: these hold about equally
   many paths, also where a third of them begin with one word or one pair of words.
2. Union. Transducers are dealt by range and united; weights add up. Prefixes are summed, and those that occur
   often enough leave the range. A prefix that an edge cuts leaves both ranges with a part of its count,
   which a grouping adds.
3. Composition. Frequent phrases form a transducer per range. The parts of each candidate are dealt to their
   ranges in lists and run through the range's transducer. A range that is asked by very many is copied, and
   each copy answers a bounded share of them.

A part occurs at least as often as the phrase, so nothing is lost by keeping only frequent phrases.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.transducers import CountTransducer, counted, part_of, union, vocabulary
from quayside.plans.settle import settle

SHARD = 1 << 21  # bytes of one language whose n-grams are sorted together
HELD = 1 << 23  # bytes a task holds at most before the largest language is sorted
ROWS = 256  # rows turned into Python objects at a time
RANGE = 1 << 19  # paths of a range, about
RANGES = 1 << 16  # ranges at most; beyond, a range holds more paths
ASKED = 1 << 16  # parts asked of a range in one group, about
SAMPLED = 1 << 12, 1 << 18  # texts looked at to choose the edges: so many or a 256th of all, at most the second
NAMED = 1 << 10  # paths that a shard of the sample names
EDGE_SAMPLE = 100_000  # named paths that come to the driver

_KIND = np.zeros(256, np.uint8)  # of a byte: in a word, between words, between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2

_NAMED = "lang string, path array<binary>, weight double"
_CUT = "lang string, range int, blob binary"
_GRAMS = "lang string, gram array<string>, f bigint"


def _sorted_paths(texts: list[bytes], longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The n-grams of texts: words, and sorted paths with their counts; one path for each word, of it and the next ones in its piece."""
    raw = np.frombuffer(b"\n".join(texts).lower(), np.uint8)  # bytes.lower: A-Z alone
    kind = _KIND[raw]
    inside = kind == 0
    edges = np.diff(np.concatenate(([False], inside, [False])).view(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    distinct, number = vocabulary(words)
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    paths = np.zeros((len(number), longest), np.int32)
    for k in range(min(longest, len(number))):
        here = slice(0, len(number) - k)
        paths[here, k] = np.where(piece[k:] == piece[here], number[k:], 0)
    return distinct, *counted(paths, len(distinct))


def _shards(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """The n-grams of one language and some megabytes at a time."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size: dict[str, int] = defaultdict(int)

    def out(lang: str) -> tuple:
        size.pop(lang)
        return lang, *_sorted_paths(held.pop(lang), longest)

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            for lang, text in zip(part["lang"].to_pylist(), part["text"].cast(pa.binary()).to_pylist(), strict=True):
                held[lang].append(text)
                size[lang] += len(text) + 1
                if size[lang] >= SHARD:
                    yield out(lang)
                elif sum(size.values()) >= HELD:
                    yield out(max(size, key=size.get))
    for lang in list(held):
        yield out(lang)


def _named(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """Paths of the sample at equal distances, and how many each stands for."""
    for lang, words, paths, _ in _shards(batches, longest):
        at = np.unique(np.linspace(0, len(paths), NAMED, endpoint=False).astype(np.int64)) if len(paths) else np.empty(0, np.int64)
        named = [[words[int(w)].as_py() for w in path] for path in paths[at]]
        weight = np.full(len(at), len(paths) / max(1, len(at)))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(named, pa.list_(pa.binary())), pa.array(weight)], ["lang", "path", "weight"])


def _edges(texts: DataFrame, longest: int) -> dict[str, list[tuple[bytes, ...]]]:
    """Where the ranges of each language begin."""
    rows = texts.count()
    one_of = max(1, rows // min(SAMPLED[1], max(SAMPLED[0], rows >> 8)))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(one_of)) == 0) if one_of > 1 else texts
    named = settle(sample.mapInArrow(lambda b: _named(b, longest), _NAMED), "named")
    told = named.agg(F.count(F.lit(1)), F.sum("weight")).first()
    keep = max(1, -(-told[0] // EDGE_SAMPLE))
    rows = named.where(F.pmod(F.xxhash64("lang", "path"), F.lit(keep)) == 0).limit(2 * EDGE_SAMPLE).collect()
    scale = one_of * (told[1] or 0.0) / max(1.0, sum(r.weight for r in rows))
    each = max(RANGE, one_of * (told[1] or 0.0) / RANGES)
    edges: dict[str, list[tuple[bytes, ...]]] = {}
    sums: dict[str, float] = defaultdict(float)
    for lang, path, weight in sorted((r.lang, tuple(map(bytes, r.path)), r.weight) for r in rows):
        own = edges.setdefault(lang, [])
        sums[lang] += weight * scale
        if sums[lang] >= each and (not own or own[-1] < path):
            own.append(path)
            sums[lang] = 0.0
    return edges


def _place(words: list[bytes], paths: np.ndarray, edge: tuple[bytes, ...]) -> int:
    """How many paths come before ``edge``."""
    low, high = 0, len(paths)
    for d, word in enumerate(edge):
        at = bisect_right(words, word) - 1
        column = paths[low:high, d]
        if words[at] != word:
            return low + int(np.searchsorted(column, at, "right"))
        low, high = low + int(np.searchsorted(column, at, "left")), low + int(np.searchsorted(column, at, "right"))
    return low


def _cut(batches: Iterator[pa.RecordBatch], edges: dict[str, list[tuple[bytes, ...]]], longest: int) -> Iterator[pa.RecordBatch]:
    """Count transducers of the parts of each shard."""
    for lang, words, paths, weights in _shards(batches, longest):
        names = words.to_pylist()
        at = [0, *(_place(names, paths, e) for e in edges.get(lang, ())), len(paths)]
        cut = [(k, part_of(words, paths, weights, *at[k : k + 2]).dump()) for k in range(len(at) - 1) if at[k] < at[k + 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(cut), pa.string()), pa.array([k for k, _ in cut], pa.int32()), pa.array([b for _, b in cut], pa.binary())], ["lang", "range", "blob"]
        )


def _frequent(table: pa.Table, least: int) -> pa.Table:
    """Prefixes of a range that occur ``least`` times, and with any count those that an edge may have cut: also the one without words."""
    held: list[CountTransducer] = []
    size = 0
    for blob in table["blob"].to_pylist():
        held.append(CountTransducer.load(blob))
        size += len(held[-1].weights)
        if size > 2 * RANGE:
            held = [union(held)]
            size = len(held[0].weights)
    whole = union(held)
    paths, total = whole.paths(), whole.total
    words = whole.words.cast(pa.large_string())
    grams, sizes, counts = [np.empty(0, np.int32)], [np.zeros(1, np.int64)], [total[-1:]]
    new = np.zeros(len(paths), bool)
    new[:1] = True
    for d in range(paths.shape[1]):
        new[1:] |= paths[1:, d] != paths[:-1, d]
        first = np.flatnonzero(new)
        f = total[np.append(first[1:], len(paths))] - total[first]
        wanted = f >= least
        if d < paths.shape[1] - 1:
            wanted[[0, -1]] = True
        wanted &= paths[first, d] > 0
        chosen = first[wanted]
        grams.append(paths[chosen, : d + 1].ravel())
        sizes.append(np.full(len(chosen), d + 1))
        counts.append(f[wanted])
    offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), words.take(pa.array(np.concatenate(grams))).cast(pa.string()))
    n = len(lists)
    return pa.table({"lang": pa.array(table["lang"].to_pylist()[:1] * n, pa.string()), "gram": lists, "f": pa.array(np.concatenate(counts), pa.int64())})


def _range_of(edges: dict[str, list[tuple[bytes, ...]]], lang: str, gram: list[bytes], longest: int) -> int:
    return bisect_right(edges.get(lang, []), tuple(gram) + (b"",) * (longest - len(gram)))


def _ranged(batches: Iterator[pa.RecordBatch], edges: dict, longest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = batch["gram"].to_pylist()
        at = [_range_of(edges, lang, [w.encode() for w in g], longest) for lang, g in zip(batch["lang"].to_pylist(), grams, strict=True)]
        yield batch.append_column("range", pa.array(at, pa.int32()))


def _as_paths(grams: list[list[str]], longest: int) -> tuple[pa.Array, np.ndarray]:
    words, number = vocabulary(pa.array([w.encode() for g in grams for w in g], pa.large_binary()))
    paths = np.zeros((len(grams), longest), np.int32)
    sizes = np.array([len(g) for g in grams])
    row = np.repeat(np.arange(len(grams)), sizes)
    paths[row, np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = number
    return words, paths


def _built(table: pa.Table, longest: int) -> pa.Table:
    """One transducer of the frequent phrases of a range; here a path's weight is its own count."""
    words, paths = _as_paths(table["gram"].to_pylist(), longest)
    order = np.lexsort(paths.T[::-1])
    t = CountTransducer.build(words, paths[order], table["f"].to_numpy()[order])
    return pa.table({"lang": table["lang"].slice(0, 1), "range": table["range"].slice(0, 1), "blob": pa.array([t.dump()], pa.binary())})


_NONE = pa.table(
    [pa.array([], k) for k in (pa.string(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.int64())], names=["lang", "gram", "cut", "side", "f"]
)
_ASKED = "lang string, range int, grams array<array<string>>, cuts array<int>, sides array<int>"


def _asked(batches: Iterator[pa.RecordBatch], edges: dict, longest: int) -> Iterator[pa.RecordBatch]:
    """For each candidate and cut its two parts, in lists by the range that knows them."""
    for batch in batches:
        lists: dict[tuple[str, int], tuple[list, list, list]] = defaultdict(lambda: ([], [], []))
        for lang, gram in zip(batch["lang"].to_pylist(), batch["gram"].to_pylist(), strict=True):
            coded = [w.encode() for w in gram]
            for k in range(1, len(gram)):
                for side, part in ((0, coded[:k]), (1, coded[k:])):
                    for column, value in zip(lists[lang, _range_of(edges, lang, part, longest)], (gram, k, side), strict=True):
                        column.append(value)
        keys, values = list(lists), list(lists.values())
        columns = [[k[0] for k in keys], [k[1] for k in keys], *([v[i] for v in values] for i in range(3))]
        kinds = [pa.string(), pa.int32(), pa.list_(pa.list_(pa.string())), pa.list_(pa.int32()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "range", "grams", "cuts", "sides"])


_ANSWERS = "lang string, gram array<string>, cut int, side int, f bigint"


def _composed(asked: pa.Table, known: pa.Table, longest: int) -> pa.Table:
    """The parts asked of one range run through its transducer."""
    t = CountTransducer.load(known["blob"][0].as_py())
    grams = [g for row in asked["grams"].to_pylist() for g in row]
    cuts, sides = (np.concatenate([np.array(row, np.int32) for row in asked[c].to_pylist()]) for c in ("cuts", "sides"))
    parts = [g[k:] if s else g[:k] for g, k, s in zip(grams, cuts.tolist(), sides.tolist(), strict=True)]
    number = t.numbers(pa.array([w.encode() for p in parts for w in p], pa.large_binary()))
    sizes = np.array([len(p) for p in parts])
    paths = np.zeros((len(parts), longest), np.int64)
    paths[np.repeat(np.arange(len(parts)), sizes), np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = number
    columns = [[asked["lang"][0].as_py()] * len(parts), grams, cuts, sides, t.counts(paths)]
    kinds = [pa.string(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "gram", "cut", "side", "f"])


def _scored(batches: Iterator[pa.RecordBatch], longest: int, scale: int) -> Iterator[pa.RecordBatch]:
    """The lowest ``scale * a * a / (l * r)`` of all cuts, rounded down, the first cut of equal ones. Python's integers have no limit."""
    for batch in batches:
        a = batch["a"].to_pylist()
        found = []
        sides = [(batch[f"l{k}"].to_pylist(), batch[f"r{k}"].to_pylist()) for k in range(1, longest)]
        for i, f in enumerate(a):
            score, k = min((scale * f * f // (l[i] * r[i]), k) for k, (l, r) in enumerate(sides) if l[i] is not None)
            found.append((sides[k][0][i], sides[k][1][i], score))
        l, r, score = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch["lang"], batch["gram"], batch["a"], pa.array(l, pa.int64()), pa.array(r, pa.int64()), pa.array(score, pa.int64())],
            ["lang", "gram", "a", "l", "r", "score"],
        )


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, top: int | None = 2000, inside: int = 50, scale: int = 1_000_000
) -> DataFrame:
    """The best phrases of each language of ``docs`` (lang, text): lang, rank, phrase, a, l, r, n, score.

    A-Z count as a-z. Pieces end at ``. , ; : ! ?`` and at line feeds, vertical tabs, form feeds and returns; words of a
    piece are divided by spaces and tabs. Phrases of 2 to ``longest`` words that occur ``least`` times (a) are cut in two at
    each place; l and r are the counts of the parts and ``scale * a * a / (l * r)``, rounded down, is the score; the lowest
    counts, the first of equal ones. A phrase inside a longer one that occurs at least ``inside`` percent as often goes.
    n counts the words of the language. By score, a, both falling, and phrase in byte order, the ``top`` first are returned (all, if None).

    A missing text is empty, a missing language is ``und``; texts of any length are one more piece of a shard; repeated rows
    count each time; an empty table or one without words gives no rows. Further columns are ignored, whatever their names.
    """
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words at least and occur once at least")
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    edges = _edges(texts, longest)
    cut = texts.mapInArrow(lambda b: _cut(b, edges, longest), _CUT)
    counts = cut.groupBy("lang", "range").applyInArrow(lambda t: _frequent(t, least), _GRAMS)
    grams = settle(counts.groupBy("lang", "gram").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.size("gram") == 0)), "grams")
    ranged = grams.where(F.size("gram") > 0).mapInArrow(lambda b: _ranged(b, edges, longest), f"{_GRAMS}, range int")
    known = settle(ranged.groupBy("lang", "range").applyInArrow(lambda t: _built(t, longest), _CUT), "known")

    candidates = grams.where(F.size("gram") > 1)
    asked = settle(candidates.select("lang", "gram").mapInArrow(lambda b: _asked(b, edges, longest), _ASKED), "asked")
    # A range that very many ask is asked in several groups.
    shares = asked.groupBy("lang", "range").agg(F.ceil(F.sum(F.size("cuts")) / ASKED).cast("int").alias("shares"))
    shares = settle(shares, "shares", compact=True)
    share = F.pmod(F.xxhash64(F.col("grams")[0], F.size("grams")), F.col("shares")).cast("int")
    dealt = asked.join(shares, ["lang", "range"]).withColumn("share", share).drop("shares").groupBy("lang", "range", "share")
    copies = known.join(shares, ["lang", "range"]).withColumn("share", F.explode(F.expr("sequence(0, shares - 1)"))).drop("shares")
    answers = dealt.cogroup(copies.groupBy("lang", "range", "share")).applyInArrow(
        lambda a, k: _composed(a, k, longest) if a.num_rows else _NONE, _ANSWERS
    )
    part = lambda k, side: F.max(F.when((F.col("cut") == k) & (F.col("side") == side), F.col("f")))
    cuts = answers.groupBy("lang", "gram").agg(*[part(k, s).alias(f"{'lr'[s]}{k}") for k in range(1, longest) for s in (0, 1)])
    scored = candidates.withColumnRenamed("f", "a").join(cuts, ["lang", "gram"]).mapInArrow(
        lambda b: _scored(b, longest, scale), "lang string, gram array<string>, a bigint, l bigint, r bigint, score bigint"
    )
    # The largest count of a longer candidate around each phrase.
    inner = F.expr(
        "flatten(transform(sequence(2, size(gram) - 1), m -> transform(sequence(1, size(gram) - m + 1), i -> slice(gram, i, m))))"
    )
    around = candidates.where(F.size("gram") > 2).select("lang", F.explode(inner).alias("gram"), "f")
    around = around.groupBy("lang", "gram").agg(F.max("f").alias("_around"))
    left = scored.join(around, ["lang", "gram"], "left")
    left = left.where(F.col("_around").isNull() | (100 * F.col("_around") < inside * F.col("a"))).drop("_around")
    phrases = left.withColumn("phrase", F.array_join("gram", " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order).cast("bigint"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    totals = grams.where(F.size("gram") == 0).select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
