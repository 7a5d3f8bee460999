"""Repeated byte strings removed: every byte inside a string of ``length`` bytes that also starts elsewhere.

1. Anchors. Of the short strings inside each window of ``length`` bytes the one with the smallest hash is its
   anchor. Equal windows have equal anchors at the same place, so only windows whose anchor occurs more than once
   can repeat. Anchors are counted over all texts, and the stretches around those met twice are cut out.
2. Suffix sort. Stretches are dealt by anchor, and the suffixes at their windows' starts are sorted, to a depth of
   ``length``, by mergesort. Two suffixes are compared by prefix polynomial hashes: a binary search over the length of
   their common extension, then one byte, so a comparison takes log2(length) steps. Suffixes that stand next to
   each other and agree to the full depth repeat; these are verified byte by byte. Merges of all anchors go
   on side by side. Only suffixes at the same distance from their anchor can be equal, so only these are sorted together.
3. An anchor in very many stretches is dealt into groups of at most ``GROUP`` by chance. Windows that are alone
   in their group, and one of each set of equal ones, go on under their SHA-256, which is grouped once more.

The spans found are brought together by row, and joined into maximal runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.shingles import _powers, mix
from quayside.plans.settle import settle

PIECE = 1 << 20  # bytes looked at together
GROUP = 4096  # stretches of one anchor in one group
SORTED = 1 << 17  # windows sorted together, about
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(40503))
_UP, _DOWN = _powers(_ODD, PIECE + 1), _powers(_INVERSE, PIECE + 1)


def _prefix_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the polynomial, and what brings a difference of them to a common place."""
    up, down = (_UP, _DOWN) if len(raw) <= PIECE else (_powers(_ODD, len(raw) + 1), _powers(_INVERSE, len(raw) + 1))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[raw] * up[: len(raw)], out=sums[1:])
    return sums, down


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _stretches(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For texts from ``begins`` to ``ends`` in ``raw``: anchor hash, text, first window, number of windows, anchor's distance from the first.

    A stretch is a run of windows with one anchor. The first of equally small hashes in a window counts.
    """
    anchor = max(1, length * 8 // 25)
    empty = tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64))
    if len(raw) < length:
        return empty
    sums, down = _prefix_hashes(raw)
    hashes = mix((sums[anchor:] - sums[:-anchor]) * down[: len(raw) - anchor + 1])
    low = np.uint64(PIECE - 1)
    place = _lowest((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), length - anchor + 1) & low
    place = place.astype(np.int64)
    inside = np.zeros(len(place) + 1, np.int8)  # windows that lie in one text
    long = ends - begins >= length
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    starts = np.zeros(len(place), bool)
    starts[0] = True
    starts[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
    starts[begins[begins < len(place)]] = True
    first = np.flatnonzero(starts & inside)
    if not len(first):
        return empty
    stops = np.flatnonzero(np.concatenate((starts[1:] | ~inside[1:], [True])) & inside) + 1
    text = np.searchsorted(begins, first, "right") - 1
    return hashes[place[first]], text, first - begins[text], stops - first, place[first] - first


def _anchors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["key", "row", "start", "windows", "lead"]

    def out(texts: list[bytes], rows: list[int], offsets: list[int]) -> pa.RecordBatch:
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        key, text, start, windows, lead = _stretches(np.frombuffer(b"".join(texts), np.uint8), ends - sizes, ends, length)
        columns = [key.view(np.int64), np.array(rows)[text], np.array(offsets)[text] + start, windows.astype(np.int32), lead.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    for batch in batches:
        texts, rows, offsets, size = [], [], [], 0
        for row, text in zip(batch["row"].to_pylist(), batch["text"].cast(pa.large_binary()).to_pylist(), strict=True):
            # Pieces of a long text overlap, so that each window lies in one of them.
            for at in range(0, max(1, len(text) - length + 1), PIECE - length + 1):
                piece = text[at : at + PIECE]
                if len(piece) < length:
                    continue
                if size + len(piece) > PIECE:
                    yield out(texts, rows, offsets)
                    texts, rows, offsets, size = [], [], [], 0
                texts.append(piece)
                rows.append(row)
                offsets.append(at)
                size += len(piece)
        if texts:
            yield out(texts, rows, offsets)


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each stretch."""
    names = ["key", "salt", "row", "start", "windows", "lead", "piece"]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        for row, text, found in zip(batch["row"].to_pylist(), batch["text"].cast(pa.large_binary()).to_pylist(), batch["found"], strict=True):
            values = found.values
            starts, windows = values.field("start").to_pylist(), values.field("windows").to_pylist()
            for column, field in zip((columns[0], columns[1], columns[5]), ("key", "salt", "lead"), strict=True):
                column.extend(values.field(field).to_pylist())
            columns[2].extend([row] * len(starts))
            columns[3].extend(starts)
            columns[4].extend(windows)
            columns[6].extend(text[s : s + n + length - 1] for s, n in zip(starts, windows, strict=True))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


class SuffixOrder:
    """Suffixes of ``raw`` that start at the places ``at``, compared to a depth of ``length`` by hashes of their beginnings.

    A suffix is named by its number in ``at``.
    """

    def __init__(self, raw: np.ndarray, at: np.ndarray, length: int):
        self.raw, self.at, self.length = raw, at, length
        self.sums, self.down = _prefix_hashes(raw)
        self.whole = self._hashes(at, length)

    def _hashes(self, place: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[place + size] - self.sums[place]) * self.down[place]

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The length of the common extension from places that differ within the depth."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length)
        for _ in range(int(self.length).bit_length()):
            middle = (low + high) >> 1
            alike = self._hashes(x, middle) == self._hashes(y, middle)
            low, high = np.where(alike, middle, low), np.where(alike, high, middle)
        return low

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as suffix a comes before, equals or comes after suffix b."""
        out = np.zeros(len(a), np.int8)
        other = np.flatnonzero(self.whole[a] != self.whole[b])
        if len(other):
            x, y = self.at[a[other]], self.at[b[other]]
            common = self._common(x, y)
            out[other] = np.where(self.raw[x + common] < self.raw[y + common], -1, 1)
        return out

    def identical(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of suffixes a and b are the same, whatever the hashes say.

        Pairs that lie one byte behind another pair share all but their last byte with it, so of a chain of
        such pairs the first is compared whole and each other one by one byte.
        """
        order = np.lexsort((self.at[b] - self.at[a], self.at[a]))
        x, y = self.at[a[order]], self.at[b[order]]
        head = np.ones(len(x), bool)
        head[1:] = (x[1:] != x[:-1] + 1) | (y[1:] != y[:-1] + 1)
        same = self.raw[x + self.length - 1] == self.raw[y + self.length - 1]
        word = 8 if self.length >= 8 else 1
        view = np.ndarray(len(self.raw) - word + 1, f"<u{word}", self.raw, strides=(1,))
        first = np.flatnonzero(head)
        for skip in [*range(0, self.length - word + 1, word), self.length - word]:
            same[first] &= view[x[first] + skip] == view[y[first] + skip]
        # A pair holds if no pair of its chain up to it differs.
        differ = np.cumsum(~same)
        before = np.where(first > 0, differ[first - 1], 0)
        out = np.empty(len(x), bool)
        out[order] = differ == before[np.cumsum(head) - 1]
        return out

    def sort(self, numbers: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``numbers`` with each class (from ``first`` on, ``size`` long) in suffix order, by mergesort of all classes side by side."""
        numbers, width = numbers.copy(), 1
        while width < size.max(initial=0):
            big = np.flatnonzero(size > width)
            count = size[big]
            item = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)  # place in the class
            base, total = np.repeat(first[big], count), np.repeat(count, count)
            run = item // width
            right = (run & 1).astype(bool)
            pair = (run & ~1) * width  # where the two runs to be merged begin
            other = np.where(right, pair, np.minimum(pair + width, total))
            low, high = other.copy(), np.where(right, pair + width, np.minimum(pair + 2 * width, total))
            own = base + item
            open_ = np.flatnonzero(low < high)
            while len(open_):  # how many of the other run come first; of equal ones those of the left run do
                middle = (low[open_] + high[open_]) >> 1
                order = self.compare(numbers[base[open_] + middle], numbers[own[open_]])
                before = np.where(right[open_], order <= 0, order < 0)
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            merged = base + pair + (item - run * width) + (low - other)
            moved = numbers[own]
            numbers[merged] = moved
            # Hashes that met by chance may contradict each other; then two suffixes get one place, and one stays empty.
            filled = np.zeros(len(numbers), bool)
            filled[merged] = True
            if not filled[own].all():
                size = size.copy()
                for c in np.unique(np.searchsorted(first, own[~filled[own]], "right") - 1):
                    places = slice(first[c], first[c] + size[c])
                    numbers[places] = sorted(moved[(own >= places.start) & (own < places.stop)], key=self.string)
                    size[c] = 0
            width *= 2
        return numbers

    def string(self, number: int) -> bytes:
        place = self.at[number]
        return self.raw[place : place + self.length].tobytes()


def repeated_windows(raw: np.ndarray, at: np.ndarray, kind: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows that start ``at`` places of ``raw``: which equal another one of the same ``kind``, and for each the first of its equals."""
    if not len(at):
        return np.empty(0, bool), np.empty(0, np.int64)
    order = np.argsort(kind, kind="stable")
    first = np.flatnonzero(np.diff(kind[order], prepend=kind[order][0] - 1))
    size = np.diff(np.append(first, len(order)))
    suffixes = SuffixOrder(raw, at, length)
    whole = suffixes.whole[order]
    alike = np.logical_and.reduceat(whole == np.repeat(whole[first], size), first)  # in order as they are
    ranked = suffixes.sort(order, first[~alike], size[~alike])
    near = np.ones(len(at), bool)
    near[first] = False
    near = np.flatnonzero(near)
    near = near[suffixes.whole[ranked[near]] == suffixes.whole[ranked[near - 1]]]
    same = np.zeros(len(at) + 1, bool)  # whether a window equals the one before it in order
    same[near] = suffixes.identical(ranked[near], ranked[near - 1])
    for c in np.unique(np.searchsorted(first, near[~same[near]], "right") - 1):  # hashes met by chance: ordered by the bytes
        places = slice(first[c], first[c] + size[c])
        ranked[places] = sorted(ranked[places], key=suffixes.string)
        strings = [suffixes.string(m) for m in ranked[places]]
        same[first[c] + 1 : first[c] + size[c]] = [a == b for a, b in zip(strings, strings[1:], strict=False)]
    repeated, like = np.empty(len(at), bool), np.empty(len(at), np.int64)
    repeated[ranked] = same[:-1] | same[1:]
    like[ranked] = ranked[np.maximum.accumulate(np.where(same[:-1], 0, np.arange(len(at))))]
    return repeated, like


_FOUND = "row bigint, low bigint, high bigint, window binary"


def _spans(table: pa.Table, length: int) -> pa.RecordBatch:
    """Spans of the repeated windows of whole groups of stretches; of split groups also what may repeat in another part."""
    key, salt = table["key"].to_numpy(), table["salt"].to_numpy()
    rows, starts = table["row"].to_numpy(), table["start"].to_numpy()
    windows, lead = table["windows"].to_numpy().astype(np.int64), table["lead"].to_numpy().astype(np.int64)
    raw = np.frombuffer(b"".join(table["piece"].to_pylist()), np.uint8)
    sizes = windows + length - 1
    offset = np.cumsum(sizes) - sizes
    group = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]))))
    context = np.repeat(np.arange(len(windows)), windows)
    step = np.arange(len(context)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = offset[context] + step
    kind = group[context] * length + (lead[context] - step)
    repeated, like = repeated_windows(raw, at, kind, length)
    begin = repeated & np.concatenate(([True], (context[1:] != context[:-1]) | ~repeated[:-1]))
    end = repeated & np.concatenate(((context[1:] != context[:-1]) | ~repeated[1:], [True]))
    a, b = np.flatnonzero(begin), np.flatnonzero(end)
    row, low, high = rows[context[a]], starts[context[a]] + step[a], starts[context[b]] + step[b] + length
    open_ = np.flatnonzero((salt[context] >= 0) & (~repeated | (like == np.arange(len(at)))))
    digests = [hashlib.sha256(raw[p : p + length]).digest() for p in at[open_]]
    n, alone = len(row), ~repeated[open_]
    where = starts[context[open_]] + step[open_]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([row, rows[context[open_]]]), pa.int64(), mask=np.concatenate([np.zeros(n, bool), ~alone])),
            pa.array(np.concatenate([low, where]), pa.int64()),
            pa.array(np.concatenate([high, where + length]), pa.int64()),
            pa.array([None] * n + digests, pa.binary()),
        ],
        ["row", "low", "high", "window"],
    )


def _sorted_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Whole groups, as many at a time as have about ``SORTED`` windows."""
    held: list[pa.RecordBatch] = []
    size = 0

    def parts(table: pa.Table, ended: bool) -> tuple[list[pa.Table], pa.Table]:
        key, salt = table["key"].to_numpy(), table["salt"].to_numpy()
        first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]))))
        edges = [*first.tolist(), len(key)] if ended else first.tolist()  # else the last group may go on
        before = np.append(0, np.cumsum(table["windows"].to_numpy()))
        out, at = [], 0
        for edge in edges[1:]:
            if before[edge] - before[at] >= SORTED or edge == edges[-1]:
                out.append(table.slice(at, edge - at))
                at = edge
        return out, table.slice(at)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += int(np.sum(batch["windows"].to_numpy()))
        if size >= SORTED:
            ready, rest = parts(pa.Table.from_batches(held), False)
            yield from (_spans(t, length) for t in ready)
            held, size = rest.to_batches(), int(np.sum(rest["windows"].to_numpy()))
    if held:
        yield from (_spans(t, length) for t in parts(pa.Table.from_batches(held), True)[0])


def _runs(spans: list[dict] | None) -> list[dict[str, int]]:
    """Maximal runs: spans that overlap or touch become one."""
    out: list[list[int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [{"start": a, "end": b} for a, b in out]


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            spans = [_runs(s) for s in part["spans"].to_pylist()]
            sizes, kept = [], []
            for text, runs in zip(part["text"].cast(pa.large_binary()).to_pylist(), spans, strict=True):
                edges = [0, *(x for r in runs for x in (r["start"], r["end"])), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"]
            )


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, text and a number for each row: its doc_id if these are all there and all different, else one given in a stored copy."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = texts.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if ids[0] == ids[1]:
        return texts.withColumn("row", F.coalesce("doc_id", F.lit(0)))
    return settle(texts.withColumn("row", F.monotonically_increasing_id()), "texts")


def without_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_bytes, spans (start, end: the maximal runs removed, in bytes), kept (the bytes left).

    A byte goes if a string of ``length`` bytes that covers it starts at two places, of one text or of two; strings are those
    of the texts as they come, and may overlap. Matches do not cross texts. A missing text is empty; texts shorter than ``length``
    stay whole. Texts of any length are looked at in overlapping pieces. Repeated rows are texts of their own, also with
    equal or missing ids, so all of a repeated text goes. An empty table gives none. Further columns are ignored.
    """
    if length < 1:
        raise ValueError("a string has one byte at least")
    texts = _identified(docs)
    plain = texts.select("row", "text")
    anchors = settle(plain.mapInArrow(lambda b: _anchors(b, length), "key bigint, row bigint, start bigint, windows int, lead int"), "anchors")
    shared = settle(anchors.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "shared")
    salt = F.when(F.col("many") > GROUP, F.pmod(F.xxhash64("row", "start"), F.ceil(F.col("many") / GROUP))).otherwise(-1)
    met = anchors.join(shared, "key").select("row", F.struct("key", salt.cast("int").alias("salt"), "start", "windows", "lead").alias("found"))
    by_row = met.groupBy("row").agg(F.collect_list("found").alias("found"))
    cut = plain.join(by_row, "row").mapInArrow(
        lambda b: _cut(b, length), "key bigint, salt int, row bigint, start bigint, windows int, lead int, piece binary"
    )
    dealt = cut.repartition("key", "salt").sortWithinPartitions("key", "salt")
    found = dealt.mapInArrow(lambda b: _sorted_groups(b, length), _FOUND)
    if shared.where(F.col("many") > GROUP).isEmpty():
        spans = found
    else:
        found = settle(found, "found")
        again = settle(found.where("window IS NOT NULL").groupBy("window").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "again")
        late = found.where("window IS NOT NULL AND row IS NOT NULL").join(again, "window", "left_semi")
        spans = found.where("window IS NULL").unionByName(late)
    by_text = spans.groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    whole = texts.join(by_text, "row", "left").select("doc_id", "text", "spans")
    return whole.mapInArrow(_finished, "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")


def digests(removed: DataFrame) -> DataFrame:
    """The result of ``without_repeats`` in numbers, and the digest of the bytes kept."""
    size = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return removed.select(
        "doc_id", "n_bytes", size.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
