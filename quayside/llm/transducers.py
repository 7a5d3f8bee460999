"""Count transducers: minimal acyclic automata over words, whose paths carry counts.

A path is a row of ``longest`` word numbers; shorter phrases end in 0, the end mark. Words are numbered from 1
in byte order, so paths in order of their numbers are in order of their words. States are built from the
sorted paths, the deepest first: once all paths through a prefix are known its state is final, and states with
the same arcs become one, found by a hash of their arcs and compared arc by arc. Weights stay with the paths, in
order; a state knows how many paths leave it, so a prefix leads to a range of paths, and its count is the
sum of the weights in this range: two reads of a running total.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from quayside.llm.shingles import mix

_WORDS = pa.large_binary()


def vocabulary(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in byte order, the end mark first, and the number of each given word."""
    coded = words.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(1, len(order) + 1)
    distinct = pa.concat_arrays([pa.array([b""], _WORDS), coded.dictionary.take(pa.array(order))])
    found = number[coded.indices.to_numpy()] if len(order) else np.empty(0, np.int64)
    return distinct, found


def summed(paths: np.ndarray, weights: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct paths of numbers below ``base``, and the sum of the weights of each."""
    if not len(paths):
        return paths, weights
    if base ** paths.shape[1] < 1 << 62:
        key = paths[:, 0].astype(np.int64)
        for d in range(1, paths.shape[1]):
            key = key * base + paths[:, d]
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        out = np.empty((len(new), paths.shape[1]), np.int32)
        key = key[new]
        for d in reversed(range(paths.shape[1])):
            key, out[:, d] = np.divmod(key, base)
        return out, np.add.reduceat(weights[order], new)
    order = np.lexsort(paths.T[::-1])
    paths = paths[order]
    new = np.flatnonzero(np.concatenate(([True], (paths[1:] != paths[:-1]).any(1))))
    return paths[new], np.add.reduceat(weights[order], new)


def counted(paths: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    return summed(paths, np.ones(len(paths), np.int64), base)


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of all i, ``counts[i]`` of each."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


class CountTransducer:
    """words: the alphabet. levels: for each depth the arcs of its states, (offsets, labels, targets). weights: of the paths."""

    def __init__(self, words: pa.Array, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], weights: np.ndarray):
        self.words, self.levels, self.weights = words, levels, weights
        self.total = np.concatenate(([0], np.cumsum(weights)))
        below = np.ones(1, np.int64)  # paths that leave a state
        self.below, self.before = [below], []
        for offsets, _, targets in reversed(levels):
            running = np.concatenate(([0], np.cumsum(below[targets])))
            self.before.insert(0, running[:-1] - np.repeat(running[offsets[:-1]], np.diff(offsets)))
            below = running[offsets[1:]] - running[offsets[:-1]]
            self.below.insert(0, below)

    @classmethod
    def build(cls, words: pa.Array, paths: np.ndarray, weights: np.ndarray) -> CountTransducer:
        """From sorted distinct paths."""
        depth, n = paths.shape[1], len(paths)
        new = [np.concatenate(([True], np.zeros(max(0, n - 1), bool)))[:n]]
        for d in range(depth):
            changed = np.concatenate(([True], paths[1:, d] != paths[:-1, d]))[:n]
            new.append(new[-1] | changed)
        state = np.zeros(n, np.int64)  # of the prefixes one deeper; at the end, the final one
        levels = []
        for d in reversed(range(depth)):
            arcs = np.flatnonzero(new[d + 1])
            labels = paths[arcs, d].astype(np.int64)
            owner = np.flatnonzero(new[d][arcs])  # the first arc of each prefix of length d
            counts = np.diff(np.append(owner, len(arcs)))
            merged, kept = _register(labels, state, owner, counts)
            pick = _ragged(owner[kept], counts[kept])
            offsets = np.concatenate(([0], np.cumsum(counts[kept])))
            levels.insert(0, (offsets, labels[pick], state[pick]))
            state = merged
        return cls(words, levels, weights)

    def paths(self) -> np.ndarray:
        """All paths, in order."""
        states, columns = np.zeros(1 if len(self.weights) else 0, np.int64), []
        for offsets, labels, targets in self.levels:
            counts = offsets[states + 1] - offsets[states]
            arcs = _ragged(offsets[states], counts)
            columns = [np.repeat(c, counts) for c in columns] + [labels[arcs].astype(np.int32)]
            states = targets[arcs]
        return np.stack(columns, 1) if columns else np.empty((0, 0), np.int32)

    def counts(self, prefixes: np.ndarray) -> np.ndarray:
        """The count of each prefix, a row of word numbers; -1 stands for a word that does not occur. Unknown prefixes count 0."""
        state, low = np.zeros(len(prefixes), np.int64), np.zeros(len(prefixes), np.int64)
        known = np.full(len(prefixes), bool(len(self.weights)))
        base = len(self.words) + 1
        for d in range(prefixes.shape[1]):
            offsets, labels, targets = self.levels[d]
            if not len(labels):
                return np.zeros(len(prefixes), np.int64)
            arcs = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) * base + labels
            wanted = state * base + prefixes[:, d]
            at = np.minimum(np.searchsorted(arcs, wanted), len(arcs) - 1)
            known &= (arcs[at] == wanted) & (prefixes[:, d] >= 0)
            at = np.where(known, at, 0)
            low += np.where(known, self.before[d][at], 0)
            state = np.where(known, targets[at], 0)
        high = low + np.where(known, self.below[prefixes.shape[1]][state], 0)
        return np.where(known, self.total[high] - self.total[low], 0)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each of the words, -1 where it is not in the alphabet."""
        return pc.fill_null(pc.index_in(words.cast(_WORDS), self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def dump(self) -> bytes:
        small = lambda a: a.astype(np.min_scalar_type(int(a.max(initial=0))))
        arrays = [x for level in self.levels for x in (np.diff(level[0]), *level[1:])] + [self.weights]
        ends = np.frombuffer(self.words.buffers()[1], np.int64)[self.words.offset : self.words.offset + len(self.words) + 1]
        sizes, letters = np.diff(ends), memoryview(self.words.buffers()[2] or b"")[ends[0] : ends[-1]]
        out = [struct.pack("<II", len(self.levels), len(letters)), letters]
        for a in [sizes, *arrays]:
            a = small(a)
            out += [struct.pack("<BQ", a.itemsize, len(a)), a.tobytes()]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(out))

    @classmethod
    def load(cls, blob: bytes) -> CountTransducer:
        data = zstandard.ZstdDecompressor().decompress(blob)
        depth, n = struct.unpack_from("<II", data)
        letters, at, arrays = data[8 : 8 + n], 8 + n, []
        while at < len(data):
            size, count = struct.unpack_from("<BQ", data, at)
            arrays.append(np.frombuffer(data, f"<u{size}", count, at + 9).astype(np.int64))
            at += 9 + size * count
        offsets = lambda sizes: np.concatenate(([0], np.cumsum(sizes)))
        words = pa.Array.from_buffers(_WORDS, len(arrays[0]), [None, pa.py_buffer(offsets(arrays[0])), pa.py_buffer(letters)])
        levels = [(offsets(arrays[1 + 3 * d]), arrays[2 + 3 * d], arrays[3 + 3 * d]) for d in range(depth)]
        return cls(words, levels, arrays[-1])


def part_of(words: pa.Array, paths: np.ndarray, weights: np.ndarray, low: int, high: int) -> CountTransducer:
    """The transducer of the sorted paths from ``low`` to ``high``, with only their words."""
    some = paths[low:high]
    used = np.zeros(len(words), bool)
    used[0] = True
    used[some] = True
    number = np.cumsum(used, dtype=np.int32) - 1
    return CountTransducer.build(words.filter(pa.array(used)), number[some], weights[low:high])


def _register(labels: np.ndarray, targets: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States with the same arcs made one: the new state of each old one, and the old ones that are kept."""
    if not len(first):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        arc = mix(labels.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(targets.astype(np.uint64) + np.uint64(1)))
        signature = mix(np.add.reduceat(arc, first) + counts.astype(np.uint64))
    _, chosen, state = np.unique(signature, return_index=True, return_inverse=True)
    like = chosen[state]
    alike = counts == counts[like]
    pairs = np.flatnonzero(alike & (like != np.arange(len(first))))
    if len(pairs):
        own, other = _ragged(first[pairs], counts[pairs]), _ragged(first[like[pairs]], counts[pairs])
        same = (labels[own] == labels[other]) & (targets[own] == targets[other])
        starts = np.cumsum(counts[pairs]) - counts[pairs]
        alike[pairs] = np.logical_and.reduceat(same, starts)
    odd = np.flatnonzero(~alike)  # a hash met by chance: such a state stays by itself
    state = state.astype(np.int64)
    state[odd] = len(chosen) + np.arange(len(odd))
    return state, np.concatenate([chosen, odd])


def union(parts: list[CountTransducer]) -> CountTransducer:
    """All paths of the parts; weights of a path are added."""
    words, number = vocabulary(pa.concat_arrays([p.words.slice(1) for p in parts]))
    paths, weights, at = [], [], 0
    for p in parts:
        own = np.concatenate(([0], number[at : at + len(p.words) - 1]))
        at += len(p.words) - 1
        paths.append(own[p.paths()])
        weights.append(p.weights)
    return CountTransducer.build(words, *summed(np.concatenate(paths), np.concatenate(weights), len(words)))
