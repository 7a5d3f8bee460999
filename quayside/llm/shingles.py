"""Word shingles as 64-bit hashes, a whole Arrow batch at a time."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)  # odd base of the byte polynomial
_BASE_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_SEED = 20240229


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_SEED))
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BLOCK = 1 << 16
_UP, _DOWN = _powers(_ODD, _BLOCK + 1), _powers(_BASE_INVERSE, _BLOCK + 1)


def word_hashes(data: bytes) -> np.ndarray:
    """Hash of each word of lower-cased UTF-8 ``data``; words are runs of bytes other than white space."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.diff(np.concatenate(([True], _IS_SPACE[raw], [True])).view(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    if not len(starts):
        return np.empty(0, np.uint64)
    long = np.flatnonzero(ends - starts > 4096)
    sums = np.zeros(len(raw) + 1, np.uint64)
    if len(raw) <= _BLOCK:
        up, down = _UP, _DOWN
    else:
        up, down = _powers(_ODD, len(raw) + 1), _powers(_BASE_INVERSE, len(raw) + 1)
    np.cumsum(_BYTE_VALUE[raw] * up[: len(raw)], out=sums[1:])
    out = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    if len(long):  # the polynomial is weak on long made-up runs
        import xxhash

        for i in long:
            out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return out


_PLACE = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(_SEED + 1)) | np.uint64(1)


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``words`` consecutive words, A-Z lower-cased.

    A text with fewer words is one shingle, the whole sequence; without words, or null, none.
    """
    hashes = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    total = np.full(n, np.uint64(width))
    for i in range(width):
        total += hashes[i : i + n] * _PLACE[i]
    return np.unique(mix(total))
