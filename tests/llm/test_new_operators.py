"""Phrases, repeated bytes and hard negatives against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import collocations, hard_negatives, repeated_bytes, transducers

LONG = " ".join(f"w{i % 97}" for i in range(30_000))
TEXTS = [
    ("en", "New York is big, New York! is old; new york IS here. " * 6), ("en", "New York is big, New York! is old; new york IS here. " * 6),
    ("de", "ab ab ab ab ab ab. " * 9), (None, "x y z\tx y z\nx y z\x0bx y z " * 5), ("en", None), ("en", ""), (None, " .,;:!? \t\n"), ("fr", LONG), ("fr", "É é É é. " * 12),
    ("en", "a\x01 b a\x01 b " * 8),
]


@pytest.fixture(scope="module")
def texts(spark):
    """Extra columns have names that the operators use inside."""
    rows = [(i, t, lang, "x", 1, "g") for i, (lang, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, gram string, f int, row string")


def brute_phrases(rows, longest=3, least=10, top=2000, inside=50, scale=1_000_000):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang, text = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        around = Counter()
        for g, a in candidates.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    around[g[i : i + k]] = max(around[g[i : i + k]], a)
        found = []
        for g, a in candidates.items():
            if g in around and 100 * around[g] >= inside * a:
                continue
            score, k = min((scale * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("longest, least, top", [(3, 10, 2000), (2, 1, 5), (4, 3, None)])
def test_phrases(texts, longest, least, top):
    got = sorted(map(tuple, collocations.collocations(texts, longest, least, top).collect()))
    assert got == brute_phrases(TEXTS, longest, least, top)


def test_phrases_in_narrow_ranges(texts, monkeypatch):
    """Edges that cut words and pairs, shards of a few texts, and requests in many groups."""
    for name, value in {"RANGE": 7, "SHARD": 300, "HELD": 600, "ASKED": 3, "ROWS": 2}.items():
        monkeypatch.setattr(collocations, name, value)
    small = texts.where("doc_id <> 7")
    got = sorted(map(tuple, collocations.collocations(small, least=2).collect()))
    assert got == brute_phrases([t for i, t in enumerate(TEXTS) if i != 7], least=2)


def test_phrases_of_nothing(texts):
    assert collocations.collocations(texts.where("false")).collect() == []
    assert collocations.collocations(texts.where("doc_id in (4, 5, 6)")).collect() == []
    with pytest.raises(ValueError, match="two words"):
        collocations.collocations(texts, longest=1)


def test_scores_beyond_64_bits():
    columns = {"lang": ["x"], "gram": [["a", "b"]], "a": [3 * 10**12], "l1": [4 * 10**12], "r1": [5 * 10**12]}
    batch = pa.RecordBatch.from_pydict({k: pa.array(v, None if k in ("lang", "gram") else pa.int64()) for k, v in columns.items()})
    (found,) = collocations._scored([batch], 2, 1_000_000)
    assert found["score"].to_pylist() == [450_000]


def test_transducers():
    """Shared endings are one state; unions, prefixes and the stored form are those of plain counting."""
    rng = np.random.default_rng(3)
    parts, plain = [], Counter()
    for _ in range(4):
        words, number = transducers.vocabulary(pa.array([f"w{i}".encode() for i in rng.integers(0, 12, 300)], pa.large_binary()))
        paths, weights = transducers.counted(number.reshape(-1, 3).astype(np.int32), len(words))
        parts.append(transducers.CountTransducer.load(transducers.CountTransducer.build(words, paths, weights).dump()))
        for path, w in zip(paths, weights, strict=True):
            for k in range(1, 4):
                plain[tuple(words[int(x)].as_py() for x in path[:k])] += int(w)
    whole = transducers.union(parts)
    for prefix in [*plain, (b"w1", b"none"), (b"none",)]:
        assert whole.counts(whole.numbers(pa.array(prefix, pa.large_binary()))[None]).tolist() == [plain.get(prefix, 0)]
    assert whole.total[-1] == 400 and len(whole.paths()) == len({p for p in plain if len(p) == 3})
    words, number = transducers.vocabulary(pa.array([b"a", b"b", b"c", b"d"], pa.large_binary()))
    shared = transducers.CountTransducer.build(words, np.array([[1, 3, 4], [2, 3, 4]], np.int32), np.array([5, 7]))
    assert [len(level[1]) for level in shared.levels] == [2, 1, 1]


def removed(rows, length):
    count = Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = []
    for key, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if count[text[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        runs = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum())
        out.append((key, len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


PASSAGE = " ".join(f"passage{i}" for i in range(30))
BYTES = [
    (1, f"é one {PASSAGE} two"), (2, f"three {PASSAGE} four {PASSAGE}"), (3, "aaaa" * 60), (4, PASSAGE[:201]), (5, None), (6, ""), (7, "short"), (7, "short"),
    (None, f"no id {PASSAGE[:150]}"), (None, "other"), (9, "日本語" * 90), (10, PASSAGE[:199] + "|"), (11, PASSAGE[1:201]),
]


@pytest.mark.parametrize("length, group", [(200, 4096), (200, 2), (50, 3), (7, 4096), (1, 5)])
def test_repeated_bytes(spark, monkeypatch, length, group):
    monkeypatch.setattr(repeated_bytes, "GROUP", group)
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in BYTES], "doc_id bigint, text string, start int, row string")
    got = sorted((tuple(r) for r in repeated_bytes.digests(repeated_bytes.without_repeats(frame, length)).collect()), key=repr)
    assert got == removed([(i, (t or "").encode()) for i, t in BYTES], length)


def test_repeated_bytes_by_ids(spark):
    """Without missing or repeated ids no copy is numbered; pieces of a long text overlap."""
    unique = {i: (i, t) for i, t in BYTES if i is not None}.values()
    body = bytes(random.Random(2).randrange(97, 123) for _ in range(3000)).decode()
    rows = [*unique, (50, body + "A" + body[500:900]), (51, "B" + body[100:350])]
    want = removed([(i, (t or "").encode()) for i, t in rows], 200)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((tuple(r) for r in repeated_bytes.digests(repeated_bytes.without_repeats(frame)).collect()), key=repr) == want
    raw = body.encode()
    whole = [tuple(b.to_pydict().values()) for b in repeated_bytes._anchors([pa.RecordBatch.from_pydict({"row": [1], "text": [body]})], 200)]
    places = sorted(zip(*[[x for b in whole for x in b[k]] for k in (2, 3)], strict=True))
    assert [s for s, _ in places] + [len(raw) - 199] == [0] + [s + n for s, n in places]
    assert repeated_bytes.without_repeats(frame.where("false")).collect() == []
    with pytest.raises(ValueError, match="one byte"):
        repeated_bytes.without_repeats(frame, 0)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "PIECE", 1 << 9)
    rows = [(1, PASSAGE * 7), (2, "x" + PASSAGE * 2), (3, "y" * 900)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    batches = [pa.RecordBatch.from_pydict({"row": [1], "text": [PASSAGE * 7]})]
    pieces = [dict(zip(b.schema.names, b.to_pydict().values(), strict=True)) for b in repeated_bytes._anchors(batches, 50)]
    covered = sorted((s, n) for b in pieces for s, n in zip(b["start"], b["windows"], strict=True))
    assert covered[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(covered, covered[1:], strict=False))
    assert sorted(map(tuple, repeated_bytes.digests(repeated_bytes.without_repeats(frame, 50)).collect())) == removed([(i, t.encode()) for i, t in rows], 50)


def test_suffix_order(monkeypatch):
    """Mergesort by hashes against plain sorting, and hashes that collide."""
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 600).astype(np.uint8)
    at, kind = np.arange(560), rng.integers(0, 5, 560)
    order = np.argsort(kind, kind="stable")
    first = np.flatnonzero(np.diff(kind[order], prepend=-1))
    suffixes = repeated_bytes.SuffixOrder(raw, at, 9)
    ranked = suffixes.sort(order, first, np.diff(np.append(first, len(order))))
    strings = [raw[i : i + 9].tobytes() for i in at]
    assert [(kind[i], strings[i]) for i in ranked] == sorted((kind[i], strings[i]) for i in at)
    repeated, like = repeated_bytes.repeated_windows(raw, at, kind, 9)
    count = Counter(zip(kind, strings, strict=True))
    assert repeated.tolist() == [count[kind[i], strings[i]] > 1 for i in at]
    assert all(strings[i] == strings[like[i]] and kind[i] == kind[like[i]] for i in at)

    class Colliding(repeated_bytes.SuffixOrder):
        def _hashes(self, place, size):
            return super()._hashes(place, size) & np.uint64(1)

    monkeypatch.setattr(repeated_bytes, "SuffixOrder", Colliding)
    repeated, _ = repeated_bytes.repeated_windows(raw, at, kind, 9)
    assert any(repeated) and all(count[kind[i], strings[i]] > 1 for i in at if repeated[i])


def negatives(rows, anchors, k=5, n=10):
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for i, label, v in rows:
        if i not in anchors:
            continue
        scores = [(-dot(v, w), j, other) for j, other, w in rows if j != i]
        for score, p, _ in sorted(s for s in scores if s[2] == label)[:k]:
            fits = sorted((s, j) for s, j, other in scores if other != label and 30 * -score <= 100 * -s <= 90 * -score)[:n]
            out += [(i, p, rank, j, -score, -s) for rank, (s, j) in enumerate(fits, 1)]
    return sorted(out)


VECTORS = "vec_id bigint, label bigint, vector array<bigint>, block int, score string"


@pytest.mark.parametrize("block, chunk, step, clusters", [(4096, 2048, 512, 64), (20, 4, 3, 3)])
def test_hard_negatives(spark, monkeypatch, block, chunk, step, clusters):
    for name, value in {"BLOCK": block, "CHUNK": chunk, "STEP": step, "CLUSTERS": clusters}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(8)
    middles = rng.normal(0, 60, (6, 8))
    rows = [(int(i), int(rng.integers(0, 3)) if i % 5 else 0, (middles[rng.integers(0, 6)] + rng.normal(0, 12, 8)).astype(int).tolist()) for i in range(120)]
    rows += [(200, 1, rows[3][2]), (201, 2, rows[3][2]), (202, 1, [0] * 8), (203, 7, rows[3][2]), (204, 1, rows[5][2][:5])]  # ties, zeros, a label of its own, a shorter one
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    anchors = set(range(0, 240, 9)) | {202, 203, 204}
    got = hard_negatives.hard_negatives(frame, F.col("vec_id").isin(list(anchors)))
    assert sorted(map(tuple, got.collect())) == negatives(rows, anchors)


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [0.5, 0.25]), (1, 1, [0.5, 0.2]), (2, 2, [0.3, 0.1]), (3, None, [1.0, 1.0]), (4, 1, None), (5, 1, [nan, 1.0]), (6, 2, [inf, 1.0]), (7, 2, [None, 1.0]), (None, 2, [0.3, 0.1]), (8, 2, [])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, label int, embedding array<float>, vector string")
    whole = hard_negatives.whole_vectors(frame)
    assert sorted((r["vec_id"], list(r["vector"])) for r in whole.collect()) == [(0, [128, 64]), (1, [128, 51]), (2, [76, 25]), (8, [])]
    assert sorted(map(tuple, hard_negatives.hard_negatives(whole, F.col("vec_id") == 0).collect())) == [(0, 1, 1, 2, 19648, 11328)]
    assert hard_negatives.hard_negatives(whole.where("false"), F.col("vec_id") == 0).collect() == []
    assert hard_negatives.hard_negatives(whole, F.lit(False)).collect() == []


def test_repeated_rows_of_vectors(spark):
    rows = [(1, 1, [10, 0]), (1, 1, [10, 0]), (2, 1, [9, 0]), (3, 2, [6, 0]), (3, 2, [6, 0])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    got = sorted(map(tuple, hard_negatives.hard_negatives(frame, F.col("vec_id") == 1).collect()))
    assert got == sorted([(1, 2, 1, 3, 90, 60), (1, 2, 2, 3, 90, 60)] * 2)


def test_products_beyond_doubles():
    a = np.array([[1 << 30, 1 << 30]], np.int64)
    assert hard_negatives._products(a, a).tolist() == [[1 << 61]]
    big = np.array([[1 << 30] * 8], np.int64)
    assert hard_negatives._products(big, big).tolist() == [[(1 << 63) - 1]] and hard_negatives._products(big, -big).tolist() == [[-(1 << 63)]]


def test_saturated_lists_are_enlarged(spark):
    """A list full of links doubles while it stays full; another one does not grow."""
    from quayside.llm import nn_descent

    search = nn_descent.Search(neighbours=2, widest_list=8)
    links = [(1, 100 + i, 0.99 - i / 1000) for i in range(9)]
    pairs = spark.createDataFrame([*links, (2, 200, 0.99), (2, 201, 0.5), (2, 202, 0.4), (3, 300, 0.5), (3, 301, 0.4), (3, 302, 0.3)], "src bigint, dst bigint, cosine double")
    for turn, longest in ((0, 2), (1, 4), (2, 8), (5, 8)):
        sizes = {r["src"]: r["count"] for r in nn_descent._nearest(pairs, "src", search, turn).groupBy("src").count().collect()}
        assert sizes == {1: longest, 2: 2, 3: 2}
