"""Least padding against all boundaries, language proportions against a plain fit, and odd rows."""

import itertools
import random

import numpy as np
import pytest

from quayside.llm import languages, packing


def padding(lengths, counts, sums, ends):
    total, low = 0, -1
    for end in ends:
        inside = [i for i, length in enumerate(lengths) if low < length <= end]
        total += sum(end * counts[i] - sums[i] for i in inside)
        low = end
    return total


def test_least_padding_against_all_boundaries():
    rng = random.Random(6)
    for _ in range(250):
        n, buckets = rng.randrange(1, 9), rng.randrange(1, 5)
        lengths = sorted(rng.sample(range(1, 60), n))
        counts = [rng.randrange(1, 30) for _ in lengths]
        sums = [sum(rng.randint(max(1, length - 3), length) for _ in range(c)) for length, c in zip(lengths, counts, strict=True)]
        got = packing.least_padding(*(np.array(x, np.int64) for x in (lengths, counts, sums)), buckets)
        best = min(padding(lengths, counts, sums, sorted({*some, lengths[-1]})) for k in range(buckets) for some in itertools.combinations(lengths, k))
        assert len(got) <= buckets and got[-1] == lengths[-1] and padding(lengths, counts, sums, got) == best


def test_documents_are_packed_with_least_padding(spark):
    rng = random.Random(7)
    sizes = [rng.choice([1, 2, 5, 9, 30, 31, 64, 100]) for _ in range(120)]
    rows = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, n_tokens bigint"), budget=300, buckets=3).collect()
    lengths = sorted(set(sizes))
    counts, sums = [sizes.count(x) for x in lengths], [x * sizes.count(x) for x in lengths]
    best = min(padding(lengths, counts, sums, sorted({*some, lengths[-1]})) for k in range(3) for some in itertools.combinations(lengths, k))
    assert sum(r["padding"] for r in rows) == best and sorted(r["n_tokens"] for r in rows) == sorted(sizes)


def test_proportions_against_a_plain_fit():
    """Expectation-maximisation written with loops reaches the same proportions."""
    rng = np.random.default_rng(5)
    likelihood = rng.random((3, 40)) + 0.01
    counts = rng.integers(1, 9, 40).astype(float)
    weights = [1 / 3] * 3
    while True:  # until no proportion moves by a thousandth
        shares = [0.0] * 3
        for cell in range(40):
            parts = [weights[k] * likelihood[k][cell] for k in range(3)]
            for k in range(3):
                shares[k] += counts[cell] * parts[k] / sum(parts)
        moved = max(abs(s / sum(shares) - w) for s, w in zip(shares, weights, strict=True))
        weights = [s / sum(shares) for s in shares]
        if moved < 1e-3:
            break
    fitted, reached = languages._fit(likelihood, counts, 4000)
    plain = sum(counts[cell] * np.log(sum(weights[k] * likelihood[k][cell] for k in range(3))) for cell in range(40))
    assert np.allclose(fitted, weights, atol=1e-9) and abs(reached - plain) < 1e-6 * abs(plain)


@pytest.fixture(scope="module")
def told(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    return table, languages.train(table)


def test_languages_of_odd_rows(spark, told):
    """Repeated rows and ids get one answer, long texts are read whole, mixed ones name both languages."""
    table, model = told
    by = {r["lang"]: r["text"] for r in table.where("length(text) > 2000").select("lang", "text").collect()}
    (first, a), (second, b) = sorted(by.items())[:2]
    rows = [(1, a), (1, a), (None, a), (2, a * 400), (3, a + " " + b), (4, b + " " + a), (5, "12 34"), (6, None), (7, "")]
    found = languages.identify(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, names int"), model).collect()
    got = {(r["doc_id"]): r for r in found}
    assert len(found) == len(rows) and len({(r["lang_pred"], r["score"]) for r in found if r["doc_id"] in (1, None)}) == 1
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == first and {x.split(":")[0] for x in got[3]["langs"].split(",")} >= {first, second}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (5, 6, 7))
    assert got[3]["langs"].split(",")[0].split(":")[1] == got[4]["langs"].split(",")[0].split(":")[1]
