"""Language proportions of documents as a mixture, by expectation-maximisation over character trigrams.

The model is one smoothed trigram distribution per language, counted over all training texts: each
task adds up its own counts and hands on one row per language and trigram cell. A document's trigrams
are then taken as drawn from a mixture of languages. Its proportions are fitted by
expectation-maximisation, and languages join the mixture, most probable first, while they raise the
likelihood by more than the penalty of one more language.

The driver gets languages x cells counts, 65536 cells a language whatever the corpus holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = 1 << 16
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str) -> np.ndarray:
    """Cells of the letter trigrams of a text, lower-cased, all else as one blank; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.uint32)
    points = np.concatenate(([32], np.where(letter, points, 32), [32])).astype(np.uint32)
    points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
    code = (points[:-2] * np.uint32(0x9E3779B1) + points[1:-1]) * np.uint32(0x85EBCA77) + points[2:]
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0xC2B2AE3D)
    return code >> np.uint32(16)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            if lang not in totals:
                totals[lang] = np.zeros(CELLS, np.int64)
            totals[lang] += np.bincount(trigrams(text.as_py()), minlength=CELLS)
    for lang, counts in totals.items():
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells), pa.string()), pa.array(cells, pa.int32()), pa.array(counts[cells])], names=["lang", "cell", "n"])


def train(labelled: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(text, lang) -> languages in order and a table of log-probabilities, languages x cells.

    Rows with a null text or lang are left out. Without any row there are no languages.
    """
    rows = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("text is not null and lang is not null")
    counts = rows.mapInArrow(_counting, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counts.column("lang").to_pylist()))
    table = np.full((len(names), CELLS), smoothing)
    place = {name: i for i, name in enumerate(names)}
    table[[place[x] for x in counts.column("lang").to_pylist()], counts.column("cell").to_numpy()] += counts.column("n").to_numpy()
    return names, np.log(table / table.sum(1, keepdims=True)) if names else table


def _fit(likelihood: np.ndarray, counts: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """Proportions of the rows of ``likelihood`` (languages x distinct trigrams) and the log-likelihood."""
    weights, total = np.full(len(likelihood), 1 / len(likelihood)), counts.sum()
    for _ in range(steps):
        new = weights * (likelihood @ (counts / (weights @ likelihood))) / total
        done = np.abs(new - weights).max() < 1e-3
        weights = new
        if done:
            break
    return weights, float(counts @ np.log(weights @ likelihood))


def mixture(cells: np.ndarray, table: np.ndarray, penalty: float = 3.0, steps: int = 25) -> list[tuple[int, float]]:
    """The languages of one document with their proportions, largest first; empty without trigrams or languages.

    A language more has to raise the log-likelihood by ``penalty`` times the logarithm of the number
    of trigrams; trigrams overlap, so each letter counts about three times. Equal languages come in
    the order of the table.
    """
    if not len(cells) or not len(table):
        return []
    distinct, counts = np.unique(cells, return_counts=True)
    logs = table[:, distinct]
    top = logs.max(0)
    likelihood = np.exp(logs - top)  # the shared factor changes all likelihoods alike
    single = logs @ counts - counts @ top
    first = int(single.argmax())
    if len(table) == 1:
        return [(first, 1.0)]
    weights, _ = _fit(likelihood, counts, steps)
    weights[first] = 2  # the best single language leads
    order = np.argsort(-weights, kind="stable")
    chosen, shares, reached = [first], np.ones(1), float(single[first])
    for language in order[1:]:
        more, best = _fit(likelihood[[*chosen, language]], counts, steps)
        if best - reached <= penalty * np.log(counts.sum() + 1):
            break
        chosen, shares, reached = [*chosen, int(language)], more, best
    return sorted(zip(chosen, shares.tolist(), strict=True), key=lambda x: -x[1])


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], penalty: float = 3.0) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> doc_id, lang_pred, score, langs, one row per row.

    lang_pred is the language with the largest proportion, score that proportion, langs all selected
    ones as ``en:0.93,fr:0.07``. Null and empty texts, texts without a letter, and all texts if the
    model has no language get ``und``, 0.0 and an empty langs. The prediction reads nothing but the
    text, all of it; doc_id is only carried, also where it is null or repeated. Other columns are not
    read.
    """
    names, table = model
    shared = docs.sparkSession.sparkContext.broadcast((names, table.astype(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for batch in batches:
            found = [mixture(trigrams(text.as_py()), table, penalty) if text.is_valid else [] for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([names[x[0][0]] if x else UNKNOWN for x in found], pa.string()),
                    pa.array([min(1.0, x[0][1]) if x else 0.0 for x in found], pa.float64()),
                    pa.array([",".join(f"{names[i]}:{share:.2f}" for i, share in x) for x in found], pa.string()),
                ],
                names=["doc_id", "lang_pred", "score", "langs"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, lang_pred string, score double, langs string")


def label_rows(docs: DataFrame, model: tuple[list[str], np.ndarray], name: str, penalty: float = 3.0) -> DataFrame:
    """``docs`` (text, ...) with all its columns and the predicted language as ``name``, as in ``identify``."""
    names, table = model
    shared = docs.sparkSession.sparkContext.broadcast((names, table.astype(np.float64)))
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for batch in batches:
            found = [mixture(trigrams(text.as_py()), table, penalty) if text.is_valid else [] for text in batch.column("text")]
            languages = pa.array([names[x[0][0]] if x else UNKNOWN for x in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, languages], names=[*columns, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))


def held_out():
    """Whether a document is kept from training: crc32 of doc_id as text leaves 1 when divided by 3; a null id never."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    """Train on the rows of ``docs`` that are not held out, and ``identify`` all rows."""
    model = train(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "langs")
