"""Byte-level BPE by a shuffle of distinct words.

Texts are cut into pre-tokens, and each chunk of a task's documents is written as what it is made of:
per document the places of its pre-tokens in the chunk's vocabulary, and the vocabulary itself, dealt
by a hash of the word. Chunks hold each word once, so the shuffle brings a word at most once per chunk
to the task that encodes it, and a word that fills a third of all texts is no heavier there than any
other. Ids go back to their chunk and are put together by position. The positions never move: they are
written in buckets of the chunk, where the ids meet them.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans.settle import scratch_path

CHUNK_CHARS = 16 << 20  # of text in a chunk; a longer document is a chunk of its own
CHUNK_WORDS = 1 << 18  # distinct words in a chunk, but for one document
WORD_PARTS = 256  # at least so many parts of the vocabulary, and at least the session's shuffle partitions


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(2)
def _encoder(pattern: str, ranks: tuple) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=dict(ranks), special_tokens={})


_EXPLODED = "kind int, chunk bigint, part int, doc_id bigint, places binary, words binary, lengths binary"
_PLACE_BYTES = 4


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as four runs of bytes, high bytes together: they compress better."""
    return values.astype("<u4").view(np.uint8).reshape(-1, _PLACE_BYTES).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(_PLACE_BYTES, -1).T).view("<u4").ravel()


def _explode(pattern: str, parts: int, chunk_chars: int, chunk_words: int):
    def chunk_rows(chunk: int, vocabulary: dict[str, int]) -> Iterator[pa.RecordBatch]:
        words = [w.encode("utf-8", "surrogatepass") for w in vocabulary]
        part = np.fromiter((crc32(w) % parts for w in words), np.int32, len(words))
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
        rows = []
        for own in np.split(order, cuts[1:]) if len(order) else []:
            mine = [words[i] for i in own]
            rows.append((int(part[own[0]]), _planes(own), b"".join(mine), _planes(np.fromiter(map(len, mine), np.uint32, len(mine)))))
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([1] * n, pa.int32()), pa.array([chunk] * n, pa.int64()), pa.array([r[0] for r in rows], pa.int32()), pa.nulls(n, pa.int64())]
            + [pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3)],
            schema=SCHEMA,
        )

    SCHEMA = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("part", pa.int32()), ("doc_id", pa.int64()), ("places", pa.binary()), ("words", pa.binary()), ("lengths", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        chunk, chars, vocabulary = TaskContext.get().partitionId() << 32, 0, {}
        for batch in batches:
            ids, places = [], []

            def documents():
                n = len(ids)
                return pa.RecordBatch.from_arrays(
                    [pa.array([0] * n, pa.int32()), pa.array([chunk] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(ids, pa.int64()), pa.array(places, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
                    schema=SCHEMA,
                )

            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                if chars and (chars + len(text) > chunk_chars or len(vocabulary) > chunk_words):
                    yield documents()
                    ids, places = [], []
                    yield from chunk_rows(chunk, vocabulary)
                    chunk, chars, vocabulary = chunk + 1, 0, {}
                found = find(text)
                own = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in found), np.uint32, len(found))
                ids.append(doc_id)
                places.append(_planes(own))
                chars += len(text)
            yield documents()
        yield from chunk_rows(chunk, vocabulary)

    return run


def _encode_words(pattern: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(pattern, shared.value)._encode_single_piece
        known: dict[bytes, list[int]] = {}
        last = None
        for batch in batches:
            ids_out, lengths_out = [], []
            for part, words, lengths in zip(batch.column("part").to_pylist(), batch.column("words"), batch.column("lengths"), strict=True):
                if part != last:  # sorted by part: no word of this one comes again
                    known.clear()
                    last = part
                data, ends = words.as_py(), np.cumsum(_from_planes(lengths.as_py())).tolist()
                ids: list[int] = []
                sizes = []
                start = 0
                for end in ends:
                    word = data[start:end]
                    start = end
                    found = known.get(word)
                    if found is None:
                        if len(known) > 1_000_000:  # forget, to bound memory: words met again are encoded again
                            known.clear()
                        found = known[word] = encode(word)
                    ids += found
                    sizes.append(len(found))
                ids_out.append(_planes(np.array(ids, np.uint32)))
                lengths_out.append(_planes(np.array(sizes, np.uint32)))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("places"), pa.array(ids_out, pa.binary()), pa.array(lengths_out, pa.binary())], names=["chunk", "places", "ids", "lengths"])

    return run


def _reassemble(key, documents: pa.Table, words: pa.Table) -> pa.Table:
    """Ids of the documents of one chunk, by position."""
    places = [_from_planes(x.as_py()) for x in words.column("places")]
    lengths = [_from_planes(x.as_py()) for x in words.column("lengths")]
    ids = [_from_planes(x.as_py()).astype(np.int32) for x in words.column("ids")]
    n = sum(map(len, places))
    starts, sizes = np.zeros(n, np.int64), np.zeros(n, np.int64)
    before = 0
    for place, length, some in zip(places, lengths, ids, strict=True):
        sizes[place] = length
        starts[place] = before + np.cumsum(length) - length
        before += len(some)
    pool = np.concatenate(ids) if ids else np.empty(0, np.int32)
    out, ends = [], [0]
    for doc in documents.column("places"):
        own = _from_planes(doc.as_py())
        size = sizes[own]
        total = int(size.sum())
        first = np.cumsum(size) - size
        out.append(pool[np.repeat(starts[own] - first, size) + np.arange(total)])
        ends.append(ends[-1] + total)
    flat = np.concatenate(out) if out else np.empty(0, np.int32)
    lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat, pa.int32())).cast(pa.list_(pa.int32()))
    return pa.table({"doc_id": documents.column("doc_id").combine_chunks() if documents.num_rows else pa.array([], pa.int64()), "ids": lists})


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, chunk_chars: int = CHUNK_CHARS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> doc_id, ids array<int>, one row per row.

    Each match of ``pattern`` is encoded by itself by the merge ``ranks``, without special tokens. Null
    and empty texts have no ids. Texts are read whole; a document is never divided. Null and repeated
    doc_ids are carried along. Other columns are not read. An empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(tuple(ranks.items()))
    exploded = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(_explode(pattern, max(WORD_PARTS, parallel), chunk_chars, chunk_words), _EXPLODED)
    table = f"exploded_{uuid.uuid4().hex}"
    (
        exploded.write.format("parquet")
        .option("compression", "zstd")
        .partitionBy("kind")
        .bucketBy(max(64, parallel), "chunk")
        .option("path", scratch_path(spark, "exploded"))
        .saveAsTable(table)
    )
    written = spark.table(table)
    words = written.where("kind = 1").select("part", "chunk", "places", "words", "lengths").repartition("part").sortWithinPartitions("part")
    encoded = words.mapInArrow(_encode_words(pattern, shared), "chunk bigint, places binary, ids binary, lengths binary")
    documents = written.where("kind = 0").select("chunk", "doc_id", "places")
    return documents.groupBy("chunk").cogroup(encoded.groupBy("chunk")).applyInArrow(_reassemble, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, ids, ...) -> doc_id, n_tokens, ids_sha256, bytes: ids joined with the token-byte table.

    The table has one row per token of the vocabulary, so every task holds it. Null ids count as none.
    ids_sha256 is the digest of the decimal ids joined by commas. An id that the table lacks fails.
    """
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        decimal = [str(i).encode() for i in range(len(tokens))]
        for batch in batches:
            counts, digests, texts = [], [], []
            for row in batch.column("ids"):
                ids = row.values.to_numpy(zero_copy_only=False).tolist() if row.is_valid else []
                counts.append(len(ids))
                digests.append(hashlib.sha256(b",".join(map(decimal.__getitem__, ids))).hexdigest())
                texts.append(b"".join(map(tokens.__getitem__, ids)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.binary())], names=["doc_id", "n_tokens", "ids_sha256", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode: doc_id, n_tokens, ids_sha256 and the digest of the decoded bytes."""
    ranks = read_ranks(path)
    back = decode(encode(docs, ranks, pattern), ranks)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))
