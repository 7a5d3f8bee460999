"""Token ids in files: frequency-ranked, byte-aligned variable-length codes with separate control bytes.

Ids are replaced by their rank by frequency over the whole corpus. A rank takes one to four bytes; two
bits of a control byte say how many, and the control bytes of a block stand before its data bytes, so
numpy decodes a block with one table lookup and no loop over ids.

A block (all numbers little-endian):
    4 bytes  "TVB1"      4 bytes  documents d      8 bytes  ids n
    8 d bytes  doc_ids    d bytes  1 where doc_id is null    8 d bytes  ids of each document
    (n + 3) // 4 control bytes, the first id in the lowest two bits    the data bytes
Blocks are rows of Parquet files, (shard, block, before, payload): Spark's committed writes keep a lost
task's half-written blocks out. Shards follow each other by doc_id, blocks inside a shard too; before
counts the ids of the shard's earlier blocks. The rank table is a Parquet file beside them.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.plans.settle import settle

BLOCK_IDS = 1 << 18  # a block ends with the document that reaches so many ids
CACHE = 1_000_000  # words a Python worker remembers

_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"


def _narrow_pattern() -> str:
    """The byte-level pattern for texts of the first 256 code points, whose classes the standard library matches fastest."""
    signs = lambda kind: "".join(re.escape(chr(i)) for i in range(256) if regex.match(kind, chr(i)))
    letters, numbers, space = signs(r"\p{L}"), signs(r"\p{N}"), signs(r"\s")
    return _WORDS.format(letter=f"[{letters}]", number=f"[{numbers}]", letters=letters, numbers=numbers, space=space)


class CachedTokenizer(dict):
    """Ids of whole texts by the tokenizers library; as a dict, the ids of the words met so far.

    Added tokens in a text are cut out first, as the library does: ``<|endoftext|>`` is one id. A byte-level
    tokenizer without normalizer merges inside its own pre-tokens only, so each distinct word of the rest is
    encoded once per worker, by the model of the library. Other tokenizers encode whole texts.
    """

    def __init__(self, definition: str, limit: int = CACHE):
        super().__init__()
        self.library, self.limit = Tokenizer.from_str(definition), limit
        self.model = self.library.model
        told = json.loads(definition)
        split, added = told.get("pre_tokenizer") or {}, told.get("added_tokens") or []
        self.by_word = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
            and not told.get("normalizer") and not told.get("truncation") and not told.get("padding")
            and told["model"].get("type") == "BPE" and not told["model"].get("dropout")
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        )
        self.added = {t["content"]: t["id"] for t in added}
        self.cut = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.added, key=len, reverse=True))) if added else None
        self.kind = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.narrow = re.compile(_narrow_pattern()).findall
        self.wide = regex.compile(_WORDS.format(letter=r"\p{L}", number=r"\p{N}", letters=r"\p{L}", numbers=r"\p{N}", space=r"\s")).findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the vocabulary
        rest = iter(range(256, 512))
        self.sign = [chr(b) if b in plain else chr(next(rest)) for b in range(256)]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:  # bounds memory; words met again are encoded again
            self.clear()
        signs = "".join(map(self.sign.__getitem__, word.encode()))
        found = self[word] = array(self.kind, [t.id for t in self.model.tokenize(signs)]).tobytes()
        return found

    def encode(self, text: str) -> bytes:
        """Little-endian ids, of two bytes if the vocabulary allows, else of four."""
        if not self.by_word:
            return array(self.kind, self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if self.cut is None or not self.cut.search(text):
            return self._words(text)
        out, at = [], 0
        for token in self.cut.finditer(text):
            out += [self._words(text[at : token.start()]), array(self.kind, [self.added[token[0]]]).tobytes()]
            at = token.end()
        return b"".join([*out, self._words(text[at:])])

    def _words(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return b"".join(map(self.__getitem__, self.wide(text)))
        return b"".join(map(self.__getitem__, self.narrow(text)))


@lru_cache(1)
def _tokenizer(definition: str) -> CachedTokenizer:
    return CachedTokenizer(definition)


def _width(definition: str) -> str:
    return "<u2" if Tokenizer.from_str(definition).get_vocab_size() <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, definition: str, end_id: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> counted, doc_id, ids: two bytes an id if the vocabulary allows, else four.

    Null texts count as empty. Each task adds a row with counted true: how often each id came, eight
    bytes an id of the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    kind = _width(definition)
    end = b"" if end_id is None else np.array([end_id], kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared.value)
        total = np.zeros(max(tokenizer.library.get_vocab_size(), (end_id or 0) + 1), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = [tokenizer.encode(t.as_py() or "") + end for t in part.column("text")]
                total += np.bincount(np.frombuffer(b"".join(ids), kind), minlength=len(total))
                yield pa.RecordBatch.from_arrays([pa.array([False] * len(ids)), part.column("doc_id"), pa.array(ids, pa.binary())], names=["counted", "doc_id", "ids"])
        yield pa.RecordBatch.from_arrays([pa.array([True]), pa.nulls(1, pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["counted", "doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _TOKENS)


_TOKENS = "counted boolean, doc_id bigint, ids binary"


def frequency_ranks(counts: DataFrame) -> np.ndarray:
    """Ids that occur from the most to the least frequent, equal ones by id, from the counted rows of ``tokenize``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.column("ids"):
                more = np.frombuffer(row.as_py(), np.int64)
                total = np.pad(total, (0, max(0, len(more) - len(total))))
                total[: len(more)] += more
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["id", "n"])

    # One row per id of the vocabulary reaches the driver.
    counted = counts.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = counted.column("id").to_numpy(), counted.column("n").to_numpy()
    return ids[np.lexsort((ids, -n))].astype(np.uint32)


def pack_codes(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of numbers below 2**32."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    bits = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    bits[: len(ranks)] = size - 1
    bits = bits.reshape(-1, 4)
    control = bits[:, 0] | bits[:, 1] << 2 | bits[:, 2] << 4 | bits[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.tobytes(), data.tobytes()


_SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1  # of the four numbers behind a control byte


def unpack_codes(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n numbers behind ``pack_codes``."""
    size = _SIZES[np.frombuffer(control, np.uint8)].ravel()[:n]
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[start].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        more = np.flatnonzero(size > k)
        out[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_block(doc_ids: list[int | None], counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack_codes(ranks)
    head = struct.pack("<4sIQ", b"TVB1", len(doc_ids), len(ranks))
    return b"".join((head, np.array([x or 0 for x in doc_ids], "<i8").tobytes(), bytes(x is None for x in doc_ids), np.array(counts, "<i8").tobytes(), control, data))


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids of each document and all ranks of a block."""
    magic, d, n = struct.unpack_from("<4sIQ", block)
    if magic != b"TVB1":
        raise ValueError("not a block of token ids")
    doc_ids, at = np.frombuffer(block, "<i8", d, 16).tolist(), 16 + 8 * d
    null, at = block[at : at + d], at + d
    counts, at = np.frombuffer(block, "<i8", d, at), at + 8 * d
    middle = at + (n + 3) // 4
    return [None if x else i for i, x in zip(doc_ids, null, strict=True)], counts, unpack_codes(block[at:middle], block[middle:], n)


_BLOCKS = "shard int, block int, before bigint, payload binary"


def write_store(docs: DataFrame, path: str, tokenizer_json: str, end_id: int | None, block_ids: int = BLOCK_IDS) -> None:
    """Tokenize ``docs`` (doc_id, text, ...) and write the store at ``path``, documents by ascending doc_id.

    Null doc_ids come first; rows with equal doc_id follow each other in the order of the input.
    Null texts count as empty. A document is never divided over blocks. Other columns are not read. An empty table
    gives a store without blocks.
    """
    kind = _width(tokenizer_json)
    path_of = lambda name: f"{path}/{name}"
    spark: SparkSession = docs.sparkSession
    tokenize(docs, tokenizer_json, end_id).write.option("compression", "zstd").partitionBy("counted").parquet(path_of("raw"))
    written = spark.read.schema("doc_id bigint, ids binary, counted boolean").parquet(path_of("raw"))
    tokens, order = written.where("not counted").select("doc_id", "ids"), frequency_ranks(written.where("counted"))
    spark.createDataFrame(pa.table({"rank": np.arange(len(order), dtype=np.int64), "id": order.astype(np.int64)})).coalesce(1).write.parquet(path_of("ranks"))
    shared = spark.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        rank = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, counts, parts, n = [], [], [], 0

        def finished():
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([write_block(doc_ids, counts, np.concatenate(parts))], pa.binary())],
                names=["shard", "block", "before", "payload"],
            )

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                own = rank[np.frombuffer(ids.as_py(), kind)]
                doc_ids.append(doc_id)
                counts.append(len(own))
                parts.append(own)
                n += len(own)
                if n >= block_ids:
                    yield finished()
                    block, before = block + 1, before + n
                    doc_ids, counts, parts, n = [], [], [], 0
        if doc_ids:
            yield finished()

    # The place in the input tells equal doc_ids apart, so that also one id with a third of all rows is spread.
    placed = tokens.withColumn("place", F.monotonically_increasing_id())
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parallel, "doc_id", "place").sortWithinPartitions("doc_id", "place")
    ordered.select("doc_id", "ids").mapInArrow(run, _BLOCKS).write.option("compression", "none").parquet(path_of("blocks"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of a store, from its files alone."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    table = spark.read.parquet(f"{path}/ranks").toArrow()  # one row per id of the vocabulary
    order = np.zeros(table.num_rows, np.uint32)
    order[table.column("rank").to_numpy()] = table.column("id").to_numpy()
    shared = spark.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            for shard, before, payload in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist(), batch.column("payload"), strict=True):
                doc_ids, counts, ranks = read_block(payload.as_py())
                ids = order[ranks]
                ends = np.cumsum(counts)
                starts = ends - counts
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(doc_ids), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(before + starts), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["shard", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    read = settle(blocks.mapInArrow(run, "shard int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"), "read")
    # One row per shard, so this window is as small as the list of shards.
    shards = read.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("earlier"))
    return read.join(F.broadcast(earlier), "shard").select("doc_id", (F.col("earlier") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
