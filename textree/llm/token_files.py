"""Token ids in files of directly addressable codes, and reading them back.

A segment holds the ids of whole documents. Each id is cut into chunks, lowest first: level 0 has the first
chunk of every id, level 1 the second chunk of those ids that go on, and so forth; a bitmap per level says
which go on and a directory counts the set bits before every 512th place. The place of an id on the next
level is the rank of its bit, so any id is found from its number alone, without decoding its neighbours.

One file per task, segments one after another, tasks in ascending order of doc_id.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textree.llm.batches import text_slices
from textree.llm.text_encoder import TextEncoder
from textree.storage import delete_path, new_path, store

MAGIC = b"DAC1"
HEADER = struct.Struct("<4sBxxxIIQQ")  # magic, levels, file number, documents, ids, bytes of the segment
LEVEL = struct.Struct("<BxxxxxxxQ")  # bits of a chunk, entries
RANK_BITS = 512
CHUNK_BITS = (8, 8, 8, 8)
SEGMENT_IDS = 1_000_000
END = b"\n"  # the writer ends each segment with it


def _popcount(packed: np.ndarray) -> np.ndarray:
    return np.bitwise_count(packed)


def encode_levels(ids: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(bits, chunks, bitmap, directory) of each level; chunks are bytes."""
    levels, rest = [], ids.astype(np.uint32)
    for bits in CHUNK_BITS:
        more = rest >> bits
        goes_on = more > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-len(rest) // RANK_BITS) * RANK_BITS // 8, np.uint8)
        padded[: len(bitmap)] = bitmap
        ones = _popcount(padded).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
        directory = np.zeros(len(ones) + 1, np.uint32)
        np.cumsum(ones, out=directory[1:])
        levels.append((bits, (rest & ((1 << bits) - 1)).astype(np.uint8), padded, directory))
        rest = more[goes_on]
        if not len(rest):
            break
    return levels


def write_segment(file: int, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    levels = encode_levels(ids)
    present = np.array([x is not None for x in doc_ids], np.uint8)
    parts = [
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        present.tobytes(),
        np.array(lengths, "<u8").tobytes(),
    ]
    for bits, chunks, bitmap, directory in levels:
        parts += [LEVEL.pack(bits, len(chunks)), chunks.tobytes(), bitmap.tobytes(), directory.astype("<u4").tobytes()]
    body = b"".join(parts)
    return HEADER.pack(MAGIC, len(levels), file, len(doc_ids), len(ids), HEADER.size + len(body)) + body


@dataclass
class Segment:
    """One segment over the bytes of a file; ``access`` finds single ids, ``ids`` decodes all."""

    file: int
    doc_ids: list[int | None]
    lengths: np.ndarray
    levels: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]
    n_ids: int
    size: int

    @classmethod
    def read(cls, data: memoryview, at: int = 0) -> Segment:
        magic, n_levels, file, n_docs, n_ids, size = HEADER.unpack_from(data, at)
        if magic != MAGIC or at + size > len(data):
            raise ValueError("not a whole segment of token ids")
        place = at + HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal place
            got = np.frombuffer(data, kind, count, place)
            place += got.nbytes
            return got

        numbers, present, lengths = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs)
        levels = []
        for _ in range(n_levels):
            bits, count = LEVEL.unpack_from(data, place)
            place += LEVEL.size
            blocks = -(-count // RANK_BITS)
            levels.append((bits, take("u1", count), take("u1", blocks * RANK_BITS // 8), take("<u4", blocks + 1)))
        doc_ids = [x if p else None for x, p in zip(numbers.tolist(), present.tolist(), strict=True)]
        return cls(file, doc_ids, lengths, levels, n_ids, size)

    def access(self, number: int) -> int:
        """The id at ``number``: one chunk, one bit and one rank per level."""
        value, shift, at = 0, 0, number
        for bits, chunks, bitmap, directory in self.levels:
            value |= int(chunks[at]) << shift
            if not bitmap[at >> 3] >> (at & 7) & 1:
                return value
            block = at // RANK_BITS
            first = block * RANK_BITS // 8
            before = int(_popcount(bitmap[first : at >> 3]).sum()) + int(bitmap[at >> 3] & ((1 << (at & 7)) - 1)).bit_count()
            at, shift = int(directory[block]) + before, shift + bits
        return value

    def ids(self) -> np.ndarray:
        value = np.zeros(0, np.uint32)
        for bits, chunks, bitmap, _ in reversed(self.levels):
            goes_on = np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)
            level = chunks.astype(np.uint32)
            level[goes_on] |= value << np.uint32(bits)
            value = level
        return value


def segments(content: bytes) -> Iterator[Segment]:
    data, at = memoryview(content), 0
    while at < len(data):
        segment = Segment.read(data, at)
        yield segment
        at += segment.size + len(END)


@functools.lru_cache(maxsize=1)
def library_encoder(path: str) -> TextEncoder:
    """The library's own steps, with the ids of known words kept."""
    tokenize = Tokenizer.from_file(path).model.tokenize
    return TextEncoder(path, lambda word: [x.id for x in tokenize(word)])


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    path: str,
    end_id: int,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all texts, each closed by ``end_id``, in ascending order of id, to raw files in ``path``.

    ``path`` is any folder Spark can write. Rows are range-partitioned by id and, among equal or null ids, by
    a hash of the text, into ``files`` files (as many as the scan has pieces). A task holds one segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = library_encoder(tokenizer_path), TaskContext.get().partitionId()
        end = int(end_id).to_bytes(4, "little")
        doc_ids, lengths, ids, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            payload = write_segment(file, doc_ids, lengths, np.frombuffer(b"".join(ids), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([payload], pa.binary())], ["payload"])

        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                doc_ids += batch.column("doc_id").slice(start, len(texts)).to_pylist()
                for text in texts:
                    ids.append(encoder.encode(text) + end)
                    lengths.append(len(ids[-1]) // 4)
                    held += lengths[-1]
                if held >= SEGMENT_IDS:
                    yield flush()
                    doc_ids, lengths, ids, held = [], [], [], 0
        if doc_ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(files or max(1, rows.rdd.getNumPartitions()), F.col("doc_id"), tie)
    ordered = ordered.sortWithinPartitions(F.col("doc_id"), tie)
    # bytes pass through the text writer as they are
    ordered.mapInArrow(run, "payload binary").select(F.col("payload").cast("string")).write.text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """file, doc_id, place (ids before it in its file), n_tokens and ids_crc32 of every document in ``path``."""
    schema = pa.schema(
        [("file", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                before = 0
                for segment in segments(content.as_buffer()):
                    ids = segment.ids().astype("<u4")
                    edges = np.r_[0, np.cumsum(segment.lengths.astype(np.int64))]
                    crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                    columns = [[segment.file] * len(crcs), segment.doc_ids, before + edges[:-1], np.diff(edges), crcs]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
                    before += int(edges[-1])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    kinds = "file int, doc_id long, place long, n_tokens long, ids_crc32 long"
    return found.select("content").mapInArrow(run, kinds)


def token_index(docs: DataFrame, tokenizer_path: str, end_id: int, **options) -> DataFrame:
    """Write token files to the shared folder and give doc_id, start, n_tokens, ids_crc32 as read back from them.

    Null and empty texts have only the end id. Repeated rows each count, next to each other; null ids come
    first. An empty table gives an empty table; other columns are not read; very long texts are whole in one
    segment. ``start`` adds the totals of earlier files, one row per file.
    """
    spark = docs.sparkSession
    path = new_path(spark, "token-files")
    write_token_files(docs, tokenizer_path, path, end_id, **options)
    read = store(read_token_files(spark, path), "token-index").df
    delete_path(spark, path)
    totals = read.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    earlier = totals.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    return read.join(F.broadcast(earlier), "file").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
