"""Token ids in fixed-width bit-packed files.

Documents are range-partitioned by id. Each task writes files of about ``file_ids`` ids, one
after another, so memory is bounded by one file and the longest document. A file that a failed
or repeated task leaves is never read: files are written under a temporary name, then renamed,
and hold the same bytes on every attempt.

File layout, little-endian:

    8 bytes   TMPACK01
    u32       bits of an id
    u32       ids of a block
    u64 x 5   part, file in the part, ids of the part before this file, ids, documents
    u64 x B+1 block offsets in bytes from the first block; the last is the end
    u8  x D   1 if the document has an id
    i64 x D   document ids (0 where there is none)
    u64 x D+1 first id of each document, counted in this file; the last is the end
    blocks    id i of a block takes the bits [i * bits, (i + 1) * bits), lowest bit first,
              padded to whole bytes

Any id can be read alone: its block's offset and its place in the block are known.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import id_number, read_table, texts_of, tidied
from tidemark.llm.token_ids import VOCABULARY_SIZE, encode, forgetting, parts_of, vocabulary_path
from tidemark.session import scratch_path

#: Bytes of text whose distinct words are encoded together.
PIECE_BYTES = 24 << 20

MAGIC = b"TMPACK01"
HEAD = struct.Struct("<8sII5Q")


def id_bits(vocabulary_size: int) -> int:
    """The fewest bits that tell all ids below ``vocabulary_size`` apart."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(wide[:, :bits].ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def file_bytes(ids: np.ndarray, docs: list, starts: np.ndarray, bits: int, block: int, part: int, number: int, before: int) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    blocks = [pack_bits(ids[at : at + block], bits) for at in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    known = np.array([d is not None for d in docs], np.uint8)
    numbers = np.array([0 if d is None else d for d in docs], "<i8")
    head = HEAD.pack(MAGIC, bits, block, part, number, before, len(ids), len(docs))
    return b"".join([head, offsets.tobytes(), known.tobytes(), numbers.tobytes(), starts.astype("<u8").tobytes(), *blocks])


class PackedFile:
    """One file's bytes: its documents, and any range of its ids."""

    def __init__(self, data: bytes):
        magic, self.bits, self.block, self.part, self.number, self.before, self.n_ids, self.n_docs = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a packed id file")
        at, blocks = HEAD.size, -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        at += 8 * (blocks + 1)
        self.known = np.frombuffer(data, np.uint8, self.n_docs, at).astype(bool)
        at += self.n_docs
        self.docs = np.frombuffer(data, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.starts = np.frombuffer(data, "<u8", self.n_docs + 1, at).astype(np.int64)
        self.payload, self.data = at + 8 * (self.n_docs + 1), data

    def ids(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``begin`` to ``end``; only the blocks they lie in are unpacked."""
        end = self.n_ids if end is None else end
        if begin >= end:
            return np.zeros(0, np.uint32)
        first, last = begin // self.block, (end - 1) // self.block
        found = []
        for k in range(first, last + 1):
            n = min(self.block, self.n_ids - k * self.block)
            found.append(unpack_bits(self.data[self.payload + self.offsets[k] : self.payload + self.offsets[k + 1]], self.bits, n))
        return np.concatenate(found)[begin - first * self.block : end - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def write_file(folder: str, name: str, data: bytes) -> None:
    """A whole file or none: written under another name, then moved."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    temporary = f"{root}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        out.write(data)
    store.move(temporary, f"{root}/{name}")


def write_ids(
    df: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    vocabulary_size: int = VOCABULARY_SIZE,
    file_ids: int = 1 << 21,
    block_ids: int = 1 << 14,
) -> DataFrame:
    """Writes the files to ``folder``, in ascending id order, and returns one row per part: part, part_ids, base.

    ``base`` is the number of ids in all parts before. NULL ids come first; rows with the same id
    are ordered by a hash of their texts. NULL texts count as empty and have the end id alone.
    """
    path, bits = vocabulary or vocabulary_path(), id_bits(vocabulary_size)

    @tidied
    @forgetting
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        chunks: list[np.ndarray] = []
        docs: list = []
        sizes: list[int] = []

        def close() -> None:
            nonlocal number, before
            ids, starts = np.concatenate(chunks), np.cumsum([0, *sizes])
            write_file(folder, f"part-{part:08d}-{number:06d}.ids", file_bytes(ids, docs, starts, bits, block_ids, part, number, before))
            number, before = number + 1, before + len(ids)
            chunks.clear(), docs.clear(), sizes.clear()

        for batch in (piece for whole in batches for piece in parts_of(whole, 1, PIECE_BYTES)):
            ids, offsets = encode(texts_of(batch.column(1)), path)
            keys, lengths = batch.column(0).to_pylist(), np.diff(offsets)
            at, held = 0, sum(sizes)
            while at < len(keys):  # as many documents as this file still takes, at least one
                room = np.searchsorted(offsets, offsets[at] + max(file_ids - held, 1), side="left")
                to = min(max(int(room), at + 1), len(keys))
                chunks.append(ids[offsets[at] : offsets[to]])
                docs += keys[at:to]
                sizes += lengths[at:to].tolist()
                held += int(offsets[to] - offsets[at])
                at = to
                if held >= file_ids:
                    close()
                    held = 0
        if docs:
            close()
        if before:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([before], pa.int64())], names=["part", "part_ids"])

    tie = "tie"
    ordered = (
        df.select(id_number(df, id_col).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias(tie))
        .repartitionByRange("key", tie).sortWithinPartitions("key", tie).select("key", "text")
    )
    # One row per task, which the driver keeps track of anyway.
    parts = sorted(tuple(r) for r in ordered.mapInArrow(run, "part long, part_ids long").collect())
    bases = np.cumsum([0, *(n for _, n in parts)]).tolist()
    return df.sparkSession.createDataFrame([(p, n, b) for (p, n), b in zip(parts, bases)], "part long, part_ids long, base long")


def read_ids(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                found = PackedFile(data.as_py())
                ids, begins, ends = found.ids(), found.starts[:-1], found.starts[1:]
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(found.n_docs, found.part)), pa.array(found.docs, pa.int64(), mask=~found.known),
                        pa.array(found.before + begins), pa.array(ends - begins), pa.array(crc, pa.int64()),
                    ],
                    names=["part", "doc_id", "in_part", "n_tokens", "ids_crc32"],
                )

    if parts.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").load(f"{folder}/*.ids").select("content")
    rows = files.mapInArrow(run, "part long, doc_id long, in_part long, n_tokens long, ids_crc32 long")
    return rows.join(parts, "part").select("doc_id", (F.col("base") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32")


def op4_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "op4-ids")
    parts = write_ids(read_table(spark, sf_dir, "documents"), folder)
    return read_ids(spark, folder, parts)


QUERIES = {"op4_packed_token_ids": op4_packed_token_ids}
ORACLE_SQL: dict[str, str] = {}
