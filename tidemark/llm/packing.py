"""Cost-balanced packing of documents into training sequences.

A piece of n tokens costs ``linear * n + quadratic * n^2``: feed-forward work and attention
within the piece. Each task packs its own documents, a block of ``block_docs`` at a time, and
nothing is shuffled. Whole sequences' worth of a long document fill sequences of their own.
The remainders of a block go, longest first, to the sequence of the lowest cost that has room;
a remainder that fits nowhere is cut at the room there is. A block opens as many sequences as
its tokens fill and hands what is left to the next block. What is left at the end of a task is
less than one sequence and is cut to powers of two, which need no padding. So no sequence is
padded, and memory is bounded by a block.

``sequence_id`` is the task's number in the high bits and a counter in the low ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import id_number, read_table, texts_of, tidied
from tidemark.llm.token_ids import encode, forgetting, parts_of, vocabulary_path

#: Text encoded at a time: a worker also holds the tokenizer and the words a task has met, beside what other stages left to its executor.
#: Each piece's distinct words are looked up among all kept ones, so much smaller pieces take twice the time.
PIECE_BYTES = 4 << 20

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def assign(lengths: np.ndarray, rooms: np.ndarray, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(piece, start within it, length, sequence, offset in it) of every part.

    Pieces go in descending length to the sequence of the lowest cost that has room for them.
    One that fits nowhere gives the emptiest sequence what it holds and is tried again with
    the rest. ``rooms`` adds up to ``lengths``, so at the end every sequence is full.
    """
    rooms = rooms.astype(np.int64).copy()
    size = rooms.copy()
    cost = np.zeros(len(rooms))
    parts = []
    for piece in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[piece])
        while left:
            fits = rooms >= left
            if fits.any():
                to = int(np.argmin(np.where(fits, cost, np.inf)))
                part = left
            else:
                to = int(np.argmax(rooms))
                part = int(rooms[to])
            parts.append((int(piece), start, part, to, int(size[to] - rooms[to])))
            rooms[to] -= part
            cost[to] += linear * part + quadratic * part * part
            start, left = start + part, left - part
    return parts


def powers_of_two(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class _Packer:
    """Pieces of one task on their way into sequences."""

    def __init__(self, size: int, linear: float, quadratic: float, block_docs: int, task: int):
        self.size, self.linear, self.quadratic, self.block_docs = size, linear, quadratic, block_docs
        self.next_sequence = task << 40
        self.waiting: list[tuple[object, int, np.ndarray, int]] = []  # id, start, ids, tokens of the document
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) // self.size * self.size
        for start in range(0, whole, self.size):
            self._place((doc_id, start, ids[start : start + self.size], len(ids)), 0, self.size, self.next_sequence, 0)
            self.next_sequence += 1
        if whole < len(ids):
            self.waiting.append((doc_id, whole, ids[whole:].copy(), len(ids)))
        if len(self.waiting) >= self.block_docs:
            self._pack(last=False)

    def _place(self, piece, start: int, length: int, sequence: int, offset: int) -> None:
        doc_id, at, ids, total = piece
        crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
        self.rows.append((doc_id, at + start, length, crc, total, sequence, offset))

    def _pack(self, last: bool) -> None:
        pieces, self.waiting = self.waiting, []
        if not pieces:
            return
        lengths = np.array([len(p[2]) for p in pieces], np.int64)
        full, rest = divmod(int(lengths.sum()), self.size)
        ends = powers_of_two(rest) if last else [rest] * bool(rest)
        rooms = np.array([self.size] * full + ends, np.int64)
        later = []
        for piece, start, length, to, offset in assign(lengths, rooms, self.linear, self.quadratic):
            if to >= full and not last:  # the sequence that this block does not fill
                doc_id, at, ids, total = pieces[piece]
                later.append((doc_id, at + start, ids[start : start + length], total))
            else:
                self._place(pieces[piece], start, length, self.next_sequence + to, offset)
        self.next_sequence += full + len(ends) * last
        self.waiting = later

    def finish(self) -> None:
        self._pack(last=True)

    def take(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        columns, self.rows = list(zip(*self.rows)), []
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    size: int = 4096,
    linear: float = 1.0,
    quadratic: float = 1 / 4096,
    block_docs: int = 4096,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and an end id; a NULL or empty text is the end id alone, and
    has a piece like any other. Rows with the same or a NULL id are packed one by one. Empty
    input gives an empty result; other columns are not read. ``size`` is a power of two.
    """
    path = vocabulary or vocabulary_path()
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")

    @tidied
    @forgetting
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(size, linear, quadratic, block_docs, TaskContext.get().partitionId())
        for batch in (piece for whole in batches for piece in parts_of(whole, 1, PIECE_BYTES)):
            ids, offsets = encode(texts_of(batch.column(1)), path)
            for doc_id, begin, end in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                packer.add(doc_id, ids[begin:end])
            if (out := packer.take()) is not None:
                yield out
        packer.finish()
        if (out := packer.take()) is not None:
            yield out

    return df.select(id_number(df, id_col).alias("doc_id"), F.col(text)).mapInArrow(run, SCHEMA)


def op10_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


QUERIES = {"op10_cost_balanced_packing": op10_cost_balanced_packing}
ORACLE_SQL: dict[str, str] = {}
