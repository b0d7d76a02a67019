"""Connected components of a table of links, and a bounded filter on whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix64
from tidemark.session import settle

SLICE_BITS = 1 << 18
HASHES = 3


def components(links: DataFrame) -> DataFrame:
    """One row per linked node: node, label (the smallest node it reaches). ``links`` has long columns a and b.

    Each task first turns its own links into stars. Then large-star and small-star steps by turns:
    every node hands its smallest neighbour to its other neighbours, first to the larger ones,
    then to the smaller ones, until the links are stars around the smallest node. Each round is
    written to the shared folder; the number of rounds grows with the logarithm of the longest
    chain. Minima are combined before the shuffle.
    """
    pairs = links.where("a <> b").select("a", "b").mapInArrow(_stars, "u long, v long")
    pairs, before = settle(pairs, "links"), None
    while True:
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before = now
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        both_ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(least, "u").select(F.explode(both_ends).alias("e"))
        pairs = settle(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links (a, b) as links (u, v) of each node with the smallest one it reaches by them."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    both = np.array([(x, root(x)) for x in parent], np.int64).reshape(-1, 2)
    both = both[both[:, 0] != both[:, 1]]
    yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])


def _cells(values: np.ndarray, bits: int) -> np.ndarray:
    a = mix64(values.astype(np.int64).view(np.uint64))
    b = (a >> np.uint64(32)) | np.uint64(1)
    return np.stack([(a + np.uint64(k) * b) % np.uint64(bits) for k in range(HASHES)], axis=1).astype(np.int64)


class Bloom:
    """Which whole numbers may be in a set: never wrong about one that is."""

    def __init__(self, bitmap: bytes, bits: int):
        self.bitmap, self.bits = bitmap, bits

    def __contains__(self, value: int) -> bool:
        return bool(self.test(np.array([value]))[0])

    def test(self, values: np.ndarray) -> np.ndarray:
        cells = _cells(values, self.bits)
        data = np.frombuffer(self.bitmap, np.uint8)
        return ((data[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=1)


def bloom_of(df: DataFrame, column: str, bits_per_row: int = 12, max_bits: int = 1 << 27) -> Bloom:
    """A filter of the column's numbers; at most ``max_bits / 8`` bytes, beyond which it lets more others through.

    Tasks send the cells they set, each slice of the filter is put together by one task, and the
    driver gets the slices.
    """
    rows, bits = df.count(), SLICE_BITS
    while bits < rows * bits_per_row and bits < max_bits:
        bits *= 2

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.unique(_cells(batch.column(0).to_numpy(), bits).ravel()) if batch.num_rows else np.zeros(0, np.int64)
            slices, begins = np.unique(cells // SLICE_BITS, return_index=True)
            inside = (cells % SLICE_BITS).astype("<u4")
            pieces = [inside[b:e].tobytes() for b, e in zip(begins, np.append(begins[1:], len(cells)))]
            yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int64()), pa.array(pieces, pa.binary())], names=["slice", "cells"])

    def merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(SLICE_BITS, bool)
        for batch in batches:
            for piece in batch.column("cells").to_pylist():
                marks[np.frombuffer(piece, "<u4")] = True
        bitmap = np.packbits(marks, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([bitmap], pa.binary())], names=["slice", "bitmap"])

    slices = (
        df.select(F.col(column).cast("long")).where(F.col(column).isNotNull()).mapInArrow(touched, "slice long, cells binary")
        .groupBy("slice").applyInArrow(merged, "slice long, bitmap binary")
    )
    whole = bytearray(bits // 8)
    for row in slices.collect():  # at most max_bits / 8 bytes
        whole[row.slice * (SLICE_BITS // 8) : (row.slice + 1) * (SLICE_BITS // 8)] = row.bitmap
    return Bloom(bytes(whole), bits)
