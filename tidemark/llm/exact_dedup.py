"""Exact duplicates: a two-pass Bloom filter finds what may repeat; only those rows are shuffled.

Pass one hashes every text into a Bloom filter whose cells count to two. Tasks send the few
cells they touched; each slice of the filter is merged by one task and kept as one bit per
cell: "set at least twice". Pass two tests every row against this filter. A row whose cells
are not all set twice has no equal and goes straight through. The others are shuffled by
their SHA-256 and settled exactly, so a false alarm costs a shuffled row and no correctness.

The filter has ``bits_per_row`` cells a row up to ``max_bits`` cells. That bound is the size of
the broadcast (``max_bits / 8`` bytes); beyond it more rows are shuffled, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tidemark.llm.common import free_name, read_table, texts_of, tidied
from tidemark.session import settle

HASHES = 3
SLICE_BITS = 1 << 18


def _folded(texts: pa.Array) -> list[bytes]:
    """Texts in UTF-8 with A-Z lower-cased and nothing else changed."""
    return pc.ascii_lower(texts).cast(pa.large_binary()).to_pylist()


def _cells(texts: list[bytes], bits: int) -> np.ndarray:
    """The filter's cells of each text, one row per text."""
    import xxhash

    a = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in texts), np.uint64, len(texts))
    b = (a >> np.uint64(32)) | np.uint64(1)
    return np.stack([(a + np.uint64(k) * b) % np.uint64(bits) for k in range(HASHES)], axis=1).astype(np.int64)


def _filter_bits(rows: int, bits_per_row: int, max_bits: int) -> int:
    bits = SLICE_BITS
    while bits < rows * bits_per_row and bits < max_bits:
        bits *= 2
    return bits


def repeat_filter(df: DataFrame, text: str, bits_per_row: int = 16, max_bits: int = 1 << 31) -> tuple[bytes, int]:
    """(bitmap of the cells set at least twice, number of cells)."""
    bits = _filter_bits(df.select(F.lit(1)).count(), bits_per_row, max_bits)

    @tidied
    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, counts = np.unique(_cells(_folded(texts_of(batch.column(0))), bits).ravel(), return_counts=True)
            cells = np.sort(np.concatenate((cells, cells[counts > 1])))  # twice is enough
            slices, begins = np.unique(cells // SLICE_BITS, return_index=True)
            ends = np.append(begins[1:], len(cells))
            inside = (cells % SLICE_BITS).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(slices, pa.int64()), pa.array([inside[b:e].tobytes() for b, e in zip(begins, ends)], pa.binary())],
                names=["slice", "cells"],
            )

    def merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLICE_BITS, np.uint8)
        for batch in batches:
            for piece in batch.column("cells").to_pylist():
                found = np.bincount(np.frombuffer(piece, "<u4"), minlength=SLICE_BITS)
                counts = np.minimum(counts + np.minimum(found, 2), 2).astype(np.uint8)
        bitmap = np.packbits(counts == 2, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([bitmap], pa.binary())], names=["slice", "bitmap"])

    slices = (
        df.select(text).mapInArrow(touched, "slice long, cells binary")
        .groupBy("slice").applyInArrow(merged, "slice long, bitmap binary")
    )
    whole = bytearray(bits // 8)
    for row in slices.collect():  # at most max_bits / 8 bytes
        at = row.slice * (SLICE_BITS // 8)
        whole[at : at + SLICE_BITS // 8] = row.bitmap
    return bytes(whole), bits


def with_repeat_flag(df: DataFrame, text: str, sha: str, flag: str, **size) -> DataFrame:
    """``df`` with the SHA-256 of the normalised text and whether another row may have the same text."""
    bitmap, bits = repeat_filter(df, text, **size)
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    @tidied
    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            texts = _folded(texts_of(batch.column(text)))
            cells = _cells(texts, bits)
            maybe = ((twice[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=1)
            digests = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, digests, pa.array(maybe, pa.bool_())], names=[*batch.schema.names, sha, flag])

    schema = StructType([*df.schema.fields, StructField(sha, StringType()), StructField(flag, BooleanType())])
    return df.mapInArrow(tested, schema)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", **size) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty. The row with
    the largest id stays; a NULL id is smaller than any other. Of several rows with the same
    id and text one stays. Empty input gives an empty result; other columns are not read.
    """
    narrow = df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    flagged = with_repeat_flag(narrow, "text", "text_sha256", "maybe", **size).drop("text")
    rows = settle(flagged.withColumn("row_id", F.monotonically_increasing_id()), "op9-rows")
    straight = rows.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    repeated = rows.where("maybe")
    groups = settle(
        repeated.groupBy("text_sha256").agg(
            F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count(F.lit(1)).alias("group_size")
        ),
        "op9-groups",
    )
    resolved = repeated.join(groups, "text_sha256").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("keep.row_id")).alias("kept"), "text_sha256",
    )
    return straight.unionByName(resolved)


def drop_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text", **size) -> DataFrame:
    """The rows of ``df`` that stay, with their columns; rules as in ``exact_groups``.

    Rows without an equal are never shuffled. Of the others each task passes on one row per
    text, so a text that fills a third of the table reaches its group as one row per task.
    """
    sha, flag, rank = (free_name(df, name) for name in ("sha", "maybe", "rank"))
    flagged = with_repeat_flag(df, text, sha, flag, **size)
    order = Window.partitionBy(sha).orderBy(F.col(id_col).desc_nulls_last())
    firsts = flagged.where(flag).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank)
    return flagged.where(~F.col(flag)).unionByName(firsts).drop(sha, flag)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


QUERIES = {"op9_exact_dedup": op9_exact_dedup}

ORACLE_SQL = {
    "op9_exact_dedup": """
    WITH t AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM t WINDOW w AS (PARTITION BY text_sha256)"""
}
