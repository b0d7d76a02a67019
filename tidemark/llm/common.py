"""What the text operators share: reading tables, plain tokens, Arrow batches."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

#: The white space that separates words everywhere in this package: blank and U+0009 to U+000D.
BLANKS = r"[\x20\x09-\x0D]+"

WORDS = pa.list_(pa.string())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def id_number(df: DataFrame, id_col: str) -> Column:
    """Ids as whole numbers: numbers as they are, anything else by a 64-bit hash; NULL stays NULL."""
    column = F.col(id_col)
    if isinstance(df.schema[id_col].dataType, (IntegralType, DecimalType)):
        return column.cast("long")
    return F.when(column.isNotNull(), F.xxhash64(column))


def fold(key: str | Column, parts: int) -> Column:
    """crc32 of the key written as text, modulo ``parts``; NULL keys count as the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on one Arrow batch after another: memory is bounded by a batch."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return to the system what finished batches have left: Spark keeps Python workers, and their memory, for later tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def tidied(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's generator, after which its memory is given back."""

    @functools.wraps(work)
    def run(*given: object) -> Iterator:
        try:
            yield from work(*given)
        finally:
            give_back()

    return run


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts of a batch; NULL becomes the empty text.

    The result begins at the start of its buffers: some string kernels (``ascii_lower``) give
    wrong bytes for an array that does not.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.offset:
        column = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(column.cast(pa.large_string()), "")


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words of a batch one after another, where each text's words begin).

    Words are the maximal runs of anything but ``BLANKS``. The second array has one entry
    more than there are texts.
    """
    parts = pc.ascii_split_whitespace(texts)
    starts = parts.offsets.to_numpy()
    words = parts.values.slice(starts[0], starts[-1] - starts[0])
    empty = pc.equal(words, "")
    if pc.any(empty).as_py():  # a text that begins or ends with white space gives an empty word there
        keep = ~empty.to_numpy(zero_copy_only=False)
        kept = np.concatenate(([0], np.cumsum(keep)))
        return words.filter(pa.array(keep)), kept[starts - starts[0]]
    return words, (starts - starts[0]).astype(np.int64)


def word_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each word's entry, the distinct words)."""
    if not len(words):
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    coded = pc.dictionary_encode(words)
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hashes(distinct: pa.Array) -> np.ndarray:
    """One 64-bit hash for each distinct word."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))


def shingle_hashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words that lie within one text, and the place of each one's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    within = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mix64(total[within]), within
