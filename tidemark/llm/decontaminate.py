"""Benchmark items inside documents, also with their passages in another order: greedy string tiling.

Words are compared in lower case without punctuation; in scripts that set no blanks each letter is a word. Seeds are
the runs of three words, the shortest that make a tile. A document and an item meet if the seeds they share could cover
enough of the item, counted for each item. The pair is then tiled: the longest run of words that both have
and that no tile covers yet becomes a tile, again and again, until none of three words is left.
Candidate runs come from running Karp-Rabin hashes of one length, which starts large and is
halved. The share of the item under tiles does not depend on the order of its passages; an item
with at least ``share`` of its words under tiles is in the document, and so is one with a tile of ``LONG`` words,
however much more there is of it.

The benchmark is cut into blocks of bounded size; documents are scanned once for each block,
which is broadcast. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import read_table, shingle_hashes, split_words, texts_of, tidied, word_codes, word_hashes
from tidemark.llm.token_ids import parts_of

LEAST = 3
#: Words of one tile that are enough by themselves.
LONG = 50
START = 20
SHARE = 0.8
#: Text of one block of the benchmark, which bounds what is broadcast.
BLOCK_BYTES = 16 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


#: Scripts that set no blanks between words.
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all texts' words, where each text's words begin); marks are dropped, and words of marks alone."""
    words, starts = split_words(texts)
    codes, distinct = word_codes(words)
    if pc.any(pc.match_substring_regex(distinct, UNSPACED)).as_py():
        words, starts = split_words(pc.replace_substring_regex(texts, UNSPACED, r" \1 "))
        codes, distinct = word_codes(words)
    bare = pc.replace_substring_regex(pc.utf8_lower(distinct), r"[^\p{L}\p{N}]+", "")
    hashes, real = word_hashes(bare), pc.not_equal(bare, "").to_numpy(zero_copy_only=False)
    keep = real[codes]
    kept = np.concatenate(([0], np.cumsum(keep)))
    return hashes[codes[keep]], kept[starts]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, base, np.uint64))))


class _Running:
    """Karp-Rabin hashes of all runs of any one length, from one running sum."""

    def __init__(self, words: np.ndarray):
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * _powers(BASE, len(words))[:-1], dtype=np.uint64)))
        self.back = _powers(INVERSE, len(words))

    def runs(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.back[:n] if n > 0 else np.zeros(0, np.uint64)


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Where a run of ``size`` words begins that holds no marked one."""
    total = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(total[size:] == total[:-size]) if len(marked) >= size else np.zeros(0, np.int64)


def _matches(item: np.ndarray, doc: np.ndarray, in_item: _Running, in_doc: _Running, taken: np.ndarray, used: np.ndarray, size: int):
    """(length, place in the item, place in the document) of the longest free matches from ``size`` words on."""
    free_item, free_doc = _free(taken, size), _free(used, size)
    if not len(free_item) or not len(free_doc):
        return []
    item_runs, doc_runs = in_item.runs(size)[free_item], in_doc.runs(size)[free_doc]
    hits = np.flatnonzero(np.isin(doc_runs, item_runs))
    places: dict[int, list[int]] = {}
    for value, at in zip(item_runs.tolist(), free_item.tolist()):
        places.setdefault(value, []).append(at)
    found, done = [], {}
    for value, t in zip(doc_runs[hits].tolist(), free_doc[hits].tolist()):
        for p in places[value]:
            if done.get(t - p, -1) > t:  # inside a match on the same diagonal
                continue
            n = 0
            while p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and not taken[p + n] and not used[t + n]:
                n += 1
            if n >= size:
                found.append((n, p, t))
                done[t - p] = t + n
    return found


def tile(item: np.ndarray, doc: np.ndarray, least: int = LEAST, start: int = START) -> list[tuple[int, int, int]]:
    """Tiles (length, place in the item, place in the document), none of which overlap in either."""
    taken, used, tiles = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    in_item, in_doc = _Running(item), _Running(doc)
    size = max(least, min(start, len(item)))
    while True:
        found = _matches(item, doc, in_item, in_doc, taken, used, size)
        longest = max((n for n, _, _ in found), default=0)
        if longest > 2 * size:
            size = longest
            continue
        again = False
        for n, p, t in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if taken[p : p + n].any() or used[t : t + n].any():
                again = True  # part of it may still make a tile of this length
                continue
            taken[p : p + n] = used[t : t + n] = True
            tiles.append((n, p, t))
        if taken.all():
            return tiles
        if again:
            continue
        if size == least:
            return tiles
        size = max(least, size // 2)


class Items:
    """A block of the benchmark, ready to be looked up: seeds of all items, and their words."""

    def __init__(self, ids: list, texts: pa.Array, least: int = LEAST):
        self.ids, self.least = ids, least
        self.words, self.starts = tokens(texts)
        self.sizes = np.diff(self.starts)
        hashes, at = shingle_hashes(self.words, self.starts, least)
        owner = np.repeat(np.arange(len(ids)), self.sizes)[at] if len(at) else np.zeros(0, np.int64)
        pairs, self.times = np.unique(np.stack([hashes, owner.astype(np.uint64)], axis=1), axis=0, return_counts=True)
        self.seeds, self.first = np.unique(pairs[:, 0], return_index=True)
        self.first = np.append(self.first, len(pairs))
        self.owners = pairs[:, 1].astype(np.int64)
        # Items too short for a seed are found only as a whole document.
        self.short: dict[bytes, list[int]] = {}
        for k in np.flatnonzero((self.sizes > 0) & (self.sizes < least)).tolist():
            self.short.setdefault(self.item(k).tobytes(), []).append(k)
        self.grams = [np.unique(_Running(self.item(k)).runs(least)) for k in range(len(ids))]

    def item(self, k: int) -> np.ndarray:
        return self.words[self.starts[k] : self.starts[k + 1]]

    def meetings(self, words: np.ndarray, starts: np.ndarray, share: float) -> np.ndarray:
        """Pairs (text, item) whose common seeds could cover enough of the item."""
        hashes, at = shingle_hashes(words, starts, self.least)
        if not len(hashes) or not len(self.seeds):
            return np.zeros((0, 2), np.int64)
        place = np.minimum(np.searchsorted(self.seeds, hashes), len(self.seeds) - 1)
        hit = np.flatnonzero(self.seeds[place] == hashes)
        text = np.searchsorted(starts, at[hit], side="right") - 1
        met = np.unique(np.stack([text, place[hit]], axis=1), axis=0)
        n = np.diff(self.first)[met[:, 1]]
        ends = np.cumsum(n)
        inner = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
        entry = np.repeat(self.first[met[:, 1]], n) + inner
        pairs, of = np.unique(np.stack([np.repeat(met[:, 0], n), self.owners[entry]], axis=1), axis=0, return_inverse=True)
        seeds = np.bincount(of.ravel(), self.times[entry], len(pairs))
        return pairs[(seeds * self.least >= share * self.sizes[pairs[:, 1]]) | (seeds > LONG - self.least)]

    def cover(self, doc: np.ndarray, k: int, share: float) -> tuple[int, int]:
        """(words of item ``k`` under tiles in ``doc``, longest tile); zeros if ``share`` is out of reach."""
        item, gram = self.item(k), _Running(doc).runs(self.least)
        inside = np.isin(gram, self.grams[k])
        reach = np.zeros(len(item), bool)
        for at in np.flatnonzero(np.isin(_Running(item).runs(self.least), gram[inside])):
            reach[at : at + self.least] = True
        if reach.sum() < share * len(item) and not len(_free(~reach, LONG)):
            return 0, 0
        # A word outside every shared run of the least length lies in no tile: leave one between regions.
        near = np.zeros(len(doc) + 1, bool)
        for shift in range(self.least):
            near[np.flatnonzero(inside) + shift] = True
        edge = near | np.concatenate(([False], near[:-1]))
        regions = np.where(near[:-1], doc, np.uint64(0))[edge[:-1]]
        tiles = tile(item, regions, self.least)
        return sum(n for n, _, _ in tiles), max((n for n, _, _ in tiles), default=0)

    def contained(self, texts: pa.Array, share: float) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, words under tiles, words of the item, longest tile) of each item in a text."""
        words, starts = tokens(texts)
        for text, k in self.meetings(words, starts, share).tolist():
            item_words = int(self.sizes[k])
            covered, longest = self.cover(words[starts[text] : starts[text + 1]], k, share)
            if covered >= share * item_words or longest >= LONG:
                yield text, k, covered, item_words, longest
        if self.short:
            for text in np.flatnonzero((np.diff(starts) > 0) & (np.diff(starts) < self.least)).tolist():
                own = words[starts[text] : starts[text + 1]]
                for k in self.short.get(own.tobytes(), ()):
                    yield text, k, len(own), len(own), len(own)


def blocks(benchmark: DataFrame, id_col: str, text: str, block_bytes: int, least: int) -> Iterator[Items]:
    """The benchmark in blocks of about ``block_bytes`` at most; equal ids and texts count once, NULL texts not at all."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-2 * total // block_bytes)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    for k in range(n):
        found = rows.where(part == k).collect() if n > 1 else rows.collect()
        if found:
            yield Items([r.item_id for r in found], texts_of(pa.array([r.text for r in found], pa.large_string())), least)


def find_items(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
    item_text: str = "text", share: float = SHARE, least: int = LEAST, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item in it: doc_id, item_id, tiled_words, item_words, longest_tile, coverage.

    NULL and empty texts hold nothing; an item without a word is in no document, and one of one or two
    words only in a document that is nothing else. Items with the same words are all found. Rows with equal ids are taken
    one by one, and very long texts are read whole. No documents or no items give no rows. Only ids and texts are read.
    """
    types = dict(docs.dtypes)[doc_id], dict(benchmark.dtypes)[item_id]
    schema = f"doc_id {types[0]}, item_id {types[1]}, tiled_words int, item_words int, longest_tile int, coverage double"
    id_type = to_arrow_type(benchmark.schema[item_id].dataType)
    narrow, out = docs.select(doc_id, doc_text), None
    for block in blocks(benchmark, item_id, item_text, block_bytes, least):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        @tidied
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in (piece for whole in batches for piece in parts_of(whole, 1)):
                found = list(items.contained(texts_of(batch.column(1)), share))
                if found:
                    text, k, covered, words, longest = (list(c) for c in zip(*found))
                    numbers = [pa.array(c, pa.int32()) for c in (covered, words, longest)]
                    ids = pa.array([items.ids[i] for i in k], id_type)
                    share_of = pa.array(np.array(covered) / np.array(words))
                    names = "doc_id item_id tiled_words item_words longest_tile coverage".split()
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text)), ids, *numbers, share_of], names=names)

        part = narrow.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
    share: float = SHARE, least: int = LEAST, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns; rules as in ``find_items``."""
    place = docs.columns.index(doc_text)
    for block in blocks(benchmark, item_id, item_text, block_bytes, least):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        @tidied
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in (piece for whole in batches for piece in parts_of(whole, place)):
                clean = np.ones(batch.num_rows, bool)
                for text, *_ in shared.value.contained(texts_of(batch.column(place)), share):
                    clean[text] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op6_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_benchmark_tiling": op6_benchmark_tiling}
ORACLE_SQL: dict[str, str] = {}
