"""Importance resampling of documents towards a target: hashed n-gram features and a keyed draw.

A feature is a run of ``low`` to ``high`` words; its bucket is the crc32 of its bytes modulo the
number of buckets. Two passes over the texts: the first counts buckets, the second adds up each
document's gains. In both, a batch's n-grams go into an open-addressed table (``interning``) that
keeps a bucket and a count for each slot; a document's gains are gathered by the slots of its
occurrences. Counts are added within each task; what leaves it is one row for each bucket.

The draw is Gumbel's: a weight plus a noise that depends on the seed and the document's id alone,
so any partitioning draws the same documents.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import read_table, tidied
from tidemark.llm.interning import CHUNK, Table, Words, byte_class
from tidemark.llm.token_ids import parts_of
from tidemark.session import settle

LOW, HIGH = 1, 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
SHARE = 10
#: Bytes of text whose n-grams are worked on at a time.
PIECE_BYTES = 4 << 20
#: Words are runs of digits, small letters and all bytes beyond ASCII.
WORD_BYTES = byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))


class Features:
    """The n-grams of a batch: (document, bucket) of every occurrence, in pieces of ``CHUNK`` occurrences."""

    def __init__(self, texts: pa.Array, low: int, high: int, buckets: int):
        self.words, self.low, self.high, self.buckets = Words(texts, WORD_BYTES), low, high, buckets

    def tables(self) -> Iterator[tuple[np.ndarray, Table, np.ndarray]]:
        """(document of each occurrence, the table of the occurrences, the bucket of each slot)."""
        words = self.words
        for size in range(self.low, self.high + 1):
            runs = words.runs(size)
            for at in range(0, len(runs), CHUNK):
                first = runs[at : at + CHUNK]
                starts, lengths = words.starts[first], words.run_lengths(first, size)
                table = Table(words.data, starts, lengths)
                data, buckets = words.data, self.buckets
                ends = (starts + lengths)[table.first].tolist()
                slots = [zlib.crc32(data[s:e]) % buckets for s, e in zip(starts[table.first].tolist(), ends)]
                yield words.owner[first], table, np.array(slots, np.int64)


def bucket_counts(df: DataFrame, text: str = "text", low: int = LOW, high: int = HIGH, buckets: int = BUCKETS) -> np.ndarray:
    """How often the n-grams of all texts fall into each bucket; tasks send one row for each bucket they saw."""

    @tidied
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in (piece for batch in batches for piece in parts_of(batch, 0, PIECE_BYTES)):
            for _, table, bucket in Features(piece.column(0), low, high, buckets).tables():
                np.add.at(total, bucket, table.count)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    counts = df.select(text).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():  # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio of the smoothed shares) of each bucket."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in pairs], np.int64)


def noise(seed: int, doc_id: object) -> int:
    """floor(1000 * Gumbel noise) of an id; a NULL id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def weigh(
    df: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text: str = "text", low: int = LOW, high: int = HIGH, seed: int = SEED
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document; ``gains`` (one number a bucket) is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(gains)
    narrow = df.select(F.col(text).alias("text"), F.col(id_col).alias("doc_id"))
    id_type = to_arrow_type(narrow.schema["doc_id"].dataType)

    @tidied
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for piece in (piece for batch in batches for piece in parts_of(batch, 0, PIECE_BYTES)):
            n = piece.num_rows
            features = Features(piece.column(0), low, high, len(gain))
            total, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for owner, table, bucket in features.tables():
                heads = np.flatnonzero(np.diff(owner, prepend=-1))
                total[owner[heads]] += np.add.reduceat(gain[bucket][table.slot], heads)
                count += np.bincount(owner, minlength=n)
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            ids = piece.column(1)
            score = weight + np.array([noise(seed, i) for i in ids.to_pylist()], np.int64)
            words = np.bincount(features.words.owner, minlength=n).astype(np.int64)
            arrays = [ids.cast(id_type), *(pa.array(x) for x in (words, count, weight, score))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight", "score"])

    kind = dict(narrow.dtypes)["doc_id"]
    return narrow.mapInArrow(weighed, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def drawn(weighed: DataFrame, least_words: int = LEAST_WORDS, share: int = SHARE) -> DataFrame:
    """``weighed`` with ``rank``: 1, 2, 3... for the best ``share`` % of the documents long enough, NULL for the others.

    Scores are whole numbers within some 60,000 of each other (gains are bounded by the logarithm of
    a count, the noise by its 32 bits), so the table of their counts is small at any size: the driver finds
    from it the score at which the draw ends and the rank at which each score begins. Only documents
    of one score are ranked together. Among equal scores the smaller id comes first, a NULL id last.
    """
    long_enough = F.col("n_words") >= least_words
    counts = weighed.where(long_enough).groupBy("score").count().collect()
    spark, wanted = weighed.sparkSession, sum(row["count"] for row in counts) * share // 100
    before, begins = 0, []
    for score, n in sorted(((row["score"], row["count"]) for row in counts), reverse=True):
        if before >= wanted:
            break
        begins.append((score, before))
        before += n
    lowest = begins[-1][0] if begins else None
    inside = long_enough & (F.col("score") >= F.lit(lowest)) if begins else F.lit(False)
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    table = spark.createDataFrame(begins, "of long, before long")
    ranked = weighed.where(inside).withColumn("place", F.row_number().over(order)).join(F.broadcast(table), F.col("score") == F.col("of"))
    rank = F.col("before") + F.col("place")
    best = ranked.select(*weighed.columns, F.when(rank <= wanted, rank).cast("long").alias("rank"))
    return best.unionByName(weighed.where(~inside).withColumn("rank", F.lit(None).cast("long")))


def resample(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text", low: int = LOW, high: int = HIGH,
    buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, share: int = SHARE,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (NULL if not drawn).

    NULL and empty texts have no feature, weight 0 and are not drawn; a NULL id counts as an empty one in
    the noise. Rows with the same id get the same noise and are drawn each by its own weight. Very long
    texts are read whole; their n-grams go through the table in chunks. An empty target gives
    gains that favour rare buckets; empty input gives an empty result. Other columns are not read.
    """
    source = bucket_counts(df, text, low, high, buckets)
    gains = bucket_gains(source, bucket_counts(target, target_text, low, high, buckets))
    return drawn(settle(weigh(df, gains, id_col, text, low, high, seed), "weighed"), least_words, share)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op13_importance_resampling": op13_importance_resampling}

ORACLE_SQL = {
    "op13_importance_resampling": r"""
    WITH words AS (
      SELECT doc_id, NULL AS item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
      FROM documents
      UNION ALL
      SELECT NULL, item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
      FROM benchmark),
    crc_table AS (
      SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS crcs
      FROM range(256) AS r(i)),
    buckets AS (
      SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
      FROM (SELECT DISTINCT w FROM words), crc_table),
    counts AS (
      SELECT bucket, count(*) FILTER (item_id IS NULL) AS s, count(*) FILTER (item_id IS NOT NULL) AS t
      FROM words JOIN buckets USING (w) GROUP BY bucket),
    gains AS (
      SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)
        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000))))::BIGINT AS gain
      FROM counts),
    weights AS (
      SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
      FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE item_id IS NULL GROUP BY doc_id),
    scored AS (
      SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
          (('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM documents AS d LEFT JOIN weights AS x ON x.doc_id = d.doc_id),
    ranked AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n_all FROM scored WHERE n_features >= 20)
    SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= n_all * 10 // 100 THEN place END AS rank
    FROM scored AS s LEFT JOIN ranked AS r ON r.doc_id = s.doc_id"""
}
