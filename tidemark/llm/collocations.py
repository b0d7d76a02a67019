"""Phrase collocations of each language by SON partitioning: exact counts of all frequent phrases.

Documents are dealt into ``SHARDS`` shards by a hash of their id. A phrase that occurs ``support`` times in
a language occurs at least support * n_i / N times in one shard (n_i, N: words of the language in the
shard and in all), so mining every shard completely at that lowered support finds all of them.

* Words are counted first; a phrase needs words that are frequent themselves.
* Each shard is mined level by level, pairs before runs of three and four words. A shard is no task:
  the phrases of one shard are spread over many tasks by their hash, so shards may be of any size while
  their number, and with it the local support, stays the same. Keys are counted within each batch before
  they are sent, in blobs, and a hot phrase sends a row per batch.
* The phrases frequent in some shard are united, and one more pass counts them over all documents. In it
  the phrases are interned by their bytes (``interning``) and grouped by their text, so clashes of hashes
  can only add candidates, never change a count.

Filters of what may be a candidate are bounded (``components.Bloom``); beyond their size more phrases are
counted in vain, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, read_table, tidied
from tidemark.llm.components import Bloom, bloom_of
from tidemark.llm.interning import CHUNK, Table, Words, byte_class, hash_slices, slices
from tidemark.llm.token_ids import parts_of
from tidemark.session import settle

SUPPORT, SHARE, SHARE_OF = 30, 80, 100
LONGEST, FIRST = 4, 2000
SCALE = 2_000_000
SHARDS = 4
UNKNOWN = "und"
#: Bytes of text whose phrases are worked on at a time.
PIECE_BYTES = 4 << 20
#: Keys that one task sorts, and bytes of text that make one; they set the number of groups.
TASK_KEYS, KEY_BYTES = 1 << 20, 10
#: Groups in which the best phrases of a language are chosen before they meet.
SALTS = 32
CUTS = b".,;:!?\x0a\x0b\x0c\x0d"
CUT_BYTES = byte_class(CUTS)
WORD_BYTES = ~byte_class(CUTS + b"\x20\x09")
STEP = np.uint64(0x9E3779B97F4A7C15)


class Phrases:
    """Words of texts of one language, with a key for each run of them."""

    def __init__(self, texts: pa.Array, lang: str, longest: int):
        self.words, self.longest = Words(texts, WORD_BYTES, CUT_BYTES), longest
        self.salt = mix64(np.array([xxhash.xxh64_intdigest(lang.encode())], np.uint64))
        self.hashes = hash_slices(self.words.data, self.words.starts, self.words.lengths)

    def keys(self, first: np.ndarray, size: int) -> np.ndarray:
        """A 64-bit name of each of these runs of ``size`` words, different for each language."""
        total = np.full(len(first), size, np.uint64)
        for k in range(size):
            total = total * STEP + self.hashes[first + k]
        return mix64(total ^ self.salt)

    def passing(self, filters: Sequence[Bloom | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, first words, keys) of the runs all of whose parts pass: ``filters[n - 1]`` is for runs of n words.

        A filter that is missing lets all pass; no longer runs than there are filters.
        """
        before: np.ndarray | None = None
        for size, known in enumerate(filters, 1):
            first = self.words.runs(size)
            if before is not None:  # both runs that are a word shorter
                first = first[before[first] & before[first + 1]]
            keys = self.keys(first, size)
            if known is not None:
                kept = known.test(keys.view(np.int64))
                first, keys = first[kept], keys[kept]
            yield size, first, keys
            before = np.zeros(len(self.words.starts) + 1, bool)
            before[first] = True


def _by_language(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[str, np.ndarray, Phrases]]:
    """(language, shard of each text, phrases) of batches (text, lang, shard), in pieces."""
    for piece in (piece for batch in batches for piece in parts_of(batch, 0, PIECE_BYTES)):
        for lang in pc.unique(piece.column(1)).to_pylist():
            own = piece.filter(pc.equal(piece.column(1), lang))
            yield lang, own.column(2).to_numpy().astype(np.int64), Phrases(own.column(0), lang, longest)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    begins = np.flatnonzero(new)
    return keys[begins], np.diff(np.append(begins, len(keys)))


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """``values[cuts[k] : cuts[k + 1]]`` as binary values."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


_SENT = ["shard", "part", "need", "keys", "counts"]
_SENT_SQL = "shard int, part long, need long, keys binary, counts binary"


def _sent(shard: int, need: int, keys: np.ndarray, parts: int) -> pa.RecordBatch:
    """A batch's keys of one shard, one row for each group of keys."""
    keys, counts = _counted(keys)
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)  # in the order of the keys
    begins = np.flatnonzero(np.diff(part, prepend=-1))
    cuts = np.append(begins, len(keys))
    n = len(begins)
    arrays = [
        pa.array(np.full(n, shard, np.int32)), pa.array(part[begins]), pa.array(np.full(n, need, np.int64)),
        _blobs(keys, cuts), _blobs(counts.astype(np.uint32), cuts),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=_SENT)


def _frequent(sent: DataFrame) -> DataFrame:
    """Keys that occur as often as they need within their shard."""

    def summed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, needs = [], [], []
        for batch in batches:
            for need, blob, count in zip(batch.column("need").to_pylist(), batch.column("keys"), batch.column("counts")):
                keys.append(np.frombuffer(blob.as_buffer(), np.uint64))
                counts.append(np.frombuffer(count.as_buffer(), np.uint32).astype(np.int64))
                needs.append(np.full(len(keys[-1]), need, np.int64))
        own, count, need = np.concatenate(keys), np.concatenate(counts), np.concatenate(needs)
        order = np.argsort(own, kind="stable")
        own, count, need = own[order], count[order], need[order]
        begins = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        kept = np.add.reduceat(count, begins) >= need[begins]
        yield pa.RecordBatch.from_arrays([pa.array(own[begins[kept]].view(np.int64))], names=["key"])

    return sent.groupBy("shard", "part").applyInArrow(summed, "key long")


def frequent_phrases(
    df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS
) -> tuple[DataFrame, dict[str, int]]:
    """(lang, size, phrase, a) of all phrases of up to ``longest`` words with at least ``support`` occurrences, and each language's words.

    Languages, not documents, are gathered: their number is taken as bounded.
    """
    spark = df.sparkSession
    rows = df.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(shards)).cast("int").alias("shard"),
    )
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, text_bytes // (KEY_BYTES * TASK_KEYS * shards))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, shard, made in _by_language(batches, 1):
            if len(made.words.owner):
                keys = made.keys(np.arange(len(made.words.owner)), 1)
                told = _sent(0, support, keys, parts * shards)
                n = np.bincount(shard[made.words.owner], minlength=shards)
                counts = pa.RecordBatch.from_arrays([pa.array([name] * shards), pa.array(np.arange(shards, dtype=np.int32)), pa.array(n.astype(np.int64))], names=["lang", "of", "n"])
                yield _both(told, counts)

    told = settle(rows.mapInArrow(tidied(words), f"{_SENT_SQL}, lang string, of int, n long"), "words")
    per_shard = told.where("lang is not null").groupBy("lang", "of").agg(F.sum("n").alias("n")).collect()
    totals: dict[str, int] = {}
    for row in per_shard:
        totals[row.lang] = totals.get(row.lang, 0) + row.n
    need = {(row.lang, row.of): max(1, -(-support * row.n // totals[row.lang])) for row in per_shard}
    frequent_words = settle(_frequent(told.where("keys is not null").select(*_SENT)), "frequent")
    filters = [spark.sparkContext.broadcast(bloom_of(frequent_words, "key"))]

    def mined(sizes: range) -> DataFrame:
        """Keys of the phrases of these sizes that are frequent in some shard."""
        known = list(filters)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = [b.value for b in known] + [None] * len(sizes)
            for name, shard, made in _by_language(batches, sizes[-1]):
                for size, first, keys in made.passing(tests):
                    if size in sizes and len(first):
                        at = shard[made.words.owner[first]]
                        for s in np.unique(at).tolist():
                            yield _sent(s, need[name, s], keys[at == s], parts)

        return settle(_frequent(rows.mapInArrow(tidied(run), _SENT_SQL)).distinct(), "frequent")

    if longest > 1:
        filters.append(spark.sparkContext.broadcast(bloom_of(mined(range(2, 3)), "key")))
    if longest > 2:
        filters += [spark.sparkContext.broadcast(bloom_of(mined(range(3, longest + 1)), "key"))] * (longest - 2)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = [b.value for b in filters]
        for name, _, made in _by_language(batches, longest):
            for size, runs, _ in made.passing(tests):
                for at in range(0, len(runs), CHUNK):
                    first = runs[at : at + CHUNK]
                    starts, lengths = made.words.starts[first], made.words.run_lengths(first, size)
                    table = Table(made.words.data, starts, lengths)
                    phrases = slices(made.words.data, starts[table.first], lengths[table.first]).cast(pa.large_string())
                    n = len(phrases)
                    arrays = [pa.array([name] * n), pa.array(np.full(n, size, np.int32)), phrases.cast(pa.string()), pa.array(table.count)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["lang", "size", "phrase", "a"])

    found = rows.mapInArrow(tidied(counted), "lang string, size int, phrase string, a long")
    return settle(found.groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= support), "phrases"), totals


def _both(told: pa.RecordBatch, counts: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of both kinds, each with NULL for the columns of the other."""
    return pa.concat_tables([pa.table(told), pa.table(counts)], promote_options="default").select([*_SENT, "lang", "of", "n"]).combine_chunks().to_batches()[0]


def _words(first: int | str, count: str) -> F.Column:
    """``count`` words of ``words`` from the one at ``first``, one blank apart."""
    return F.expr(f"array_join(slice(words, {first}, {count}), ' ')")


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", support: int = SUPPORT, longest: int = LONGEST,
    share: int = SHARE, share_of: int = SHARE_OF, first: int = FIRST, shards: int = SHARDS,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a``: occurrences of the phrase; ``l``, ``r``: of its two parts at the cut that scores lowest (of equal
    scores the earliest); ``n``: words of the language; score = floor(2,000,000 a / (l + r)). Phrases inside a
    longer one that occurs ``share`` / ``share_of`` as often are left out. Products are decimals and the
    division is one of whole numbers, so nothing is rounded.

    NULL and empty texts have no words. A NULL language is ``und``. Rows with the same id or text all count.
    Very long texts are read whole. A table without frequent phrases, and an empty one, give an empty
    result; other columns are not read.
    """
    spark = df.sparkSession
    counts, totals = frequent_phrases(df, text, lang, id_col, support, longest, shards)
    candidates = counts.where("size > 1").withColumn("words", F.split("phrase", " "))
    of = lambda name, value: counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(value))
    cuts = (
        candidates.select("lang", "size", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        .select("lang", "phrase", "a", "k", _words(1, "k").alias("head"), _words("k + 1", "size - k").alias("tail"))
        .join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
        .withColumn("score", F.expr(f"cast(a as decimal(20,0)) * {SCALE} div (cast(l as decimal(20,0)) + r)"))
    )
    lowest = F.min(F.struct("score", "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest.alias("cut")).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    inner = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), s -> array_join(slice(words, s, m), ' '))))")
    inside = (
        candidates.where("size > 2").select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    covered = F.expr(f"cast(longer as decimal(20,0)) * {share_of} >= cast(a as decimal(20,0)) * {share}")
    left = scored.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered)
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(*best)
        salted = salted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    n_words = spark.createDataFrame(list(totals.items()), "lang string, n long")
    return salted.join(F.broadcast(n_words), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {"op12_son_collocations": op12_son_collocations}

ORACLE_SQL = {
    "op12_son_collocations": r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
    counts AS MATERIALIZED (
      SELECT lang, size, phrase, count(*) AS a FROM (
        SELECT lang, size, array_to_string(ws[i : i + size - 1], ' ') AS phrase
        FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM words, range(1, 5) AS s(size)))
      GROUP BY ALL),
    totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
    frequent AS MATERIALIZED (SELECT lang, size, phrase, a FROM counts WHERE a >= 30),
    candidates AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS ws FROM frequent WHERE size > 1),
    parts AS MATERIALIZED (
      SELECT lang, phrase, a, k, array_to_string(ws[1 : k], ' ') AS head, array_to_string(ws[k + 1 : size], ' ') AS tail
      FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
    cuts AS (
      SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
      FROM parts AS c JOIN frequent AS x ON x.lang = c.lang AND x.phrase = c.head JOIN frequent AS y ON y.lang = c.lang AND y.phrase = c.tail),
    scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_phrases AS (
      SELECT lang, a, array_to_string(ws[s : s + m - 1], ' ') AS phrase
      FROM (SELECT *, unnest(range(1, size - m + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates WHERE size > 2))),
    longer AS (SELECT lang, phrase, max(a) AS most FROM inner_phrases GROUP BY lang, phrase),
    ranked AS (
      SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, l, r, n, score
      FROM scored AS s JOIN totals AS t ON t.lang = s.lang
      LEFT JOIN longer AS o ON o.lang = s.lang AND o.phrase = s.phrase
      WHERE most IS NULL OR 100 * most < 80 * s.a)
    SELECT * FROM ranked WHERE rank <= 2000"""
}
