"""Quality classifier by positive-unlabelled learning.

A linear score over plain measures of a text is fitted to trusted positives and to all texts as
unlabelled ones. With the class prior p and the logistic loss l, the risk is

    p * mean over positives of l(+g)  +  max(0, mean over unlabelled of l(-g) - p * mean over positives of l(-g))

The second term estimates the risk on negatives, of which none is trusted; it is kept from going
below zero, where a fit would only learn to tell the sample's positives from the rest. Damped
Newton steps minimise the risk: sums over all rows, made by Spark, give each step, and the
non-negative risk chooses its length. The class prior is the share of positives among the
labelled rows that may be learnt from, with one row of either class added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold, read_table, split_words, texts_of, tidied, word_codes
from tidemark.llm.token_ids import parts_of
from tidemark.session import settle

MEASURES = (
    "log_chars", "mean_word", "upper", "digit", "mark", "other_mark", "exclaim", "pipe", "white",
    "distinct_words", "repeated_word", "distinct_pairs", "top_word", "loud_words", "marked_ends",
    "distinct_lines", "line_length", "mid_marks",
)
#: Standardised measures are cut at so many standard deviations.
REACH = 6.0
#: Bytes of text that are measured at a time; a measure takes some fifty times as much for a moment.
PIECE_BYTES = 4 << 20
STEPS = (1.0, 0.5, 0.25, 0.1, 0.03)


def _sums(mask: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` in each text."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return (total[starts[1:]] - total[starts[:-1]]).astype(np.float64)


def measures(texts: pa.Array) -> np.ndarray:
    """One row of ``MEASURES`` for each text; zeros for an empty one. Reads whole texts."""
    n = len(texts)
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + n + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if raw.buffers()[2] else np.zeros(0, np.uint8)
    at = offsets - offsets[0]
    starts_char = (data & 0xC0) != 0x80
    chars = _sums(starts_char, at)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    upper = ((data >= 65) & (data <= 90)) | ((data == 0xC3) & np.append((data[1:] >= 0x80) & (data[1:] <= 0x9E), False)[: len(data)])
    digit = (data >= 48) & (data <= 57)
    plain = np.isin(data, np.frombuffer(b".,", np.uint8))
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)
    other = ~(white | digit | plain | letter)
    nonblank = np.maximum(chars - _sums(white, at), 1)
    share = lambda mask: _sums(mask, at) / nonblank

    words, first = split_words(texts)
    codes, distinct = word_codes(words)
    count = np.diff(first).astype(np.float64)
    some = np.maximum(count, 1)
    owner = np.repeat(np.arange(n), np.diff(first))
    same_text = owner[1:] == owner[:-1]
    kinds = len(distinct) + 1

    def distinct_share(keys: np.ndarray, owners: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct keys of each text, count of its most frequent key) as shares of ``total``."""
        if not len(keys):
            return np.zeros(n), np.zeros(n)
        order = np.lexsort((keys, owners))
        k, o = keys[order], owners[order]
        new = np.concatenate(([True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])))
        begins = np.flatnonzero(new)
        runs = np.diff(np.append(begins, len(k)))
        most = np.zeros(n)
        np.maximum.at(most, o[begins], runs)
        return np.bincount(o[begins], minlength=n) / total, most / total

    few_words, top = distinct_share(codes, owner, some)
    pairs = codes[:-1] * kinds + codes[1:]
    few_pairs, _ = distinct_share(pairs[same_text], owner[1:][same_text], np.maximum(count - 1, 1))
    repeated = np.bincount(owner[1:][same_text & (codes[1:] == codes[:-1])], minlength=n) / some
    of_word = lambda pattern: pc.match_substring_regex(distinct, pattern).to_numpy(zero_copy_only=False)[codes]
    per_word = lambda mask: np.bincount(owner[mask], minlength=n) / some
    if len(distinct):
        loud, ends, mid = of_word(r"^\P{L}*\p{Lu}[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"), of_word(r"[^\p{L}\p{N}.,;:?'\")]$"), of_word(r"\p{L}[^\p{L}\p{N}'’-]+\p{L}")
    else:
        loud = ends = mid = np.zeros(0, bool)

    lines = pc.split_pattern(texts, "\n")
    line_first = lines.offsets.to_numpy().astype(np.int64)
    line_values = lines.values.slice(line_first[0], line_first[-1] - line_first[0])
    line_codes, _ = word_codes(line_values)
    line_owner = np.repeat(np.arange(n), np.diff(line_first))
    line_count = np.maximum(np.diff(line_first), 1).astype(np.float64)
    few_lines, _ = distinct_share(line_codes, line_owner, line_count)

    root = np.log1p(some)  # long texts repeat words anyway: measured against the logarithm of the length
    columns = [
        np.log1p(chars), np.minimum(nonblank / some, 60), share(upper), share(digit), share(plain), share(other),
        share(data == 33), share(data == 124), _sums(white, at) / np.maximum(chars, 1),
        few_words * root, repeated, few_pairs * root, top, per_word(loud), per_word(ends), few_lines,
        np.log1p(chars / line_count), per_word(mid),
    ]
    table = np.stack(columns, axis=1)
    table[chars == 0] = 0.0
    return table


def features(df: DataFrame, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``keep`` columns, and ``x``: the measures of each text. NULL counts as empty."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = len(keep) + 1
        for batch in (piece for whole in batches for piece in parts_of(whole, place, PIECE_BYTES)):
            table = measures(texts_of(batch.column(place)))
            flat = pa.array(table.astype(np.float32).ravel())
            x = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(MEASURES)), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], x], names=[*batch.schema.names[:place], "x"])

    types = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in (id_col, *keep)] + ["x array<float>"])
    return df.select(id_col, *keep, text).mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy()[column.offsets[0].as_py() : column.offsets[-1].as_py()].reshape(len(column), -1).astype(np.float64)


def summed(rows: DataFrame, work, size: int) -> np.ndarray:
    """The sum over all rows of ``work(x, trusted)``, an array of ``size`` numbers for each batch.

    Spark adds the tasks' arrays entry by entry; the driver gets ``size`` numbers.
    """

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += work(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], names=["k", "v"])

    entries = rows.select("x", "trusted").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for k, v in entries:
        out[k] = v
    return out


class Model:
    """A linear score of standardised measures; plain arrays, small enough to travel with a task."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.clip((x - self.mean) / self.scale, -REACH, REACH), np.ones((len(x), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -60, 60)))


def _losses(z: np.ndarray, trusted: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of l(+g) and l(-g) over positives and of l(-g) over all rows, for each column of ``weights``."""
    g = z @ weights
    plus, minus = np.logaddexp(0, -g), np.logaddexp(0, g)
    return np.concatenate([plus[trusted].sum(axis=0), minus[trusted].sum(axis=0), minus.sum(axis=0)])


def fit(rows: DataFrame, prior: float, rounds: int = 12, ridge: float = 1e-2) -> Model:
    """A model fitted to all ``rows`` (x, trusted); every row counts as unlabelled too."""
    d = len(MEASURES)
    moments = summed(rows, lambda x, t: np.concatenate([[len(x), t.sum()], x.sum(axis=0), (x * x).sum(axis=0)]), 2 + 2 * d)
    n, positives = moments[0], moments[1]
    mean = moments[2 : 2 + d] / max(n, 1)
    scale = np.sqrt(np.maximum(moments[2 + d :] / max(n, 1) - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-6, scale, 1.0), np.zeros(d + 1), prior)
    model.weights[-1] = np.log(prior / (1 - prior))
    if not positives:  # nothing to learn from: every text gets the prior
        return model

    def risk(plus: float, minus: float, all_minus: float, weights: np.ndarray) -> float:
        negative = all_minus / n - prior * minus / positives
        return prior * plus / positives + max(0.0, negative) + ridge * float(weights[:-1] @ weights[:-1])

    def slopes(x: np.ndarray, trusted: np.ndarray) -> np.ndarray:
        z = model.design(x)
        p = 1 / (1 + np.exp(-np.clip(z @ model.weights, -60, 60)))
        bend = lambda rows: (z[rows] * (p * (1 - p))[rows, None]).T @ z[rows]
        first = [z[trusted].sum(axis=0), (z * p[:, None]).sum(axis=0), (z * p[:, None])[trusted].sum(axis=0)]
        return np.concatenate([*first, bend(slice(None)).ravel(), bend(trusted).ravel(), _losses(z, trusted, model.weights[:, None])])

    w = d + 1
    for _ in range(rounds):
        out = summed(rows, slopes, 3 * w + 2 * w * w + 3)
        of_positives, of_all, of_scored = out[:w] / positives, out[w : 2 * w] / n, out[2 * w : 3 * w] / positives
        curve, curve_positives = out[3 * w : 3 * w + w * w].reshape(w, w) / n, out[3 * w + w * w : -3].reshape(w, w) / positives
        if out[-1] / n - prior * out[-2] / positives < 0:
            # The negative part is cut off at 0: only the loss of the positives, l(+g), is left to descend.
            slope, curve = prior * (of_scored - of_positives), prior * curve_positives
        else:
            # l(+g) - l(-g) = -g, so the positives enter the slope by their mean alone.
            slope = of_all - prior * of_positives
        here = risk(*out[-3:], model.weights)
        weight_loss = np.append(np.full(d, 2 * ridge), 1e-8)
        step = np.linalg.solve(curve + np.diag(weight_loss + 1e-6), slope + weight_loss * model.weights)
        tried = np.stack([model.weights - t * step for t in STEPS], axis=1)
        sums = summed(rows, lambda x, t, w=tried: _losses(model.design(x), t, w), 3 * len(STEPS)).reshape(3, -1)
        risks = [risk(*sums[:, k], tried[:, k]) for k in range(len(STEPS))]
        best = int(np.argmin(risks))
        if risks[best] >= here - 1e-7:
            break
        model.weights = tried[:, best]
    return model


def trusted_labels(labels: DataFrame, parts: int = 3, held_out: int = 1, id_col: str = "doc_id") -> DataFrame:
    """One row per labelled document that may be learnt from: doc_id, good (all its labels are 1)."""
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & (fold(id_col, parts) != held_out))
    return known.groupBy(F.col(id_col).alias("doc_id")).agg((F.min("quality") == 1).alias("good"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame]:
    """(model, settled table of doc_id, x, trusted). ``labels`` may name documents that are not there."""
    learn = trusted_labels(labels)
    counts = learn.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good")).first()
    prior = (counts["good"] + 1) / (counts["n"] + 2)
    table = settle(features(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))), "op8-measures")
    rows = table.join(learn.where("good").select("doc_id", F.lit(True).alias("trusted")), "doc_id", "left")
    rows = settle(rows.select("doc_id", "x", F.coalesce("trusted", F.lit(False)).alias("trusted")), "op8-rows")
    return fit(rows, prior), rows


def scores(rows: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), drop_x: bool = True) -> DataFrame:
    """The ``keep`` columns of ``rows`` and the score of each."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = pa.array(model.score(_matrix(batch.column(len(keep)))))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], score], names=[*keep, "score"])

    types = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["score double"])
    return rows.select(*keep, "x").mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from labels of the folds other than 1 only. NULL and empty texts are scored by their
    (zero) measures; documents with the same id get a row each; without a trusted positive, every
    score is the prior. No documents give no rows. Nothing but the text enters a score.
    """
    model, rows = train(docs, labels, id_col, text)
    return scores(rows, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns; nothing is shuffled.

    NULL and empty texts are judged by their (zero) measures; repeated rows are judged alike, and very long texts whole. Without a
    trusted positive every score is the prior. No documents give no rows.
    """
    model, _ = train(docs, labels, id_col, text)
    names = docs.columns

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = names.index(text)
        for batch in (piece for whole in batches for piece in parts_of(whole, place, PIECE_BYTES)):
            good = model.score(measures(texts_of(batch.column(place)))) >= 0.5
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def op8_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {"op8_quality_pu": op8_quality_pu}
ORACLE_SQL: dict[str, str] = {}
