"""Log-bilinear language model trained by noise-contrastive estimation; scores whole texts.

Words fall into classes: each of the most frequent training words is a class of its own, the end
of a text is one, and all other words share classes by their endings. A token's probability is

    P(class | the classes of the words before it) * P(word | class)

The first factor is the log-bilinear model. Each class has a vector for each place of the
context; their sum, the predicted vector, is multiplied with the classes' target vectors, and the
softmax over all classes normalises it: one matrix product for a block of tokens. The second
factor is (c + 1) / (N + V + 1) within the class, from counts over all training texts, and leaves one
share for words never seen. So the probabilities of all texts of a length add up to one.

Training is distributed: in each round every task trains a copy of the model on the training
texts of one slice in its partition, with noise classes shared by a block of tokens, and the copies
are averaged with their numbers of tokens as weights. Every training text is in one slice. The
model is a few thousand numbers, whatever the size of the corpus; the counts grow with it.

Counts of the most frequent words (at most ``KNOWN`` of them) are broadcast. Rarer words are counted
by a join on the word, one row for each distinct rare word of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold, read_table, split_words, texts_of, tidied, word_codes, word_hashes
from tidemark.llm.token_ids import parts_of
from tidemark.session import settle

HELD_OUT, FOLDS = 2, 7
#: Classes that are one word each, and classes of all other words by their endings.
FREQUENT, ENDINGS = 192, 62
CLASSES = FREQUENT + ENDINGS + 1
END = FREQUENT + ENDINGS
START = CLASSES  # what stands before a text
ORDER, WIDTH, NOISE, BLOCK, ROUNDS, STEP, CALM = 3, 24, 64, 1024, 4, 0.1, 1e-6
#: Words whose counts are broadcast, and the longest of them: at most 2^18 * (64 + 8) bytes or 19 MB.
KNOWN, KNOWN_BYTES = 1 << 18, 64
#: Tokens or contexts scored by one matrix product.
SCORED = 1 << 11


def ending_class(words: pa.Array) -> np.ndarray:
    """The class of each word by its ending: a hash of the last two letters or digits, or of its marks."""
    bare = pc.replace_substring_regex(words, r"[^\p{L}\p{N}]+$", "")
    tail = pc.utf8_slice_codeunits(bare, start=-2)
    codes, distinct = word_codes(tail)
    return (FREQUENT + (word_hashes(distinct) % np.uint64(ENDINGS)).astype(np.int64))[codes]


def counted(docs: DataFrame, text: str) -> DataFrame:
    """(word, c) over all texts; each batch is counted before the shuffle."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in parts_of(whole, 0)):
            words, _ = split_words(pc.ascii_lower(texts_of(batch.column(0))))
            codes, distinct = word_codes(words)
            if len(distinct):
                c = np.bincount(codes, minlength=len(distinct))
                yield pa.RecordBatch.from_arrays([distinct.cast(pa.string()), pa.array(c)], names=["word", "c"])

    return docs.select(text).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Counts of the frequent words, classes, and totals of the classes; of bounded size."""

    def __init__(self, words: list[str], counts: np.ndarray, frequent: int, tokens: int, types: int, ends: int):
        self.words, self.counts = pa.array(words, pa.large_string()), counts
        self.frequent = frequent  # the first so many words are classes of their own
        self.tokens, self.types, self.ends = tokens, types, ends
        self.log_total = float(np.log10(tokens + types + 1))
        self.log_end = float(np.log10(ends + 1)) - self.log_total
        self.class_tokens, self.class_types = np.zeros(CLASSES), np.zeros(CLASSES)

    def look_up(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(count of each word, -1 where it is not among the broadcast ones; its class)."""
        place = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        found = place >= 0
        counts = np.full(len(distinct), -1, np.int64)
        counts[found] = self.counts[place[found]]
        classes = ending_class(distinct) if len(distinct) else np.zeros(0, np.int64)
        own = found & (place < self.frequent)
        classes[own] = place[own]
        return counts, classes


def build_vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """The words above the least count that leaves at most ``KNOWN`` of them, and the totals of all classes."""
    short = F.octet_length("word") <= KNOWN_BYTES
    # Counts by size: all small ones apart, large ones by their eight leading bits.
    unit = F.pow(F.lit(2.0), F.floor(F.log2("c")) - 8).cast("long")
    size = F.when(F.col("c") < 4096, F.col("c")).otherwise(F.col("c") - F.col("c") % unit)
    sizes = counts.groupBy(size.alias("size")).agg(F.count(F.when(short, 1)).alias("n"), F.count(F.lit(1)).alias("types"), F.sum("c").alias("tokens")).collect()
    least, held = None, 0
    for row in sorted(sizes, key=lambda r: -r["size"]):
        if held + row["n"] > KNOWN:
            break
        least, held = row["size"], held + row["n"]
    rows = counts.where(short & (F.col("c") >= least)).collect() if least is not None else []
    rows.sort(key=lambda r: (-r["c"], r["word"]))
    words, c = [r["word"] for r in rows], np.array([r["c"] for r in rows], np.int64)
    tokens, types = sum(r["tokens"] for r in sizes) + ends, sum(r["types"] for r in sizes) + (ends > 0)
    vocabulary = Vocabulary(words, c, min(FREQUENT, len(words)), tokens, types, ends)
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)

    @tidied
    def of_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES, 2))
        for batch in batches:
            if batch.num_rows:
                _, classes = shared.value.look_up(batch.column(0).cast(pa.large_string()))
                total[:, 0] += np.bincount(classes, weights=batch.column(1).to_numpy(), minlength=CLASSES)
                total[:, 1] += np.bincount(classes, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int32()), pa.array(total[:, 0]), pa.array(total[:, 1])], names=["k", "n", "v"])

    for k, n, v in counts.mapInArrow(of_classes, "k int, n double, v double").groupBy("k").agg(F.sum("n"), F.sum("v")).collect():
        vocabulary.class_tokens[k], vocabulary.class_types[k] = n, v
    vocabulary.class_tokens[END], vocabulary.class_types[END] = ends, 1
    return vocabulary


class Model:
    """The log-bilinear model: vectors of the context, vectors and weights of the targets."""

    def __init__(self, context: np.ndarray, target: np.ndarray, bias: np.ndarray, noise: np.ndarray):
        self.context, self.target, self.bias, self.noise = context, target, bias, noise

    @classmethod
    def fresh(cls, class_tokens: np.ndarray) -> Model:
        """Small fixed vectors; the weights make it the classes' frequencies to begin with."""
        rng = np.random.default_rng(11)
        noise = (class_tokens + 1) / (class_tokens + 1).sum()
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return cls(draw(ORDER, CLASSES + 1, WIDTH), draw(CLASSES, WIDTH), np.log(noise).astype(np.float32), noise)

    def copy(self) -> Model:
        return Model(self.context.copy(), self.target.copy(), self.bias.copy(), self.noise)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.context.ravel(), self.target.ravel(), self.bias]).astype(np.float64)

    def with_values(self, flat: np.ndarray) -> Model:
        a, b = self.context.size, self.context.size + self.target.size
        values = flat.astype(np.float32)
        return Model(values[:a].reshape(self.context.shape), values[a:b].reshape(self.target.shape), values[b:], self.noise)

    def predicted(self, before: np.ndarray) -> np.ndarray:
        """The predicted vector of each token from the classes before it, one column for each place."""
        total = self.context[0][before[:, 0]]
        for place in range(1, ORDER):
            total = total + self.context[place][before[:, place]]
        return total

    def log_totals(self, before: np.ndarray) -> np.ndarray:
        """The logarithm of the sum of exp(score) over all classes, for each context."""
        out = np.empty(len(before))
        weights, ones = np.ascontiguousarray(self.target.T), np.ones(CLASSES, np.float32)
        for at in range(0, len(before), SCORED):
            scores = self.predicted(before[at : at + SCORED]) @ weights
            scores += self.bias
            total, top = np.exp(scores) @ ones, 0.0
            if not (np.isfinite(total) & (total > 0)).all():  # beyond what single precision holds
                top = scores.max(axis=1)
                total = np.exp(scores - top[:, None]) @ ones
            out[at : at + SCORED] = top + np.log(total.astype(np.float64))
        return out

    def log10(self, before: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of the classes ``targets``.

        Texts come back to the same few words before a token again and again, so the sum over all classes is
        computed once for each distinct context.
        """
        keys = before @ np.array([(CLASSES + 1) ** place for place in range(ORDER)], np.int32)
        _, first, place = np.unique(keys, return_index=True, return_inverse=True)
        out = -self.log_totals(before[first])[place]
        for at in range(0, len(targets), SCORED):
            here, predicted = targets[at : at + SCORED], self.predicted(before[at : at + SCORED])
            out[at : at + SCORED] += np.einsum("ij,ij->i", predicted, self.target[here]) + self.bias[here]
        return out / np.log(10)


class Trainer:
    """Noise-contrastive steps with a step size of its own for each number (Adagrad)."""

    def __init__(self, model: Model, seed: int):
        self.model, self.rng = model.copy(), np.random.default_rng(seed)
        self.squares = [np.full(x.shape, CALM, np.float32) for x in (self.model.context, self.model.target, self.model.bias)]
        self.cumulated = np.cumsum(model.noise)

    def _step(self, which: int, values: np.ndarray, slope: np.ndarray) -> None:
        self.squares[which] += slope * slope
        values -= STEP * slope / np.sqrt(self.squares[which])

    def learn(self, before: np.ndarray, targets: np.ndarray) -> None:
        """One block: each true class against ``NOISE`` noise classes, the same for the whole block."""
        model, n = self.model, len(targets)
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), CLASSES - 1)
        predicted = model.predicted(before)
        shift = np.log(NOISE * model.noise).astype(np.float32)  # log of the expected number of noise samples
        true = (predicted * model.target[targets]).sum(axis=1) + model.bias[targets] - shift[targets]
        false = predicted @ model.target[noise].T + (model.bias - shift)[noise]
        pull = (1 / (1 + np.exp(np.clip(true, -30, 30)))).astype(np.float32)  # how far a true one is from certain
        push = (1 / (1 + np.exp(-np.clip(false, -30, 30)))).astype(np.float32)
        to_predicted = push @ model.target[noise] - pull[:, None] * model.target[targets]
        target_slope = summed_by(targets, -pull[:, None] * predicted, CLASSES)
        np.add.at(target_slope, noise, push.T @ predicted)
        bias_slope = np.bincount(targets, weights=-pull, minlength=CLASSES).astype(np.float32)
        np.add.at(bias_slope, noise, push.sum(axis=0))
        context_slope = np.stack([summed_by(before[:, place], to_predicted, CLASSES + 1) for place in range(ORDER)])
        for which, (values, slope) in enumerate(((model.context, context_slope), (model.target, target_slope), (model.bias, bias_slope))):
            self._step(which, values, slope / n)


def summed_by(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each key, below ``n``."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    begins = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[ordered[begins]] = np.add.reduceat(rows[order], begins, axis=0)
    return out


def with_context(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The classes of the ``ORDER`` tokens before each token, nearest first; ``START`` before a text."""
    before = np.full((len(classes), ORDER), START, np.uint8)
    place = np.arange(len(classes)) - np.repeat(starts[:-1], np.diff(starts))
    for back in range(1, ORDER + 1):
        there = place >= back
        before[there, back - 1] = classes[np.flatnonzero(there) - back]
    return before


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all texts of a batch from their byte strings, and where each text begins."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return flat, np.concatenate(([0], np.cumsum(lengths)))


def train(rows: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """``rounds`` rounds over ``rows`` (classes, slice): one slice each, all of it."""
    for number in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(model)

        @tidied
        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            trainer, seen = Trainer(shared.value, 7919 * number + TaskContext.get().partitionId()), 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                classes, starts = _sequences(batch.column(0))
                before = with_context(classes, starts)
                order = np.random.default_rng(number).permutation(len(classes))
                for at in range(0, len(order), BLOCK):
                    block = order[at : at + BLOCK]
                    trainer.learn(before[block], classes[block])
                seen += len(classes)
            if seen:
                flat = trainer.model.flat() * seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(-1, len(flat)), pa.int32()), pa.array(np.concatenate(([float(seen)], flat)))], names=["k", "v"]
                )

        sums = rows.where(F.col("slice") == number).select("classes").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
        if sums:
            values = np.zeros(len(sums))
            for k, v in sums:
                values[k + 1] = v
            model = model.with_values(values[1:] / values[0])
    return model


_READ = "held_out boolean, n_tokens long, n_known long, base double, classes binary, words array<string>, times array<int>"


def read_texts(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text: str) -> DataFrame:
    """One row per text: row, doc_id, held_out, n_tokens, what the broadcast counts tell, its classes, its rarer words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in (piece for whole in batches for piece in parts_of(whole, 2)):
            n = batch.num_rows
            words, starts = split_words(pc.ascii_lower(texts_of(batch.column(2))))
            codes, distinct = word_codes(words)
            counts, classes = known.look_up(distinct)
            c, per_text = counts[codes], np.diff(starts)
            owner = np.repeat(np.arange(n), per_text)
            # Log shares token by token: small numbers, whose sum is exact for the longest texts. One end more for each text.
            logs = np.insert(np.where(c >= 0, np.log10(np.maximum(c, 0) + 1.0), 0.0) - known.log_total, starts[1:], known.log_end)
            begins = (starts + np.arange(n + 1)).tolist()
            base = [logs[b:e].sum() for b, e in zip(begins, begins[1:])]
            n_known = np.bincount(owner, weights=c > 0, minlength=n).astype(np.int64) + (known.ends > 0)
            sequence = np.insert(classes[codes].astype(np.uint8), starts[1:], END)
            blobs = [sequence[b:e].tobytes() for b, e in zip(begins, begins[1:])]
            rare = np.flatnonzero(c < 0)
            pairs, times = np.unique(owner[rare] * (len(distinct) + 1) + codes[rare], return_counts=True)
            of_text = np.searchsorted(pairs // (len(distinct) + 1), np.arange(n + 1))
            offsets = pa.array(of_text, pa.int32())
            names = distinct.take(pa.array(pairs % (len(distinct) + 1))).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)), batch.column(0), batch.column(1), pa.array(per_text + 1), pa.array(n_known), pa.array(base),
                    pa.array(blobs, pa.binary()), pa.ListArray.from_arrays(offsets, names), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                ],
                names=["row", "doc_id", *(part.split()[0] for part in _READ.split(", "))],
            )
            row += n

    kind = dict(docs.dtypes)[id_col]
    asked = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, FOLDS) == HELD_OUT).alias("held_out"), text)
    return asked.mapInArrow(run, f"row long, doc_id {kind}, {_READ}")


def score_classes(rows: DataFrame, model: Model, vocabulary: Vocabulary) -> DataFrame:
    """row, and ``inner``: what the sum of log10 P(class | before) P(word | class) has more than the base score."""
    # A frequent word is all of its class.
    constant = -np.log10(vocabulary.class_tokens + vocabulary.class_types + 1)
    alone = np.arange(CLASSES) < vocabulary.frequent
    alone[END] = True
    within = np.where(alone, -np.log10(vocabulary.class_tokens + 1), constant) + vocabulary.log_total
    shared = rows.sparkSession.sparkContext.broadcast((model, within))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, within = shared.value
        for batch in batches:
            if batch.num_rows:
                classes, starts = _sequences(batch.column(1))
                logs = model.log10(with_context(classes, starts), classes) + within[classes]
                inner = [logs[b:e].sum() for b, e in zip(starts[:-1].tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(inner, pa.float64())], names=["row", "inner"])

    return rows.select("row", "classes").mapInArrow(run, "row long, inner double")


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from documents whose fold is not ``HELD_OUT``. NULL and empty texts are an end alone.
    Documents with the same id have a row each, and a NULL id counts as the empty text for its
    fold. No documents give no rows; without a training document all counts are zero. Only the
    id and the text are read.
    """
    learnt = docs.where(fold(id_col, FOLDS) != HELD_OUT)
    counts = settle(counted(learnt, text), "op2-counts")
    vocabulary = build_vocabulary(counts, learnt.select(F.lit(1)).count())
    rows = settle(read_texts(docs, vocabulary, id_col, text), "op2-texts")
    # Slices of whole texts; equal texts fall into different ones.
    sliced = rows.where(~F.col("held_out")).select("classes", F.pmod(F.xxhash64("row"), F.lit(ROUNDS)).alias("slice"))
    model = train(sliced, Model.fresh(vocabulary.class_tokens))
    # A rare word adds log10(c + 1) to both scores; one never seen adds nothing.
    rare = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("e")).select("row", F.col("e.words").alias("word"), F.col("e.times").alias("times"))
    log_count = F.col("times") * F.log10(F.col("c") + 1)
    from_join = rare.join(counts, "word").groupBy("row").agg(F.sum(log_count).alias("more"), F.sum("times").alias("more_known"))
    inner = score_classes(rows, model, vocabulary)
    scored = (
        rows.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base")
        .join(inner, "row").join(from_join, "row", "left").withColumn("base_score", F.col("base") + F.coalesce("more", F.lit(0.0)))
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score", (F.col("base_score") + F.col("inner")).alias("score"),
    )


def op2_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))


QUERIES = {"op2_log_bilinear": op2_log_bilinear}
ORACLE_SQL: dict[str, str] = {}
