"""Token ids of whole batches with a public tokenizer.

White space never joins two pieces of this vocabulary, so a text's ids are its words' ids one
after another. Each distinct word of a batch is therefore encoded once, and the texts are put
together from the words' ids with numpy. Words of plain Latin letters, with at most one comma
or full stop behind them, need none of the vocabulary's normalising and cutting; they go to
the same merges by a shorter way. A task keeps the ids of short words of both kinds.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import split_words, texts_of, word_codes

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
VOCABULARY_SIZE = 49_408

#: Letters that the vocabulary's normaliser leaves alone: a-z and the small letters of U+00DF to U+00FF.
LETTERS = "[a-zß-öø-ÿ]+"

#: Words encoded in one call, which bounds the memory that the tokenizer's own objects take.
CALL = 512

#: Words of a kind whose ids a task keeps, and the most bytes of such a word.
KEPT = 1 << 19
LONGEST = 32

#: Bytes of text that are worked on at a time.
PART_BYTES = 8 << 20

#: Bytes of text that are cut into words at a time.
SPLIT_BYTES = 1 << 20


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load(path: str):
    """The tokenizer, once for each Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def load_plain(path: str):
    """(the tokenizer for plain words between blanks, the id that stands for a separator here and in the whole tokenizer)."""
    from tokenizers import Tokenizer, pre_tokenizers

    plain = Tokenizer(load(path).model)  # the same model, not a second one in memory
    plain.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    (separator,) = plain.encode("|", add_special_tokens=False).ids
    return plain, separator


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[s : s + n]`` of every (s, n), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    places = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    places += np.arange(total, dtype=kind)
    return values[places]


def joined_ids(tokenizer, separator: int, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after another, ids of each): words without a ``|``, many of them in one text."""
    parts = [np.zeros(0, np.uint32)]
    for at in range(0, len(words), 16 * CALL):
        joined, ids = [" | ".join(words[k : k + CALL]) for k in range(at, min(at + 16 * CALL, len(words)), CALL)], []
        for found in tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids += found.ids
            ids.append(separator)
        parts.append(np.array(ids, np.uint32))
    flat = np.concatenate(parts)
    cuts = np.flatnonzero(flat == separator)
    return np.delete(flat, cuts), np.diff(cuts, prepend=-1) - 1


class PlainWords:
    """Ids of plain words, kept from batch to batch of a task: at most ``KEPT`` words.

    When they are full, those not met since the last time are dropped. A look-up reads all kept
    words, so it should come once for many words.
    """

    def __init__(self, path: str):
        self.path = path
        self.words = pa.array([], pa.large_string())
        self.ids, self.sizes, self.met = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, bool)

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return joined_ids(*load_plain(self.path), words.to_pylist())

    def _drop(self) -> np.ndarray:
        """Drops the words not met; the others' new places."""
        begins = np.cumsum(self.sizes) - self.sizes
        places = np.cumsum(self.met) - 1
        self.ids = gather(self.ids, begins[self.met], self.sizes[self.met])
        self.words, self.sizes = self.words.filter(pa.array(self.met)), self.sizes[self.met]
        self.met = np.zeros(len(self.sizes), bool)
        return places

    def get(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, ids of each), of distinct words."""
        place = pc.index_in(words, value_set=self.words)
        new = pc.is_null(place).to_numpy(zero_copy_only=False)
        at = pc.fill_null(place, 0).to_numpy().astype(np.int64)
        self.met[at[~new]] = True
        if new.any():
            added = words.filter(pa.array(new))
            if len(self.words) + len(added) > KEPT:  # never drops a word that the present batch has
                at[~new] = self._drop()[at[~new]]
            at[new] = len(self.words) + np.arange(len(added))
            ids, sizes = self._encoded(added)
            self.words = pa.concat_arrays([self.words, added])
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
            self.met = np.concatenate([self.met, np.zeros(len(sizes), bool)])
        begins = np.cumsum(self.sizes) - self.sizes
        return gather(self.ids, begins[at], self.sizes[at]), self.sizes[at]


class OtherWords(PlainWords):
    """Ids of any words without a ``|``, kept alike, by the whole tokenizer."""

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        _, separator = load_plain(self.path)
        return joined_ids(load(self.path), separator, words.to_pylist())


@lru_cache(maxsize=1)
def kept_words(path: str) -> tuple[PlainWords, OtherWords]:
    return PlainWords(path), OtherWords(path)


def forgetting(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's generator, after which its kept words are dropped: Spark keeps Python workers, and other stages need the memory."""

    @wraps(work)
    def run(*given: object) -> Iterator:
        try:
            yield from work(*given)
        finally:
            kept_words.cache_clear()

    return run


def _single_ids(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    tokenizer, ids, lengths = load(path), [], []
    for at in range(0, len(words), 4 * CALL):
        for found in tokenizer.encode_batch_fast(words.slice(at, 4 * CALL).to_pylist(), add_special_tokens=False):
            ids += (own := found.ids)
            lengths.append(len(own))
    return np.array(ids, np.uint32), np.array(lengths, np.int64)


def word_ids(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after another, how many ids each word has)."""
    short = pc.less_equal(pc.binary_length(words), LONGEST)
    plain = pc.and_(short, pc.match_substring_regex(words, f"^{LETTERS}[.,]?$")).to_numpy(zero_copy_only=False)
    other = pc.and_not(short, pc.match_substring(words, "|")).to_numpy(zero_copy_only=False) & ~plain
    single = ~(plain | other)
    simple = words.filter(pa.array(plain))
    codes, stems = word_codes(pc.utf8_rtrim(simple, characters=".,"))
    plain_words, other_words = kept_words(path)
    tables = [
        plain_words.get(stems), other_words.get(words.filter(pa.array(other))), _single_ids(words.filter(pa.array(single)), path),
        _single_ids(pa.array([",", "."], pa.large_string()), path),
    ]
    flat = np.concatenate([ids for ids, _ in tables])
    sizes = np.concatenate([n for _, n in tables])
    begins = np.cumsum(sizes) - sizes
    comma, stop = len(sizes) - 2, len(sizes) - 1
    # Each word is one entry of the tables, and for some a second one: the mark behind it.
    entry = np.zeros((len(words), 2), np.int64)
    entry[plain, 0] = codes
    entry[other, 0] = len(stems) + np.arange(int(other.sum()))
    entry[single, 0] = len(stems) + int(other.sum()) + np.arange(int(single.sum()))
    second = np.zeros(len(simple), np.int64)
    second[pc.ends_with(simple, ",").to_numpy(zero_copy_only=False)] = comma
    second[pc.ends_with(simple, ".").to_numpy(zero_copy_only=False)] = stop
    entry[plain, 1] = second
    lengths = sizes[entry]
    lengths[:, 1] *= entry[:, 1] > 0
    return gather(flat, begins[entry].ravel(), lengths.ravel()), lengths.sum(axis=1)


def encode(texts: pa.Array, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each followed by ``end_id``; where each text's ids begin, and the end).

    Texts are cut into words, and put together from ids, ``SPLIT_BYTES`` at a time, which is what
    takes memory; their distinct words are encoded together, which is what takes time.
    """
    split = []
    for piece in parts_of(pa.RecordBatch.from_arrays([texts], names=["text"]), 0, SPLIT_BYTES):
        words, starts = split_words(_folded(texts_of(piece.column(0))))
        codes, own = word_codes(words)
        split.append((codes.astype(np.int32), starts, own))
    known, distinct = word_codes(pa.concat_arrays([own for _, _, own in split] or [pa.array([], pa.large_string())]))
    known = np.split(known, np.cumsum([len(own) for _, _, own in split])[:-1])
    ids, sizes = word_ids(distinct, path)
    # One more entry stands for the end of a text.
    vocabulary, sizes = np.append(ids, np.uint32(end_id)), np.append(sizes, 1)
    begins = np.cumsum(sizes) - sizes
    flat, counts = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
    for (codes, starts, _), entries in zip(split, known):
        sequence = np.insert(entries[codes], starts[1:], len(distinct))
        lengths = sizes[sequence]
        flat.append(gather(vocabulary, begins[sequence], lengths))
        ends = np.cumsum(lengths)[starts[1:] + np.arange(len(starts) - 1)]
        counts.append(np.diff(ends, prepend=0))
    return np.concatenate(flat), np.cumsum(np.concatenate(counts))


def parts_of(batch: pa.RecordBatch, column: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts take about ``most`` bytes (``PART_BYTES``); a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // (most or PART_BYTES)
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        if end > begin:
            yield batch.slice(begin, end - begin)


def _folded(texts: pa.Array) -> pa.Array:
    """Texts with A-Z in lower case, as the vocabulary has them, so that fewer words are distinct.

    Only texts without a mark like <|...|> are changed: these are found before the vocabulary's
    own lower-casing, in exactly their spelling.
    """
    marked = pc.match_substring(texts, "<|")
    return pc.if_else(marked, texts, pc.ascii_lower(texts))
