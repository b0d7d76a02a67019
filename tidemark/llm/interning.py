"""Words as slices of a byte buffer, and an open-addressed table that numbers equal slices.

A batch of texts is one buffer of UTF-8 bytes. Words are runs of bytes of a class; phrases are
slices of a second buffer in which the words of a text stand one blank apart. ``Table`` puts the
slices of a batch into slots: 64-bit xxhash keys with linear probing, and every slice that lands
on a taken slot is compared with the slot's bytes, so that equal keys of different slices part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import texts_of
from tidemark.llm.token_ids import gather

#: The primes of xxHash64.
PRIME_1 = np.uint64(0x9E3779B185EBCA87)
PRIME_2 = np.uint64(0xC2B2AE3D27D4EB4F)
PRIME_3 = np.uint64(0x165667B19E3779F9)
PRIME_4 = np.uint64(0x85EBCA77C2B2AE63)
PRIME_5 = np.uint64(0x27D4EB2F165667C5)

#: Slices of at least so many bytes are hashed by the library, one by one.
LONG = 32
#: Slices that are put into one table.
CHUNK = 1 << 20


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of the rows of a matrix of bytes with less than ``LONG`` columns."""
    n, length = rows.shape
    h = np.full(n, PRIME_5 + np.uint64(length), np.uint64)
    at = 0
    while at + 8 <= length:
        lane = np.ascontiguousarray(rows[:, at : at + 8]).view("<u8").ravel()
        h = _turn(h ^ (_turn(lane * PRIME_2, 31) * PRIME_1), 27) * PRIME_1 + PRIME_4
        at += 8
    if at + 4 <= length:
        lane = np.ascontiguousarray(rows[:, at : at + 4]).view("<u4").ravel().astype(np.uint64)
        h = _turn(h ^ (lane * PRIME_1), 23) * PRIME_2 + PRIME_3
        at += 4
    for k in range(at, length):
        h = _turn(h ^ (rows[:, k].astype(np.uint64) * PRIME_5), 11) * PRIME_1
    h = (h ^ (h >> np.uint64(33))) * PRIME_2
    h = (h ^ (h >> np.uint64(29))) * PRIME_3
    return h ^ (h >> np.uint64(32))


def hash_slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of the slices ``data[s : s + n]``: all slices of one length at a time."""
    import xxhash

    out = np.zeros(len(starts), np.uint64)
    order = np.argsort(lengths, kind="stable")
    kinds, begins = np.unique(lengths[order], return_index=True)
    with np.errstate(over="ignore"):
        for length, own in zip(kinds.tolist(), np.split(order, begins[1:])):
            if length < LONG:
                out[own] = _hash_rows(data[starts[own][:, None] + np.arange(length)])
            else:
                out[own] = [xxhash.xxh64_intdigest(data[s : s + length].tobytes()) for s in starts[own].tolist()]
    return out


def same_slices(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether ``data[a : a + n]`` equals ``data[b : b + n]``, for every (a, b, n)."""
    if not len(a):
        return np.zeros(0, bool)
    differ = gather(data, a, lengths) != gather(data, b, lengths)
    total = np.concatenate(([0], np.cumsum(differ)))
    ends = np.cumsum(lengths)
    return total[ends] == total[ends - lengths]


class Table:
    """Slots of the slices ``data[s : s + n]``: ``slot`` numbers them from 0, equal slices alike.

    ``first`` is the slice that took each slot, ``count`` the number of its slices. ``keys`` can be
    given by tests; they only decide where a slice is looked for, never whether two are equal.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None = None):
        keys = hash_slices(data, starts, lengths) if keys is None else keys
        n, size = len(starts), 16
        while size < 2 * n:
            size *= 2
        held = np.full(size, -1, np.int64)  # the slice that took a place
        place = np.zeros(n, np.int64)
        left, at = np.arange(n), (keys & np.uint64(size - 1)).astype(np.int64)
        while len(left):
            free = held[at] < 0
            held[at[free]] = left[free]  # of several slices that come at once, one stays
            taker = held[at]
            alike = (keys[taker] == keys[left]) & (lengths[taker] == lengths[left])
            alike[alike] = same_slices(data, starts[left[alike]], starts[taker[alike]], lengths[left[alike]])
            place[left[alike]] = at[alike]
            left, at = left[~alike], (at[~alike] + 1) & (size - 1)
        used = np.flatnonzero(held >= 0)
        number = np.zeros(size, np.int64)
        number[used] = np.arange(len(used))
        self.slot, self.first = number[place], held[used]
        self.count = np.bincount(self.slot, minlength=len(used)).astype(np.int64)


def slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The slices as binary values."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(gather(data, starts, lengths).tobytes())])


def byte_class(inside: np.ndarray | bytes) -> np.ndarray:
    """A table of 256 entries that is true for these bytes."""
    table = np.zeros(256, bool)
    table[np.frombuffer(bytes(inside), np.uint8)] = True
    return table


class Words:
    """The words of a batch of texts, with A-Z as a-z.

    ``word``: which bytes make words; runs of them are words. ``cut``: bytes between which words
    belong together; every text begins a new stretch too. Both classes are of ASCII or whole
    characters, so a run of bytes is a run of characters.

    ``data`` holds the words one blank apart; word k is ``data[starts[k] : starts[k] + lengths[k]]``.
    ``owner`` is the text of each word, ``stretch`` its stretch.
    """

    def __init__(self, texts: pa.Array, word: np.ndarray, cut: np.ndarray | None = None):
        texts = pc.ascii_lower(texts_of(texts))
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        inside = word[raw]
        new = inside.copy()
        new[1:] &= ~inside[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        new[heads] = inside[heads]
        begins = np.flatnonzero(new)
        number = np.cumsum(new)  # of the last word that began, from 1
        kept = np.flatnonzero(inside)
        which = number[kept] - 1
        self.lengths = np.bincount(which, minlength=len(begins)).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths + np.arange(len(begins))
        self.data = np.full(len(kept) + len(begins), 0x20, np.uint8)
        self.data[np.arange(len(kept)) + which] = raw[kept]
        self.owner = np.searchsorted(offsets, begins, side="right") - 1
        self.stretch = self.owner
        if cut is not None:
            cuts = np.cumsum(cut[raw])
            self.stretch = (cuts[begins] if len(raw) else begins) + self.owner
        self.texts = len(texts)

    def runs(self, size: int) -> np.ndarray:
        """First words of all runs of ``size`` words within a stretch."""
        last = len(self.starts) - size + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.stretch[:last] == self.stretch[size - 1 :])

    def run_lengths(self, first: np.ndarray, size: int) -> np.ndarray:
        """Bytes of these runs of words, blanks included."""
        end = first + size - 1
        return self.starts[end] + self.lengths[end] - self.starts[first]
