from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm.interning import Table, Words, byte_class, hash_slices, slices
from tidemark.llm.resampling import WORD_BYTES


def _some(seed=1, n=3000):
    rng = np.random.default_rng(seed)
    return rng.integers(0, 4, 5000).astype(np.uint8), rng.integers(0, 4900, n), rng.integers(0, 60, n)


def test_hashes_are_those_of_the_library():
    data, starts, lengths = _some()
    want = [xxhash.xxh64_intdigest(data[a : a + n].tobytes()) for a, n in zip(starts, lengths)]
    assert hash_slices(data, starts, lengths).tolist() == want


@pytest.mark.parametrize("clash", [False, True])
def test_equal_slices_share_a_slot(clash):
    """Also when all keys are the same: bytes decide."""
    data, starts, lengths = _some()
    lengths = lengths % 6
    table = Table(data, starts, lengths, np.full(len(starts), 7, np.uint64) if clash else None)
    texts = [data[a : a + n].tobytes() for a, n in zip(starts, lengths)]
    assert len(table.first) == len(set(texts))
    assert [texts[table.first[k]] for k in table.slot] == texts
    assert table.count.sum() == len(texts) and all(texts.count(texts[f]) == c for f, c in zip(table.first, table.count))
    assert slices(data, starts, lengths).to_pylist() == texts


def test_empty_table():
    nothing = np.zeros(0, np.int64)
    table = Table(np.zeros(0, np.uint8), nothing, nothing)
    assert len(table.slot) == len(table.first) == len(table.count) == 0


def test_words_and_stretches():
    texts = ["Hello wörld, a1 b\x00c", "", None, "x", "--", "日本 A.b c"]
    cut = byte_class(b".,;")
    words = Words(pa.array(texts), WORD_BYTES, cut)
    got = [(o, words.data[a : a + n].tobytes().decode()) for o, a, n in zip(words.owner, words.starts, words.lengths)]
    low = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "") for t in texts]
    assert got == [(i, w) for i, t in enumerate(low) for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)]
    pairs = [words.data[words.starts[k] :][: n].tobytes().decode() for k, n in zip(words.runs(2), words.run_lengths(words.runs(2), 2))]
    assert pairs == ["hello wörld", "a1 b", "b c", "日本 a", "b c"]
    assert len(Words(pa.array(["", None], pa.string()), WORD_BYTES, cut).runs(1)) == 0
