"""Packing and packed id files against the tokenizer itself."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import packed_ids, packing, token_ids
from tidemark.llm.common import read_table, texts_of

SMALL = "/root/testdata/sf0.001"


def plain_ids(text):
    return token_ids.load(token_ids.vocabulary_path()).encode(text or "", add_special_tokens=False).ids + [token_ids.END_ID]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


PIECES = st.sampled_from(["the", "The.", "a,", "b.,", "it's", "é", "é", "́", "ß", "×", "|", "<|endoftext|>", "<|ENDOFTEXT|>", "12", " ", "İ", "Σ"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(PIECES, st.sampled_from(["", " ", "\n", "\t "])), max_size=12), min_size=1, max_size=5))
def test_batches_are_encoded_like_single_texts(texts):
    texts = ["".join(a + b for a, b in t) for t in texts]
    ids, offsets = token_ids.encode(pa.array(texts, pa.large_string()), token_ids.vocabulary_path())
    for text, begin, end in zip(texts, offsets, offsets[1:]):
        assert ids[begin:end].tolist() == plain_ids(text)


def test_slices_of_a_batch_are_encoded_like_the_whole(monkeypatch):
    texts = [f"Été {k} ß, wörter. AKIA {'x' * (k % 50)}" for k in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    monkeypatch.setattr(token_ids, "PART_BYTES", 1000)
    at = 0
    for piece in token_ids.parts_of(batch, 0):
        ids, offsets = token_ids.encode(texts_of(piece.column(0)), token_ids.vocabulary_path())
        for begin, end in zip(offsets, offsets[1:]):
            assert ids[begin:end].tolist() == plain_ids(texts[at])
            at += 1
    assert at == 500


def test_kept_words_are_bounded_and_right(monkeypatch):
    monkeypatch.setattr(token_ids, "KEPT", 50)
    kept = token_ids.PlainWords(token_ids.vocabulary_path())
    rng = np.random.default_rng(5)
    for _ in range(40):
        words = sorted({"".join(rng.choice(list("abé"), rng.integers(1, 5))) for _ in range(20)})
        ids, sizes = kept.get(pa.array(words, pa.large_string()))
        ends = np.cumsum(sizes)
        for word, begin, end in zip(words, ends - sizes, ends):
            assert ids[begin:end].tolist() == plain_ids(word)[:-1]
        assert len(kept.words) <= 50 + 20


def test_kept_words_are_looked_up_once_and_not_encoded_again(monkeypatch):
    texts = pa.array([f"{a}{b} {a}{c}," for a in "abcdefgh" for b in ("%%%", "-1", "é!") for c in "xyz"], pa.large_string())
    path = token_ids.vocabulary_path()
    token_ids.kept_words.cache_clear()
    lookups, given_out, whole = [], [], token_ids.load(path)

    class Counted:
        def encode_batch_fast(self, words, **how):
            given_out.extend(w for w in words if w not in ",.")
            return whole.encode_batch_fast(words, **how)

    index_in = token_ids.pc.index_in
    monkeypatch.setattr(token_ids.pc, "index_in", lambda *a, **k: lookups.append(1) or index_in(*a, **k))
    monkeypatch.setattr(token_ids, "load", lambda path: Counted())
    first = token_ids.encode(texts, path)
    assert given_out and len(lookups) == 2, "plain and other words: all kept words are read once for each"
    given_out.clear()
    again = token_ids.encode(texts, path)
    assert not given_out
    monkeypatch.undo()
    assert first[0].tolist() == again[0].tolist() == [i for t in texts.to_pylist() for i in plain_ids(t)[:-1] + [token_ids.END_ID]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8), st.sampled_from([1, 30, 1 << 20]))
def test_words_encoded_in_one_text_are_as_alone(texts, split):
    texts = [t.replace("\0", "") for t in texts]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_ids, "SPLIT_BYTES", split)
        ids, offsets = token_ids.encode(pa.array(texts, pa.large_string()), token_ids.vocabulary_path())
    assert len(offsets) == len(texts) + 1
    for text, begin, end in zip(texts, offsets, offsets[1:]):
        assert ids[begin:end].tolist() == plain_ids(text)


def test_kept_words_are_dropped_with_their_task():
    path = token_ids.vocabulary_path()
    token_ids.kept_words.cache_clear()

    @token_ids.forgetting
    def task(batches):
        for texts in batches:
            yield token_ids.encode(pa.array(texts, pa.large_string()), path)[0].tolist()

    kept = [(ids, len(token_ids.kept_words(path)[0].words)) for ids in task([["some words"], ["more words"]])]
    assert kept == [(plain_ids("some words"), 2), (plain_ids("more words"), 3)]
    assert not len(token_ids.kept_words(path)[0].words)


def test_long_words_are_not_kept():
    path = token_ids.vocabulary_path()
    token_ids.kept_words.cache_clear()
    texts = ["x" * 5000, "%5" * 900, "漢字" * 400, "a|b | ||", "short -5"]
    ids, offsets = token_ids.encode(pa.array(texts, pa.large_string()), path)
    for text, begin, end in zip(texts, offsets, offsets[1:]):
        assert ids[begin:end].tolist() == plain_ids(text)
    assert [kept.words.to_pylist() for kept in token_ids.kept_words(path)] == [["short"], ["-5"]]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, 2**b - 1), max_size=300))))
def test_bits_round_trip(case):
    bits, ids = case
    data = packed_ids.pack_bits(np.array(ids, np.uint32), bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert packed_ids.unpack_bits(data, bits, len(ids)).tolist() == ids


def test_a_file_gives_any_range():
    ids = np.random.default_rng(1).integers(0, 49_408, 1000).astype(np.uint32)
    data = packed_ids.file_bytes(ids, [5, None, 9], np.array([0, 10, 10, 1000]), packed_ids.id_bits(49_408), 64, 0, 0, 0)
    found = packed_ids.PackedFile(data)
    assert found.bits == 16 and found.docs.tolist() == [5, 0, 9] and found.known.tolist() == [True, False, True]
    for begin, end in [(0, 1000), (63, 65), (64, 128), (999, 1000), (5, 5), (130, 700)]:
        assert found.ids(begin, end).tolist() == ids[begin:end].tolist()
    assert len(found.document(1)) == 0 and found.document(2).tolist() == ids[10:].tolist()


def test_ids_beyond_the_width_are_refused():
    with pytest.raises(ValueError):
        packed_ids.file_bytes(np.array([8], np.uint32), [1], np.array([0, 1]), 3, 4, 0, 0, 0)


def check_files(rows, texts):
    rows = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((d for d, _ in texts), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    want = sorted((d is not None, d or 0, len(i := plain_ids(t)), crc(i)) for d, t in texts)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == want


def test_files_hold_every_document(spark):
    rows = packed_ids.op4_packed_token_ids(spark, SMALL).collect()
    check_files(rows, [tuple(r) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect()])


def test_files_of_odd_rows(spark, store):
    check_files(packed_ids.op4_packed_token_ids(spark, store(documents=ODD_ROWS)).collect(), ODD_ROWS)


def test_many_small_files(spark, docs, tmp_path):
    rows = [(k, "some words " * (k % 7)) for k in range(300)]
    parts = packed_ids.write_ids(docs(rows), str(tmp_path / "ids"), file_ids=50, block_ids=8)
    assert len(list((tmp_path / "ids").glob("*.ids"))) > 20
    check_files(packed_ids.read_ids(spark, str(tmp_path / "ids"), parts).collect(), rows)


def test_no_documents_no_ids(spark, store):
    assert packed_ids.op4_packed_token_ids(spark, store(documents=[])).count() == 0
    assert packing.op10_cost_balanced_packing(spark, store(documents=[])).count() == 0


def check_packing(rows, texts, size=4096):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id, r.doc_tokens].append(r)
    wanted = defaultdict(list)
    for d, t in texts:
        ids = plain_ids(t)
        wanted[d, len(ids)].append(ids)
    assert set(by_doc) == set(wanted)
    for key, pieces in by_doc.items():
        copies = wanted[key]
        assert sum(p.length for p in pieces) == key[1] * len(copies)
        for p in pieces:
            assert any(crc(ids[p.start : p.start + p.length]) == p.ids_crc32 for ids in copies)
        if len(copies) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size and at & (at - 1) == 0, "full, or a power of two: nothing is padded"


def test_packing_places_every_id_once(spark):
    texts = [tuple(r) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    check_packing(packing.op10_cost_balanced_packing(spark, SMALL).collect(), texts)


def test_packing_of_odd_rows_and_small_sequences(spark, docs, store):
    check_packing(packing.op10_cost_balanced_packing(spark, store(documents=ODD_ROWS)).collect(), ODD_ROWS)
    rows = [(k, "some words " * (k % 40)) for k in range(200)]
    check_packing(packing.pack(docs(rows), size=32, block_docs=16).collect(), rows, 32)


def test_costs_are_balanced():
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.geometric(1 / 400, 2000), 4095)
    full, rest = divmod(int(lengths.sum()), 4096)
    cost = np.zeros(full)
    for _, _, n, to, _ in packing.assign(lengths, np.array([4096] * full + packing.powers_of_two(rest)), 1.0, 1 / 4096):
        if to < full:
            cost[to] += n + n * n / 4096
    in_order = []
    for n in np.split(lengths, np.searchsorted(np.cumsum(lengths), np.arange(1, full) * 4096)):
        in_order.append((n + n * n / 4096).sum())
    assert cost.std() < 0.6 * np.std(in_order)


def test_size_must_be_a_power_of_two(docs):
    with pytest.raises(ValueError):
        packing.pack(docs([(1, "a")]), size=100)
