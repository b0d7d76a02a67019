"""The language model: counts and base scores by plain counting, probabilities that add up, gains on held-out texts."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import language_model as lm
from tidemark.llm.common import read_table

SF = "/root/testdata/sf0.01"
THE_END = object()


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in lower).split(" ") if w] + [THE_END]


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def plain(texts):
    """(id, held out, tokens, known, training tokens) -> base score, by counting."""
    counts = Counter(t for i, x in texts if not held_out(i) for t in tokens(x))
    n, v, out = sum(counts.values()), len(counts), []
    for i, x in texts:
        t = tokens(x)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        out.append(((i, held_out(i), len(t), sum(counts[w] > 0 for w in t), n), base))
    return sorted(out, key=str)


def check(rows, texts):
    got = sorted((((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens), r.base_score) for r in rows), key=str)
    want = plain(texts)
    assert [k for k, _ in got] == [k for k, _ in want]
    assert [b for _, b in got] == pytest.approx([b for _, b in want], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


@pytest.fixture(scope="module")
def scored(spark):
    return lm.op2_log_bilinear(spark, SF).collect()


def test_counts_and_base_scores(spark, scored):
    check(scored, [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()])


def test_the_model_beats_the_counts_on_held_out_texts(scored):
    out = [r for r in scored if r.held_out]
    n = sum(r.n_tokens for r in out)
    assert sum(r.score - r.base_score for r in out) / n > 0.05


def test_rare_words_are_counted_by_the_join(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 300)
    rows = [tuple(r) for r in read_table(spark, SF, "documents").limit(300).select("doc_id", "text").collect()] + [(5000, "z" * 70_000), (5001, "z" * 70_000)]
    check(lm.score(docs(rows)).collect(), rows)


def test_odd_rows_and_empty_tables(spark, docs, store):
    check(lm.op2_log_bilinear(spark, store(documents=ODD_ROWS)).collect(), ODD_ROWS)
    assert lm.op2_log_bilinear(spark, store(documents=[])).count() == 0
    out = next(k for k in range(100) if held_out(k))
    check(lm.score(docs([(out, "only held out")])).collect(), [(out, "only held out")])


def small_model():
    rng = np.random.default_rng(2)
    model = lm.Model.fresh(rng.integers(1, 1000, lm.CLASSES).astype(float))
    return model.with_values(model.flat() + rng.normal(0, 0.5, model.flat().shape))


def test_probabilities_of_all_classes_add_up_to_one():
    model, before = small_model(), np.random.default_rng(3).integers(0, lm.CLASSES + 1, (5, lm.ORDER))
    for row in before:
        logs = model.log10(np.tile(row, (lm.CLASSES, 1)), np.arange(lm.CLASSES))
        assert (10**logs).sum() == pytest.approx(1, rel=1e-4)


def test_words_of_a_class_add_up_to_one(spark):
    words = [f"{stem}{end}" for stem in "abcdefgh" for end in ("ing", "ed", "es", ".", "2")]
    frequent = [(f"common{k}", 1000 + k) for k in range(lm.FREQUENT)]
    counts = spark.createDataFrame([(w, k % 5 + 1) for k, w in enumerate(words)] + frequent, "word string, c long")
    vocabulary = lm.build_vocabulary(counts, 3)
    _, classes = vocabulary.look_up(pa.array(words, pa.large_string()))
    _, own = vocabulary.look_up(pa.array([w for w, _ in frequent], pa.large_string()))
    assert sorted(own.tolist()) == list(range(lm.FREQUENT)) and min(classes) >= lm.FREQUENT
    assert vocabulary.types == len(words) + lm.FREQUENT + 1
    assert vocabulary.tokens == 3 + sum(k % 5 + 1 for k in range(len(words))) + sum(c for _, c in frequent)
    for c in set(classes.tolist()):
        own = [k % 5 + 1 for k in range(len(words)) if classes[k] == c]
        total = vocabulary.class_tokens[c] + vocabulary.class_types[c] + 1
        assert sum((n + 1) / total for n in own) + 1 / total == pytest.approx(1)


def test_a_model_far_out_stays_finite():
    model = small_model()
    model.bias[3] = 500
    logs = model.log10(np.full((4, lm.ORDER), lm.START), np.array([3, 0, 3, 1]))
    assert np.isfinite(logs).all() and logs[0] == pytest.approx(0, abs=1e-6)


def test_training_learns_a_language():
    rng = np.random.default_rng(5)
    classes = np.concatenate([np.tile(rng.permutation(20), 1)[:20] if k % 2 else np.arange(20, 40) for k in range(3000)]).astype(np.uint8)
    before = lm.with_context(classes, np.array([0, len(classes)]))
    model = lm.Model.fresh(np.bincount(classes, minlength=lm.CLASSES).astype(float))
    trainer = lm.Trainer(model, 1)
    for at in range(0, len(classes), lm.BLOCK):
        trainer.learn(before[at : at + lm.BLOCK], classes[at : at + lm.BLOCK])
    assert trainer.model.log10(before, classes).mean() > model.log10(before, classes).mean() + 0.3


def test_context_stops_at_the_text():
    before = lm.with_context(np.array([1, 2, 3, 4, 5], np.uint8), np.array([0, 3, 5]))
    s = lm.START
    assert before.tolist() == [[s, s, s], [1, s, s], [2, 1, s], [s, s, s], [4, s, s]]


def test_each_context_is_normalised_once(monkeypatch):
    import numpy as np

    from tidemark.llm import language_model as lm

    model, seen = lm.Model.fresh(np.arange(lm.CLASSES)), []
    plain = model.log_totals
    monkeypatch.setattr(model, "log_totals", lambda before: seen.append(len(before)) or plain(before))
    classes = np.tile(np.array([3, 1, 4, 1, 5], np.uint8), 2000)
    before = lm.with_context(classes, np.array([0, len(classes)]))
    got = model.log10(before, classes)
    assert seen == [len(np.unique(before, axis=0))] and seen[0] < 10
    scores = (model.predicted(before) @ model.target.T + model.bias).astype(np.float64)
    want = (scores[np.arange(len(classes)), classes] - np.log(np.exp(scores).sum(axis=1))) / np.log(10)
    assert np.allclose(got, want, atol=1e-5)
