"""The quality classifier: held-out accuracy, what it may learn from, and odd rows."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import quality
from tidemark.llm.common import read_table

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 1


def auc(pairs):
    good, bad = [s for s, q in pairs if q], [s for s, q in pairs if not q]
    bad = np.sort(bad)
    return np.mean([(np.searchsorted(bad, s) + np.searchsorted(bad, s, side="right")) / 2 for s in good]) / len(bad)


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in quality.op8_quality_pu(spark, SF).collect()}


def test_every_document_has_a_score(spark, scored):
    assert len(scored) == read_table(spark, SF, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == held_out(i) for i, r in scored.items())


def test_held_out_labels_are_predicted(spark, scored):
    labels = [(r.doc_id, r.quality) for r in read_table(spark, SF, "labels").collect() if held_out(r.doc_id)]
    assert len(labels) > 1000
    assert auc([(scored[i].score, q) for i, q in labels]) > 0.99
    assert np.mean([scored[i].predicted == q for i, q in labels]) > 0.98


def test_held_out_labels_are_not_learnt(spark, store, docs):
    texts = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").limit(300).collect()]
    own = [(i, 1 if "***" not in t else 0, 0) for i, t in texts]
    turned = [(i, 1 - q if held_out(i) else q, 1) for i, q, _ in own]
    first = {r.doc_id: r.score for r in quality.classify(docs(texts), spark.createDataFrame(own, LABELS)).collect()}
    other = {r.doc_id: r.score for r in quality.classify(docs(texts), spark.createDataFrame(turned, LABELS)).collect()}
    assert first == pytest.approx(other, abs=1e-6)


def test_odd_rows_and_empty_tables(spark, docs):
    rows = [*ODD_ROWS, *((100 + k, f"A plain sentence number {k}.") for k in range(40))]
    labels = [(100 + k, int(k % 4 > 0), 0) for k in range(40)] + [(None, 1, 0), (100, None, 0), (9999, 1, 0), (101, 1, 0), (101, 0, 1)]
    got = quality.classify(docs(rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows) and all(math.isfinite(r.score) and 0 <= r.score <= 1 for r in got)
    assert quality.classify(docs([]), spark.createDataFrame(labels, LABELS)).count() == 0
    alone = quality.classify(docs(rows), spark.createDataFrame([], LABELS)).collect()
    assert all(r.score == pytest.approx(0.5) for r in alone)


def test_the_stage_keeps_what_is_predicted_good(spark, docs):
    rows = [(r.doc_id, r.text) for r in read_table(spark, "/root/testdata/sf0.01", "documents").collect()]
    labels = read_table(spark, "/root/testdata/sf0.01", "labels")
    kept = quality.keep_good(docs(rows), labels)
    assert kept.columns == docs([]).columns
    want = {r.doc_id for r in quality.classify(docs(rows), labels).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == want and len(want) > 700


def test_measures_by_hand():
    texts = ["", "AB cd. AB!", "a|b\na|b\nc 12"]
    table = quality.measures(pa.array(texts, pa.large_string()))
    at = quality.MEASURES.index
    assert not table[0].any()
    assert table[1, at("upper")] == pytest.approx(4 / 8) and table[1, at("exclaim")] == pytest.approx(1 / 8)
    assert table[1, at("distinct_words")] == pytest.approx(1 * math.log1p(3)) and table[2, at("pipe")] == pytest.approx(2 / 9)
    assert table[2, at("distinct_lines")] == pytest.approx(2 / 3) and table[2, at("digit")] == pytest.approx(2 / 9)
    assert table[1, at("loud_words")] == pytest.approx(2 / 3) and table[1, at("marked_ends")] == pytest.approx(1 / 3)


def test_measures_of_a_slice_are_those_of_the_whole():
    texts = pa.array([f"Wörter {k} UND Zeichen!! *** é" * (k % 7) for k in range(50)], pa.large_string())
    from tidemark.llm.common import texts_of

    whole = quality.measures(texts_of(texts))
    assert np.allclose(whole[20:40], quality.measures(texts_of(texts.slice(20, 20))))
