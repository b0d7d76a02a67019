"""Every stage of the pipeline against a plain version on the same input."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.conftest import ODD_ROWS
from tests.llm.test_decontaminate import words
from tests.llm.test_exact_dedup import folded
from tests.llm.test_ids import check_packing
from tests.llm.test_jaccard import shingles
from tidemark.llm import decontaminate, quality
from tidemark.llm.common import read_table

SF = "/root/testdata/sf0.01"
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def texts_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def one_copy(rows):
    best = {}
    for i, t in rows:
        best[folded(t)] = max(best.get(folded(t), (i, t)), (i, t), key=lambda r: (r[0] is not None, r[0] or 0))
    return list(best.values())


def one_near_copy(rows):
    sets = [shingles(t, 5) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < k}:
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                parent[max(find(k), find(j))] = min(find(k), find(j))
    first = {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        first.setdefault(find(k) if sets[k] else ("empty", k), k)
    return [rows[k] for k in first.values()]


def covered(item, doc):
    """Whether 80 % of the item's words lie in runs of three that the document has as well."""
    grams = {tuple(doc[k : k + 3]) for k in range(len(doc) - 2)}
    under = {k + s for k in range(len(item) - 2) if tuple(item[k : k + 3]) in grams for s in range(3)}
    return len(under) >= decontaminate.SHARE * len(item)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and result of each stage."""
    docs, out = read_table(spark, SF, "documents"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(number))
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_stages_hand_on_documents(spark, steps):
    columns = read_table(spark, SF, "documents").dtypes
    assert [len(corpus_pipeline.STAGES), *(s[1].dtypes == columns for s in steps[:4])] == [5, True, True, True, True]
    sizes = [s[1].count() for s in steps[:4]]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 500


def test_quality_stage(spark, steps):
    want = {r.doc_id for r in quality.classify(steps[0][0], read_table(spark, SF, "labels")).collect() if r.predicted}
    assert {r.doc_id for r in steps[0][1].collect()} == want
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    assert sum(labels[i] for i in labels if i not in want) <= 0.02 * sum(labels.values()), "good documents stay"


def test_exact_stage(steps):
    assert texts_of(steps[1][1]) == sorted(one_copy(texts_of(steps[1][0])), key=str)


def test_near_stage(steps):
    assert texts_of(steps[2][1]) == sorted(one_near_copy(texts_of(steps[2][0])), key=str)


def test_benchmark_stage(spark, steps):
    items = [w for w in (words(r.text) for r in read_table(spark, SF, "benchmark").collect()) if w]
    kept = dict(texts_of(steps[3][1]))
    for i, text in texts_of(steps[3][0]):
        doc = words(text)
        assert (i in kept) == (not any(covered(item, doc) for item in items))


def test_packing_stage(steps):
    check_packing(steps[4][1].collect(), texts_of(steps[4][0]))


def test_odd_rows_run_through(spark, store):
    labels = ("doc_id long, quality int, toxic int", [(k, 1, 0) for k in range(5)])
    folder = store(documents=[*ODD_ROWS, (20, f"x {PASSAGE} y")], labels=labels, benchmark=("item_id long, text string", [(1, PASSAGE), (2, None)]))
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and 20 not in {r.doc_id for r in rows}
    empty = store(documents=[], labels=(labels[0], []), benchmark=("item_id long, text string", []))
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_packing_encodes_small_pieces(spark, docs, monkeypatch):
    from tidemark.llm import packing

    monkeypatch.setattr(packing, "PIECE_BYTES", 1000)
    rows = [(i, f"word{i} " * (i % 50)) for i in range(200)]
    cut = {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in packing.pack(docs(rows).coalesce(1), size=65536).collect()}
    monkeypatch.setattr(packing, "PIECE_BYTES", 8 << 20)
    whole = {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in packing.pack(docs(rows).coalesce(1), size=65536).collect()}
    assert cut.keys() == whole.keys() and {k: n for k, (n, _) in cut.items()} == {k: n for k, (n, _) in whole.items()}
