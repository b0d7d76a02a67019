"""Exact dedup against plain grouping, with a filter too small to be of use and one large enough."""

from __future__ import annotations

import hashlib
import random

import pytest

import __spark_entry__ as entry
from tests.llm.conftest import ODD_ROWS
from tests.oracle import compare, connect
from tidemark.llm import exact_dedup
from tidemark.llm.common import read_table

SF = "/root/testdata/sf0.01"


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(folded(t), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        ordered = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        out += [(i, keep, len(ids), k == 0, sha) for k, i in enumerate(ordered)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_sql(spark):
    ok, note = compare(exact_dedup.op9_exact_dedup(spark, SF), connect(SF), entry.oracle_sql()["op9_exact_dedup"])
    assert ok, note


@pytest.mark.parametrize("max_bits", [exact_dedup.SLICE_BITS, 1 << 31])
def test_odd_rows_and_hot_groups(docs, max_bits):
    rng = random.Random(3)
    rows = [(k, rng.choice(["hot", "HOT", f"text {rng.randrange(300)}", "É", "é"])) for k in range(2000)] + ODD_ROWS + [(None, "hot"), (None, None)]
    df = docs(rows).repartition(5)
    got = exact_dedup.exact_groups(df, max_bits=max_bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(got) == plain(rows)
    kept = exact_dedup.drop_copies(df, max_bits=max_bits)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, folded(r.text)) for r in kept.collect()), key=str) == sorted(
        ((i, t) for t in {folded(t) for _, t in rows} for i in [next(w[1] for w in plain(rows) if w[4] == hashlib.sha256(t.encode()).hexdigest())]), key=str
    )


def test_rows_without_an_equal_are_not_shuffled(docs):
    df = docs([(k, f"text {k}") for k in range(1000)] + [(1000, "text 7")])
    flagged = exact_dedup.with_repeat_flag(df, "text", "sha", "maybe").where("maybe").count()
    assert 2 <= flagged < 30


def test_empty_table_and_clashing_names(spark, store, docs):
    assert exact_dedup.op9_exact_dedup(spark, store(documents=[])).count() == 0
    assert exact_dedup.drop_copies(docs([])).count() == 0
    clash = spark.createDataFrame([(1, "a", 5, "x"), (2, "A", 6, "y")], "doc_id long, text string, row_id int, text_sha256 string")
    assert rows_of(exact_dedup.exact_groups(clash)) == plain([(1, "a"), (2, "A")])
    assert [tuple(r) for r in exact_dedup.drop_copies(clash).collect()] == [(2, "A", 6, "y")]


def test_all_documents_are_there(spark):
    assert exact_dedup.op9_exact_dedup(spark, SF).count() == read_table(spark, SF, "documents").count()
