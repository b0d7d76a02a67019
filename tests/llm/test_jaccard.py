"""The parity-sketch join against all pairs, and its bounds on random sets."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import jaccard
from tidemark.llm.common import read_table
from tidemark.llm.components import bloom_of, components

SF = "/root/testdata/sf0.01"


def shingles(text, size=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in lower).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def all_pairs(texts, share=85, share_of=100):
    """(id, size, component) of every text, from every pair of texts that have a shingle in common."""
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        common = {}
        for x in s:
            for j in holders[x]:
                if j < k:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if share_of * n >= share * (len(s) + len(sets[j]) - n):
                parent[find(k)] = find(j)
    smallest = {}
    for k, (i, _) in enumerate(texts):
        if i is not None:
            smallest[find(k)] = min(i, smallest.get(find(k), i))
    return sorted(((i, len(sets[k]), smallest.get(find(k))) for k, (i, _) in enumerate(texts)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_all_pairs(spark):
    texts = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    got, want = rows_of(jaccard.op5_parity_jaccard(spark, SF)), all_pairs(texts)
    assert got == want
    assert len({c for _, _, c in want}) < len(want) - 50


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return words


@pytest.mark.parametrize("seed", range(2))
def test_chains_and_crowds(spark, docs, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng, texts = random.Random(seed), []
    for family in range(12):  # chains: each text is near the one before
        words = [f"f{family}w{rng.randrange(300)}" for _ in range(rng.choice([3, 6, 9, 14, 40, 120, 400]))]
        for _ in range(rng.randrange(2, 12)):
            texts.append(" ".join(words))
            words = edited(words, rng.randrange(0, 3), rng)
    base = [f"common{k}" for k in range(150)]
    texts += [" ".join(edited(base, rng.randrange(0, 7), rng)) for _ in range(60)]  # a crowd around the threshold
    passage = [f"p{k}" for k in range(60)]  # a passage that many texts share
    texts += [" ".join(passage + [f"own{rng.randrange(10**9)}" for _ in range(rng.randrange(5, 40))]) for _ in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert rows_of(jaccard.near_groups(docs(rows).repartition(3))) == all_pairs(rows)


def test_text_ids_and_other_columns(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [("b", long, 1, 2, 3, "x"), ("a", long + " more", 1, 2, 3, "x"), (None, "else", 1, 2, 3, "x"), ("c", None, 1, 2, 3, None)]
    df = spark.createDataFrame(rows, "ID string, text string, mark int, id_ int, name int, __mark string")
    assert rows_of(jaccard.near_groups(df, id_col="ID")) == sorted([("a", 58, "a"), ("b", 57, "a"), ("c", 0, "c"), (None, 1, None)], key=str)
    kept = jaccard.drop_near_copies(df, id_col="ID")
    assert kept.columns == df.columns and rows_of(kept.select("ID")) == sorted([("a",), ("c",), (None,)], key=str)


def test_odd_rows_and_empty_tables(spark, docs, store):
    rows = [*ODD_ROWS, (9, "Some text"), (None, "some TEXT"), (11, "a b c"), (12, "A\tB  C"), (13, "a b c d"), (14, None)]
    assert rows_of(jaccard.near_groups(docs(rows))) == all_pairs(rows)
    assert jaccard.op5_parity_jaccard(spark, store(documents=[])).count() == 0
    assert rows_of(jaccard.near_groups(docs([(1, None), (2, "")]))) == [(1, 0, 1), (2, 0, 2)]


def test_one_of_each_group_stays(docs):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(100)]
    rows = [(k, " ".join(edited(base, 2, rng))) for k in range(10, 20)] + [(30, "alone in the world"), (31, None), (32, ""), (32, "")]
    rows += [(40, "the same text twice"), (40, "the same text twice"), (None, "the same text TWICE"), (None, "without an id"), (None, "without an id")]
    got = jaccard.drop_near_copies(docs(rows))
    assert got.columns == docs([]).columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    whole = {c for i, _, c in all_pairs(rows) if i in range(10, 20)}
    want = [r for r in rows[:10] if r[0] in whole] + rows[10:14] + [(40, "the same text twice"), (None, "without an id")]
    assert kept == sorted(want, key=str)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 10**6))
def test_linked_sets_meet_in_a_group(n, less, more, seed):
    rng = random.Random(seed)
    both = [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts = [" ".join(both + [f"a{k}" for k in range(less % (n + 1))]), " ".join(both + [f"b{k}" for k in range(more % (n + 1))])]
    sets = jaccard.Sets(pa.array(texts, pa.large_string()))
    a, b = (shingles(t) for t in texts)
    assert sets.sizes.tolist() == [len(a), len(b)]
    bands = jaccard.Bands(85, 100)
    common = len(np.intersect1d(sets.of(0), sets.of(1)))
    assert common == len(a & b)
    x, y = sets.sketch(0), sets.sketch(1)
    assert jaccard._apart(x, y) <= len(a ^ b)
    if bands.links(common, len(a), len(b)):
        assert bands.most_apart(np.array(len(a)), np.array(len(b))) >= len(a ^ b)
        keys, names = jaccard.group_keys(sets, bands)
        own = [set(keys[names == name].tolist()) for name in sets.names]
        assert sets.names[0] == sets.names[1] or own[0] & own[1]


def test_bands_cover_linked_sizes():
    bands = jaccard.Bands(85, 100)
    for a in range(1, 3000):
        b = a * 100 // 85  # the largest size that can link with a
        assert bands.of(np.array([b]))[0] - bands.of(np.array([a]))[0] <= 1
    assert (bands.groups > bands.differ).all()


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 50)] + [(5, 5), (3000, 2999)]
    rng.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(201)}, **{1000 + k: 1000 for k in range(50)}, 2999: 2999, 3000: 2999}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_filter_never_misses(spark):
    found = bloom_of(spark.range(0, 100_000, 7).select("id"), "id")
    values = np.arange(100_000)
    hit = found.test(values)
    assert hit[::7].all() and hit.mean() < 0.2
    assert bloom_of(spark.range(0).select("id"), "id").test(values).sum() == 0
