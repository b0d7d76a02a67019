from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import collocations
from tidemark.llm.components import Bloom


def _low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, support, first=2000, longest=4, share=80):
    """(lang, rank, phrase, a, l, r, n, score) of rows (lang, text)."""
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            counts.update((lang, *words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    held = {p: a for p, a in counts.items() if len(p) > 2 and a >= support}
    out = []
    for (lang, *words), a in held.items():
        inside = lambda longer: any(longer[1 + s : 1 + s + len(words)] == tuple(words) for s in range(len(longer) - len(words)))
        if any(q[0] == lang and len(q) > len(words) + 1 and inside(q) and 100 * b >= share * a for q, b in held.items()):
            continue
        cuts = [(counts[lang, *words[:k]], counts[lang, *words[k:]], k) for k in range(1, len(words))]
        score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for l, r, k in cuts)
        out.append((lang, " ".join(words), a, l, r, n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, rank, *x[1:]) for rank, x in enumerate(own[:first], 1)]
    return sorted(ranked)


def _got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def _table(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def _some(seed, n=200):
    rng = random.Random(seed)
    words = "the of and New York city river été x\x00y a-b 42 rare common".split()
    piece = lambda: " \t".join(rng.choices(words, [40, 30, 20, 9, 9, 8, 7, 5, 4, 3, 2, 1, 6], k=rng.randint(0, 9)))
    return [(rng.choice(["en", "de", None]), "".join(piece() + rng.choice(". ,\n;:!?\x0b\r") for _ in range(6))) for _ in range(n)]


@pytest.mark.parametrize("support, shards, longest", [(5, 4, 4), (1, 3, 4), (30, 1, 4), (8, 7, 2)])
def test_against_plain_counting(spark, support, shards, longest):
    rows = _some(support)
    got = collocations.collocations(_table(spark, rows).repartition(5), support=support, shards=shards, longest=longest)
    assert _got(got) == brute(rows, support, longest=longest)


def test_runs_of_one_word_and_a_hot_copy(spark):
    """Overlaps count; a text that fills most of the table is mined like any other."""
    rows = [("en", "go go go go go, stop")] * 300 + _some(3, 30)
    assert _got(collocations.collocations(_table(spark, rows))) == brute(rows, 30)


def test_clashing_keys_change_nothing(spark, monkeypatch):
    """Filters that let everything through only add candidates."""
    rows = _some(4)
    monkeypatch.setattr(collocations, "bloom_of", lambda *_: Bloom(b"\xff" * 8, 64))
    assert _got(collocations.collocations(_table(spark, rows), support=5)) == brute(rows, 5)


def test_the_first_of_each_language(spark):
    rows = _some(5)
    assert _got(collocations.collocations(_table(spark, rows), support=3, first=7)) == brute(rows, 3, first=7)


def test_odd_rows_empty_tables_and_other_columns(spark, docs):
    rows = [("en", t) for _, t in ODD_ROWS]
    assert _got(collocations.collocations(docs(ODD_ROWS), support=2)) == brute(rows, 2)
    assert collocations.collocations(docs([])).count() == collocations.collocations(docs([(1, None), (2, " .")])).count() == 0
    schema = "key string, body string, lang string, a int, n int, size int, words int, score int, shard int, text int"
    df = spark.createDataFrame([("k", "a b a b", "x", *[1] * 7), (None, "a b", None, *[None] * 7)], schema)
    got = _got(collocations.collocations(df, text="body", id_col="key", support=1))
    assert got == brute([("x", "a b a b"), (None, "a b")], 1)


def test_scores_beyond_64_bits(spark):
    """The division is one of whole numbers, also where its products pass 64 bits."""
    from pyspark.sql import functions as F

    a, both = 9_100_000_000_000_000, 18_200_000_000_000_003
    row = spark.range(1).select(F.expr(f"cast({a}L as decimal(20,0)) * {collocations.SCALE} div (cast({both}L as decimal(20,0)) + 0L) as s"))
    assert row.first().s == 2_000_000 * a // both


def test_blobs_follow_their_keys():
    keys = np.array([5, 1 << 63, 5, 7, (1 << 64) - 1], np.uint64)
    sent = collocations._sent(1, 2, keys, 4)
    back = {k: c for ks, cs in zip(sent.column("keys").to_pylist(), sent.column("counts").to_pylist()) for k, c in zip(np.frombuffer(ks, np.uint64).tolist(), np.frombuffer(cs, np.uint32).tolist())}
    assert back == {5: 2, 7: 1, 1 << 63: 1, (1 << 64) - 1: 1} and sent.column("part").to_pylist() == [0, 2, 3]
