from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import resampling


def _low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _features(text, low, high):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _low(text))
    grams = [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]
    return len(words), grams


def brute(rows, target, low, high, buckets, least, share, seed=2024):
    of = lambda g: zlib.crc32(g.encode()) % buckets
    made = [(i, *_features(t, low, high)) for i, t in rows]
    s = Counter(of(g) for _, _, grams in made for g in grams)
    t = Counter(of(g) for _, text in target for g in _features(text, low, high)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for i, words, grams in made:
        weight = sum(gain(of(g)) for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, words, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    best = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for rank, row in enumerate(best[: len(best) * share // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=repr)


def _got(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("low, high, buckets, least, share", [(1, 1, 10_000, 20, 10), (1, 2, 97, 1, 50), (2, 3, 10, 0, 100)])
def test_against_plain_counting(spark, docs, low, high, buckets, least, share):
    words = "the quick brown Fox, jumps over a lazy dog; it's 42 ÅÉ naïve x-ray".split()
    rows = [(i, " ".join(words[(i * k) % len(words)] for k in range(1, 3 + i % 40))) for i in range(150)]
    target = [(i, " ".join(words[: 2 + i])) for i in range(5)]
    got = resampling.resample(docs(rows), docs(target), low=low, high=high, buckets=buckets, least_words=least, share=share)
    assert _got(got) == brute(rows, target, low, high, buckets, least, share)


def test_odd_rows_and_partitions(spark, docs):
    got = [
        _got(resampling.resample(docs(ODD_ROWS).repartition(n), docs([(1, "some text")]), least_words=1, share=60)) for n in (1, 5)
    ]
    assert got[0] == got[1] == brute(ODD_ROWS, [(1, "some text")], 1, 1, 10_000, 1, 60)


def test_empty_tables(spark, docs):
    nothing, one = docs([]), docs([(1, "a b")])
    assert resampling.resample(nothing, one).count() == resampling.resample(nothing, nothing).count() == 0
    assert _got(resampling.resample(one, nothing, least_words=1, share=100)) == brute([(1, "a b")], [], 1, 1, 10_000, 1, 100)


def test_text_ids_and_other_columns(spark):
    schema = "name string, body string, score string, rank int, bucket int, of int, place int, text int"
    df = spark.createDataFrame([("a", "x y", "s", 1, 2, 3, 4, 5), (None, None, None, None, None, None, None, None)], schema)
    got = resampling.resample(df, df, id_col="name", text="body", target_text="body", least_words=1, share=100)
    assert _got(got) == brute([("a", "x y"), (None, None)], [(0, "x y")], 1, 1, 10_000, 1, 100)


def test_query_draws_a_tenth(spark, store):
    rows = [(i, f"word{i % 7} " * 25) for i in range(95)] + [(200, "too short")]
    folder = store(documents=rows, benchmark=("item_id long, text string", [(1, "word3 word4")]))
    got = resampling.op13_importance_resampling(spark, folder)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(r.rank for r in got.collect() if r.rank) == list(range(1, 10))
