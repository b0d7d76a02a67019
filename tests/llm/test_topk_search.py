from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk_search

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=10, every=100, asked=None):
    """(query_id, rank, vec_id, score) of rows (id, vector)."""
    good = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and good(v)]
    asked = asked or (lambda i: i % every == 0)
    queries = {}
    for i, v in rows:
        if i is not None and good(v) and asked(i):
            queries[i] = max(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        v = [math.floor(1024 * x) for x in v]
        scored = sorted((-min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(v, w)))), i) for i, w in whole if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def _got(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def _some(n, width, seed=0, cluster=0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) / math.sqrt(width) for _ in range(width)]) for i in range(n)]
    return [(i, rows[i % cluster][1] if cluster and i % 3 else v) for i, v in rows]


@pytest.mark.parametrize("n, width, block, asked, k", [(700, 16, 64, 3, 10), (300, 3, 300, 1024, 10), (250, 8, 7, 1, 20), (130, 1, 50, 2, 4)])
def test_against_all_pairs(spark, n, width, block, asked, k):
    rows = _some(n, width)
    got = topk_search.exact_top_k(_table(spark, rows).repartition(3), k=k, block=block, queries=asked, is_query=F.col("vec_id") % 20 == 0)
    assert _got(got) == brute(rows, k, every=20)


def test_ties_and_a_hot_vector(spark):
    """Two thirds of the rows are copies of five vectors; the smaller ids come first."""
    rows = _some(600, 6, cluster=5)
    assert _got(topk_search.exact_top_k(_table(spark, rows).repartition(4), block=100)) == brute(rows)


def test_odd_vectors(spark):
    rows = [
        (0, [0.5, -0.25]), (100, None), (200, [1.0, None]), (300, [float("nan"), 1.0]), (400, [float("inf"), 0.0]), (500, []), (600, [0.0, 0.0]),
        (None, [1.0, 1.0]), (1, [1.0]), (2, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, [-1e-9, 1e-9]), (700, [0.5, 1.0]), (700, [0.5, 2.0]), (-100, [1.5, 0.0]),
    ]
    for parts in (1, 6):
        assert _got(topk_search.exact_top_k(_table(spark, rows).repartition(parts))) == brute(rows)


def test_numbers_beyond_53_and_64_bits(spark):
    rows = [(0, [1e6, 3.0]), (1, [1e6, 1 / 1024]), (2, [1e6, 2 / 1024]), (100, [1e300, 1.0]), (3, [-1e300, 1.0]), (4, [2.0**40, 2.0**40])]
    assert _got(topk_search.exact_top_k(_table(spark, rows))) == brute(rows)


def test_text_ids_and_other_columns(spark):
    schema = "name string, v array<float>, id int, vector int, n int, block int, query_id int, rank int"
    df = spark.createDataFrame([(f"k{i}", [float(i), 1.0], *[i] * 6) for i in range(30)] + [(None, None, *[None] * 6)], schema)
    got = topk_search.exact_top_k(df, id_col="name", vector="v", is_query=F.col("name").endswith("7"), k=3, block=8)
    rows = [(f"k{i}", [float(i), 1.0]) for i in range(30)]
    assert _got(got) == brute(rows, 3, asked=lambda i: i.endswith("7"))


def test_empty_tables(spark):
    assert topk_search.exact_top_k(_table(spark, [])).count() == 0
    assert topk_search.exact_top_k(_table(spark, [(1, [1.0])])).count() == 0
    assert topk_search.exact_top_k(_table(spark, [(100, [1.0])])).count() == 0


def test_reading_stops_early():
    """On vectors with few large components the lists are not read to their ends."""
    rng = np.random.default_rng(0)
    matrix = np.floor(1024 * rng.standard_normal((2000, 32)) ** 3)
    lists = topk_search.Lists(matrix, np.argsort(matrix, axis=0, kind="stable").T.astype(np.uint16))
    none = np.zeros(2000, bool)
    for query in matrix[:50]:
        scores = matrix @ query
        left = lists._qualified(query, 10, np.sort(scores)[-10], none)
        assert len(left) <= 2000 * topk_search.FEW and set(np.argsort(-scores)[:9]) <= set(left)
