"""Trees on the shared binned table: both ways of growing them, against plain versions."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.plans import trees
from tidemark.plans.trees import Fit

FEATURES = ("a", "b", "c")
SCHEMA = "id long, a double, b double, c double, y double, role string, other string"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = 3 * (x[:, 0] > 5) + x[:, 1] / 4 - 2 * (x[:, 2] > 8) * (x[:, 0] > 3) + rng.normal(0, 0.3, 400)
    rows = [(i, *map(float, x[i]), float(y[i]), "train" if i < 300 else "test", "train" if i < 150 else None) for i in range(400)]
    return x, y, spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def score(s, n, l1, l2):
    return (np.sign(s) * max(abs(s) - l1, 0)) ** 2 / (n + l2)


def plain_tree(x, g, w, depth, least, l1, l2, step):
    """A tree as nested tuples, every cut tried."""
    s, n = float((w * g).sum()), float(w.sum())
    value = step * np.sign(s) * max(abs(s) - l1, 0) / max(n + l2, 1e-9)
    best = (1e-9, None)
    for f in range(x.shape[1]) if depth else ():
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            nl, sl = float(w[left].sum()), float((w * g)[left].sum())
            if min(nl, n - nl) >= least:
                gain = score(sl, nl, l1, l2) + score(s - sl, n - nl, l1, l2) - score(s, n, l1, l2)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut))
    if best[1] is None:
        return value
    f, cut = best[1]
    left = x[:, f] <= cut
    sides = [plain_tree(x[m], g[m], w[m], depth - 1, least, l1, l2, step) for m in (left, ~left)]
    return (f, cut, *sides)


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def plain_booster(x, y, train, fit):
    margin = np.full(len(y), y[train].mean())
    for _ in range(fit.trees):
        tree = plain_tree(x[train], (y - margin)[train], np.ones(train.sum()), fit.depth, fit.min_rows, fit.l1, fit.l2, fit.step)
        margin = margin + np.array([walk(tree, r) for r in x])
    return margin


@pytest.mark.parametrize(("l1", "l2"), [(0.0, 0.0), (5.0, 10.0)])
def test_boosting_equals_a_plain_booster(data, l1, l2):
    x, y, df = data
    fit = Fit("b", FEATURES, "y", "role", trees=20, depth=2, min_rows=20, rows=1.1, step=0.3, l1=l1, l2=l2)
    model = trees.fit_trees(df, [fit], ["id"])
    got = {r.id: r.y_pred for r in trees.predict(df, [fit], model, ["id"]).collect()}
    want = plain_booster(x, y, np.arange(400) < 300, fit)
    np.testing.assert_allclose([got[i] for i in range(400)], want, atol=1e-4)


def test_penalties_and_draws_make_different_learners(data):
    _, _, df = data
    fits = [
        Fit("plain", FEATURES, "y", "role", trees=30, depth=2, min_rows=20, rows=0.7, step=0.1),
        Fit("penalised", FEATURES, "y", "role", trees=30, depth=2, min_rows=20, rows=0.6, share=0.6, by_node=False, step=0.1, l1=5, l2=10),
        Fit("forest", FEATURES, "y", "role", trees=30, depth=3, min_rows=5, share=0.7),
    ]
    pred = trees.predict(df, fits, trees.fit_trees(df, fits, ["id"]), ["id"])
    sums = {r.fit: r.s for r in pred.groupBy("fit").agg({"y_pred": "sum"}).withColumnRenamed("sum(y_pred)", "s").collect()}
    assert len(set(sums.values())) == 3


def test_both_ways_grow_the_same_trees(data):
    """Broadcast or spread over tasks, in any number of partitions."""
    _, _, df = data
    fits = [
        Fit("forest", FEATURES, "y", "role", trees=7, depth=4, min_rows=5, share=0.7),
        Fit("other rows", ("a", "c"), "y", "other", trees=3, depth=3, min_rows=2),
        Fit("boosting", FEATURES, "y", "role", trees=4, depth=2, min_rows=20, rows=0.6, share=0.6, by_node=False, step=0.3, l1=1, l2=2),
    ]
    read = lambda m: sorted(map(tuple, m.collect()))
    whole = read(trees.fit_trees(df, fits, ["id"]))
    assert whole == read(trees.fit_trees(df.repartition(5), fits, ["id"])) == read(trees.fit_trees(df, fits, ["id"], table_bytes=0))
    assert len(whole) == 14


def test_forests_nest(data):
    """The first trees of a forest, cut off, are the smaller forest."""
    _, _, df = data
    large = Fit("large", FEATURES, "y", "role", trees=30, depth=5, min_rows=5, share=0.7)
    small = Fit("small", FEATURES, "y", "role", trees=10, depth=2, min_rows=5, share=0.7)
    model = trees.fit_trees(df, [large, small], ["id"])
    staged = trees.staged_r2(df, [large], model, (10, 30), (2, 5))
    for fit, at in ((large, (30, 5)), (small, (10, 2))):
        pred = trees.predict(df, [fit], model, ["id"]).toPandas()
        for split, rows in pred.groupby("split"):
            r2 = 1 - ((rows.y_true - rows.y_pred) ** 2).sum() / ((rows.y_true - rows.y_true.mean()) ** 2).sum()
            assert staged["large", split, *at] == pytest.approx(r2, abs=1e-9)


def test_odd_tables(spark):
    fit = Fit("f", ("a",), "y", "role", trees=2, depth=2, min_rows=1)
    df = spark.createDataFrame([(1, None, 0.0, 0.0, None, None, None)], SCHEMA)
    model = trees.fit_trees(df, [fit], ["id"])
    assert model.count() == 2 and trees.predict(df, [fit], model, ["id"]).count() == 0
    same = spark.createDataFrame([(i, 1.0, 0.0, 0.0, 2.0, "train", None) for i in range(9)], SCHEMA)
    assert {round(r.y_pred, 6) for r in trees.predict(same, [fit], trees.fit_trees(same, [fit], ["id"]), ["id"]).collect()} == {2.0}
