from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluate
from tidemark.operators.features import feature_list, model_features
from tidemark.operators.series import ts_folds
from tidemark.plans import modelling
from tidemark.plans.dataset import PRICE

TREES = {"numTrees": 10, "minInstancesPerNode": 5}


@pytest.fixture(scope="module")
def table(spark):
    """Two series with a strong weekly pattern, so a fit has something to find."""
    rng = np.random.default_rng(1)
    rows = []
    for key, level in (("a", 40.0), ("b", 80.0)):
        for i in range(260):
            price = level * (1 + 0.3 * np.sin(2 * np.pi * i / 7)) + rng.normal(0, 1)
            rows.append((key, dt.date(2023, 1, 1) + dt.timedelta(i), float(price), float(rng.normal(100, 5))))
    df = spark.createDataFrame(rows, f"series_id string, d date, {PRICE} double, Supply_Volume double")
    return model_features(df, PRICE).cache()


@pytest.fixture(scope="module")
def matrix(table):
    return modelling.model_matrix(table, feature_list(table)).cache()


def test_matrix_is_complete_and_split_in_time(matrix):
    assert matrix.where(" or ".join(f"{c} is null" for c in matrix.columns)).count() == 0
    spans = matrix.groupBy("series_id").agg(
        F.max(F.when(F.col("split") == "train", F.col("d"))).alias("a"), F.min(F.when(F.col("split") == "test", F.col("d"))).alias("b"))
    assert all(r["a"] < r["b"] for r in spans.collect())


def test_experiments_grow(table):
    sizes = [len(feature_list(table, e)) for e in ("BASE", "BASE + LAG", "BASE + LAG + ROLL", "FULL MODEL")]
    assert sizes == sorted(set(sizes)) and "Diesel" not in feature_list(table)
    assert not set(feature_list(table, without=["Lag"])) & {"lag1", "lag28"}


def test_ridge_equals_the_closed_form(matrix, table):
    names = feature_list(table)
    pred = modelling.fit_predict(matrix, "Ridge", names)
    rows = matrix.join(pred.select("series_id", "d", "y_pred"), ["series_id", "d"]).toPandas()
    train = rows[rows["split"] == "train"]
    x, y = train[names].to_numpy(float), train["target"].to_numpy()
    scale = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(scale == 0, 1, scale)
    w = np.linalg.solve(z.T @ z + 100 * np.eye(len(names)), z.T @ (y - y.mean()))
    zt = (rows[names].to_numpy(float) - x.mean(axis=0)) / np.where(scale == 0, 1, scale)
    np.testing.assert_allclose(rows["y_pred"], zt @ w + y.mean(), rtol=1e-6)


@pytest.mark.parametrize(("name", "params"), [("RandomForest", TREES), ("GradientBoosting", {"maxIter": 15, "stepSize": 0.3}), ("XGBoost", {"maxIter": 15, "stepSize": 0.3})])
def test_trees_beat_the_mean(matrix, table, name, params):
    pred = modelling.fit_predict(matrix, name, feature_list(table), params=params)
    r2 = {r["split"]: r["r2"] for r in evaluate.metrics(pred).collect()}
    assert r2["train"] > 0.8 and r2["test"] > 0.7


def test_seeded_fit_repeats(matrix, table):
    runs = [modelling.fit_predict(matrix, "RandomForest", feature_list(table), params=TREES).agg(F.sum("y_pred")).first()[0] for _ in range(2)]
    assert runs[0] == runs[1]


def test_importances(matrix, table):
    names = feature_list(table)
    rows = modelling.feature_importance(matrix, names, TREES).collect()
    assert {r["feature"] for r in rows} == set(names) and sum(r["importance"] for r in rows) == pytest.approx(1)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)


def test_one_table_has_the_roles_of_each_matrix(table):
    sets = {"few": ["lag1"], "all": feature_list(table)}
    stacked, roles = modelling.stacked(table, sets, (1, 7))
    for (name, h), role in roles.items():
        own = modelling.model_matrix(table, sets[name], h).select("series_id", "d", "split", "target")
        here = stacked.where(F.col(role).isNotNull()).select("series_id", "d", F.col(role).alias("split"), F.col(f"target_h{h}").alias("target"))
        assert sorted(map(tuple, own.collect())) == sorted(map(tuple, here.collect()))
    whole, all_roles = modelling.stacked(table, {"few": ["lag1"]}, complete="all")
    assert whole.where(F.col(all_roles["few", 7]).isNotNull()).count() == modelling.model_matrix(table, ["lag1"], complete="all").count()


def test_sizes_of_the_learners():
    fits = {m: modelling.tree_fit("f", m, [f"x{i}" for i in range(45)]) for m in ("RandomForest", "GradientBoosting", "XGBoost", modelling.SERVICE)}
    assert fits["XGBoost"].l1 == 5 and fits["XGBoost"].l2 == 10 and fits["XGBoost"].drawn == 27 and not fits["XGBoost"].by_node
    assert fits["GradientBoosting"].l2 == 0 and fits["GradientBoosting"].drawn == 45 and fits["RandomForest"].drawn == 18
    assert modelling.tree_fit("f", "RandomForest", ["x"] * 42, {"featureSubsetStrategy": "sqrt"}).drawn == 6
    assert [f.trees for f in fits.values()] == [400, 500, 500, 500] and fits[modelling.SERVICE].depth == 6


def test_short_catalogue_leaves_out_the_long_lag(table):
    from tidemark import fixed

    short = feature_list(table, catalogue=fixed.FEATURE_GROUPS_SHORT)
    assert "lag28" in table.columns and "lag28" not in short and "lag28" in feature_list(table)
    own = modelling.model_matrix(table, ["lag1"]).count()
    shared = modelling.model_matrix(table, ["lag1"], complete="all").count()
    assert own - shared == 2 * 27


def test_ablation_and_horizons(table):
    gaps = modelling.ablation_table(table, modelling.ablation(table, ("BASE", "FULL MODEL"), ("Ridge",))).collect()
    r2 = {r["exp"]: r["test_r2"] for r in gaps}
    assert {r["exp"]: r["n_features"] for r in gaps} == {e: len(feature_list(table, e)) for e in r2}
    assert r2["FULL MODEL"] > r2["BASE"]
    pred = modelling.horizon_predictions(table, (1, 7), params=TREES)
    out = modelling.horizon_table(pred, modelling.persistence(table, (1, 7))).orderBy("horizon").collect()
    assert [r["horizon"] for r in out] == [1, 7]
    assert out[0]["delta_r2"] > 0.3 and out[0]["significant"]
    for r in out:
        assert r["delta_r2"] == pytest.approx(r["model_r2"] - r["naive_r2"])


def test_walk_forward_has_no_leak(table):
    pred = modelling.walk_forward(table, n_splits=3, params=TREES)
    assert {r["fold"] for r in evaluate.walk_forward_summary(pred).collect()} == {"Fold 1", "Fold 2", "Fold 3", "Mean", "Std"}
    once = pred.groupBy("series_id", "d").count().agg(F.max("count")).first()[0]
    assert once == 1


def test_grid_search(table):
    grid = {"numTrees": (5,), "maxDepth": (1, 5)}
    out = modelling.grid_search(table, grid=grid, n_splits=2, top=1).orderBy("rank").collect()
    assert [r["maxDepth"] for r in out] == ["5", "1"] and out[0]["cv_r2"] > out[1]["cv_r2"]
    assert out[0]["gap"] == pytest.approx(out[0]["train_r2"] - out[0]["test_r2"]) and out[1]["test_r2"] is None


def test_points_of_the_grid_equal_their_own_fits(table):
    """Forests inside the largest one score as they do when fitted alone, fold by fold."""
    names = [f for f in feature_list(table)][:20]
    grid = {"numTrees": (6, 12), "maxDepth": (2, 4), "minInstancesPerNode": (5,), "featureSubsetStrategy": ("0.5", "sqrt")}
    out = modelling.grid_search(table, names, grid, n_splits=2, top=3).collect()
    assert len(out) == 8 and sum(r["test_r2"] is not None for r in out) == 3
    matrix = modelling.model_matrix(table, names)
    folds = ts_folds(matrix.where("split = 'train'").drop("split"), 2)
    for r in [out[0], out[2], out[5], out[7]]:
        point = {"numTrees": int(r["numTrees"]), "maxDepth": int(r["maxDepth"]), "minInstancesPerNode": 5, "featureSubsetStrategy": r["featureSubsetStrategy"]}
        scores = []
        for fold in (1, 2):
            rows = folds.where(F.col("fold") == fold).withColumnRenamed("role", "split")
            pred = modelling.fit_predict(rows, "RandomForest", names, params=point).where("split = 'test'").toPandas()
            scores.append(1 - ((pred.y_true - pred.y_pred) ** 2).sum() / ((pred.y_true - pred.y_true.mean()) ** 2).sum())
        assert r["cv_r2"] == pytest.approx(np.mean(scores), abs=0.02)


def test_forecast_from_the_last_row(spark, table, tmp_path):
    modelling.fit_forecasters(table, str(tmp_path), (1, 3), params=TREES)
    out = modelling.forecast(table, str(tmp_path)).collect()
    assert len(out) == 4 and {(r["target_date"] - r["as_of"]).days for r in out} == {1, 3}
    assert {r["as_of"] for r in out} == {dt.date(2023, 1, 1) + dt.timedelta(259)}
    assert all((20 < r["price"] < 60) == (r["series_id"] == "a") for r in out)
    again = modelling.forecast(table.repartition(3), str(tmp_path)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_forecast_days_follow_the_rows(table, tmp_path):
    """Where rows go on behind the last complete one the target is a row's day, and beyond the end each day is a row."""
    modelling.fit_forecasters(table, str(tmp_path), (1, 3), params=TREES)
    last = dt.date(2023, 1, 1) + dt.timedelta(259)
    gap = table.where(F.col("d") != F.lit(last - dt.timedelta(1))).withColumn("lag1", F.when(F.col("d") != F.lit(last), F.col("lag1")))
    out = {(r["horizon"], r["as_of"], r["target_date"]) for r in modelling.forecast(gap, str(tmp_path)).collect()}
    assert out == {(1, last - dt.timedelta(2), last), (3, last - dt.timedelta(2), last + dt.timedelta(2))}
