from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, evaluate
from tidemark.plans import modelling
from tidemark.plans.dataset import PRICE
from tidemark.session import scratch_path
from tidemark.sources.profiles import append_profiles, read_profiles

SCHEMA = "exp string, model string, horizon int, fold int, split string, series_id string, d date, y_true double, y_pred double"


def table(spark, models, n=60, seed=3, split=None, ties=False):
    """Predictions of several models for one series; returns the frame and arrays."""
    rng = np.random.default_rng(seed)
    y = rng.normal(4, 0.3, n)
    out, arrays = [], {"y": y}
    for m, noise in models.items():
        p = y + rng.normal(0, noise, n)
        if ties:
            p = np.round(p, 1)
        arrays[m] = p
        for i in range(n):
            part = split or ("train" if i < n // 2 else "test")
            out.append(("E", m, 7, i % 4, part, "a", dt.date(2024, 1, 1) + dt.timedelta(i), float(y[i]), float(p[i])))
    return spark.createDataFrame(out, SCHEMA), arrays


def scores(y, p):
    y, p = np.exp(y), np.exp(p)
    e = y - p
    return {"r2": 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(), "rmse": math.sqrt((e**2).mean()), "mae": np.abs(e).mean(),
            "mape": np.abs(e / (y + 1e-6)).mean() * 100}


def test_metrics_in_both_spaces(spark):
    df, a = table(spark, {"M": 0.2})
    got = {r["split"]: r for r in evaluate.metrics(df).collect()}
    for name, part in (("train", slice(0, 30)), ("test", slice(30, 60))):
        for k, v in scores(a["y"][part], a["M"][part]).items():
            assert got[name][k] == pytest.approx(v)
    log = {r["split"]: r for r in evaluate.metrics(df, space="log").collect()}["test"]
    mae = np.abs(a["y"][30:] - a["M"][30:]).mean()
    assert log["mae"] == pytest.approx(mae) and log["npr_error"] == pytest.approx(52.86 * (math.exp(mae) - 1))
    with pytest.raises(ValueError, match="space"):
        evaluate.metrics(df, space="cube")


def test_r2_of_constant_target_and_missing_predictions(spark):
    base = ("E", "M", 7, 0, "test", "a", dt.date(2024, 1, 1))
    flat = spark.createDataFrame([(*base, 1.0, 1.0), (*base, 1.0, 2.0), (*base, 1.0, None)], SCHEMA)
    row = evaluate.metrics(flat).first()
    assert (row["n"], row["r2"]) == (2, 0.0)
    exact = spark.createDataFrame([(*base, 1.0, 1.0)] * 2, SCHEMA)
    assert evaluate.metrics(exact).first()["r2"] == 1.0
    assert evaluate.metrics(exact.limit(1)).first()["r2"] is None


def test_gap_and_grade(spark):
    df, a = table(spark, {"GOOD": 0.01, "BAD": 0.01})
    worse = df.withColumn("y_pred", F.when((F.col("model") == "BAD") & (F.col("split") == "test"), F.col("y_pred") + 0.4).otherwise(F.col("y_pred")))
    got = {r["model"]: r for r in evaluate.overfit_gap(worse).collect()}
    assert got["GOOD"]["grade"] == "good" and got["BAD"]["grade"] == "high"
    assert got["BAD"]["overfit_gap"] == pytest.approx(got["BAD"]["train_r2"] - got["BAD"]["test_r2"])
    assert [r["model"] for r in evaluate.summary(evaluate.overfit_gap(worse), exp="E").collect()] == ["GOOD", "BAD"]


def test_diebold_mariano(spark):
    df, a = table(spark, {"M": 0.1, "PERSISTENCE": 0.3})
    row = evaluate.diebold_mariano(df).first()
    t = slice(30, 60)
    loss = [(np.exp(a[m][t]) - np.exp(a["y"][t])) ** 2 for m in ("M", "PERSISTENCE")]
    diff = loss[0] - loss[1]
    stat = diff.mean() / (diff.std(ddof=1) / math.sqrt(len(diff)))
    assert row["n"] == 30 and row["dm_stat"] == pytest.approx(stat) and 0 < row["p_value"] < 0.05 and row["significant"]
    few = evaluate.diebold_mariano(df, min_dates=31).first()
    assert row["enough"] and (few["n"], few["enough"], few["dm_stat"], few["p_value"], few["significant"]) == (30, False, None, None, None)
    with pytest.raises(Exception, match="more than one row"):
        evaluate.diebold_mariano(df.unionByName(df.where("model = 'PERSISTENCE'"))).collect()


def test_walk_forward_summary(spark):
    df, a = table(spark, {"M": 0.2}, split="test")
    got = {r["fold"]: r for r in evaluate.walk_forward_summary(df).collect()}
    folds = [scores(a["y"][i::4], a["M"][i::4]) for i in range(4)]
    assert set(got) == {"Fold 0", "Fold 1", "Fold 2", "Fold 3", "Mean", "Std"}
    for k in ("r2", "mae", "mape"):
        xs = np.array([f[k] for f in folds])
        assert got["Fold 2"][k] == pytest.approx(xs[2]) and got["Mean"][k] == pytest.approx(xs.mean()) and got["Std"][k] == pytest.approx(xs.std())


def brute_auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("partitions", [1, 3, 16])
@pytest.mark.parametrize("ties", [False, True])
def test_auc_equals_counting_pairs(spark, partitions, ties):
    rng = np.random.default_rng(11)
    rows, want = [], {}
    for key, n in (("hot", 600), ("b", 40), ("c", 25)):
        label = (rng.random(n) < 0.2).astype(int)
        label[:2] = (0, 1)
        score = rng.normal(label, 1.0)
        score = np.round(score, 0 if ties else 9)
        want[key] = brute_auc(score, label)
        rows += [(key, float(s), int(v)) for s, v in zip(score, label)]
    rows += [("none", 1.0, 0), ("none", 2.0, 0), ("b", None, 1)]
    df = spark.createDataFrame(rows, "k string, s double, y int")
    got = {r["k"]: r["auc"] for r in evaluate.grouped_auc(df, "s", "y", ["k"], partitions).collect()}
    assert got.pop("none") is None and got == pytest.approx(want)


def test_spikes(spark):
    df, a = table(spark, {"M": 0.1}, n=200)
    row = evaluate.spike_report(df, sigma=0.5).first()
    price, pred = np.exp(a["y"]), np.exp(a["M"])
    threshold = price[:100].mean() + 0.5 * price[:100].std(ddof=1)
    truth, called = price[100:] > threshold, pred[100:] > threshold
    hit = (truth & called).sum()
    assert row["precision"] == pytest.approx(hit / called.sum()) and row["recall"] == pytest.approx(hit / truth.sum())
    assert row["f1"] == pytest.approx(2 * hit / (called.sum() + truth.sum()))
    assert row["auc"] == pytest.approx(brute_auc(pred[100:], truth.astype(int))) and row["few_shocks"] == (truth.sum() < 30)


def test_spikes_of_a_cheap_series_are_its_own(spark):
    df, a = table(spark, {"M": 0.1}, n=200)
    both = df.unionByName(df.withColumn("series_id", F.lit("dear")).withColumns({c: F.col(c) + 5 for c in ("y_true", "y_pred")}))
    each = {r["series_id"]: r["shocks"] for r in evaluate.spike_report(both, sigma=0.5).collect()}
    assert len(each) == 2 and len(set(each.values())) == 1
    pooled = evaluate.spike_labels(both, 0.5, evaluate.ID).groupBy("series_id").agg(F.sum("is_spike").alias("n")).collect()
    assert {r["series_id"]: r["n"] for r in pooled} != each


def test_missing_prediction_is_no_spike_and_undefined_scores_are_zero(spark):
    df, _ = table(spark, {"M": 0.1})
    blank = df.withColumn("y_pred", F.lit(None).cast("double"))
    row = evaluate.spike_prf(evaluate.spike_labels(blank, sigma=0.5)).first()
    assert (row["n"], row["precision"], row["recall"], row["f1"]) == (30, 0.0, 0.0, 0.0)
    none = evaluate.spike_report(df, sigma=50).first()
    assert (none["shocks"], none["recall"], none["auc"]) == (0, 0.0, None)


def test_subsets(spark):
    df, a = table(spark, {"M": 0.2})
    flags = df.where(F.dayofmonth("d") <= 15).select("series_id", "d", F.lit(1).alias("disruption_flag")).distinct()
    got = {r["subset"]: r["n"] for r in evaluate.subset_metrics(df, flags).collect()}
    test_days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(30, 60)]
    on = sum(d.day <= 15 for d in test_days)
    assert got == {"All test dates": 30, "Disruption dates": on, "Non-disruption dates": 30 - on}
    few = {r["subset"]: (r["enough"], r["mae"] is None) for r in evaluate.subset_metrics(df, flags, min_rows=16).collect()}
    assert few == {"All test dates": (True, False), "Disruption dates": (False, True), "Non-disruption dates": (False, True)}


def test_residuals(spark):
    df, a = table(spark, {"M": 0.2}, split="test")
    row = evaluate.residual_stats(df).first()
    r = np.exp(a["y"]) - np.exp(a["M"])
    assert row["residual_mean"] == pytest.approx(r.mean()) and row["residual_std"] == pytest.approx(r.std())


def test_persistence_is_two_horizons_old(spark):
    x = [0.5, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(i), v) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, f"series_id string, d date, {PRICE} double")
    pred = modelling.persistence(df, horizons=(2,)).orderBy("d").collect()
    assert len(pred) == 8 and [r["split"] for r in pred] == ["train"] * 6 + ["test"] * 2
    assert [r["y_true"] for r in pred] == pytest.approx([math.log(v) for v in x[2:]])
    assert [r["y_pred"] for r in pred][:2] == [None, None]
    assert [r["y_pred"] for r in pred][2:] == pytest.approx([math.log(max(v, 1)) for v in x[:6]])
    last = modelling.persistence(df, horizons=(2,), anchor="last").orderBy("d").collect()
    assert [r["y_pred"] for r in last] == pytest.approx([math.log(max(v, 1)) for v in x[:8]])


def test_psi(spark):
    rng = np.random.default_rng(5)
    frame = lambda x: spark.createDataFrame([(float(v), float(w)) for v, w in zip(x, rng.normal(size=len(x)))], "a double, b double")
    ref, cur = rng.normal(0, 1, 1000), rng.normal(1, 1, 1000)
    got = {r["feature"]: r for r in drift.psi(frame(ref), frame(cur), ["a", "b"]).collect()}
    edges = np.sort(ref)[[math.ceil(len(ref) * k / 10) - 1 for k in range(1, 10)]]
    share = lambda x: np.maximum(np.bincount(np.searchsorted(edges, x, side="left"), minlength=10) / len(x), 1e-4)
    want = ((share(cur) - share(ref)) * np.log(share(cur) / share(ref))).sum()
    assert got["a"]["psi"] == pytest.approx(want) and got["a"]["drift"] and not got["b"]["drift"]


def test_rolling_mae(spark):
    df, a = table(spark, {"M": 0.2}, n=80)
    got = drift.rolling_mae(df, days=5).orderBy("d").collect()
    err = np.abs(np.exp(a["y"]) - np.exp(a["M"]))
    want = [err[max(40, i - 4): i + 1].mean() for i in range(40, 80)]
    assert [r["rolling_mae"] for r in got] == pytest.approx(want) and got[0]["train_mae"] == pytest.approx(err[:40].mean())


def test_stored_profiles(spark):
    cut, rng = dt.date(2024, 3, 10), np.random.default_rng(6)
    values = [(dt.date(2024, 1, 1) + dt.timedelta(k % 100), float(v), None) for k, v in enumerate(rng.integers(0, 50, 2000))]
    df = spark.createDataFrame([*values, (None, 3.0, 1.0)], "d date, a double, b double")
    target = scratch_path(spark, "profiles")
    wrong = df.where("a = 7").withColumn("a", F.lit(900.0))
    append_profiles(target, df.where("a <> 7").unionByName(wrong), ["a", "b"])
    append_profiles(target, df.where("a = 7"), ["a", "b"], old=wrong)  # a correction
    append_profiles(target, None, ["a", "b"], old=df.limit(0))  # nothing changes
    first, last = dt.date(2024, 1, 1), dt.date(2024, 4, 9)
    before, after = read_profiles(spark, target, first, cut - dt.timedelta(1)), read_profiles(spark, target, cut, last)
    got = drift.psi_against(drift.reference(before), after).collect()
    want = drift.psi(df.where(F.col("d") < cut), df.where(F.col("d") >= cut), ["a", "b"]).collect()
    assert [r["feature"] for r in got] == ["a"] == [r["feature"] for r in want] and got[0]["psi"] == pytest.approx(want[0]["psi"])
    assert read_profiles(spark, target, first, last).agg(F.max("value")).first()[0] < 50
    one = read_profiles(spark, target, last, last)
    files = one.inputFiles()
    assert len({f.split("_place=")[1].split("/")[0] for f in files}) == 1
    empty = drift.psi_against(drift.reference(before), before.limit(0)).collect()
    assert [tuple(r) for r in empty] == [("a", None, None)]
