from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import day
from tidemark.operators import fill, series, shaping

START = dt.date(2024, 1, 1)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def gappy(spark):
    """Three series with gaps, as Spark and pandas tables on a closed calendar."""
    rng = np.random.default_rng(7)
    pdfs = []
    for key, n in (("a", 60), ("b", 41), ("c", 1)):
        x = rng.normal(100, 20, n)
        x[rng.random(n) < 0.3] = np.nan
        pdfs.append(pd.DataFrame({"series_id": key, "d": [START + dt.timedelta(i) for i in range(n)], "x": x}))
    pdf = pd.concat(pdfs, ignore_index=True)
    rows = [(r.series_id, r.d, None if np.isnan(r.x) else float(r.x)) for r in pdf.itertuples()]
    return spark.createDataFrame(rows, "series_id string, d date, x double"), pdf


def by_series(df, col):
    got = {}
    for r in df.orderBy("series_id", "d").collect():
        got.setdefault(r["series_id"], []).append(np.nan if r[col] is None else r[col])
    return got


def check(df, col, pdf, fn):
    got = by_series(df, col)
    for key, part in pdf.groupby("series_id"):
        np.testing.assert_allclose(got[key], fn(part["x"]).to_numpy(dtype=float), rtol=1e-9, atol=1e-9, equal_nan=True)


@pytest.mark.parametrize("k", [1, 3, 7, 28])
def test_lags(gappy, k):
    df, pdf = gappy
    check(series.lags(df, "x", [k]), f"lag{k}", pdf, lambda x: x.shift(k))


@pytest.mark.parametrize(("fn", "w"), [("mean", 3), ("mean", 7), ("std", 7), ("max", 7), ("min", 7)])
def test_rolling_needs_all_rows(gappy, fn, w):
    df, pdf = gappy
    check(series.rolling(df, "x", {"y": (w, fn)}), "y", pdf, lambda x: getattr(x.shift(1).rolling(w), fn)())


def test_rolling_range(gappy):
    df, pdf = gappy
    roll = lambda x: x.shift(1).rolling(7)
    check(series.rolling(df, "x", {"y": (7, "range")}), "y", pdf, lambda x: roll(x).max() - roll(x).min())


def test_log_lead(gappy):
    df, pdf = gappy
    check(series.leads_log(df, "x", [2]), "target_h2", pdf, lambda x: np.log(x.shift(-2)))


def test_log_lead_of_nonpositive_is_null(frame):
    df = frame("series_id string, d date, x double", [("a", day("2024-01-01"), 1.0), ("a", day("2024-01-02"), 0.0), ("a", day("2024-01-03"), -1.0)])
    assert by_series(series.leads_log(df, "x", [1]), "target_h1")["a"] == pytest.approx([np.nan] * 3, nan_ok=True)


@pytest.mark.parametrize(
    ("strategy", "fn"),
    [
        ("ffill", lambda x: x.ffill()),
        ("bfill", lambda x: x.bfill()),
        ("ffill_bfill", lambda x: x.ffill().bfill()),
        ("interpolate", lambda x: x.interpolate()),
        ("interpolate_fill", lambda x: x.interpolate().ffill().bfill()),
        ("zero", lambda x: x.fillna(0)),
        ("keep", lambda x: x),
    ],
)
def test_fills(gappy, strategy, fn):
    df, pdf = gappy
    check(fill.fill(df, {"x": strategy}), "x", pdf, fn)


def test_fill_keeps_columns_and_rejects_unknown(gappy):
    df, _ = gappy
    assert fill.fill(df.withColumn("z", F.lit(1)), {"x": "ffill"}).columns == ["series_id", "d", "x", "z"]
    with pytest.raises(ValueError, match="unknown strategy"):
        fill.fill(df, {"x": "guess"})


def test_interpolation_counts_rows_not_days(frame):
    df = frame("series_id string, d date, x double", [("a", day("2024-01-01"), 0.0), ("a", day("2024-01-02"), None), ("a", day("2024-01-11"), 10.0)])
    assert by_series(fill.interpolate(df, ["x"]), "x")["a"] == [0.0, 5.0, 10.0]


@SLOW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), unique=True, min_size=1, max_size=25))
def test_densify_properties(frame, cells):
    df = frame("series_id string, d date, x double", [(k, START + dt.timedelta(i), float(i)) for k, i in cells])
    dense = series.densify(df)
    got = dense.collect()
    for key in {k for k, _ in cells}:
        days = sorted(i for k, i in cells if k == key)
        mine = sorted((r["d"], r["x"]) for r in got if r["series_id"] == key)
        assert [d for d, _ in mine] == [START + dt.timedelta(i) for i in range(days[0], days[-1] + 1)]
        assert [x for _, x in mine if x is not None] == [float(i) for i in days]
    assert sorted(map(tuple, series.densify(dense).fillna(-1.0).collect())) == sorted(map(tuple, dense.fillna(-1.0).collect()))
    missing = {(r["series_id"], r["d"]) for r in series.missing_days(df).collect()}
    assert missing == {(r["series_id"], r["d"]) for r in got if r["x"] is None}


def test_densify_rejects_repeated_days(frame):
    twice = frame("series_id string, d date, x double", [("a", START, 1.0), ("a", START, 2.0)])
    with pytest.raises(PySparkException, match="more than one row"):
        series.densify(twice).collect()
    with pytest.raises(PySparkException, match="more than one row"):
        series.densify(twice.drop("series_id"), keys=()).collect()


def test_densify_without_keys(frame):
    df = frame("d date, x double", [(day("2024-01-03"), 3.0), (day("2024-01-01"), 1.0), (None, 9.0)])
    got = [tuple(r) for r in series.densify(df, keys=()).orderBy("d").collect()]
    assert got == [(day("2024-01-01"), 1.0), (day("2024-01-02"), None), (day("2024-01-03"), 3.0)]


def test_window_without_keys_is_refused():
    with pytest.raises(ValueError, match="key columns"):
        series.by_day(())


def test_step_to_daily(frame):
    df = frame("series_id string, d date, v double", [
        ("a", day("2021-12-30"), 1.0), ("a", day("2022-01-03"), 2.0), ("a", day("2022-01-05"), 3.0), ("a", day("2022-02-01"), 9.0),
        ("b", day("2022-01-06"), 5.0), ("b", day("2022-01-07"), None), ("c", day("2022-01-07"), 6.0),
    ])
    got = sorted(map(tuple, series.step_to_daily(df, "v", "2022-01-07", start="2022-01-01").collect()))
    # the value in force on the first of January is lost, days end the day before
    assert got == [("a", day("2022-01-03"), 2.0), ("a", day("2022-01-04"), 2.0), ("a", day("2022-01-05"), 3.0), ("a", day("2022-01-06"), 3.0), ("b", day("2022-01-06"), 5.0)]


def test_extend_monthly(frame):
    df = frame("series_id string, d date, v double", [("a", day("2024-01-01"), 1.0), ("a", day("2024-02-01"), 2.0), ("b", day("2024-04-30"), 7.0), ("c", day("2024-05-01"), 8.0)])
    got = sorted(map(tuple, series.extend_monthly(df, "v", "2024-05-01").collect()))
    assert got == [
        ("a", day("2024-01-01"), 1.0), ("a", day("2024-02-01"), 2.0), ("a", day("2024-03-01"), 2.0), ("a", day("2024-04-01"), 2.0),
        ("a", day("2024-05-01"), 2.0), ("b", day("2024-04-30"), 7.0), ("b", day("2024-05-01"), 7.0), ("c", day("2024-05-01"), 8.0),
    ]


def test_month_windows(frame):
    df = frame("start date, end date", [(day("2023-11-15"), day("2024-01-10"))])
    got = [tuple(r) for r in series.month_windows(df).orderBy("window_start").collect()]
    assert got == [
        (day("2023-11-01"), day("2023-12-01"), day("2023-11-30")), (day("2023-12-01"), day("2024-01-01"), day("2023-12-31")),
        (day("2024-01-01"), day("2024-01-11"), day("2024-01-10")),
    ]


@pytest.mark.parametrize(("n", "splits", "gap"), [(60, 5, 0), (60, 5, 7), (23, 4, 2), (11, 3, 0)])
def test_time_folds(frame, n, splits, gap):
    df = frame("series_id string, d date", [("a", START + dt.timedelta(i)) for i in range(n)])
    size = n // (splits + 1)
    got = {}
    for r in series.ts_folds(df, splits, gap).collect():
        got.setdefault((r["fold"], r["role"]), []).append(r["row_no"] - 1)
    for fold in range(1, splits + 1):
        start = n - (splits + 1 - fold) * size
        assert sorted(got[fold, "test"]) == list(range(start, start + size))
        assert sorted(got[fold, "train"]) == list(range(start - gap))


def test_chrono_split_per_series(frame):
    df = frame("series_id string, d date", [(k, START + dt.timedelta(i)) for k, n in (("a", 10), ("b", 7)) for i in range(n)])
    got = {}
    for r in series.chrono_split(df).collect():
        got.setdefault((r["series_id"], r["split"]), []).append(r["d"])
    assert {k: len(v) for k, v in got.items()} == {("a", "train"): 8, ("a", "test"): 2, ("b", "train"): 5, ("b", "test"): 2}
    assert max(got["a", "train"]) < min(got["a", "test"])


def test_series_do_not_see_each_other(gappy):
    df, _ = gappy
    specs = {"m": (7, "mean"), "s": (3, "std")}
    whole = series.rolling(fill.fill(df, {"x": "interpolate_fill"}), "x", specs).where(F.col("series_id") == "a")
    alone = series.rolling(fill.fill(df.where(F.col("series_id") == "a"), {"x": "interpolate_fill"}), "x", specs)
    key = lambda r: r["d"]
    assert sorted(whole.collect(), key=key) == sorted(alone.collect(), key=key)


def test_daily_agg_sums_missing_to_zero(frame):
    df = frame("series_id string, d date, p double, q double", [("a", START, 1.0, None), ("a", START, 3.0, None), ("a", None, 9.0, 9.0)])
    out = shaping.daily_agg(df, {"p": ("p", "mean"), "q": ("q", "sum0"), "m": ("p", "max")})
    assert [tuple(r) for r in out.collect()] == [("a", START, 2.0, 0.0, 3.0)]


def test_drop_nonpositive_keeps_missing(frame):
    out = shaping.drop_nonpositive(frame("x double", [(1.0,), (0.0,), (-1.0,), (None,)]), "x")
    assert sorted((r[0] for r in out.collect()), key=str) == [1.0, None]


def test_pivot_gives_absent_columns(frame):
    df = frame("d date, k string, v double", [(START, "A", 1.0), (START, "A", 2.0), (START, "Z", 9.0)])
    out = shaping.pivot_fixed(df, ["d"], "k", ["A", "B"], "v", "_Risk")
    assert [r.asDict() for r in out.collect()] == [{"d": START, "A_Risk": 2.0, "B_Risk": 0.0}]


def test_outer_merge_equals_long_form(frame):
    df = frame("loc string, d date, t double, r double", [("A", day("2024-01-01"), 1.0, 2.0), ("B", day("2024-01-02"), 3.0, None), ("A", day("2024-01-02"), 5.0, 6.0)])
    frames = {k: df.where(F.col("loc") == k).drop("loc") for k in "AB"}
    wide = shaping.outer_merge(frames)
    long = shaping.widen_locations(df, "loc", ["A", "B"], ["t", "r"])
    assert wide.columns == long.columns == ["d", "A_t", "A_r", "B_t", "B_r"]
    assert sorted(map(str, wide.collect())) == sorted(map(str, long.collect()))


def test_lookup_label(frame):
    df = frame("f string", [("lag1",), ("x",), (None,)])
    assert [r[0] for r in df.select(shaping.lookup_label(F.col("f"), {"Lag": ["lag1"], "Also": ["lag1", "y"]})).collect()] == ["Lag", "Other", "Other"]


def test_a_day_must_be_a_date(spark):
    df = spark.sql("SELECT 'a' AS series_id, timestamp_ntz'2024-01-01 10:00:00' AS d, 1.0D AS x")
    for operator in (series.densify, series.missing_days):
        with pytest.raises(ValueError, match="must be a date"):
            operator(df)
