from __future__ import annotations

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import day
from tidemark import fixed
from tidemark.operators import events, features, report, shaping
from tidemark.plans import dataset
from tidemark.plans.dataset import PRICE, SUPPLY

D0 = dt.date(2024, 1, 1)


def at(i):
    return D0 + dt.timedelta(i)


@pytest.fixture(scope="module")
def quotes(spark):
    rows = [
        ("01/01/2024", "गोलभेडा ठूलो(नेपाली)", "रू ४०"), ("01/01/2024", "गोलभेडा सानो(टनेल)", "रू २०"), ("01/01/2024", "आलु", "9"),
        ("01/03/2024", "गोलभेडा", "1,000.5"), ("01/03/2024", "गोलभेडा", "x"), ("13/45/2024", "गोलभेडा", "7"), ("01/04/2024", "गोलभेडा", ""),
    ]
    return spark.createDataFrame(rows, "`Date` string, `कृषि उपज` string, `औसत` string")


def test_price_rows(quotes):
    price = dataset.daily_price(dataset.quote_rows(quotes), keys=())
    assert sorted(map(tuple, price.collect())) == [(day("2024-01-01"), 30.0), (day("2024-01-03"), 1000.5)]


def test_supply_of_missing_values_is_zero(quotes):
    raw = quotes.withColumnRenamed("औसत", "आगमन")
    supply = dataset.daily_supply(dataset.quote_rows(raw, fixed.SUPPLY_COLUMNS), keys=())
    assert sorted(map(tuple, supply.collect())) == [(day("2024-01-01"), 60.0), (day("2024-01-03"), 1000.5), (day("2024-01-04"), 0.0)]


def keyed(spark, days, name, value=float):
    return spark.createDataFrame([("a", at(i), value(v)) for i, v in days.items()], f"series_id string, d date, {name} double")


def daily(spark, days, name):
    return spark.createDataFrame([(at(i), v) for i, v in days.items()], f"d date, {name} double")


def values(df, col):
    return [r[col] for r in df.orderBy("d").collect()]


def test_values_on_days_without_a_price_are_lost(spark):
    price = keyed(spark, {0: 10, 2: 12}, PRICE)
    rate = daily(spark, {1: 5.0, 2: 6.0}, "Diesel")
    after = shaping.merge_sources(price, [rate])
    before = shaping.merge_sources(price, [rate], densify_when="before")
    assert values(after, "Diesel") == [None, None, 6.0]
    assert values(before, "Diesel") == [None, 5.0, 6.0]
    assert values(dataset.base_dataset(price, [rate]), "Diesel") == [6.0, 6.0, 6.0]


def test_repeated_daily_keys_raise(spark):
    price = keyed(spark, {0: 10, 2: 12}, PRICE)
    rate = daily(spark, {0: 5.0}, "Diesel")
    with pytest.raises(PySparkException, match="more than one row"):
        shaping.merge_sources(price, [rate.union(rate)]).collect()
    with pytest.raises(PySparkException, match="more than one row"):
        shaping.merge_sources(price.union(price), [rate]).collect()


def test_empty_source_keeps_its_columns(spark):
    price = keyed(spark, {0: 10, 1: 11}, PRICE)
    out = dataset.base_dataset(price, [daily(spark, {0: 1.0}, "Inflation").limit(0)])
    assert values(out, "Inflation") == [None, None]


@pytest.fixture(scope="module")
def sources(spark):
    price = keyed(spark, {0: 10, 3: 40, 4: 41}, PRICE).join(keyed(spark, {0: 1, 4: 9}, SUPPLY), ["series_id", "d"], "left")
    weather = spark.createDataFrame(
        [(at(0), None, 1.0, None), (at(3), 6.0, None, 5.0)], "d date, K_Temperature double, K_Rainfall_MM double, K_Precipitation double"
    )
    return price, [daily(spark, {3: 7.0}, "Diesel"), weather, daily(spark, {3: 0.4}, "Kavre_Risk")]


def test_cloud_fills(sources):
    out = dataset.base_dataset(*sources, "cloud")
    assert values(out, PRICE) == [10, 10, 10, 40, 41]
    assert values(out, SUPPLY) == [1, 3, 5, 7, 9]
    assert values(out, "Diesel") == [7.0] * 5
    assert values(out, "K_Temperature") == [6.0] * 5
    assert values(out, "K_Rainfall_MM") == [1, 0, 0, 0, 0] and values(out, "K_Precipitation") == [0, 0, 0, 5, 0]
    assert values(out, "Kavre_Risk") == [0, 0, 0, 0.4, 0]


def test_local_fills(sources):
    out = dataset.base_dataset(*sources, "local")
    assert values(out, SUPPLY) == [1, 1, 1, 1, 9]
    assert values(out, "Diesel") == [None, None, None, 7.0, 7.0]
    assert values(out, "K_Temperature") == [None, None, None, 6.0, None]
    assert values(out, "K_Rainfall_MM") == [1, 0, 0, 0, 0] and values(out, "K_Precipitation") == [None, None, None, 5, None]


def test_clean_weather_variants(spark):
    rows = [(at(0), None, 1.0, None), (at(1), 2.0, None, 3.0), (at(3), None, None, None), (at(4), 8.0, 2.0, None), (at(5), None, None, 1.0)]
    df = spark.createDataFrame(list(reversed(rows)), "d date, K_temperature double, K_rain double, K_precipitation double")
    cloud, local = dataset.clean_weather(df), dataset.clean_weather(df, variant="local")
    assert values(cloud, "K_temperature") == [None, 2.0, 5.0, 8.0, 8.0] and values(local, "K_temperature") == [None, 2.0, 2.0, 8.0, 8.0]
    assert values(cloud, "K_precipitation") == [0, 3, 0, 0, 1] and values(local, "K_precipitation") == [None, 3, None, None, 1]


def test_nonpositive_prices_make_lags_positional(spark):
    base = keyed(spark, {0: 10, 1: 0, 2: 12, 3: 13}, PRICE).withColumn(SUPPLY, F.lit(1.0)).withColumn("unit", F.lit(1))
    out = features.lags(dataset.model_base(base), PRICE, [1])
    assert values(out, PRICE) == [10, 12, 13] and values(out, "lag1") == [None, 10, 12] and "unit" not in out.columns


def test_ts_dataset_against_pandas(spark):
    n = 40
    price = [50 + 10 * math.sin(i) for i in range(n)]
    base = keyed(spark, dict(enumerate(price)), PRICE).withColumn("Diesel", F.when(F.col("d") > F.lit(at(20)), 1.0))
    got = dataset.ts_dataset(base).orderBy("d").toPandas()
    x = pd.Series(price)
    want = pd.DataFrame({
        "price_lag7": x.shift(7), "price_roll_mean_3": x.shift(1).rolling(3).mean(), "price_roll_std_7": x.shift(1).rolling(7).std(),
    }).iloc[7:].reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns.tolist()], want, rtol=1e-9)
    assert "is_weekend" in got and len(got) == n - 7
    local = dataset.ts_dataset(base, "local")
    assert "is_weekend" not in local.columns and local.count() == n - 21


def test_daily_event_risk(spark):
    ev = spark.createDataFrame(
        [(at(0), "Kavre", 3), (at(0), "Kavre", 5), (at(2), "Sarlahi", 1), (at(1), "Elsewhere", 5), (None, "Kavre", 5), (at(9), "Kavre", None)],
        "Date date, District string, Severity int",
    )
    out = events.daily_event_risk(ev).orderBy("d").collect()
    assert [r["d"] for r in out] == [at(0), at(1), at(2)]
    assert [r["Kavre_Risk"] for r in out] == [1.0, 0.0, 0.0] and [r["Dhading_Risk"] for r in out] == [0.0] * 3
    assert [r["Market_Risk"] for r in out] == pytest.approx([0.2, 0.0, 0.08])


def test_disruption_features(spark):
    df = spark.createDataFrame([(0.0, 0.4, 0.0, 0.16), (0.0, 0.0, 0.0, 0.0), (1.0, 0.2, None, 0.23)],
                               "Kathmandu_Risk double, Sarlahi_Risk double, Dhading_Risk double, Market_Risk double")
    out = features.disruption_features(df).collect()
    assert [r["disruption_flag"] for r in out] == [1, 0, 1] and [r["active_disruption_count"] for r in out] == [1, 0, 2]
    assert [r["max_severity"] for r in out] == [0.4, 0.0, 1.0]
    assert [r["weighted_route_blockage"] for r in out] == pytest.approx([0.4, 0.0, 0.55])


def test_news_to_events(spark):
    items = spark.createDataFrame(
        [("Major flood in Dhading", "u1", "s", dt.datetime(2024, 1, 2, 23, 0), "none"), ("Market opens", "u2", "s", None, "road closed near Kavre, killed"),
         ("Flood in Pokhara", "u3", "s", dt.datetime(2024, 1, 3), "x")],
        "title string, url string, source string, published_at timestamp_ntz, body string",
    )
    title = events.news_records(items, "2024-01-01", "2024-02-01").orderBy("url").collect()
    assert [(r["district"], r["event_type"], r["severity"], str(r["date"])) for r in title] == [
        ("Dhading", "Flood", 3, "2024-01-02"), (None, None, None, "None"), (None, "Flood", 2, "2024-01-03")]
    assert str(title[0]["window_end"]) == "2024-01-31"
    body = events.news_records(items, "2024-01-01", "2024-02-01", body="body", tiers=fixed.SEVERITY_WORDS_LOCAL).orderBy("url").collect()
    assert (body[1]["district"], body[1]["event_type"], body[1]["severity"]) == ("Kavre", "Road_Block", 4)
    kept = events.district_events(events.news_records(items, "2024-01-01", "2024-02-01")).collect()
    assert [tuple(r) for r in kept] == [(day("2024-01-02"), "Dhading", "Flood", 3)]


def test_keyword_query(spark):
    df = spark.createDataFrame([(day("2024-01-01"), day("2024-01-11"))], "window_start date, window_stop date")
    text = events.keyword_query(df, ["A", "B"], {"x": ["zeta", "alpha"], "y": ["alpha"]}, ["s.example"]).first()["query"]
    assert text == '("A" OR "B") ("alpha" OR "zeta") (site:s.example) Nepal after:2024-01-01 before:2024-01-11'


def test_quality_report(spark):
    df = keyed(spark, {0: 1, 1: 2}, "x").union(keyed(spark, {1: 2}, "x")).withColumn("y", F.when(F.col("x") > 1, F.col("x")))
    got = {(r["item"], r["column_name"]): r["value"] for r in report.quality_report(df).collect()}
    assert got == {("rows", ""): "3", ("columns", ""): "4", ("repeated_rows", ""): "1", ("first_date", "d"): "2024-01-01",
                   ("last_date", "d"): "2024-01-02", ("nulls", "y"): "1"}


def test_correlation_skips_incomplete_pairs_and_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 1.0), (3.0, None, 1.0), (4.0, 7.0, 1.0)], "a double, b double, c double")
    got = {(r["a"], r["b"]): r["corr"] for r in report.corr_matrix(df, ["a", "b", "c"], digits=None).collect()}
    pdf = pd.DataFrame({"a": [1, 2, 4], "b": [2.0, 4, 7]})
    assert got["a", "b"] == pytest.approx(pdf.corr().loc["a", "b"]) and got["a", "c"] is None and got["a", "a"] == pytest.approx(1)


def test_season_ttest(spark):
    base = keyed(spark, {i: 10 + (i % 7) + (3 if at(i).month in (6, 7, 8, 9) else 0) for i in range(366)}, PRICE)
    row = {r["period"]: r for r in report.season_ttest(base, PRICE).collect()}["Monsoon (Jun-Sep)"]
    x = pd.Series([r[PRICE] for r in base.orderBy("d").collect()])
    inside = pd.Series([at(i).month in (6, 7, 8, 9) for i in range(366)])
    a, b = x[inside], x[~inside]
    pooled = ((len(a) - 1) * a.var() + (len(b) - 1) * b.var()) / (len(x) - 2)
    t = (a.mean() - b.mean()) / math.sqrt(pooled * (1 / len(a) + 1 / len(b)))
    assert row["t_stat"] == pytest.approx(t) and row["significant"] and row["premium_pct"] == pytest.approx((a.mean() / b.mean() - 1) * 100)


def test_search_variant_of_the_features(spark):
    base = keyed(spark, {i: 10 + i % 5 for i in range(400)}, PRICE)
    out = features.model_features(base, PRICE, variant="search")
    missing = [f for f in fixed.SEARCH_FEATURES if f not in out.columns]
    assert set(missing) == {"Supply_Volume", "USD_TO_NPR", "Diesel", "Inflation", "Sarlahi_Rainfall_MM", "Dhading_Rainfall_MM", "Kathmandu_Rainfall_MM", "Market_Risk"}
    november = out.where(F.month("d") == 11)
    assert november.agg(F.min("is_terai_harvest")).first()[0] == 1
    assert features.model_features(base, PRICE).where(F.month("d") == 11).agg(F.max("is_terai_harvest")).first()[0] == 0
