"""Daily tables: aggregation, calendar, fills, windows, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.rows import row_mean
from tidemark.operators import events, features, fill, series, shaping
from tidemark.operators.series import chrono_split, densify
from tidemark.plans import dataset, modelling, roles
from tidemark.plans.catalog import sql as S
from tidemark.plans.catalog.registry import query
from tidemark.plans.dataset import PRICE, SUPPLY
from tidemark.session import settle


def dense(spark, sf):
    return densify(roles.daily_quotes(spark, sf))


def filled(spark, sf):
    """Closed calendar with the price carried forward."""
    daily = roles.daily_quotes(spark, sf).select("series_id", "d", PRICE)
    return fill.ffill(densify(daily), [PRICE])


def model_table(spark, sf):
    base = dataset.model_base(roles.base_table(spark, sf))
    return features.model_features(base, PRICE, shares=roles.RISK_WEIGHTS)


@query("daily_price", f"WITH {S.QUOTES} SELECT series_id, d, avg(price) AS price FROM quotes "
       "WHERE d IS NOT NULL AND price IS NOT NULL GROUP BY 1, 2", "price")
def _(spark, sf):
    return dataset.daily_price(roles.quotes(spark, sf), "price")


@query("daily_supply", f"WITH {S.QUOTES} SELECT series_id, d, coalesce(sum(CASE WHEN qty > 25 THEN qty END), 0) AS qty "
       "FROM quotes WHERE d IS NOT NULL GROUP BY 1, 2", "qty")
def _(spark, sf):
    rows = roles.quotes(spark, sf).withColumn("qty", F.when(F.col("qty") > 25, F.col("qty")))
    return dataset.daily_supply(rows, "qty")


@query("densify_calendar", f"WITH {S.DENSE} SELECT series_id, d, Average_Price, Supply_Volume FROM dense",
       "Average_Price Supply_Volume")
def _(spark, sf):
    return dense(spark, sf)


@query("missing_days", f"WITH {S.DAILY}, {S.CAL} SELECT series_id, d FROM cal ANTI JOIN daily USING (series_id, d)")
def _(spark, sf):
    return series.missing_days(roles.daily_quotes(spark, sf))


@query("ffill", f"WITH {S.FILLED} SELECT series_id, d, Average_Price FROM filled", "Average_Price")
def _(spark, sf):
    return filled(spark, sf)


_LATE = "CASE WHEN d >= DATE '1995-03-01' THEN Supply_Volume END"


@query("ffill_bfill", f"WITH {S.DENSE}, late AS (SELECT series_id, d, {_LATE} AS x FROM dense) "
       f"SELECT series_id, d, {S.both('x')} AS x FROM late", "x")
def _(spark, sf):
    x = F.when(F.col("d") >= F.lit("1995-03-01").cast("date"), F.col(SUPPLY)).alias("x")
    return fill.fill(dense(spark, sf).select("series_id", "d", x), {"x": "ffill_bfill"})


_GAPPY = "CASE WHEN d BETWEEN DATE '1995-03-01' AND DATE '2001-06-30' THEN Supply_Volume END"


@query("interpolate_linear", f"WITH {S.DENSE}, gappy AS (SELECT series_id, d, pos, {_GAPPY} AS x FROM dense) "
       f"SELECT series_id, d, {S.line('x')} AS x FROM gappy", "x")
def _(spark, sf):
    inside = F.col("d").between(F.lit("1995-03-01").cast("date"), F.lit("2001-06-30").cast("date"))
    rows = dense(spark, sf).select("series_id", "d", F.when(inside, F.col(SUPPLY)).alias("x"))
    return fill.interpolate(rows, ["x"])


_LAGS = ", ".join(f"lag(Average_Price, {k}) OVER ({S.W}) AS lag{k}" for k in fixed.MODEL_LAGS)


@query("price_lags", f"WITH {S.FILLED} SELECT series_id, d, Average_Price, {_LAGS} FROM filled",
       "Average_Price " + " ".join(f"lag{k}" for k in fixed.MODEL_LAGS))
def _(spark, sf):
    return series.lags(filled(spark, sf), PRICE, fixed.MODEL_LAGS)


@query("complete_cases", f"WITH {S.FILLED}, l AS (SELECT series_id, d, {_LAGS} FROM filled) "
       "SELECT series_id, d, lag1, lag28 FROM l WHERE lag1 IS NOT NULL AND lag28 IS NOT NULL", "lag1 lag28")
def _(spark, sf):
    lagged = series.lags(filled(spark, sf), PRICE, (1, 28))
    return shaping.complete_cases(lagged).drop(PRICE)


_LEADS = ", ".join(
    f"CASE WHEN lead(Average_Price, {h}) OVER ({S.W}) > 0 THEN ln(lead(Average_Price, {h}) OVER ({S.W})) END AS target_h{h}"
    for h in fixed.HORIZONS
)


@query("targets_h1_h7", f"WITH {S.FILLED} SELECT series_id, d, {_LEADS} FROM filled",
       " ".join(f"target_h{h}" for h in fixed.HORIZONS))
def _(spark, sf):
    return series.leads_log(filled(spark, sf), PRICE, fixed.HORIZONS).drop(PRICE)


def _rolling(name, specs, fns):
    cols = ", ".join(f"{S.rolled('Average_Price', w, fns[fn])} AS {n}" for n, (w, fn) in specs.items())

    @query(name, f"WITH {S.DENSE} SELECT series_id, d, {cols} FROM dense", " ".join(specs))
    def _(spark, sf):
        return series.rolling(dense(spark, sf), PRICE, specs).drop(PRICE, SUPPLY)


_rolling("rolling_mean", {f"mean{w}": (w, "mean") for w in (3, 7, 14, 21, 30)}, {"mean": "avg"})
_rolling("rolling_std", {f"std{w}": (w, "std") for w in (7, 14, 21)}, {"std": "stddev_samp"})
_rolling("rolling_range", {"range7": (7, "range")}, {"range": "range"})


@query("chrono_split", f"""WITH {S.FILLED}, n AS (SELECT series_id, d, row_number() OVER ({S.W}) AS pos,
  count(*) OVER (PARTITION BY series_id) AS n FROM filled)
  SELECT series_id, d, CASE WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM n""")
def _(spark, sf):
    return chrono_split(filled(spark, sf)).drop(PRICE)


_FOLDS = " UNION ALL ".join(
    f"""SELECT series_id, d, {k} AS fold, pos + 1 AS row_no,
    CASE WHEN pos >= n - {6 - k} * (n // 6) AND pos < n - {6 - k} * (n // 6) + n // 6 THEN 'test'
         WHEN pos < n - {6 - k} * (n // 6) - 7 THEN 'train' END AS role FROM n"""
    for k in range(1, 6)
)


@query("ts_folds", f"""WITH {S.FILLED}, n AS (SELECT series_id, d, row_number() OVER ({S.W}) - 1 AS pos,
  count(*) OVER (PARTITION BY series_id) AS n FROM filled)
  SELECT series_id, d, CAST(fold AS INTEGER) AS fold, CAST(row_no AS INTEGER) AS row_no, role FROM ({_FOLDS}) WHERE role IS NOT NULL""")
def _(spark, sf):
    return series.ts_folds(filled(spark, sf), 5, 7).drop(PRICE)


_STEP = """steps AS (SELECT o_orderstatus AS series_id, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) AS value
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2)"""


def _steps(spark, sf):
    orders = roles.table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    rows = orders.select(F.col("o_orderstatus").alias("series_id"), F.to_date("o_orderdate").alias("d"), "o_totalprice")
    return shaping.daily_agg(rows, {"value": ("o_totalprice", "max")})


@query("step_to_daily", f"""WITH {_STEP}, kept AS (SELECT * FROM steps WHERE d >= DATE '1995-02-01'),
  run AS (SELECT *, lead(d) OVER (PARTITION BY series_id ORDER BY d) AS nxt FROM kept)
  SELECT series_id, CAST(unnest(generate_series(d, coalesce(nxt - 1, DATE '2001-12-31'), INTERVAL 1 DAY)) AS DATE) AS d, value
  FROM run""", "value")
def _(spark, sf):
    return series.step_to_daily(_steps(spark, sf), "value", "2002-01-01", start="1995-02-01")


_MONTHLY = """m AS (SELECT o_orderstatus AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS d,
  avg(o_totalprice) AS value FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2)"""


@query("extend_monthly", f"""WITH {_MONTHLY}, tail AS (SELECT series_id, max(d) AS d, arg_max(value, d) AS value FROM m GROUP BY 1)
  SELECT * FROM m UNION ALL
  SELECT series_id, CAST(unnest(generate_series(d + INTERVAL 1 MONTH, DATE '2002-06-15', INTERVAL 1 MONTH)) AS DATE), value
  FROM tail""", "value")
def _(spark, sf):
    orders = roles.table(spark, sf, "orders").where(F.col("o_orderpriority") != "5-LOW")
    month = F.trunc(F.to_date("o_orderdate"), "month").alias("d")
    rows = orders.select(F.col("o_orderstatus").alias("series_id"), month, "o_totalprice")
    monthly = shaping.daily_agg(rows, {"value": ("o_totalprice", "mean")})
    return series.extend_monthly(monthly, "value", "2002-06-15")


@query("month_windows", f"""WITH {S.DAILY}, span AS (SELECT series_id, min(d) AS a, max(d) AS b FROM daily GROUP BY 1),
  w AS (SELECT series_id, b, CAST(unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH)) AS DATE) AS window_start FROM span)
  SELECT series_id, window_start, least(CAST(window_start + INTERVAL 1 MONTH AS DATE), b + 1) AS window_stop,
    least(CAST(window_start + INTERVAL 1 MONTH AS DATE), b + 1) - 1 AS window_end FROM w""")
def _(spark, sf):
    span = roles.daily_quotes(spark, sf).groupBy("series_id").agg(F.min("d").alias("start"), F.max("d").alias("end"))
    return series.month_windows(span, keys=["series_id"])


@query("latest_value", f"WITH {S.DAILY} SELECT series_id, max(d) AS d, arg_max(Average_Price, d) AS Average_Price "
       "FROM daily GROUP BY 1", "Average_Price")
def _(spark, sf):
    return series.latest_value(roles.daily_quotes(spark, sf), PRICE)


@query("history_range", f"WITH {S.DAILY} SELECT series_id, d, Average_Price FROM daily "
       "WHERE d BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'", "Average_Price")
def _(spark, sf):
    daily = roles.daily_quotes(spark, sf).select("series_id", "d", PRICE)
    return dataset.history_range(daily, "1998-01-01", "1998-12-31")


_SPARSE = "SELECT * FROM daily LEFT JOIN steps USING (d) LEFT JOIN monthly USING (d)"


@query("merge_sources", f"WITH {S.DAILY}, {S.CAL}, {S.RATES}, j AS ({_SPARSE}) "
       "SELECT series_id, d, Average_Price, Diesel, Inflation FROM cal LEFT JOIN j USING (series_id, d)",
       "Average_Price Diesel Inflation")
def _(spark, sf):
    base = roles.daily_quotes(spark, sf).select("series_id", "d", PRICE)
    return shaping.merge_sources(base, [roles.step_changes(spark, sf), roles.monthly_rate(spark, sf)])


@query("merge_sources_before", f"WITH {S.DAILY}, {S.CAL}, {S.RATES} SELECT series_id, d, Average_Price, Diesel, Inflation "
       "FROM cal LEFT JOIN daily USING (series_id, d) LEFT JOIN steps USING (d) LEFT JOIN monthly USING (d)",
       "Average_Price Diesel Inflation")
def _(spark, sf):
    base = roles.daily_quotes(spark, sf).select("series_id", "d", PRICE)
    others = [roles.step_changes(spark, sf), roles.monthly_rate(spark, sf)]
    return shaping.merge_sources(base, others, densify_when="before")


_STATION = "SELECT d, Temperature AS {s}_Temperature, Rainfall_MM AS {s}_Rainfall_MM FROM stations WHERE location = '{s}'"


@query("outer_merge_locations", f"WITH {S.STATIONS} SELECT * FROM ({_STATION.format(s='A')}) "
       f"FULL JOIN ({_STATION.format(s='N')}) USING (d) FULL JOIN ({_STATION.format(s='R')}) USING (d)",
       " ".join(S.STATION_COLUMNS))
def _(spark, sf):
    rows = settle(roles.stations_long(spark, sf))
    return shaping.outer_merge({s: rows.where(F.col("location") == s).drop("location") for s in roles.STATIONS})


@query("widen_locations", f"WITH {S.STATIONS} SELECT * FROM wide", " ".join(S.STATION_COLUMNS))
def _(spark, sf):
    return roles.stations_wide(spark, sf)


@query("weather_aggregates", f"""WITH {S.STATIONS}, l AS (
  SELECT d, avg(Temperature) AS Temp_mean, stddev_samp(Temperature) AS Temp_std,
         avg(Rainfall_MM) AS Rainfall_mean, max(Rainfall_MM) AS Rainfall_max FROM stations GROUP BY d)
  SELECT * FROM wide JOIN l USING (d)""",
       " ".join(S.STATION_COLUMNS) + " Temp_mean Temp_std Rainfall_mean Rainfall_max")
def _(spark, sf):
    return features.weather_aggregates(roles.stations_wide(spark, sf))


@query("row_mean_skipnull", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount = 0 AND l_tax = 0 THEN NULL
  WHEN l_discount = 0 THEN l_tax WHEN l_tax = 0 THEN l_discount ELSE (l_discount + l_tax) / 2 END AS mid FROM lineitem""", "mid")
def _(spark, sf):
    items = roles.table(spark, sf, "lineitem")
    parts = [F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")]
    return items.select("l_orderkey", "l_linenumber", "l_partkey", row_mean(parts).alias("mid"))


@query("daily_risk_long", f"""WITH {S.EVENTS} SELECT d, district, max(severity / 5.0::DOUBLE) AS risk FROM risk_events
  WHERE district IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE') GROUP BY 1, 2""", "risk")
def _(spark, sf):
    return events.daily_risk(roles.risk_events(spark, sf), list(roles.RISK_WEIGHTS))


@query("risk_pivot", f"""WITH {S.EVENTS} SELECT d,
  {', '.join(f"coalesce(max(severity / 5.0::DOUBLE) FILTER (district = '{p}'), 0) AS {p}_Risk" for p in (*S.RISK, 'ATLANTIS'))}
  FROM risk_events GROUP BY d""", " ".join([*S.RISK_COLUMNS, "ATLANTIS_Risk"]))
def _(spark, sf):
    places = [*roles.RISK_WEIGHTS, "ATLANTIS"]
    rows = roles.risk_events(spark, sf).select(
        F.col("Date").alias("d"), F.col("District").alias("district"), events.severity_to_risk(F.col("Severity")).alias("risk")
    )
    return shaping.pivot_fixed(rows, ["d"], "district", places, "risk", "_Risk")


@query("market_risk", f"WITH {S.RISK_DAYS} SELECT * FROM risk", " ".join([*S.RISK_COLUMNS, "Market_Risk"]))
def _(spark, sf):
    return roles.event_risk(spark, sf)


@query("market_risk_long", f"WITH {S.RISK_DAYS} SELECT d, Market_Risk FROM risk SEMI JOIN risk_wide USING (d)", "Market_Risk")
def _(spark, sf):
    risk = events.daily_risk(roles.risk_events(spark, sf), list(roles.RISK_WEIGHTS))
    return events.market_risk_long(risk, roles.RISK_WEIGHTS)


_BLOCK = " + ".join(f"CAST({p}_Risk > 0 AS INTEGER) * {w}" for p, w in S.RISK.items())


@query("disruption_features", f"""WITH {S.RISK_DAYS} SELECT d, CAST(Market_Risk > 0 AS INTEGER) AS disruption_flag,
  CAST({' + '.join(f'CAST({c} > 0 AS INTEGER)' for c in S.RISK_COLUMNS)} AS INTEGER) AS active_disruption_count,
  greatest({', '.join(S.RISK_COLUMNS)}) AS max_severity, CAST({_BLOCK} AS DOUBLE) AS weighted_route_blockage FROM risk""",
       "max_severity weighted_route_blockage")
def _(spark, sf):
    df = features.disruption_features(roles.event_risk(spark, sf), roles.RISK_WEIGHTS)
    return df.drop(*S.RISK_COLUMNS, "Market_Risk")


@query("calendar_features", f"""WITH {S.DAILY} SELECT series_id, d, {S.DAY} AS day, {S.MONTH} AS month, {S.DOW} AS day_of_week,
  {S.WEEKEND} AS is_weekend, {S.MONTH_SIN} AS month_sin, {S.MONTH_COS} AS month_cos FROM daily""", "month_sin month_cos")
def _(spark, sf):
    return features.calendar_features(roles.daily_quotes(spark, sf).select("series_id", "d"))


@query("festival_flag", f"WITH {S.DAILY} SELECT series_id, d, {S.FESTIVAL} AS is_festival FROM daily")
def _(spark, sf):
    return features.festival_flag(roles.daily_quotes(spark, sf).select("series_id", "d"))


_SEASONS = ", ".join(f"{S.in_months(m)} AS {n}" for n, m in fixed.SEASON_MONTHS.items())


@query("season_flags", f"WITH {S.DAILY} SELECT series_id, d, {_SEASONS}, {S.WEEKS} AS weeks_to_dashain, "
       "day(d) / 30.0::DOUBLE AS month_progress FROM daily", "weeks_to_dashain month_progress")
def _(spark, sf):
    return features.season_flags(roles.daily_quotes(spark, sf).select("series_id", "d"))


def _feature_query(name, columns, doubles):
    @query(name, f"WITH {S.features()} SELECT series_id, d, {', '.join(columns)} FROM mf", " ".join(doubles))
    def _(spark, sf):
        return model_table(spark, sf).select("series_id", "d", *columns)


_feature_query("momentum", *[["momentum7", "momentum14", "momentum21", "accel"]] * 2)
_feature_query("price_position", *[["zscore14", "volatility7"]] * 2)
_feature_query("interactions", *[["mom7_x_monsoon", "mom7_x_festival"]] * 2)
_feature_query("model_features", S.MODEL_FEATURES, [f for f in S.MODEL_FEATURES if f not in S.INTEGER_FEATURES])


@query("base_dataset", f"WITH {S.base()} SELECT * FROM base", S.BASE_DOUBLES)
def _(spark, sf):
    return roles.base_table(spark, sf)


@query("base_dataset_local", f"WITH {S.base('local')} SELECT * FROM base", S.BASE_DOUBLES)
def _(spark, sf):
    return roles.base_table(spark, sf, "local")


def _ts_sql(variant):
    roll = {"price_roll_mean_3": (3, "avg"), "price_roll_mean_7": (7, "avg"), "price_roll_std_7": (7, "stddev_samp")}
    cols = [f"{S.DAY} AS day", f"{S.MONTH} AS month", f"{S.DOW} AS day_of_week"]
    cols += [f"{S.WEEKEND} AS is_weekend"] if variant == "cloud" else []
    cols += [f"{S.MONTH_SIN} AS month_sin", f"{S.MONTH_COS} AS month_cos", f"{S.FESTIVAL} AS is_festival"]
    cols += [f"lag(Average_Price, {k}) OVER ({S.W}) AS price_lag{k}" for k in (1, 3, 7)]
    cols += [f"{S.rolled('Average_Price', w, fn)} AS {n}" for n, (w, fn) in roll.items()]
    needed = ["Average_Price", "price_lag1", "price_lag3", "price_lag7"]
    if variant == "local":
        needed = [*S.BASE_DOUBLES.split(), "price_lag7", *roll]
    where = " AND ".join(f"{c} IS NOT NULL" for c in needed)
    return f"WITH {S.base(variant)}, t AS (SELECT *, {', '.join(cols)} FROM base) SELECT * FROM t WHERE {where}"


_TS_DOUBLES = S.BASE_DOUBLES + (
    " month_sin month_cos price_lag1 price_lag3 price_lag7 price_roll_mean_3 price_roll_mean_7 price_roll_std_7"
)


@query("ts_dataset", _ts_sql("cloud"), _TS_DOUBLES)
def _(spark, sf):
    return dataset.ts_dataset(roles.base_table(spark, sf))


@query("ts_dataset_local", _ts_sql("local"), _TS_DOUBLES)
def _(spark, sf):
    return dataset.ts_dataset(roles.base_table(spark, sf, "local"), "local")


@query("model_matrix", f"""WITH {S.features()}, t AS (
  SELECT *, ln(lead(Average_Price, 7) OVER ({S.W})) AS target FROM mf),
  c AS (SELECT *, row_number() OVER ({S.W}) AS rn, count(*) OVER (PARTITION BY series_id) AS n FROM t
        WHERE {' AND '.join(f'{f} IS NOT NULL' for f in [*S.MODEL_FEATURES, 'target'])})
  SELECT series_id, d, {', '.join(S.MODEL_FEATURES)}, target, 7 AS horizon,
         CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM c""",
       " ".join([f for f in S.MODEL_FEATURES if f not in S.INTEGER_FEATURES] + ["target"]))
def _(spark, sf):
    df = model_table(spark, sf)
    return modelling.model_matrix(df, features.feature_list(df))
