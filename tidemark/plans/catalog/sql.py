"""Shared SQL pieces: the given tables in the roles of ``plans.roles``."""

from __future__ import annotations

from tidemark import fixed

W = "PARTITION BY series_id ORDER BY d"
STATION_COLUMNS = [f"{s}_{m}" for s in "ANR" for m in ("Temperature", "Rainfall_MM")]
RISK = {"AFRICA": 0.15, "AMERICA": 0.40, "ASIA": 0.25, "EUROPE": 0.20}
RISK_COLUMNS = [f"{p}_Risk" for p in RISK]


def before(x: str, w: str = W) -> str:
    return f"last_value({x} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def after(x: str, w: str = W) -> str:
    return f"first_value({x} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def both(x: str, w: str = W) -> str:
    return f"coalesce({before(x, w)}, {after(x, w)})"


def line(x: str, w: str = W, fill: bool = False) -> str:
    """Straight line by position ``pos``."""
    at = f"CASE WHEN {x} IS NOT NULL THEN pos END"
    p, n, pp, np = before(x, w), after(x, w), before(at, w), after(at, w)
    body = (
        f"CASE WHEN {x} IS NOT NULL THEN {x} WHEN {n} IS NOT NULL "
        f"THEN {p} + ({n} - {p}) * ({pp} - pos)::DOUBLE / ({pp} - {np}) ELSE {p} END"
    )
    return f"coalesce({body}, {n})" if fill else body


def rolled(x: str, width: int, fn: str, w: str = W) -> str:
    frame = f"OVER ({w} ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
    value = f"max({x}) {frame} - min({x}) {frame}" if fn == "range" else f"{fn}({x}) {frame}"
    return f"CASE WHEN count({x}) {frame} = {width} THEN {value} END"


QUOTES = """quotes AS (
  SELECT p_brand AS series_id, CAST(l_shipdate AS DATE) AS d,
         l_extendedprice / nullif(l_quantity, 0) AS price, l_quantity AS qty
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

DAILY = QUOTES + """, daily AS (
  SELECT series_id, d, avg(price) AS Average_Price, coalesce(sum(qty), 0) AS Supply_Volume
  FROM quotes WHERE d IS NOT NULL GROUP BY series_id, d HAVING avg(price) IS NOT NULL)"""

CAL = """cal AS (
  SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT series_id, min(d) AS a, max(d) AS b FROM daily GROUP BY series_id))"""

DENSE = DAILY + ", " + CAL + f""", dense AS (
  SELECT series_id, d, Average_Price, Supply_Volume, row_number() OVER ({W}) AS pos
  FROM cal LEFT JOIN daily USING (series_id, d))"""

FILLED = DENSE + f""", filled AS (
  SELECT series_id, d, {before('Average_Price')} AS Average_Price, Supply_Volume FROM dense)"""

RATES = """rate AS (
  SELECT CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) AS USD_TO_NPR FROM orders GROUP BY 1),
steps AS (
  SELECT CAST(o_orderdate AS DATE) AS d, max(o_totalprice) AS Diesel FROM orders
  WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
monthly AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, avg(o_totalprice) AS Inflation FROM orders GROUP BY 1)"""

STATIONS = """stations AS (
  SELECT l_returnflag AS location, CAST(l_shipdate AS DATE) AS d,
         avg(l_discount) * 100 AS Temperature, sum(l_tax) AS Rainfall_MM FROM lineitem GROUP BY 1, 2),
wide AS (
  SELECT d, """ + ", ".join(
    f"max({m}) FILTER (location = '{s}') AS {s}_{m}" for s in "ANR" for m in ("Temperature", "Rainfall_MM")
) + """ FROM stations GROUP BY d)"""

EVENTS = """risk_events AS (
  SELECT CAST(o_orderdate AS DATE) AS d, r_name AS district, o_orderstatus AS event_type,
         6 - CAST(left(o_orderpriority, 1) AS INTEGER) AS severity
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_DAYS = """SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT min(d) AS a, max(d) AS b FROM risk_wide)"""
RISK_DAYS = EVENTS + """, risk_wide AS (
  SELECT d, """ + ", ".join(f"max(severity / 5.0) FILTER (district = '{p}') AS {p}_Risk" for p in RISK) + f"""
  FROM risk_events WHERE district IN ({', '.join(repr(p) for p in RISK)}) GROUP BY d),
risk AS (
  SELECT d, {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in RISK_COLUMNS)},
    CAST({' + '.join(f'coalesce({p}_Risk, 0) * {w}' for p, w in RISK.items())} AS DOUBLE) AS Market_Risk
  FROM ({_DAYS}) LEFT JOIN risk_wide USING (d))"""


def weather_clean(variant: str) -> str:
    w = "ORDER BY d"
    temps = [f"{s}_Temperature" for s in "ANR"]
    rains = [f"{s}_Rainfall_MM" for s in "ANR"]
    temp = {c: line(c, w) if variant == "cloud" else before(c, w) for c in temps}
    cols = [f"{temp[c]} AS {c}" for c in temps] + [f"coalesce({c}, 0) AS {c}" for c in rains]
    return f"weather AS (SELECT d, {', '.join(cols)} FROM (SELECT *, row_number() OVER (ORDER BY d) AS pos FROM wide))"


def merged(variant: str = "cloud") -> str:
    """CTEs up to the joined table on a closed calendar, not yet filled."""
    return f"""{DAILY}, {CAL}, {RATES}, {STATIONS}, {weather_clean(variant)}, {RISK_DAYS},
joined AS (
  SELECT * FROM daily LEFT JOIN rate USING (d) LEFT JOIN steps USING (d) LEFT JOIN monthly USING (d)
  LEFT JOIN weather USING (d) LEFT JOIN risk USING (d)),
merged AS (
  SELECT *, row_number() OVER ({W}) AS pos FROM cal LEFT JOIN joined USING (series_id, d))"""


def base(variant: str = "cloud") -> str:
    macro = both if variant == "cloud" else before
    cols = {"Average_Price": before("Average_Price")}
    cols["Supply_Volume"] = line("Supply_Volume", fill=True) if variant == "cloud" else before("Supply_Volume")
    cols.update({c: macro(c) for c in ("USD_TO_NPR", "Diesel", "Inflation")})
    for c in STATION_COLUMNS:
        if "Rainfall" in c:
            cols[c] = f"coalesce({c}, 0)"
        else:
            cols[c] = line(c, fill=True) if variant == "cloud" else c
    cols.update({c: f"coalesce({c}, 0)" for c in [*RISK_COLUMNS, "Market_Risk"]})
    picked = ", ".join(f"{x} AS {c}" for c, x in cols.items())
    return f"{merged(variant)}, base AS (SELECT series_id, d, {picked} FROM merged)"


BASE_DOUBLES = " ".join(
    ["Average_Price", "Supply_Volume", "USD_TO_NPR", "Diesel", "Inflation", *STATION_COLUMNS, *RISK_COLUMNS, "Market_Risk"]
)

DAY, MONTH = "CAST(day(d) AS INTEGER)", "CAST(month(d) AS INTEGER)"
DOW = "CAST(isodow(d) - 1 AS INTEGER)"
WEEKEND = "CAST(isodow(d) IN (6, 7) AS INTEGER)"
MONTH_SIN, MONTH_COS = "sin(2 * pi() * month(d) / 12)", "cos(2 * pi() * month(d) / 12)"
FESTIVAL = (
    "CAST((month(d) = 3 AND day(d) BETWEEN 1 AND 20) OR (month(d) = 4 AND day(d) BETWEEN 10 AND 20) "
    "OR (month(d) = 9 AND day(d) >= 25) OR (month(d) = 10 AND day(d) <= 15) "
    "OR (month(d) = 11 AND day(d) BETWEEN 1 AND 15) AS INTEGER)"
)
WEEKS = "least(abs(dayofyear(d) - 280), 365 - abs(dayofyear(d) - 280)) / 7.0::DOUBLE"


def in_months(months) -> str:
    return f"CAST(month(d) IN ({', '.join(str(m) for m in months)}) AS INTEGER)"


def features() -> str:
    """CTEs up to ``mf``, the full feature table of the fits."""
    p = "Average_Price"
    temp, rain = [[f"{s}_{m}" for s in "ANR"] for m in ("Temperature", "Rainfall_MM")]
    tm = f"(({' + '.join(temp)}) / 3)"
    step1 = {
        "Temp_mean": tm,
        "Temp_std": "sqrt((" + " + ".join(f"({t} - {tm}) * ({t} - {tm})" for t in temp) + ") / 2)",
        "Rainfall_mean": f"({' + '.join(rain)}) / 3",
        "Rainfall_max": f"greatest({', '.join(rain)})",
    }
    risk = {
        "disruption_flag": "CAST(Market_Risk > 0 AS INTEGER)",
        "active_disruption_count": "CAST(" + " + ".join(f"CAST({c} > 0 AS INTEGER)" for c in RISK_COLUMNS) + " AS INTEGER)",
        "max_severity": f"greatest({', '.join(RISK_COLUMNS)})",
        "weighted_route_blockage": "CAST("
        + " + ".join(f"CAST({q}_Risk > 0 AS INTEGER) * {w}" for q, w in RISK.items())
        + " AS DOUBLE)",
    }
    lag = {f"lag{k}": f"lag({p}, {k}) OVER ({W})" for k in fixed.MODEL_LAGS}
    roll = {f"roll_mean{w}": rolled(p, w, "avg") for w in (7, 14, 21)}
    roll.update({f"roll_std{w}": rolled(p, w, "stddev_samp") for w in (7, 14, 21)})
    roll["price_range7"] = rolled(p, 7, "range")
    cal = {
        "month_sin": MONTH_SIN, "month_cos": MONTH_COS, "month_progress": "day(d) / 30.0::DOUBLE",
        "is_monsoon": in_months((6, 7, 8, 9)), "is_dashain_tihar": in_months((10, 11)),
        "is_terai_harvest": in_months((12, 1, 2)), "day_of_week": DOW, "is_weekend": WEEKEND,
        "weeks_to_dashain": WEEKS,
    }
    first = ", ".join(f"{x} AS {c}" for c, x in {**step1, **risk, **lag, **roll, **cal}.items())
    second = ", ".join(
        f"{x} AS {c}"
        for c, x in {
            "momentum7": "lag1 - lag7", "momentum14": "lag1 - lag14", "momentum21": "lag1 - lag21",
            "accel": "(lag1 - lag7) - (lag7 - lag14)",
            "zscore14": "(lag1 - roll_mean14) / CASE WHEN roll_std14 = 0 THEN 1 ELSE roll_std14 END",
            "volatility7": "roll_std7 / (roll_mean7 + 1e-6)",
            "mom7_x_monsoon": "(lag1 - lag7) * is_monsoon", "mom7_x_festival": "(lag1 - lag7) * is_dashain_tihar",
        }.items()
    )
    return f"{base()}, mf0 AS (SELECT *, {first} FROM base), mf AS (SELECT *, {second} FROM mf0)"


#: Features of the full model that exist for the given tables, in catalogue order.
_ABSENT = ("Pressure_mean", "Wind_mean", "Wind_max", "Precip_mean", "Precip_max")
MODEL_FEATURES = [f for g in fixed.FEATURE_GROUPS.values() for f in g if f not in _ABSENT]
INTEGER_FEATURES = (
    "disruption_flag", "active_disruption_count", "is_monsoon", "is_dashain_tihar", "is_terai_harvest",
    "day_of_week", "is_weekend",
)

PERSISTENCE = FILLED + f""", shifted AS (
  SELECT series_id, d, h AS horizon, Average_Price,
         CASE WHEN ahead > 0 THEN ln(ahead) END AS y_true,
         CASE WHEN back IS NOT NULL THEN ln(greatest(back, 1)) END AS y_pred
  FROM (""" + " UNION ALL ".join(
    f"SELECT series_id, d, Average_Price, {h} AS h, lead(Average_Price, {h}) OVER ({W}) AS ahead, "
    f"lag(Average_Price, {h}) OVER ({W}) AS back FROM filled"
    for h in fixed.HORIZONS
) + """)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY series_id, horizon ORDER BY d) AS pos,
         count(*) OVER (PARTITION BY series_id, horizon) AS n
  FROM shifted WHERE y_true IS NOT NULL AND Average_Price IS NOT NULL),
pred AS (
  SELECT 'BASELINE' AS exp, 'PERSISTENCE' AS model, CAST(horizon AS INTEGER) AS horizon, 0 AS fold,
         CASE WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split,
         series_id, d, y_true, y_pred FROM placed)"""
