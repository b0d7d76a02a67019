"""From cleaned daily sources to the base table and the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.dates import DATE_FORMATS, parse_date
from tidemark.functions.numbers import clean_number, normalize_category, to_float
from tidemark.operators.features import calendar_features, dataset_lags, festival_flag
from tidemark.operators.fill import fill
from tidemark.operators.series import D, KEYS, densify, unique_by
from tidemark.operators.shaping import daily_agg, drop_nonpositive, merge_sources
from tidemark.sources.increments import dedupe_by
from tidemark.sources.tables import columns_containing, drop_if_exists

PRICE, SUPPLY = "Average_Price", "Supply_Volume"
MACRO = ("USD_TO_NPR", "Diesel", "Inflation")


def quote_rows(raw: DataFrame, columns=fixed.QUOTE_COLUMNS, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Scraped quote or volume rows: renamed, cleaned, and cut to the commodities kept.

    Dates and numbers come out of a generator: later filters on them would else be pushed below this step, and
    everything would be parsed twice.
    """
    value = next(v for v in columns.values() if v not in ("Date", "commodity"))
    picked = raw.select(*[F.col(f"`{src}`").alias(dst) for src, dst in columns.items()])
    named = picked.withColumn("commodity", normalize_category(F.col("commodity")))
    kept = named.where(F.col("commodity").isin(list(fixed.COMMODITIES_KEPT)))
    parsed = F.struct(parse_date(F.col("Date"), formats).alias(D), clean_number(F.col(value)).alias(value))
    return kept.select("commodity", F.inline(F.array(parsed)).alias(D, value)).select(D, "commodity", value)


def daily_price(quotes: DataFrame, value: str = PRICE, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Mean quote per key and day over complete rows."""
    return daily_agg(quotes.na.drop(subset=[d, value]), {value: (value, "mean")}, keys, d)


def daily_supply(rows: DataFrame, value: str = SUPPLY, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Summed volume per key and day; a day of missing values sums to 0."""
    return daily_agg(rows, {value: (value, "sum0")}, keys, d)


def macro_rows(
    raw: DataFrame, date: str, value: str, name: str, order: Sequence[str], formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """A market-wide source as ``(d, name)``: coerced, dated, the first row of a day by ``order``."""
    rows = raw.select(parse_date(F.col(date), formats).alias(D), to_float(F.col(value)).alias(name), *order)
    return dedupe_by(rows.where(F.col(D).isNotNull()), [D], order).select(D, name)


def clean_weather(df: DataFrame, d: str = D, variant: str = "cloud") -> DataFrame:
    """Wide daily weather ahead of the merge: temperatures filled, rain 0.

    The cloud variant draws straight lines and counts precipitation as rain; the local
    one carries forward and looks at rain columns only. Rows are taken in date order.
    The table is checked to hold one row per day, so one constant key is enough.
    """
    temps = columns_containing(df, "temp", ignore_case=True)
    rain_words = ("rain", "precipitation") if variant == "cloud" else ("rain",)
    rains = columns_containing(df, *rain_words, ignore_case=True)
    policy = {c: "interpolate" if variant == "cloud" else "ffill" for c in temps}
    policy.update({c: "zero" for c in rains})
    rows = unique_by(df.where(F.col(d).isNotNull()), [d]).withColumn("_all", F.lit(0))
    return fill(rows, policy, ["_all"], d).drop("_all")


def fill_policy(df: DataFrame, variant: str = "cloud") -> dict[str, str]:
    """Strategy per column.

    ``cloud`` and ``local`` close the base table, ``model`` prepares it for the fits of
    the report (risk is interpolated there), ``model_all`` is the shorter rule of the
    other fits: everything forward, then backward.
    """
    if variant == "model_all":
        return {c: "ffill_bfill" for c in df.columns if c not in (*KEYS, D)}
    weather_lines = {
        "cloud": ("Temperature", "Pressure", "Wind"),
        "local": (),
        "model": ("Temperature", "Air_Pressure", "Wind_Speed", "Precipitation", "Rainfall_MM"),
    }[variant]
    zeros = {"cloud": ("Rain", "Precipitation", "Risk"), "local": ("Rainfall", "Risk"), "model": ()}[variant]
    lines = weather_lines + (("Risk",) if variant == "model" else ())
    policy = {c: "zero" for c in columns_containing(df, *zeros)} if zeros else {}
    policy.update({c: "interpolate_fill" for c in columns_containing(df, *lines)} if lines else {})
    macro = "ffill" if variant == "local" else "ffill_bfill"
    policy.update({c: macro for c in MACRO if c in df.columns})
    policy[PRICE] = "ffill_bfill" if variant == "model" else "ffill"
    if SUPPLY in df.columns:
        policy[SUPPLY] = {"cloud": "interpolate_fill", "local": "ffill", "model": "ffill_bfill"}[variant]
    return policy


def base_dataset(
    base: DataFrame, others: Sequence[DataFrame], variant: str = "cloud", keys: Sequence[str] = KEYS, d: str = D
) -> DataFrame:
    """Join onto the price days, close the calendar, fill each column by its rule."""
    merged = merge_sources(base, others, keys, d)
    return fill(merged, fill_policy(merged, variant), keys, d)


def ts_dataset(base: DataFrame, variant: str = "cloud", keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Calendar, festival, lag and rolling columns; rows without price history are dropped.

    The cloud variant asks for the price and its lags only, the local one for every column.
    """
    df = festival_flag(calendar_features(base, d, variant), d)
    df = dataset_lags(df, PRICE, keys, d)
    needed = [PRICE, "price_lag1", "price_lag3", "price_lag7"]
    return df.na.drop(subset=needed) if variant == "cloud" else df.na.drop()


def model_base(base: DataFrame, variant: str = "model", keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Base table as the fits see it.

    Days without a positive price are removed after the calendar is closed, so later
    lags count rows, not days. ``model_all`` keeps such days but drops missing prices.
    """
    dense = densify(drop_if_exists(base, fixed.RATE_METADATA), keys, d)
    rows = dense.where(F.col(PRICE).isNotNull()) if variant == "model_all" else drop_nonpositive(dense, PRICE)
    return fill(rows, fill_policy(rows, variant), keys, d)


def history_range(daily: DataFrame, start: str, end: str, d: str = D) -> DataFrame:
    """Rows of a date range, both ends included."""
    return daily.where(F.col(d).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
