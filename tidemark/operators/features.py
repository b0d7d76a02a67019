"""Derived features of the daily table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import dates
from tidemark.functions.rows import row_max, row_mean, row_std, zero_to_one
from tidemark.operators.series import D, KEYS, lags, rolling
from tidemark.sources.tables import columns_containing


def calendar_features(df: DataFrame, d: str = D, variant: str = "cloud") -> DataFrame:
    """day, month, day_of_week (Monday 0), is_weekend (not in the local variant), month_sin/cos."""
    c = F.col(d)
    cols = {"day": F.dayofmonth(c), "month": F.month(c), "day_of_week": dates.weekday(c)}
    if variant == "cloud":
        cols["is_weekend"] = dates.is_weekend(c)
    return df.withColumns({**cols, "month_sin": dates.month_sin(c), "month_cos": dates.month_cos(c)})


def festival_flag(df: DataFrame, d: str = D, ranges=fixed.FESTIVAL_RANGES, name: str = "is_festival") -> DataFrame:
    return df.withColumn(name, dates.in_day_ranges(F.col(d), ranges))


def season_flags(df: DataFrame, d: str = D, spec: Mapping[str, Sequence[int]] = fixed.SEASON_MONTHS) -> DataFrame:
    """Month flags, distance to the festival in weeks and progress of the month."""
    c = F.col(d)
    flags = {name: dates.in_months(c, months) for name, months in spec.items()}
    flags["weeks_to_dashain"] = dates.weeks_to_day_of_year(c, fixed.FESTIVAL_DAY_OF_YEAR)
    flags["month_progress"] = F.dayofmonth(c) / F.lit(30)
    return df.withColumns(flags)


def dataset_lags(df: DataFrame, value: str, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """The lag and rolling columns of the published table."""
    df = lags(df, value, (1, 3, 7), "price_lag", keys, d)
    specs = {"price_roll_mean_3": (3, "mean"), "price_roll_mean_7": (7, "mean"), "price_roll_std_7": (7, "std")}
    return rolling(df, value, specs, 1, keys, d)


def momentum(df: DataFrame, prefix: str = "momentum") -> DataFrame:
    """lag1 against lag7/14/21, and the change of the weekly move. Needs the lag columns."""
    lag = {k: F.col(f"lag{k}") for k in (1, 7, 14, 21)}
    return df.withColumns(
        {
            f"{prefix}7": lag[1] - lag[7],
            f"{prefix}14": lag[1] - lag[14],
            f"{prefix}21": lag[1] - lag[21],
            "accel": (lag[1] - lag[7]) - (lag[7] - lag[14]),
        }
    )


def price_position(df: DataFrame) -> DataFrame:
    """zscore14 and volatility7. Needs lag1 and the rolling columns."""
    return df.withColumns(
        {
            "zscore14": (F.col("lag1") - F.col("roll_mean14")) / zero_to_one(F.col("roll_std14")),
            "volatility7": F.col("roll_std7") / (F.col("roll_mean7") + F.lit(1e-6)),
        }
    )


def interactions(df: DataFrame, weekly: str = "momentum7", harvest: bool = False) -> DataFrame:
    cols = {
        "mom7_x_monsoon": F.col(weekly) * F.col("is_monsoon"),
        "mom7_x_festival": F.col(weekly) * F.col("is_dashain_tihar"),
    }
    if harvest:
        cols["mom7_x_harvest"] = F.col(weekly) * F.col("is_terai_harvest")
    return df.withColumns(cols)


def weather_aggregates(df: DataFrame) -> DataFrame:
    """Mean, spread and maximum over the per-location columns of one metric."""
    rules = [
        ("Temperature", {"Temp_mean": row_mean, "Temp_std": row_std}),
        ("Rainfall_MM", {"Rainfall_mean": row_mean, "Rainfall_max": row_max}),
        ("Air_Pressure", {"Pressure_mean": row_mean}),
        ("Wind_Speed", {"Wind_mean": row_mean, "Wind_max": row_max}),
        ("Precipitation", {"Precip_mean": row_mean, "Precip_max": row_max}),
    ]
    cols = {}
    for part, outputs in rules:
        found = [F.col(f"`{c}`") for c in columns_containing(df, part)]
        if found:
            cols.update({name: fn(found) for name, fn in outputs.items()})
    return df.withColumns(cols)


def market_risk(
    df: DataFrame, weights: Mapping[str, float] = fixed.DISTRICT_WEIGHTS, name: str = "Market_Risk"
) -> DataFrame:
    """Weighted sum of the ``{place}_Risk`` columns."""
    total = None
    for place, weight in weights.items():
        part = F.col(f"`{place}_Risk`") * F.lit(weight)
        total = part if total is None else total + part
    return df.withColumn(name, total)


def disruption_features(df: DataFrame, shares: Mapping[str, float] = fixed.DISTRICT_WEIGHTS) -> DataFrame:
    """Flag, count, maximum and weighted share of the places at risk; an absent column counts as 0."""
    for place in shares:
        if f"{place}_Risk" not in df.columns:
            df = df.withColumn(f"{place}_Risk", F.lit(0.0))
    risks = {place: F.col(f"`{place}_Risk`") for place in shares}
    active = {place: F.coalesce((r > 0).cast("int"), F.lit(0)) for place, r in risks.items()}
    blocked = None
    for place, share in shares.items():
        part = active[place].cast("double") * F.lit(share)
        blocked = part if blocked is None else blocked + part
    return df.withColumns(
        {
            "disruption_flag": F.coalesce((F.col("Market_Risk") > 0).cast("int"), F.lit(0)),
            "active_disruption_count": sum(list(active.values())[1:], list(active.values())[0]),
            "max_severity": row_max(list(risks.values())),
            "weighted_route_blockage": blocked,
        }
    )


def model_features(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = KEYS,
    d: str = D,
    variant: str = "report",
    shares: Mapping[str, float] = fixed.DISTRICT_WEIGHTS,
) -> DataFrame:
    """The full feature table for model fits.

    ``variant="search"`` names the momentum columns ``mom…``, adds the 30-day mean, the
    extra seasons and the harvest interaction, and counts November as harvest.
    """
    search = variant == "search"
    df = weather_aggregates(df)
    if "Market_Risk" in df.columns and not search:
        df = disruption_features(df, shares)
    df = lags(df, value, fixed.MODEL_LAGS, "lag", keys, d)
    specs = {f"roll_mean{w}": (w, "mean") for w in ((7, 14, 21, 30) if search else (7, 14, 21))}
    specs.update({f"roll_std{w}": (w, "std") for w in ((7, 14) if search else (7, 14, 21))})
    specs["price_range7"] = (7, "range")
    df = rolling(df, value, specs, 1, keys, d)
    prefix = "mom" if search else "momentum"
    df = price_position(momentum(df, prefix))
    seasons = dict(fixed.SEASON_MONTHS)
    if search:
        seasons["is_terai_harvest"] = fixed.SEARCH_HARVEST_MONTHS
    else:
        seasons = {k: seasons[k] for k in ("is_monsoon", "is_dashain_tihar", "is_terai_harvest")}
    df = season_flags(calendar_features(df, d), d, seasons)
    return interactions(df, f"{prefix}7", harvest=search)


def feature_list(
    df: DataFrame,
    experiment: str = "FULL MODEL",
    without: Sequence[str] = (),
    catalogue: Mapping[str, Sequence[str]] = fixed.FEATURE_GROUPS,
) -> list[str]:
    """Features of an experiment that exist in ``df``, leaving out whole groups on request."""
    groups = [g for g in fixed.EXPERIMENTS[experiment] if g not in without]
    return [f for g in groups for f in catalogue[g] if f in df.columns]
