"""News items to records, events and daily risk."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.dates import parse_date
from tidemark.functions.vocab import first_group, first_match, tier_score
from tidemark.operators.features import market_risk
from tidemark.operators.series import D, densify
from tidemark.operators.shaping import pivot_fixed


def tag_text(
    df: DataFrame,
    text: Column,
    places: Mapping[str, str] = fixed.PLACE_NAMES,
    groups: Mapping[str, Sequence[str]] = fixed.EVENT_WORDS,
    tiers: Mapping[int, Sequence[str]] = fixed.SEVERITY_WORDS,
) -> DataFrame:
    """Adds district, event_type and severity found in the text.

    The text is lower-cased once, ahead of the rules. Severity is missing where no
    event type was found.
    """
    low = F.col("_low")
    return (
        df.withColumn("_low", F.lower(text))
        .withColumns(
            {"district": first_match(low, places), "event_type": first_group(low, groups)}
        )
        .withColumn("severity", F.when(F.col("event_type").isNotNull(), tier_score(low, tiers)))
        .drop("_low")
    )


def news_records(
    items: DataFrame,
    window_start: str | Column,
    window_stop: str | Column,
    body: str | None = None,
    **vocab,
) -> DataFrame:
    """Feed items to records with their fetch window; rules read the title, or title and body."""
    text = F.col("title") if body is None else F.concat_ws(" ", "title", body)
    start = F.lit(window_start).cast("date") if isinstance(window_start, str) else window_start
    stop = F.lit(window_stop).cast("date") if isinstance(window_stop, str) else window_stop
    tagged = tag_text(items, text, **vocab)
    extra = [] if body is None else [F.col(body).alias("raw_text")]
    return tagged.select(
        F.to_date("published_at").alias("date"),
        "published_at",
        "source",
        "title",
        "url",
        "district",
        "event_type",
        "severity",
        *extra,
        start.alias("window_start"),
        F.date_sub(stop, 1).alias("window_end"),
    )


def district_events(records: DataFrame, keep: Sequence[str] = fixed.DISTRICTS) -> DataFrame:
    """Complete records of the given districts as ``(Date, District, Event_Type, Severity)``."""
    date = F.col("date")
    if records.schema["date"].dataType.simpleString() == "string":
        date = parse_date(date)
    rows = records.select(
        date.cast("date").alias("Date"),
        F.col("district").alias("District"),
        F.col("event_type").alias("Event_Type"),
        F.col("severity").try_cast("double").cast("int").alias("Severity"),
    )
    return rows.na.drop().where(F.col("District").isin(list(keep)))


def severity_to_risk(c: Column) -> Column:
    return F.coalesce(c / F.lit(5.0), F.lit(0.0))


def risk_rows(
    events: DataFrame, districts: Sequence[str], date: str = "Date", district: str = "District", severity: str = "Severity"
) -> DataFrame:
    """Complete events of the given districts as ``(d, district, risk)``."""
    rows = events.na.drop(subset=[date, district, severity]).where(F.col(district).isin(list(districts)))
    return rows.select(
        F.col(date).cast("date").alias(D), F.col(district).alias("district"), severity_to_risk(F.col(severity)).alias("risk")
    )


def daily_risk(events: DataFrame, districts: Sequence[str], **columns: str) -> DataFrame:
    """Highest risk per day and district, long form."""
    return risk_rows(events, districts, **columns).groupBy(D, "district").agg(F.max("risk").alias("risk"))


def daily_event_risk(
    events: DataFrame, weights: Mapping[str, float] = fixed.DISTRICT_WEIGHTS, **columns: str
) -> DataFrame:
    """One row per day from the first to the last event: ``{place}_Risk`` and ``Market_Risk``.

    Any number of events is reduced to one row per day before the calendar is closed.
    """
    places = list(weights)
    wide = pivot_fixed(risk_rows(events, places, **columns), [D], "district", places, "risk", "_Risk", fill=None)
    days = densify(wide, keys=(), d=D)
    return market_risk(days.na.fill(0.0, subset=[f"{p}_Risk" for p in places]), weights)


def market_risk_long(risk: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Weighted risk per day straight from the long form; the weights are a handful of literals."""
    weight = F.lit(0.0)
    for place, w in weights.items():
        weight = F.when(F.col("district") == place, F.lit(w)).otherwise(weight)
    return risk.groupBy(D).agg(F.sum(F.col("risk") * weight).alias("Market_Risk"))


def sorted_vocabulary(groups: Mapping[str, Sequence[str]]) -> list[str]:
    return sorted({w for words in groups.values() for w in words})


def keyword_query(
    windows: DataFrame,
    places: Sequence[str] = tuple(fixed.PLACE_NAMES),
    groups: Mapping[str, Sequence[str]] = fixed.EVENT_WORDS,
    sites: Sequence[str] = (),
    country: str = fixed.COUNTRY_WORD,
    start: str = "window_start",
    stop: str = "window_stop",
) -> DataFrame:
    """Search string per fetch window: places, sorted distinct words, sites, date bounds."""

    def any_of(words: Sequence[str], form: str) -> Column:
        literals = F.array(*[F.lit(form.format(w)) for w in words])
        return F.concat(F.lit("("), F.array_join(literals, " OR "), F.lit(")"))

    parts = [any_of(places, '"{}"'), any_of(sorted_vocabulary(groups), '"{}"')]
    if sites:
        parts.append(any_of(sites, "site:{}"))
    parts += [
        F.lit(country),
        F.concat(F.lit("after:"), F.date_format(start, "yyyy-MM-dd")),
        F.concat(F.lit("before:"), F.date_format(stop, "yyyy-MM-dd")),
    ]
    return windows.withColumn("query", F.concat_ws(" ", *parts))
