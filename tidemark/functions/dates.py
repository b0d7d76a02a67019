"""Dates in text, fiscal labels and calendar parts."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.numbers import ascii_digits

#: Padded or not; month first where slashes end with the year. A time of day, with or without T, parts of a second, a half
#: of the day or a zone, and the name of a weekday are left out before.
DATE_FORMATS = (
    "yyyy-M-d", "M/d/yyyy", "yyyy/M/d", "yyyy.M.d", "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "d-MMMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy",
    "MMM d yyyy", "MMMM d yyyy", "M/d/yy", "yyyyMMdd",
)
_TIME_OF_DAY = r"(?i)[T ]+\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*(?:[AP]\.?M\.?)?\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})?$"
_WEEKDAY = r"(?i)^(?:mon|tue(?:s)?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+"
_ANY_DATE = r"(\d{4}[.\-/]\d{1,2}[.\-/]\d{1,2})"


#: Parts of a format: numbers, names of months, marks between them.
_PARTS = re.compile(r"((?:y+|M{1,2}(?!M)|d{1,2})+)|(M{3,4})|([\s,./-]+)")


def _shape(date_format: str) -> str | None:
    """A pattern that fits every text in this format, and maybe others; None if the format has parts of other kinds."""
    if _PARTS.sub("", date_format):
        return None
    number = lambda run: r"[-+]?\d+" if len(set(run)) == 1 else r"[-+\d]+"
    parts = [number(n) if n else r"\D+" if name else re.escape(marks) for n, name, marks in _PARTS.findall(date_format)]
    return rf"\A{''.join(parts)}\z"


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The day of the first format that fits, as it is written, else NULL.

    A format that does not fit costs an exception inside Spark, so those of another shape are not tried.
    """
    day = F.regexp_replace(F.regexp_replace(F.trim(c), _TIME_OF_DAY, ""), _WEEKDAY, "")

    def tried(text: Column, date_format: str) -> Column:
        found, shape = F.try_to_date(text, date_format), _shape(date_format)
        return found if shape is None else F.when(text.rlike(shape), found)

    # An array of one: a lambda's argument is computed once, a column at each place where it stands.
    return F.get(F.transform(F.array(day), lambda text: F.coalesce(*[tried(text, f) for f in formats])), F.lit(0))


def extract_ad_date(c: Column, before: int = 2050) -> Column:
    """First valid date in a text that mixes two calendars.

    Years of the other calendar are larger than any year in use, so a date counts
    only if its year lies below ``before``.
    """
    found = F.regexp_extract_all(ascii_digits(c), F.lit(_ANY_DATE), F.lit(1))
    dates = F.transform(found, lambda x: F.try_to_date(F.regexp_replace(x, r"[.\-/]", "-"), "yyyy-M-d"))
    return F.get(F.filter(dates, lambda x: x.isNotNull() & (F.year(x) < before)), F.lit(0))


def parse_rfc822(c: Column) -> Column:
    """RFC-822 publish time to a zone-free timestamp in UTC, else NULL."""
    text = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3},\s*", "")
    instant = F.coalesce(
        F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss zzz")),
        F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss xx")),
    )
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)


def fiscal_start_year(c: Column) -> Column:
    """``2021/22 (2078/79)`` -> 2021, anything else NULL."""
    year = F.regexp_extract(F.trim(c), r"^(\d{4})/\d{2}", 1)
    return F.nullif(year, F.lit("")).cast("int")


def month_pair_number(c: Column, months: Mapping[str, int] = fixed.MONTH_PAIRS) -> Column:
    """``Jul/Aug`` -> 7; unknown labels are NULL."""
    table = F.create_map(*[F.lit(x) for pair in months.items() for x in pair])
    return F.try_element_at(table, F.lower(F.trim(c)))


def weekday(d: Column) -> Column:
    """Monday = 0."""
    return F.weekday(d)


def is_weekend(d: Column) -> Column:
    return F.weekday(d).isin(5, 6).cast("int")


def month_sin(d: Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * F.month(d) / F.lit(12))


def month_cos(d: Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * F.month(d) / F.lit(12))


def in_months(d: Column, months: Sequence[int]) -> Column:
    """0/1 flag."""
    return F.month(d).isin(*months).cast("int")


def in_day_ranges(d: Column, ranges: Sequence[tuple[int, int, int, int]]) -> Column:
    """0/1 flag for (month, day) to (month, day) ranges, both ends included."""
    at = F.month(d) * 100 + F.dayofmonth(d)
    hit = F.lit(False)
    for from_month, from_day, to_month, to_day in ranges:
        hit = hit | at.between(from_month * 100 + from_day, to_month * 100 + to_day)
    return hit.cast("int")


def weeks_to_day_of_year(d: Column, centre: int) -> Column:
    """Shortest way round the year to ``centre``, in weeks."""
    away = F.abs(F.dayofyear(d) - centre)
    return F.least(away, F.lit(365) - away) / F.lit(7.0)


def local_today(instant: Column, zone: str = fixed.MARKET_ZONE) -> Column:
    """The calendar day at ``zone`` for a timestamp; callers pass the result as ``as_of``."""
    wall = instant.cast("timestamp").cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(zone), wall))
