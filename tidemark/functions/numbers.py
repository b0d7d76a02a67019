"""Numbers and category labels in scraped text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed

_BLANKS = " \t\n\r\f\u000b\u00a0"
_FLOAT = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def ascii_digits(c: Column) -> Column:
    """Devanagari digits to ASCII digits; everything else is kept."""
    return F.translate(c, fixed.DEVANAGARI_DIGITS, "0123456789")


def to_float(c: Column) -> Column:
    """Text to double by the usual scripting-language rules, else NULL.

    Accepts surrounding blanks, exponents and single underscores between digits.
    ``nan`` counts as missing, and type suffixes such as ``1d`` are rejected.
    """
    text = F.regexp_replace(F.btrim(c.cast("string"), F.lit(_BLANKS)), r"(?<=\d)_(?=\d)", "")
    return F.when(text.rlike(_FLOAT), text.try_cast("double"))


def clean_number(c: Column) -> Column:
    """Currency-like text (currency sign, thousands commas, local digits) to double."""
    bare = F.replace(F.replace(c.cast("string"), F.lit(fixed.CURRENCY_SIGN), F.lit("")), F.lit(","), F.lit(""))
    return to_float(ascii_digits(bare))


def normalize_category(c: Column, ordered: Mapping[str, str] = fixed.COMMODITY_NAMES) -> Column:
    """Drop bracketed remarks, then map by the first key contained in the name.

    The order of ``ordered`` decides, since one key may contain another. Names that
    match nothing are returned cleaned, and a missing name becomes ``nan``.
    """
    name = F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("nan")), r"\(.*?\)", ""))
    label = None
    for needle, value in ordered.items():
        hit = name.contains(needle)
        label = F.when(hit, value) if label is None else label.when(hit, value)
    return name if label is None else label.otherwise(name)


def no_nan(c: Column) -> Column:
    """NaN to NULL: the library knows one kind of missing value."""
    return F.when(~F.isnan(c), c)
