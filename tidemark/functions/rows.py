"""Null-skipping statistics across the columns of one row, and safe arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _present(cols: Sequence[Column]) -> list[Column]:
    return [c.isNotNull().cast("int") for c in cols]


def _add(cols: Sequence[Column]) -> Column:
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def row_count(cols: Sequence[Column]) -> Column:
    return _add(_present(cols))


def row_mean(cols: Sequence[Column]) -> Column:
    """Mean of the values present, NULL if none is."""
    return F.try_divide(_add([F.coalesce(c, F.lit(0.0)) for c in cols]), row_count(cols))


def row_std(cols: Sequence[Column]) -> Column:
    """Sample standard deviation of the values present, NULL below two values."""
    mean = row_mean(cols)
    squares = _add([F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in cols])
    n = row_count(cols)
    return F.when(n >= 2, F.sqrt(squares / (n - 1)))


def row_max(cols: Sequence[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def zero_to_one(c: Column) -> Column:
    """Denominator guard."""
    return F.when(c == 0, F.lit(1.0)).otherwise(c)


def ln_or_null(c: Column) -> Column:
    return F.when(c > 0, F.ln(c))
