"""Aggregation to the daily grain, joins of daily tables, pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import D, KEYS, densify, require_date, unique_by


def daily_agg(
    df: DataFrame, measures: Mapping[str, tuple[str, str]], keys: Sequence[str] = KEYS, d: str = D
) -> DataFrame:
    """One row per key and day: ``{name: (column, how)}`` with ``mean``, ``sum0`` or ``max``.

    ``sum0`` of a day that holds only missing values is 0. Rows without a date are
    left out. Partial aggregation before the shuffle keeps hot keys harmless.
    """
    hows = {
        "mean": F.avg,
        "sum0": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
        "max": F.max,
    }
    aggs = [hows[how](column).alias(name) for name, (column, how) in measures.items()]
    return df.where(F.col(d).isNotNull()).groupBy(*keys, d).agg(*aggs)


def merge_sources(
    base: DataFrame,
    others: Sequence[DataFrame],
    keys: Sequence[str] = KEYS,
    d: str = D,
    densify_when: str = "after",
) -> DataFrame:
    """Left-join daily tables onto ``base`` and close the calendar.

    A table that has the key columns is joined by key and day, a table without them
    by day alone. The latter must be unique per day, which is checked while it runs. How a
    table is joined is left to its size.

    ``densify_when="after"`` (default) joins first, so values that fall on days
    without a base row are **lost** and filled again later; ``"before"`` keeps them;
    ``"never"`` leaves the calendar open.
    """
    if densify_when not in ("after", "before", "never"):
        raise ValueError("densify_when must be 'after', 'before' or 'never'")
    require_date(base, d)
    out = densify(base, keys, d) if densify_when == "before" else base.where(F.col(d).isNotNull())
    for other in others:
        require_date(other, d)
        if all(k in other.columns for k in keys):
            out = out.join(other, [*keys, d], "left")
        else:
            out = out.join(unique_by(other.where(F.col(d).isNotNull()), [d]), d, "left")
    cols = [*keys, d, *[c for c in out.columns if c not in (*keys, d)]]
    out = out.select(*cols)
    return densify(out, keys, d) if densify_when == "after" else out


def outer_merge(frames: Mapping[str, DataFrame], on: str = D) -> DataFrame:
    """Full outer join of per-location tables; their columns get the location as prefix."""
    prefixed = [
        f.select(on, *[F.col(c).alias(f"{name}_{c}") for c in f.columns if c != on]) for name, f in frames.items()
    ]
    return reduce(lambda a, b: a.join(b, on, "full"), prefixed)


def widen_locations(
    df: DataFrame, location: str, names: Sequence[str], metrics: Sequence[str], d: str = D
) -> DataFrame:
    """The same table from the long form: one aggregation instead of a chain of joins."""
    aggs = [
        F.max(F.when(F.col(location) == n, F.col(m))).alias(f"{n}_{m}") for n in names for m in metrics
    ]
    return df.where(F.col(location).isin(list(names))).groupBy(d).agg(*aggs)


def pivot_fixed(
    df: DataFrame,
    on: Sequence[str],
    col: str,
    values: Sequence[str],
    value: str,
    suffix: str = "",
    fill: float | None = 0.0,
) -> DataFrame:
    """Long to wide (maximum per cell) with a given list of columns.

    A value that never occurs still gets its column. Conditional aggregates need one
    shuffle by ``on``; ``pivot`` would add another one by ``on`` and ``col``.
    """
    cells = {v: F.max(F.when(F.col(col) == v, F.col(value))) for v in values}
    if fill is not None:
        cells = {v: F.coalesce(c, F.lit(fill)) for v, c in cells.items()}
    return df.groupBy(*on).agg(*[c.alias(f"{v}{suffix}") for v, c in cells.items()])


def common_dates(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key also occurs in ``b``."""
    return a.join(b.select(*on), list(on), "left_semi")


def complete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(cols) if cols else None)


def drop_nonpositive(df: DataFrame, col: str) -> DataFrame:
    """Drop values at or below zero; missing values stay."""
    c = F.col(col)
    return df.where((c > 0) | c.isNull())


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The ``k`` largest; ``tie`` makes the choice repeatable."""
    return df.orderBy(F.col(by).desc(), *tie).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The ``k`` largest of each group, cut down before the shuffle too."""
    w = Window.partitionBy(*group).orderBy(F.col(by).desc(), *tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def lookup_label(c: Column, groups: Mapping[str, Sequence[str]], default: str = "Other") -> Column:
    """Name of the first group that lists the value."""
    table: dict[str, str] = {}
    for name, members in groups.items():
        for member in members:
            table.setdefault(member, name)
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(literal, c), F.lit(default))
