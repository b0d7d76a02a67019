"""Filling gaps in keyed daily series.

Looking ahead is done by a second window in descending order: a frame that ends at
``unboundedFollowing`` is evaluated anew for every row, whereas a descending running
frame is one pass. All columns of one call share at most two windows, the ascending one
last, so that the lags computed next find their order already there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.operators.series import D, KEYS, by_day

STRATEGIES = ("ffill", "bfill", "ffill_bfill", "interpolate", "interpolate_fill", "zero", "keep")


def fill(df: DataFrame, policy: Mapping[str, str], keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Fill columns as told by ``{column: strategy}``.

    * ``ffill`` / ``bfill`` / ``ffill_bfill``: last value before, next value after, or both in turn
    * ``interpolate``: straight line between neighbours by row position; NULLs before the
      first value stay, NULLs after the last one take it
    * ``interpolate_fill``: the same, and the leading NULLs take the first value
    * ``zero``: 0;  ``keep``: unchanged
    """
    for column, strategy in policy.items():
        if strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {strategy!r} for {column!r}")
    order = df.columns
    linear = [c for c, s in policy.items() if s.startswith("interpolate")]
    ahead = [c for c, s in policy.items() if s in ("bfill", "ffill_bfill")] + linear
    behind = [c for c, s in policy.items() if s in ("ffill", "ffill_bfill")] + linear
    if ahead:
        down = Window.partitionBy(*keys).orderBy(F.col(d).desc())
        df = df.withColumn("_pos", F.row_number().over(down)) if linear else df
        df = df.withColumns(_running(df, ahead, linear, "next", down))
    if behind:
        df = df.withColumns(_running(df, behind, linear, "prev", by_day(keys, d)))
    return df.select(*[_filled(c, policy[c]).alias(c) if c in policy else F.col(c) for c in order])


def _running(df: DataFrame, cols: Sequence[str], linear: Sequence[str], side: str, w: WindowSpec) -> dict:
    """Last value seen so far, and for straight lines also its position."""
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    out = {f"_{side}_{c}": F.last(c, ignorenulls=True).over(frame) for c in cols}
    for c in linear:
        at = F.when(F.col(c).isNotNull(), F.col("_pos"))
        out[f"_{side}pos_{c}"] = F.last(at, ignorenulls=True).over(frame)
    return out


def _filled(c: str, strategy: str) -> Column:
    x, prev, nxt = F.col(c), F.col(f"_prev_{c}"), F.col(f"_next_{c}")
    if strategy == "keep":
        return x
    if strategy == "zero":
        return F.coalesce(x, F.lit(0.0))
    if strategy == "ffill":
        return prev
    if strategy == "bfill":
        return nxt
    if strategy == "ffill_bfill":
        return F.coalesce(prev, nxt)
    share = (F.col("_pos") - F.col(f"_prevpos_{c}")) / (F.col(f"_nextpos_{c}") - F.col(f"_prevpos_{c}"))
    line = F.when(x.isNotNull(), x).when(nxt.isNotNull(), prev + (nxt - prev) * share).otherwise(prev)
    return F.coalesce(line, nxt) if strategy == "interpolate_fill" else line


def ffill(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    return fill(df, {c: "ffill" for c in cols}, keys, d)


def bfill(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    return fill(df, {c: "bfill" for c in cols}, keys, d)


def interpolate(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    return fill(df, {c: "interpolate" for c in cols}, keys, d)
