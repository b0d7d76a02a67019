"""Calendar, lag, lead and rolling operators over keyed daily series.

Every operator here works on tables that hold at most one row per key and day. A
key's rows are then bounded by the calendar (a century is 36,525 days) however large
the raw tables are, so one window partition per key stays small even for a key that
owned a third of the raw rows. ``densify`` raises where that does not hold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.functions.rows import ln_or_null

KEYS = ("series_id",)
D = "d"


def by_day(keys: Sequence[str] = KEYS, d: str = D) -> WindowSpec:
    if not keys:
        raise ValueError("a window needs key columns; add a constant one for a single series")
    return Window.partitionBy(*keys).orderBy(d)


def require_date(df: DataFrame, d: str = D) -> None:
    """Raises unless ``d`` is a DATE: with a time of day, a "day" would not be unique and series not bounded by the calendar."""
    kind = df.schema[d].dataType.simpleString()
    if kind != "date":
        raise ValueError(f"{d} must be a date, not {kind}")


def densify(df: DataFrame, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """All days from a key's first to its last one; the added days hold NULLs.

    Each row is expanded up to the day before its successor, which needs one window
    and no join with a calendar. Rows without a date are left out and a repeated day
    raises. Without keys the days run over the whole table, which is checked to be a
    daily table before its days are lined up under one constant key.
    """
    require_date(df, d)
    df = df.where(F.col(d).isNotNull())
    values = [c for c in df.columns if c not in (*keys, d)]
    if not keys:
        once = unique_by(df, [d]).withColumn("_all", F.lit(0))
        return densify(once, ["_all"], d).select(d, *values)
    follower = F.col("_next")
    until = (
        F.when(follower == F.col(d), F.raise_error(F.lit("more than one row for a key and day")).cast("date"))
        .when(follower.isNull(), F.col(d))
        .otherwise(F.date_sub(follower, 1))
    )
    run = df.withColumn("_next", F.lead(d).over(by_day(keys, d))).withColumn("_until", until)
    run = run.select(*keys, d, *values, F.explode(F.sequence(d, "_until")).alias("_day"))
    own = F.col("_day") == F.col(d)
    return run.select(*keys, F.col("_day").alias(d), *[F.when(own, F.col(c)).alias(c) for c in values])


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself if the keys are unique; a repeated key raises at run time."""
    values = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in values])
    ok = F.assert_true(F.col("_n") == 1, F.lit("more than one row for a key"))
    return grouped.where(ok.isNull()).select(*df.columns)


def missing_days(df: DataFrame, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Days between a key's first and last one that have no row."""
    require_date(df, d)
    days = df.where(F.col(d).isNotNull()).select(*keys, d).distinct()
    after = F.date_add(d, 1)
    before_next = F.date_sub(F.lead(d).over(by_day(keys, d)), 1)
    gaps = days.select(*keys, after.alias("_from"), before_next.alias("_to")).where(F.col("_to") >= F.col("_from"))
    return gaps.select(*keys, F.explode(F.sequence("_from", "_to")).alias(d))


def lags(
    df: DataFrame, value: str, ks: Sequence[int], prefix: str = "lag", keys: Sequence[str] = KEYS, d: str = D
) -> DataFrame:
    w = by_day(keys, d)
    return df.withColumns({f"{prefix}{k}": F.lag(value, k).over(w) for k in ks})


def leads_log(
    df: DataFrame, value: str, hs: Sequence[int], prefix: str = "target_h", keys: Sequence[str] = KEYS, d: str = D
) -> DataFrame:
    """Log of the value ``h`` rows ahead; values not above zero give NULL."""
    w = by_day(keys, d)
    led = df.withColumns({f"{prefix}{h}": F.lead(value, h).over(w) for h in hs})
    return led.withColumns({f"{prefix}{h}": ln_or_null(F.col(f"{prefix}{h}")) for h in hs})


_ROLLERS = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min, "sum": F.sum}


def rolling(
    df: DataFrame,
    value: str,
    specs: Mapping[str, tuple[int, str]],
    shift: int = 1,
    keys: Sequence[str] = KEYS,
    d: str = D,
) -> DataFrame:
    """Trailing statistics ``{name: (width, fn)}`` in one window pass.

    A frame of ``width`` rows ends ``shift`` rows back; the result is NULL unless all of
    its values are present. ``fn``: mean, std, max, min, sum or range.
    """
    x, w = F.col(value), by_day(keys, d)
    raw: dict[str, Column] = {}
    out: dict[str, Column] = {}
    for name, (width, fn) in specs.items():
        frame = w.rowsBetween(-(width + shift - 1), -shift)
        raw[f"_n{width}"] = F.count(x).over(frame)
        if fn == "range":
            raw[f"_max_{name}"], raw[f"_min_{name}"] = F.max(x).over(frame), F.min(x).over(frame)
            stat = F.col(f"_max_{name}") - F.col(f"_min_{name}")
        else:
            raw[f"_{name}"] = _ROLLERS[fn](x).over(frame)
            stat = F.col(f"_{name}")
        out[name] = F.when(F.col(f"_n{width}") == width, stat)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in out]
    return df.withColumns(raw).select(*kept, *[c.alias(n) for n, c in out.items()])


def step_to_daily(
    df: DataFrame,
    value: str,
    as_of: str | Column,
    keys: Sequence[str] = KEYS,
    d: str = D,
    start: str | None = None,
) -> DataFrame:
    """Change records to one row per day, each value holding until the next change.

    Days end the day before ``as_of``. ``start`` drops earlier changes **before** the
    expansion, so a value already in force at ``start`` is not carried into it.
    """
    last_day = F.date_sub(F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of, 1)
    rows = df.where(F.col(d).isNotNull() & F.col(value).isNotNull())
    if start is not None:
        rows = rows.where(F.col(d) >= F.lit(start).cast("date"))
    rows = rows.withColumn("_last", last_day).where(F.col(d) <= F.col("_last"))
    follower = F.lead(d).over(by_day(keys, d))
    until = F.least(F.coalesce(F.date_sub(follower, 1), F.col("_last")), F.col("_last"))
    run = rows.withColumn("_until", until).where(F.col("_until") >= F.col(d))
    return run.select(*keys, F.explode(F.sequence(d, "_until")).alias(d), value)


def extend_monthly(
    df: DataFrame, value: str, as_of: str, keys: Sequence[str] = KEYS, d: str = D
) -> DataFrame:
    """Add the month starts after a key's last date up to ``as_of``, with its last value."""
    end = F.lit(as_of).cast("date")
    last = df.groupBy(*keys).agg(F.max(d).alias("_last"), F.max_by(value, d).alias(value))
    first = F.trunc(F.add_months("_last", 1), "month")
    added = (
        last.withColumn("_first", first)
        .where(F.col("_first") <= end)
        .select(*keys, F.explode(F.sequence("_first", end, F.expr("interval 1 month"))).alias(d), value)
    )
    return df.select(*keys, d, value).unionByName(added)


def month_windows(df: DataFrame, start: str = "start", end: str = "end", keys: Sequence[str] = ()) -> DataFrame:
    """Fetch windows per month: ``[window_start, window_end)`` and the last day stored.

    The last window is cut to the day after ``end``.
    """
    months = F.explode(F.sequence(F.trunc(start, "month"), F.col(end), F.expr("interval 1 month")))
    rows = df.select(*keys, end, months.alias("window_start"))
    stop = F.least(F.add_months("window_start", 1), F.date_add(end, 1))
    return rows.select(
        *keys, "window_start", stop.alias("window_stop"), F.date_sub(stop, 1).alias("window_end")
    )


def latest_value(df: DataFrame, value: str, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Last date of each key with its value."""
    return df.groupBy(*keys).agg(F.max(d).alias(d), F.max_by(value, d).alias(value))


def chrono_position(df: DataFrame, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """``row_no`` (from 1) and ``n_rows`` of each key."""
    whole = Window.partitionBy(*keys)
    return df.withColumns(
        {"row_no": F.row_number().over(by_day(keys, d)), "n_rows": F.count(F.lit(1)).over(whole)}
    )


def chrono_split(
    df: DataFrame, share: float = 0.8, keys: Sequence[str] = KEYS, d: str = D
) -> DataFrame:
    """Column ``split``: the first ``floor(n * share)`` rows of each key train, the rest test."""
    placed = chrono_position(df, keys, d)
    cut = F.floor(F.col("n_rows") * F.lit(float(share)))
    split = F.when(F.col("row_no") <= cut, "train").otherwise("test")
    return placed.withColumn("split", split).drop("row_no", "n_rows")


def fold_roles(
    df: DataFrame, n_splits: int = 5, gap: int = 0, keys: Sequence[str] = KEYS, d: str = D
) -> tuple[DataFrame, list[Column]]:
    """``df`` with positions, and for each fold the role of a row: "train", "test" or NULL."""
    placed = chrono_position(df, keys, d)
    pos = F.col("row_no") - 1
    size = F.floor(F.col("n_rows") / (n_splits + 1))
    roles = []
    for fold in range(1, n_splits + 1):
        start = F.col("n_rows") - (n_splits + 1 - fold) * size
        roles.append(F.when((pos >= start) & (pos < start + size), "test").when(pos < start - gap, "train"))
    return placed, roles


def ts_folds(
    df: DataFrame, n_splits: int = 5, gap: int = 0, keys: Sequence[str] = KEYS, d: str = D
) -> DataFrame:
    """Expanding-window folds: every row once per fold it takes part in.

    Test blocks hold ``floor(n / (n_splits + 1))`` rows and end at the last row; the
    training rows of a fold end ``gap`` rows before its test block.
    """
    placed, roles = fold_roles(df, n_splits, gap, keys, d)
    each = [F.struct(F.lit(fold).alias("fold"), role.alias("role")) for fold, role in enumerate(roles, 1)]
    rows = placed.withColumn("_f", F.explode(F.array(*each))).drop("n_rows")
    return rows.select("*", "_f.fold", "_f.role").drop("_f").where(F.col("role").isNotNull())
