"""Descriptive statistics and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.tdist import two_sided_p
from tidemark.operators.series import D, KEYS, by_day


def monthly_profile(df: DataFrame, value: str, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Mean, spread, count and premium (percent over the key's overall mean) per month.

    The overall mean is taken from the twelve monthly sums, not from a second pass.
    """
    monthly = df.groupBy(*keys, F.month(d).alias("month")).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.count(value).alias("count"),
        F.sum(value).alias("_sum"),
    )
    year = Window.partitionBy(*keys)
    overall = F.sum("_sum").over(year) / F.sum("count").over(year)
    premium = (F.col("mean") - overall) / overall * 100
    return monthly.withColumn("premium_pct", premium).drop("_sum")


def monthly_sem(df: DataFrame, value: str, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Mean and standard error per month."""
    return df.groupBy(*keys, F.month(d).alias("month")).agg(
        F.avg(value).alias("mean"),
        (F.stddev_samp(value) / F.sqrt(F.count(value))).alias("sem"),
    )


def flag_stats(df: DataFrame, flag: str, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Days and share of a 0/1 flag, min/max/mean/std of other columns, in one pass."""
    aggs = [F.sum(flag).alias(f"{flag}_days"), (F.avg(F.col(flag).cast("double")) * 100).alias(f"{flag}_pct")]
    for v in values:
        aggs += [F.min(v).alias(f"{v}_min"), F.max(v).alias(f"{v}_max"), F.avg(v).alias(f"{v}_mean"),
                 F.stddev_samp(v).alias(f"{v}_std")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def quality_report(df: DataFrame, d: str = D) -> DataFrame:
    """``(item, column_name, value)``: rows, columns, date range, repeated rows, NULLs per column.

    Columns without NULLs are left out. Repeated rows need the distinct rows, and all
    other figures are taken from the same pass as weighted sums over those.
    """
    names = df.columns
    distinct = df.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count(F.lit(1)).alias("_n"))
    nulls = [
        F.coalesce(F.sum(F.when(F.col(f"`{c}`").isNull(), F.col("_n"))), F.lit(0)).alias(f"_null_{i}")
        for i, c in enumerate(names)
    ]
    one = distinct.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_repeated"),
        F.min(d).alias("_from"),
        F.max(d).alias("_to"),
        *nulls,
    )

    def line(item: str, column: str, value):
        return F.struct(F.lit(item).alias("item"), F.lit(column).alias("column_name"),
                        value.cast("string").alias("value"))

    lines = [
        line("rows", "", F.col("_rows")),
        line("columns", "", F.lit(len(names))),
        line("repeated_rows", "", F.col("_repeated")),
        line("first_date", d, F.col("_from").cast("date")),
        line("last_date", d, F.col("_to").cast("date")),
        *[line("nulls", c, F.col(f"_null_{i}")) for i, c in enumerate(names)],
    ]
    out = one.select(F.explode(F.array(*lines)).alias("_l")).select("_l.*")
    return out.where((F.col("item") != "nulls") | (F.col("value") != "0"))


def pearson(a: str, b: str) -> Column:
    """Correlation over the rows where both are present; NULL where one of them is constant.

    The built-in aggregate divides by zero there.
    """
    x, y = F.col(a), F.col(b)
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = 2) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present, long form.

    Each pair is computed once and mirrored; a column with itself gives 1 unless it is constant.
    """
    pairs = list(combinations(cols, 2))
    own = [F.when(F.stddev_pop(c) > 0, F.lit(1.0)).alias(f"_o{i}") for i, c in enumerate(cols)]
    one = df.agg(*[pearson(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)], *own)

    def line(a: str, b: str, source: str) -> Column:
        c = F.col(source)
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), (c if digits is None else F.bround(c, digits)).alias("corr"))

    lines = [line(x, y, f"_c{i}") for i, (a, b) in enumerate(pairs) for x, y in ((a, b), (b, a))]
    lines += [line(c, c, f"_o{i}") for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*lines)).alias("_l")).select("_l.*")


def autocorr(df: DataFrame, value: str, k: int = 1, keys: Sequence[str] = KEYS, d: str = D) -> DataFrame:
    """Correlation of a series with itself ``k`` rows back."""
    lagged = df.withColumn("_lag", F.lag(value, k).over(by_day(keys, d)))
    return lagged.groupBy(*keys).agg(pearson("_lag", value).alias(f"autocorr_lag{k}"))


def season_ttest(
    df: DataFrame,
    value: str,
    seasons: Mapping[str, Sequence[int]] = fixed.SEASON_REPORT,
    keys: Sequence[str] = KEYS,
    d: str = D,
    against_rest: Sequence[str] = fixed.SEASON_AGAINST_REST,
) -> DataFrame:
    """Days in a season against the days outside it: equal-variance t-test per key.

    The premium is taken against the overall mean, or for the seasons in
    ``against_rest`` against the mean outside. All seasons come from one aggregation.
    """
    x, month = F.col(value), F.month(d)
    aggs = [F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_std")]
    for i, months in enumerate(seasons.values()):
        inside = month.isin(*months)
        for side, hit in (("in", inside), ("out", ~inside)):
            part = F.when(hit, x)
            aggs += [F.avg(part).alias(f"_{side}{i}_mean"), F.var_samp(part).alias(f"_{side}{i}_var"),
                     F.count(part).alias(f"_{side}{i}_n")]
    one = df.groupBy(*keys).agg(*aggs)
    lines = []
    for i, name in enumerate(seasons):
        m1, v1, n1 = (F.col(f"_in{i}_{s}") for s in ("mean", "var", "n"))
        m2, v2, n2 = (F.col(f"_out{i}_{s}") for s in ("mean", "var", "n"))
        pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
        t = F.try_divide(m1 - m2, F.sqrt(pooled * (F.lit(1.0) / n1 + F.lit(1.0) / n2)))
        base = m2 if name in against_rest else F.col("_mean")
        lines.append(
            F.struct(
                F.lit(name).alias("period"), m1.alias("season_mean"), F.col("_mean").alias("annual_mean"),
                F.col("_std").alias("annual_std"),
                ((m1 - base) / base * 100).alias("premium_pct"), t.alias("t_stat"), (n1 + n2 - 2).alias("dof"),
            )
        )
    out = one.select(*keys, F.explode(F.array(*lines)).alias("_l")).select(*keys, "_l.*")
    p = two_sided_p(F.col("t_stat"), F.col("dof"))
    return out.withColumn("p_value", p).withColumn("significant", F.col("p_value") < fixed.SIGNIFICANCE)


def sum_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.sum(value).alias(value)).orderBy(F.col(value).desc(), group)
