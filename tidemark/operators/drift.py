"""Data and model drift.

The reports only promise these; the contracts are our own: population stability
index per feature, and a rolling error against the training error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(feature, *by, value, n)``: how often each value of a feature occurs, NULL left out.

    Counts of parts of the rows add up to those of all, so they can be kept by day and summed for any window.
    """
    lines = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    rows = df.select(*by, F.explode(F.array(*lines)).alias("_l")).select(*by, "_l.*").where(F.col("value").isNotNull())
    return rows.groupBy("feature", *by, "value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(
    rows: DataFrame, quantiles: Sequence[float], by: str = "feature", value: str = "value", partitions: int | None = None, n_col: str | None = None
) -> DataFrame:
    """``(by, _edges)``: for each share the smallest value with at least that share of the group's rows at or below it.

    ``n_col``: how many rows a row stands for. Rows are first reduced to one per group and value. Those are range-partitioned and ranked
    inside their partitions; one row per partition hands the totals on. A group of any size is spread
    over many tasks, and no value is approximate.
    """
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(by, value).agg(F.sum(n_col or F.lit(1)).alias("_n"))
    ranged = counts.repartitionByRange(n, by, value).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy(by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("_upto", F.sum("_n").over(inside))
    totals = placed.groupBy(by, "_part").agg(F.sum("_n").alias("_sum"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        by, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"), F.sum("_sum").over(Window.partitionBy(by)).alias("_all")
    )
    ranked = placed.join(totals, [by, "_part"]).withColumn("_rank", F.col("_before") + F.col("_upto"))
    wanted = [F.greatest(F.ceil(F.lit(q) * F.col("_all")), F.lit(1)) for q in quantiles]
    edges = [F.min(F.when(F.col("_rank") >= w, F.col(value))) for w in wanted]
    return ranked.groupBy(by).agg(F.array(*edges).alias("_edges"))


def _binned(counts: DataFrame, edges: DataFrame, bins: int) -> DataFrame:
    """``(feature, rows)``: the number of rows in each bin. ``edges`` has one short array per feature and is broadcast."""
    place = F.size(F.filter("edges", lambda e: e < F.col("value")))
    placed = counts.join(F.broadcast(edges), "feature").select("feature", "n", place.alias("_bin"))
    held = [F.coalesce(F.sum(F.when(F.col("_bin") == k, F.col("n"))), F.lit(0)) for k in range(bins)]
    return placed.groupBy("feature").agg(F.array(*held).alias("rows"))


def reference(counts: DataFrame, bins: int = 10) -> DataFrame:
    """``(feature, edges, rows)``: quantile edges of the reference window and its rows in each bin, exact at any size.

    One row per feature: kept as a table, it spares later checks the reference window itself.
    """
    edges = exact_quantiles(counts, [i / bins for i in range(1, bins)], n_col="n").withColumnRenamed("_edges", "edges")
    return edges.join(_binned(counts, edges, bins), "feature")


def psi_against(ref: DataFrame, counts: DataFrame, threshold: float = 0.2, bins: int = 10) -> DataFrame:
    """Population stability index of ``counts`` against ``reference``; shares are floored at 1e-4.

    A feature without rows now has a NULL index, one without rows in the reference is left out.
    """
    now = _binned(counts, ref.select("feature", "edges"), bins).withColumnRenamed("rows", "_now")

    def shares(held: str):
        total = F.aggregate(held, F.lit(0).cast("long"), lambda a, n: a + n)
        return F.transform(held, lambda n: F.greatest(F.try_divide(n, total), F.lit(1e-4)))

    parts = F.zip_with(shares("rows"), shares("_now"), lambda r, c: (c - r) * F.ln(c / r))
    score = F.when(F.col("_now").isNotNull(), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x))
    return ref.join(now, "feature", "left").select("feature", score.alias("psi")).withColumn("drift", F.col("psi") > threshold)


def psi(ref: DataFrame, cur: DataFrame, cols: Sequence[str], bins: int = 10, threshold: float = 0.2) -> DataFrame:
    """Population stability index of each feature over quantile bins of the reference window."""
    return psi_against(reference(value_counts(ref, cols), bins), value_counts(cur, cols), threshold, bins)


def rolling_mae(
    pred: DataFrame,
    days: int = 28,
    by: Sequence[str] = ("exp", "model", "horizon"),
    ratio: float = 1.5,
    d: str = "d",
) -> DataFrame:
    """Error of the last ``days`` days of the test rows against the training error.

    Daily sums first, so the window holds one row per group and day. The training
    error rides along as a sum over the same rows' group instead of a join.
    """
    err = F.abs(F.exp("y_true") - F.exp("y_pred"))
    daily = pred.groupBy(*by, d).agg(
        F.sum(F.when(F.col("split") == "test", err)).alias("_sum"),
        F.count(F.when(F.col("split") == "test", err)).alias("_n"),
        F.sum(F.when(F.col("split") == "train", err)).alias("_train_sum"),
        F.count(F.when(F.col("split") == "train", err)).alias("_train_n"),
    )
    day_no = F.datediff(d, F.lit("1970-01-01").cast("date"))
    span = Window.partitionBy(*by).orderBy("_day").rangeBetween(-(days - 1), 0)
    whole = Window.partitionBy(*by)
    out = daily.withColumn("_day", day_no).select(
        *by,
        d,
        "_n",
        F.try_divide(F.sum("_sum").over(span), F.sum("_n").over(span)).alias("rolling_mae"),
        F.try_divide(F.sum("_train_sum").over(whole), F.sum("_train_n").over(whole)).alias("train_mae"),
    )
    return out.where(F.col("_n") > 0).drop("_n").withColumn(
        "drift", F.col("rolling_mae") > F.col("train_mae") * ratio
    )
