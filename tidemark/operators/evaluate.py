"""Evaluation over one long table of predictions.

``predictions(exp, model, horizon, fold, split, series_id, d, y_true, y_pred)`` holds
logarithms, as the models are fitted on log prices. Everything here is grouped
aggregation over that table, so one group may be as large as it likes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.tdist import student_t_cdf
from tidemark.operators.series import unique_by

ID = ("exp", "model", "horizon")
#: Spikes are judged within each series: a dear series is not all spikes, a cheap one not without any.
EACH = (*ID, "series_id")


def r2_column(y: Column, p: Column) -> Column:
    """Share of variance explained, as an aggregate.

    A constant target gives 1 for a perfect prediction and 0 otherwise; fewer than two
    rows give NULL.
    """
    err = F.sum((y - p) * (y - p))
    total = F.count(y) * F.var_pop(y)
    flat = F.when(err == 0, 1.0).otherwise(0.0)
    return F.when(F.count(y) < 2, F.lit(None)).when(total == 0, flat).otherwise(1 - err / total)


def metric_columns(space: str = "price", y: str = "y_true", p: str = "y_pred") -> list[Column]:
    """Aggregates n, r2, rmse, mae and mape (price space) or npr_error (log space).

    Rows without a prediction take no part.
    """
    if space not in ("price", "log"):
        raise ValueError("space must be 'price' or 'log'")
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    yt, yp = (F.when(both, F.exp(c) if space == "price" else F.col(c)) for c in (y, p))
    err = yt - yp
    cols = [
        F.count(err).alias("n"),
        r2_column(yt, yp).alias("r2"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
    ]
    if space == "price":
        cols.append((F.avg(F.abs(err / (yt + F.lit(1e-6)))) * 100).alias("mape"))
    else:
        cols.append((F.lit(fixed.MEAN_PRICE) * (F.exp(F.avg(F.abs(err))) - 1)).alias("npr_error"))
    return cols


def metrics(pred: DataFrame, by: Sequence[str] = (*ID, "split"), space: str = "price") -> DataFrame:
    return pred.groupBy(*by).agg(*metric_columns(space))


def overfit_gap(pred: DataFrame, by: Sequence[str] = ID, space: str = "price") -> DataFrame:
    """Train and test R² side by side, their gap and a grade."""
    rows = metrics(pred, [*by, "split"], space)
    wide = rows.groupBy(*by).agg(
        F.max(F.when(F.col("split") == "train", F.col("r2"))).alias("train_r2"),
        F.max(F.when(F.col("split") == "test", F.col("r2"))).alias("test_r2"),
        *[F.max(F.when(F.col("split") == "test", F.col(c))).alias(c) for c in rows.columns if c in ("rmse", "mae", "mape", "npr_error")],
    )
    gap = F.col("train_r2") - F.col("test_r2")
    grade = (
        F.when(gap < fixed.GAP_GOOD, "good").when(gap < fixed.GAP_ACCEPTABLE, "acceptable").when(gap.isNotNull(), "high")
    )
    return wide.withColumn("overfit_gap", gap).withColumn("grade", grade)


def diebold_mariano(
    pred: DataFrame,
    against: str = "PERSISTENCE",
    by: Sequence[str] = ID,
    on: Sequence[str] = ("series_id", "d", "horizon"),
    min_dates: int = fixed.MIN_DM_DATES,
) -> DataFrame:
    """One-sided test that a model is more accurate than ``against`` on their common dates.

    Squared errors in price space, no correction for autocorrelation. A group with
    fewer than ``min_dates`` common rows keeps its row, with ``enough`` false and no statistic.
    With several rows of ``against`` for one place in ``on``, the test raises.
    """
    test = pred.where(F.col("split") == "test")
    err = F.exp("y_pred") - F.exp("y_true")
    model = test.where(F.col("model") != against).select(*dict.fromkeys([*by, *on]), (err * err).alias("_e1"))
    base = unique_by(test.where(F.col("model") == against).select(*on, (err * err).alias("_e2")), on)
    diff = model.join(base, list(on)).withColumn("_diff", F.col("_e1") - F.col("_e2"))
    out = diff.groupBy(*by).agg(
        F.count("_diff").alias("n"),
        F.avg("_diff").alias("_mean"),
        F.stddev_samp("_diff").alias("_std"),
    )
    stat = F.try_divide(F.col("_mean"), F.col("_std") / F.sqrt("n"))
    out = out.withColumn("enough", F.col("n") >= min_dates).withColumn("dm_stat", F.when(F.col("enough"), stat))
    p = student_t_cdf(F.col("dm_stat"), F.col("n") - 1)
    return (
        out.withColumn("p_value", p)
        .withColumn("significant", F.col("p_value") < fixed.SIGNIFICANCE)
        .drop("_mean", "_std")
    )


def walk_forward_summary(pred: DataFrame, by: Sequence[str] = ID) -> DataFrame:
    """Metrics per fold, then a Mean and a Std row (population) over the folds.

    One pass: the summary is the grouping level above the folds.
    """
    names = ["r2", "mae", "mape"]
    folds = pred.groupBy(*by, "fold").agg(*metric_columns("price")).select(*by, "fold", *names)
    levels = folds.groupingSets(
        [[*[F.col(b) for b in by], F.col("fold")], [F.col(b) for b in by]], *[F.col(b) for b in by], F.col("fold")
    ).agg(
        F.grouping("fold").alias("_all"),
        *[F.avg(n).alias(f"_mean_{n}") for n in names],
        *[F.stddev_pop(n).alias(f"_std_{n}") for n in names],
    )

    def line(label: Column, kind: str):
        return F.struct(label.alias("fold"), *[F.col(f"_{kind}_{n}").alias(n) for n in names])

    single = F.array(line(F.concat(F.lit("Fold "), F.col("fold").cast("string")), "mean"))
    pair = F.array(line(F.lit("Mean"), "mean"), line(F.lit("Std"), "std"))
    rows = levels.withColumn("_l", F.explode(F.when(F.col("_all") == 1, pair).otherwise(single)))
    return rows.select(*by, "_l.*")


def spike_threshold(pred: DataFrame, sigma: float = fixed.SPIKE_SIGMA, by: Sequence[str] = EACH) -> DataFrame:
    """Mean plus ``sigma`` sample deviations of the training prices, by series; ``by=ID`` pools all series."""
    price = F.exp("y_true")
    return (
        pred.where(F.col("split") == "train")
        .groupBy(*by)
        .agg((F.avg(price) + F.lit(sigma) * F.stddev_samp(price)).alias("threshold"))
    )


def spike_labels(pred: DataFrame, sigma: float = fixed.SPIKE_SIGMA, by: Sequence[str] = EACH) -> DataFrame:
    """Test rows with the threshold and 0/1 labels; a missing prediction counts as 0."""
    test = pred.where(F.col("split") == "test")
    rows = test.join(spike_threshold(pred, sigma, by), list(by))
    return rows.withColumns(
        {
            "is_spike": F.coalesce(F.exp("y_true") > F.col("threshold"), F.lit(False)).cast("int"),
            "pred_spike": F.coalesce(F.exp("y_pred") > F.col("threshold"), F.lit(False)).cast("int"),
        }
    )


def spike_prf(labels: DataFrame, by: Sequence[str] = EACH) -> DataFrame:
    """Precision, recall and F1 of the spike class, 0 where undefined."""
    hit = F.sum(F.col("is_spike") * F.col("pred_spike"))
    out = labels.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_spike").alias("shocks"),
        F.sum("pred_spike").alias("_called"),
        hit.alias("_hit"),
    )
    ratio = {
        "precision": F.coalesce(F.try_divide(F.col("_hit"), F.col("_called")), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(F.col("_hit"), F.col("shocks")), F.lit(0.0)),
        "f1": F.coalesce(F.try_divide(F.lit(2) * F.col("_hit"), F.col("_called") + F.col("shocks")), F.lit(0.0)),
        "shock_pct": F.col("shocks") / F.col("n") * 100,
        "few_shocks": F.col("shocks") < fixed.FEW_SHOCKS,
    }
    return out.withColumns(ratio).drop("_called", "_hit")


def grouped_auc(
    df: DataFrame, score: str, label: str, by: Sequence[str] = ID, partitions: int | None = None
) -> DataFrame:
    """Area under the ROC curve per group, ties counted half; NULL without both classes.

    Rows are first reduced to one per group and score. Those are range-partitioned, so
    a large group is spread over many tasks; each partition ranks its own scores and
    hands one row of totals to the last step. No group is gathered in one place.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, score)
        .agg(F.sum(label).alias("_pos"), F.sum(1 - F.col(label)).alias("_neg"))
    )
    ranged = counts.repartitionByRange(n, *by, score).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy(*by, "_part").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    wins = F.col("_pos") * (F.col("_below") + F.col("_neg") / 2)
    parts = (
        ranged.withColumn("_below", below)
        .groupBy(*by, "_part")
        .agg(F.sum(wins).alias("_wins"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    )
    across = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.col("_wins") + F.col("_pos") * F.coalesce(F.sum("_neg").over(across), F.lit(0))
    return (
        parts.withColumn("_wins", carried)
        .groupBy(*by)
        .agg(F.sum("_wins").alias("_wins"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
        .select(*by, F.try_divide(F.col("_wins"), F.col("_pos") * F.col("_neg")).alias("auc"))
    )


def spike_report(pred: DataFrame, sigma: float = fixed.SPIKE_SIGMA, by: Sequence[str] = EACH) -> DataFrame:
    """Precision, recall, F1 and AUC of spike detection per group."""
    labels = spike_labels(pred, sigma, by).select(*by, "is_spike", "pred_spike", F.exp("y_pred").alias("_price"))
    return spike_prf(labels, by).join(grouped_auc(labels, "_price", "is_spike", by), list(by), "left")


def subset_metrics(
    pred: DataFrame,
    flags: DataFrame,
    flag: str = "disruption_flag",
    by: Sequence[str] = ID,
    on: Sequence[str] = ("series_id", "d"),
    min_rows: int = fixed.MIN_SUBSET_ROWS,
) -> DataFrame:
    """Metrics on all test rows, on flagged and on unflagged ones, in one pass.

    A date without a flag counts as unflagged. A subset below ``min_rows`` keeps its row, with
    ``enough`` false and no score.
    """
    keys = [F.col(b) for b in by]
    test = pred.where(F.col("split") == "test")
    joined = test.join(flags.select(*on, F.col(flag).alias("_flag")), list(on), "left")
    joined = joined.withColumn("_flag", F.coalesce(F.col("_flag"), F.lit(0)))
    out = joined.groupingSets([keys, [*keys, F.col("_flag")]], *keys, F.col("_flag")).agg(
        F.grouping("_flag").alias("_all"), *metric_columns("price")
    )
    subset = (
        F.when(F.col("_all") == 1, "All test dates").when(F.col("_flag") == 1, "Disruption dates")
        .otherwise("Non-disruption dates")
    )
    enough = F.col("n") >= min_rows
    scores = [F.when(enough, F.col(c)).alias(c) for c in ("r2", "mae", "mape")]
    return out.select(*by, subset.alias("subset"), "n", enough.alias("enough"), *scores)


def residuals(pred: DataFrame) -> DataFrame:
    """Actual minus predicted, in price space."""
    return pred.withColumn("residual", F.exp("y_true") - F.exp("y_pred"))


def residual_stats(pred: DataFrame, by: Sequence[str] = (*ID, "split")) -> DataFrame:
    """Mean and population deviation of the residuals."""
    return residuals(pred).groupBy(*by).agg(
        F.count("residual").alias("n"),
        F.avg("residual").alias("residual_mean"),
        F.stddev_pop("residual").alias("residual_std"),
    )


def summary(
    gaps: DataFrame, model: str | None = None, exp: str | None = None, horizon: int | None = None
) -> DataFrame:
    """Rows of one model or one experiment, best test score first."""
    for name, wanted in (("model", model), ("exp", exp), ("horizon", horizon)):
        if wanted is not None:
            gaps = gaps.where(F.col(name) == wanted)
    return gaps.orderBy(F.col("test_r2").desc_nulls_last(), "exp", "model")
