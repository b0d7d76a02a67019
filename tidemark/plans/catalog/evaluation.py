"""Evaluation over the naive forecasts, for which everything can be said in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import drift, evaluate, series
from tidemark.plans import modelling, roles
from tidemark.plans.catalog import sql as S
from tidemark.plans.catalog.daily import filled
from tidemark.plans.catalog.registry import query
from tidemark.plans.catalog.statistics import t_cdf_sql
from tidemark.plans.reports import first_predictions

P = S.PERSISTENCE
ID = "exp, model, horizon"
OK = "(SELECT * FROM {t} WHERE y_true IS NOT NULL AND y_pred IS NOT NULL)"
R2 = "1 - sum(({y} - {p}) * ({y} - {p})) / (count({y}) * var_pop({y}))"


def metric_sql(table: str, by: str, where: str = "true") -> str:
    y, p = "exp(y_true)", "exp(y_pred)"
    return f"""SELECT {by}, count(*) AS n, {R2.format(y=y, p=p)} AS r2, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse,
      avg(abs({y} - {p})) AS mae, avg(abs(({y} - {p}) / ({y} + 1e-6))) * 100 AS mape FROM {OK.format(t=table)} WHERE {where} GROUP BY {by}"""


def pred(spark, sf):
    return modelling.persistence(filled(spark, sf))


def two_models(spark, sf):
    """Naive forecasts by both anchors, the second one under a model name of its own."""
    daily = filled(spark, sf)
    last = modelling.persistence(daily, anchor="last").withColumn("model", F.lit("LAST")).withColumn("exp", F.lit("NAIVE"))
    return modelling.persistence(daily).unionByName(last)


LAST = """last AS (SELECT 'NAIVE' AS exp, 'LAST' AS model, CAST(horizon AS INTEGER) AS horizon, 0 AS fold,
  CASE WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split, series_id, d, y_true,
  ln(greatest(Average_Price, 1)) AS y_pred FROM placed)"""


@query("persistence", f"WITH {P} SELECT * FROM pred", "y_true y_pred")
def _(spark, sf):
    return pred(spark, sf)


@query("metrics_price", f"WITH {P} {metric_sql('pred', ID + ', split')}", "r2 rmse mae mape")
def _(spark, sf):
    return evaluate.metrics(pred(spark, sf))


@query("metrics_log", f"""WITH {P} SELECT {ID}, split, count(*) AS n, {R2.format(y='y_true', p='y_pred')} AS r2,
  sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, avg(abs(y_true - y_pred)) AS mae,
  52.86::DOUBLE * (exp(avg(abs(y_true - y_pred))) - 1) AS npr_error FROM {OK.format(t='pred')} GROUP BY {ID}, split""", "r2 rmse mae npr_error")
def _(spark, sf):
    return evaluate.metrics(pred(spark, sf), space="log")


_GAP = f"""WITH {P}, {LAST}, both_models AS (SELECT * FROM pred UNION ALL SELECT * FROM last),
  m AS ({metric_sql('both_models', ID + ', split')}),
  g AS (SELECT {ID}, max(r2) FILTER (split = 'train') AS train_r2, max(r2) FILTER (split = 'test') AS test_r2,
    max(rmse) FILTER (split = 'test') AS rmse, max(mae) FILTER (split = 'test') AS mae, max(mape) FILTER (split = 'test') AS mape
    FROM m GROUP BY {ID}),
  r AS (SELECT *, train_r2 - test_r2 AS overfit_gap,
    CASE WHEN train_r2 - test_r2 < 0.1 THEN 'good' WHEN train_r2 - test_r2 < 0.15 THEN 'acceptable' ELSE 'high' END AS grade FROM g)"""
_GAP_DOUBLES = "train_r2 test_r2 rmse mae mape overfit_gap"


@query("overfit_gap", f"{_GAP} SELECT * FROM r", _GAP_DOUBLES)
def _(spark, sf):
    return evaluate.overfit_gap(two_models(spark, sf))


@query("summary_full_model", f"{_GAP} SELECT * FROM r WHERE exp = 'NAIVE'", _GAP_DOUBLES)
def _(spark, sf):
    return evaluate.summary(evaluate.overfit_gap(two_models(spark, sf)), exp="NAIVE")


@query("diebold_mariano", f"""WITH {P}, {LAST}, j AS (
  SELECT last.exp, last.model, last.horizon, pow(exp(last.y_pred) - exp(last.y_true), 2) - pow(exp(pred.y_pred) - exp(pred.y_true), 2) AS diff
  FROM last JOIN pred USING (series_id, d, horizon) WHERE last.split = 'test' AND pred.split = 'test'),
  a AS (SELECT {ID}, count(diff) AS n, avg(diff) / (stddev_samp(diff) / sqrt(count(diff))) AS dm_stat FROM j GROUP BY {ID}),
  p AS (SELECT *, {t_cdf_sql('dm_stat', '(n - 1)')} AS p_value FROM a WHERE n >= 20)
  SELECT {ID}, n, n >= 20 AS enough, p.dm_stat, p_value, p_value < 0.05 AS significant FROM a LEFT JOIN p USING ({ID}, n)""", "dm_stat p_value")
def _(spark, sf):
    return evaluate.diebold_mariano(two_models(spark, sf))


@query("diebold_mariano_series", f"""WITH {P}, {LAST}, j AS (
  SELECT last.exp, last.model, last.horizon, series_id, d, pow(exp(last.y_pred) - exp(last.y_true), 2) - pow(exp(pred.y_pred) - exp(pred.y_true), 2) AS diff
  FROM last JOIN pred USING (series_id, d, horizon) WHERE last.split = 'test' AND pred.split = 'test'),
  a AS (SELECT {ID}, series_id, count(diff) AS n, avg(diff) / (stddev_samp(diff) / sqrt(count(diff))) AS dm_stat FROM j GROUP BY {ID}, series_id),
  p AS (SELECT *, {t_cdf_sql('dm_stat', '(n - 1)')} AS p_value FROM a WHERE n >= 20)
  SELECT {ID}, series_id, n, n >= 20 AS enough, p.dm_stat, p_value, p_value < 0.05 AS significant
  FROM a LEFT JOIN p USING ({ID}, series_id, n)""", "dm_stat p_value")
def _(spark, sf):
    return evaluate.diebold_mariano(two_models(spark, sf), by=evaluate.EACH)


_WF = f"""SELECT exp, model, horizon, fold, r2, mae, mape FROM ({metric_sql('f', 'exp, model, horizon, fold')})"""
_FOLD_ROWS = " UNION ALL ".join(
    f"SELECT exp, model, horizon, {k} AS fold, y_true, y_pred FROM z WHERE pos >= n - {6 - k} * (n // 6) AND pos < n - {6 - k} * (n // 6) + n // 6"
    for k in range(1, 6)
)


@query("walk_forward", f"""WITH {P}, z AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY d) - 1 AS pos,
    count(*) OVER (PARTITION BY series_id) AS n FROM pred WHERE horizon = 7),
  f AS ({_FOLD_ROWS}), w AS ({_WF})
  SELECT exp, model, horizon, 'Fold ' || fold AS fold, r2, mae, mape FROM w
  UNION ALL SELECT exp, model, horizon, 'Mean', avg(r2), avg(mae), avg(mape) FROM w GROUP BY 1, 2, 3
  UNION ALL SELECT exp, model, horizon, 'Std', stddev_pop(r2), stddev_pop(mae), stddev_pop(mape) FROM w GROUP BY 1, 2, 3""", "r2 mae mape")
def _(spark, sf):
    rows = pred(spark, sf).where(F.col("horizon") == 7).drop("fold", "split")
    folds = series.ts_folds(rows, 5, 7).where(F.col("role") == "test")
    return evaluate.walk_forward_summary(folds)


EACH = f"{ID}, series_id"
_SPIKE = f"""WITH {P}, th AS (SELECT {EACH}, avg(exp(y_true)) + 1.5 * stddev_samp(exp(y_true)) AS threshold FROM pred WHERE split = 'train' GROUP BY {EACH}),
  sp AS (SELECT pred.*, threshold, CAST(coalesce(exp(y_true) > threshold, false) AS INTEGER) AS is_spike,
    CAST(coalesce(exp(y_pred) > threshold, false) AS INTEGER) AS pred_spike FROM pred JOIN th USING ({EACH}) WHERE split = 'test')"""


@query("spike_labels", f"{_SPIKE} SELECT exp, model, horizon, fold, split, series_id, d, y_true, y_pred, threshold, is_spike, pred_spike FROM sp",
       "y_true y_pred threshold")
def _(spark, sf):
    return evaluate.spike_labels(pred(spark, sf))


@query("spike_prf", f"""{_SPIKE}, c AS (SELECT {EACH}, count(*) AS n, CAST(sum(is_spike) AS BIGINT) AS shocks, sum(pred_spike)::DOUBLE AS called,
    sum(is_spike * pred_spike)::DOUBLE AS hit FROM sp GROUP BY {EACH})
  SELECT {EACH}, n, shocks, coalesce(hit / nullif(called, 0), 0) AS "precision", coalesce(hit / nullif(shocks, 0), 0) AS recall,
    coalesce(2 * hit / nullif(called + shocks, 0), 0) AS f1, shocks / n::DOUBLE * 100 AS shock_pct, shocks < 30 AS few_shocks FROM c""",
       "precision recall f1 shock_pct")
def _(spark, sf):
    return evaluate.spike_prf(evaluate.spike_labels(pred(spark, sf)))


@query("spike_auc", f"""{_SPIKE}, s AS (SELECT {EACH}, is_spike, exp(y_pred) AS x FROM sp WHERE y_pred IS NOT NULL),
  r AS (SELECT *, rank() OVER (PARTITION BY {EACH} ORDER BY x) + (count(*) OVER (PARTITION BY {EACH}, x) - 1) / 2.0::DOUBLE AS rk FROM s)
  SELECT {EACH}, (sum(rk) FILTER (is_spike = 1) - count(*) FILTER (is_spike = 1) * (count(*) FILTER (is_spike = 1) + 1) / 2.0::DOUBLE)
    / nullif(count(*) FILTER (is_spike = 1)::DOUBLE * count(*) FILTER (is_spike = 0), 0) AS auc FROM r GROUP BY {EACH}""", "auc")
def _(spark, sf):
    labels = evaluate.spike_labels(pred(spark, sf)).withColumn("price", F.exp("y_pred"))
    return evaluate.grouped_auc(labels, "price", "is_spike", evaluate.EACH)


_SUB = f"""WITH {P}, {S.RISK_DAYS}, x AS (SELECT pred.*, coalesce(CAST(Market_Risk > 0.6 AS INTEGER), 0) AS flag FROM pred LEFT JOIN risk USING (d)
  WHERE split = 'test')"""


@query("subset_metrics", f"""{_SUB}, a AS ({metric_sql('x', "exp, model, horizon, 'All test dates'")}), b AS ({metric_sql('x', 'exp, model, horizon, flag')}),
  u AS (SELECT exp, model, horizon, 'All test dates' AS subset, n, r2, mae, mape FROM a
  UNION ALL SELECT exp, model, horizon, CASE flag WHEN 1 THEN 'Disruption dates' ELSE 'Non-disruption dates' END, n, r2, mae, mape FROM b)
  SELECT exp, model, horizon, subset, n, n >= 10 AS enough, CASE WHEN n >= 10 THEN r2 END AS r2, CASE WHEN n >= 10 THEN mae END AS mae,
    CASE WHEN n >= 10 THEN mape END AS mape FROM u""", "r2 mae mape")
def _(spark, sf):
    flags = roles.event_risk(spark, sf).select("d", (F.col("Market_Risk") > 0.6).cast("int").alias("disruption_flag"))
    return evaluate.subset_metrics(pred(spark, sf), flags, on=["d"])


@query("residuals", f"WITH {P} SELECT *, exp(y_true) - exp(y_pred) AS residual FROM pred", "y_true y_pred residual")
def _(spark, sf):
    return evaluate.residuals(pred(spark, sf))


@query("residual_stats", f"""WITH {P} SELECT {ID}, split, count(exp(y_true) - exp(y_pred)) AS n, avg(exp(y_true) - exp(y_pred)) AS residual_mean,
  stddev_pop(exp(y_true) - exp(y_pred)) AS residual_std FROM pred GROUP BY {ID}, split""", "residual_mean residual_std")
def _(spark, sf):
    return evaluate.residual_stats(pred(spark, sf))


@query("persistence_sample", f"""WITH {P} SELECT series_id, d, exp(y_true) AS actual, exp(y_pred) AS predicted FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY d) AS rn FROM pred
  WHERE horizon = 7 AND split = 'test' AND y_pred IS NOT NULL) WHERE rn <= 10""", "actual predicted")
def _(spark, sf):
    return first_predictions(pred(spark, sf).where(F.col("horizon") == 7), 10)


_E = "abs(exp(y_true) - exp(y_pred))"


@query("model_drift_mae", f"""WITH {P}, t AS (SELECT {ID}, avg({_E}) AS train_mae FROM pred WHERE split = 'train' GROUP BY {ID}),
  e AS (SELECT {ID}, d, sum({_E}) AS s, count({_E}) AS c FROM pred WHERE split = 'test' GROUP BY {ID}, d HAVING count({_E}) > 0),
  r AS (SELECT {ID}, d, sum(s) OVER w / sum(c) OVER w AS rolling_mae FROM e
    WINDOW w AS (PARTITION BY {ID} ORDER BY d RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW))
  SELECT *, rolling_mae > train_mae * 1.5 AS drift FROM r JOIN t USING ({ID})""", "rolling_mae train_mae")
def _(spark, sf):
    return drift.rolling_mae(pred(spark, sf))


