"""Fits on the feature table.

All are registered at the full sizes of ``fixed.py``, over the whole feature table.
"""

from __future__ import annotations

from tidemark import fixed
from tidemark.operators import evaluate, features
from tidemark.plans import dataset, modelling, roles
from tidemark.plans.catalog import sql as S
from tidemark.plans.catalog.daily import model_table
from tidemark.plans.catalog.evaluation import metric_sql
from tidemark.plans.catalog.registry import query
from tidemark.plans.dataset import PRICE
from tidemark.session import scratch_path, settle


def _fit_query(name: str, model: str) -> None:
    @query(name)
    def _(spark, sf):
        df = model_table(spark, sf)
        names = features.feature_list(df)
        matrix = settle(modelling.model_matrix(df, names))
        return evaluate.metrics(modelling.fit_predict(matrix, model, names))


_fit_query("fit_ridge", "Ridge")
_fit_query("fit_rf", "RandomForest")
_fit_query("fit_gbt", "GradientBoosting")
_fit_query("fit_gbt_sparse", "XGBoost")
_fit_query("fit_gbt_service", modelling.SERVICE)


_PAIR = ("lag1", "roll_std7")
_A, _B = _PAIR


@query("fit_ridge_pair", f"""WITH {S.features()}, t AS (SELECT *, ln(lead(Average_Price, 7) OVER ({S.W})) AS y FROM mf),
  c AS (SELECT *, row_number() OVER ({S.W}) AS rn, count(*) OVER (PARTITION BY series_id) AS n FROM t
        WHERE {_A} IS NOT NULL AND {_B} IS NOT NULL AND y IS NOT NULL),
  m AS (SELECT *, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM c),
  s AS (SELECT avg({_A}) AS ma, stddev_pop({_A}) AS sa, avg({_B}) AS mb, stddev_pop({_B}) AS sb, avg(y) AS my FROM m WHERE split = 'train'),
  z AS (SELECT m.split, y, my, ({_A} - ma) / sa AS a, ({_B} - mb) / sb AS b FROM m, s),
  u AS (SELECT sum(a * a) + {fixed.RIDGE_ALPHA} AS aa, sum(b * b) + {fixed.RIDGE_ALPHA} AS bb, sum(a * b) AS ab,
        sum(a * (y - my)) AS ay, sum(b * (y - my)) AS by_ FROM z WHERE split = 'train'),
  w AS (SELECT (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS wa, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM u),
  p AS (SELECT 'PAIR' AS exp, 'Ridge' AS model, 7 AS horizon, split, y AS y_true, my + wa * a + wb * b AS y_pred FROM z, w)
  {metric_sql('p', 'exp, model, horizon, split')}""", "r2 rmse mae mape")
def _(spark, sf):
    """Ridge on two features over all rows, which SQL can solve too."""
    matrix = settle(modelling.model_matrix(model_table(spark, sf), _PAIR))
    return evaluate.metrics(modelling.fit_predict(matrix, "Ridge", _PAIR, "PAIR"))


@query("ablation")
def _(spark, sf):
    df = settle(model_table(spark, sf))
    return modelling.ablation_table(df, modelling.ablation(df))


@query("ablation_short_study")
def _(spark, sf):
    """The shorter study: fewer columns, one set of rows for all experiments, scores of logarithms."""
    base = dataset.model_base(roles.base_table(spark, sf), "model_all")
    df = settle(features.model_features(base, PRICE, shares=roles.RISK_WEIGHTS).drop("roll_std21"))
    pred = modelling.ablation(df, catalogue=fixed.FEATURE_GROUPS_SHORT, complete="all")
    return evaluate.summary(evaluate.overfit_gap(pred, space="log"))


@query("horizon_table")
def _(spark, sf):
    df = settle(model_table(spark, sf))
    pred = modelling.horizon_predictions(df)
    return modelling.horizon_table(pred, modelling.persistence(df))


@query("walk_forward_model")
def _(spark, sf):
    df = settle(model_table(spark, sf))
    return evaluate.walk_forward_summary(modelling.walk_forward(df))


@query("grid_search")
def _(spark, sf):
    base = dataset.model_base(roles.base_table(spark, sf), "model_all")
    df = settle(features.model_features(base, PRICE, variant="search"))
    return modelling.grid_search(df)


@query("feature_importance")
def _(spark, sf):
    df = model_table(spark, sf)
    names = features.feature_list(df)
    matrix = settle(modelling.model_matrix(df, names))
    return modelling.feature_importance(matrix, names)


@query("spike_report_model")
def _(spark, sf):
    df = settle(model_table(spark, sf))
    names = features.feature_list(df)
    matrix = settle(modelling.model_matrix(df, names))
    pred = modelling.fit_predict(matrix, "RandomForest", names)
    naive = modelling.persistence(df, horizons=(7,))
    return evaluate.spike_report(pred.unionByName(naive))


@query("risk_feature_study")
def _(spark, sf):
    """Errors on disruption days with and without the risk features."""
    df = settle(model_table(spark, sf))
    frames = []
    for exp, without in (("WITH KG", ()), ("WITHOUT KG", ("KG Risk",))):
        names = features.feature_list(df, without=without)
        matrix = settle(modelling.model_matrix(df, names))
        frames.append(modelling.fit_predict(matrix, "RandomForest", names, exp))
    return evaluate.subset_metrics(frames[0].unionByName(frames[1]), df)


@query("forecast_7d")
def _(spark, sf):
    """Models are fitted and stored once; the forecast reads them."""
    df, path = settle(model_table(spark, sf)), scratch_path(spark, "forecasters")
    modelling.fit_forecasters(df, path)
    return modelling.forecast(df, path)


@query("forecast_days", f"""WITH {S.features()}, t AS (SELECT *, row_number() OVER ({S.W}) AS rn,
    count(*) OVER (PARTITION BY series_id) AS n, max(d) OVER (PARTITION BY series_id) AS last_day,
    {', '.join(f'lead(d, {h}) OVER ({S.W}) AS day_{h}' for h in fixed.HORIZONS)} FROM mf),
  c AS (SELECT * FROM t WHERE {' AND '.join(f'{f} IS NOT NULL' for f in S.MODEL_FEATURES)}
        QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY d DESC) = 1)
  """ + " UNION ALL ".join(
    f"SELECT series_id, d AS as_of, {h} AS horizon, CAST(coalesce(day_{h}, last_day + CAST({h} - (n - rn) AS INTEGER)) AS DATE) AS target_date FROM c"
    for h in fixed.HORIZONS
))
def _(spark, sf):
    df = model_table(spark, sf)
    return modelling.forecast_days(df, features.feature_list(df))
