"""Model matrices, baselines, fits and the studies built from them.

All fits append to one long table of predictions, and everything after that is
aggregation (see ``operators.evaluate``). Feature tables are written to the shared
folder once before the fits, which then read files and not the raw tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.rows import ln_or_null
from tidemark.operators import evaluate
from tidemark.operators.features import feature_list
from tidemark.operators.series import D, KEYS, by_day, chrono_split, fold_roles, leads_log
from tidemark.plans import trees
from tidemark.plans.dataset import PRICE
from tidemark.plans.trees import Fit
from tidemark.session import settle
from tidemark.sources.increments import dedupe_by

MODELS = ("Ridge", "RandomForest", "GradientBoosting", "XGBoost")
SERVICE = "ServiceBoosting"


def model_matrix(
    df: DataFrame,
    features: Sequence[str],
    horizon: int = fixed.PRIMARY_HORIZON,
    value: str = PRICE,
    share: float = fixed.TRAIN_SHARE,
    keys: Sequence[str] = KEYS,
    d: str = D,
    complete: str = "features",
) -> DataFrame:
    """Features that exist, log target ``horizon`` rows ahead, complete cases, split in time.

    ``complete="all"`` asks for every column of ``df``, not just the features, so that
    all experiments are fitted on the same rows.
    """
    present = [f for f in features if f in df.columns]
    led = leads_log(df, value, [horizon], "target_h", keys, d)
    if complete == "all":
        led = led.na.drop()
    rows = led.select(*keys, d, *present, F.col(f"target_h{horizon}").alias("target")).na.drop()
    return chrono_split(rows.withColumn("horizon", F.lit(horizon)), share, keys, d)


def persistence(
    df: DataFrame,
    horizons: Sequence[int] = fixed.HORIZONS,
    value: str = PRICE,
    anchor: str = "lag_h",
    share: float = fixed.TRAIN_SHARE,
    keys: Sequence[str] = KEYS,
    d: str = D,
) -> DataFrame:
    """Naive forecasts for all horizons from one window pass.

    ``lag_h`` predicts the value ``h`` rows **back** for the target ``h`` rows ahead, as
    the reports do; ``last`` predicts the current value. Prices are raised to at least 1.
    """
    if anchor not in ("lag_h", "last"):
        raise ValueError("anchor must be 'lag_h' or 'last'")
    w = by_day(keys, d)
    cols = {f"_lead{h}": F.lead(value, h).over(w) for h in horizons}
    cols.update({f"_lag{h}": F.lag(value, h).over(w) for h in horizons})

    def line(h: int) -> Column:
        seen = F.col(f"_lag{h}") if anchor == "lag_h" else F.col(value)
        naive = F.when(seen.isNotNull(), F.ln(F.greatest(seen, F.lit(1.0))))
        return F.struct(
            F.lit(h).alias("horizon"), ln_or_null(F.col(f"_lead{h}")).alias("y_true"), naive.alias("y_pred")
        )

    rows = df.select(*keys, d, value).withColumns(cols)
    rows = rows.select(*keys, d, value, F.explode(F.array(*[line(h) for h in horizons])).alias("_l"))
    rows = rows.select(*keys, d, value, "_l.*").where(F.col("y_true").isNotNull() & F.col(value).isNotNull())
    rows = chrono_split(rows, share, [*keys, "horizon"], d)
    return prediction_rows(rows, "BASELINE", "PERSISTENCE", keys, d)


def prediction_rows(
    rows: DataFrame, exp: str, model: str, keys: Sequence[str] = KEYS, d: str = D, fold: int = 0
) -> DataFrame:
    fold_col = F.col("fold") if "fold" in rows.columns else F.lit(fold)
    return rows.select(
        F.lit(exp).alias("exp"), F.lit(model).alias("model"), F.col("horizon").cast("int").alias("horizon"),
        fold_col.cast("int").alias("fold"), "split", *keys, d, "y_true", "y_pred",
    )


def ridge(train: DataFrame, features: Sequence[str], params: Mapping | None = None, label: str = "target") -> PipelineModel:
    """Ridge regression on features scaled by their population deviation.

    The library scales by sample deviation and divides the target by its deviation, so
    the penalty is converted; that takes the row count and spread of the target.
    """
    params = dict(params or {})
    alpha = params.pop("alpha", fixed.RIDGE_ALPHA)
    n, spread = train.agg(F.count(label), F.stddev_pop(label)).first()
    penalty = alpha * (n - 1) / n / n * (spread or 0.0)
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        LinearRegression(
            featuresCol="scaled", labelCol=label, predictionCol="y_pred", solver="normal",
            elasticNetParam=0.0, standardization=False, regParam=penalty, **params,
        ),
    ]
    return Pipeline(stages=stages).fit(train)


def tree_fit(
    name: str, model: str, features: Sequence[str], params: Mapping | None = None, target: str = "target", role: str = "split"
) -> Fit:
    """The sizes of one of :data:`MODELS` or :data:`SERVICE`, changed by ``params``, as a fit of trees."""
    sizes = {
        "RandomForest": fixed.FOREST, "GradientBoosting": fixed.BOOSTING, "XGBoost": fixed.BOOSTING_SPARSE, SERVICE: fixed.BOOSTING_SERVICE,
    }
    penalties = {"XGBoost": fixed.BOOSTING_SPARSE_PENALTIES, SERVICE: fixed.BOOSTING_SERVICE_PENALTIES}
    p = {**sizes[model], **(params or {})}
    subset = p.get("featureSubsetStrategy", "1.0")
    share = int(len(features) ** 0.5) / len(features) if subset == "sqrt" else float(subset)
    forest = model == "RandomForest"
    return Fit(
        name, tuple(features), target, role, trees=p["numTrees" if forest else "maxIter"], depth=p["maxDepth"],
        min_rows=p.get("minInstancesPerNode", 1), share=share, by_node=forest, rows=None if forest else p["subsamplingRate"],
        step=None if forest else p["stepSize"], seed=fixed.SEED, **penalties.get(model, {}),
    )


def fit_predict(
    matrix: DataFrame, name: str, features: Sequence[str], exp: str = "FULL MODEL", params: Mapping | None = None
) -> DataFrame:
    """Fit on the training rows, predict all rows."""
    if name == "Ridge":
        scored = ridge(matrix.where(F.col("split") == "train"), features, params).transform(matrix).withColumn("y_true", F.col("target"))
        return prediction_rows(scored, exp, name)
    fits = [tree_fit(name, name, features, params)]
    model = trees.fit_trees(matrix, fits, [*KEYS, D])
    return prediction_rows(trees.predict(matrix, fits, model, [*KEYS, D, "horizon"]), exp, name)


def stacked(
    df: DataFrame,
    sets: Mapping[str, Sequence[str]],
    horizons: Sequence[int] = (fixed.PRIMARY_HORIZON,),
    share: float = fixed.TRAIN_SHARE,
    value: str = PRICE,
    complete: str = "features",
) -> tuple[DataFrame, dict[tuple[str, int], str]]:
    """One table for all fits: every feature and target once, and for each set of features and horizon a column with the
    role of a row ("train", "test", or NULL where something is missing). Roles are those of ``model_matrix``.
    """
    led = leads_log(df, value, horizons, "target_h")
    w, whole = by_day(KEYS, D), Window.partitionBy(*KEYS)
    names, shown = {}, {}
    for at, (name, features) in enumerate(sets.items()):
        for h in horizons:
            needed = [*(df.columns if complete == "all" else features), f"target_h{h}"]
            full = reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in needed])
            one = F.when(full, 1).otherwise(0)
            cut = F.floor(F.sum(one).over(whole) * F.lit(float(share)))
            role = F.when(full, F.when(F.sum(one).over(w.rowsBetween(Window.unboundedPreceding, 0)) <= cut, "train").otherwise("test"))
            names[name, h] = f"role_{at}_{h}"
            shown[names[name, h]] = role
    features = list(dict.fromkeys(f for fs in sets.values() for f in fs))
    return led.withColumns(shown).select(*KEYS, D, *features, *[f"target_h{h}" for h in horizons], *shown), names


def _scored(table: DataFrame, fits: Mapping[tuple, Fit]) -> DataFrame:
    """Predictions of fits on one stacked table, by (exp, model, horizon, fold)."""
    model = trees.fit_trees(table, list(fits.values()), [*KEYS, D])
    names = [(f.name, *key) for key, f in fits.items()]
    known = table.sparkSession.createDataFrame(names, "fit string, exp string, model string, horizon int, fold int")
    pred = trees.predict(table, list(fits.values()), model, [*KEYS, D])
    return pred.join(F.broadcast(known), "fit").select("exp", "model", "horizon", "fold", "split", *KEYS, D, "y_true", "y_pred")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def ablation(
    df: DataFrame,
    experiments: Sequence[str] = tuple(fixed.EXPERIMENTS),
    models: Sequence[str] = MODELS,
    horizon: int = fixed.PRIMARY_HORIZON,
    params: Mapping[str, Mapping] | None = None,
    catalogue: Mapping = fixed.FEATURE_GROUPS,
    complete: str = "features",
) -> DataFrame:
    """Predictions of every feature set with every model, from one table; all trees are grown in one job."""
    sets = {exp: feature_list(df, exp, catalogue=catalogue) for exp in experiments}
    table, roles = stacked(df, sets, (horizon,), complete=complete)
    table, target = settle(table), f"target_h{horizon}"
    params, frames = params or {}, []
    if "Ridge" in models:
        for exp, features in sets.items():
            role = roles[exp, horizon]
            rows = table.where(F.col(role).isNotNull()).select(
                *KEYS, D, *features, F.col(target).alias("target"), F.col(role).alias("split"), F.lit(horizon).alias("horizon")
            )
            frames.append(fit_predict(rows, "Ridge", features, exp, params.get("Ridge")))
    fits = {
        (exp, m, horizon, 0): tree_fit(f"{m} on {exp}", m, features, params.get(m), target, roles[exp, horizon])
        for exp, features in sets.items() for m in models if m != "Ridge"
    }
    return _union([*frames, *([_scored(table, fits)] if fits else [])])


def ablation_table(df: DataFrame, pred: DataFrame, catalogue: Mapping = fixed.FEATURE_GROUPS) -> DataFrame:
    """Scores, gap and grade of every experiment and model, with the number of features used."""
    sizes = {exp: len(feature_list(df, exp, catalogue=catalogue)) for exp in fixed.EXPERIMENTS}
    table = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    return evaluate.overfit_gap(pred).withColumn("n_features", F.try_element_at(table, F.col("exp")))


def horizon_predictions(
    df: DataFrame,
    horizons: Sequence[int] = fixed.HORIZONS,
    name: str = "RandomForest",
    params: Mapping | None = None,
    exp: str = "FULL MODEL",
) -> DataFrame:
    """One fit per horizon on the full features, all on one table."""
    features = feature_list(df, exp)
    table, roles = stacked(df, {exp: features}, horizons)
    fits = {(exp, name, h, 0): tree_fit(f"{name} h{h}", name, features, params, f"target_h{h}", roles[exp, h]) for h in horizons}
    return _scored(settle(table), fits)


def horizon_table(pred: DataFrame, naive: DataFrame) -> DataFrame:
    """Model against persistence per horizon: R², errors, difference and test statistic.

    The naive forecast is scored on the dates it shares with the model.
    """
    on = ["series_id", "d", "horizon"]
    model = pred.where(F.col("split") == "test")
    shared = (
        naive.select(*on, "y_pred").where(F.col("y_pred").isNotNull())
        .join(model.select(*on, "y_true", "exp", F.lit("test").alias("split"), F.lit(0).alias("fold")), on)
        .withColumn("model", F.lit("PERSISTENCE"))
        .select(pred.columns)
    )
    both = model.unionByName(shared)
    scores = both.groupBy("horizon").agg(
        *[
            m.alias(f"{prefix}_{n}")
            for prefix, hit in (("model", F.col("model") != "PERSISTENCE"), ("naive", F.col("model") == "PERSISTENCE"))
            for m, n in _masked_metrics(hit)
        ]
    )
    dm = evaluate.diebold_mariano(both, by=["horizon"]).select("horizon", "dm_stat", "p_value", "significant")
    return scores.join(dm, "horizon", "left").withColumn("delta_r2", F.col("model_r2") - F.col("naive_r2"))


def _masked_metrics(hit: Column):
    yt, yp = F.when(hit, F.exp("y_true")), F.when(hit, F.exp("y_pred"))
    err = yt - yp
    return [
        (evaluate.r2_column(yt, yp), "r2"),
        (F.avg(F.abs(err)), "mae"),
        (F.avg(F.abs(err / (yt + F.lit(1e-6)))) * 100, "mape"),
    ]


def walk_forward(
    df: DataFrame,
    n_splits: int = 5,
    gap: int = fixed.PRIMARY_HORIZON,
    horizon: int = fixed.PRIMARY_HORIZON,
    name: str = "RandomForest",
    params: Mapping | None = None,
) -> DataFrame:
    """Test predictions of one fit per fold."""
    features = feature_list(df)
    placed, roles = fold_roles(model_matrix(df, features, horizon).drop("split"), n_splits, gap)
    table = settle(placed.withColumns({f"role_{i}": role for i, role in enumerate(roles, 1)}))
    fits = {
        ("FULL MODEL", name, horizon, i): tree_fit(f"{name} fold {i}", name, features, params, "target", f"role_{i}")
        for i in range(1, n_splits + 1)
    }
    return _scored(table, fits).where(F.col("split") == "test")


def grid_search(
    df: DataFrame,
    features: Sequence[str] = fixed.SEARCH_FEATURES,
    grid: Mapping[str, Sequence] = fixed.SEARCH_GRID,
    n_splits: int = 5,
    horizon: int = fixed.PRIMARY_HORIZON,
    top: int = 10,
) -> DataFrame:
    """Mean R² of forests over expanding time folds per parameter set; the best ``top`` are refitted and tested.

    Forests nest: for each fold, the one with the most and deepest trees holds all that differ from it in
    ``numTrees`` and ``maxDepth`` alone, so only the other parameters are fitted anew. One result row per parameter
    set, so the list returned to the driver is as long as the grid. Scores are in log space.
    """
    spark, keys = df.sparkSession, [*KEYS, D]
    present = [f for f in features if f in df.columns]
    matrix = settle(model_matrix(df, present, horizon))
    placed, roles = fold_roles(matrix.where(F.col("split") == "train"), n_splits)
    names = [f"role_{i}" for i in range(1, n_splits + 1)]
    folds = settle(placed.drop("split").withColumns(dict(zip(names, roles))))
    counts, depths = grid.get("numTrees", (fixed.FOREST["numTrees"],)), grid.get("maxDepth", (fixed.FOREST["maxDepth"],))
    others = {k: v for k, v in grid.items() if k not in ("numTrees", "maxDepth")}
    outer = [dict(zip(others, values)) for values in product(*others.values())]

    def largest(point: Mapping, role: str) -> Fit:
        params = {**point, "numTrees": max(counts), "maxDepth": max(depths)}
        return tree_fit(f"{sorted(point.items())} {role}", "RandomForest", present, params, "target", role)

    fits = [[largest(point, role) for role in names] for point in outer]
    model = trees.fit_trees(folds, [f for of in fits for f in of], keys)
    ranked = []
    for point, of in zip(outer, fits):
        r2 = trees.staged_r2(folds, of, model, counts, depths, ("test",))
        for n, depth in product(counts, depths):
            scores = [r2.get((f.name, "test", n, depth)) for f in of]
            mean = sum(scores) / n_splits if None not in scores else None
            ranked.append((mean, {**point, "numTrees": n, "maxDepth": depth}))
    ranked.sort(key=lambda sp: -sp[0] if sp[0] is not None else float("inf"))
    best = [{k: p[k] for k in others} for _, p in ranked[:top]]
    best = [p for i, p in enumerate(best) if p not in best[:i]]
    again = [largest(point, "split") for point in best]
    tested = trees.staged_r2(matrix, again, trees.fit_trees(matrix, again, keys), counts, depths) if again else {}
    rows = []
    for rank, (cv_r2, p) in enumerate(ranked, 1):
        name = largest({k: p[k] for k in others}, "split").name
        both = [tested.get((name, split, p["numTrees"], p["maxDepth"])) if rank <= top else None for split in ("train", "test")]
        rows.append((rank, *[str(p[k]) for k in grid], cv_r2, *both))
    columns = ", ".join(f"{k} string" for k in grid)
    out = spark.createDataFrame(rows, f"rank int, {columns}, cv_r2 double, train_r2 double, test_r2 double")
    return out.withColumn("gap", F.col("train_r2") - F.col("test_r2"))


def feature_importance(matrix: DataFrame, features: Sequence[str], params: Mapping | None = None) -> DataFrame:
    """``(feature, importance)`` of a forest on the training rows, largest first; one row per feature."""
    fit = tree_fit("forest", "RandomForest", features, params)
    weights = trees.importances(fit, trees.fit_trees(matrix, [fit], [*KEYS, D]))
    frame = matrix.sparkSession.createDataFrame(list(weights.items()), "feature string, importance double")
    return frame.orderBy(F.col("importance").desc(), "feature")


def fit_forecasters(
    df: DataFrame,
    path: str,
    horizons: Sequence[int] = fixed.HORIZONS,
    name: str = "RandomForest",
    params: Mapping | None = None,
    exp: str = "FULL MODEL",
) -> None:
    """Fit each horizon on all complete rows and store the models, with their features, at ``path``."""
    features = feature_list(df, exp)
    table, roles = stacked(df, {exp: features}, horizons, share=1.0)
    fits = [tree_fit(str(h), name, features, params, f"target_h{h}", roles[exp, h]) for h in horizons]
    trees.store(fits, trees.fit_trees(settle(table), fits, [*KEYS, D]), path)


def forecast_rows(df: DataFrame, features: Sequence[str], horizons: Sequence[int] = fixed.HORIZONS) -> DataFrame:
    """The last row of each series with all ``features``, and for each horizon the day ``day_<h>`` it aims at.

    A horizon counts rows: the target is the day of that row where the series goes on, and beyond its end every day is a row.
    """
    w, whole = by_day(KEYS, D), Window.partitionBy(*KEYS)
    left = F.count(F.lit(1)).over(whole) - F.row_number().over(w)
    days = {
        f"day_{h}": F.coalesce(F.lead(D, h).over(w), F.date_add(F.max(D).over(whole), (F.lit(h) - left).cast("int"))) for h in horizons
    }
    rows = dedupe_by(df.withColumns(days).na.drop(subset=list(features)), KEYS, [D], "last")
    return rows.select(*KEYS, D, *features, *days)


def forecast_days(df: DataFrame, features: Sequence[str], horizons: Sequence[int] = fixed.HORIZONS) -> DataFrame:
    """``(series_id, as_of, horizon, target_date)``: what the next forecasts start from and aim at."""
    lines = [F.struct(F.lit(h).cast("int").alias("horizon"), F.col(f"day_{h}").alias("target_date")) for h in horizons]
    rows = forecast_rows(df, features, horizons)
    return rows.select(*KEYS, F.col(D).alias("as_of"), F.explode(F.array(*lines)).alias("_l")).select(*KEYS, "as_of", "_l.*")


def forecast(df: DataFrame, path: str) -> DataFrame:
    """Score the last complete row of each series with stored models; nothing is fitted.

    One row per series and horizon: ``(series_id, as_of, horizon, target_date, price)``; see :func:`forecast_rows`.
    """
    fits, model = trees.load(df.sparkSession, path)
    features = list(dict.fromkeys(c for f in fits for c in f.features))
    spans = {f: int(f.name) for f in fits}
    last = settle(forecast_rows(df, features, list(spans.values())).select(
        "*", *[F.lit("last").alias(f.role) for f in fits], *[F.lit(None).cast("double").alias(f.target) for f in fits]
    ))
    pred = trees.predict(last, fits, model, [*KEYS, D, *[f"day_{h}" for h in spans.values()]])
    target = F.coalesce(*[F.when(F.col("fit") == f.name, F.col(f"day_{h}")) for f, h in spans.items()])
    return pred.select(*KEYS, F.col(D).alias("as_of"), F.col("fit").cast("int").alias("horizon"), target.alias("target_date"), F.exp("y_pred").alias("price"))
