"""The registered fits are the whole job: every size as ``fixed.py`` has it."""

from __future__ import annotations

import inspect

import pytest

from tests.conftest import TESTDATA
from tidemark import fixed
from tidemark.plans import modelling
from tidemark.plans.catalog import models
from tidemark.plans.catalog.registry import _QUERIES


class Stop(Exception):
    pass


def stop(*given, **named):
    raise Stop(given, named)


FITS = {
    "fit_rf": "RandomForest", "fit_gbt": "GradientBoosting", "fit_gbt_sparse": "XGBoost", "fit_gbt_service": modelling.SERVICE,
    "horizon_table": "RandomForest", "walk_forward_model": "RandomForest", "feature_importance": "RandomForest",
    "spike_report_model": "RandomForest", "risk_feature_study": "RandomForest", "forecast_7d": "RandomForest",
}
FULL = {"RandomForest": fixed.FOREST, "GradientBoosting": fixed.BOOSTING, "XGBoost": fixed.BOOSTING_SPARSE, modelling.SERVICE: fixed.BOOSTING_SERVICE}
COUNT = {"horizon_table": 7, "walk_forward_model": 5, "forecast_7d": 7}


@pytest.mark.parametrize("query", FITS)
def test_fits_have_their_full_sizes(spark, monkeypatch, query):
    made = []

    def recorded(df, fits, *rest):
        made.extend(fits)
        raise Stop

    monkeypatch.setattr(models, "settle", lambda df, *_: df)
    monkeypatch.setattr(modelling, "settle", lambda df, *_: df)
    monkeypatch.setattr(modelling.trees, "fit_trees", recorded)
    with pytest.raises(Stop):
        _QUERIES[query](spark, TESTDATA)
    sizes, forest = FULL[FITS[query]], FITS[query] == "RandomForest"
    assert len(made) == COUNT.get(query, 1)
    for fit in made:
        assert (fit.trees, fit.depth) == (sizes["numTrees" if forest else "maxIter"], sizes["maxDepth"])
        assert (fit.step, fit.rows) == ((None, None) if forest else (sizes["stepSize"], sizes["subsamplingRate"]))
        assert fit.min_rows == sizes.get("minInstancesPerNode", 1)


@pytest.mark.parametrize(("query", "function"), [("ablation", "ablation"), ("grid_search", "grid_search")])
def test_studies_are_whole(spark, monkeypatch, query, function):
    whole = inspect.signature(getattr(modelling, function))
    monkeypatch.setattr(models, "settle", lambda df, *_: df)
    monkeypatch.setattr(modelling, function, stop)
    with pytest.raises(Stop) as stopped:
        _QUERIES[query](spark, TESTDATA)
    bound = whole.bind(*stopped.value.args[0], **stopped.value.args[1])
    assert list(bound.arguments) == ["df"], "nothing but the table is given, the rest is as in fixed.py"


def test_short_study_has_all_models(spark, monkeypatch):
    monkeypatch.setattr(models, "settle", lambda df, *_: df)
    whole = inspect.signature(modelling.ablation)
    monkeypatch.setattr(modelling, "ablation", stop)
    with pytest.raises(Stop) as stopped:
        _QUERIES["ablation_short_study"](spark, TESTDATA)
    bound = whole.bind(*stopped.value.args[0], **stopped.value.args[1])
    assert set(bound.arguments) == {"df", "catalogue", "complete"}, "all experiments and models"
