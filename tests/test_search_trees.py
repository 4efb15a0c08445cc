"""The search of tree ensembles fits less often than the library's and finds the same errors and models."""

import pytest
from pyspark.ml import regression
from pyspark.sql import functions as F

from tabulon.operators import evaluate, features, supervised, tuning
from tabulon.plans import jobs


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    drawn = spark.range(0, 900, 1, 3).select(
        *[(F.pmod(F.hash(i, F.lit(c)), F.lit(97)) / 7).alias(f"cont{c}") for c in range(6)], (i % 3).cast("int").alias("fold")
    )
    label = F.col("cont0") * F.col("cont1") - F.sin("cont2") * 9 + F.when(F.col("cont3") > 5, F.col("cont4")).otherwise(2.0)
    return features.vectorised(drawn, [f"cont{c}" for c in range(6)]).select("features", label.alias("label"), "fold")


def estimator(kind):
    return supervised.tree_regressor(kind, "features", "label", 1)


def points(model, kind):
    first = model.numTrees if kind == "forest" else model.maxIter
    return tuning.param_grid({first: (2, 5), model.maxDepth: (2, 4)})


@pytest.mark.parametrize("kind, name", [("forest", "RandomForestRegressor"), ("boosted", "GBTRegressor")])
def test_same_errors_from_half_the_fits(rows, monkeypatch, kind, name):
    model = estimator(kind)
    theirs = tuning.cross_validate(model, points(model, kind), evaluate.rmse_evaluator(), rows)
    fitted = []
    fit = getattr(regression, name)._fit
    monkeypatch.setattr(getattr(regression, name), "_fit", lambda self, df: fitted.append(1) or fit(self, df))
    ours = tuning.search_trees(model, points(model, kind), rows)
    assert len(fitted) == 3 * 2 + 1  # of 3 * 4 + 1
    assert ours.avgMetrics == pytest.approx(theirs.avgMetrics, rel=1e-9)
    assert ours.bestModel.toDebugString.split("\n")[1:] == theirs.bestModel.toDebugString.split("\n")[1:]


def test_forest_that_the_library_grows_piecewise_is_not_shared():
    model = supervised.tree_regressor("forest", "features", "label", 1, maxMemoryInMB=1)
    grid = tuning.param_grid({model.numTrees: (2, 20), model.maxDepth: (2, 8)})
    assert sorted(tuning._shared_fits(model, grid, 100)) == [[0], [1], [2], [3]]


def test_cut_forest_is_the_shallow_forest(rows):
    deep, low = (supervised.tree_regressor("forest", "features", "label", 7, numTrees=4, maxDepth=d).fit(rows) for d in (6, 3))
    scored = supervised.with_cut_forest(deep, rows, {"three": 3, "six": 6, "none": 0})
    scored = low.transform(scored.withColumnRenamed("prediction", "whole")).collect()
    assert len(scored) == 900
    assert all(r["three"] == pytest.approx(r["prediction"], rel=1e-12) and r["six"] == pytest.approx(r["whole"], rel=1e-12) for r in scored)
    assert len({r["none"] for r in scored}) == 1


@pytest.mark.parametrize("folds", [2, 4])
def test_wrong_folds_are_an_error(rows, folds):
    model = estimator("forest")
    with pytest.raises(ValueError):
        tuning.search_trees(model, points(model, "forest"), rows, folds)


def test_regression_job_searches_this_way(spark, monkeypatch):
    seen = []
    search = tuning.search_trees
    monkeypatch.setattr(tuning, "search_trees", lambda *a, **k: seen.append(1) or search(*a, **k))
    i = F.col("id")
    table = spark.range(200).select("id", (i % 5).cast("double").alias("cont1"), (i % 5 * 3.0).alias("loss"))
    run = jobs.regress_table(jobs.prepare_table(table)[0], "boosted", grid={"maxIter": (1, 2), "maxDepth": (2,)})
    assert seen == [1] and run.search_metrics().count() == 2
