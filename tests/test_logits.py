"""Logistic regressions that share their passes are the library's, and take far fewer jobs."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from tabulon.operators import evaluate, logits, tuning


def words(spark, n=240, label="double"):
    draw = np.random.default_rng(1)
    rows = []
    for i in range(n):
        one = int(draw.integers(2))
        own = [f"w{int(w)}" for w in draw.integers(0, 40, int(draw.integers(0, 20)))]
        rows.append((own + [f"{'xy'[one]}{int(draw.integers(9))}"] * int(draw.integers(0, 2)), one, i % 3))
    df = spark.createDataFrame(rows, "filtered array<string>, label int, fold int").repartition(3)
    return df.withColumn("label", F.col("label").cast(label))


def parts(numbers=(16,), regs=(0.01,), **settings):
    hashing = HashingTF(inputCol="filtered", outputCol="raw_features")
    idf = IDF(inputCol="raw_features", outputCol="features")
    logistic = LogisticRegression(**settings)
    grid = tuning.param_grid({hashing.numFeatures: numbers, idf.minDocFreq: (0, 5), logistic.regParam: regs})
    return Pipeline(stages=[hashing, idf, logistic]), grid


def test_same_search_with_one_fit_of_the_library(spark, monkeypatch):
    (pipeline, grid), df = parts((16, 256), maxIter=12), words(spark, label="int")
    theirs = tuning.cross_validate(pipeline, grid, evaluate.auc_evaluator(), df)
    fitted, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, rows: fitted.append(1) or fit(self, rows))
    ours = tuning.search_words(pipeline, grid, evaluate.auc_evaluator(), df)
    assert len(fitted) == 1  # of 3 * 4 + 1
    assert np.abs(np.array(ours.avgMetrics) - theirs.avgMetrics).max() < 1e-9
    assert np.abs(np.array(ours.stdMetrics) - theirs.stdMetrics).max() < 1e-9
    a, b = (model.bestModel.stages for model in (ours, theirs))
    assert a[0].getNumFeatures() == b[0].getNumFeatures() and a[1].getMinDocFreq() == b[1].getMinDocFreq()
    assert np.abs(a[2].coefficients.toArray() - b[2].coefficients.toArray()).max() < 1e-9


@pytest.mark.parametrize("most", [1, 40])
def test_same_coefficients(spark, most):
    """Each fit of a search against the library's on the same rows."""
    (pipeline, grid), df = parts((64,), (0.0, 0.01), maxIter=most), words(spark)
    hashing, idf, logistic = pipeline.getStages()
    hashed = hashing.copy(grid[0]).transform(df)
    blocks = logits.packed(hashed, "raw_features", "label", "fold", 0)
    rows, sums = logits._column_sums(blocks, [64], 3)
    problems = logits._prepared(pipeline, grid, [range(len(grid))], rows, sums)
    for fit, (weights, intercept) in zip(problems, logits._fitted(blocks, problems)):
        if fit.fold != 1:
            continue
        train = hashed.where(F.col("fold") != fit.fold)
        known = idf.copy(grid[fit.place]).fit(train)
        theirs = logistic.copy(grid[fit.place]).fit(known.transform(train))
        assert np.abs(weights - theirs.coefficients.toArray() * known.idf.toArray()).max() < 1e-6
        assert intercept == pytest.approx(theirs.intercept, abs=1e-6)


def test_a_pass_serves_all_fits(spark, monkeypatch):
    passes, summed = [], logits._summed
    monkeypatch.setattr(logits, "_summed", lambda *a: passes.append(1) or summed(*a))
    pipeline, grid = parts((16, 64), maxIter=6)
    tuning.search_words(pipeline, grid, evaluate.auc_evaluator(), words(spark))
    assert len(passes) < 20  # 12 fits of 6 rounds


def test_odd_labels_are_left_to_the_library(spark):
    pipeline, grid = parts((16,), maxIter=3)
    one_sided = words(spark).withColumn("label", F.when(F.col("fold") == 0, 1.0).otherwise(0.0))
    three = words(spark).withColumn("label", F.when(F.rand(1) < 0.2, 2.0).otherwise(F.col("label")))
    missing = words(spark).withColumn("label", F.expr("CASE WHEN label > 0 THEN label END"))
    for df in (one_sided, three, missing):
        hashed = pipeline.getStages()[0].copy(grid[0]).transform(df)
        assert logits.search([hashed], pipeline, grid, [range(len(grid))], 3, "fold", None, 1) is None


def test_unknown_grids(spark):
    pipeline, grid = parts(maxIter=2, elasticNetParam=0.5)
    assert not logits.knows(pipeline, grid)
    found = tuning.search_words(pipeline, grid, evaluate.auc_evaluator(), words(spark))
    assert found.avgMetrics == pytest.approx(tuning.cross_validate(pipeline, grid, evaluate.auc_evaluator(), words(spark)).avgMetrics)
