"""Bins with edges from all rows, and trees over them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import features, supervised


def test_edges(spark):
    draw = np.random.default_rng(1)
    rows = [(float(i % 5), float(draw.normal()), 7.0, None if i % 2 else float(i % 40), float("nan")) for i in range(3000)]
    df = spark.createDataFrame(rows, "few double, many double, one double, some double, none double").repartition(6)
    names = df.columns
    bucketizer = features.fit_bins(df, names, [f"b_{c}" for c in names], bins=32, handle_invalid="keep")
    edges = dict(zip(names, bucketizer.getSplitsArray()))
    assert edges["few"] == [-math.inf, 1.0, 2.0, 3.0, 4.0, math.inf]
    assert edges["one"] == [-math.inf, 7.0, math.inf] and edges["none"] == [-math.inf, 0.0, math.inf]
    assert edges["some"] == [-math.inf, *[float(k) for k in range(2, 40, 2)], math.inf]
    sizes = {r["b_many"]: r["count"] for r in bucketizer.transform(df).groupBy("b_many").count().collect()}
    assert len(sizes) <= 33 and sizes[0.0] == 1 and sizes[max(sizes)] == 1  # the least and the largest value
    assert max(sizes.values()) < 1.2 * 3000 / 31


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "a double")
    assert features.fit_bins(df, ["a"], ["b"]).getSplitsArray() == [[-math.inf, 0.0, math.inf]]


@pytest.fixture(scope="module")
def rare(spark):
    """One row in 100,000 has a value, amid the others, that decides its label."""
    x = F.when(F.col("id") == 77_777, 4.5).otherwise((F.col("id") * 7919 % 10).cast("double"))
    rows = spark.range(100_000).select(x.alias("x"), F.rand(3).alias("noise"))
    return rows.withColumn("label", F.when(F.col("x") == 4.5, 1000.0).otherwise(F.when(F.col("x") < 5, 0.0).otherwise(1.0))).repartition(8).cache()


@pytest.mark.parametrize("kind", ["tree", "forest", "boosted"])
def test_a_rare_value_is_found(spark, rare, kind):
    params = {"forest": {"bootstrap": False, "featureSubsetStrategy": "all", "numTrees": 3}, "boosted": {"maxIter": 2}}.get(kind, {})
    tree = supervised.tree_regressor(kind, "features", "label", maxDepth=3, **params)
    model = supervised.fit_binned_tree(rare, ["x", "noise"], tree)
    found = model.transform(rare.where("x = 4.5")).first()["prediction"]
    assert abs(found - 1000) < 1
    assert model.transform(rare.where("x < 4.5")).agg(F.max("prediction")).first()[0] < 5


def test_the_library_alone_misses_it(spark, rare):
    raw = features.vectorised(rare, ["x"])
    model = supervised.tree_regressor("tree", "features", "label", maxDepth=5).fit(raw)
    assert model.transform(raw.where("x = 4.5")).first()["prediction"] < 900


def test_a_classifier(spark, rare):
    tree = supervised.tree_classifier("tree", "features", "odd", maxDepth=2)
    rows = rare.withColumn("odd", (F.col("x") == 4.5).cast("double"))
    model = supervised.fit_binned_tree(rows, ["x"], tree)
    assert model.transform(rows).where("prediction <> odd").count() == 0
