"""Principal axes: against plain decompositions, on wide, degenerate and faulty tables."""

import numpy as np
import pytest
from checking import compare, duck
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tabulon.operators import principal


def frame(spark, rows, parts=7):
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(rows)], "id long, row array<double>")
    return df.repartition(parts).select("id", array_to_vector("row").alias("features"))


def plain_axes(rows, k):
    rows = np.array(rows, float)
    _, s, v = np.linalg.svd(rows - rows.mean(0), full_matrices=False)
    v = v * np.sign(np.take_along_axis(v, np.abs(v).argmax(1)[:, None], 1))
    return v[:k], (s**2 / (s**2).sum())[:k]


@pytest.mark.parametrize("shape", [(1000, 6), (300, 40), (30, 200)])
@pytest.mark.parametrize("partitions", ["4", "70"])
def test_axes(spark, shape, partitions):
    draw = np.random.default_rng(shape[0])
    rows = draw.normal(size=shape) * 0.8 ** np.arange(shape[1]) + 1e4 * draw.normal(size=shape[1])
    k = min(5, shape[1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        model = principal.fit_pca(frame(spark, rows), "features", k=k)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    axes, shares = plain_axes(rows, k)
    assert np.abs(model.axes - axes).max() < 1e-8 and np.abs(model.shares - shares).max() < 1e-10


def test_blocks_are_triangulated_as_they_come(spark, monkeypatch):
    monkeypatch.setattr(principal, "BLOCK_NUMBERS", 64)
    rows = np.random.default_rng(2).normal(size=(5000, 9)) * np.arange(1, 10)
    model = principal.fit_pca(frame(spark, rows), "features", k=9)
    axes, shares = plain_axes(rows, 9)
    assert np.abs(model.axes - axes).max() < 1e-8 and np.abs(model.shares - shares).max() < 1e-10


def test_same_as_the_library(spark):
    rows = np.random.default_rng(5).normal(size=(400, 12)) * np.arange(1, 13)
    df = frame(spark, rows)
    theirs = PCA(k=4, inputCol="features", outputCol="pca").fit(df)
    ours = principal.fit_pca(df, "features", k=4)
    assert np.abs(np.abs(theirs.pc.toArray().T) - np.abs(ours.axes)).max() < 1e-8
    assert np.abs(theirs.explainedVariance.toArray() - ours.shares).max() < 1e-10
    found = dict(ours.transform(df).select("id", vector_to_array("pca")).collect())
    assert max(np.abs(np.array(found[i]) - ours.axes @ row).max() for i, row in enumerate(rows)) < 1e-9


def test_many_columns(spark):
    """5,000 columns: neither the driver nor, with few rows, any task holds a square of them."""
    draw = np.random.default_rng(8)
    planted = np.linalg.qr(draw.normal(size=(5000, 2)))[0].T
    rows = draw.normal(size=(120, 2)) * [30.0, 9.0] @ planted
    model = principal.fit_pca(frame(spark, rows, parts=3), "features", k=2)
    assert np.abs(np.abs(model.axes @ planted.T) - np.eye(2)).max() < 0.2
    assert abs(model.shares.sum() - 1) < 1e-9


def test_more_axes_than_rows_and_no_variance(spark):
    model = principal.fit_pca(frame(spark, [(1, 2, 3, 4), (2, 4, 6, 8)]), "features", k=4)
    assert np.abs(model.axes @ model.axes.T - np.eye(4)).max() < 1e-9
    assert np.abs(model.shares - [1, 0, 0, 0]).max() < 1e-12
    model = principal.fit_pca(frame(spark, [(1, 2)] * 30), "features", k=2)
    assert np.abs(model.axes @ model.axes.T - np.eye(2)).max() < 1e-9 and np.abs(model.shares.sum()) <= 1 + 1e-9


def test_faulty_tables(spark):
    good = frame(spark, [(1, 2), (3, 5)])
    for df in (good.limit(0), frame(spark, [(1, 2), (3, float("nan"))]), frame(spark, [(1, 2), (1, 2, 3)], 1)):
        with pytest.raises(Exception, match="principal axes need"):
            principal.fit_pca(df, "features", k=1)
    with pytest.raises(ValueError, match="3 axes of 2 columns"):
        principal.fit_pca(good, "features", k=3)
    model = principal.fit_pca(good, "features", k=1)
    some = good.withColumn("features", F.when(F.col("id") == 0, F.col("features")))
    found = {r["id"]: r["pca"] for r in model.transform(some).collect()}
    assert found[1] is None and len(found[0]) == 1


def test_twenty_fits_in_one_session(spark, folder):
    """The rotation keeps all lengths, each time: no decomposition fails now and then."""
    db, run = duck(folder), entry_points.queries()["pca_rotation"]
    for _ in range(20):
        assert compare(run(spark, folder), db, entry_points.oracle_sql()["pca_rotation"]) is None
