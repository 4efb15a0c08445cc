"""Linear grids from Gram sums: against the library, coordinate conditions, folds and plan."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulon.operators import gram, supervised


def frame(spark, x, y, folds=3):
    rows = [(i % folds, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "fold int, row array<double>, label double").repartition(5)
    return df.select("fold", array_to_vector("row").alias("features"), "label")


def table(seed=1, n=400, d=6):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, d)) * np.arange(1, d + 1) + 50
    return x, x @ np.linspace(-2, 3, d) + draw.normal(size=n) + 7


def objective(x, y, b, b0, reg, mix):
    s = x.std(0)
    return ((y - x @ b - b0) ** 2).mean() / 2 + reg * (mix * np.abs(s * b).sum() + (1 - mix) / 2 * ((s * b) ** 2).sum())


def test_plain_least_squares_is_the_library_s(spark):
    x, y = table()
    df = frame(spark, x, y)
    ours = gram.linear_search(df, regs=(0.0,), elastic_nets=(0.0,))
    theirs = supervised.fit_linear(df, reg=0.0, elastic_net=0.0, solver="normal")
    assert np.abs(ours.coefficients - theirs.coefficients.toArray()).max() < 1e-8 and abs(ours.intercept - theirs.intercept) < 1e-6
    for _, _, fold, n, rmse in ours.errors:
        left = np.arange(len(y)) % 3 == fold
        b, *_ = np.linalg.lstsq(np.column_stack([np.ones((~left).sum()), x[~left]]), y[~left], rcond=None)
        assert n == left.sum() and abs(rmse - np.sqrt(((y[left] - b[0] - x[left] @ b[1:]) ** 2).mean())) < 1e-6


@pytest.mark.parametrize("reg,mix", [(0.1, 0.0), (0.5, 0.5), (2.0, 1.0), (50.0, 1.0)])
def test_no_step_lowers_the_objective(spark, reg, mix):
    x, y = table(2)
    found = gram.linear_search(frame(spark, x, y), regs=(reg,), elastic_nets=(mix,))
    best = objective(x, y, found.coefficients, found.intercept, reg, mix)
    draw = np.random.default_rng(0)
    for size in (1e-1, 1e-3):
        for _ in range(300):
            b = found.coefficients + size * draw.normal(size=6) * (draw.random(6) < 0.4)
            assert objective(x, y, b, (y - x @ b).mean(), reg, mix) >= best - 1e-9
    assert (reg < 50) or not found.coefficients.any()


def test_odd_tables(spark):
    x, y = table(3, 60, 3)
    x[:, 1] = 5.0  # constant
    x = np.column_stack([x, x[:, 0]])  # twice the same
    for mix in (0.0, 0.5):
        found = gram.linear_search(frame(spark, x, y), regs=(0.1,), elastic_nets=(mix,))
        assert found.coefficients[1] == 0 and np.isfinite(found.coefficients).all()
    with pytest.raises(ValueError, match="two folds"):
        gram.linear_search(frame(spark, x, y, folds=1))
    with pytest.raises(ValueError, match="two folds"):
        gram.linear_search(frame(spark, x, y).limit(0))
    with pytest.raises(Exception, match="without nulls"):
        gram.linear_search(frame(spark, x, y).withColumn("label", F.when(F.col("fold") > 0, F.col("label"))))


def test_the_best_point_wins_and_is_refitted(spark):
    x, y = table(4)
    found = gram.linear_search(frame(spark, x, y), regs=(5.0, 0.001, 1.0), elastic_nets=(0.0, 1.0))
    assert found.best[0] == 0.001
    rows = found.table(spark).collect()
    assert len(rows) == 18 and sum(r["best"] for r in rows) == 3


def test_one_scan(spark, tmp_path):
    """All folds and grid points come from one job of one scan, with one row per task and fold before the shuffle."""
    x, y = table(5)
    rows = frame(spark, x, y).select("fold", "label", F.col("features"))
    rows.write.parquet(str(tmp_path / "t"))
    df, scans = spark.read.parquet(str(tmp_path / "t")), []
    plain = gram.fold_sums
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("search", "search")
    try:
        gram.linear_search(df)
        scans = tracker.getJobIdsForGroup("search")
    finally:
        spark.sparkContext.setJobGroup("", "")
    stages = [s for j in scans for s in tracker.getJobInfo(j).stageIds]
    assert plain is gram.fold_sums and 1 <= len(scans) <= 3
    reading = [s for s in stages if (info := tracker.getStageInfo(s)) and info.numTasks == df.rdd.getNumPartitions() and info.numCompletedTasks]
    assert len(reading) >= 1
