"""Mixtures over blocks: the library's fit, block by block, and no vector objects in the rounds."""

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulon.operators import mixture, unsupervised
from tabulon.session import held


def frame(spark, x):
    df = spark.createDataFrame([([float(v) for v in row],) for row in x], "row array<double>").repartition(3)
    return df.select(array_to_vector("row").alias("features"))


def two_clouds(seed=1, n=600):
    draw = np.random.default_rng(seed)
    return np.concatenate([draw.normal(size=(n, 3)), draw.normal(size=(n // 2, 3)) * [1, 2, 0.5] + [6, -4, 1]])


@pytest.mark.parametrize("x", [two_clouds(), np.floor(two_clouds(2)), np.repeat(two_clouds(3, 90), 7, axis=0)])
def test_same_as_the_library(spark, monkeypatch, x):
    monkeypatch.setattr(mixture, "BLOCK", 64)
    df = frame(spark, x)
    ours = unsupervised.fit_mixture(df, k=2, seed=5, max_iter=40)
    with held(df, balanced=True) as (rows,):
        theirs = GaussianMixture(k=2, seed=5, maxIter=40).fit(rows)
    assert ours.rounds == theirs.summary.numIter
    assert np.abs(ours.weights - np.array(theirs.weights)).max() < 1e-9
    for i, gaussian in enumerate(theirs.gaussians):
        assert np.abs(ours.means[i] - gaussian.mean.toArray()).max() < 1e-8
        assert np.abs(ours.covariances[i] - gaussian.cov.toArray()).max() < 1e-8


def test_blocks_hold_every_row(spark, monkeypatch):
    monkeypatch.setattr(mixture, "BLOCK", 8)
    seen = []
    monkeypatch.setattr(mixture, "written", lambda df, name: seen.append(df.cache()) or seen[0])
    mixture.fit_blocks(frame(spark, np.repeat([[0.0, 1.0], [2.0, 5.0], [3.0, 3.5]], 30, axis=0)), "features", 2, 1, 2)
    blocks = seen[0].select("numbers", "times").collect()
    assert sum(np.frombuffer(r["times"]).sum() for r in blocks) == 90
    assert all(len(r["numbers"]) == 16 * len(np.frombuffer(r["times"])) for r in blocks)


def test_rounds_read_packed_blocks(spark, monkeypatch):
    """A round's input is the written table of blocks, not a vector column."""
    kinds = []
    one_round = mixture._round
    monkeypatch.setattr(mixture, "_round", lambda blocks, found: kinds.append(blocks.dtypes) or one_round(blocks, found))
    mixture.fit_blocks(frame(spark, two_clouds(4, 50)), "features", 2, 1, 3)
    assert len(kinds) == 3 and all(dict(k)["numbers"] == "binary" for k in kinds)


def test_null_vectors_are_an_error(spark):
    df = frame(spark, two_clouds(1, 20)).withColumn("features", F.when(F.rand(1) < 0.9, F.col("features")))
    with pytest.raises(Exception):
        unsupervised.fit_mixture(df)
