"""Gaussian mixtures over blocks of rows: each round is one pass of sums over packed numbers.

The library decodes every row as a vector object in every round. Here the rows are packed once
into blocks of plain numbers, and a task adds up a block's sums with whole columns at a time. Start, rounds and
end are the library's, so the fit is the library's but for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.session import held, written

#: Rows that are packed together, and rows whose chances are worked out at a time.
BLOCK, ROWS = 1 << 17, 1 << 13
_TINY = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Mixture:
    """``weights`` (k), ``means`` (k by d), ``covariances`` (k by d by d), the log likelihood before the last round, and the rounds taken."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = float("-inf")
    rounds: int = 0

    def densities(self) -> list[tuple[float, np.ndarray]]:
        """Per cluster the log density at its mean and a root of the inverse covariance, over the directions it varies in."""
        found = []
        for cov in self.covariances:
            values, axes = np.linalg.eigh(cov)
            live = values > _TINY * values.max() * len(values)
            if not live.any():
                raise ValueError("a covariance matrix has no direction with any variance")
            found.append((
                -0.5 * (len(values) * np.log(2 * np.pi) + np.log(values[live]).sum()),
                (axes * np.where(live, np.where(live, values, 1.0) ** -0.5, 0.0)).T,
            ))
        return found


def _chances(x: np.ndarray, mixture: Mixture, densities: list[tuple[float, np.ndarray]]) -> np.ndarray:
    """One line per cluster, for one column of ``x`` per row."""
    parts = []
    for weight, mean, (level, root) in zip(mixture.weights, mixture.means, densities):
        z = root @ (x - mean[:, None])
        parts.append(_TINY + weight * np.exp(level - 0.5 * (z * z).sum(0)))
    return np.stack(parts)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of different rows, component by component, each row with how often it comes in its block."""
    parts, n = [], 0

    def block() -> pa.RecordBatch:
        x = np.concatenate(parts)
        x = x[np.lexsort(x.T)]
        first = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]).any(1)])
        times = np.diff(np.r_[first, len(x)]).astype(float)
        return pa.RecordBatch.from_arrays(
            [pa.array([x.shape[1]], pa.int32()), pa.array([x[first].T.tobytes()]), pa.array([times.tobytes()])], ["width", "numbers", "times"]
        )

    for batch in batches:
        if batch.num_rows:
            column = batch.column(0)
            parts.append(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))
            n += batch.num_rows
            if n >= BLOCK:
                yield block()
                parts, n = [], 0
    if parts:
        yield block()


def _round(blocks: DataFrame, mixture: Mixture) -> Mixture:
    """The mixture after one more round, from one row of sums per task."""
    k, d = mixture.means.shape
    densities = mixture.densities()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weights, means, squares = 0.0, np.zeros(k), np.zeros((k, d)), np.zeros((k, d, d))
        for batch in batches:
            for width, numbers, times in zip(*[column.to_pylist() for column in batch.columns]):
                if width != d:
                    raise ValueError("a mixture needs vectors of one length")
                all_x, all_times = np.frombuffer(numbers).reshape(d, -1), np.frombuffer(times)
                for start in range(0, len(all_times), ROWS):
                    x, n = all_x[:, start : start + ROWS], all_times[start : start + ROWS]
                    chances = _chances(x, mixture, densities)
                    whole = chances.sum(0)
                    total += n @ np.log(whole)
                    shares = chances * (n / whole)
                    weights += shares.sum(1)
                    means += shares @ x.T
                    for c in range(k):
                        squares[c] += (x * shares[c]) @ x.T
        sums = np.concatenate([[total], weights, means.ravel(), squares.ravel()])
        lists = pa.ListArray.from_arrays(pa.array([0, len(sums)], pa.int32()), pa.array(sums))
        yield pa.RecordBatch.from_arrays([lists], ["sums"])

    parts = blocks.mapInArrow(add, "sums array<double>").select(F.posexplode("sums").alias("place", "value"))
    found = dict(parts.groupBy("place").agg(F.sum("value")).collect())
    sums = np.array([found[place] for place in range(len(found))])
    total, weights, means, squares = sums[0], sums[1 : k + 1], sums[k + 1 : k + 1 + k * d].reshape(k, d), sums[k + 1 + k * d :]
    means = means / weights[:, None]
    outer = means[:, :, None] * means[:, None, :]
    return Mixture(weights / weights.sum(), means, squares.reshape(k, d, d) / weights[:, None, None] - outer, float(total), mixture.rounds + 1)


def fit_blocks(df: DataFrame, features: str, k: int, seed: int, max_iter: int, tol: float = 0.01) -> Mixture:
    """The library's mixture of the vectors ``features``: its seeded start, then rounds until the log likelihood gains no more than ``tol``.

    Rows are packed into blocks in the shared folder; equal rows of a block are taken together, rows that are all
    different cost 8 bytes more each. The driver and a task hold the sums of the ``k`` clusters. Vectors that are
    null or not numbers are an error, as they are for the library.
    """
    with held(df.select(features), balanced=True) as (rows,):
        start = GaussianMixture(featuresCol=features, k=k, seed=seed, maxIter=0).fit(rows)
        packed = rows.select(vector_to_array(features).alias("row"))
        blocks = written(packed.mapInArrow(_pack, "width int, numbers binary, times binary"), "blocks")
    gaussians = start.gaussians
    mixture = Mixture(
        np.array(start.weights), np.array([g.mean.toArray() for g in gaussians]), np.array([g.cov.toArray() for g in gaussians])
    )
    before = 0.0
    while mixture.rounds < max_iter and abs(mixture.log_likelihood - before) > tol:
        before = mixture.log_likelihood
        mixture = _round(blocks, mixture)
    return mixture
