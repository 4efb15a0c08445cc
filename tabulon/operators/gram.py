"""Linear models over a whole grid and all folds from one scan.

A linear fit needs no more of its rows than their Gram sums: of the products of all
pairs of features, label and one. The sums of each fold are added up in one scan; those of
the other folds together are the total less one fold. Every point of the grid is then solved, and its error on
the left-out fold worked out, from sums alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows whose products are taken at a time.
ROWS = 4096


def fold_sums(df: DataFrame, features: str, label: str, fold: str) -> dict[int, np.ndarray]:
    """Gram sums of (1, features, label) of each fold.

    Each task sends one triangle of sums per fold. Rows with a null label or fold are an error, as are vectors of several lengths.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                if any(c.null_count for c in part.columns):
                    raise ValueError("linear fits need features, labels and folds without nulls")
                rows = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                rows = np.column_stack([np.ones(len(part)), rows, part.column(1).to_numpy()])
                numbers = part.column(2).to_numpy()
                for number in np.unique(numbers):
                    own = rows[numbers == number]
                    sums[number] = sums.get(number, 0.0) + own.T @ own
        for number, total in sums.items():
            triangle = total[np.triu_indices(len(total))]
            lists = pa.ListArray.from_arrays(pa.array([0, len(triangle)], pa.int32()), pa.array(triangle))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), lists], ["fold", "sums"])

    rows = df.select(vector_to_array(features), F.col(label).cast("double"), F.col(fold).cast("int"))
    parts = rows.mapInArrow(add, "fold int, sums array<double>").select("fold", F.posexplode("sums").alias("place", "value"))
    added = parts.groupBy("fold", "place").agg(F.sum("value").alias("value"))
    found = added.groupBy("fold").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("sums"))
    out = {}
    for row in found.collect():
        width = int((8 * len(row["sums"]) + 1) ** 0.5 - 1) // 2
        gram = np.zeros((width, width))
        gram[np.triu_indices(width)] = [entry["value"] for entry in row["sums"]]
        out[row["fold"]] = gram + np.triu(gram, 1).T
    return out


def centred(gram: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Number of rows, means, and covariances (over n) of features and label."""
    n = gram[0, 0]
    means = gram[0, 1:] / n
    return n, means, gram[1:, 1:] / n - np.outer(means, means)


def solve(gram: np.ndarray, reg: float, elastic_net: float, rounds: int = 1000, tol: float = 1e-12) -> tuple[np.ndarray, float]:
    """Coefficients and intercept from Gram sums.

    They minimise half the mean squared error plus ``reg`` times
    ``elastic_net * sum(s |b|) + (1 - elastic_net) / 2 * sum(s^2 b^2)``, where s is the standard deviation of a
    feature: a penalty on what the coefficients of standardised features would be. A
    constant feature has the coefficient 0.
    """
    _, means, cov = centred(gram)
    d = len(means) - 1
    s = np.sqrt(np.maximum(np.diag(cov)[:d], 0))
    used = s > 1e-9 * np.maximum(np.abs(means[:d]), 1e-300)
    scale = np.where(used, s, 1.0)
    a = cov[:d, :d] / np.outer(scale, scale)
    c = np.where(used, cov[:d, d] / scale, 0.0)
    l1, l2 = reg * elastic_net, reg * (1 - elastic_net)
    b = np.zeros(d)
    if l1 == 0:
        live = np.flatnonzero(used)
        system = a[np.ix_(live, live)] + l2 * np.eye(len(live))
        b[live] = np.linalg.lstsq(system, c[live], rcond=None)[0]
    else:
        for _ in range(rounds):
            before = b.copy()
            for j in np.flatnonzero(used):
                pull = c[j] - a[j] @ b + a[j, j] * b[j]
                b[j] = np.sign(pull) * max(abs(pull) - l1, 0.0) / (a[j, j] + l2)
            if np.abs(b - before).max(initial=0.0) <= tol * max(1.0, np.abs(b).max(initial=0.0)):
                break
    b = np.where(used, b / scale, 0.0)
    return b, float(means[d] - means[:d] @ b)


def squared_error(gram: np.ndarray, coefficients: np.ndarray, intercept: float) -> tuple[int, float]:
    """Number of rows and mean squared error of a fit on the rows behind the sums."""
    n, means, cov = centred(gram)
    w = np.append(-coefficients, 1.0)
    bias = means @ w - intercept
    return round(n), float(max(w @ cov @ w, 0.0) + bias * bias)


@dataclass(frozen=True)
class LinearSearch:
    """``errors``: reg, elastic_net, fold, n, rmse. ``best``: reg and elastic_net of the least mean error, refitted on all rows."""

    errors: list[tuple[float, float, int, int, float]]
    best: tuple[float, float]
    coefficients: np.ndarray
    intercept: float

    def table(self, spark: SparkSession) -> DataFrame:
        best = [(*row, row[:2] == self.best) for row in self.errors]
        return spark.createDataFrame(best, "reg double, elastic_net double, fold int, n long, rmse double, best boolean")


def linear_search(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    fold: str = "fold",
    regs: Sequence[float] = (0.0, 0.01, 0.1, 1.0),
    elastic_nets: Sequence[float] = (0.0, 0.5, 1.0),
) -> LinearSearch:
    """Fit every penalty on every choice of all folds but one, and measure it on that one: one scan of ``df``.

    The driver takes a square of the features per fold. Equal mean errors go to the earlier point of the grid.
    """
    sums = fold_sums(df, features, label, fold)
    if len(sums) < 2:
        raise ValueError("a search needs rows in two folds at least")
    total = sum(sums.values())
    errors = []
    for reg in regs:
        for mix in elastic_nets:
            for number in sorted(sums):
                n, mean = squared_error(sums[number], *solve(total - sums[number], reg, mix))
                errors.append((float(reg), float(mix), int(number), n, mean**0.5))
    points = list(dict.fromkeys(row[:2] for row in errors))
    best = min(points, key=lambda p: np.mean([row[4] for row in errors if row[:2] == p]))
    return LinearSearch(errors, best, *solve(total, *best))
