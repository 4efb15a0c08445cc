"""Centroid clustering by equal-average equal-variance search, in whole numbers.

For vectors of d components with sums S and deviations V (the length of the vector
less its mean) the squared distance of x and c is at least

    (Sx - Sc)^2 / d    and    (Sx - Sc)^2 / d + (Vx - Vc)^2.

The centroids are sorted by their sums, that is by their means. A vector starts
at its own mean and scans outward, nearer mean first. The first inequality ends its
scan, since all further means are further away; the second one passes over a single
centroid; what neither rejects is measured in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import by_batch, stored, sub_batches
from tabulon.llm.vectors import extent, whole_numbers

#: No difference of two sums, and so no bound or distance times d, goes beyond its square, 2^62.
LARGEST_GAP = 1 << 31


def spread_of(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the components, and the square root of d times the deviation, per row."""
    d = vectors.shape[1]
    sums = vectors.sum(1)
    return sums, np.sqrt((d * np.einsum("ij,ij->i", vectors, vectors) - sums * sums).astype(np.float64))


class Codebook:
    """Centroids (whole numbers, one row each) sorted by mean, ready to be searched."""

    def __init__(self, centroids: np.ndarray):
        sums, wide = spread_of(centroids)
        self.numbers = np.argsort(sums, kind="stable")
        self.centroids, self.wide = centroids[self.numbers], wide[self.numbers]
        self.sums = sums[self.numbers]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid and squared distance per row (ties: smaller number), and how many distances were taken."""
        n, d = vectors.shape
        sums, wide = spread_of(vectors)
        last = len(self.sums) - 1
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, -1)
        rows, taken = np.arange(n), 0
        while len(rows):
            lo, hi = low[rows], high[rows]
            below = np.where(lo >= 0, sums[rows] - self.sums[np.maximum(lo, 0)], LARGEST_GAP)
            above = np.where(hi <= last, self.sums[np.minimum(hi, last)] - sums[rows], LARGEST_GAP)
            down = below <= above
            gap = np.where(down, below, above)
            # Equal means: d * best. A row without a distance so far has an unreachable best.
            reach = np.where(number[rows] < 0, LARGEST_GAP * LARGEST_GAP - 1, d * np.where(number[rows] < 0, 0, best[rows]))
            going = (gap < LARGEST_GAP) & (gap * gap <= reach)
            rows, down, gap, reach = rows[going], down[going], gap[going], reach[going]
            at = np.where(down, low[rows], high[rows])
            low[rows[down]] -= 1
            high[rows[~down]] += 1
            # The roots are rounded, so the second bound gives way by more than their error.
            apart = np.abs(wide[rows] - self.wide[at])
            apart = np.maximum(apart - 1e-12 * (wide[rows] + self.wide[at]), 0)
            bound = (gap.astype(np.float64) ** 2 + apart**2) * (1 - 1e-12)
            open_ = bound <= reach
            chosen, at = rows[open_], at[open_]
            taken += len(chosen)
            apart = vectors[chosen] - self.centroids[at]
            distance = np.einsum("ij,ij->i", apart, apart)
            candidate = self.numbers[at]
            better = (distance < best[chosen]) | ((distance == best[chosen]) & (candidate < number[chosen]))
            best[chosen[better]], number[chosen[better]] = distance[better], candidate[better]
        return number, best, taken


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every row."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(centroids)
        for batch in sub_batches(batches):
            number, best, _ = book.nearest(_matrix(batch.column(1), centroids.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number.astype(np.int32)), pa.array(best)], ["vec_id", "cluster", "distance"]
            )

    return by_batch(rows.select("vec_id", "weights"), assign, "vec_id long, cluster int, distance long")


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid replaced by the floor of the mean of its vectors; one without vectors stays.

    A task adds up its own vectors, so it sends one row per centroid.
    """
    k, d = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, sums, counts = Codebook(centroids), np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for batch in sub_batches(batches):
            vectors = _matrix(batch.column(0), d)
            number, _, _ = book.nearest(vectors)
            order = np.argsort(number, kind="stable")
            held, first = np.unique(number[order], return_index=True)
            sums[held] += np.add.reduceat(vectors[order], first) if len(held) else 0
            counts += np.bincount(number, minlength=k)
        full = np.flatnonzero(counts)
        bounds = np.arange(0, len(full) * d + 1, d, dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(sums[full].reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(counts[full]), lists], ["cluster", "n", "sums"])

    parts = by_batch(rows.select("weights"), add, "cluster int, n long, sums array<long>")
    totals = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)]
    )
    out = centroids.copy()
    for row in totals.collect():
        out[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(d)]
    return out


@dataclass(frozen=True)
class Clustering:
    """``centroids``: whole numbers, one list each. ``members``: vec_id, cluster, squared distance."""

    centroids: list[list[int]]
    members: DataFrame

    def sizes(self) -> DataFrame:
        """``cluster, n, inertia`` of every cluster with members."""
        return self.members.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
        )


def cluster(
    vectors: DataFrame,
    *,
    k: int = 40,
    rounds: int = 5,
    length: int = 64,
    factor: int = 256,
    seed: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Clustering:
    """Cluster vectors of ``length`` components around ``k`` centroids in exact whole numbers.

    Components become floor(factor * x). The centroids start as the ``k`` vectors
    with the least sha256 of seed and id (equal ones: smaller vector first). Each round
    assigns all vectors and moves the centroids; then all are assigned once more. A
    round is one scan of the vectors, with ``k`` rows out of each task; only the
    centroids, ``k`` times ``length`` numbers, reach the driver and each task.

    Vectors that are null, of another length, or hold null or non-finite components
    take no part. A null id is kept and hashed as the empty one. Every row counts, repeated rows too.
    Fewer than ``k`` vectors make as many centroids; an empty table has none, and no members. Centroids
    without members stay. Further columns are not looked at. An error is raised for components so large that
    sums of ``length`` of them go beyond 2^30, since the distances would not fit 64 bits.
    """
    rows = whole_numbers(vectors, id_col, vector_col, factor, length)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select("weights", digest.alias("digest")).orderBy("digest", "weights").limit(k).collect()
    if not first:
        members = vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long")
        return Clustering([], members)
    _, _, most = extent(rows)
    if 2 * length * most > LARGEST_GAP // 2:
        raise ValueError(f"components of magnitude {most} are too large for exact distances")
    centroids = np.array([row["weights"] for row in first], np.int64)
    for _ in range(rounds):
        centroids = _moved(rows, centroids)
    return Clustering(centroids.tolist(), stored(_assigned(rows, centroids), "members"))
