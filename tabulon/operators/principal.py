"""Principal axes of tall and wide tables by orthogonal triangulation of row blocks.

Any block of rows can be replaced by the triangle of its QR decomposition without a
change to the axes, and so can any collection of such triangles. Each task triangulates
its rows, and the triangles are merged in a tree. A leading column of ones takes
up the means, so one scan does without them. The last triangle is decomposed in the task that holds it;
the driver gets ``k`` axes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Triangles that a task of the next level merges.
FAN_IN = 8
#: Numbers that a task gathers before it triangulates them, if that is more than a square of the columns.
BLOCK_NUMBERS = 1 << 20


@dataclass(frozen=True)
class PrincipalAxes:
    """``axes``: one unit row per axis, falling variance. ``shares``: parts of the whole variance."""

    axes: np.ndarray
    shares: np.ndarray
    column: str
    out: str

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the products of each vector (not centred) with the axes as a vector column; null for null."""
        axes = self.axes

        @F.arrow_udf("array<double>")
        def project(vectors: pa.Array) -> pa.Array:
            rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, axes.shape[1])
            full = vectors.is_valid().to_numpy(zero_copy_only=False)
            bounds = pa.array(np.concatenate([[0], np.cumsum(full) * len(axes)]).astype(np.int32))
            return pa.ListArray.from_arrays(bounds, pa.array((rows @ axes.T).reshape(-1)), mask=pa.array(~full))

        products = project(F.when(F.col(self.column).isNotNull(), vector_to_array(self.column)))
        return df.withColumn(self.out, F.when(products.isNotNull(), array_to_vector(products)))


def _triangulated(first: bool, last_k: int | None):
    """The work of one level: rows in, rows of their triangle out.

    On the ``first`` level a row is preceded by a one. ``last_k`` asks the last level for
    the axes: its rows are then an axis after its variance and the variance of all.
    """

    def yielded(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 19) // max(1, rows.shape[1]))
        for start in range(0, len(rows), step):
            part = np.ascontiguousarray(rows[start : start + step])
            bounds = np.arange(0, part.size + 1, part.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(part.reshape(-1)))
            yield pa.RecordBatch.from_arrays([lists], ["row"])

    def axes_of(triangle: np.ndarray, k: int) -> np.ndarray:
        centred = np.linalg.qr(triangle, mode="r")[1:, 1:]  # what the column of ones leaves
        if len(centred) < k:  # fewer rows than axes: the rest have no variance
            centred = np.vstack([centred, np.zeros((k - len(centred), centred.shape[1]))])
        try:
            _, lengths, axes = np.linalg.svd(centred, full_matrices=False)
        except np.linalg.LinAlgError:  # the symmetric form always converges, at half the digits
            values, vectors = np.linalg.eigh(centred.T @ centred)
            lengths, axes = np.sqrt(np.maximum(values[::-1], 0)), vectors.T[::-1]
        axes = axes[:k] * np.where(np.take_along_axis(axes[:k], np.abs(axes[:k]).argmax(1)[:, None], 1) < 0, -1.0, 1.0)
        return np.column_stack([lengths[:k] ** 2, np.full(len(axes), (lengths**2).sum()), axes])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.unique(np.diff(batch.column(0).offsets.to_numpy()))
            if batch.column(0).null_count or len(sizes) != 1:
                raise ValueError("principal axes need vectors of one length, without nulls")
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, sizes[0])
            if not np.isfinite(rows).all():
                raise ValueError("principal axes need finite numbers")
            if first:
                rows = np.column_stack([np.ones(len(rows)), rows])
            waiting.append(rows)
            n, width = sum(map(len, waiting)), rows.shape[1]
            if n >= 2 * width and n * width >= BLOCK_NUMBERS:
                waiting = [np.linalg.qr(np.concatenate(waiting), mode="r")]
        if waiting:
            rows = np.concatenate(waiting)
            if last_k is not None:
                yield from yielded(axes_of(rows, last_k))
            else:
                yield from yielded(np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows)

    return work


def fit_pca(df: DataFrame, column: str, out: str = "pca", k: int = 3) -> PrincipalAxes:
    """The ``k`` principal axes of a vector column, from one scan.

    The entry of largest magnitude of an axis is positive. A task holds a
    triangle and a block of as many rows, so n columns take a few times n * n doubles in each task,
    less if there are fewer rows than columns; the driver takes k * n. An empty table, a null
    vector, vectors of several lengths and numbers that are not finite are errors.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(vector_to_array(column).alias("row"))
    rows = rows.mapInArrow(_triangulated(True, None), "row array<double>")
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        rows = rows.repartition(parts).mapInArrow(_triangulated(False, None), "row array<double>")
    found = rows.repartition(1).mapInArrow(_triangulated(False, k), "row array<double>").collect()
    if not found:
        raise ValueError("principal axes need at least one row")
    table = np.array([row["row"] for row in found])
    if k > table.shape[1] - 2:
        raise ValueError(f"{k} axes of {table.shape[1] - 2} columns")
    shares = table[:, 0] / table[0, 1] if table[0, 1] > 0 else np.zeros(k)
    return PrincipalAxes(table[:, 2:], shares, column, out)


def axis_table(df: DataFrame, model: PrincipalAxes, names: list[str] | None = None) -> DataFrame:
    """``axis, place, loading``, or the name of the column in place of its place: one row per axis and column."""
    rows = [
        (a, names[p] if names else p, float(v)) for a, axis in enumerate(model.axes) for p, v in enumerate(axis)
    ]
    kind = "column string" if names else "place int"
    return df.sparkSession.createDataFrame(rows, f"axis int, {kind}, loading double")
