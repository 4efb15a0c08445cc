"""Searches over hashed words with many logistic regressions at a time: one pass over the rows serves all fits.

The library makes a job, or two, for each step of each fit, and such a job takes far longer than its sums. Here
the counts of words are packed once into blocks of plain numbers, and a pass works out the losses and
gradients of all fits of a search. The steps are the library's (limited-memory BFGS, strong Wolfe conditions, the same
ends), so the fits are the library's but for rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tabulon.session import held

#: Entries that are packed together; a pass holds a few numbers for each of them.
ENTRIES = 1 << 18
#: Partitions of the rows that a pass takes in one task, if there are enough for all cores: a task holds the sums of all fits.
_TOGETHER = 8
#: Up to so many tasks send their sums straight to the driver.
_DIRECT = 16
_MEMORY, _VALUES, _TRIES = 10, 20, 10
_BLOCK = "fold int, labels binary, sizes binary, places binary, numbers binary"


class _NoStep(Exception):
    """No step in this direction, as the library's search has it."""


def _between(left: tuple, right: tuple) -> float:
    """Where the cubic through two points ``t, value, slope`` is least, not too near to either."""
    (t, value, slope), (u, other, rise) = left, right
    d = slope + rise - 3 * (value - other) / (t - u)
    with np.errstate(invalid="ignore", divide="ignore"):
        root = np.sqrt(np.float64(d * d - slope * rise))
        least = u - (u - t) * (rise + root - d) / (rise - slope + 2 * root)
    low, high = t + 0.1 * (u - t), t + 0.9 * (u - t)
    return low if least < low else high if least > high else float(least)


def _step(x: np.ndarray, value: float, grad: np.ndarray, way: np.ndarray, t: float) -> Generator:
    """The strong Wolfe search: the step, and value and gradient there."""
    slope = float(grad @ way)
    if slope > 0:
        raise _NoStep

    def at(t: float) -> Generator:
        found, there = yield x + way * t
        return (t, found, float(there @ way)), there

    def zoom(low: tuple, high: tuple) -> Generator:
        for _ in range(_TRIES):
            point, there = yield from at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if point[1] > value + 1e-4 * point[0] * slope or point[1] >= low[1]:
                high = point
            else:
                if abs(point[2]) <= 0.9 * abs(slope):
                    return point[0], point[1], there
                if point[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = point
        raise _NoStep

    low = (0.0, value, slope)
    for i in range(_TRIES):
        point, there = yield from at(t)
        if not np.isfinite(point[1]):
            t /= 2.0
            continue
        if point[1] > value + 1e-4 * t * slope or (point[1] >= low[1] and i > 0):
            return (yield from zoom(low, point))
        if abs(point[2]) <= 0.9 * abs(slope):
            return point[0], point[1], there
        if point[2] >= 0:
            return (yield from zoom(point, low))
        low, t = point, t * 1.5
    raise _NoStep


def _way(grad: np.ndarray, steps: list[np.ndarray], changes: list[np.ndarray]) -> np.ndarray:
    """The way down, from the newest to the oldest of the kept steps and changes of the gradient."""
    way, shares, products = grad.copy(), [], []
    for step, change in zip(steps, changes):
        products.append(float(step @ change))
        shares.append(float(step @ way) / products[-1] if products[-1] else np.nan)
        if np.isnan(shares[-1]):
            raise _NoStep
        way -= shares[-1] * change
    if steps:
        if products[0] < 0:
            raise _NoStep
        way *= products[0] / float(changes[0] @ changes[0])
    for step, change, share, product in zip(steps[::-1], changes[::-1], shares[::-1], products[::-1]):
        way += (share - float(change @ way) / product) * step
    return -way


def least(x: np.ndarray, max_iter: int, tol: float) -> Generator[np.ndarray, tuple[float, np.ndarray], tuple[np.ndarray, int]]:
    """Gives points and is sent the value and the gradient there; returns the least point and the rounds, as the library's search."""
    value, grad = yield x
    first, seen, rounds, failed = value, [np.inf], 0, False
    steps, changes = [], []
    while not (
        rounds >= max_iter
        or (len(seen) >= 2 and abs(value - max(seen)) <= tol * first)
        or np.linalg.norm(grad) <= max(tol * value, 1e-8)
    ):
        try:
            way = _way(grad, steps, changes)
            t, new_value, new_grad = yield from _step(x, value, grad, way, 1.0 / np.linalg.norm(way) if rounds == 0 else 1.0)
            if t * np.linalg.norm(grad) < 1e-10:
                raise _NoStep
        except _NoStep:
            if failed:
                break
            failed, steps, changes = True, [], []
            continue
        new_x = x + way * t
        steps, changes = [new_x - x, *steps][:_MEMORY], [new_grad - grad, *changes][:_MEMORY]
        x, value, grad, rounds, failed = new_x, new_value, new_grad, rounds + 1, False
        seen = [*seen, value][-_VALUES:]
    return x, rounds


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows of one fold: per row its label and its number of entries, and all entries."""
    parts: dict[int, list[tuple[np.ndarray, ...]]] = {}

    def block(fold: int) -> pa.RecordBatch:
        columns = [np.concatenate(column) for column in zip(*parts.pop(fold))]
        columns[2] = columns[2].astype(np.min_scalar_type(columns[2].max(initial=0)))
        columns[3] = columns[3].astype(np.min_scalar_type(int(columns[3].max(initial=0))))  # they are whole numbers
        return pa.RecordBatch.from_arrays(
            [pa.array([fold], pa.int32()), *[pa.array([column.tobytes()], pa.binary()) for column in columns]],
            ["fold", "labels", "sizes", "places", "numbers"],
        )

    for batch in batches:
        folds, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        for fold in np.unique(folds):
            rows = pa.array(np.flatnonzero(folds == fold))
            places, numbers = (batch.column(c).take(rows) for c in (2, 3))
            sizes = np.diff(places.offsets.to_numpy())
            parts.setdefault(int(fold), []).append((
                labels[folds == fold].astype(float),
                sizes.astype(np.int32),
                places.flatten().to_numpy(zero_copy_only=False).astype(np.int32),
                numbers.flatten().to_numpy(zero_copy_only=False),
            ))
            if sum(len(part[2]) for part in parts[int(fold)]) >= ENTRIES:
                yield block(int(fold))
    for fold in list(parts):
        yield block(fold)


def packed(rows: DataFrame, hashed: str, label: str, fold: str, setting: int) -> RDD:
    """``setting, fold, labels, sizes, places, numbers`` per block of rows whose ``hashed`` words are sparse vectors."""
    inner = F.unwrap_udt(hashed)
    blocks = rows.select(
        F.col(fold).cast("int").alias("fold"),
        F.col(label).cast("double").alias("label"),
        inner["indices"].alias("places"),
        inner["values"].alias("numbers"),
    ).mapInArrow(_pack, _BLOCK)
    return blocks.rdd.map(lambda row: (setting, row[0], *map(bytes, row[1:])))


def together(parts: Sequence[RDD]) -> RDD:
    """The blocks of all settings in as few partitions as keep the cores busy, so that few tasks send sums of the same fits."""
    whole = parts[0].context.union(list(parts))
    return whole.coalesce(max(whole.context.defaultParallelism, whole.getNumPartitions() // _TOGETHER))


def _entries(sizes: bytes, places: bytes, numbers: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of entries per row, and place and number of each entry."""
    counts = np.frombuffer(sizes, np.int32)
    n = max(int(counts.sum()), 1)
    kinds = [np.dtype(f"u{len(data) // n or 1}") for data in (places, numbers)]
    return counts, np.frombuffer(places, kinds[0]).astype(np.intp), np.frombuffer(numbers, kinds[1]).astype(float)


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Where the entries of each row begin that has any."""
    full = sizes[sizes > 0].astype(np.intp)
    return np.cumsum(full) - full


def _row_sums(values: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes))
    if len(starts):
        out[sizes > 0] = np.add.reduceat(values, starts)
    return out


def _summed(blocks: RDD, add) -> list[np.ndarray]:
    """The sums of the lists of arrays that ``add`` makes of each task's blocks; None where a task has nothing to add."""

    def both(a: list, b: list) -> list:
        return [y if x is None else x if y is None else x + y for x, y in zip(a, b)]

    return blocks.mapPartitions(lambda part: [add(part)]).treeReduce(both, 1 if blocks.getNumPartitions() <= _DIRECT else 2)


@dataclass(frozen=True)
class _Fit:
    """One fit: hash setting, left-out fold, the grid's place, and the scaling of its columns."""

    setting: int
    fold: int
    place: int
    n: float
    start: np.ndarray  # coefficients of scaled columns, intercept last
    scale: np.ndarray  # from counts to scaled columns
    means: np.ndarray  # of scaled columns
    reg: float
    max_iter: int
    tol: float

    def weights(self, x: np.ndarray) -> tuple[np.ndarray, float]:
        """Coefficients of counts, and the intercept."""
        return x[:-1] * self.scale, float(x[-1] - x[:-1] @ self.means)

    def objective(self, x: np.ndarray, loss: float, rest: float, sums: np.ndarray) -> tuple[float, np.ndarray]:
        grad = np.append((sums * self.scale - rest * self.means) / self.n + self.reg * x[:-1], rest / self.n)
        return loss / self.n + 0.5 * self.reg * float(x[:-1] @ x[:-1]), grad


def fits(estimator: LogisticRegression) -> bool:
    """Whether :func:`search` knows this kind of regression."""
    own = estimator.getFamily() in ("auto", "binomial") and estimator.getElasticNetParam() == 0.0
    own = own and estimator.getFitIntercept() and estimator.getStandardization() and estimator.getMaxIter() >= 0
    odd = ("weightCol", "lowerBoundsOnCoefficients", "upperBoundsOnCoefficients", "lowerBoundsOnIntercepts", "upperBoundsOnIntercepts")
    return own and not any(estimator.isSet(name) for name in odd)


def knows(pipeline: Pipeline, grid: Sequence[dict]) -> bool:
    """Whether :func:`search` knows all points of a grid over a pipeline."""
    stages = pipeline.getStages()
    if [type(stage) for stage in stages] != [HashingTF, IDF, LogisticRegression]:
        return False
    hashing, idf, logistic = stages
    chained = hashing.getOutputCol() == idf.getInputCol() and idf.getOutputCol() == logistic.getFeaturesCol()
    return chained and all(fits(logistic.copy(point)) for point in grid)


def _column_sums(blocks: RDD, widths: Sequence[int], folds: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per fold rows, rows labelled one and rows of other labels; per setting and fold the columns' rows, sums and squares."""

    def add(part: Iterator) -> list[np.ndarray]:
        rows, sums = np.zeros((folds, 3)), [None] * len(widths)
        for setting, fold, labels, sizes, places, numbers in part:
            if sums[setting] is None:
                sums[setting] = np.zeros((folds, 3, widths[setting]))
            if setting == 0:
                labels = np.frombuffer(labels)
                rows[fold] += len(labels), (labels == 1).sum(), ((labels != 0) & (labels != 1)).sum()
            _, at, x = _entries(sizes, places, numbers)
            for k, weights in enumerate((x != 0, x, x * x)):
                sums[setting][fold, k] += np.bincount(at, weights, widths[setting])
        return [rows, *sums]

    rows, *sums = _summed(blocks, add)
    return rows, sums


def _prepared(pipeline: Pipeline, grid: Sequence[dict], settings: Sequence[Sequence[int]], rows: np.ndarray, sums: list[np.ndarray]) -> list[_Fit]:
    _, idf, logistic = pipeline.getStages()
    found = []
    for setting, places in enumerate(settings):
        for fold in range(len(rows)):
            others = np.arange(len(rows)) != fold
            n, ones, _ = rows[others].sum(0)
            seen, total, squares = sums[setting][others].sum(0)
            spread = squares - total * total / n
            spread = np.where(spread > 1e-12 * squares, spread, 0.0) / max(n - 1.0, 1.0)
            for place in places:
                known = seen >= idf.copy(grid[place]).getMinDocFreq()
                frequency = np.where(known, np.log((n + 1.0) / (seen + 1.0)), 0.0)
                deviation = frequency * np.sqrt(spread)
                inverse = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation != 0)
                fit = logistic.copy(grid[place])
                start = np.append(np.zeros(len(seen)), np.log(ones / (n - ones)))
                found.append(_Fit(
                    setting, fold, place, n, start, inverse * frequency, inverse * frequency * total / n,
                    fit.getRegParam(), fit.getMaxIter(), fit.getTol(),
                ))
    return found


def _pass(blocks: RDD, asked: list[tuple[_Fit, np.ndarray]]) -> list[np.ndarray]:
    """Per fit the loss, the sum of the errors and their products with the counts, over its rows."""
    context = blocks.context
    sent = context.broadcast([(fit.setting, fit.fold, *fit.weights(x)) for fit, x in asked])

    def add(part: Iterator) -> list[np.ndarray]:
        fitted = sent.value
        out = [None] * len(fitted)
        for setting, fold, labels, sizes, places, numbers in part:
            counts, at, x = _entries(sizes, places, numbers)
            labels, starts = np.frombuffer(labels), _starts(counts)
            for i, (own, left_out, weights, intercept) in enumerate(fitted):
                if own != setting or left_out == fold:
                    continue
                total = out[i] = np.zeros(len(weights) + 2) if out[i] is None else out[i]
                margin = _row_sums(x * weights[at], counts, starts) + intercept
                error = 1.0 / (1.0 + np.exp(-np.clip(margin, -700, None))) - labels
                total[0] += (np.logaddexp(0.0, margin) - labels * margin).sum()
                total[1] += error.sum()
                total[2:] += np.bincount(at, x * np.repeat(error, counts), len(weights))
        return out

    try:
        return _summed(blocks, add)
    finally:
        sent.destroy()


def _fitted(blocks: RDD, problems: Sequence[_Fit]) -> list[tuple[np.ndarray, float]]:
    """Coefficients of counts and intercept per fit; each pass serves every fit that has not come to its end."""
    searches = [least(fit.start, fit.max_iter, fit.tol) for fit in problems]
    points = {i: next(search) for i, search in enumerate(searches)}
    ends: dict[int, np.ndarray] = {}
    while points:
        found = _pass(blocks, [(problems[i], x) for i, x in points.items()])
        for (i, x), sums in zip(list(points.items()), found):
            try:
                points[i] = searches[i].send(problems[i].objective(x, float(sums[0]), float(sums[1]), sums[2:]))
            except StopIteration as end:
                del points[i]
                ends[i] = end.value[0]
    return [problems[i].weights(ends[i]) for i in range(len(problems))]


def _scores(spark: SparkSession, blocks: RDD, problems: Sequence[_Fit], models: list[tuple[np.ndarray, float]]) -> DataFrame:
    """``fit, label, rawPrediction`` of the rows that each fit has left out."""
    sent = blocks.context.broadcast([(fit.setting, fit.fold, *model) for fit, model in zip(problems, models)])

    def score(part: Iterator) -> Iterator[tuple[int, float, float]]:
        for setting, fold, labels, sizes, places, numbers in part:
            counts, at, x = _entries(sizes, places, numbers)
            labels, starts = np.frombuffer(labels), _starts(counts)
            for i, (own, left_out, weights, intercept) in enumerate(sent.value):
                if own == setting and left_out == fold:
                    margin = _row_sums(x * weights[at], counts, starts) + intercept
                    yield from zip([i] * len(labels), labels.tolist(), margin.tolist())

    return spark.createDataFrame(blocks.mapPartitions(score), "fit int, label double, rawPrediction double")


def search(
    frames: Sequence[DataFrame],
    pipeline: Pipeline,
    grid: Sequence[dict],
    settings: Sequence[Sequence[int]],
    folds: int,
    fold: str,
    measure: Callable[[DataFrame], float],
    parallelism: int,
) -> np.ndarray | None:
    """What ``measure`` finds on each fold (lines) for each point of the grid, of the rows ``label, rawPrediction`` left out.

    ``frames`` are the rows with hashed words, one per hash setting, and ``settings`` the grid's places of each.
    None if a fold has labels that are not 0 or 1, or only one of them without it: the library then decides.
    The driver holds the kept steps of all fits, 20 vectors each, a task one vector for each fit.
    """
    spark = frames[0].sparkSession
    hashing, _, logistic = pipeline.getStages()
    widths = [hashing.copy(grid[places[0]]).getNumFeatures() for places in settings]
    blocks = together([packed(f, hashing.getOutputCol(), logistic.getLabelCol(), fold, s) for s, f in enumerate(frames)])
    blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, sums = _column_sums(blocks, widths, folds)
        without = rows.sum(0) - rows
        if rows[:, 2].any() or (without[:, 1] == 0).any() or (without[:, 1] == without[:, 0]).any():
            return None
        problems = _prepared(pipeline, grid, settings, rows, sums)
        models = _fitted(blocks, problems)
        metrics = np.zeros((folds, len(grid)))
        with held(_scores(spark, blocks, problems, models)) as (scores,):
            scores.count()  # held before the measures share it
            run = inheritable_thread_target(spark)(lambda i: measure(scores.where(F.col("fit") == i).drop("fit")))
            with ThreadPool(parallelism) as pool:
                for fit, metric in zip(problems, pool.imap(run, range(len(problems)))):
                    metrics[fit.fold, fit.place] = metric
        return metrics
    finally:
        blocks.unpersist()
