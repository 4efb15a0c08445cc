"""Matrix factorisation by normal equations that are added up in parts.

The library's fit keeps all ratings of an item, and of a user, in one block. Here a half step is a join of the
ratings with the factors of the other side and two sums: each task adds up the products of
its own ratings per item, and the parts of an item, however many ratings it
has, are merged and solved. No key's ratings ever meet, and no id is held by the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.session import written

#: Products that a task holds before it adds them up by key, and systems that it solves at a time.
NUMBERS, SYSTEMS = 1 << 22, 4096


@dataclass(frozen=True)
class FactorTables:
    """``users``: user_id, features. ``items``: item_id, features. One row per rated id."""

    users: DataFrame
    items: DataFrame

    def user_factors(self) -> DataFrame:
        return self.users

    def item_factors(self) -> DataFrame:
        return self.items

    def predict(self, pairs: DataFrame) -> DataFrame:
        """Add ``prediction``; pairs with an unknown user or item are dropped."""
        both = pairs.join(self.users.withColumnRenamed("features", "_user"), "user_id")
        both = both.join(self.items.withColumnRenamed("features", "_item"), "item_id")
        product = F.aggregate(F.zip_with("_user", "_item", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        return both.select(*pairs.columns, product.alias("prediction"))


def _half_step(rank: int, reg: float):
    """The two halves of a half step: sums per key from joined ratings, and solutions from sorted sums."""
    high, wide = np.triu_indices(rank), rank * (rank + 1) // 2
    most = max(1024, NUMBERS // (wide + rank))

    def lists(rows: np.ndarray) -> pa.Array:
        bounds = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(rows.reshape(-1)))

    def added(keys: np.ndarray, *parts: np.ndarray) -> list[np.ndarray]:
        """Sums of each part by key, for keys in any order."""
        order = np.argsort(keys, kind="stable")
        found, first = np.unique(keys[order], return_index=True)
        return [found, *[np.add.reduceat(part[order], first) for part in parts]]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def sums() -> pa.RecordBatch:
            keys, ratings, factors = (np.concatenate(x) for x in zip(*waiting))
            products = np.column_stack([factors[:, high[0]] * factors[:, high[1]], factors * ratings[:, None]])
            found, n, totals = added(keys, np.ones(len(keys), np.int64), products)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n), lists(totals)], ["key", "n", "sums"])

        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                factors = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, rank)
                waiting.append((part.column(0).to_numpy(), part.column(1).to_numpy(), factors))
                if sum(len(w[0]) for w in waiting) >= most:
                    yield sums()
                    waiting.clear()
        if waiting:
            yield sums()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(keys: np.ndarray, n: np.ndarray, totals: np.ndarray) -> pa.RecordBatch:
            systems = np.zeros((len(keys), rank, rank))
            systems[:, high[0], high[1]] = systems[:, high[1], high[0]] = totals[:, :wide]
            systems[:, np.arange(rank), np.arange(rank)] += reg * n[:, None]
            sides = totals[:, wide:, None]
            try:
                found = np.linalg.solve(systems, sides)[:, :, 0]
            except np.linalg.LinAlgError:  # some system leaves a direction open: the least solution
                found = (np.linalg.pinv(systems, hermitian=True) @ sides)[:, :, 0]
            return pa.RecordBatch.from_arrays([pa.array(keys), lists(found)], ["key", "features"])

        rest = None  # the last key of a batch may go on in the next one
        for batch in batches:
            for start in range(0, batch.num_rows, SYSTEMS):
                part = batch.slice(start, SYSTEMS)
                totals = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                columns = part.column(0).to_numpy(), part.column(1).to_numpy(), totals
                if rest is not None:
                    columns = tuple(np.concatenate(x) for x in zip(rest, columns))
                keys, n, totals = added(*columns)
                rest = keys[-1:], n[-1:], totals[-1:]
                if len(keys) > 1:
                    yield solved(keys[:-1], n[:-1], totals[:-1])
        if rest is not None:
            yield solved(*rest)

    return add, solve


def _solved(ratings: DataFrame, factors: DataFrame, key: str, other: str, rank: int, reg: float) -> DataFrame:
    add, solve = _half_step(rank, reg)
    joined = ratings.join(factors, other).select(F.col(key).alias("key"), "rating", "features")
    sums = joined.mapInArrow(add, "key long, n long, sums array<double>")
    found = sums.repartition("key").sortWithinPartitions("key").mapInArrow(solve, "key long, features array<double>")
    return written(found.withColumnRenamed("key", key), "factors")


def fit_factors(
    ratings: DataFrame, rank: int = 8, iterations: int = 10, reg: float = 0.1, seed: int = 5
) -> FactorTables:
    """Factorise ``user_id, item_id, rating`` (ids of 64 bits) by alternating least squares.

    Minimises the squared errors plus ``reg`` times the squared lengths of the factors, each as often as its
    user or item has ratings. The items start from hashes of ``seed`` and id, so a fit does not
    depend on partitions, but for the order of sums. Each of the ``2 * iterations`` half steps writes the factors of
    one side; a hot item sends one row of sums per task and a few million products. Rows with a null are
    left out; repeated pairs count as often as they occur. No ratings make no factors.
    """
    rows = ratings.select(
        F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id"), F.col("rating").cast("double").alias("rating")
    ).dropna()
    rows = written(rows, "ratings")
    start = [F.lit(0.1) + F.pmod(F.xxhash64(F.lit(seed), F.lit(j), "item_id"), F.lit(1 << 20)) / float(1 << 20) for j in range(rank)]
    items = rows.select("item_id").distinct().withColumn("features", F.array(*start))
    users = rows.select("user_id").distinct().withColumn("features", F.array(*[F.lit(0.0)] * rank))
    for _ in range(iterations):
        users = _solved(rows, items, "user_id", "item_id", rank, reg)
        items = _solved(rows, users, "item_id", "user_id", rank, reg)
    return FactorTables(users, items)
