"""Relational operators: projections, splits, samples, joins, aggregates, top-k."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions import hash_unit, squared_error
from tabulon.session import materialised

# --- columns -----------------------------------------------------------------


def feature_columns(
    columns: Sequence[str],
    dropped: Sequence[str] = ("id", "label"),
    category_prefix: str = "cat",
    index_prefix: str = "idx_",
) -> list[str]:
    """Names of the feature columns: indexed names for categories, others as they are."""
    kept = [name for name in columns if name not in set(dropped)]
    return [index_prefix + name if name.startswith(category_prefix) else name for name in kept]


def matching_columns(df: DataFrame, pattern: str) -> list[str]:
    return [name for name in df.columns if re.match(pattern, name)]


def column_arity(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """``feature, n_distinct, kept`` per column; the count is exact up to ``limit``.

    A sketch in one pass rules out columns that are clearly too wide; only the
    others are counted exactly, so a nearly unique column is never shuffled.
    Columns over the limit have a null count and ``kept`` false.
    """
    spark = df.sparkSession
    sketch = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    # The sketch errs by about 5 %; a column twice over the limit is beyond doubt.
    near = [c for c in columns if sketch[c] <= 2 * limit]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in near]
    )
    exact = (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n"))
        if near
        else spark.createDataFrame([], "feature string, n long")
    )
    names = spark.createDataFrame([(c, c in near) for c in columns], "feature string, near boolean")
    count = F.coalesce("n", F.lit(0).cast("long"))
    kept = F.col("near") & (count <= limit)
    return names.join(exact, "feature", "left").select(
        "feature", F.when(kept, count).alias("n_distinct"), kept.alias("kept")
    )


# --- splits and samples ------------------------------------------------------


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Row-wise random split. The rows drawn depend on the partitioning as well as the seed.

    The frame is written first: each part is drawn from the same written rows, so the
    parts neither overlap nor lose rows when one of them is worked out again.
    """
    return materialised(df).randomSplit([float(w) for w in weights], seed)


def with_split(
    df: DataFrame, keys: Sequence[str], weights: Mapping[str, float], seed: int = 0
) -> DataFrame:
    """Add ``part``: a split that depends on the keys alone, so reruns agree on any cluster."""
    total = float(sum(weights.values()))
    names = list(weights)
    edges, reached = [], 0.0
    for name in names[:-1]:
        reached += weights[name] / total
        edges.append((reached, name))
    unit = hash_unit(list(keys), seed)
    part: Column = F.lit(names[-1])
    for edge, name in reversed(edges):
        part = F.when(unit < edge, F.lit(name)).otherwise(part)
    return df.withColumn("part", part)


def with_modular_split(df: DataFrame, key: str, shares: Mapping[str, int]) -> DataFrame:
    """Add ``part`` from ``key`` modulo the sum of the shares, for dense integer keys."""
    total = sum(shares.values())
    slot = F.pmod(F.col(key), F.lit(total))
    names = list(shares)
    edges, reached = [], 0
    for name in names[:-1]:
        reached += shares[name]
        edges.append((reached, name))
    part: Column = F.lit(names[-1])
    for edge, name in reversed(edges):
        part = F.when(slot < edge, F.lit(name)).otherwise(part)
    return df.withColumn("part", part)


def with_fold(df: DataFrame, keys: Sequence[str], folds: int, seed: int = 0) -> DataFrame:
    """Add an integer ``fold`` in [0, folds) that depends on the keys alone."""
    return df.withColumn("fold", F.floor(hash_unit(list(keys), seed) * folds).cast("int"))


def sample_rows(df: DataFrame, fraction: float, seed: int = 10) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def take_sample(df: DataFrame, n: int, seed: int = 10) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), drawn uniformly; each task keeps at most ``n``."""
    draw = "_draw"
    return df.withColumn(draw, F.rand(seed)).orderBy(draw).limit(n).drop(draw)


# --- rows --------------------------------------------------------------------


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.where(F.col(column).startswith(prefix))


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def part_counts(df: DataFrame) -> DataFrame:
    """Row counts per ``part`` and in total from one pass; the total has part ``all``."""
    counts = df.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        F.inline(
            F.array(
                F.struct(F.col("part").alias("part"), F.col("n").alias("n")),
                F.struct(F.lit("all").alias("part"), F.col("n").alias("n")),
            )
        )
    ).groupBy("part").agg(F.sum("n").alias("n"))


# --- ratings -----------------------------------------------------------------


def item_stats(ratings: DataFrame) -> DataFrame:
    """``item_id, n_ratings, mean_rating``; partial aggregates leave a hot item no cost."""
    return ratings.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.avg("rating").alias("mean_rating")
    )


def unrated_items(items: DataFrame, rated: DataFrame) -> DataFrame:
    """Catalogue rows whose item is not in ``rated``."""
    return items.join(rated.select("item_id").distinct(), "item_id", "left_anti")


def candidate_pairs(items: DataFrame, rated: DataFrame, user_id: int) -> DataFrame:
    """``user_id, item_id`` for every catalogue item the one user has not rated."""
    mine = rated.where(F.col("user_id") == user_id)
    return unrated_items(items, mine).select(
        F.lit(user_id).cast("long").alias("user_id"), "item_id"
    )


def rated_titles(scores: DataFrame, items: DataFrame, counts: DataFrame) -> DataFrame:
    """Join item scores with titles and rating counts; items missing anywhere drop out.

    All three sides hold one row per item, so no key is hot, and the optimiser
    picks a broadcast from the sizes it sees.
    """
    return (
        scores.join(items.select("item_id", "title"), "item_id")
        .join(counts.select("item_id", "n_ratings"), "item_id")
        .select("item_id", "title", "score", "n_ratings")
    )


def top_supported(scored: DataFrame, min_count: int = 25, k: int = 25) -> DataFrame:
    """The ``k`` best scores among items with at least ``min_count`` ratings."""
    return (
        scored.where(F.col("n_ratings") >= min_count)
        .orderBy(F.desc("score"), "item_id")
        .limit(k)
    )


def top_per_user(scored: DataFrame, k: int = 25, digits: int = 6) -> DataFrame:
    """The ``k`` best ``score`` rows per user; scores equal to ``digits`` places rank by item.

    The rank filter lets Spark keep at most ``k`` rows per user and task before
    the shuffle, so one user with a huge candidate list does not load one task.
    """
    best_first = Window.partitionBy("user_id").orderBy(F.desc(F.round("score", digits)), "item_id")
    return scored.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= k)


def matched_errors(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Truth joined with predictions on user and item, and the squared error of each pair."""
    return truth.join(
        predictions.select("user_id", "item_id", "prediction"), ["user_id", "item_id"]
    ).withColumn("squared_error", squared_error("rating", "prediction"))


def squared_errors(predictions: DataFrame) -> DataFrame:
    """Predictions that still carry the true rating, with the squared error of each."""
    return predictions.withColumn("squared_error", squared_error("rating", "prediction"))


def root_mean_square(df: DataFrame, column: str = "squared_error") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(column)).alias("rmse")
    )
