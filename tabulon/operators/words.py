"""Word vectors as tables, from sums over word pairs.

Vectors trained by skip-grams with negative samples factorise, in effect, the pointwise mutual
information of words and contexts. Here that is done directly: pairs are counted, and the
positive mutual information (zero for all other pairs) is factorised by alternating least
squares. All unseen pairs enter through one small matrix, the products of the factors of
the other side, so a round costs one row per seen pair and no task or driver holds the vocabulary.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.operators.ordering import dense_ids
from tabulon.operators.recommend import best_items
from tabulon.session import written


def pair_counts(df: DataFrame, column: str, window: int = 5) -> DataFrame:
    """``word, context, n``: how often two tokens are at most ``window`` places apart, in both directions.

    Pairs are counted in each task before they are shuffled.
    """
    n = F.size("words")
    apart = df.select(F.col(column).alias("words")).withColumn("apart", F.explode(F.sequence(F.lit(1), F.lit(window)))).where(n > F.col("apart"))
    first = F.slice("words", F.lit(1), n - F.col("apart")).alias("word")
    then = F.slice("words", F.col("apart") + 1, n - F.col("apart")).alias("context")
    near = apart.select(first, then).select(F.inline(F.arrays_zip("word", "context"))).where("word is not null and context is not null")
    once = near.groupBy("word", "context").agg(F.count(F.lit(1)).alias("n"))
    both = once.unionAll(once.select(F.col("context").alias("word"), F.col("word").alias("context"), "n"))
    return both.groupBy("word", "context").agg(F.sum("n").alias("n"))


def mutual_information(counts: DataFrame) -> DataFrame:
    """``word, context, x``: the logarithm of how much oftener a pair occurs than by chance, where that is positive."""
    words = counts.groupBy("word").agg(F.sum("n").alias("n_word"))
    total = words.agg(F.sum("n_word")).first()[0] or 1
    contexts = words.select(F.col("word").alias("context"), F.col("n_word").alias("n_context"))
    x = F.log(F.col("n") * F.lit(float(total)) / (F.col("n_word") * F.col("n_context")))
    return counts.join(words, "word").join(contexts, "context").select("word", "context", x.alias("x")).where(F.col("x") > 0)


def _times(vector: Column, matrix: np.ndarray) -> Column:
    rows = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in matrix])
    product = lambda row: F.aggregate(F.zip_with(row, vector, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return F.transform(rows, product)


def _half(pairs: DataFrame, factors: DataFrame, key: str, other: str, size: int, reg: float) -> DataFrame:
    entries = [F.col("vector")[i] for i in range(size)]
    squares = factors.agg(*[F.sum(a * b) for i, a in enumerate(entries) for b in entries[: i + 1]]).first()
    gram = np.zeros((size, size))
    gram[np.tril_indices(size)] = [v or 0.0 for v in squares]
    gram = gram + np.tril(gram, -1).T
    inverse = np.linalg.inv(gram + reg * np.eye(size))
    sums = pairs.join(factors, other).groupBy(key).agg(*[F.sum(F.col("x") * e).alias(f"s{i}") for i, e in enumerate(entries)])
    solved = sums.select(key, F.array(*[f"s{i}" for i in range(size)]).alias("s"))
    return written(solved.select(key, _times(F.col("s"), inverse).alias("vector")), "words")


def fit_word_tables(
    df: DataFrame, column: str, size: int = 16, window: int = 5, min_count: int = 1, rounds: int = 5, reg: float = 0.1, seed: int = 1
) -> DataFrame:
    """``word, vector`` of every token that occurs in ``min_count`` pairs or more and not by chance only.

    The contexts start from hashes of ``seed`` and word, so a fit does not depend on partitions but for
    the order of sums. The driver takes ``size`` squared sums per half round. A hot word's pairs are
    summed in each task; the adaptive skew join splits them. Null lists and null tokens are left out,
    and so are words that stand alone. No text makes no vectors.
    """
    counts = written(pair_counts(df, column, window), "pairs")
    if min_count > 1:
        frequent = counts.groupBy("word").agg(F.sum("n").alias("of_word")).where(F.col("of_word") >= min_count).select("word")
        counts = counts.join(frequent, "word", "left_semi")
        counts = counts.join(frequent.withColumnRenamed("word", "context"), "context", "left_semi")
    pairs = written(mutual_information(counts), "information")
    start = [F.pmod(F.xxhash64(F.lit(seed), F.lit(i), "context"), F.lit(1 << 20)) / float(1 << 20) - 0.5 for i in range(size)]
    contexts = pairs.select("context").distinct().withColumn("vector", F.array(*start))
    words = pairs.select("word").distinct().withColumn("vector", F.array(*[F.lit(0.0)] * size))
    for _ in range(rounds):
        words = _half(pairs, contexts, "word", "context", size, reg)
        contexts = _half(pairs, words, "context", "word", size, reg)
    return words


def alike(vectors: DataFrame, k: int = 1, block: int = 4096) -> DataFrame:
    """``word, place, other, cosine``: the ``k`` words of nearest direction for each word, equal ones by word.

    Vectors are scaled to length one and searched as items of :func:`tabulon.operators.recommend.best_items`.
    """
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    ids = dense_ids(vectors, "word", "id").withColumn("id", F.col("id").cast("long"))
    scaled = vectors.withColumn("length", length).where(F.col("length") > 0)
    scaled = scaled.join(ids, "word").select("id", "word", F.transform("vector", lambda x: x / F.col("length")).alias("features"))
    scaled = written(scaled, "directions")
    own = scaled.select(F.col("id").alias("user_id"), F.col("id").alias("item_id"))
    found = best_items(
        scaled.select(F.col("id").alias("item_id"), "features"), scaled.select(F.col("id").alias("user_id"), "features"), own, k, block_items=block
    )
    lists = found.select(F.col("user_id").alias("id"), F.posexplode(F.arrays_zip("best", "scores")).alias("place", "entry"))
    names = scaled.select(F.col("id").alias("other_id"), F.col("word").alias("other"))
    named = lists.select("id", "place", F.col("entry.best").alias("other_id"), F.col("entry.scores").alias("cosine"))
    return named.join(scaled.select("id", "word"), "id").join(names, "other_id").select("word", "place", "other", "cosine")
