"""Exact top-k search by term-at-a-time accumulation.

Rows are sparse: a component other than zero is a term with a weight. The rows of a
block are turned into one posting list per term. A query takes its terms one after the
other and scatters the weights of each list, times its own, into a dense array with one
score per row of the block. The best are taken by partition selection and merged with
those of the earlier blocks.

The queries and the rows they are compared with are each dealt into blocks, and every
pair of blocks is one cell for one task, which holds the queries of the cell and reads
its rows as a stream.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import by_batch, stored
from tabulon.llm.vectors import extent, whole_numbers

#: Rows whose postings and scores a task holds at a time.
ROWS = 2048
#: Queries of one cell at most; more of them make more cells.
MOST_QUERIES = 1 << 16
FOUND = "query bigint, vec_id bigint, score bigint"


class Postings:
    """The posting lists of a block of rows: per term the rows that have it, and their weights."""

    def __init__(self, sizes: np.ndarray, weights: np.ndarray):
        """Rows laid end to end: how many components each has, and all components."""
        self.rows = len(sizes)
        row = np.repeat(np.arange(self.rows), sizes)
        term = np.arange(len(weights)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        full = np.flatnonzero(weights)
        order = full[np.argsort(term[full], kind="stable")]
        self.row, self.weight = row[order], weights[order]
        self.first = np.searchsorted(term[order], np.arange(int(sizes.max(initial=0)) + 1))

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Inner product of one sparse query with every row; terms that no row has add nothing."""
        out = np.zeros(self.rows, np.int64)
        for term, weight in zip(terms, weights):
            if term + 1 < len(self.first):
                a, b = self.first[term], self.first[term + 1]
                if b - a == self.rows:
                    out += self.weight[a:b] * weight
                else:
                    out[self.row[a:b]] += self.weight[a:b] * weight
        return out


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, best first, equal ones by smaller id."""
    places = np.arange(len(scores))
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


class Queries:
    """The queries of a cell, each with the best rows it has met so far."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray, k: int):
        self.keys, self.ids, self.k = keys, ids, k
        self.sparse = [(np.flatnonzero(w).tolist(), w[w != 0].tolist()) for w in np.split(weights, np.cumsum(sizes)[:-1])]
        nothing = np.empty(0, np.int64)
        self.best = [(nothing, nothing)] * len(keys)

    def meet(self, ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> None:
        """Score a block of rows for every query."""
        postings = Postings(sizes, weights)
        for q, (terms, own) in enumerate(self.sparse):
            scores = postings.scores(terms, own)
            held, held_ids = self.best[q]
            fresh = ids != self.ids[q]
            if len(held) == self.k:
                fresh &= scores >= held[-1]
            fresh = np.flatnonzero(fresh)
            fresh = fresh[best_of(scores[fresh], ids[fresh], self.k)]
            if len(fresh):
                scores, found = np.concatenate([held, scores[fresh]]), np.concatenate([held_ids, ids[fresh]])
                order = best_of(scores, found, self.k)
                self.best[q] = scores[order], found[order]

    def results(self) -> pa.RecordBatch:
        counts = [len(scores) for scores, _ in self.best]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(self.keys, counts)),
                pa.array(np.concatenate([ids for _, ids in self.best])),
                pa.array(np.concatenate([scores for scores, _ in self.best])),
            ],
            ["query", "vec_id", "score"],
        )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Slices of one cell and one kind (queries first), of at most ``ROWS`` rows: cell, asks, and their columns."""
    for batch in batches:
        cells = batch.column(0).to_numpy()
        asks = batch.column(1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(cells)]):
            for start in range(a, b, ROWS):
                part = batch.slice(start, min(ROWS, b - start))
                lists = part.column(4)
                sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                weights = lists.flatten().to_numpy(zero_copy_only=False)
                yield cells[a], asks[a], (part.column(2).to_numpy(), part.column(3).to_numpy(), sizes, weights)


def _search(dealt: DataFrame, cells: int, k: int) -> DataFrame:
    """The ``k`` best of each cell for each of its queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked, queries = None, [], None
        for at, asks, columns in _runs(batches):
            if at != cell:
                if queries is not None:
                    yield queries.results()
                cell, asked, queries = at, [], None
            if asks:
                asked.append(columns)
                continue
            if queries is None and asked:
                queries = Queries(*[np.concatenate(x) for x in zip(*asked)], k)
            if queries is not None:
                _, ids, sizes, weights = columns
                queries.meet(ids, sizes, weights)
        if queries is not None:
            yield queries.results()

    return (
        dealt.repartition(cells, "cell")
        .sortWithinPartitions("cell", F.desc("asks"))
        .transform(by_batch, search, FOUND)
    )


def top_k(
    vectors: DataFrame,
    queries: Column,
    *,
    k: int = 5,
    factor: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` rows with the highest inner product for each row where ``queries`` holds.

    Components become floor(factor * x); the score is the inner product in whole numbers.
    Returns query_id, rank (from 1), vec_id, score, equal scores by smaller id. Rows
    with the query's own id are no candidates. Every row is compared with every query. Blocks
    grow with the square root of the number of rows, so the copies that are
    shuffled grow with the power 1.5, and a task holds at most ``MOST_QUERIES`` queries.

    Vectors that are null or hold null or non-finite components, and rows without an id, take
    no part. Vectors may differ in length: a missing component is zero. Rows with one id
    and one vector count once; an id with several vectors has one result for each as a query.
    Further columns are not looked at. An empty table gives an empty result, and a single row no
    answers. An error is raised for components so large that a score could go beyond 64 bits.
    """
    spark = vectors.sparkSession
    rows = stored(whole_numbers(vectors, id_col, vector_col, factor).where(F.col("vec_id").isNotNull()).distinct(), "rows")
    asked = whole_numbers(vectors.where(queries), id_col, vector_col, factor).where(F.col("vec_id").isNotNull()).distinct()
    asked = stored(asked.withColumn("query", F.xxhash64("vec_id", "weights")), "queries")
    n, length, most = extent(rows)
    n_queries = asked.count()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if length * most * most >= 1 << 63:
        raise ValueError(f"components of magnitude {most} are too large for scores of 64 bits")
    size = max(512, 8 * math.isqrt(n))
    blocks, query_blocks = math.ceil(n / size), math.ceil(n_queries / min(size, MOST_QUERIES))

    def dealt(column: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(parts))

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    held = rows.select("vec_id", "weights", dealt("vec_id", blocks).alias("block"), each(query_blocks).alias("query_block"))
    ask = asked.select("query", "vec_id", "weights", dealt("query", query_blocks).alias("query_block"), each(blocks).alias("block"))
    cell = (F.col("block") * query_blocks + F.col("query_block")).alias("cell")
    both = held.select(cell, F.lit(False).alias("asks"), F.lit(0).cast("long").alias("query"), "vec_id", "weights").unionAll(
        ask.select(cell, F.lit(True).alias("asks"), "query", "vec_id", "weights")
    )
    found = _search(both, blocks * query_blocks, k)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    best = found.select("query", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
    names = asked.select("query", F.col("vec_id").alias("query_id"))
    return best.join(names, "query").select("query_id", "rank", "vec_id", "score")
