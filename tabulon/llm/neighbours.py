"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``prefix`` nearest of the pivots, in order. Rows are dealt into blocks, and the
rows of a block are posted in the inverted files of the pivots, each with the place that
the pivot has in its order. A query goes through the files of its own pivots and adds up, row by row, how
near the places are: that ranks the block by footrule distance between the orders (a pivot
outside an order counts as the place after its end). The best of a block, a bounded share of it, are
reranked by their inner product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import by_batch, stored, sub_batches
from tabulon.llm.topk import best_of

#: Rows of one inverted file block, and queries of one cell at most; more queries make more cells.
ROWS, MOST_QUERIES = 2048, 1 << 14
#: Candidates of a query, as a multiple of the square root of the number of vectors.
CANDIDATE_FACTOR = 12
FOUND = "query long, vec_id long, score double"


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows with an id and a finite vector other than zero: vec_id, vector (single precision stays so)."""
    v = F.col(vector_col)
    if vectors.schema[vector_col].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & good & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")
    )


def _with_order(vectors: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """Add ``places``: the numbers of the nearest pivots as bytes, nearest first, ties to the smaller number."""
    kind, names = _number_kind(len(pivots)), [*vectors.columns, "places"]

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 1 << 20):
            near = -(_matrix(batch.column(1)).astype(float) @ pivots.T)
            least = np.partition(near, prefix - 1, axis=1)[:, prefix - 1 : prefix]
            places = np.argsort(np.where(near <= least, near, np.inf), axis=1, kind="stable")[:, :prefix].astype(kind)
            packed = pa.array([row.tobytes() for row in places], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed], names)

    kinds = [f"{c} {t}" for c, t in vectors.dtypes]
    return by_batch(vectors, order, ", ".join([*kinds, "places binary"]))


def _number_kind(pivots: int) -> type:
    return np.uint8 if pivots <= 256 else np.uint16 if pivots <= 1 << 16 else np.uint32


class PivotFiles:
    """The inverted files of a block: per pivot an entry for each row, its place in the row's order, or ``prefix`` if it isn't there."""

    def __init__(self, places: np.ndarray, pivots: int):
        rows, self.prefix = places.shape
        kind, self.wide = (np.uint8, np.uint16) if self.prefix < 256 else (np.uint16, np.uint64)
        self.files = np.full((pivots, rows), self.prefix, kind)
        self.own = np.arange(self.prefix, dtype=kind)[:, None]
        self.files[places.T, np.arange(rows)] = self.own

    def nearness(self, own: np.ndarray) -> np.ndarray:
        """Per row prefix * (prefix + 1) less the footrule distance to a query's order ``own``; 0 where no pivot is shared."""
        place = np.maximum(self.files[own], self.own)
        return 2 * (self.prefix * self.prefix - np.add.reduce(place, axis=0, dtype=self.wide).astype(np.int64))


def candidates_of(nearness: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` rows of least footrule distance; rows as far as the last of them come along, those without a shared pivot don't."""
    if wanted >= len(nearness):
        return np.arange(len(nearness))
    least = np.partition(nearness, len(nearness) - wanted)[len(nearness) - wanted]
    return np.flatnonzero(nearness >= max(least, 1))


class Asked:
    """The queries of a cell, each with the best vectors it has met so far."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, vectors: np.ndarray, places: np.ndarray, k: int, pivots: int, share: float | None):
        self.keys, self.ids, self.vectors, self.places = keys, ids, vectors, places
        self.k, self.pivots, self.share = k, pivots, share
        self.best = [(np.empty(0), np.empty(0, np.int64))] * len(keys)
        self.reranked = 0

    def meet(self, ids: np.ndarray, vectors: np.ndarray, places: np.ndarray) -> None:
        """Rank a block by footrule distance for every query and rerank the first of it by inner product."""
        wanted = len(ids) if self.share is None else max(self.k + 1, math.ceil(self.share * len(ids)))
        files = PivotFiles(places, self.pivots) if wanted < len(ids) else None
        for q in range(len(self.keys)):
            found = candidates_of(files.nearness(self.places[q]), wanted) if files else np.arange(len(ids))
            if len(found) <= self.k:  # hardly a shared pivot: the block has no order for this query
                found = np.arange(len(ids))
            self.reranked += len(found)
            found = found[ids[found] != self.ids[q]]
            scores = (vectors[found] * self.vectors[q]).sum(1)
            held, held_ids = self.best[q]
            if len(held) == self.k:
                better = scores >= held[-1]
                found, scores = found[better], scores[better]
            if len(found):
                scores, found = np.concatenate([held, scores]), np.concatenate([held_ids, ids[found]])
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


def _search(dealt: DataFrame, cells: int, k: int, pivots: int, prefix: int, share: float | None) -> DataFrame:
    """The ``k`` best of each cell for each of its queries; a cell's queries come first, then its rows as a stream."""
    kind = _number_kind(pivots)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, asked = None, [], None
        for batch in batches:
            cells, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int8)
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(asks) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(cells)]):
                if cells[a] != cell:
                    if asked is not None:
                        yield asked.results()
                    cell, parts, asked = cells[a], [], None
                for start in range(a, b, ROWS):
                    part = batch.slice(start, min(ROWS, b - start))
                    places = np.frombuffer(b"".join(part.column(5).to_pylist()), kind).reshape(-1, prefix)
                    columns = part.column(3).to_numpy(), _matrix(part.column(4)).astype(float), places
                    if asks[a]:
                        parts.append((part.column(2).to_numpy(), *columns))
                        continue
                    if asked is None and parts:
                        asked = Asked(*[np.concatenate(x) for x in zip(*parts)], k, pivots, share)
                    if asked is not None:
                        asked.meet(*columns)
        if asked is not None:
            yield asked.results()

    return (
        dealt.repartition(cells, "cell")
        .sortWithinPartitions("cell", F.desc("asks"), "vec_id", "query")
        .transform(by_batch, search, FOUND)
    )


def nearest(
    vectors: DataFrame,
    queries: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    pivots: int = 256,
    prefix: int = 64,
    candidates: int | None = None,
    exact: bool = False,
    seed: int = 11,
) -> DataFrame:
    """The ``k`` vectors with the largest inner product for each row where ``queries`` holds.

    Returns query_id, rank (from 1), vec_id, score (inner product in double precision),
    nearest first, ties to the smaller id, the query's own row left out. The pivots, a
    sample, are the only thing that is fitted on a sample and broadcast; every vector is posted.
    ``candidates`` is the recall parameter: how many vectors a query is compared with in full, 12 times
    the square root of their number unless given, so a share that falls as the table
    grows. Each block gives its part of them. ``exact`` compares with all.

    Blocks of rows grow with the square root of their number, and each meets each block of queries in one cell, so
    no task holds a pivot's file as a whole. Of equal vectors only the ``k`` + 1 smallest ids can be among the
    answers, so only they are posted.

    Null or zero vectors, vectors with null or non-finite components and rows without an id take
    no part, nor do vectors of another length than most. Rows with one id and one vector
    count once; an id with several vectors asks with all of them for one result. Further columns are
    not looked at. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    own = usable(vectors, id_col, vector_col)
    lengths = own.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "d").first()
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if common is None:
        return nothing
    own = own.where(F.size("vector") == common["d"]).distinct()
    same = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    own = stored(own.withColumn("same", same).where(F.col("same") <= k + 1).drop("same"), "vectors")
    asked = usable(vectors.where(queries), id_col, vector_col).where(F.size("vector") == common["d"]).distinct()
    sampled = own.orderBy(F.xxhash64(F.lit(seed), F.col("vector").cast("array<double>")), "vec_id").limit(pivots)
    chosen = np.array([row["vector"] for row in sampled.select("vector").collect()], float)
    prefix = min(prefix, len(chosen))
    own = stored(_with_order(own, chosen, prefix), "orders")
    asked = stored(_with_order(asked, chosen, prefix).withColumn("query", F.xxhash64("vec_id", "vector")), "asked")
    n, n_queries = own.count(), asked.count()
    if not n_queries:
        return nothing
    wanted = math.ceil(CANDIDATE_FACTOR * math.sqrt(n)) if candidates is None else candidates
    size = max(512, 8 * math.isqrt(n))
    blocks, query_blocks = math.ceil(n / size), math.ceil(n_queries / min(4 * size, MOST_QUERIES))

    def dealt(column: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), column), F.lit(parts))

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    held = own.select("*", dealt("vec_id", blocks).alias("block"), each(query_blocks).alias("query_block"), F.lit(0).cast("long").alias("query"))
    ask = asked.select("*", dealt("query", query_blocks).alias("query_block"), each(blocks).alias("block"))
    cell = (F.col("block") * query_blocks + F.col("query_block")).alias("cell")
    columns = ["query", "vec_id", "vector", "places"]
    both = held.select(cell, F.lit(False).alias("asks"), *columns).unionAll(ask.select(cell, F.lit(True).alias("asks"), *columns))
    found = _search(both, blocks * query_blocks, k, len(chosen), prefix, None if exact else wanted / n)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("place", place).where(F.col("place") <= k)
    named = found.join(asked.select("query", F.col("vec_id").alias("query_id")), "query").select("query_id", "vec_id", "score").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return named.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
