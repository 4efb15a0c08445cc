"""Explicit-feedback matrix factorisation: fit, predict, save, rank search, recommend."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators.ordering import dense_ids, with_positions
from tabulon.operators.tables import root_mean_square, squared_errors
from tabulon.session import held, materialised, shared_folder

_INT_MAX = 2**31 - 1


@dataclass(frozen=True)
class Recommender:
    """A fitted factor model, with id tables where the ids do not fit 32 bits."""

    model: ALSModel
    users: DataFrame | None = None
    items: DataFrame | None = None

    def user_factors(self) -> DataFrame:
        return _named_factors(self.model.userFactors, self.users, "user_id")

    def item_factors(self) -> DataFrame:
        return _named_factors(self.model.itemFactors, self.items, "item_id")

    def predict(self, pairs: DataFrame) -> DataFrame:
        """Add ``prediction``; pairs with an unknown user or item are dropped."""
        coded = _coded(pairs, self.users, "user_id", "_user")
        coded = _coded(coded, self.items, "item_id", "_item").dropna(subset=["_user", "_item"])
        scored = self.model.transform(coded)
        return scored.select(*pairs.columns, F.col("prediction").cast("double").alias("prediction"))


def _named_factors(factors: DataFrame, ids: DataFrame | None, name: str) -> DataFrame:
    if ids is None:
        return factors.select(F.col("id").cast("long").alias(name), "features")
    return factors.join(ids.withColumnRenamed("_code", "id"), "id").select(name, "features")


def _coded(df: DataFrame, ids: DataFrame | None, column: str, out: str) -> DataFrame:
    if ids is None:
        return df.withColumn(out, F.expr(f"try_cast({column} AS INT)"))
    return df.join(ids.withColumnRenamed("_code", out), column)


def fit_als(
    ratings: DataFrame,
    rank: int = 8,
    iterations: int = 10,
    reg: float = 0.1,
    seed: int = 5,
    blocks: int = 10,
    nonnegative: bool = False,
) -> Recommender:
    """Factorise ``user_id, item_id, rating``.

    The library needs 32-bit ids: ids in that range are cast, others replaced by
    dense codes from a join table. ``blocks`` is the number of blocks of users and of
    items: raise it with the ratings, which lie in blocks; starting factors depend on it.
    """
    spark = ratings.sparkSession
    shared_folder(spark)  # the fit cuts its own lineage there
    with held(ratings.select("user_id", "item_id", "rating")) as (rows,):
        low_u, high_u, low_i, high_i = rows.agg(
            F.min("user_id"), F.max("user_id"), F.min("item_id"), F.max("item_id")
        ).first()
        users = None if _fits_int(low_u, high_u) else dense_ids(rows, "user_id", "_code")
        items = None if _fits_int(low_i, high_i) else dense_ids(rows, "item_id", "_code")
        coded = _coded(_coded(rows, users, "user_id", "_user"), items, "item_id", "_item")
        als = ALS(
            userCol="_user",
            itemCol="_item",
            ratingCol="rating",
            rank=rank,
            maxIter=iterations,
            regParam=reg,
            seed=seed,
            numUserBlocks=blocks,
            numItemBlocks=blocks,
            nonnegative=nonnegative,
            coldStartStrategy="drop",
        )
        return Recommender(als.fit(coded), users, items)


def _fits_int(low, high) -> bool:
    return low is None or (-_INT_MAX <= low and high <= _INT_MAX)


def save_recommender(recommender: Recommender, path: str) -> None:
    recommender.model.write().overwrite().save(f"{path}/model")
    for name in ("users", "items"):
        ids = getattr(recommender, name)
        if ids is not None:
            ids.write.mode("overwrite").parquet(f"{path}/{name}")
    kept = {name: getattr(recommender, name) is not None for name in ("users", "items")}
    spark = recommender.model.userFactors.sparkSession
    spark.createDataFrame([(json.dumps(kept),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/id_tables")


def load_recommender(spark: SparkSession, path: str) -> Recommender:
    kept = json.loads(spark.read.text(f"{path}/id_tables").first()["value"])
    tables = {n: spark.read.parquet(f"{path}/{n}") if kept[n] else None for n in kept}
    return Recommender(ALSModel.load(f"{path}/model"), **tables)


def search_rank(
    train: DataFrame, validation: DataFrame, ranks: Sequence[int] = (4, 8, 12), **settings
) -> DataFrame:
    """``rank, n, rmse, best``: validation error per rank, the lowest marked."""
    spark = train.sparkSession
    rows = []
    with held(train, validation) as (train_rows, validation_rows):
        for rank in ranks:
            fitted = fit_als(train_rows, rank=rank, **settings)
            found = root_mean_square(squared_errors(fitted.predict(validation_rows))).first()
            rows.append((rank, found["n"], found["rmse"]))
    best = min(rows, key=lambda row: (row[2], row[0]))[0]
    return spark.createDataFrame(
        [(*row, row[0] == best) for row in rows], "rank int, n long, rmse double, best boolean"
    )


def score_users(recommender: Recommender, items: DataFrame, users: Sequence[int]) -> DataFrame:
    """``user_id, <item columns>, score`` of every given item for a handful of users.

    The users' factors travel inside the plan and the items are scored where they
    lie. For many users see :func:`top_items`, which makes no row per pair.
    """
    factors = recommender.item_factors().join(items, "item_id")
    found = recommender.user_factors().where(F.col("user_id").isin([int(u) for u in users])).collect()
    if not found:
        return items.select(F.lit(None).cast("long").alias("user_id"), "*").limit(0).withColumn(
            "score", F.lit(0.0)
        )
    tastes = [
        F.struct(
            F.lit(row["user_id"]).cast("long").alias("user_id"),
            F.array(*[F.lit(float(v)) for v in row["features"]]).alias("taste"),
        )
        for row in found
    ]
    scored = factors.select(*items.columns, "features", F.inline(F.array(*tastes)))
    return scored.select("user_id", *items.columns, _product("features", "taste").alias("score"))


def _product(one: Column | str, two: Column | str) -> Column:
    parts = F.zip_with(one, two, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)


#: Users of one cell; a task holds their factors and best items and reads the item blocks as a stream.
CELL_USERS = 1024
_STATE = "user_id long, taste array<double>, rated array<long>, best array<long>, scores array<double>, met int"


def item_blocks(factors: DataFrame, block_items: int) -> DataFrame:
    """``block, ids, numbers, longest, shortest``: items packed by falling length of their factors."""
    length = F.sqrt(_product("features", "features"))
    placed = with_positions(
        factors.select(F.col("item_id").cast("long").alias("item_id"), F.col("features").cast("array<double>").alias("features"), length.alias("length")),
        [F.desc("length"), "item_id"],
        "place",
    )
    entries = F.sort_array(F.collect_list(F.struct("item_id", "features")))
    packed = placed.groupBy(F.floor(F.col("place") / block_items).cast("int").alias("block")).agg(
        entries.alias("held"), F.max("length").alias("longest"), F.min("length").alias("shortest")
    )
    return packed.select(
        "block",
        F.col("held.item_id").alias("ids"),
        F.flatten("held.features").alias("numbers"),
        "longest",
        "shortest",
    )


def _meet_blocks(k: int, digits: int):
    """The work of one round: users of a cell meet the blocks that can still change their best items.

    Rows of a cell come users first, then blocks by number. No score is longer than the
    product of both lengths (Cauchy-Schwarz), so a user passes over a block whose longest
    factor can't reach the user's ``k``-th score, and is closed as soon as that holds for all blocks to come.
    """

    def rounded(x: np.ndarray) -> np.ndarray:
        return np.copysign(np.floor(np.abs(x) * 10.0**digits + 0.5), x)

    def best_first(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        places = np.arange(len(ids))
        if len(ids) > k:
            least = np.partition(scores, len(ids) - k)[len(ids) - k]
            places = np.flatnonzero(scores >= least)
        return places[np.lexsort((ids[places], -scores[places]))[:k]]

    class Cell:
        def __init__(self, rows: list[dict]):
            self.rows = rows
            self.tastes = np.array([row["numbers"] for row in rows], float)
            self.lengths = np.sqrt((self.tastes**2).sum(1)) * (1 + 1e-9)
            self.rated = [row["ids"] for row in rows]
            self.best = [row["best"] for row in rows]
            self.scores = [row["scores"] for row in rows]
            self.met = [row["met"] for row in rows]
            self.least = np.array([self.reached(u) for u in range(len(rows))])
            self.shortest = 0.0

        def reached(self, user: int) -> float:
            return rounded(self.scores[user][-1:])[0] if len(self.best[user]) == k else -np.inf

        def meet(self, block: dict) -> None:
            self.shortest = block["shortest"]
            ids = block["ids"]
            factors = block["numbers"].reshape(len(ids), -1)
            users = np.flatnonzero(rounded(self.lengths * block["longest"]) >= self.least)
            products = self.tastes[users] @ factors.T
            for user, scores in zip(users.tolist(), products):
                self.met[user] += 1
                near = rounded(scores)
                found = np.flatnonzero(near >= self.least[user])
                if len(self.rated[user]):
                    found = found[~np.isin(ids[found], self.rated[user])]
                found = found[best_first(near[found], ids[found])]
                if len(found):
                    every, all_ids = np.concatenate([self.scores[user], scores[found]]), np.concatenate([self.best[user], ids[found]])
                    order = best_first(rounded(every), all_ids)
                    self.scores[user], self.best[user] = every[order], all_ids[order]
                    self.least[user] = self.reached(user)

        def states(self) -> pa.RecordBatch:
            is_open = rounded(self.lengths * self.shortest) >= self.least
            lists = pa.list_(pa.float64()), pa.list_(pa.int64())
            columns = [
                pa.array([row["key"] for row in self.rows], pa.int64()),
                pa.array([row["numbers"] for row in self.rows], lists[0]),
                pa.array([row["ids"] for row in self.rows], lists[1]),
                pa.array(self.best, lists[1]),
                pa.array(self.scores, lists[0]),
                pa.array(self.met, pa.int32()),
                pa.array(is_open),
            ]
            return pa.RecordBatch.from_arrays(columns, ["user_id", "taste", "rated", "best", "scores", "met", "is_open"])

    def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
        """Rows with their lists as arrays: the lists of a block are long."""
        lists = ("numbers", "ids", "best", "scores")
        rest = batch.drop_columns(list(lists)).to_pylist()
        for place, row in enumerate(rest):
            yield row | {c: batch.column(c).slice(place, 1).flatten().to_numpy(zero_copy_only=False) for c in lists}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, users, cell = None, [], None
        for batch in batches:
            for row in rows_of(batch):
                if row["cell"] != number:
                    if cell is not None:
                        yield cell.states()
                    number, users, cell = row["cell"], [], None
                if row["block"] < 0:
                    users.append(row)
                    continue
                if cell is None and users:
                    cell = Cell(users)
                if cell is not None:
                    cell.meet(row)
        if cell is not None:
            yield cell.states()

    return work


def _round(users: DataFrame, n_users: int, blocks: DataFrame, k: int, digits: int) -> DataFrame:
    """The users' states and whether they are open still, after the given blocks."""
    cells = -(-n_users // CELL_USERS)
    none = F.expr("cast(array() as array<long>)"), F.expr("cast(array() as array<double>)")
    asked = users.select(
        F.pmod(F.xxhash64("user_id"), F.lit(cells)).cast("int").alias("cell"), F.lit(-1).alias("block"),
        F.col("user_id").alias("key"), F.col("taste").alias("numbers"), F.col("rated").alias("ids"), "best", "scores", "met",
        F.lit(0.0).alias("longest"), F.lit(0.0).alias("shortest"),
    )
    offered = blocks.select(
        F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), "block",
        F.lit(None).cast("long").alias("key"), "numbers", "ids", none[0].alias("best"), none[1].alias("scores"), F.lit(0).alias("met"),
        "longest", "shortest",
    )
    dealt = asked.unionByName(offered).repartition(cells, "cell").sortWithinPartitions("cell", "block")
    return materialised(dealt.mapInArrow(_meet_blocks(k, digits), f"{_STATE}, is_open boolean"))


def best_items(
    item_factors: DataFrame, user_factors: DataFrame, rated: DataFrame, k: int = 25, digits: int = 6, block_items: int = 4096
) -> DataFrame:
    """``user_id, best, scores, met``: the ids and scores of the ``k`` best unrated items of each user, best first.

    Scores are compared after rounding half away from zero to ``digits`` places, equal ones rank
    by item. Items are cut into blocks of ``block_items`` by falling length of their factors. In
    each round the users that are still open meet twice as many blocks as in the round before,
    so blocks are sent only to cells of open users; ``met`` counts the blocks that a user was scored against.
    """
    blocks = materialised(item_blocks(item_factors, block_items))
    known = rated.groupBy("user_id").agg(F.collect_set(F.col("item_id").cast("long")).alias("rated"))
    users = user_factors.join(known, "user_id", "left").select(
        F.col("user_id").cast("long").alias("user_id"),
        F.col("features").cast("array<double>").alias("taste"),
        F.coalesce("rated", F.expr("cast(array() as array<long>)")).alias("rated"),
        F.expr("cast(array() as array<long>)").alias("best"),
        F.expr("cast(array() as array<double>)").alias("scores"),
        F.lit(0).alias("met"),
    )
    users = materialised(users)
    n_blocks, n_users = blocks.count(), users.count()
    first, step, closed = 0, 1, users.limit(0)
    while first < n_blocks and n_users:
        these = blocks.where((F.col("block") >= first) & (F.col("block") < first + step))
        states = _round(users, n_users, these, k, digits)
        first, step = first + step, step * 2
        going = F.col("is_open") & F.lit(first < n_blocks)
        closed = closed.unionByName(states.where(~going).drop("is_open"))
        users = states.where(going).drop("is_open")
        n_users = users.count() if first < n_blocks else 0
    return closed.select("user_id", "best", "scores", "met")


def top_items(
    recommender: Recommender,
    items: DataFrame,
    users: DataFrame,
    rated: DataFrame,
    k: int = 25,
    digits: int = 6,
    block_items: int = 4096,
) -> DataFrame:
    """``user_id, <item columns>, score``: the ``k`` best items of each user that the user has not rated.

    There is no row per pair of user and item, and a user stops at the first block of
    items that can't win (:func:`best_items`). Users without a factor are left out.
    """
    factors = recommender.item_factors().join(items.select("item_id").distinct(), "item_id", "left_semi")
    asked = recommender.user_factors().join(users.select("user_id").distinct(), "user_id", "left_semi")
    best = best_items(factors, asked, rated, k, digits, block_items)
    lists = best.select("user_id", F.col("best").alias("item_id"), F.col("scores").alias("score"))
    found = lists.select("user_id", F.inline(F.arrays_zip("item_id", "score")))
    return found.join(items, "item_id").select("user_id", *items.columns, "score")
