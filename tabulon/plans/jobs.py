"""End-to-end jobs: tabular regression, text classification, recommendation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.operators import evaluate, features, supervised, tables, tuning
from tabulon.operators.recommend import Recommender, fit_als, search_rank, top_items
from tabulon.session import held, written

# --- tabular regression ------------------------------------------------------


@dataclass(frozen=True)
class TabularData:
    """Rows with an assembled feature vector, the names of its entries, and its widest category."""

    rows: DataFrame
    names: list[str]
    arity: int = 0  # of the widest category


def prepare_table(
    train: DataFrame,
    others: Sequence[DataFrame] = (),
    label: str = "loss",
    key: str = "id",
    dropped: Sequence[str] = (),
) -> list[TabularData]:
    """Index the ``cat*`` columns over all frames together and assemble the features.

    The columns in ``dropped`` are left out; the indexers of all others are fitted in one pass.
    """
    columns = [c for c in train.columns if c not in (key, label, *dropped)]
    categories = [c for c in columns if c.startswith("cat")]
    values = tables.union_all(*[frame.select(*categories) for frame in (train, *others)])
    index = features.fit_string_index(values, categories, ["idx_" + c for c in categories])
    names = tables.feature_columns(columns, dropped=(key, label))
    arity = max(map(len, index.labelsArray), default=0)

    def shaped(frame: DataFrame) -> TabularData:
        ready = features.vectorised(index.transform(frame), names)
        target = [F.col(label).alias("label")] if label in frame.columns else []
        return TabularData(ready.select(key, *target, "features"), names, arity)

    return [shaped(frame) for frame in (train, *others)]


@dataclass(frozen=True)
class RegressionRun:
    model: Model
    search: CrossValidatorModel
    names: list[str]
    train: DataFrame
    validation: DataFrame

    def metrics(self) -> DataFrame:
        """Regression metrics of the best model on both parts."""
        return tables.union_all(
            *[
                evaluate.regression_metrics(self.model.transform(rows)).select(
                    F.lit(part).alias("part"), "*"
                )
                for part, rows in (("train", self.train), ("validation", self.validation))
            ]
        )

    def search_metrics(self) -> DataFrame:
        return tuning.metric_table(self.train.sparkSession, self.search, larger_is_better=False)

    def importances(self) -> DataFrame:
        return supervised.importance_table(self.train.sparkSession, self.model, self.names)

    def predictions(self, data: TabularData, key: str = "id", out: str = "loss") -> DataFrame:
        return self.model.transform(data.rows).select(key, F.col("prediction").alias(out))


def regress_table(
    data: TabularData,
    kind: str = "forest",
    key: str = "id",
    grid: dict[str, Sequence] | None = None,
    max_bins: int | None = None,
    folds: int = 3,
    seed: int = 1,
    parallelism: int = 4,
    split: Column | None = None,
    fold: Column | None = None,
    **params,
) -> RegressionRun:
    """Split 7:3, search a grid by cross-validation, refit the best tree model.

    Forests search trees and depth, boosted trees rounds and depth, with one fit for points of which one's
    model holds the other's (:func:`~tabulon.operators.tuning.search_trees`). Without
    ``max_bins`` there are 32 bins, or as many as the widest category has values.
    ``split`` (train or validation) and ``fold`` (from 0) replace the seeded ones;
    ``params`` are the library's own parameters of the model.
    """
    if grid is None:
        first = "numTrees" if kind == "forest" else "maxIter"
        grid = {first: (5, 20), "maxDepth": (4, 6)}
    if split is None:
        rows = tables.with_split(data.rows, [key], {"train": 7, "validation": 3}, seed)
    else:
        rows = data.rows.withColumn("part", split)
    train = rows.where("part = 'train'").drop("part")
    train = tables.with_fold(train, [key], folds, seed + 1) if fold is None else train.withColumn("fold", fold)
    validation = rows.where("part = 'validation'").drop("part")
    model = supervised.tree_regressor(kind, "features", "label", seed, maxBins=max_bins or max(32, data.arity), **params)
    points = tuning.param_grid({model.getParam(name): values for name, values in grid.items()})
    if kind in ("forest", "boosted"):
        search = tuning.search_trees(model, points, train, folds, parallelism=parallelism, packed=True)
    else:
        search = tuning.cross_validate(
            model, points, evaluate.rmse_evaluator(), train, folds, parallelism=parallelism, seed=seed
        )
    return RegressionRun(search.bestModel, search, data.names, train.drop("fold"), validation)


# --- text classification -----------------------------------------------------


def text_tokens(df: DataFrame, text: str = "text", out: str = "filtered") -> DataFrame:
    """Tokens without English stop words; the text itself is dropped."""
    words = features.tokenize(df, text, "words")
    return features.remove_stop_words(words, "words", out).drop("words", text)


def text_pipeline(num_features: int = 1000, min_doc_freq: int = 0, reg: float = 0.01) -> Pipeline:
    """Hashed term counts, inverse document frequency, logistic regression."""
    hashing = HashingTF(inputCol="filtered", outputCol="raw_features", numFeatures=num_features)
    idf = IDF(inputCol="raw_features", outputCol="features", minDocFreq=min_doc_freq)
    logistic = LogisticRegression(regParam=reg, threshold=0.5)
    return Pipeline(stages=[hashing, idf, logistic])


def classify_text(train: DataFrame, **settings) -> PipelineModel:
    """Fit the text pipeline on ``filtered`` tokens and ``label``."""
    with held(train.select("filtered", "label"), balanced=True) as (rows,):
        return text_pipeline(**settings).fit(rows)


def tune_text(
    train: DataFrame,
    num_features: Sequence[int] = (1_000, 10_000, 100_000),
    min_doc_freq: Sequence[int] = (0, 10, 100),
    folds: int = 3,
    key: str = "id",
    parallelism: int = 4,
    seed: int = 2018,
) -> CrossValidatorModel:
    """Search hash size and document frequency; tokens are made once, before the search, and all fits share its passes."""
    pipeline = text_pipeline()
    hashing, idf, _ = pipeline.getStages()
    grid = tuning.param_grid({hashing.numFeatures: num_features, idf.minDocFreq: min_doc_freq})
    rows = tables.with_fold(train, [key], folds, seed).select("filtered", "label", "fold")
    return tuning.search_words(pipeline, grid, evaluate.auc_evaluator(), rows, folds, parallelism=parallelism)


def tuned_and_untuned(
    train: DataFrame, test: DataFrame, key: str = "id", seed: int = 2018, **search
) -> DataFrame:
    """``test`` scored by the plain text pipeline and by the one a search found: key, model, label, prediction, auc.

    ``model`` is untuned or tuned, and ``auc`` the area under the ROC that it reaches on ``test``. ``search``
    goes to :func:`tune_text`.
    """
    models = {"untuned": classify_text(train), "tuned": tune_text(train, key=key, seed=seed, **search)}
    scored = []
    for name, model in models.items():
        rows = supervised.with_probability(model.transform(test), "score").select(key, "label", "prediction", "score")
        auc = evaluate.auc_evaluator("label", "score").evaluate(rows)
        scored.append(rows.select(key, F.lit(name).alias("model"), "label", "prediction", F.lit(float(auc)).alias("auc")))
    return tables.union_all(*scored)


# --- recommendation ----------------------------------------------------------


def recommend(
    ratings: DataFrame,
    items: DataFrame,
    new_ratings: DataFrame,
    users: DataFrame | Sequence[int],
    k: int = 25,
    min_count: int = 25,
    digits: int = 6,
    **settings,
) -> DataFrame:
    """Top ``k`` items per new user among items with at least ``min_count`` ratings.

    The model is refitted with the new ratings; rating counts are those from
    before they were added. Only supported, titled, unrated items are scored.
    The ratings are written down once, for the fit and the counts.
    """
    ratings = written(ratings, "ratings")
    fitted = recommend_model(ratings, new_ratings, **settings)
    return recommend_with(fitted, ratings, items, new_ratings, users, k, min_count, digits)


def recommend_model(ratings: DataFrame, new_ratings: DataFrame, **settings) -> Recommender:
    return fit_als(tables.union_all(ratings, new_ratings), **settings)


def recommend_best_rank(
    train: DataFrame, validation: DataFrame, ranks: Sequence[int] = (4, 8, 12), **settings
) -> tuple[Recommender, int]:
    """A model of the rank with the least validation error, fitted on both parts, and that rank."""
    found = search_rank(train, validation, ranks, **settings)
    rank = found.where("best").first()["rank"]
    return fit_als(tables.union_all(train, validation), rank=rank, **settings), rank


def recommend_with(
    fitted: Recommender,
    ratings: DataFrame,
    items: DataFrame,
    new_ratings: DataFrame,
    users: DataFrame | Sequence[int],
    k: int = 25,
    min_count: int = 25,
    digits: int = 6,
) -> DataFrame:
    supported = tables.item_stats(ratings).where(F.col("n_ratings") >= min_count)
    eligible = items.select("item_id", "title").join(
        supported.select("item_id", "n_ratings"), "item_id"
    )
    if not isinstance(users, DataFrame):
        users = ratings.sparkSession.createDataFrame([(int(u),) for u in users], "user_id long")
    best = top_items(fitted, eligible, users, new_ratings, k, digits)
    return tables.top_per_user(best, k, digits).select(
        "user_id", "place", "item_id", "title", "score", "n_ratings"
    )
