"""Regression and classification: fits with the usual defaults, and fitted models as tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml import classification as mc
from pyspark.ml import regression as mr
from pyspark.ml.feature import IndexToString, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators.evaluate import best_threshold, regression_metrics, threshold_table
from tabulon.operators.features import fit_bins, fit_string_index, fit_vector_index
from tabulon.session import held

# --- linear models -----------------------------------------------------------


def fit_linear(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    reg: float = 0.3,
    elastic_net: float = 0.8,
    max_iter: int = 10,
    solver: str = "auto",
) -> mr.LinearRegressionModel:
    regression = mr.LinearRegression(
        featuresCol=features,
        labelCol=label,
        regParam=reg,
        elasticNetParam=elastic_net,
        maxIter=max_iter,
        solver=solver,
    )
    with held(df.select(features, label), balanced=True) as (rows,):
        return regression.fit(rows)


def fit_glm(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    family: str = "gaussian",
    link: str = "identity",
    reg: float = 0.3,
    max_iter: int = 10,
) -> mr.GeneralizedLinearRegressionModel:
    regression = mr.GeneralizedLinearRegression(
        featuresCol=features,
        labelCol=label,
        family=family,
        link=link,
        regParam=reg,
        maxIter=max_iter,
    )
    return regression.fit(df.select(features, label))


def fit_logistic(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    reg: float = 0.3,
    elastic_net: float = 0.8,
    max_iter: int = 10,
    family: str = "auto",
    threshold: float = 0.5,
    tol: float = 1e-6,
) -> mc.LogisticRegressionModel:
    regression = mc.LogisticRegression(
        featuresCol=features,
        labelCol=label,
        regParam=reg,
        elasticNetParam=elastic_net,
        maxIter=max_iter,
        family=family,
        threshold=threshold,
        tol=tol,
    )
    with held(df.select(features, label), balanced=True) as (rows,):
        return regression.fit(rows)


def linear_table(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """``term, coefficient`` of a model with one coefficient vector; the intercept comes last."""
    rows = [(name, float(value)) for name, value in zip(names, model.coefficients.toArray())]
    return spark.createDataFrame(
        [*rows, ("(intercept)", float(model.intercept))], "term string, coefficient double"
    )


def linear_summary_table(spark: SparkSession, model: mr.LinearRegressionModel) -> DataFrame:
    summary = model.summary
    history = list(summary.objectiveHistory)
    row = (
        int(summary.totalIterations),
        float(history[0]),
        float(history[-1]),
        float(summary.rootMeanSquaredError),
        float(summary.r2),
    )
    return spark.createDataFrame(
        [row],
        "iterations int, first_objective double, last_objective double, rmse double, r2 double",
    )


def glm_summary_table(
    spark: SparkSession, model: mr.GeneralizedLinearRegressionModel, names: Sequence[str]
) -> DataFrame:
    """``term, statistic, value`` rows: per coefficient, and for the fit as a whole."""
    summary = model.summary
    terms = [*names, "(intercept)"]
    per_term = {
        "std_error": summary.coefficientStandardErrors,
        "t_value": summary.tValues,
        "p_value": summary.pValues,
    }
    rows = [
        (term, statistic, float(value))
        for statistic, values in per_term.items()
        for term, value in zip(terms, values)
    ]
    whole = {
        "dispersion": summary.dispersion,
        "null_deviance": summary.nullDeviance,
        "deviance": summary.deviance,
        "df_null": summary.residualDegreeOfFreedomNull,
        "df_residual": summary.residualDegreeOfFreedom,
        "aic": summary.aic,
    }
    rows += [("(fit)", statistic, float(value)) for statistic, value in whole.items()]
    return spark.createDataFrame(rows, "term string, statistic string, value double")


def logistic_table(
    spark: SparkSession, model: mc.LogisticRegressionModel, names: Sequence[str]
) -> DataFrame:
    """``class, term, coefficient`` of the coefficient matrix and intercept vector."""
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = []
    for i in range(matrix.shape[0]):
        rows += [(i, name, float(value)) for name, value in zip(names, matrix[i])]
        rows.append((i, "(intercept)", float(intercepts[i])))
    return spark.createDataFrame(rows, "class int, term string, coefficient double")


def objective_table(spark: SparkSession, model: Model) -> DataFrame:
    rows = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "iteration int, objective double")


def with_probability(df: DataFrame, out: str = "p", of_class: int = 1) -> DataFrame:
    return df.withColumn(out, vector_to_array("probability")[of_class])


def with_best_threshold(
    model: mc.LogisticRegressionModel, df: DataFrame, label: str = "label"
) -> tuple[mc.LogisticRegressionModel, float]:
    """A copy of ``model`` that labels with the threshold of the best F-measure on ``df``, and that threshold.

    Rows that score exactly the threshold are positive, as they are where it is looked for.
    """
    scored = with_probability(model.transform(df), "score").select(F.col(label).alias("label"), "score")
    best = float(best_threshold(threshold_table(scored)).first()["threshold"])
    return model.copy().setThreshold(math.nextafter(best, 0.0)), best


# --- perceptron --------------------------------------------------------------


def fit_perceptron(
    df: DataFrame,
    layers: Sequence[int] = (4, 5, 4, 3),
    features: str = "features",
    label: str = "label",
    max_iter: int = 100,
    block_size: int = 128,
    seed: int = 1234,
) -> mc.MultilayerPerceptronClassificationModel:
    """The first layer has one unit per feature, the last one per class."""
    classifier = mc.MultilayerPerceptronClassifier(
        featuresCol=features,
        labelCol=label,
        layers=list(layers),
        maxIter=max_iter,
        blockSize=block_size,
        seed=seed,
    )
    with held(df.select(features, label), balanced=True) as (rows,):
        return classifier.fit(rows)


# --- trees -------------------------------------------------------------------

_CLASSIFIERS = {
    "tree": mc.DecisionTreeClassifier,
    "forest": mc.RandomForestClassifier,
    "boosted": mc.GBTClassifier,
}
_REGRESSORS = {
    "tree": mr.DecisionTreeRegressor,
    "forest": mr.RandomForestRegressor,
    "boosted": mr.GBTRegressor,
}


def tree_regressor(kind: str, features: str, label: str, seed: int = 1, **params):
    """A tree, forest or boosted regressor; ``params`` are the library's own parameters."""
    return _REGRESSORS[kind](featuresCol=features, labelCol=label, seed=seed, **params)


def tree_classifier(kind: str, features: str, label: str, seed: int = 1, **params):
    return _CLASSIFIERS[kind](featuresCol=features, labelCol=label, seed=seed, **params)


def fit_indexed_regressor(
    data: DataFrame,
    kind: str,
    train_when: str | None = None,
    features: str = "features",
    label: str = "label",
    max_categories: int = 4,
    seed: int = 1,
    **params,
) -> PipelineModel:
    """Vector index over all of ``data``, then a tree model fitted on the training rows.

    ``train_when`` is the condition of the training rows, all rows by default.
    """
    with held(data, balanced=True) as (rows,):
        return _indexed_regressor(rows, kind, train_when, features, label, max_categories, seed, params)


def indexed_regressor_metrics(
    data: DataFrame,
    kind: str,
    train_when: str,
    test_when: str,
    features: str = "features",
    label: str = "label",
    max_categories: int = 4,
    seed: int = 1,
    **params,
) -> DataFrame:
    """Metrics on the test rows of what :func:`fit_indexed_regressor` fits on the training rows.

    ``data`` is worked out once for the fit and the test, and held until both are done.
    """
    with held(data, balanced=True) as (rows,):
        model = _indexed_regressor(rows, kind, train_when, features, label, max_categories, seed, params)
        found = regression_metrics(model.transform(rows.where(test_when)), label)
        return data.sparkSession.createDataFrame(found.collect(), found.schema)


def _indexed_regressor(rows, kind, train_when, features, label, max_categories, seed, params) -> PipelineModel:
    indexer = fit_vector_index(rows, features, "indexed_features", max_categories)
    model = tree_regressor(kind, "indexed_features", label, seed, **params)
    return Pipeline(stages=[indexer, model]).fit(_training(rows, train_when))


def fit_indexed_classifier(
    data: DataFrame,
    kind: str,
    train_when: str | None = None,
    features: str = "features",
    label: str = "label",
    max_categories: int = 4,
    seed: int = 1,
    **params,
) -> PipelineModel:
    """Label and vector indexes over all of ``data``, a tree model, and labels mapped back."""
    with held(data, balanced=True) as (rows,):
        labels = fit_string_index(rows, [label], ["indexed_label"])
        indexer = fit_vector_index(rows, features, "indexed_features", max_categories)
        model = tree_classifier(kind, "indexed_features", "indexed_label", seed, **params)
        back = IndexToString(
            inputCol="prediction", outputCol="predicted_label", labels=labels.labelsArray[0]
        )
        stages = [labels, indexer, model, back]
        return Pipeline(stages=stages).fit(_training(rows, train_when))


def fit_binned_tree(df: DataFrame, columns: Sequence[str], tree, bins: int = 32, handle_invalid: str = "error") -> PipelineModel:
    """A tree model (:func:`tree_regressor`, :func:`tree_classifier`) over bins that all rows decide.

    The library looks for split points in a sample of rows and so knows nothing of a
    value that one row in a hundred thousand has. Here the columns are cut into
    bins first (:func:`~tabulon.operators.features.fit_bins`); a bin is a category of the tree, so none is missed, and a split
    may put any set of bins on one side.
    """
    names = [f"_bin_{c}" for c in columns]
    with held(df, balanced=True) as (rows,):
        bucketizer = fit_bins(rows, columns, names, bins, handle_invalid=handle_invalid)
        assembler = VectorAssembler(inputCols=names, outputCol=tree.getFeaturesCol())
        widest = max(map(len, bucketizer.getSplitsArray()))
        tree = tree.copy({tree.maxBins: max(widest, tree.getMaxBins())})
        return Pipeline(stages=[bucketizer, assembler, tree]).fit(rows)


def _training(rows: DataFrame, condition: str | None) -> DataFrame:
    return rows if condition is None else rows.where(condition)


def model_stage(model: PipelineModel) -> Model:
    """The fitted tree, forest or boosted stage of a pipeline."""
    return next(s for s in model.stages if hasattr(s, "featureImportances"))


def importance_table(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    values = model.featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(names, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double")


def tree_summary(spark: SparkSession, model: Model) -> DataFrame:
    """One row: kind of model, number of trees, nodes in all, and greatest depth."""
    trees = list(model.trees) if hasattr(model, "trees") else [model]
    nodes = model.totalNumNodes if hasattr(model, "totalNumNodes") else model.numNodes
    row = (type(model).__name__, len(trees), int(nodes), max(int(t.depth) for t in trees))
    return spark.createDataFrame([row], "model string, n_trees int, n_nodes int, depth int")


def with_cut_forest(model: mr.RandomForestRegressionModel, df: DataFrame, depths: Mapping[str, int]) -> DataFrame:
    """Add, per name, what the forest predicts if its trees are cut at that depth.

    A node that is cut off is stood for by its ancestor at that depth, whose prediction the library keeps.
    """
    leaf = "_leaf"
    scored = model.copy().setLeafCol(leaf).transform(df).withColumn(leaf, vector_to_array(leaf).cast("array<int>"))
    roots = [tree._call_java("rootNode") for tree in model.trees]
    for name, depth in depths.items():
        found = [F.array(*map(F.lit, _cut_leaves(root, depth)))[F.col(leaf)[i]] for i, root in enumerate(roots)]
        total = F.lit(0.0)
        for value in found:
            total = total + value
        scored = scored.withColumn(name, total / len(roots))
    return scored.drop(leaf)


def _cut_leaves(node, depth: int) -> list[float]:
    """Per leaf below ``node``, from left to right: the prediction of its ancestor at ``depth``, or its own above that."""
    if node.getClass().getSimpleName() == "LeafNode":
        return [float(node.prediction())]
    below = _cut_leaves(node.leftChild(), depth - 1) + _cut_leaves(node.rightChild(), depth - 1)
    return below if depth > 0 else [float(node.prediction())] * len(below)


def residual_table(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(label) - F.col(prediction))
